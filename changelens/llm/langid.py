"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training is one pass: each task adds up bucket counts per language and the
sums are merged by a grouped sum (languages x ``BUCKETS`` rows from a task at
most).  The smoothed log-probability matrix is broadcast; its size is
languages x ``BUCKETS`` numbers whatever the corpus, and is checked.  Scoring
turns a batch of texts into a sparse count matrix (a row's buckets and counts)
and multiplies it with the matrix in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changelens.llm.bpe import chunks
from changelens.llm.common import table
from changelens.session import prepare_python

BUCKETS = 1 << 14
SIZES = (1, 2, 3)
SMOOTHING = 0.5
MATRIX_MB = 256
PIECE = 1 << 20
#: Odd multipliers of the characters of an n-gram in its hash.
FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def bucket_counts(text: str) -> np.ndarray:
    """How often the n-grams of a text fall in each bucket; the text in lower case, a space at either end."""
    total = np.zeros(BUCKETS, np.int64)
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
    for at in range(0, len(codes), PIECE):
        piece = codes[at : at + PIECE + max(SIZES) - 1]
        for n in SIZES:
            m = min(PIECE, len(codes) - at) if at + PIECE + n - 1 <= len(codes) else len(piece) - n + 1
            if m <= 0:
                continue
            h = np.full(m, n * 0x27D4EB2F & 0xFFFFFFFF, np.uint32)
            for k in range(n):
                h = (h ^ piece[k : k + m]) * FACTORS[k]
                h ^= h >> np.uint32(15)
            total += np.bincount(h & np.uint32(BUCKETS - 1), minlength=BUCKETS)
    return total


def train(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, matrix) from (text, lang): matrix[bucket, language] of log-probabilities,
    and the log prior in a last row.  Rows without text, letter or language teach nothing."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in it:
            for part in chunks(b, "text"):
                for text, lang in zip(part.column("text").to_pylist(), part.column("lang").to_pylist(), strict=True):
                    if has_letter(text):
                        own = sums.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
                        own[:-1] += bucket_counts(text)
                        own[-1] += 1
        for lang, own in sums.items():
            at = np.nonzero(own)[0]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(own[at])], ["lang", "bucket", "n"])

    prepare_python(labelled.sparkSession)
    most = (MATRIX_MB << 20) // ((BUCKETS + 1) * 8)
    if labelled.select("lang").distinct().limit(most + 2).count() > most + 1:  # a null is one of them
        raise ValueError(f"more than {most} languages of {BUCKETS} buckets do not fit {MATRIX_MB} MB; use fewer buckets")
    rows = labelled.select(F.col("text").cast("string"), F.col("lang").cast("string")).where("text IS NOT NULL AND lang IS NOT NULL")
    sums = rows.mapInArrow(batches, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = sums.toArrow()  # languages x (BUCKETS + 1) rows at most
    langs = sorted(set(got["lang"].to_pylist()))
    counts = np.zeros((BUCKETS + 1, len(langs)))
    column = {lang: i for i, lang in enumerate(langs)}
    counts[got["bucket"].to_numpy(), [column[x] for x in got["lang"].to_pylist()]] = got["n"].to_numpy()
    grams = counts[:-1] + SMOOTHING
    return langs, np.vstack([np.log(grams / grams.sum(axis=0)), np.log(counts[-1:] / max(1.0, counts[-1].sum()))])


def scores(texts: list[str], matrix: np.ndarray) -> np.ndarray:
    """Posterior of each language (columns) for each text (rows)."""
    rows = [bucket_counts(t) for t in texts]
    at = [np.nonzero(r)[0] for r in rows]
    starts = np.concatenate(([0], np.cumsum([len(x) for x in at])[:-1])).astype(np.int64)
    buckets, counts = np.concatenate(at), np.concatenate([r[x] for r, x in zip(rows, at, strict=True)])
    logs = np.add.reduceat(matrix[buckets] * counts[:, None], starts, axis=0) + matrix[-1]
    logs = np.exp(logs - logs.max(axis=1, keepdims=True))
    return logs / logs.sum(axis=1, keepdims=True)


def predict(docs: DataFrame, langs: list[str], matrix: np.ndarray) -> DataFrame:
    """``docs`` (doc_id, text and any others that are not long) with lang_pred and score, without text.

    Defined cases: ``und`` with score 0 where the text is null or has no letter
    or nothing was learned; of equal scores the first language in code point
    order.  Rows that repeat are judged alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast((langs, matrix))
    prepare_python(docs.sparkSession)
    kept = [c for c in docs.columns if c != "text"]

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, matrix = shared.value
        for b in it:
            for part in chunks(b, "text"):
                texts = part.column("text").to_pylist()
                pred, best = ["und"] * len(texts), [0.0] * len(texts)
                able = [i for i, t in enumerate(texts) if langs and has_letter(t)]
                if able:
                    p = scores([texts[i] for i in able], matrix)
                    for i, k, s in zip(able, p.argmax(axis=1).tolist(), p.max(axis=1).tolist(), strict=True):
                        pred[i], best[i] = langs[k], s
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in kept), pa.array(pred, pa.string()), pa.array(best, pa.float64())], [*kept, "lang_pred", "score"])

    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes if c != "text")
    return docs.mapInArrow(batches, f"{schema}, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves 2 by 4; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score; learned from the documents that are not held out."""
    d = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), "lang").withColumn("held_out", held_out(F.col("doc_id")))
    langs, matrix = train(d.where(~F.col("held_out")))
    return predict(d.select("doc_id", "held_out", "text"), langs, matrix)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
