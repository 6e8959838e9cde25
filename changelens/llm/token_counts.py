"""Token counts by a two-tier lookup of pre-token lengths.

A piece of this kind of vocabulary has the space mark only in front and never a
line break, so BPE never merges across the start of a word: a text's count is
the sum over its words.  Tier one is a table of the most frequent words'
counts, broadcast (``TABLE_WORDS`` entries at most); tier two is each worker's
own cache, filled by encoding the words that tier one lacks.  Both only save
time.  Words are never shuffled, but for the bounded lists of which tier one
is made: each task's most frequent words in a sample of ``SAMPLE_ROWS`` rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelens.llm.bpe import chunks
from changelens.llm.common import table
from changelens.session import prepare_python

TABLE_WORDS = 1 << 15
SAMPLE_ROWS = 20_000
CACHE_WORDS = 300_000
LIMIT = 4096
MARK = "▁"  # stands for a space in pieces

#: Words of a line, with the spaces (or marks) in front of each; the first may have none.
SPACED = regex.compile(rf"[ {MARK}]*[^ {MARK}]+|[ {MARK}]+").findall


class Counts(dict):
    """Tokens of a word by the word, filled on demand.

    A key that starts with a space or mark is a word with that many spaces in
    front; any other is the start of a line and has none.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        self.encode = sentencepiece.SentencePieceProcessor(model_file=path).encode
        self.frequent: dict[str, int] = {}

    def __missing__(self, word: str) -> int:
        n = self.frequent.get(word)
        if n is None:
            # the model puts one mark in front of a text; a line break is a token of its own after it
            n = len(self.encode(word[1:])) if word[0] in f" {MARK}" and len(word) > 1 else len(self.encode("\n" + word)) - 2
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = n
        return n

    def words(self, text: str) -> Iterator[str]:
        """The words of a whole text; line breaks are not among them."""
        for i, line in enumerate(text.split("\n")):
            if not i:
                line = " " + line
            yield from SPACED(line)

    def count(self, text: str) -> int:
        if not text:
            return 0
        return text.count("\n") + sum(map(self.__getitem__, self.words(text)))


_COUNTS: dict[str, Counts] = {}


def counter(path: str, frequent: dict[str, int]) -> Counts:
    """The worker's cache for a model."""
    if path not in _COUNTS:
        _COUNTS[path] = Counts(path)
    _COUNTS[path].frequent = frequent
    return _COUNTS[path]


def frequent_words(docs: DataFrame, path: str, words: int = TABLE_WORDS, sample_rows: int = SAMPLE_ROWS) -> dict[str, int]:
    """Tier one: counts of the most frequent words of a sample.

    The sums are as bounded as the sample is; few partitions send their ``words`` rows to the driver.
    """
    prepare_python(docs.sparkSession)
    n = docs.count()
    sample = docs if n <= sample_rows else docs.sample(sample_rows / n, seed=7)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, seen = counter(path, {}), Counter()
        for b in it:
            for part in chunks(b, "text"):
                for text in part.column("text").to_pylist():
                    seen.update(c.words(text or ""))
                if len(seen) > 8 * words:
                    seen = Counter(dict(seen.most_common(words)))
        top = seen.most_common(words)
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in top if len(w) <= 64], pa.string()), pa.array([k for w, k in top if len(w) <= 64], pa.int64())], ["word", "k"])

    top = (
        sample.select(F.col("text").cast("string")).mapInArrow(batches, "word string, k long")
        .groupBy("word").agg(F.sum("k").alias("k")).coalesce(4).orderBy(F.col("k").desc(), "word").limit(words).select("word").collect()
    )
    c = Counts(path)
    return {r.word: c[r.word] for r in top}


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.

    Defined cases: a null text counts as empty and has no tokens; rows that
    repeat count alike; other columns are not read; an empty table gives an
    empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent_words(docs, path))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path, shared.value)
        for b in it:
            for part in chunks(b, "text"):
                n = [c.count(x or "") for x in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("n_bytes"), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return (
        docs.select(F.col("doc_id").cast("long"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
        .mapInArrow(batches, "doc_id long, n_bytes long, n_tokens long")
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
