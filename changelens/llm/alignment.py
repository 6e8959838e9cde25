"""Alignment of the tokens of two vocabularies over the same text.

Both tokenizations are read as byte ranges.  The ends of A's tokens and of B's
tokens are put in a dictionary each (end to index); the ends that both have,
in order, cut the two id lists in groups, and every A-B pair inside a group is
a link.  Groups of one token each are words that both vocabularies know.

Neither vocabulary has tokens across the start of a spaced word, so the words
of a batch are aligned once each, all together (their ends are common to both
sides), and a worker remembers the words it has met.  New words are encoded as
lines of many words, and cut where both sides have an end at the end of a word;
words that could touch their neighbours, and lines that do not give back their
bytes, are encoded word by word.  What is known of the words is kept in arrays,
so a batch of texts is put together by slices.
A link's weight
is how many documents hold it: the documents' distinct pairs are counted by
partial aggregation and joined back.  The ``TABLE_PAIRS`` pairs in most
documents are broadcast (a bound of rows, whatever the data), the others are
joined by shuffle; none of those is in so many documents that it could be hot.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from changelens.llm.bpe import byte_letters, chunks
from changelens.llm.common import join_on, table
from changelens.session import prepare_python, stage_table

#: Pairs that are broadcast; words a worker remembers, and the longest of them; bytes of text aligned at once.
TABLE_PAIRS = 1 << 18
CACHE_WORDS = 200_000
CACHE_CHARS = 40
BATCH_BYTES = 1 << 20
#: A pair of ids as one number, a * PAIR + b; a word's place in its batch stands above it.
PAIR = 1 << 20
PLACE = 1 << 40
#: Links of a group that is expanded by its distinct ids instead.
LARGE_GROUP = 1 << 16

#: White space in front of a space: no word starts there.  Elsewhere one starts at every space.
NO_START = re.compile(r"[\s\u180e] ")
START = re.compile(r"(?<=[^\s\u180e])(?= )")
#: A word that is encoded alone: after it no word would start, or it has the sign that stands for a space.
ALONE = re.compile(r"[\s\u180e]\Z|▁")
#: New words aligned at once, and words to a line.
NEW_WORDS = 100_000
LINE_WORDS = 1_000


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of either side each group and those before it have, for the ends of two
    tokenizations of the same bytes."""
    at_a = dict(zip(ends_a.tolist(), range(1, len(ends_a) + 1), strict=True))
    at_b = dict(zip(ends_b.tolist(), range(1, len(ends_b) + 1), strict=True))
    both = sorted(at_a.keys() & at_b.keys())
    return (np.fromiter(map(at_a.__getitem__, both), np.int64, len(both)),
            np.fromiter(map(at_b.__getitem__, both), np.int64, len(both)))


def links(ids_a: np.ndarray, ids_b: np.ndarray, upto_a: np.ndarray, upto_b: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (word, A id, B id) that are linked, as sorted numbers, and how often.

    Every slice is expanded to its pairs; a very large one by its distinct ids, so that no slice
    needs more room than the square of the ids in it.
    """
    n_a, n_b = np.diff(upto_a, prepend=0), np.diff(upto_b, prepend=0)
    group_of = np.repeat(np.arange(len(n_a)), n_a)
    small = n_a * n_b <= LARGE_GROUP
    width = np.where(small, n_b, 0)[group_of]           # partners of each A token
    a = np.repeat(np.arange(len(ids_a)), width)
    first = np.cumsum(width) - width
    b = np.repeat((upto_b - n_b)[group_of] - first, width) + np.arange(len(a))
    keys = [place[group_of[a]] * PLACE + ids_a[a] * PAIR + ids_b[b]]
    times = [np.ones(len(a), np.int64)]
    for g in np.flatnonzero(~small):
        x, m = np.unique(ids_a[upto_a[g] - n_a[g] : upto_a[g]], return_counts=True)
        y, n = np.unique(ids_b[upto_b[g] - n_b[g] : upto_b[g]], return_counts=True)
        keys.append((place[g] * PLACE + x[:, None] * PAIR + y[None, :]).ravel())
        times.append(np.outer(m, n).ravel())
    key, time = np.concatenate(keys), np.concatenate(times)
    order = np.argsort(key, kind="stable")
    key, time = key[order], time[order]
    start = np.flatnonzero(np.diff(key, prepend=-1))
    return key[start], np.add.reduceat(time, start) if len(start) else time


def count(ids: list[list[int]]) -> np.ndarray:
    return np.fromiter(map(len, ids), np.int64, len(ids))


def flat(ids: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(ids), np.int64)


def slices(first: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, sizes) of the slices ``at``, one behind the other, where slice i is first[i]..first[i + 1]."""
    size = first[at + 1] - first[at]
    upto = np.cumsum(size)
    return np.repeat(first[at] - upto + size, size) + np.arange(upto[-1] if len(upto) else 0), size


class Entries(NamedTuple):
    """What is known of some words, each with a space in front: ``numbers`` has a row for each word (n_a,
    n_b, n_groups, n_links), ``told`` its groups, ``first`` where its ``pairs`` and their ``times`` start."""

    numbers: np.ndarray
    told: list[str]
    first: np.ndarray
    pairs: np.ndarray
    times: np.ndarray

    def of(self, at: np.ndarray) -> Entries:
        places, size = slices(self.first, at)
        return Entries(self.numbers[at], [self.told[i] for i in at.tolist()], np.concatenate(([0], np.cumsum(size))), self.pairs[places], self.times[places])

    def start(self, n: int) -> Entries:
        end = self.first[n]
        return Entries(self.numbers[:n], self.told[:n], self.first[: n + 1], self.pairs[:end], self.times[:end])

    def behind(self, others: list[Entries]) -> Entries:
        """The entries of ``others`` and these, in order."""
        every = [*others, self]
        shift = np.cumsum([0, *(e.first[-1] for e in every)])
        return Entries(
            np.concatenate([e.numbers for e in every]), list(chain.from_iterable(e.told for e in every)),
            np.concatenate([[0], *(e.first[1:] + n for e, n in zip(every, shift, strict=False))]),
            np.concatenate([e.pairs for e in every]), np.concatenate([e.times for e in every]))


def no_entries() -> Entries:
    none = np.empty(0, np.int64)
    return Entries(np.empty((0, 4), np.int64), [], np.zeros(1, np.int64), none, none)


class Aligner:
    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; threads that wait for work would use others
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        letters = byte_letters()
        named = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.bytes_a = [bytes(letters[c] for c in named.get(i, "") if c in letters) for i in range(max(named) + 1)]
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b = [self.piece_bytes(i) for i in range(self.b.get_piece_size())]
        self.len_a, self.len_b = (np.fromiter(map(len, x), np.int64) for x in (self.bytes_a, self.bytes_b))
        # ids as text, with what stands behind them inside a group and at its end
        told = lambda n, end: np.array([f"{i}{end}" for i in range(n)], object)
        n_a, n_b = len(self.bytes_a), len(self.bytes_b)
        self.told_a, self.told_b = (told(n_a, ","), told(n_a, "|")), (told(n_b, ","), told(n_b, ";"))
        self.last_b = told(n_b, "\n")
        #: Places of the words in ``known``; below zero where either side's bytes are not those of the text.
        self.words: dict[str, int] = {}
        self.known = no_entries()

    def piece_bytes(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:-1], 16)])
        return self.b.id_to_piece(i).replace("▁", " ").encode()

    @staticmethod
    def split(text: str) -> list[str]:
        """The words of a text, without the space each starts with (the first one's is not in the text)."""
        spaced = " " + text
        if NO_START.search(spaced) is None:
            return text.split(" ")
        return [w[1:] for w in START.split(spaced)]

    def encoded(self, words: list[str]) -> tuple[list[list[int]], list[list[int]], list[bool]]:
        """Both sides' ids of a space and each word, and whether both give back its bytes; else it has none."""
        spaced = [" " + w for w in words]
        a = [e.ids for e in self.a.encode_batch_fast(spaced, add_special_tokens=False)]
        # alone, an empty word would lose its space
        b = [x if w else x[2:] for w, x in zip(words, self.b.encode([w or "\n " for w in words], num_threads=1), strict=True)]
        raw = [w.encode() for w in spaced]
        lens = count(raw)

        def all_fine(ids: list[list[int]], parts: list[bytes], sizes: np.ndarray) -> bool:
            n = count(ids)
            return (bool(n.all()) and np.array_equal(np.add.reduceat(sizes[flat(ids)], np.cumsum(n) - n), lens)
                    and b"".join([parts[k] for k in chain.from_iterable(ids)]) == b"".join(raw))

        if all_fine(a, self.bytes_a, self.len_a) and all_fine(b, self.bytes_b, self.len_b):
            return a, b, [True] * len(words)
        fine = [b"".join([self.bytes_a[k] for k in x]) == r and b"".join([self.bytes_b[k] for k in y]) == r for x, y, r in zip(a, b, raw, strict=True)]
        for i, ok in enumerate(fine):
            if not ok:
                a[i], b[i] = [], []
        return a, b, fine

    def in_lines(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Both sides' ids of the words, each with a space in front, and how many each word has, encoded in
        lines of many words; None if some line does not give back its bytes or has no end where a word ends."""
        lines = [" ".join(words[i : i + LINE_WORDS]) for i in range(0, len(words), LINE_WORDS)]
        spaced = [" " + x for x in lines]
        raw = "".join(spaced).encode()
        ends = np.cumsum(np.fromiter(map(len, map(str.encode, words)), np.int64, len(words)) + 1)
        out = []
        for ids, parts, sizes in (
                ([e.ids for e in self.a.encode_batch_fast(spaced, add_special_tokens=False)], self.bytes_a, self.len_a),
                (self.b.encode(lines, num_threads=1), self.bytes_b, self.len_b)):
            joined = np.concatenate([np.array(x, np.int64) for x in ids])
            token_ends = np.cumsum(sizes[joined])
            upto = np.searchsorted(token_ends, ends, "right")
            if not upto[0] or not np.array_equal(token_ends[upto - 1], ends) or b"".join([parts[k] for k in chain.from_iterable(ids)]) != raw:
                return None
            out += [joined, np.diff(upto, prepend=0)]
        return tuple(out)

    def entries(self, words: list[str]) -> tuple[list[str], Entries]:
        """The words whose bytes both sides give back, and their entries."""
        near = [w for w in words if w and ALONE.search(w) is None]
        made = self.in_lines(near) if near else None
        if made is None:
            near = []
        alone = words if not near else [w for w in words if not w or ALONE.search(w) is not None]
        if alone:
            a, b, fine = self.encoded(alone)
            given = [np.concatenate(x) if made else x[0] for x in zip(*([made] if made else []), (flat(a), count(a), flat(b), count(b)), strict=True)]
            words = near + [w for w, ok in zip(alone, fine, strict=True) if ok]
            kept = np.concatenate((np.ones(len(near), bool), fine))
        else:
            given, words, kept = made, near, np.ones(len(near), bool)
        ids_a, n_a, ids_b, n_b = given
        n_a, n_b = n_a[kept], n_b[kept]  # the others have no ids
        upto_a, upto_b = align(np.cumsum(self.len_a[ids_a]), np.cumsum(self.len_b[ids_b]))
        place = np.repeat(np.arange(len(words)), n_a)[upto_a - 1] if len(upto_a) else np.empty(0, np.int64)
        of_group = lambda w: np.bincount(place, w, len(words)).astype(np.int64)
        sizes_a, sizes_b = np.diff(upto_a, prepend=0), np.diff(upto_b, prepend=0)

        # a group's ids of A, then of B: a token's place is its own plus the other side's tokens in front of it
        out = np.empty(len(ids_a) + len(ids_b), object)
        for ids, upto, sizes, others, told in (
                (ids_a, upto_a, sizes_a, upto_b - sizes_b, self.told_a), (ids_b, upto_b, sizes_b, upto_a, self.told_b)):
            at = np.arange(len(ids)) + np.repeat(others, sizes)
            out[at] = told[0][ids]
            out[at[upto - 1]] = told[1][ids[upto - 1]]
        out[np.cumsum(n_a + n_b) - 1] = self.last_b[ids_b[np.cumsum(n_b) - 1]]
        told = "".join(out.tolist()).split("\n")[:-1]

        key, times = links(ids_a, ids_b, upto_a, upto_b, place)
        first = np.searchsorted(key, np.arange(len(words) + 1) * PLACE)
        return words, Entries(np.stack([n_a, n_b, of_group(None), of_group(sizes_a * sizes_b)], axis=1), told, first, key % PLACE, times)

    def learn(self, words: set[str]) -> int:
        """Have the entries of ``words`` in ``self.known``; returns how many of them all are to be remembered."""
        new = [w for w in words if w not in self.words]
        if len(self.words) + len(new) > CACHE_WORDS:
            common = [w for w in words if w in self.words]  # the common ones are in any batch
            at = np.array([self.words[w] for w in common], np.int64)
            self.known = self.known.of(at[at >= 0])
            self.words = dict(zip(common, np.where(at < 0, -1, np.cumsum(at >= 0) - 1).tolist(), strict=True))
        short = [w for w in new if len(w) <= CACHE_CHARS]
        long = [w for w in new if len(w) > CACHE_CHARS]
        made, n, remembered = [self.known], len(self.known.told), 0
        for some in (short, long):
            remembered = n if some is long else 0
            for i in range(0, len(some), NEW_WORDS):
                part = some[i : i + NEW_WORDS]
                self.words.update(dict.fromkeys(part, -1))
                fine, entries = self.entries(part)
                self.words.update(zip(fine, range(n, n + len(fine)), strict=True))
                made.append(entries)
                n += len(fine)
        if len(made) > 1:
            self.known = made[-1].behind(made[:-1])
        return remembered

    def batch(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Of the texts: their numbers (n_a, n_b, n_groups, n_links), groups, where their distinct pairs start
        and end, these pairs, sorted, and the links of each."""
        split = [self.split(t) if t else [] for t in texts]
        words = set().union(*split)
        remembered = self.learn(words)
        at = [list(map(self.words.__getitem__, ws)) for ws in split]
        at = [x if not x or min(x) >= 0 else [] for x in at]
        told = self.known.told.__getitem__
        groups = [";".join(map(told, x)) for x in at]
        words_upto = np.cumsum(count(at))
        flat_at = flat(at)
        sums = np.concatenate((np.zeros((1, 4), np.int64), np.cumsum(self.known.numbers[flat_at], axis=0)))
        numbers = np.diff(sums[words_upto], axis=0, prepend=sums[:1])

        places, size = slices(self.known.first, flat_at)
        text = np.repeat(np.repeat(np.arange(len(texts)), np.diff(words_upto, prepend=0)), size)
        key, times = text * PLACE + self.known.pairs[places], self.known.times[places]
        order = np.argsort(key)
        key, times = key[order], times[order]
        start = np.flatnonzero(np.diff(key, prepend=-1))
        key, times = key[start], np.add.reduceat(times, start) if len(start) else times
        first = np.searchsorted(key, np.arange(len(texts) + 1) * PLACE)

        if remembered < len(self.known.told):
            self.known = self.known.start(remembered)
        for w in words:
            if len(w) > CACHE_CHARS:
                del self.words[w]
        return numbers, groups, first, key % PLACE, times

    def texts(self, texts: list[str]) -> Iterator[tuple]:
        """(n_a, n_b, n_groups, n_links, groups, pairs, times) of each text."""
        numbers, groups, first, pairs, times = self.batch(texts)
        for n, told, i, j in zip(numbers.tolist(), groups, first[:-1].tolist(), first[1:].tolist(), strict=True):
            yield *n, told, pairs[i:j].tolist(), times[i:j].tolist()


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's aligner."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
    ("groups", pa.string()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])
DDL = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, ``groups`` (``a1,a2|b1;a3|b2``, ids in order),
    and its distinct linked ``pairs`` (a * PAIR + b) with ``times``, the links of each.

    A (a byte-level vocabulary) takes a space and the text, B (pieces) the text
    and adds the space.  Defined cases: a null or empty text, and one whose
    bytes either side does not give back, has no tokens: zeros, an empty string
    and empty lists; strings of special tokens are plain text; rows that repeat
    are aligned alike; other columns are not read; an empty table gives an
    empty result.
    """

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = aligner(path_a, path_b)
        for b in it:
            for part in chunks(b, "text", BATCH_BYTES):
                numbers, groups, first, pairs, times = known.batch([x or "" for x in part.column("text").to_pylist()])
                lists = [pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(x, pa.int64())) for x in (pairs, times)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c, pa.int64()) for c in numbers.T), pa.array(groups, pa.string()), *lists], schema=SCHEMA)

    prepare_python(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(batches, DDL)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n_docs, best): in how many rows of ``aligned`` a pair is linked, and whether no other pair of its A id is in more.

    An A id has at most one pair for each id of B, so a window over it is bounded by the vocabulary.
    """
    n = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n_docs"))
    most = F.max("n_docs").over(Window.partitionBy(F.floor(F.col("pair") / PAIR).cast("long")))
    return n.withColumn("best", F.col("n_docs") == most)


def cross_tokenizer(docs: DataFrame, path_a: str, path_b: str, table_pairs: int = TABLE_PAIRS) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair is in the most documents
    of all pairs of its A id), count_sum (over links: documents that hold the pair), groups_sha256 ('' without tokens)."""
    sha = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    rows = stage_table(
        aligned(docs, path_a, path_b).select("doc_id", "n_a", "n_b", "n_groups", "n_links", sha, "pairs", "times")
        .withColumn("row", F.monotonically_increasing_id()), "alignment")
    counts = stage_table(pair_counts(rows), "alignment-pairs")
    frequent = stage_table(counts.orderBy(F.col("n_docs").desc(), "pair").limit(table_pairs), "alignment-frequent")

    held = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), "x.times")
    sums = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n_docs")).alias("count_sum")]
    near = held.join(F.broadcast(frequent), "pair").groupBy("row").agg(*sums)
    rest = held.join(F.broadcast(frequent.select("pair")), "pair", "left_anti")
    rare = join_on(rest, counts.join(F.broadcast(frequent.select("pair")), "pair", "left_anti"), ["pair"], hint="merge")
    total = near.unionByName(rare.groupBy("row").agg(*sums)).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    none = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return join_on(rows.drop("pairs", "times"), total, ["row"], "left", "merge").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", none("n_best"), none("count_sum"), "groups_sha256")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return cross_tokenizer(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
