"""Phrases whose words keep together, mined by multikey quicksort of suffixes.

Every word of a piece (a stretch without sentence marks) starts a suffix.  A
suffix is cut to ``LONGEST`` words and, because a phrase is only as frequent as
any two neighbours in it, before its first infrequent pair of words; suffixes
of one word then have nothing to say.  Each task combines equal suffixes and
groups them by their leading words: the first, or if it is hot as many as it
takes to a pair that is not, so a group holds fewer than ``HOT`` suffixes
whatever the data.  Groups are dealt into parts by a hash, and a task sends one
row for each part, so its rows do not grow with the groups; there are as many
parts as it takes for one to fit in a task.  There a group's suffixes are put in
three by the pivot's word at a depth (less, equal, greater); the equal part goes on one word deeper, its weight is the count of
the phrase so far, and a part lighter than ``least`` is abandoned.  Phrases
shorter than the leading words may also lie in other groups, so their counts
are partial and summed.

Which words and which pairs are frequent or hot goes to the tasks as tables of
a fixed number of hash slots, 2 bits each, whatever the corpus.  Pairs are counted by a 32-bit hash, in sorted
lists of slots.  Words or pairs that share a slot with a frequent one only make
a suffix longer than needed; the counts themselves are of the words.
"""

from __future__ import annotations

import random
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changelens.llm.bpe import chunks
from changelens.llm.common import join_on, table
from changelens.session import prepare_python, stage_table

LEAST = 100
LONGEST = 5
TOP = 2000
UNKNOWN = "und"
#: Occurrences from which a word or a pair is hot: a group of suffixes is smaller.
HOT = 50_000
SLOT_BITS = 26
CHUNK_BITS = 22
#: Slots of pairs: as counted, and in the table that goes to the tasks; lists of counted slots are cut by their first bits.
PAIR_BITS = 32
TABLE_BITS = 26
PART_BITS = 8
#: Different words or suffixes that a task combines before it sends them on; words it remembers; pairs it counts at once.
COMBINED = 400_000
KNOWN = 500_000
PAIRS = 1 << 22
#: Parts of a language's suffixes at least, and occurrences of frequent words for each part beyond that.
PARTS = 64
PART_WORDS = 1 << 22
BATCH_CHARS = 1 << 21

#: A-Z are folded, these marks end a piece, tabs are blanks.
MARKS = b".,;:!?\n\x0b\x0c\r"
#: Stands for a mark, as a word of its own; no byte of UTF-8.
END = b"\xff"
FOLD = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + MARKS + b"\t", b"abcdefghijklmnopqrstuvwxyz" + END * len(MARKS) + b" ")


def texts_of(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """(lang, folded text) of the rows of a task."""
    for b in it:
        for part in chunks(b, "text", BATCH_CHARS):
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                if text:
                    yield lang, text.encode().translate(FOLD)


def hashed(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, xxhash.xxh32_intdigest(lang))


def slot(h: int) -> int:
    return h >> (64 - SLOT_BITS)


def packed(level: np.ndarray) -> bytes:
    """Levels of 0 to 2, four to a byte, the first in the lowest bits."""
    return (level.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8).tobytes()


# --- words --------------------------------------------------------------------

def words(docs: DataFrame) -> DataFrame:
    """(lang, word, f) of all words, each task combining its own first."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}

        def out() -> pa.RecordBatch:
            columns = [[], [], []]
            for lang, c in seen.items():
                columns[0] += [lang] * len(c)
                columns[1] += c.keys()
                columns[2] += c.values()
            seen.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.int64())], ["lang", "word", "f"])

        for lang, text in texts_of(it):
            seen.setdefault(lang, Counter()).update(text.replace(END, b" ").split())
            if sum(map(len, seen.values())) > COMBINED:
                yield out()
        yield out()

    made = docs.mapInArrow(batches, "lang string, word binary, f long")
    return made.groupBy("lang", F.col("word").cast("string").alias("word")).agg(F.sum("f").alias("f"))


def levels(frequent: DataFrame, hot: int) -> bytes:
    """The table of slots: 0 where no frequent word is, 1, or 2 where one is hot; four slots a byte.

    Each task makes its own part, so the driver takes 2**(SLOT_BITS - CHUNK_BITS) parts of a fixed size.
    """

    def slots(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            at = [slot(hashed(lang, w.encode())) for lang, w in zip(b.column("lang").to_pylist(), b.column("word").to_pylist(), strict=True)]
            level = [2 if f >= hot else 1 for f in b.column("f").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x >> CHUNK_BITS for x in at], pa.int32()), pa.array(at, pa.int64()), pa.array(level, pa.int32())], ["part", "slot", "level"])

    def parts(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for b in it:
            part, at, level = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            for p in np.unique(part).tolist():
                held = made.setdefault(p, np.zeros(1 << CHUNK_BITS, np.uint8))
                np.maximum.at(held, at[part == p] & ((1 << CHUNK_BITS) - 1), level[part == p].astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array(list(made), pa.int32()), pa.array(list(map(packed, made.values())), pa.binary())], ["part", "bits"])

    found = frequent.select("lang", "word", "f").mapInArrow(slots, "part int, slot long, level int")
    rows = found.groupBy("part", "slot").agg(F.max("level").alias("level")).repartition(1 << (SLOT_BITS - CHUNK_BITS), "part").mapInArrow(
        parts, "part int, bits binary").collect()
    whole = bytearray((1 << SLOT_BITS) // 4)
    for r in rows:
        whole[r.part << (CHUNK_BITS - 2) : (r.part + 1) << (CHUNK_BITS - 2)] = r.bits
    return bytes(whole)


# --- pairs ----------------------------------------------------------------------

class Words(dict):
    """Numbers of the words a task has met, with the level and hash of each; 0 is the end of a piece."""

    def __init__(self, lang: str, table: bytes) -> None:
        super().__init__()
        self.lang, self.table = lang, table
        self.level, self.hash = [0], [0]
        self[END] = 0

    def __missing__(self, word: bytes) -> int:
        h = hashed(self.lang, word)
        at = slot(h)
        self.level.append(self.table[at >> 2] >> 2 * (at & 3) & 3)
        self.hash.append(h)
        self[word] = n = len(self)
        return n


class Numbered:
    """The texts of one language as numbers of words: a task's rows are taken some texts at a time."""

    def __init__(self, lang: str, table: bytes) -> None:
        self.known = Words(lang, table)

    def take(self, text: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """(words, levels, slots of the pairs that start at each but the last; pairs that end a piece or
        have an infrequent word are told by a level of 0)."""
        if len(self.known) > KNOWN:
            self.known = Words(self.known.lang, self.known.table)
        ws = text.replace(END, b" \xff ").split()
        numbers = list(map(self.known.__getitem__, ws))
        level = np.fromiter(map(self.known.level.__getitem__, numbers), np.uint8, len(ws))
        h = np.fromiter(map(self.known.hash.__getitem__, numbers), np.uint64, len(ws))
        mixed = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + (h[1:] ^ (h[1:] >> np.uint64(29)))) * np.uint64(0xBF58476D1CE4E5B9)
        return ws, level, (mixed >> np.uint64(64 - PAIR_BITS)).astype(np.uint32)


def table_slot(pair: np.ndarray) -> np.ndarray:
    return pair >> np.uint32(PAIR_BITS - TABLE_BITS)


def frequent_pairs(docs: DataFrame, shared: object, least: int, hot: int) -> bytes:
    """The table of pairs: 1 for each slot where some pair slot was met ``least`` times or more, 2 for ``hot``; four slots a byte.

    Tasks send sorted slots with their counts, a row for each part of the
    slots; a part is added up in one task, which holds one list at a time
    beside the sum, and gives its bits of the table."""
    part_shift = np.uint32(PAIR_BITS - PART_BITS)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbered: dict[str, Numbered] = {}
        held: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            slots, n = np.unique(np.concatenate(held) if held else np.empty(0, np.uint32), return_counts=True)
            held.clear()
            cuts = np.searchsorted(slots >> part_shift, np.arange((1 << PART_BITS) + 1))
            parts = [p for p in range(1 << PART_BITS) if cuts[p] < cuts[p + 1]]
            lists = [(slots[cuts[p] : cuts[p + 1]], n[cuts[p] : cuts[p + 1]]) for p in parts]
            gaps = [np.diff(s, prepend=np.uint32(p << (PAIR_BITS - PART_BITS))).astype("<u4").tobytes() for p, (s, _) in zip(parts, lists, strict=True)]
            # four planes of bytes: the high ones are almost all zero
            planes = [np.frombuffer(g, np.uint8).reshape(-1, 4).T.tobytes() for g in gaps]
            counts = [m.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for _, m in lists]
            return pa.RecordBatch.from_arrays(
                [pa.array(parts, pa.int32()), pa.array(planes, pa.binary()), pa.array(counts, pa.binary())], ["part", "gaps", "counts"])

        size = 0
        for lang, text in texts_of(it):
            ws, level, pair = numbered.setdefault(lang, Numbered(lang, shared.value)).take(text)
            held.append(pair[(level[:-1] > 0) & (level[1:] > 0)])
            size += len(held[-1])
            if size > PAIRS:
                yield out()
                size = 0
        yield out()

    def unpacked(planes: bytes) -> np.ndarray:
        return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel()

    def summed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a task's rows come sorted by part
        now, slots, counts, waiting = None, None, None, []

        def merge() -> None:
            nonlocal slots, counts
            s = np.concatenate([slots, *(x for x, _ in waiting)])
            c = np.concatenate([counts, *(y for _, y in waiting)])
            waiting.clear()
            order = np.argsort(s, kind="stable")
            s, c = s[order], c[order]
            start = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1]))) if len(s) else np.empty(0, np.int64)
            slots, counts = s[start], np.add.reduceat(c, start) if len(s) else c

        def close() -> pa.RecordBatch:
            merge()
            level = np.zeros(1 << (TABLE_BITS - PART_BITS), np.uint8)
            for n, value in ((least, 1), (hot, 2)):
                level[table_slot(slots[counts >= n]) & np.uint32(len(level) - 1)] = value
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([packed(level)], pa.binary())], ["part", "bits"])

        for b in it:
            for part, gaps, n in zip(*(b.column(c).to_pylist() for c in ("part", "gaps", "counts")), strict=True):
                if part != now:
                    if now is not None:
                        yield close()
                    now, slots, counts = part, np.empty(0, np.uint32), np.empty(0, np.int64)
                first = np.uint32(part << (PAIR_BITS - PART_BITS))
                waiting.append((first + np.cumsum(unpacked(gaps), dtype=np.uint32), unpacked(n).astype(np.int64)))
                if sum(len(x) for x, _ in waiting) > max(1 << 20, len(slots)):
                    merge()
        if now is not None:
            yield close()

    lists = docs.mapInArrow(batches, "part int, gaps binary, counts binary")
    rows = lists.repartition(1 << PART_BITS, "part").sortWithinPartitions("part").mapInArrow(summed, "part int, bits binary").collect()
    size = (1 << (TABLE_BITS - PART_BITS)) // 4
    whole = bytearray(size << PART_BITS)
    for r in rows:
        whole[r.part * size : (r.part + 1) * size] = r.bits
    return bytes(whole)


# --- suffixes -------------------------------------------------------------------

def suffixes_of(text: bytes, numbered: Numbered, pairs: np.ndarray, longest: int, seen: Counter) -> None:
    """Count the suffixes of two words or more in a folded text, as far as neighbours are frequent pairs.

    A suffix is kept with how many of its words lead to its group, and whether no other group starts with these."""
    ws, level, pair = numbered.take(text)
    if len(ws) < 2:
        return
    at = table_slot(pair)
    linked = pairs[at >> np.uint32(2)] >> (np.uint32(2) * (at & np.uint32(3))).astype(np.uint8) & 3
    linked[(level[:-1] == 0) | (level[1:] == 0)] = 0
    starts = np.flatnonzero(linked)
    if not len(starts):
        return
    ends = np.flatnonzero(np.diff(np.concatenate((linked > 0, [False])).astype(np.int8)) == -1)  # where a run of pairs ends
    size = np.minimum(ends[np.searchsorted(ends, starts)] - starts + 2, longest)
    warm = np.concatenate((np.flatnonzero(linked < 2), [len(ws)]))  # pairs that are not hot
    lead = np.where(level[starts] < 2, 1, warm[np.searchsorted(warm, starts)] - starts + 2)
    whole = (lead <= size) | (size == longest)
    lead = np.minimum(lead, size)
    seen.update([(k, x, *ws[i : i + n]) for i, n, k, x in zip(starts.tolist(), size.tolist(), lead.tolist(), whole.tolist(), strict=True)])


def part_of(lead: bytes, parts: int) -> int:
    return xxhash.xxh64_intdigest(lead) % parts


def suffixes(docs: DataFrame, shared: object, longest: int, parts: int) -> DataFrame:
    """(lang, part, groups): what each task combined, a row for each part.

    ``groups`` has the part's groups, cut by ``END``: a line with 1 if no other group starts with
    its leading words, else 0, and these words, then a line for each suffix, its weight and its further words.
    """

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bits = shared.value
        pairs = np.frombuffer(bits, np.uint8)
        seen: dict[str, Counter] = {}
        numbered: dict[str, Numbered] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, c in seen.items():
                groups: dict[tuple, list[bytes]] = {}
                for (k, whole, *ws), n in c.items():
                    groups.setdefault((whole, *ws[:k]), []).append(b" ".join([b"%d" % n, *ws[k:]]))
                dealt: dict[int, list[bytes]] = {}
                for (whole, *ws), lines in groups.items():
                    lead = b" ".join(ws)
                    dealt.setdefault(part_of(lead, parts), []).append(b"\n".join([b"%d %s" % (whole, lead), *sorted(lines)]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(dealt), pa.string()), pa.array(list(dealt), pa.int32()),
                     pa.array([END.join(g) for g in dealt.values()], pa.binary())], ["lang", "part", "groups"])
            seen.clear()

        for lang, text in texts_of(it):
            suffixes_of(text, numbered.setdefault(lang, Numbered(lang, table)), pairs, longest, seen.setdefault(lang, Counter()))
            if sum(map(len, seen.values())) > COMBINED:
                yield from out()
        yield from out()

    return docs.mapInArrow(batches, "lang string, part int, groups binary")


def three_way(rows: list[tuple[list[bytes], int]], depth: int, prefix: bytes, least: int, found: list[tuple[bytes, int]]) -> None:
    """Multikey quicksort of (words, weight) from ``depth`` on, all equal before it.

    Every equal part's phrase and weight go to ``found``; parts lighter than
    ``least`` are dropped with all that would lie below them.  The larger side
    of a cut is worked off in the loop, so calls nest with the logarithm of the rows.
    """
    todo = [(rows, depth, prefix)]
    while todo:
        rows, depth, prefix = todo.pop()
        rows = [r for r in rows if len(r[0]) > depth]
        if sum(n for _, n in rows) < least:
            continue
        pivot = rows[random.randrange(len(rows))][0][depth]
        less, equal, greater = [], [], []
        for r in rows:
            w = r[0][depth]
            (equal if w == pivot else less if w < pivot else greater).append(r)
        todo += [(less, depth, prefix), (greater, depth, prefix)]
        weight = sum(n for _, n in equal)
        if weight >= least:
            phrase = prefix + b" " + pivot if prefix else pivot
            found.append((phrase, weight))
            todo.append((equal, depth + 1, phrase))


def phrases(docs: DataFrame, frequent: DataFrame, least: int = LEAST, longest: int = LONGEST, hot: int = HOT) -> DataFrame:
    """(lang, phrase, f) of all phrases of two to ``longest`` words that occur ``least`` times or more."""
    sc = docs.sparkSession.sparkContext
    table = levels(frequent, hot)
    pairs = frequent_pairs(docs, sc.broadcast(table), least, hot)
    shared = sc.broadcast((table, pairs))
    # a suffix starts at a frequent word
    most = frequent.groupBy("lang").agg(F.sum("f").alias("n")).agg(F.max("n")).first()[0] or 0
    parts = max(PARTS, most // PART_WORDS)

    def counted(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a task's rows come sorted by part; a part may go on in the next batch
        now, held = None, []
        found: list[tuple[str, bytes, int]] = []
        partial: Counter = Counter()  # phrases that may lie in other groups, too

        def close(lang: str, head: bytes, lists: list[bytes]) -> None:
            lead = head[2:]
            whole = head.startswith(b"1")
            ws = lead.split(b" ")
            rows = [(further, int(n)) for lines in lists for n, *further in (line.split(b" ") for line in lines.split(b"\n"))]
            weight = sum(n for _, n in rows)
            for k in range(2, len(ws) + (not whole)):
                partial[lang, b" ".join(ws[:k])] += weight
            if weight >= least:
                if whole and len(ws) > 1:
                    found.append((lang, lead, weight))
                deeper: list[tuple[bytes, int]] = []
                three_way(rows, 0, lead, least, deeper)
                found.extend((lang, p, n) for p, n in deeper)

        def batch(rest: bool = False) -> pa.RecordBatch:
            if rest or len(partial) > COMBINED:
                found.extend((lang, p, n) for (lang, p), n in partial.items())
                partial.clear()
            columns = list(zip(*found, strict=True)) or [[], [], []]
            found.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.int64())], ["lang", "phrase", "f"])

        def close_part() -> Iterator[pa.RecordBatch]:
            groups: dict[bytes, list[bytes]] = {}
            while held:
                for group in held.pop().split(END):
                    head, _, lines = group.partition(b"\n")
                    groups.setdefault(head, []).append(lines)
            for head, lists in groups.items():
                close(now[0], head, lists)
                if max(len(found), len(partial)) > COMBINED:
                    yield batch()
            yield batch()

        for b in it:
            for lang, part, groups in zip(*(b.column(c).to_pylist() for c in ("lang", "part", "groups")), strict=True):
                if now != (lang, part):
                    yield from close_part()
                    now = lang, part
                held.append(groups)
        yield from close_part()
        yield batch(rest=True)

    routed = suffixes(docs, shared, longest, parts).repartition("lang", "part").sortWithinPartitions("lang", "part")
    made = routed.mapInArrow(counted, "lang string, phrase binary, f long")
    return made.groupBy("lang", F.col("phrase").cast("string").alias("phrase")).agg(F.sum("f").alias("f")).where(F.col("f") >= least)


# --- scores ---------------------------------------------------------------------

def _exact(c: str) -> Column:
    return F.col(c).cast("decimal(38,0)")


def scored(grams: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of all ``grams`` (lang, phrase, f) of two words or more.

    A phrase's score is that of its worst cut, floor(1000 a n / (l r)); of equal ones the first cut counts.
    """
    ws = F.split("phrase", " ")
    cuts = grams.withColumn("ws", ws).where(F.size("ws") > 1).select(
        "lang", "phrase", F.col("f").alias("a"), "ws", F.explode(F.sequence(F.lit(1), F.size("ws") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("ws", 1, F.col("k")), " ").alias("front"),
        F.expr("array_join(slice(ws, k + 1, size(ws)), ' ')").alias("back"))
    of = lambda name, f: grams.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cuts = cuts.join(of("front", "l"), ["lang", "front"]).join(of("back", "r"), ["lang", "back"]).join(totals, "lang")
    product = _exact("l") * _exact("r")
    score = F.lit(1000).cast("decimal(38,0)") * _exact("a") * _exact("n")
    cuts = cuts.withColumn("up", score).withColumn("down", product).withColumn("score", F.expr("up div down"))
    worst = F.min(F.struct("score", "k", "l", "r")).alias("w")
    return cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.first("n").alias("n"), worst).select(
        "lang", "phrase", "a", "w.l", "w.r", "n", "w.score")


def without_parts(candidates: DataFrame, grams: DataFrame, share: int = 100) -> DataFrame:
    """Candidates that lie in no longer phrase with ``share`` percent of their count or more."""
    ws = F.split("phrase", " ")
    longer = grams.withColumn("ws", ws).where(F.size("ws") > 2)
    parts = longer.select("lang", "f", "ws", F.explode(F.expr("sequence(2, size(ws) - 1)")).alias("k")).select(
        "lang", "f", "ws", "k", F.explode(F.expr("sequence(1, size(ws) - k + 1)")).alias("i")).select(
        "lang", F.expr("array_join(slice(ws, i, k), ' ')").alias("phrase"), "f")
    held = parts.groupBy("lang", "phrase").agg(F.max("f").alias("f_longer"))
    return candidates.join(held, ["lang", "phrase"], "left").where(
        F.col("f_longer").isNull() | (F.lit(100) * F.col("f_longer") < F.lit(share) * F.col("a"))).drop("f_longer")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, hot: int = HOT) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    Defined cases: a null language is ``und``, a null text is empty; rows that
    repeat are counted as often; a text without words counts nothing; other
    columns are not read; an empty table gives an empty result.
    """
    prepare_python(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("string"))
    all_words = stage_table(words(texts), "words")
    totals = all_words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = all_words.where(F.col("f") >= least)
    grams = stage_table(
        frequent.select("lang", F.col("word").alias("phrase"), "f").unionByName(phrases(texts, frequent, least, longest, hot)), "grams")
    kept = without_parts(scored(grams, totals), grams)
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '{UNKNOWN}') AS lang,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS ws FROM d),
s AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM p),
g AS (SELECT lang, array_to_string(list_slice(ws, i, i + k - 1), ' ') AS phrase, k
      FROM s JOIN range(1, {LONGEST + 1}) AS q(k) ON i + k - 1 <= len(ws)),
f AS (SELECT lang, phrase, any_value(k) AS k, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= {LEAST}),
t AS (SELECT lang, sum(len(ws)) AS n FROM p GROUP BY lang),
c AS (SELECT lang, phrase, f AS a, k, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
cut AS (SELECT lang, phrase, a, k, ws, unnest(range(1, k)) AS j FROM c),
v AS (SELECT cut.lang, cut.phrase, a, j, x.f AS l, y.f AS r, n,
        (1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS score
      FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(list_slice(ws, 1, j), ' ')
      JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(list_slice(ws, j + 1, cut.k), ' ') JOIN t ON t.lang = cut.lang),
w AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
sub AS (SELECT lang, a, ws, k, unnest(range(2, k)) AS m FROM c),
part AS (SELECT lang, a, array_to_string(list_slice(ws, i, i + m - 1), ' ') AS phrase
         FROM (SELECT lang, a, ws, m, unnest(range(1, k - m + 2)) AS i FROM sub)),
gone AS (SELECT DISTINCT w.lang, w.phrase FROM w JOIN part ON part.lang = w.lang AND part.phrase = w.phrase AND 100 * part.a >= 100 * w.a),
o AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
      FROM w ANTI JOIN gone USING (lang, phrase))
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM o WHERE rank <= {TOP}
"""
