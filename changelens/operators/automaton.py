"""Terms in word streams by a multi-pattern automaton (TRM-04).

The dictionary becomes a trie of words with failure links (Aho and Corasick
1975): one state for each prefix of a term, one step for each word of a
stream, whatever the number and length of terms.  The automaton is broadcast,
which is bounded by ``MAX_TERMS`` and ``MAX_BYTES``.  A word that no term has ends
every match, so lines give only the words that some term has, with their places;
those are sorted by Spark and each stream of them is passed over once.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelens.operators import diffs as dif
from changelens.session import prepare_python

#: What a broadcast dictionary may have: terms, and bytes of them.
MAX_TERMS = 1_000_000
MAX_BYTES = 64 << 20
# Words per output batch of a task.
ROWS_PER_BATCH = 100_000


class Automaton:
    """States are numbers; 0 is the root."""

    def __init__(self, terms: list[str]) -> None:
        self.step: list[dict[str, int]] = [{}]
        self.fail, self.size, self.found = [0], [0], [0]  # found: the longest suffix that is a term, as a state
        depth = [0]
        for term in terms:
            at = 0
            for word in term.split(" "):
                if word not in self.step[at]:
                    self.step[at][word] = len(self.step)
                    self.step.append({})
                    self.fail.append(0)
                    self.size.append(0)
                    self.found.append(0)
                    depth.append(depth[at] + 1)
                at = self.step[at][word]
            self.size[at] = depth[at]
        todo = deque(self.step[0].values())
        while todo:
            at = todo.popleft()
            for word, to in self.step[at].items():
                back = self.fail[at]
                while back and word not in self.step[back]:
                    back = self.fail[back]
                self.fail[to] = self.step[back].get(word, 0)
                todo.append(to)
            # the terms that end here: own size, then those of the shorter suffixes
            back = self.fail[at]
            self.found[at] = back if self.size[back] else self.found[back]

    def next(self, at: int, word: str) -> int:
        while at and word not in self.step[at]:
            at = self.fail[at]
        return self.step[at].get(word, 0)

    def sizes(self, at: int) -> Iterator[int]:
        """Words of the terms that end in a state."""
        if self.size[at]:
            yield self.size[at]
        while at := self.found[at]:
            yield self.size[at]


def collected(dictionary: DataFrame, stop_words: DataFrame) -> tuple[list[str], set[str]] | None:
    """Both word lists on the driver, or None where they are beyond the bounds."""
    lists = []
    for df in (dictionary.select("term"), stop_words.select("word")):
        n, size = df.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(df.columns[0])), F.lit(0))).first()
        if n > MAX_TERMS or size > MAX_BYTES:
            return None
        lists.append([r[0] for r in df.collect() if r[0] is not None])
    return lists[0], set(lists[1])


def words_of(terms: list[str], stops: set[str]) -> set[str]:
    """The words that matches can have."""
    return {w for t in terms for w in t.split(" ")} - stops


def dictionary_words(lines: DataFrame, shared) -> DataFrame:
    """(pair_id, side, pos, wpos, word, changed, line, end, repeated): the words of
    ``lines`` (labelled units with ``line`` and ``repeated``) that some term has,
    all words of repeated lines.  No other word can be in a term, so no other is
    compared, shuffled or sorted; ``end`` is a line's last word."""
    keys = ["pair_id", "side", "pos", "line", "repeated"]
    rows = lines.select(*keys, (F.col("op") != 0).alias("changed"), "unit")
    added = [T.StructField("wpos", T.IntegerType()), T.StructField("word", T.StringType()), T.StructField("end", T.BooleanType())]
    schema = T.StructType([*(rows.schema[c] for c in (*keys, "changed")), *added])

    def kept(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, known = shared.value
        for b in it:
            of, wpos, word, end = [], [], [], []

            def out(b=b):
                at = pa.array(of, pa.int32())
                return pa.RecordBatch.from_arrays(
                    [b.column(i).take(at) for i in range(6)] + [pa.array(wpos, pa.int32()), pa.array(word, pa.string()), pa.array(end, pa.bool_())], schema.fieldNames())

            for i, (repeated, unit) in enumerate(zip(b.column(4).to_pylist(), b.column(6).to_pylist(), strict=True)):
                if unit is None:
                    continue
                parts = unit.split(" ")
                if not repeated and known.isdisjoint(parts):
                    continue
                for k, w in enumerate(parts):
                    if repeated or w in known:
                        of.append(i)
                        wpos.append(k)
                        word.append(w)
                        end.append(k == len(parts) - 1)
                if len(of) > ROWS_PER_BATCH:
                    yield out()
                    of, wpos, word, end = [], [], [], []
            yield out()

    prepare_python(lines.sparkSession)
    return rows.mapInArrow(kept, schema)


def compared(words: DataFrame) -> DataFrame:
    """The second comparison (TRM-01), of the words of changed lines: ``changed`` are those without a partner."""
    again = dif.label_units(words.where("changed").withColumn("pos", F.struct("pos", "wpos")).withColumnRenamed("word", "unit"))
    again = again.withColumn("pos", F.col("pos.pos")).withColumn("changed", F.col("op") != 0).withColumnRenamed("unit", "word")
    return words.where("NOT changed").unionByName(again.drop("op"))


def term_hits(lines: DataFrame, terms: list[str], stops: set[str]) -> DataFrame:
    """(pair_id, side, pos, wpos, n, term) of all terms with a changed word in the word streams of ``lines``
    (labelled units with ``line`` and ``repeated``); ``pos`` and ``wpos`` are of the first word.  No term goes
    across a stop word, and none across a word that no term has."""
    known = words_of(terms, stops)
    shared = lines.sparkSession.sparkContext.broadcast((Automaton(terms), known))
    words = compared(dictionary_words(lines, shared))
    kinds = {c: words.schema[c] for c in ("pair_id", "side", "pos", "wpos")}
    schema = T.StructType([*kinds.values(), T.StructField("n", T.IntegerType()), T.StructField("term", T.StringType())])

    def hits(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, known = shared.value
        stream, at, last, seen = None, 0, -1, []  # last: place of the newest changed word; seen: the words in the state
        before = (0, 0, False)
        for b in it:
            out = []
            for pair, side, pos, wpos, word, changed, line, end, repeated in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (pair, side) != stream:
                    stream, at, last, seen = (pair, side), 0, -1, []
                elif not repeated and (line, wpos) != (before[0], before[1] + 1) and not (before[2] and (line, wpos) == (before[0] + 1, 0)):
                    at, last, seen = 0, -1, []  # another word, of no term, is in between
                before = (line, wpos, end)
                at = machine.next(at, word) if word in known else 0
                if not at:
                    last, seen = -1, []
                    continue
                seen.append((pos, wpos, word))
                if changed:
                    last = len(seen) - 1
                for n in machine.sizes(at):
                    start = len(seen) - n
                    if last >= start:
                        out.append((pair, side, *seen[start][:2], n, " ".join(w for _, _, w in seen[start:])))
            columns = list(zip(*out, strict=True)) or [[]] * 6
            names = schema.fieldNames()
            types = [b.schema.field(c).type for c in names[:4]] + [pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    rows = words.select("pair_id", "side", "pos", "wpos", "word", "changed", "line", "end", "repeated")
    return rows.repartition("pair_id", "side").sortWithinPartitions("pair_id", "side", "pos", "wpos").mapInArrow(hits, schema)
