"""Near-duplicates by SimHash, found with Burkhard-Keller trees.

Fingerprints within ``radius`` bits of each other are linked and linked ones
form a component.  The distinct fingerprints are put in shards: 64 bits are cut
in radius + 1 runs, and two fingerprints within the radius agree in one run at
least (pigeonhole), so the value of each run names one shard.  A shard with
more than ``SHARD_ROWS`` fingerprints is cut again by the bits that are still
free, and so on: with b free bits a shard holds 2**b distinct values at most,
so the recursion ends and no shard is larger than the bound.

In each shard a BK-tree (children keyed by their Hamming distance to the
parent) is grown and searched; a search follows only edges whose key is within
the radius of the distance to the node.  A shard returns a spanning forest of
its links, fewer links than fingerprints.  Components come from alternating
large-star and small-star steps on these links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelens.llm.common import join_on, table, with_row_number
from changelens.session import prepare_python, stage_table

SHINGLE = 3
RADIUS = 2
SHARD_ROWS = 4096
BITS = 64


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the ``shingle``-word sequences of a text, as a signed integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), ends[-n:].tolist(), strict=True)), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):  # 64 bytes for each hash at a time
        ones += np.unpackbits(hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, number: str | None = None) -> DataFrame:
    """(doc_id, fp) of every row, and with ``number`` that column of ``docs`` in front."""
    own = [number] if number else []

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            fp = [fingerprint(x.as_py(), shingle) for x in b.column("text")]
            names = [*own, "doc_id"]
            yield pa.RecordBatch.from_arrays([*map(b.column, names), pa.array(fp, pa.int64())], [*names, "fp"])

    prepare_python(docs.sparkSession)
    return docs.select(*own, F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        batches, "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in own) + "doc_id long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def refine(mask: int, radius: int) -> list[int]:
    """The masks that fix one more of the radius + 1 runs of the bits that ``mask`` leaves free.

    None where too few bits are free for so many runs; a shard then has 2**radius values at most.
    """
    free = [b for b in range(BITS) if not (mask & 0xFFFFFFFFFFFFFFFF) >> b & 1]
    if len(free) <= radius:
        return []
    runs = np.array_split(np.array(free), radius + 1)
    return [_signed((mask & 0xFFFFFFFFFFFFFFFF) | sum(1 << int(b) for b in r)) for r in runs]


class BKTree:
    """Children keyed by their Hamming distance to the parent."""

    def __init__(self, root: int) -> None:
        self.root = (root, {})

    def add(self, value: int, radius: int) -> list[int]:
        """Insert a value; the values within ``radius`` that were there before."""
        found, todo = [], [self.root]
        while todo:
            at, children = todo.pop()
            d = (at ^ value).bit_count()
            if d <= radius:
                found.append(at)
            for edge in range(max(0, d - radius), d + radius + 1):
                if edge in children:
                    todo.append(children[edge])
        at, children = self.root
        while (d := (at ^ value).bit_count()) in children:
            at, children = children[d]
        children[d] = (value, {})
        return found


def shard_links(values: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links within one shard: (value, another value of its component)."""
    parent = {values[0]: values[0]}

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    tree = BKTree(values[0])
    for value in values[1:]:
        parent[value] = value
        for other in tree.add(value, radius):
            if (r := top(other)) != (own := top(value)):
                parent[own] = r
                yield value, other


def shards(fps: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> list[DataFrame]:
    """(mask, key, fp, id) by shard, shards with one row left out: a table for each depth that is needed.

    Every table covers the shards small enough at its depth; the rest is cut further.
    """
    out = []
    finer = {m: refine(m, radius) for m in refine(0, radius)}
    todo = fps.withColumn("mask", F.explode(F.array(*[F.lit(m).cast("long") for m in finer])))
    while True:
        keyed = stage_table(todo.withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))), "simhash-shards")
        sizes = keyed.groupBy("mask", "key").agg(F.count("*").alias("n"))
        can_be_cut = F.col("mask").isin([m for m, f in finer.items() if f])
        large = (F.col("n") > shard_rows) & can_be_cut
        out.append(join_on(keyed, sizes.where(~large & (F.col("n") > 1)).drop("n"), ["mask", "key"], "left_semi"))
        large = stage_table(sizes.where(large).drop("n"), "simhash-large")
        if large.isEmpty():
            return out
        rest = join_on(keyed, large, ["mask", "key"], "left_semi")
        cuts = F.create_map(*[x for m, f in finer.items() for x in (
            F.lit(m).cast("long"), F.array(*[F.lit(v) for v in f]).cast("array<long>"))])
        todo = rest.select("fp", "id", F.explode(F.element_at(cuts, F.col("mask"))).alias("mask"))
        finer = {x: refine(x, radius) for f in finer.values() for x in f}


def links(fps: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(a, b): links between the ids of distinct fingerprints ``fp`` that connect every component."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a task's rows come sorted by shard; a shard may go on in the next batch
        last, ids = None, {}
        out = ([], [])

        def close() -> None:
            if len(ids) > 1:
                for x, y in shard_links(list(ids), radius):
                    out[0].append(ids[x])
                    out[1].append(ids[y])

        for b in it:
            cols = [b.column(c).to_pylist() for c in ("mask", "key", "fp", "id")]
            for mask, key, fp, i in zip(*cols, strict=True):
                if (mask, key) != last:
                    close()
                    last, ids = (mask, key), {}
                ids[fp & 0xFFFFFFFFFFFFFFFF] = i
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["a", "b"])
            out = ([], [])
        close()
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["a", "b"])

    found = None
    for part in shards(fps, radius, shard_rows):
        made = part.repartition("mask", "key").sortWithinPartitions("mask", "key").mapInArrow(batches, "a long, b long")
        found = made if found is None else found.unionByName(made)
    return found.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of all ids in ``edges`` (a, b); component is the smallest id reachable.

    Alternating steps after Kiveris et al. (2014).  Large star: every
    neighbour above u is linked to the smallest of u and its neighbours.  Small
    star: u and its neighbours below are linked to the smallest of these.
    Minima are partial aggregates and the joins can be split, so a hub with
    many links is not gathered.  Each round is staged; rounds grow with the
    logarithm of the longest path.
    """
    e = stage_table(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = None
    while True:
        both = e.select("a", "b").unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = stage_table(
            join_on(both.where("b > a"), low, ["a"]).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        e = join_on(large, low, ["a"]).select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        e = stage_table(e.select("e.a", "e.b").where("a <> b").distinct(), "small-star")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            return e.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(
                e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
        mark = now


def with_component(distinct: DataFrame, radius: int, shard_rows: int) -> DataFrame:
    """Distinct fingerprints ``fp`` with their ``component``, named by one of its fingerprints."""
    # ids of fingerprints are the fingerprints themselves: unique even where doc_ids repeat or are null
    comps = components(links(distinct.select("fp", F.col("fp").alias("id")), radius, shard_rows))
    return join_on(distinct, comps, {"fp": "id"}, "left").withColumn("component", F.coalesce("component", "fp"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per document: doc_id, fp, component_id.

    Defined cases: a null text counts as empty, and a text without words has
    fingerprint zero, linked like any other; a text with fewer words than a
    shingle is one shingle.  Rows that repeat a doc_id are documents of their
    own that share the id.  A null doc_id takes part under no id: its component
    is the smallest id of the others, or null where all are null.  Other
    columns are not read; an empty table gives an empty result.
    """
    fps = stage_table(fingerprints(docs, shingle), "simhash")
    distinct = stage_table(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    named = with_component(distinct, radius, shard_rows)
    lows = named.groupBy("component").agg(F.min("low").alias("component_id"))
    label = join_on(named.select("fp", "component"), lows, ["component"]).select("fp", "component_id")
    return join_on(fps, label, ["fp"]).select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each component, with all its columns.

    The smallest doc_id stays (null last), and of rows that repeat it the first.
    """
    rows, number = with_row_number(docs, "simhash-rows")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col(number).alias("number"))
    distinct = stage_table(fingerprints(rows, number=number).groupBy("fp").agg(F.min(first).alias("first")), "simhash-distinct")
    firsts = with_component(distinct, RADIUS, SHARD_ROWS).groupBy("component").agg(F.min("first").alias("first"))
    kept = stage_table(firsts.select(F.col("first.number").alias(number)), "simhash-keep")
    return join_on(rows, kept, [number], "left_semi", "merge").drop(number)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
