"""Sharding along a Hilbert curve over document metadata.

Language, source and size are quantised to 2**BITS levels each, every cell of
that cube gets its index on the Hilbert curve, documents are put in curve order
(ties by text checksum and id) and the order is cut into runs of equal row
counts.  Neighbours on the curve are close in every dimension, so a shard's
level ranges (``shard_ranges``) are narrow and whole files can be skipped for
a predicate on any of the dimensions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changelens.llm.common import let, table, with_rank
from changelens.session import stage_path

SHARDS = 8
BITS = 5
DIMS = ("lang", "source", "size")


def levels(size: Column, bits: int = BITS) -> dict[str, Column]:
    """The quantised dimensions: hash level for names (null is 0), half powers of two for size."""
    top = (1 << bits) - 1
    named = lambda c: F.when(F.col(c).isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(c), F.lit(top)) + 1)
    return {
        "lang": named("lang").cast("int"),
        "source": named("source").cast("int"),
        "size": F.least(F.lit(top), F.floor(F.log2(size) * 2)).cast("int"),
    }


def curve_index(axes: Column, n: int, bits: int) -> Column:
    """Hilbert index of an array of ``n`` axis levels, after Skilling (2004):
    undo the excess work from the top bit down, Gray-encode, then interleave."""
    pairs = lambda low: F.array(*[
        F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, low - 1, -1) for i in range(n)])

    def swap(x: Column, s: Column) -> Column:
        low = s["q"] - 1
        first, own = F.get(x, F.lit(0)), F.get(x, s["i"])
        inverted = own.bitwiseAND(s["q"]) != 0
        swapped = first.bitwiseXOR(own).bitwiseAND(low)
        change = F.when(inverted, low).otherwise(swapped)
        return F.transform(x, lambda v, k: F.when(k == 0, v.bitwiseXOR(change)).when(
            (k == s["i"]) & ~inverted, v.bitwiseXOR(swapped)).otherwise(v))

    def gray(x: Column) -> Column:
        return F.transform(x, lambda _, k: F.aggregate(F.slice(x, 1, k + 1), F.lit(0), lambda a, v: a.bitwiseXOR(v)))

    def flips(x: Column) -> Column:
        last = F.get(x, F.lit(n - 1))
        return F.aggregate(
            F.array(*[F.lit(1 << b) for b in range(bits - 1, 0, -1)]), F.lit(0),
            lambda t, q: F.when(last.bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t))

    def interleave(x: Column) -> Column:
        return F.aggregate(
            pairs(0), F.lit(0).cast("long"),
            lambda t, s: t * 2 + F.when(F.get(x, s["i"]).bitwiseAND(s["q"]) != 0, 1).otherwise(0))

    turned = lambda x: let(flips(x), lambda t: let(F.transform(x, lambda v: v.bitwiseXOR(t)), interleave))
    return let(F.aggregate(pairs(1), axes, swap), lambda x: let(gray(x), turned))


def cells(spark: SparkSession, bits: int = BITS, n: int = len(DIMS)) -> DataFrame:
    """(cell, curve) for all 2**(bits * n) cells of the cube: a table of fixed size."""
    axis = [F.shiftright(F.col("id"), bits * i).bitwiseAND((1 << bits) - 1).cast("int") for i in range(n)]
    return spark.range(1 << (bits * n)).select(F.col("id").alias("cell"), curve_index(F.array(*axis), n, bits).alias("curve"))


def assign(docs: DataFrame, shards: int = SHARDS, bits: int = BITS, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, level_lang, level_source,
    level_size, curve, shard, slot, and the columns named in ``carry``.

    Law: ``rows``.  Shard sizes differ by one at most; slots count from 0.
    Defined cases: a null text has no bytes and the checksum of an empty one;
    null names have level 0; rows that are equal in all of this are told apart
    by no column, and any of them may take either place.  Documents with equal
    text, language and source are neighbours.  An empty table gives an empty
    result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", "lang", "source", *[F.col(c).alias(f"_{c}") for c in carry],
                    (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    q = levels(F.col("size"), bits)
    d = d.select(
        "doc_id", "size", "text_crc32", *[f"_{c}" for c in carry], *[v.alias(f"level_{k}") for k, v in q.items()])
    cell = sum(F.shiftleft(F.col(f"level_{k}").cast("long"), bits * i) for i, k in enumerate(DIMS))
    placed = d.withColumn("cell", cell).join(F.broadcast(cells(docs.sparkSession, bits)), "cell").drop("cell")
    ranked = with_rank(placed, [], [F.col("curve"), F.col("text_crc32"), F.col("size"), F.col("doc_id")])
    n = ranked.select(F.count("*")).scalar()
    # the first rank of shard s is the least r with r * shards >= s * n
    return (
        ranked.withColumn("n", n).withColumn("shard", F.expr(f"cast(rank * {shards} div n as int)"))
        .withColumn("slot", F.expr(f"rank - (shard * n + {shards - 1}) div {shards}")).drop("n", "rank")
        .withColumnsRenamed({f"_{c}": c for c in carry})
    )


def write_shards(docs: DataFrame, path: str | None = None, shards: int = SHARDS, bits: int = BITS) -> tuple[str, DataFrame]:
    """Write whole documents (each as the struct ``row``) as one folder per
    shard, in slot order, and return the path and the level ranges of the
    shards for pruning."""
    whole = docs.select("doc_id", "text", "lang", "source", F.struct("*").alias("row"))
    path = path or stage_path(docs.sparkSession, "shards")
    (assign(whole, shards, bits, ("row",)).repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
    return path, shard_ranges(docs.sparkSession.read.parquet(path))


def shard_ranges(assigned: DataFrame) -> DataFrame:
    """Rows, bytes and the range of every level in each shard."""
    return assigned.groupBy("shard").agg(
        F.count("*").alias("rows"), F.sum("size").alias("bytes"),
        *[f(f"level_{k}").alias(f"{n}_{k}") for k in DIMS for n, f in (("min", F.min), ("max", F.max))])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve", "level_lang", "level_source", "level_size")
