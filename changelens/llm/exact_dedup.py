"""Exact deduplication over an extendible-hash index on shared files.

Every document gets a 64-bit hash of its normalised text.  A directory of
2**depth entries (the hash's leading bits) points to buckets; the directory is
doubled until no bucket holds more than ``bucket_rows`` keys, and entries that
did not need the last doublings share a bucket (its local depth is smaller).
The index itself is a folder of Parquet files, one sub-folder per bucket,
written by owner tasks that each hold a contiguous range of entries.  A bucket
has one row for each distinct text; texts that collide on their hash are
chained in it (``chain`` 0, 1, ...).

Texts are compared by their bytes: the index rows come from an aggregation
keyed by (hash, normalised text).  It combines copies before the shuffle, so a
text with any number of copies sends one row from each task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changelens.llm.common import ascii_lower, free_name, join_on, table, with_row_number
from changelens.session import stage_path, stage_table

#: Keys (distinct hashes) that a bucket may hold before it is split.
BUCKET_ROWS = 1 << 16
MAX_DEPTH = 30


def normalised(text: Column) -> Column:
    return ascii_lower(F.coalesce(text, F.lit("")))


def entry(h: Column, depth: int) -> Column:
    """The directory entry of a hash: its leading ``depth`` bits."""
    return F.shiftrightunsigned(h, 64 - depth).cast("long") if depth else F.lit(0).cast("long")


def directory(keys: DataFrame, bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, int]:
    """(entry, bucket, local_depth) for a table of hashes ``h``, and the global depth.

    Rows are bounded by 2**depth, about twice the number of buckets.  Every
    doubling halves what an entry covers; it stops when all fit.
    """
    distinct = keys.select("h").distinct()
    n = distinct.count()
    depth = max(0, (n // bucket_rows).bit_length() - 1)
    while True:
        loads = stage_table(distinct.groupBy(entry(F.col("h"), depth).alias("entry")).agg(F.count("*").alias("n")), "directory")
        if depth >= MAX_DEPTH or loads.where(F.col("n") > bucket_rows).isEmpty():
            break
        depth += 1
    local = F.lit(depth)
    d = loads
    for up in range(1, depth + 1):
        w = Window.partitionBy(F.shiftright("entry", up))
        d = d.withColumn(f"_n{up}", F.sum("n").over(w))
        local = F.when(F.col(f"_n{up}") <= bucket_rows, F.lit(depth - up)).otherwise(local)
    d = d.withColumn("local_depth", local)
    bucket = F.expr(f"shiftright(entry, {depth} - local_depth)")
    return d.select(
        "entry", F.concat(F.col("local_depth").cast("string"), F.lit("-"), bucket.cast("string")).alias("bucket"),
        "local_depth"), depth


def build_index(docs: DataFrame, bucket_rows: int = BUCKET_ROWS, number: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(keys, index).  ``keys``: doc_id, h, text_sha256 of every row, and with
    ``number`` that column of ``docs``.  ``index``: the bucket files read back:
    h, chain, text_sha256, keep_id, group_size, bucket."""
    spark = docs.sparkSession
    own = [number] if number else []
    norm = docs.select(*own, F.col("doc_id").cast("long"), normalised(F.col("text")).alias("norm")).withColumn("h", F.xxhash64("norm"))
    keys = stage_table(norm.select(*own, "doc_id", "h", F.sha2("norm", 256).alias("text_sha256")), "dedup-keys")
    entries, depth = directory(keys, bucket_rows)
    groups = (
        norm.groupBy("h", "norm").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("h", F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size")
    )
    chained = groups.withColumn(
        "chain", F.row_number().over(Window.partitionBy("h").orderBy("text_sha256")) - 1)
    path = stage_path(spark, "dedup-index")
    (
        chained.withColumn("entry", entry(F.col("h"), depth)).join(entries, "entry")
        .repartitionByRange("entry", "h").sortWithinPartitions("bucket", "h", "chain")
        .drop("entry", "local_depth").write.partitionBy("bucket").parquet(path)
    )
    schema = "h long, text_sha256 string, keep_id long, group_size long, chain int, bucket string"
    return keys, spark.read.schema(schema).parquet(path)


def exact_dedup(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, bucket, chain.

    Defined cases: a null text counts as empty, and all empty texts are one
    group.  Of equal texts the largest doc_id stays; a null doc_id stays only
    where the whole group has none.  Rows that repeat the staying doc_id and
    its text are that document again and all stay.  Other columns of the input
    are not read; an empty table gives an empty result.
    """
    keys, index = build_index(docs, bucket_rows)
    return keys.join(index, ["h", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256", "bucket", "chain")


def drop_copies(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    keys, index = build_index(docs, bucket_rows)
    gone = stage_table(
        keys.join(index, ["h", "text_sha256"]).where(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .select("doc_id", "h").distinct(), "dedup-gone")
    h = free_name("_h", docs)
    named = docs.withColumn(h, F.xxhash64(normalised(F.col("text"))))
    return join_on(named, gone, {"doc_id": "doc_id", h: "h"}, "left_anti", "merge").drop(h)


def one_of_each(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row of each group of equal texts, with all its columns.

    The largest doc_id stays (null last), and of rows that repeat it the first.
    """
    rows, number = with_row_number(docs, "dedup-rows")
    keys, index = build_index(rows, bucket_rows, number)
    # one row per text and id before the join, so that repeats are never gathered
    firsts = keys.groupBy("h", "text_sha256", "doc_id").agg(F.min(number).alias(number))
    kept = stage_table(
        firsts.join(index, ["h", "text_sha256"]).where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(number), "dedup-kept")
    return join_on(rows, kept, [number], "left_semi", "merge").drop(number)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).drop("bucket", "chain")


SQL = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
           FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
"""
