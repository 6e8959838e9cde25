"""Order inside groups without putting a whole group into one task.

``with_rank`` is ``row_number() over (partition by group order by order)``.

``previous_in_group`` is ``lag(order) over (partition by group order by
order)`` for an integral ``order`` key that is unique within its group.  A
plain window would sort an entire group in one task; a group may hold a
third of all rows.  Instead the window runs per (group, bucket), where a
bucket spans ``width`` consecutive key values and so holds at most ``width``
rows, and the first row of each bucket takes the maximum of the nearest
non-empty lower bucket.  That second step works on one row per bucket, a
table ``width`` times smaller than the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changelens.session import stage_table

DEFAULT_WIDTH = 1 << 16


def previous_in_group(df: DataFrame, group: str, order: str, width: int = DEFAULT_WIDTH) -> DataFrame:
    prev = f"prev_{order}"
    b = F.floor(F.col(order) / F.lit(width)).alias("_bucket")
    x = df.select("*", b)
    in_bucket = x.withColumn(
        "_lag", F.lag(order).over(Window.partitionBy(group, "_bucket").orderBy(order)))
    buckets = x.groupBy(group, "_bucket").agg(F.max(order).alias("_bmax"))
    buckets = buckets.withColumn(
        "_prev_bmax", F.lag("_bmax").over(Window.partitionBy(group).orderBy("_bucket"))
    ).select(group, "_bucket", "_prev_bmax")
    out = in_bucket.join(buckets, [group, "_bucket"], "left")
    return out.select(
        *[c for c in df.columns],
        F.coalesce(F.col("_lag"), F.col("_prev_bmax")).alias(prev),
    )


def with_rank(df: DataFrame, group: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    """Add ``name``: the place of each row in its group, from 1 without gaps,
    in the order of ``order`` (which should tell the rows of a group apart).

    Rows are dealt into sorted ranges and numbered inside each; the counts per
    group and range, one row each, give the numbers before them.  So a group
    of any size is spread over as many tasks as it needs.  The sorted rows are
    staged: ranges are cut from a sample, and two evaluations may differ.
    """
    keys = [F.col(c) for c in group] + order
    ranged = stage_table(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), name)
    w = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        ranged.groupBy(*group, "_range").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)) - F.col("_first"))
        .select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], F.col("_range").alias("_r"), "_before")
    )
    on = F.col("_range") == F.col("_r")
    for i, c in enumerate(group):
        on = on & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return ranged.join(before, on).select(*df.columns, (F.col("_at") + F.col("_before") + 1).alias(name))
