"""Small helpers that several operators of this package share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changelens.operators.sequence import with_rank as numbered
from changelens.session import stage_table

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACE = " \t\n\x0b\f\r"
SPACE_RE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z; every other character stays as it is."""
    return F.translate(c, UPPER, UPPER.lower())


def words(c: Column) -> Column:
    """The runs of characters other than ASCII white space; null text has none."""
    trimmed = F.btrim(F.coalesce(c, F.lit("")), F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RE))


def count_words(c: Column) -> Column:
    trimmed = F.btrim(F.coalesce(c, F.lit("")), F.lit(SPACE))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACE_RE))).cast("long")


def unit(*parts: Column) -> Column:
    """A number in [0, 1) that depends on ``parts`` alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) * F.lit(2.0**-53)


def let(c: Column, f) -> Column:
    """``f(c)`` with ``c`` evaluated once, however often ``f`` or a lambda in it refers to it."""
    return F.element_at(F.transform(F.array(c), f), 1)


def free_name(base: str, *frames: DataFrame) -> str:
    """``base``, with underscores behind it until no frame has a column of that name."""
    taken = {c.lower() for df in frames for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def join_on(left: DataFrame, right: DataFrame, cols: dict[str, str] | list[str], how: str = "inner", hint: str = "") -> DataFrame:
    """Join on null-safe equality of ``cols`` (left name: right name); the
    right side's key columns are dropped, so its other names must not clash.

    ``hint="merge"`` is for a right side that grows with the documents: it is
    then shuffled at every size, and never broadcast because it still happens to fit.
    """
    pairs = cols if isinstance(cols, dict) else {c: c for c in cols}
    names = {r: free_name(f"_on_{r}", left, right) for r in pairs.values()}
    right = right.withColumnsRenamed(names)
    right = right.hint(hint) if hint else right
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(names[r])) for k, r in pairs.items()])
    return left.join(right, on, how).drop(*names.values())


def with_rank(df: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """Add ``rank``: the place of each row in its group from 0, without gaps or large windows
    (``sequence.with_rank``); ``df`` should be narrow."""
    return numbered(df, group, order, "rank").withColumn("rank", F.col("rank") - 1)


def _scans_parquet(df: DataFrame) -> bool:
    """Whether ``df`` is a Parquet table, or columns and rows chosen from one."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    return plan.nodeName() == "LogicalRelation" and plan.toString().rstrip().endswith("parquet")


def with_row_number(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``docs`` with a key that no two rows share, and that column's name.

    Rows of a Parquet table are known by file and place in it, which any task
    reads alike, so nothing is copied.  Other frames are staged with a number:
    numbers follow partitions, and two evaluations may differ.
    """
    number = free_name("_row", docs)
    if _scans_parquet(docs):
        at = docs.metadataColumn("_metadata")
        return docs.withColumn(number, F.struct(at["file_path"].alias("file"), at["row_index"].alias("place"))), number
    return stage_table(docs.withColumn(number, F.monotonically_increasing_id()), name), number
