"""Re-sheet a previous run (the reference's "sheets from JSON" job, §3.2):
read raw results -> tag and threshold filter -> rank -> one CSV per sheet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelens.operators import sheets as sh
from changelens.sources import results_io as rio


def from_raw(raw: DataFrame, key: str = "page_id") -> DataFrame:
    """Raw result rows back to the flat form the sheet operators take."""
    return raw.select(
        F.col(f"page.{key}").alias(key), "page.url", "page.title", "page.tags", "page.maintainers",
        F.try_element_at("timeframe", F.lit(-1)).alias("a"), F.try_element_at("timeframe", F.lit(1)).alias("b"),
        F.col("overall").alias("analysis"), "changes", "error")


def resheet(spark: SparkSession, input_path: str, schema, out_dir: str,
            tags: list[str] | None = None, threshold: float = 0.0, deep: bool = False) -> DataFrame:
    raw = rio.refilter(rio.read_results(spark, input_path, schema), tags, threshold)
    rows = (sh.deep_sheet_rows if deep else sh.sheet_rows)(sh.order_sheets(from_raw(raw), deep=deep))
    rio.write_sheets(rows, out_dir)
    return rows
