"""Result sinks and reloads (SNK-01..05, SRC-03..05).

Results are written by Spark writers only: partitioned CSV per sheet,
gzip JSON lines for the raw results, parquet where a later job reads them.
Nothing passes through the driver.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelens.functions import urls as U
from changelens.operators.sequence import with_rank


def raw_results(results: DataFrame, pages: DataFrame, key: str = "page_id") -> DataFrame:
    """SNK-01 rows: page fields (no bodies), timeframe ends, analysis,
    changes of a deep run (``a``, ``b``, ``analysis``; else none), error as
    'Kind: message'; ordered by the page's URL key."""
    r = results.join(pages, key, "left")
    if "changes" not in r.columns:
        part = F.struct("a", "b", "analysis")
        r = r.withColumn("changes", F.filter(F.array(part), lambda _: F.lit(False)))
    return r.select(
        F.struct(key, "url", U.canonical_key(F.col("url")).alias("url_key"), "title", "tags", "maintainers").alias("page"),
        F.array(F.col("b"), F.col("a")).alias("timeframe"),
        F.col("analysis").alias("overall"),
        "changes",
        F.when(F.col("error_kind").isNotNull(), F.concat(F.col("error_kind"), F.lit(": "), F.col("error"))).alias("error"),
    ).orderBy(F.col("page.url_key"))


def write_results(raw: DataFrame, path: str) -> None:
    """SNK-01: gzip JSON lines, one result per line."""
    raw.write.mode("overwrite").option("compression", "gzip").json(path)


def read_results(spark: SparkSession, path: str, schema, multiline: bool = False) -> DataFrame:
    """SRC-04: reload a previous run (JSON lines, or a JSON array with
    ``multiline=True``; gzip by file extension).

    An array with one result a line is read line by line, by as many tasks as
    its files have splits.  Any other layout takes a task for each file."""
    if not multiline:
        return spark.read.schema(schema).json(path)
    lines = spark.read.text(path).select(F.regexp_replace(F.trim("value"), r"^\[\s*|\s*,$|\s*\]$|^,\s*", "").alias("value"))
    lines = lines.where(F.col("value") != "")
    as_array = F.from_json(F.concat(F.lit("["), "value", F.lit("]")), "array<struct<>>")
    whole = (F.size(as_array) == 1) & F.col("value").startswith("{") & F.col("value").endswith("}")
    if not lines.where(~F.coalesce(whole, F.lit(False))).isEmpty():
        return spark.read.schema(schema).option("multiLine", True).json(path)
    return lines.select(F.from_json("value", schema).alias("r")).select("r.*")


def write_results_array(raw: DataFrame, path: str, order: list[str]) -> None:
    """The raw results as one JSON array with a result a line; its part files concatenate in order."""
    n = raw.count()
    rows = with_rank(raw.select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.to_json(F.struct("*")).alias("value")),
                     [], [F.col(f"_o{i}") for i in range(len(order))] + [F.col("value")], "_n")
    line = F.concat(F.when(F.col("_n") == 1, F.lit("[")).otherwise(F.lit("")), "value", F.when(F.col("_n") == n, F.lit("]")).otherwise(F.lit(",")))
    (rows if n else raw.sparkSession.range(1).select(F.lit("[]").alias("value"), F.lit(1).alias("_n"))).select(
        "_n", (line if n else F.col("value")).alias("value")).repartitionByRange("_n").sortWithinPartitions("_n").select("value").write.mode(
        "overwrite").option("compression", "gzip").text(path)


# ------------------------------------------------------------------ runs
RUNS = "_runs"
RUN_SCHEMA = "name string, folder string, results long, finished timestamp"


def write_run(raw: DataFrame, root: str, name: str) -> str:
    """SNK-01 as a run that can be found by its name: the results go to a folder
    of their own, and a line in the manifest ``root/_runs``, committed last,
    makes them a run.  Returns the folder; what has no line is never read."""
    spark = raw.sparkSession
    folder = f"{re.sub('[^A-Za-z0-9_.-]', '_', name)}-{uuid.uuid4().hex[:12]}"
    write_results(raw, f"{root}/{folder}")
    spark.read.schema("error string").json(f"{root}/{folder}").agg(F.count("*").alias("results")).select(
        F.lit(name).alias("name"), F.lit(folder).alias("folder"), "results", F.current_timestamp().alias("finished")
    ).write.mode("append").json(f"{root}/{RUNS}")
    return f"{root}/{folder}"


def find_run(spark: SparkSession, root: str, name: str | None = None) -> str:
    """The folder of the newest run of that name (of any, without one)."""
    runs = spark.read.schema(RUN_SCHEMA).json(f"{root}/{RUNS}")
    runs = runs.where(F.col("name") == name) if name is not None else runs
    newest = runs.orderBy(F.col("finished").desc(), F.col("folder")).select("folder").first()
    if newest is None:
        raise FileNotFoundError(f"no run {name or ''} in {root}")
    return f"{root}/{newest.folder}"


def read_run(spark: SparkSession, root: str, schema, name: str | None = None) -> DataFrame:
    """SRC-04 by name: the results of ``find_run``."""
    return read_results(spark, find_run(spark, root, name), schema)


def refilter(raw: DataFrame, tags: list[str] | None, threshold: float) -> DataFrame:
    """SRC-05: any-of exact tag names, then errors or priority >= threshold."""
    r = raw
    if tags:
        r = r.where(F.arrays_overlap(F.col("page.tags"), F.array(*[F.lit(t) for t in tags])))
    return r.where(F.col("overall").isNull() | (F.col("overall.priority") >= F.lit(threshold)))


def sheet_file_name(sheet):
    """Sheet name with ':' and '/' replaced by '_'."""
    return F.regexp_replace(sheet, "[:/]", "_")


def write_sheets(rows: DataFrame, path: str) -> None:
    """SNK-02: one CSV folder per sheet (``sheet=<name>``); its part files in
    name order hold the rows in Index order.  A large sheet is several files."""
    order = ["sheet", "_order"] + (["_change"] if "_change" in rows.columns else [])
    (rows.withColumn("sheet", sheet_file_name(F.col("sheet")))
     .repartitionByRange(*order).sortWithinPartitions(*order).drop(*order[1:])
     .write.mode("overwrite").partitionBy("sheet").option("header", True).csv(path))


def write_csv(rows: DataFrame, path: str, order: list[str] | None = None) -> None:
    """SNK-03/04/05: a summary sheet as CSV (range-partitioned by the order
    columns, so part files concatenate in order; helper columns starting
    with '_' are not written)."""
    r = rows.repartitionByRange(*order).sortWithinPartitions(*order) if order else rows
    r = r.drop(*[c for c in r.columns if c.startswith("_")])
    r.write.mode("overwrite").option("header", True).csv(path)
