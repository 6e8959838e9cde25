"""Structured Streaming over a capture feed (STR-01, STR-02).

The reference re-runs a batch job on a rolling timeframe; these are the
streaming forms of its two per-capture rules:

* ``dedup_captures``: drop repeats of the same page and body within the
  lateness bound (``dropDuplicatesWithinWatermark``);
* ``daily_changes``: captures per page per day (the change-rate input),
  tumbling one-day windows in append mode;
* ``run_daily_totals``: the same for every day at once, the newest included,
  and open to captures of any lateness: a keyed table that batches add to.

State is bounded by the watermark; checkpoints go to the shared checkpoint
folder, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def capture_stream(spark, path: str, schema, glob: str = "*.parquet") -> DataFrame:
    """A file stream of captures (parquet), with ``capture_time`` as TIMESTAMP."""
    s = spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(path)
    return s


def dedup_captures(captures: DataFrame, lateness: str = "40 days",
                   keys: tuple[str, ...] = ("page_id", "body_hash")) -> DataFrame:
    """STR-01."""
    return (captures.withColumn("capture_time", F.col("capture_time").cast("timestamp"))
            .withWatermark("capture_time", lateness)
            .dropDuplicatesWithinWatermark(list(keys)))


def daily_changes(captures: DataFrame, lateness: str = "1 day", key: str = "page_id") -> DataFrame:
    """STR-02."""
    c = captures.withColumn("capture_time", F.col("capture_time").cast("timestamp")).withWatermark("capture_time", lateness)
    return (c.groupBy(key, F.window("capture_time", "1 day").alias("day"))
            .agg(F.count("*").alias("captures"))
            .select(key, F.col("day.start").alias("day"), "captures"))


def run_available_now(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a streaming query over all available input (available-now trigger)
    into Parquet files at ``path``, in append mode, and read them back."""
    q = (df.writeStream.format("parquet").outputMode("append").option("path", path)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_daily_totals(captures: DataFrame, path: str, checkpoint: str, key: str = "page_id") -> DataFrame:
    """STR-02, complete: run over all available input, adding every batch's
    counts to the table at ``path``, and return ``read_daily_totals``.

    A batch combines its captures by (key, day) and writes them as its own
    folder, named by the batch's number and replaced as a whole: a batch that
    is run again after a failure doesn't count twice.  So a day needs no
    watermark to close it and no state is kept; a late capture adds to its day."""
    counts = captures.select(key, F.to_date(F.col("capture_time").cast("timestamp")).alias("day"))

    def add(batch: DataFrame, number: int) -> None:
        batch.groupBy(key, "day").agg(F.count("*").alias("captures")).write.mode("overwrite").parquet(f"{path}/batch={number}")

    q = counts.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return read_daily_totals(captures.sparkSession, path, counts.schema)


def read_daily_totals(spark, path: str, schema) -> DataFrame:
    """(key, day, captures) of the table at ``path``: the batches' counts, added up."""
    key, day = schema.fieldNames()
    parts = spark.read.schema(f"`{key}` {schema[key].dataType.simpleString()}, day date, captures long, batch long").parquet(path)
    return parts.groupBy(key, day).agg(F.sum("captures").alias("captures"))


def compact_daily_totals(spark, path: str, schema, before: int) -> None:
    """Put all batches under number ``before`` into one folder, ``batch=-<before>``.

    The new folder holds their sum and its name says which it covers; the
    folders it covers are deleted after it is written.  Run it while no reader
    is and no batch under ``before`` can come again."""
    from changelens.session import delete_paths

    key, day = schema.fieldNames()
    parts = spark.read.schema(f"`{key}` {schema[key].dataType.simpleString()}, day date, captures long, batch long").parquet(path)
    old = parts.where(F.col("batch") < before)
    numbers = [r.batch for r in old.select("batch").distinct().collect()]
    if len(numbers) > 1:
        old.groupBy(key, day).agg(F.sum("captures").alias("captures")).write.mode("overwrite").parquet(f"{path}/batch=-{before}")
        delete_paths(spark, [f"{path}/batch={n}" for n in numbers if n != -before])
