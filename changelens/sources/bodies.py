"""Capture bodies from files (SRC-03).

One file per capture; the file name without extension is the version id.
Bytes are decoded by the charset that the capture or the body states
(``functions.charsets``).  The binary-file source lists and reads files in
parallel; only the needed versions are kept when ``versions`` is given (semi
join on the id), and its ``content_type`` column, if any, is the header's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelens.functions import charsets as cs


def read_body_files(spark: SparkSession, path: str, glob: str = "*",
                    versions: DataFrame | None = None) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select(
        F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1).alias("version_id"), "content")
    content_type = None
    if versions is not None:
        header = [c for c in ("content_type",) if c in versions.columns]
        known = versions.select(F.col("version_id").cast("string").alias("version_id"), *header)
        files = files.join(known, "version_id") if header else files.join(known, "version_id", "left_semi")
        content_type = F.col("content_type") if header else None
    content = F.col("content")
    return files.select("version_id", cs.decode(content, cs.charset(content, content_type)).alias("body"))
