"""Skew-safe previous-in-group equals lag over the whole group."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from changelens.operators.sequence import previous_in_group


def test_previous_in_group_matches_lag(spark):
    rows = [(k % 3 if k % 5 else 0, k * 7 % 1000) for k in range(400)]
    df = spark.createDataFrame(rows, "grp int, doc_id long").dropDuplicates(["grp", "doc_id"])
    got = {(r.grp, r.doc_id): r.prev_doc_id for r in previous_in_group(df, "grp", "doc_id", width=16).collect()}
    want = {(r.grp, r.doc_id): r.p for r in df.select(
        "grp", "doc_id", F.lag("doc_id").over(Window.partitionBy("grp").orderBy("doc_id")).alias("p")).collect()}
    assert got == want
