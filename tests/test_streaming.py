"""Daily totals of a capture feed: complete days, late captures, restarts (STR-02)."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from changelens.streaming import captures as stc

SCHEMA = "page_id long, version_id long, capture_time timestamp"


def put(spark, folder, rows):
    """One more file of captures (page_id, day, hour)."""
    df = spark.createDataFrame([(p, i, f"2024-01-{d:02d} {h:02d}:30:00") for i, (p, d, h) in enumerate(rows)], "page_id long, version_id long, t string")
    df.select("page_id", "version_id", F.to_timestamp("t").alias("capture_time")).coalesce(1).write.mode("append").parquet(folder)
    return Counter((p, f"2024-01-{d:02d}") for p, d, _ in rows)


def totals(df):
    return Counter({(r.page_id, str(r.day)): r.captures for r in df.collect()})


def test_all_days_late_captures_and_restart(spark, tmp_path):
    feed, path, state = (str(tmp_path / n) for n in ("feed", "totals", "state"))
    want = put(spark, feed, [(1, 1, 3), (1, 1, 23), (2, 2, 0), (1, 30, 12)])
    run = lambda: totals(stc.run_daily_totals(stc.capture_stream(spark, feed, SCHEMA), path, state))
    assert run() == want  # the newest day, too
    want += put(spark, feed, [(1, 1, 4), (3, 15, 9)])  # long after later days were seen
    assert run() == want
    assert run() == want  # nothing new
    counts = spark.createDataFrame([], "page_id long, day date").schema
    stc.compact_daily_totals(spark, path, counts, 2)
    assert totals(stc.read_daily_totals(spark, path, counts)) == want
    want += put(spark, feed, [(1, 1, 5)])
    assert run() == want


def test_batch_that_failed_after_its_write_is_not_counted_twice(spark, tmp_path, monkeypatch):
    feed, path, state = (str(tmp_path / n) for n in ("feed", "totals", "state"))
    want = put(spark, feed, [(1, 1, 3), (1, 2, 23)])
    from pyspark.sql.streaming import DataStreamWriter

    plain = DataStreamWriter.foreachBatch

    def broken(self, func):
        def wrote_then_died(batch, number):
            func(batch, number)
            raise RuntimeError("lost after the write")
        return plain(self, wrote_then_died)

    monkeypatch.setattr(DataStreamWriter, "foreachBatch", broken)
    stream = stc.capture_stream(spark, feed, SCHEMA)
    with pytest.raises(Exception, match="lost after the write"):
        stc.run_daily_totals(stream, path, state)
    monkeypatch.setattr(DataStreamWriter, "foreachBatch", plain)
    want += put(spark, feed, [(1, 2, 1)])
    assert totals(stc.run_daily_totals(stream, path, state)) == want
