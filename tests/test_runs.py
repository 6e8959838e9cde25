"""Runs found by name, and results as one JSON array (SRC-04)."""

import gzip

import pytest
from pyspark.sql import functions as F

from changelens.sources import results_io as rio

SCHEMA = "page struct<page_id: bigint, tags: array<string>>, overall struct<priority: double>, error string"


def raw(spark, ids):
    return spark.createDataFrame([((i, [f"t{i % 2}", 'a "],[" b']), (i / 10,), None if i % 3 else "x: [y],\n{z}") for i in ids], SCHEMA)


def ids(df):
    return sorted(r.page.page_id for r in df.collect())


def test_runs_by_name(spark, tmp_path):
    root = str(tmp_path / "runs")
    first = rio.write_run(raw(spark, [1, 2]), root, "weekly 1/2")
    rio.write_run(raw(spark, [3]), root, "other")
    second = rio.write_run(raw(spark, [1, 2, 4]), root, "weekly 1/2")
    assert first != second
    assert ids(rio.read_run(spark, root, SCHEMA, "weekly 1/2")) == [1, 2, 4]
    assert ids(rio.read_run(spark, root, SCHEMA, "other")) == [3]
    with pytest.raises(FileNotFoundError):
        rio.find_run(spark, root, "none")


def test_aborted_runs_are_not_read(spark, tmp_path):
    root = str(tmp_path / "runs")
    rio.write_run(raw(spark, [1]), root, "w")
    rio.write_results(raw(spark, [7]), f"{root}/w-0123456789ab")  # stopped before its line in the manifest

    def fail(x):
        raise ValueError("lost")

    broken = raw(spark, [8]).withColumn("error", F.udf(fail, "string")("error"))
    with pytest.raises(Exception, match="lost"):
        rio.write_run(broken, root, "w")
    assert ids(rio.read_run(spark, root, SCHEMA, "w")) == [1]


@pytest.mark.parametrize("n", [0, 1, 500])
def test_array_round_trip(spark, tmp_path, n):
    path = str(tmp_path / "a")
    df = raw(spark, range(n)).repartition(3)
    rio.write_results_array(df, path, ["page"])
    text = "".join(gzip.open(p, "rt").read() for p in sorted((tmp_path / "a").glob("part-*")))
    import json

    assert [x["page"]["page_id"] for x in json.loads(text)] == list(range(n))
    back = rio.read_results(spark, path, df.schema, multiline=True)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_arrays_of_other_layouts(spark, tmp_path):
    for name, text in {"pretty": '[\n  {\n    "page": {"page_id": 1,\n "tags": []}\n  },\n  {"page": {"page_id": 2}}\n]\n', "one": '[{"page": {"page_id": 1}}, {"page": {"page_id": 2}}]',
                       "commas": '[\n{"page": {"page_id": 1}}\n,{"page": {"page_id": 2}}\n]'}.items():
        (tmp_path / f"{name}.json").write_text(text)
        assert ids(rio.read_results(spark, str(tmp_path / f"{name}.json"), SCHEMA, multiline=True)) == [1, 2], name
