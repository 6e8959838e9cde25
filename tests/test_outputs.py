"""End-to-end smoke: weekly analysis on sf0.001 and every output written."""

import glob
import os

from conftest import SF


def test_weekly_outputs(spark, tmp_path):
    from changelens.operators import sheets as sh
    from changelens.plans import registry as rg
    from changelens.plans.weekly import write_outputs
    from changelens.sources import tables as tb

    res = rg._results(spark, SF)
    prios = [r.p for r in res.selectExpr("analysis.priority AS p").collect() if r.p is not None]
    assert prios and all(0.0 <= p <= 1.0 for p in prios)
    out = str(tmp_path / "out")
    write_outputs(res, tb.page_meta(spark, SF), out, threshold=0.25)
    assert glob.glob(f"{out}/_results.json.gz/*.json.gz")
    assert glob.glob(f"{out}/sheets/sheet=*/*.csv")
    whole = spark.read.option("header", True).csv(f"{out}/sheets")
    assert set(sh.SHEET_COLUMNS) <= set(whole.columns)
    for d in ("_redirects-changed", "_redirects-current"):
        assert os.path.isdir(f"{out}/{d}")


def test_resheet_from_raw(spark, tmp_path):
    from changelens.plans import registry as rg
    from changelens.plans.resheet import resheet
    from changelens.sources import results_io as rio
    from changelens.sources import tables as tb

    from changelens.operators import sheets as sh
    raw = rio.raw_results(sh.drop_no_change(rg._results(spark, SF)),
                          tb.page_meta(spark, SF).select("page_id", "url", "title", "tags", "maintainers"))
    src = str(tmp_path / "raw")
    rio.write_results(raw, src)
    rows = resheet(spark, src, raw.schema, str(tmp_path / "sheets"), ["news"], 0.0)
    n_news = raw.where("array_contains(page.tags, 'news')").count()
    assert rows.count() == n_news
    assert glob.glob(f"{tmp_path}/sheets/sheet=*/*.csv") or n_news == 0


def test_deep_rows_and_raw_changes(spark, tmp_path):
    """SHT-02 and VER-08/09 on the weekly deep job: what the parts must satisfy."""
    from changelens.operators import sheets as sh
    from changelens.plans import registry as rg
    from changelens.session import stage_table
    from changelens.sources import results_io as rio
    from changelens.sources import tables as tb

    res = stage_table(rg._deep_results(spark, SF), "deep-test")
    parts = 0
    for r in res.collect():
        if r.analysis is None or r.analysis.priority < rg.DEEP_THRESHOLD:
            assert r.changes == []
            continue
        times = [(c.a.capture_time, c.b.capture_time) for c in r.changes]
        assert all(a < b for a, b in times) and times == sorted(times)
        assert all(r.a.capture_time <= a and b <= r.b.capture_time for a, b in times)
        assert all(c.analysis.priority >= rg.DEEP_THRESHOLD for c in r.changes)
        parts += len(r.changes)
    assert parts
    meta = tb.page_meta(spark, SF).select("page_id", "url", "title", "tags", "maintainers")
    raw = rio.raw_results(res, meta)
    rio.write_results(raw, str(tmp_path / "raw"))
    back = rio.read_results(spark, str(tmp_path / "raw"), raw.schema)
    assert back.selectExpr("sum(size(changes)) AS n").first().n == parts
    rows = sh.deep_sheet_rows(sh.order_sheets(res.join(meta, "page_id", "left"), deep=True)).collect()
    overall = [r for r in rows if r.Version == "OVERALL"]
    assert len(overall) == res.count() and len(rows) == len(overall) + parts
    assert all(("-" in r.Index) == (r.Version != "OVERALL") for r in rows)


def test_missing_bodies_fail(spark):
    """PRI-02/03: a pair without one of its bodies is a failed row, and the failures view shows it."""
    from changelens.operators import sheets as sh
    from changelens.plans import registry as rg
    from changelens.plans.weekly import change_results
    from changelens.sources import tables as tb

    a, b = rg.FRAMES[0]
    bodies = tb.version_bodies(spark, SF).where("version_id % 5 > 0")
    r = change_results(tb.versions(spark, SF), tb.page_meta(spark, SF), tb.table(spark, SF, "documents"), bodies, a, b,
                       html_ref="version_id", html_key="version_id").collect()
    gone = {x.page_id for x in r if x.error_kind in (None, "failed") and (x.a.version_id % 5 == 0 or x.b.version_id % 5 == 0)}
    assert gone and {x.page_id for x in r if x.error_kind == "failed"} == gone
    assert all(x.analysis is None for x in r if x.page_id in gone)


def test_status_sheet_file(spark, tmp_path):
    from changelens.plans import status
    from changelens.sources import tables as tb

    rows = status.status_sheet(tb.versions(spark, SF), tb.page_meta(spark, SF), tb.version_bodies(spark, SF), "2024-01-31",
                               url_pattern="*/p/*", tags=["category:BUILDING"])
    status.write_status_sheet(rows, str(tmp_path / "s"))
    back = spark.read.option("header", True).csv(str(tmp_path / "s")).collect()
    assert back and back[0].asDict().keys() == set(status.HEADERS)
    assert all("/p/" in r.URL and r["Scanner URL"].startswith("https://") for r in back)
