"""Deep search reads captures and bodies once, whatever its depth."""

import pytest
from conftest import SF
from pyspark.sql import functions as F

from changelens.plans.weekly import change_results
from changelens.session import _SCOPE, stage_scope, stage_table
from changelens.sources import tables as tb


def counted(df, reads):
    """``df``, adding to ``reads`` for every row that is read from it."""
    def rows(it):
        for b in it:
            reads.add(b.num_rows)
            yield b

    return df.mapInArrow(rows, df.schema)


def test_deep_rounds_share_one_store(spark):
    a, b = tb.FRAMES[0]
    v = tb.versions(spark, SF).where("page_id IN (1, 7)")
    reads = spark.sparkContext.accumulator(0)
    bodies = stage_table(tb.version_bodies(spark, SF).join(v.select("version_id"), "version_id", "left_semi"), "test-bodies")
    n = bodies.count()
    captures = spark.sparkContext.accumulator(0)
    got = change_results(
        counted(stage_table(v, "test-captures"), captures), tb.page_meta(spark, SF), tb.table(spark, SF, "documents"), counted(bodies, reads), a, b,
        deep=True, threshold=0.2, html_ref="version_id", html_key="version_id").select(
        "page_id", F.transform("changes", lambda c: F.struct(c["a"]["version_id"].alias("a"), c["b"]["version_id"].alias("b"))).alias("c")).collect()
    depth = max(len(r.c) for r in got)
    assert depth > 2  # several rounds
    # once for the results, once for the store
    assert 0 < reads.value <= 2 * n
    total = v.count()
    assert captures.value <= 6 * total  # the selection's passes and its end records, and one for the store


def test_store_units_are_those_of_the_ends(spark):
    """A document's units are made once; ends of every kind find what parsing their own body gives."""
    from changelens.operators import analysis as an
    from changelens.operators import store as st

    link = '<p>one</p><a href="/x">X</a><div class="news content">n</div>'
    bodies = spark.createDataFrame([(1, link), (2, link), (3, None), (4, "<p>two</p>"), (5, "")], "html_id long, html string")
    caps = spark.createDataFrame(
        [(10, 7, 1, "http://a.org/p", "t"), (11, 7, 2, "http://a.org/p", "t"), (12, 7, 1, "http://b.org/p", "t"), (13, 7, 3, "http://a.org/p", "t"),
         (14, 7, 4, None, None), (15, 7, 9, "http://a.org/p", "t"), (16, 7, 5, "http://a.org/news/", "News"), (17, 7, 1, "http://a.org/news/", "News")],
        "version_id long, page_id long, html_id long, url string, title string")
    pages = spark.createDataFrame([(7, "http://a.org/p")], "page_id long, url string")
    store = st.body_store(caps, pages, bodies, spark.createDataFrame([], "doc_id long, text string"), text_ref="html_id")
    v = F.struct("html_id", "url", "title").alias("v")
    ends = caps.select(F.col("version_id").alias("pair_id"), F.lit("a").alias("side"), v, F.lit(True).alias("content")).unionByName(
        caps.select((F.col("version_id") + 100).alias("pair_id"), F.lit("b").alias("side"), v, F.lit(False).alias("content")))
    nodes = an.html_nodes(an._join_body(ends, bodies, "html_id", "html_id", "html")).cache()
    cols = ["pair_id", "side", "kind", "pos", "unit"]
    want = sorted(map(tuple, an.html_units(nodes).select(cols).collect()))
    assert sorted(map(tuple, store.html_units(ends, "html_id").select(cols).collect())) == want and len(want) > 10
    read = sorted(map(tuple, nodes.where("kind = 'doc'").select("pair_id", "side", "client").collect()))
    assert sorted(map(tuple, store.html_docs(ends, "html_id").collect())) == read
    # captures 10 and 11 have one document of one body
    assert store.units.where("kind = 'doc'").count() == 5


def test_halves_are_staged_before_they_are_chosen(spark, monkeypatch):
    """A filter on the priority of a plan that works it out would do that twice."""
    from changelens.operators import deep as dp

    staged = {}
    real = dp.stage_table
    monkeypatch.setattr(dp, "stage_table", lambda df, name: staged.setdefault(name, (df, real(df, name)))[1])
    a, b = tb.FRAMES[0]
    v = stage_table(tb.versions(spark, SF).where("page_id IN (1, 7)"), "test-captures")
    bodies = stage_table(tb.version_bodies(spark, SF).join(v.select("version_id"), "version_id", "left_semi"), "test-bodies")
    change_results(v, tb.page_meta(spark, SF), tb.table(spark, SF, "documents"), bodies, a, b,
                   deep=True, threshold=0.2, html_ref="version_id", html_key="version_id")
    done = next(df for df, _ in staged.values() if "depth" in df.columns)
    filters = [line for line in done._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in line]
    assert filters and not any("priority" in line or "ln(" in line.lower() or "log1p" in line.lower() for line in filters)


def test_stage_scope_deletes_its_own(spark, tmp_path):
    import os

    with stage_scope(spark):
        df = stage_table(spark.range(3), "scoped")
        path = _SCOPE.get()[0]
        assert df.count() == 3 and os.path.isdir(path)
    assert not os.path.exists(path)
    with pytest.raises(ValueError), stage_scope(spark):
        stage_table(spark.range(3), "scoped")
        path = _SCOPE.get()[0]
        raise ValueError
    assert not os.path.exists(path)


def test_bucketed_stage_is_read_without_a_shuffle(spark):
    from changelens.session import stage_bucketed

    with stage_scope(spark):
        big = stage_bucketed(spark.range(1000).selectExpr("id % 7 AS k", "id AS x"), "buckets", "k")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            plan = big.join(spark.range(7).selectExpr("id AS k"), "k")._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert plan.count("Exchange hashpartitioning") <= 1 and "Bucketed: true" in plan
        name = [p for p in _SCOPE.get() if p.startswith("table:")][0].removeprefix("table:")
        assert spark.catalog.tableExists(name)
    assert not spark.catalog.tableExists(name)


def test_weekly_job_leaves_only_its_outputs(spark, tmp_path):
    import os

    from changelens.plans.weekly import weekly_job
    from changelens.session import checkpoint_dir

    a, b = tb.FRAMES[0]
    v = stage_table(tb.versions(spark, SF).where("page_id IN (1, 7)"), "test-captures")
    bodies = stage_table(tb.version_bodies(spark, SF).join(v.select("version_id"), "version_id", "left_semi"), "test-bodies")
    folder = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    weekly_job(spark, v, tb.page_meta(spark, SF), tb.table(spark, SF, "documents"), bodies, a, b, str(tmp_path / "out"),
               html_ref="version_id", html_key="version_id")
    assert set(os.listdir(folder)) == before
    assert sorted(n for n in os.listdir(tmp_path / "out")) == ["_redirects-changed", "_redirects-current", "_results.json.gz", "sheets"]
    got = {r.page.page_id for r in spark.read.json(str(tmp_path / "out" / "_results.json.gz")).collect()}
    assert got and got <= {1, 7}  # pages without a change are no results
