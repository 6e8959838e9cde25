"""What jobs move: bodies that nobody wants are not built, pairs are shuffled once, only words of terms are compared."""

import random

from conftest import SF
from pyspark.sql import functions as F

from changelens.functions import urls as U
from changelens.operators import analysis as an
from changelens.operators import automaton
from changelens.operators import diffs as dif
from changelens.operators import terms as trm
from changelens.plans import registry
from changelens.sources import tables as tb
from changelens.sources.local import values_table


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0].count("Exchange hashpartitioning")


def units(spark, rows):
    return spark.createDataFrame(rows, "pair_id long, side string, pos int, unit string")


def test_bodies_of_the_ends_alone_are_built(spark):
    ends = spark.range(1).selectExpr("7L AS pair_id", "'a' AS side", "struct(2L AS ref, 'u' AS url, 't' AS title) AS v", "true AS content")
    asked = []

    def bodies(wanted):
        asked.extend(r.id for r in wanted.collect())
        return spark.range(5).selectExpr("id", "concat('body ', id) AS html").join(wanted, "id", "left_semi")

    got = an._join_body(ends, bodies, "ref", "id", "html").collect()
    assert asked == [2] and [(r.pair_id, r._body) for r in got] == [(7, "body 2")]


def test_wanted_bodies_are_those_of_all(spark):
    ids = tb.version_bodies(spark, SF).select("version_id").where("version_id % 7 = 0")
    some = {tuple(r) for r in tb.version_bodies(spark, SF, ids).collect()}
    assert some and some == {tuple(r) for r in tb.version_bodies(spark, SF).where("version_id % 7 = 0").collect()}


def test_bodies_take_no_part_in_joins_of_captures(spark):
    assert registry._clients(spark, SF).columns == ["version_id", "client"]


def test_a_pair_is_shuffled_once(spark):
    lab = dif.label_units(units(spark, [(1, "a", 0, "x"), (1, "b", 0, "y")]))
    assert exchanges(dif.ordered_diff(lab)) == 1
    assert exchanges(dif.text_metrics(lab)) == 1
    assert exchanges(dif.runs(lab)) == 1


def test_runs_known_before_give_the_same_metrics(spark):
    rng = random.Random(3)
    rows = [(p, s, 2 * i, f"u{rng.randrange(5)}") for p in range(20) for s in "ab" for i in range(rng.randint(0, 9))]
    lab = dif.label_units(units(spark, rows))
    want = sorted(map(tuple, dif.text_metrics(lab).collect()))
    assert sorted(map(tuple, dif.text_metrics(dif.with_runs(lab)).collect())) == want
    per = {p: [r for r in dif.runs(lab).where(F.col("pair_id") == p).collect()] for p in (0, 7)}
    for p, runs in per.items():
        got = [w for w in want if w[0] == p]
        assert [(w[3], w[4], w[5]) for w in got] == [(len(runs), sum(r.length for r in runs), max((r.length for r in runs), default=0))]


def test_only_words_of_terms_are_compared(spark):
    lab = trm.with_lines(dif.label_units(units(spark, [(1, "a", 0, "old things"), (1, "b", 0, "much new green energy here")])))
    shared = spark.sparkContext.broadcast((automaton.Automaton(["green energy", "old"]), {"green", "energy", "old"}))
    got = automaton.dictionary_words(lab, shared).select("side", "wpos", "word", "changed").collect()
    assert sorted(map(tuple, got)) == [("a", 0, "old", True), ("b", 2, "green", True), ("b", 3, "energy", True)]


def test_terms_across_lines_and_other_words_are_those_of_the_join(spark):
    rng = random.Random(11)
    words = ["a", "b", "c", "the", "x", "y", "z"]
    rows = [(p, s, 3 * i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 4)))) for p in range(60) for s in "ab" for i in range(8)]
    lab = dif.label_units(units(spark, rows))
    d = trm.term_dictionary(values_table(spark, ["a", "a b", "b c a", "c c", "a the b", "b b c"], ["term"]))
    stop = values_table(spark, ["the"], ["word"])
    cols = ["pair_id", "side", "pos", "wpos", "n", "term"]
    got = sorted(map(tuple, trm.changed_ngrams(lab, d, stop).select(cols).collect()))
    assert got == sorted(map(tuple, trm.ngrams_by_join(lab, d, stop).select(cols).collect())) and len(got) > 100
    assert {r[4] for r in got} == {1, 2, 3}


def test_the_store_reads_the_wanted_bodies_alone(spark):
    from functools import partial

    from changelens.operators import store as st

    wanted = tb.versions(spark, SF).where("page_id = 7").selectExpr("version_id AS _ref", "true AS _parse").distinct()
    want, got = [
        [sorted(map(tuple, df.collect())) for df in st._distinct(bodies, wanted, "version_id", "html", "test-html")]
        for bodies in (tb.version_bodies(spark, SF), partial(tb.version_bodies, spark, SF))]
    assert got == want and got[0]


def test_results_look_up_their_bodies(spark, monkeypatch):
    """The queries on results give the job a lookup of bodies, not a view that builds all of them."""
    given = []
    monkeypatch.setattr(registry, "change_results", lambda *a, **_: given.append(a))
    registry._results(spark, SF)
    bodies = given[0][3]
    got = bodies(spark.createDataFrame([(1,), (2,)], "version_id long")).select("version_id").collect()
    assert sorted(r.version_id for r in got) == [1, 2]


def test_html_metrics_are_those_of_each_kind(spark):
    """Link and source metrics of one pass over the labelled units are those of a pass for each."""
    rng = random.Random(5)
    hrefs = [r[0] for r in spark.range(4).select(F.concat(F.lit("http://x/"), "id").alias("u")).select(U.normalize_url(F.col("u"), F.col("u"))).collect()]
    rows = [(p, s, k, 2 * i, f"{rng.choice(hrefs)}\tt{rng.randrange(3)}" if k == "link" else f"<p>{rng.randrange(5)}")
            for p in range(30) for s in "ab" for k in ("link", "source") if rng.random() < 0.9 for i in range(rng.randint(0, 9))]
    kinds = ("pair_id", "kind")
    lab = dif.label_units(spark.createDataFrame(rows, "pair_id long, side string, kind string, pos int, unit string"), kinds)
    url = lambda s: F.struct(F.concat(F.lit("http://x/"), F.col("page_id") % s).alias("url"))
    pairs = spark.range(30).toDF("page_id").select("page_id", url(2).alias("a"), url(3).alias("b"))
    pairs = pairs.unionByName(pairs.where("page_id < 3"))
    metrics = an.html_metrics(dif.with_runs(lab, kinds), pairs)
    assert exchanges(metrics.select("pair_id", "source")) <= 2  # the units' and the narrow pairs'
    got = {r.pair_id: (tuple(r.links), tuple(r.source)) for r in metrics.collect()}
    links = {r.pair_id: (r.diff_hash, r.diff_length, r.diff_ratio) for r in an.count_metrics(lab.where("kind = 'link'")).collect()}
    source = {r.pair_id: (r.diff_hash, r.diff_count, r.diff_length, r.diff_ratio) for r in an.source_metrics(lab.where("kind = 'source'")).collect()}
    own = {(r.page_id, u) for r in pairs.select("page_id", *[U.normalize_url(F.col(f"{c}.url"), F.col(f"{c}.url")).alias(c) for c in "ab"]).collect() for u in (r.a, r.b)}
    lost = {r.pair_id for r in lab.where("kind = 'link' AND op = -1").collect() if (r.pair_id, r.unit.split("\t")[0]) in own}
    assert got.keys() == links.keys() | source.keys() and 0 < len(lost) < 30
    for p, (ln, src) in got.items():
        assert ln == (*links.get(p, (dif.EMPTY_HASH, 0, 0.0)), p in lost)
        assert src == source.get(p, (dif.EMPTY_HASH, 0, 0, 0.0))


def test_results_stage_no_units_of_the_html(spark, monkeypatch):
    names = []
    real = an.stage_table
    monkeypatch.setattr(an, "stage_table", lambda df, name: names.append((name, df.columns)) or real(df, name))
    v = tb.versions(spark, SF).where("page_id = 7").selectExpr("version_id", "struct(*) AS rec").limit(2).collect()
    ids = sorted(r.version_id for r in v)
    caps = tb.versions(spark, SF).where(F.col("version_id").isin(ids)).drop("page_id")
    side = lambda i, n: caps.where(F.col("version_id") == i).select(F.struct("*").alias(n))
    pairs = side(ids[0], "a").crossJoin(side(ids[1], "b")).selectExpr("7L AS page_id", "2 AS n_versions", "a", "b")
    pages = tb.page_meta(spark, SF).where("page_id = 7")
    got = an.analyze_pairs(pairs, pages, tb.table(spark, SF, "documents"), registry._bodies(spark, SF), html_ref="version_id", html_key="version_id").collect()
    assert len(got) == 1 and got[0].analysis is not None
    assert ("html_metrics", ["pair_id", "links", "source"]) in names
    assert [c for _, c in names if "kind" in c and "unit" in c] == []
