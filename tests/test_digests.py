"""Deep search: pairs are measured from digests, and rounds leave nothing behind but what they found."""

import random

from conftest import SF
from pyspark.sql import functions as F

from changelens.functions import urls as U
from changelens.operators import analysis as an
from changelens.operators import automaton
from changelens.operators import diffs as dif
from changelens.operators import digests as dg
from changelens.operators import store as st
from changelens.operators import terms as trm
from changelens.plans.weekly import change_results
from changelens.session import SHUFFLE_CLEANUP, stage_scope, stage_table, staged_since
from changelens.sources import tables as tb

TERMS, STOPS = ["green energy", "b c", "a"], {"the"}


def digest_rows(units, kind):
    return dg.packed(units.where(F.col("kind") == kind), ["doc", "pair_id", "side", "kind"], dg.prefix(F.substring_index("unit", "\t", 1)) if kind == "link" else None)


def test_metrics_of_digests_are_those_of_rows(spark):
    rng = random.Random(7)
    words = ["a", "b", "c", "the", "green", "energy", "x"]
    line = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(1, 3)))
    unit = {"link": lambda: f"http://x/{rng.randrange(4)}\tt{rng.randrange(3)}", "source": lambda: f"<é{rng.randrange(5)}>", "text": line}
    rows = [(d, p, s, k, 3 * i, unit[k]()) for p in range(40) for s in "ab" for k in unit if rng.random() < 0.9
            for d in ((1, 2) if (p, s, k) == (5, "a", "text") else (1,)) for i in range(rng.randint(0, 12))]
    units = spark.createDataFrame(rows, "doc int, pair_id long, side string, kind string, pos int, unit string").cache()
    href = spark.createDataFrame([("http://x/1",)], "u string").select(dg.prefix(F.col("u"))).first()[0]
    texts = units.where("kind = 'text'").groupBy("doc", "pair_id", "side").agg(F.array_sort(F.collect_list(F.struct("pos", "unit"))).alias("lines"))
    texts = texts.select(F.concat_ws(" ", "doc", "pair_id", "side").alias("body_id"), "lines")
    text = dg.text_digests(texts, automaton.words_of(TERMS, STOPS)).withColumns(
        {"pair_id": F.split("body_id", " ")[1].cast("long"), "side": F.split("body_id", " ")[2], "kind": F.lit("text")})
    sent = [digest_rows(units, "link").withColumn("self_a", F.lit(href)), digest_rows(units, "source"), text,
            spark.createDataFrame([(3, "a", "end", "r1"), (3, "b", "end", None), (3, "a", "end", "r2")], "pair_id long, side string, kind string, client string")]
    same = [s.select("pair_id", *[(F.col(f.name) if f.name in s.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in dg.ROW]) for s in sent]
    m = dg.pair_metrics(same[0].unionByName(same[1]).unionByName(same[2]).unionByName(same[3])).cache()
    html = {r.pair_id: (tuple(r.links), tuple(r.source)) for r in m.select("pair_id", *dg.html_columns()).collect()}
    lab = dif.label_units(units.drop("doc").where("kind != 'text'"), ("pair_id", "kind"))
    want = {r.pair_id: (r.diff_hash, r.diff_length, r.diff_ratio) for r in an.count_metrics(lab.where("kind = 'link'")).collect()}
    lost = {r.pair_id for r in lab.where("kind = 'link' AND op = -1 AND unit LIKE 'http://x/1\t%'").collect()}
    assert 0 < len(lost) < 40
    source = {r.pair_id: tuple(r)[1:] for r in an.source_metrics(lab.where("kind = 'source'")).collect()}
    for p, (links, src) in html.items():
        assert links == (*want.get(p, (dif.EMPTY_HASH, 0, 0.0)), p in lost)
        assert src == source.get(p, (dif.EMPTY_HASH, 0, 0, 0.0))
    assert len(html) == 40 and tuple(m.where("pair_id = 3").select("ends", "a_client", "b_client").first()) == (3, "r2", None)
    # Text; several texts of an end have places in common, whose order is open.
    lab = dif.label_units(units.drop("doc", "kind").where(units.kind == "text")).cache()
    alone = lambda df: sorted(map(tuple, df.where("pair_id != 5").collect()))
    cols = ["percent_changed", "diff_hash", "diff_count", "diff_length", "diff_max_length"]
    got = dict((r[0], r[1:]) for r in alone(m.select("pair_id", *dg.text_columns())))
    rows = alone(dif.text_metrics(lab).select("pair_id", *cols))
    assert [(p, *got[p]) for p, *_ in rows] == rows
    assert [r.pair_id for r in m.where("repeated").collect()] == [5]
    lines = m.select("pair_id", F.inline("lines")).withColumn("repeated", F.lit(False))
    hits = alone(automaton.term_hits(lines, TERMS, STOPS).select("pair_id", "side", "pos", "wpos", "term"))
    full = alone(automaton.term_hits(trm.with_lines(lab), TERMS, STOPS).select("pair_id", "side", "pos", "wpos", "term"))
    assert hits == full and len(hits) > 20


def test_digests_of_the_store_are_its_units(spark):
    """Of news and other pages, with and without a known title, and of relative and other links."""
    body = ('<base href="/deep/"><p>one</p><a href="x">X</a><a href="http://c.org/#y">Y</a><a aria-controls="m" href="#z">Z</a>'
            '<div class="news content">n<img src="i.png"></div><div class="news_section">s</div><!-- c --><input type="hidden">')
    bodies = spark.createDataFrame([(1, body), (2, body.replace("one", "two")), (3, None)], "html_id long, html string")
    caps = spark.createDataFrame(
        [(10, 7, 1, "http://a.org/p", "t"), (11, 7, 2, "http://a.org/p", "t"), (12, 7, 2, "http://b.org/q", "t"), (13, 7, 1, None, None),
         (14, 7, 2, "http://a.org/news/", "News"), (15, 7, 1, "http://c.org/", None), (16, 7, 3, "http://a.org/p", "t")],
        "version_id long, page_id long, html_id long, url string, title string")
    pages = spark.createDataFrame([(7, "http://a.org/p")], "page_id long, url string")
    store = st.body_store(caps, pages, bodies, None)
    cap = caps.select("version_id", F.struct("html_id", "url", "title").alias("v"))
    ids = [(a, b) for a in range(10, 17) for b in range(10, 17)]
    pairs = spark.createDataFrame([(f"{a}-{b}", a, b) for a, b in ids], "node string, _a long, _b long")
    pairs = pairs.join(cap.toDF("_a", "a"), "_a").join(cap.toDF("_b", "b"), "_b").select("node", "a", "b", F.lit(True).alias("content"))
    selfs = [dg.prefix(U.normalize_url(F.col(f"{s}.url"), F.col(f"{s}.url"))).alias(f"self_{s}") for s in "ab"]
    m = store.pair_metrics(an.ends(pairs.select("*", *selfs), "node", ("self_a", "self_b")), "html_id", None)
    got = {r.pair_id: (r.ends, tuple(r.links), tuple(r.source)) for r in m.select("pair_id", "ends", *dg.html_columns()).collect()}
    kinds = ("pair_id", "kind")
    units = store.html_units(an.ends(pairs, "node"), "html_id")
    rows = an.html_metrics(dif.with_runs(dif.label_units(units, kinds), kinds), pairs, "node")
    want = {r.pair_id: (tuple(r.links), tuple(r.source)) for r in rows.collect()}
    assert {p: g[1:] for p, g in got.items()} == want and len(want) == 48  # 16-16 has no body
    assert got["10-11"][0] == 2 and got["10-16"][0] == 1 and len({w[1] for w in want.values()}) > 4


def test_the_search_leaves_what_it_found(spark, monkeypatch):
    """No round holds texts of units, and what a round has staged goes with it."""
    staged, real = [], an.stage_table
    for module in (an, st):
        monkeypatch.setattr(module, "stage_table", lambda df, name: staged.append((name, df.columns)) or real(df, name))
    a, b = tb.FRAMES[0]
    v = stage_table(tb.versions(spark, SF).where("page_id = 7"), "test-captures")
    bodies = stage_table(tb.version_bodies(spark, SF).join(v.select("version_id"), "version_id", "left_semi"), "test-bodies")
    with stage_scope(spark):
        got = change_results(v, tb.page_meta(spark, SF), tb.table(spark, SF, "documents"), bodies, a, b, deep=True, threshold=0.9,
                             html_ref="version_id", html_key="version_id")
        left = [p.rsplit("/", 1)[-1].rsplit("-", 1)[0].removeprefix("stage-") for p in staged_since(spark)]
        assert got.count() == 1
    assert sum(n == "pair_metrics" for n, _ in staged) and not [n for n, c in staged if "unit" in c]
    assert {n.rstrip("0123456789") for n in left} <= {"trimmed", "results", "deep-done-"}


def test_a_body_is_copied_once_a_task(spark):
    rows = spark.createDataFrame([(i, f"b{i % 3}", f"id{i % 3}") for i in range(9)] + [(9, None, None)], "_ref long, _body string, body_id string").coalesce(1)
    got = st._once_a_task(rows).collect()
    assert sorted(r._body for r in got if r._body) == ["b0", "b1", "b2"] and all(r._body in (None, f"b{r._ref % 3}") for r in got)
    assert [(r._ref, r.body_id) for r in got] == [(r._ref, r.body_id) for r in rows.collect()]


def test_shuffle_files_of_a_staged_write_go(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f for f in str(disk.getAllFiles().mkString(" ")).split() if "shuffle_" in f}
    before, conf = files(), spark.conf.get(SHUFFLE_CLEANUP, None)
    staged = stage_table(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "test-groups")
    assert files() <= before and spark.conf.get(SHUFFLE_CLEANUP, None) == conf
    assert len(staged.collect()) == 7
