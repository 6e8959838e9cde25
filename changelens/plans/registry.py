"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each one reads the driver tables (through the fixture views of
``changelens.sources.tables``) and runs a library operator on all rows.
Column names equal those of the matching oracle SQL in ``tools/oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changelens.operators import analysis as an
from changelens.operators import blocks as bk
from changelens.operators import versions as ver
from changelens.operators.catalog import select_pages
from changelens.session import stage_path, stage_table
from changelens.sources import tables as tb
from changelens.sources.tables import FRAMES, STOP_WORDS, TERMS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    """Register a query; the session gets the job settings (UTC session time
    zone, AQE, skew join) before it runs."""
    import functools

    from changelens.session import apply_job_conf

    @functools.wraps(fn)
    def run(spark, sf_dir):
        apply_job_conf(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@register
def versions_in_frame(spark, sf):
    v = ver.narrow(tb.versions(spark, sf))
    return ver.select_frames(v, FRAMES).select("frame", "page_id", "version_id", "capture_time", "is_baseline")


@register
def baseline_lookback(spark, sf):
    v = ver.narrow(tb.versions(spark, sf))
    return ver.select_frames(v, FRAMES).where("is_baseline").select(
        "frame", "page_id", F.col("version_id").alias("baseline_id"), F.col("capture_time").alias("baseline_time"))


@register
def trimmed_versions(spark, sf):
    v = ver.narrow(tb.versions(spark, sf))
    sel = stage_table(ver.select_frames(v, FRAMES), "selected")
    return ver.trim_versions(sel, ["frame", "page_id"]).select(
        "frame", "page_id", "version_id", "capture_time", "is_baseline")


# ---------------------------------------------------------------- text
from changelens.functions import text as tx  # noqa: E402
from changelens.operators import diffs as dif  # noqa: E402
from changelens.operators import scripts as osc  # noqa: E402
from changelens.operators import terms as trm  # noqa: E402
from changelens.sources.local import values_table  # noqa: E402


def _labelled(spark, sf):
    pairs = tb.doc_pairs(spark, sf)
    docs = tb.table(spark, sf, "documents")
    return dif.label_units(dif.text_units(pairs, docs))


def _dictionary(spark):
    return trm.term_dictionary(values_table(spark, TERMS, ["term"]))


def _stop_words(spark):
    return values_table(spark, STOP_WORDS, ["word"])


@register
def normalized_text(spark, sf):
    d = tb.table(spark, sf, "documents")
    return d.select("doc_id", tx.normalize_text(F.col("text")).alias("norm_text"))


@register
def normalized_text_exact(spark, sf):
    d = tb.table(spark, sf, "documents")
    return d.select("doc_id", tx.normalize_text_exact(F.col("text")).alias("norm_text"))


@register
def line_diff(spark, sf):
    return _labelled(spark, sf).select("pair_id", "side", "pos", "unit", "op")


@register
def diff_runs(spark, sf):
    return dif.runs(_labelled(spark, sf)).select(
        "pair_id", "side", F.col("run_id").cast("bigint").alias("run_id"), "op",
        F.col("n_units").cast("bigint").alias("n_units"), F.col("length").cast("bigint").alias("length"), "first_pos")


@register
def diff_metrics(spark, sf):
    return dif.text_metrics(_labelled(spark, sf))


@register
def change_hash(spark, sf):
    return dif.text_metrics(_labelled(spark, sf)).select("pair_id", "diff_hash")


@register
def term_dictionary(spark, sf):
    """A dictionary of the corpus: words of six letters and more that 5 to 50 documents have."""
    d = tb.table(spark, sf, "documents")
    w = F.array_distinct(F.filter(F.split(F.trim(tx.normalize_text(F.col("text"))), " "), lambda x: F.length(x) >= 6))
    terms = d.select("doc_id", F.explode(w).alias("term")).groupBy("term").agg(F.count("*").alias("n")).where("n BETWEEN 5 AND 50")
    return trm.term_dictionary(terms.select("term")).select("term", F.col("n_words").cast("int").alias("n_words"))


def _ngrams(spark, sf):
    return trm.changed_ngrams(_labelled(spark, sf), _dictionary(spark), _stop_words(spark))


@register
def changed_ngrams(spark, sf):
    return _ngrams(spark, sf).select("pair_id", "side", "pos", "wpos", F.col("n").cast("int").alias("n"), "term")


@register
def key_term_net(spark, sf):
    return trm.key_term_net(_ngrams(spark, sf))


@register
def key_term_summary(spark, sf):
    s = trm.key_term_summary(trm.key_term_net(_ngrams(spark, sf)))
    return s.select(
        "pair_id",
        F.array_join(F.transform(F.map_entries("key_terms"),
                                 lambda e: F.concat(e["key"], F.lit(": "), e["value"].cast("string"))), ", ").alias("key_terms"),
        "key_terms_changed", "key_terms_change_count")


# ---------------------------------------------------------------- URLs
from changelens.functions import charsets as cs  # noqa: E402
from changelens.functions import urls as U  # noqa: E402


@register
def url_canonical(spark, sf):
    p = tb.table(spark, sf, "pages")
    return p.select("page_id", "url", U.canonical_key(F.col("url")).alias("url_key"))


@register
def url_normalized(spark, sf):
    pr = tb.url_probes(spark, sf)
    return pr.select("page_id", "pos", "href", U.normalize_url(F.col("href"), F.col("url")).alias("normalized"))


@register
def session_free_urls(spark, sf):
    pr = tb.url_probes(spark, sf)
    return pr.select("page_id", "pos",
                     U.remove_session_id(U.absolute_url(F.col("url"), F.col("href"))).alias("session_free"))


@register
def url_change_types(spark, sf):
    pp = tb.page_pairs(spark, sf)
    p = tb.table(spark, sf, "pages").select("page_id", "url")
    a = p.select(F.col("page_id").alias("a_page"), F.col("url").alias("a_url"))
    b = p.select(F.col("page_id").alias("b_page"), F.col("url").alias("b_url"))
    j = pp.join(a, "a_page").join(b, "b_page")
    return j.select("pair_id", "a_url", "b_url", U.url_change_type(F.col("a_url"), F.col("b_url")).alias("change_type"))


@register
def home_pages(spark, sf):
    p = tb.table(spark, sf, "pages").select("page_id", "url")
    m = tb.page_meta(spark, sf).select("page_id", "url")
    return p.unionByName(m).select("page_id", "url", U.is_home_page(F.col("url")).alias("is_home"))


# ---------------------------------------------------------------- pair analysis
from changelens.plans.weekly import change_results  # noqa: E402


def _bodies(spark, sf):
    """The captures' bodies, looked up by the captures that are wanted."""
    return partial(tb.version_bodies, spark, sf)


def _results(spark, sf, frame=0):
    a, b = FRAMES[frame]
    return change_results(
        tb.versions(spark, sf), tb.page_meta(spark, sf), tb.table(spark, sf, "documents"),
        _bodies(spark, sf), a, b, _dictionary(spark), _stop_words(spark),
        html_ref="version_id", html_key="version_id")


@register
def page_priority(spark, sf):
    r = _results(spark, sf)
    A = "analysis."
    return r.where(F.col("error_kind").isNull() | (F.col("error_kind") != "no_change")).select(
        "page_id", "n_versions", "error_kind",
        F.round(F.col(A + "priority"), 6).alias("priority"),
        F.col(A + "status_a").alias("status_a"), F.col(A + "status_b").alias("status_b"),
        F.col(A + "status_changed").alias("status_changed"), F.col(A + "root_page").alias("root_page"),
        F.col(A + "links.diff_length").alias("links_diff_length"),
        F.col(A + "links.removed_self_link").alias("removed_self_link"),
        F.col(A + "source.diff_count").alias("source_diff_count"),
        F.col(A + "text.diff_count").alias("text_diff_count"),
        F.col(A + "text.percent_changed").alias("text_percent_changed"),
        F.col(A + "text.diff_hash").alias("text_diff_hash"),
        F.col(A + "text.key_terms_change_count").alias("key_terms_change_count"),
        F.col(A + "redirect.change_type").alias("change_type"),
        F.col(A + "redirect.client_state").alias("client_state"),
    )


# ---------------------------------------------------------------- versions, continued
from changelens.functions import gates as G  # noqa: E402
from changelens.functions import redirects as RD  # noqa: E402
from changelens.functions import status as ST  # noqa: E402
from changelens.operators import sheets as sh  # noqa: E402
from changelens.operators.analysis import count_metrics, source_metrics  # noqa: E402


@register
def catalog_scan(spark, sf):
    """SRC-01: active pages, URL pattern, any-of tags, ordered by created_at."""
    m = select_pages(tb.page_meta(spark, sf), "*/p/*", ["category:BUILDING", "news"])
    return m.orderBy("created_at").select("page_id", "url", "created_at")


@register
def change_pairs(spark, sf):
    v = tb.versions(spark, sf)
    a, b = FRAMES[0]
    pairs = ver.endpoints(ver.select_and_trim(v, a, b))
    kind, _ = G.gate(F.col("n_versions"))
    return pairs.withColumn("error_kind", kind).where(
        F.col("error_kind").isNull() | (F.col("error_kind") != "no_change")).select(
        "page_id", "n_versions", F.col("a.version_id").alias("a_id"), F.col("b.version_id").alias("b_id"),
        F.col("a.capture_time").alias("a_time"), F.col("b.capture_time").alias("b_time"), "error_kind")


@register
def latest_valid(spark, sf):
    v = tb.versions(spark, sf)
    a, b = FRAMES[3]
    vb = v.where(F.col("capture_time") < ver.ts_lit(b))
    lv = ver.latest_valid(vb, ver.select_and_trim(ver.narrow(v), a, b))
    return lv.select("page_id", F.col("latest.version_id").alias("latest_id"),
                     F.col("latest.capture_time").alias("latest_time"), "valid_id", "valid_time")


@register
def change_rate(spark, sf):
    v = ver.narrow(tb.versions(spark, sf))
    a, b = FRAMES[0]
    return ver.change_rate(ver.select_and_trim(v, a, b), a, b)


def _clients(spark, sf):
    """The client redirect of every body: what is read of it, so that bodies take no part in joins of captures."""
    return tb.version_bodies(spark, sf).select("version_id", RD.client_redirect(F.col("html")).alias("client"))


@register
def effective_status(spark, sf):
    v = tb.versions(spark, sf)
    j = v.join(_clients(spark, sf), "version_id")
    client = F.col("client")
    return j.select("version_id", ST.effective_status(
        F.col("url"), F.col("status"), F.col("network_error"), F.col("title"), F.col("headers"),
        RD.all_redirects(F.col("redirects"), client)).alias("effective_status"))


@register
def status_factor(spark, sf):
    r = _results(spark, sf).where(F.col("analysis").isNotNull())
    sa, sb = F.col("analysis.status_a"), F.col("analysis.status_b")
    return r.select("page_id", sa.alias("status_a"), sb.alias("status_b"),
                    ST.error_type(sa).alias("error_a"), ST.error_type(sb).alias("error_b"),
                    ST.status_changed(sa, sb).alias("status_changed"),
                    ST.status_factor(sa, sb).alias("factor"))


def _numbered(rows, *cols):
    """Rows of a page with their place among each other instead of their place among all nodes."""
    w = Window.partitionBy("page_id").orderBy("pos")
    return rows.select("page_id", (F.row_number().over(w) - 1).alias("n"), *cols)


@register
def page_links(spark, sf):
    nodes = bk.parse_html(tb.table(spark, sf, "pages"), "page_id")
    return _numbered(nodes.where((F.col("kind") == "link") & F.col("href").isNotNull()), "href", "text")


def _page_pair_nodes(spark, sf, kinds=None):
    pp = tb.page_pairs(spark, sf)
    pages = tb.table(spark, sf, "pages")
    e = pp.select("pair_id", F.inline(F.array(F.struct(F.lit("a").alias("side"), F.col("a_page").alias("pid")),
                                              F.struct(F.lit("b").alias("side"), F.col("b_page").alias("pid")))))
    title = F.regexp_extract("html", r"<title>([^<]*)</title>", 1)
    e = e.join(pages.select(F.col("page_id").alias("pid"), "url", title.alias("title"), F.lit(True).alias("content"),
                            F.col("html").alias("_body")), "pid").drop("pid")
    return an.html_nodes(e, kinds=kinds)


def _page_pair_links(spark, sf):
    return an.link_units(_page_pair_nodes(spark, sf, ["link"]))


@register
def link_diff(spark, sf):
    return count_metrics(dif.label_units(_page_pair_links(spark, sf)))


@register
def self_link_removed(spark, sf):
    pp = tb.page_pairs(spark, sf)
    pages = tb.table(spark, sf, "pages").select("page_id", "url")
    lab = dif.label_units(_page_pair_links(spark, sf))
    selfs = (pp.join(pages.select(F.col("page_id").alias("a_page"), F.col("url").alias("a_url")), "a_page")
             .join(pages.select(F.col("page_id").alias("b_page"), F.col("url").alias("b_url")), "b_page")
             .select("pair_id", U.normalize_url(F.col("a_url"), F.col("a_url")).alias("sa"),
                     U.normalize_url(F.col("b_url"), F.col("b_url")).alias("sb")))
    hits = lab.where(F.col("op") == -1).join(selfs, "pair_id").where(
        F.substring_index("unit", "\t", 1).isin(F.col("sa"), F.col("sb"))).select("pair_id").distinct()
    return selfs.join(hits.withColumn("hit", F.lit(True)), "pair_id", "left").select(
        "pair_id", F.coalesce(F.col("hit"), F.lit(False)).alias("removed_self_link"))


@register
def source_diff(spark, sf):
    hu = an.html_units(_page_pair_nodes(spark, sf)).where(F.col("kind") == "source")
    return source_metrics(dif.label_units(hu))


@register
def client_redirects(spark, sf):
    v = tb.versions(spark, sf)
    j = v.join(_clients(spark, sf), "version_id")
    client = F.col("client")
    allr = RD.all_redirects(F.col("redirects"), client)
    return j.select("version_id", client.alias("client"), F.array_join(allr, " ").alias("all_redirects"),
                    RD.final_url(allr, F.col("url")).alias("final_url"))


def _sheeted(spark, sf):
    r = sh.drop_no_change(_results(spark, sf))
    m = tb.page_meta(spark, sf).select("page_id", "url", "title", "tags", "maintainers")
    return r.join(m, "page_id", "left")


@register
def redirect_changes(spark, sf):
    r = _sheeted(spark, sf).withColumn("sheet", sh.sheet_key(F.col("tags")))
    return sh.redirect_changes(r).drop("_url")


@register
def redirects_current(spark, sf):
    r = _sheeted(spark, sf).withColumn("sheet", sh.sheet_key(F.col("tags")))
    return sh.redirects_current(r).select(
        "page_id", "sheet", F.col("Redirect Type").alias("redirect_type"), F.col("Monitored URL").alias("monitored_url"),
        F.col("Redirected URL").alias("redirected_url"), F.col("All Redirects").alias("all_redirects"))


@register
def media_gate(spark, sf):
    pr = tb.url_probes(spark, sf)
    absu = U.absolute_url(F.col("url"), F.col("href"))
    media = F.element_at(F.array(F.lit("text/html"), F.lit("application/xhtml+xml"), F.lit("text/calendar"),
                                 F.lit("application/pdf"), F.lit(None).cast("string")), (F.col("pos") % 5 + 1).cast("int"))
    return pr.select("page_id", "pos", G.is_fetchable(absu).alias("fetchable"),
                     G.is_allowed_extension(absu).alias("allowed_extension"),
                     G.is_analyzable_media(media, absu).alias("analyzable_media"))


@register
def news_pages(spark, sf):
    p = tb.table(spark, sf, "pages")
    title = F.regexp_extract("html", r"<title>([^<]*)</title>", 1)
    return p.select("page_id", G.is_news_page(F.col("url"), title).alias("is_news"))


@register
def metadata_only(spark, sf):
    pr = tb.url_probes(spark, sf)
    absu = U.absolute_url(F.col("url"), F.col("href"))
    return pr.select("page_id", "pos", G.is_content_analyzable(absu).alias("content_analyzable"))


@register
def sheet_keys(spark, sf):
    m = tb.page_meta(spark, sf)
    return m.select("page_id", sh.sheet_key(F.col("tags")).alias("sheet"))


@register
def agency_tags(spark, sf):
    m = tb.page_meta(spark, sf)
    return m.select("page_id", sh.prefixed_values(F.col("tags"), "agency:").alias("agencies"),
                    sh.prefixed_values(F.col("tags"), "office:").alias("offices"))


@register
def hash_groups(spark, sf):
    g = sh.hash_groups(_sheeted(spark, sf))
    return g.select("sheet", "change_group", F.col("pages").cast("bigint").alias("pages"),
                    F.round("group_priority", 6).alias("group_priority"), "first_url")


@register
def sheet_rows(spark, sf):
    o = sh.order_sheets(sh.threshold(_sheeted(spark, sf), 0.25))
    return o.select("sheet", F.col("Index").cast("bigint").alias("idx"), "page_id",
                    F.round("analysis.priority", 6).alias("priority"), "error", "change_group")


@register
def top_changes(spark, sf):
    """SRT-04: the three first rows of every sheet."""
    o = sh.top_k(sh.order_sheets(sh.threshold(_sheeted(spark, sf), 0.25)), 3)
    return o.select("sheet", F.col("Index").cast("bigint").alias("idx"), "page_id")


@register
def status_sheet(spark, sf):
    """SHT-05 for the 7 days before the end of the fixture month."""
    from changelens.plans.status import status_sheet as build

    return build(tb.versions(spark, sf), tb.page_meta(spark, sf), _bodies(spark, sf), "2024-01-31")


@register
def decoded_bodies(spark, sf):
    """SRC-03: bodies in three charsets, stated by header, by meta element or not at all."""
    b = tb.encoded_pages(spark, sf)
    label = cs.charset(F.col("content"), F.col("content_type"))
    return b.select("page_id", label.alias("charset"), cs.decode(F.col("content"), label).alias("body"))


# ---------------------------------------------------------------- HTML blocks


def _marked_nodes(spark, sf, marks):
    """Nodes of the pages with extra markup (F8), with the page's url and news flag."""
    title = F.regexp_extract("html", r"<title>([^<]*)</title>", 1)
    p = tb.marked_pages(spark, sf, marks).withColumn("news", G.is_news_page(F.col("url"), title))
    return bk.parse_html(p, ["page_id", "url", "news"])


@register
def blocks(spark, sf):
    nodes = bk.parse_html(tb.table(spark, sf, "pages"), "page_id")
    return _numbered(bk.content_blocks(nodes), "text")


@register
def stripped_blocks(spark, sf):
    n = _marked_nodes(spark, sf, [m for m, _ in tb.STRIP_MARKS])
    return _numbered(bk.strip_blocks(bk.content_blocks(n), F.col("url"), F.col("news")), "text")


@register
def main_content(spark, sf):
    n = stage_table(_marked_nodes(spark, sf, tb.MAIN_MARKS), "nodes")
    m = bk.main_content(bk.content_blocks(n), bk.main_bounds(n, ["page_id"]), ["page_id"])
    return _numbered(m, "text", F.col("found").alias("found_content_area"))


@register
def readerable(spark, sf):
    n = stage_table(bk.parse_html(tb.table(spark, sf, "pages"), "page_id"), "nodes")
    key = ["page_id"]
    docs = n.where(F.col("kind") == "doc").select("page_id")
    main = bk.main_content(bk.content_blocks(n), bk.main_bounds(n, key), key)
    return bk.readerable(n, docs, key).withColumn("score", F.round("score", 6)).join(bk.readable(main, docs, key), key)


@register
def accordion_links(spark, sf):
    n = _marked_nodes(spark, sf, [m for m, _ in tb.LINK_MARKS]).where(F.col("kind") == "link")
    return _numbered(bk.fix_accordion_links(n), "href", "text")


@register
def page_media(spark, sf):
    """BLK-04 and BLK-08 on pages whose images and base the fixture adds."""
    n = _marked_nodes(spark, sf, ['<img src="pic.png" srcset="x 2x">', '<base href="/deep/er/"><img src="../pic.png">',
                                  "<base href='https://cdn.example.org/b/'><source src=a/b.webm><img>"])
    return _numbered(bk.media_urls(n, F.col("url")), "src")


@register
def ordered_diff(spark, sf):
    return dif.ordered_diff(_labelled(spark, sf))


@register
def ordered_script(spark, sf):
    """DIF-06 with order: a shortest script of every pair of documents."""
    return osc.ordered_script(_labelled(spark, sf)).select("pair_id", "seq", "op", "pos", "unit")


@register
def ordered_script_sizes(spark, sf):
    """What every shortest script agrees on: how many units stay, go and come."""
    n = lambda op: F.count(F.when(F.col("op") == op, 1))
    return osc.ordered_script(_labelled(spark, sf)).groupBy("pair_id").agg(n(0).alias("kept"), n(-1).alias("removed"), n(1).alias("added"))


# ---------------------------------------------------------------- deep search
DEEP_THRESHOLD = 0.5


def _deep_results(spark, sf):
    """The weekly deep job (frame 0): results with their changes."""
    a, b = FRAMES[0]
    return change_results(
        tb.versions(spark, sf), tb.page_meta(spark, sf), tb.table(spark, sf, "documents"), _bodies(spark, sf),
        a, b, _dictionary(spark), _stop_words(spark), deep=True, threshold=DEEP_THRESHOLD,
        html_ref="version_id", html_key="version_id")


@register
def deep_changes(spark, sf):
    r = _deep_results(spark, sf)
    return r.select("page_id", F.posexplode("changes").alias("n", "c")).select(
        "page_id", "n", F.col("c.a.version_id").alias("a_id"), F.col("c.b.version_id").alias("b_id"),
        F.round("c.analysis.priority", 6).alias("priority"))


@register
def deep_sheet_rows(spark, sf):
    """SHT-02 over the weekly deep job."""
    m = tb.page_meta(spark, sf).select("page_id", "url", "title", "tags", "maintainers")
    r = sh.threshold(sh.drop_no_change(_deep_results(spark, sf)), DEEP_THRESHOLD).join(m, "page_id", "left")
    rows = sh.deep_sheet_rows(sh.order_sheets(r, deep=True), run_time=F.lit("2024-02-01 00:00:00").cast("timestamp"))
    return rows.drop("_order", "_change")


# ---------------------------------------------------------------- streaming
from changelens.streaming import captures as stc  # noqa: E402


def _capture_feed(spark, sf):
    """The F1 captures as a file stream: the events table's own directory
    (the stream picks the events file by glob) projected to captures."""
    ev = tb.table(spark, sf, "events")
    s = stc.capture_stream(spark, sf, ev.schema, "events.parquet")
    return s.select(F.col("user_id").alias("page_id"), F.col("event_id").alias("version_id"),
                    F.col("ts").alias("capture_time"),
                    F.md5(F.concat(F.col("event_type"), F.lit("/"),
                                   F.floor(F.col("value") / 200).cast("bigint").cast("string"))).alias("body_hash"))


@register
def capture_dedup_stream(spark, sf):
    out = stc.run_available_now(stc.dedup_captures(_capture_feed(spark, sf)),
                                stage_path(spark, "dedup"), stage_path(spark, "dedup-state"))
    return out.select("page_id", "body_hash")


@register
def daily_changes_stream(spark, sf):
    out = stc.run_available_now(stc.daily_changes(_capture_feed(spark, sf)),
                                stage_path(spark, "daily"), stage_path(spark, "daily-state"))
    return out.select("page_id", F.col("day").cast("timestamp_ntz").alias("day"), F.col("captures").cast("bigint").alias("captures"))


@register
def daily_totals_stream(spark, sf):
    """STR-02 for all days, the newest included."""
    out = stc.run_daily_totals(_capture_feed(spark, sf), stage_path(spark, "totals"), stage_path(spark, "totals-state"))
    return out.select("page_id", F.col("day").cast("timestamp_ntz").alias("day"), "captures")


# ---------------------------------------------------------------- sinks and reloads
from changelens.sources import results_io as rio  # noqa: E402

RESHEET_TAGS = ["category:BUILDING", "category:MACHINERY"]
RESHEET_THRESHOLD = 0.3


@register
def results_roundtrip(spark, sf):
    """SNK-01 -> SRC-04 -> SRC-05: write the raw results, read them back,
    re-filter by tags and threshold."""
    raw = rio.raw_results(sh.drop_no_change(_results(spark, sf)),
                          tb.page_meta(spark, sf).select("page_id", "url", "title", "tags", "maintainers"))
    path = stage_path(spark, "raw-results")
    rio.write_results(raw, path)
    back = rio.read_results(spark, path, raw.schema)
    f = rio.refilter(back, RESHEET_TAGS, RESHEET_THRESHOLD)
    return f.select(F.col("page.page_id").alias("page_id"), F.col("page.url_key").alias("url_key"),
                    F.round("overall.priority", 6).alias("priority"), "error")


@register
def results_array_roundtrip(spark, sf):
    """SRC-04 in the array form: the raw results as one JSON array, read back."""
    raw = rio.raw_results(sh.drop_no_change(_results(spark, sf)),
                          tb.page_meta(spark, sf).select("page_id", "url", "title", "tags", "maintainers"))
    path = stage_path(spark, "raw-array")
    rio.write_results_array(stage_table(raw, "raw"), path, ["page"])
    f = rio.refilter(rio.read_results(spark, path, raw.schema, multiline=True), RESHEET_TAGS, RESHEET_THRESHOLD)
    return f.select(F.col("page.page_id").alias("page_id"), F.col("page.url_key").alias("url_key"),
                    F.round("overall.priority", 6).alias("priority"), "error")


@register
def sheet_files(spark, sf):
    """SHT-01 + SNK-02: write the formatted sheets as one CSV folder per
    sheet, read them back (all columns as text)."""
    o = sh.order_sheets(sh.threshold(_sheeted(spark, sf), 0.25))
    rows = sh.sheet_rows(o, run_time=F.lit("2024-02-01 00:00:00").cast("timestamp"))
    path = stage_path(spark, "sheets")
    rio.write_sheets(rows, path)
    back = spark.read.option("header", True).csv(path)
    # CSV tells null from empty only by quotes and trims blanks
    return back.select("sheet", *[F.trim(F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(c) for c in sh.SHEET_COLUMNS])


@register
def html_text_priority(spark, sf):
    """PRI-01 with the diffed text taken from the HTML (BLK-14)."""
    a, b = FRAMES[0]
    r = change_results(tb.versions(spark, sf), tb.page_meta(spark, sf), None, _bodies(spark, sf),
                       a, b, _dictionary(spark), _stop_words(spark), html_ref="version_id", html_key="version_id")
    return r.where(F.col("analysis").isNotNull()).select(
        "page_id", F.round("analysis.priority", 6).alias("priority"),
        F.col("analysis.text.readable").alias("readable"),
        F.col("analysis.text.found_content_area").alias("found_content_area"),
        F.col("analysis.text.diff_count").alias("text_diff_count"))
