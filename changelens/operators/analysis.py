"""Pair analysis: gate, links, text, source, status, redirects, priority
(FLT-07, DIF-01/02/07, STA-*, RED-01, PRI-01/02).

Input is the endpoint table of ``versions.endpoints``: one row per key with
``n_versions`` and the oldest/newest capture structs ``a``/``b``.  Bodies are
joined *after* the gate, only for pairs that pass it and only for the two
ends, each body once per end.  Metrics come back as left joins, so pairs on
metadata-only hosts keep NULL link/text/source structs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelens.functions import gates as G
from changelens.functions import redirects as R
from changelens.functions import status as ST
from changelens.functions import text as tx
from changelens.functions import urls as U
from changelens.operators import automaton
from changelens.operators import blocks as bk
from changelens.operators import diffs as dif
from changelens.operators import digests as dg
from changelens.operators import terms as trm
from changelens.operators.bodies import bodies_of
from changelens.session import stage_table


def stage(df: DataFrame, name: str, enabled: bool = True) -> DataFrame:
    return stage_table(df, name) if enabled else df

VIEW_URL = "https://monitor.example.org/page/{page}/{a}..{b}"


def ends(pairs: DataFrame, key: str = "page_id", more: tuple[str, ...] = ()) -> DataFrame:
    """(pair_id, ``more``, side, v, content) for both ends."""
    return pairs.select(F.col(key).alias("pair_id"), *more, F.inline(F.array(
        F.struct(F.lit("a").alias("side"), F.col("a").alias("v"), F.col("content").alias("content")),
        F.struct(F.lit("b").alias("side"), F.col("b").alias("v"), F.col("content").alias("content")))))


def _join_body(e: DataFrame, bodies: DataFrame, ref: str, body_key: str, body_col: str) -> DataFrame:
    """Late body join: the narrow ends (pair, side, body ref, URL, title,
    content flag) meet the body table, each body read once per end.  The ends
    are a result of their own size, which AQE knows: it broadcasts them when
    they are small and shuffles both sides when they are not."""
    narrow = e.select("pair_id", "side", F.col(f"v.{ref}").alias("_ref"), F.col("v.url").alias("url"),
                      F.col("v.title").alias("title"), "content")
    b = bodies_of(bodies, narrow.select("_ref"), body_key).select(F.col(body_key).alias("_ref"), F.col(body_col).alias("_body"))
    return narrow.join(b, "_ref").drop("_ref")


DOC = ["pair_id", "side"]


def html_nodes(e_html: DataFrame, rules: list[bk.StripRule] = bk.STRIP_RULES, kinds: list[str] | None = None) -> DataFrame:
    """The parse of both ends' bodies, once: node rows (BLK-01) with pair_id,
    side, url, news, content and the client redirect (SC-08), all or those of
    ``kinds``.  Bodies of pairs that are not content-analysable (FLT-06) are
    not parsed further."""
    e = e_html.select(
        *DOC, "url", G.is_news_page(F.col("url"), F.col("title")).alias("news"), "content",
        R.client_redirect(F.col("_body")).alias("client"),
        F.when(F.col("content") | F.col("_body").isNull(), F.col("_body")).otherwise(F.lit("")).alias("_body"))
    return bk.parse_html(e, [*DOC, "url", "news", "content", "client"], "_body", rules, DOC, kinds)


def link_units(nodes: DataFrame, rules: list[bk.StripRule] = bk.STRIP_RULES) -> DataFrame:
    n = nodes.where(F.col("content") & ~bk.is_stripped(F.col("url"), F.col("news"), rules))
    return bk.links(n, F.col("url")).select(
        *DOC, F.lit("link").alias("kind"), "pos", F.concat("href", F.lit("\t"), "text").alias("unit"))


def html_units(nodes: DataFrame, rules: list[bk.StripRule] = bk.STRIP_RULES) -> DataFrame:
    """(pair_id, side, kind, pos, unit): 'link' units are href TAB text
    (BLK-02/03, SC-01), 'source' units the cleaned source (DIF-07, BLK-05..07)."""
    n = nodes.where(F.col("content"))
    url, news = F.col("url"), F.col("news")
    # Empty units go as elements of an array: a filter on the unit would work it out twice.
    one = F.array_remove(F.array(bk.source_unit(url)), "")
    source = n.where(bk.is_source(url, news, rules)).select(
        *DOC, F.lit("source").alias("kind"), "pos", F.explode(one).alias("unit")).where(F.col("unit").isNotNull())
    return link_units(nodes, rules).unionByName(source)


def html_text_units(nodes: DataFrame, rules: list[bk.StripRule] = bk.STRIP_RULES) -> tuple[DataFrame, DataFrame]:
    """BLK-14: text units taken from the HTML itself.

    Per end: content blocks (BLK-05) without boilerplate (BLK-07).  When both
    ends have a content area (BLK-09) only its blocks are diffed: 'yes' when
    both are also readerable (BLK-11; invisible blocks are left out then),
    else 'fallback-yes' / 'fallback-no' (BLK-10); otherwise the whole page
    ('no').  Returns (units, per-pair flags)."""
    url, news = F.col("url"), F.col("news")
    n = nodes.where(F.col("content"))
    kept = n.where(~bk.is_stripped(url, news, rules) & ~bk.inside("unsourced"))
    docs = n.where(F.col("kind") == "doc").select(*DOC, "url")
    bounds = bk.main_bounds(kept.where(F.col("kind").isin("element", "comment", "text", "doc")), DOC)
    blocks = bk.content_blocks(kept)
    choice = bk.text_choice(bk.main_content(blocks, bounds, DOC), n, bounds, docs, DOC, url)
    flags = choice.groupBy("pair_id").agg(*[F.min(c).alias(c) for c in ("found", "readable", "readerable")]).select(
        "pair_id", F.col("found").alias("found_content_area"),
        F.when(~F.col("found"), F.lit("no")).when(F.col("readerable"), F.lit("yes"))
        .when(F.col("readable"), F.lit("fallback-yes")).otherwise(F.lit("fallback-no")).alias("readable"))
    p = F.col("pos")
    in_main = (p > F.col("after")) & (p < F.col("until")) & (
        F.col("main_pos").isNull() | p.between(F.col("main_pos"), F.col("main_last")))
    shown = ~F.col("hidden") & ~bk.inside("unshown")
    units = (blocks.join(bounds.drop("found"), DOC).join(flags, "pair_id")
             .where((F.col("readable") == "no") | (in_main & ((F.col("readable") != "yes") | shown)))
             .select(*DOC, "pos", F.trim(tx.normalize_text(F.col("text"))).alias("unit")).where(F.col("unit") != ""))
    return units, flags


def text_units(e_text: DataFrame) -> DataFrame:
    return e_text.select("pair_id", "side", F.inline(tx.normalized_lines(F.col("_body"))))


def count_metrics(labelled: DataFrame) -> DataFrame:
    """Per pair: n changed units, ratio changed/(unchanged once + changed), hash."""
    changed = F.col("op") != 0
    g = labelled.groupBy("pair_id").agg(
        F.count(F.when(changed, 1)).alias("_n"),
        F.count(F.when(changed | (F.col("side") == "a"), 1)).alias("_t"),
        F.sum(F.when(changed, dif.unit_hash_part(F.col("op"), F.col("unit")))).alias("_hs"),
    )
    return g.select(
        "pair_id",
        F.col("_n").cast("bigint").alias("diff_length"),
        F.coalesce(F.round(F.col("_n") / F.nullif(F.col("_t"), F.lit(0)), 4), F.lit(0.0)).cast("double").alias("diff_ratio"),
        dif.multiset_hash(F.col("_n"), F.col("_hs")).alias("diff_hash"),
    )


def html_metrics(labelled: DataFrame, pairs: DataFrame, key: str = "page_id") -> DataFrame:
    """DIF-01/02/07 per pair from the labelled units of both kinds (with their
    runs): ``links`` as of ``count_metrics`` with ``removed_self_link``, ``source``
    as of ``source_metrics``.

    Units are combined where ``label_units`` brought them; no rows are staged."""
    selfs = pairs.select(
        F.col(key).alias("pair_id"),
        U.normalize_url(F.col("a.url"), F.col("a.url")).alias("_sa"),
        U.normalize_url(F.col("b.url"), F.col("b.url")).alias("_sb")).dropDuplicates(["pair_id"])
    changed, link = F.col("op") != 0, F.col("kind") == "link"
    href = F.substring_index("unit", "\t", 1)
    own = link & (F.col("op") == -1) & ((href == F.col("_sa")) | (href == F.col("_sb")))
    sized = labelled.join(selfs, "pair_id", "left").select(
        "pair_id", link.alias("_link"), "side", "run_id", changed.alias("_changed"), F.length("unit").alias("_len"),
        F.when(changed, dif.unit_hash_part(F.col("op"), F.col("unit"))).alias("_h"), F.coalesce(own, F.lit(False)).alias("_own"))
    per_run = sized.groupBy("pair_id", "_link", "side", "run_id", "_changed").agg(
        F.sum("_len").alias("_len"), F.count("*").alias("_units"), F.sum("_h").alias("_h"), F.max("_own").alias("_own"))
    ln, ch, shown = F.col("_link"), F.col("_changed"), F.col("_changed") | (F.col("side") == "a")
    total = lambda c, where: F.coalesce(F.sum(F.when(where, F.col(c))), F.lit(0))
    length = F.col("_len") + F.col("_units") - 1
    m = per_run.groupBy("pair_id").agg(
        total("_units", ln & ch).alias("_ln"), total("_units", ln & shown).alias("_lt"), F.sum(F.when(ln, F.col("_h"))).alias("_lh"),
        F.max("_own").alias("_own"),
        total("_units", ~ln & ch).alias("_sn"), total("_len", ~ln & ch).alias("_sc"), total("_len", ~ln & shown).alias("_st"),
        F.sum(F.when(~ln, F.col("_h"))).alias("_sh"), F.count(F.when(~ln & ch, 1)).alias("_runs"),
        F.coalesce(F.sum(F.when(~ln & ch, length)), F.lit(0)).alias("_sl"))
    ratio = lambda n, t: F.coalesce(F.round(F.col(n) / F.nullif(F.col(t), F.lit(0)), 4), F.lit(0.0)).cast("double")
    return m.select(
        "pair_id",
        F.struct(dif.multiset_hash(F.col("_ln"), F.col("_lh")).alias("diff_hash"), F.col("_ln").cast("bigint").alias("diff_length"),
                 ratio("_ln", "_lt").alias("diff_ratio"), F.col("_own").alias("removed_self_link")).alias("links"),
        F.struct(dif.multiset_hash(F.col("_sn"), F.col("_sh")).alias("diff_hash"), F.col("_runs").cast("bigint").alias("diff_count"),
                 F.col("_sl").cast("bigint").alias("diff_length"), ratio("_sc", "_st").alias("diff_ratio")).alias("source"))


def source_metrics(labelled: DataFrame) -> DataFrame:
    m = dif.text_metrics(labelled)
    return m.select("pair_id", "diff_hash", "diff_count", "diff_length",
                    F.col("percent_changed").alias("diff_ratio"))


def priority_factor(r: Column) -> Column:
    """SC-10: ln(1 + (e - 1) r)."""
    return F.log1p(F.lit(math.e - 1) * r)


def priority(content: Column, links_len: Column, links_ratio: Column, removed_self: Column,
             kt_changed: Column, kt_count: Column, t_count: Column, t_percent: Column, t_max: Column,
             st_changed: Column, st_factor: Column, change_type: Column, home: Column) -> Column:
    """PRI-01, the reference's weights (fixed values)."""
    ll = F.coalesce(links_len, F.lit(0))
    tc = F.coalesce(t_count, F.lit(0))
    tm = F.coalesce(t_max, F.lit(0))
    p = F.lit(0.0)
    p = p + F.when(content & (ll > 0), 0.3 * priority_factor(links_ratio)).otherwise(0.0)
    p = p + F.when(content & F.coalesce(removed_self, F.lit(False)), 0.75).otherwise(0.0)
    p = p + F.when(content & F.coalesce(kt_changed, F.lit(False)), F.least(F.lit(0.4), 0.05 * kt_count)).otherwise(0.0)
    p = p + F.when(content & (tc > 0), 0.65 * priority_factor(t_percent)).otherwise(0.0)
    p = p + F.when(content & (tm > 100), 0.35 * (F.least(tm, F.lit(600)) - 100) / 500).otherwise(0.0)
    base = F.greatest(F.when(content & (ll > 0), 0.1).otherwise(0.0),
                      F.when(content & (tc > 0) & (ll > 0), 0.125).otherwise(0.0))
    p = F.when(st_changed, p + 1).otherwise(p * st_factor)
    p = p + F.when(change_type == "domain", 1.0).when(change_type == "path", 0.5).otherwise(0.0)
    p = F.greatest(p, base)
    p = F.when(home, p * 0.25).otherwise(p)
    return F.greatest(F.least(p, F.lit(1.0)), F.lit(0.0))


def effective(v: str, client: Column, fields: list[str], overrides: list[tuple] | None = None) -> Column:
    c = F.col(v)
    return ST.effective_status(c["url"], c["status"], c["network_error"], c["title"],
                               c["headers"] if "headers" in fields else None,
                               R.all_redirects(c["redirects"], client), overrides)


def analyze_pairs(pairs: DataFrame, pages: DataFrame, text_bodies: DataFrame, html_bodies: DataFrame,
                  dictionary: DataFrame | None = None, stop_words: DataFrame | None = None,
                  key: str = "page_id", text_ref: str = "doc_id", html_ref: str = "html_id",
                  text_key: str = "doc_id", text_col: str = "text",
                  html_key: str = "html_id", html_col: str = "html",
                  view_url: str = VIEW_URL, strip_rules: list[bk.StripRule] = bk.STRIP_RULES,
                  status_overrides: list[tuple] | None = None, store=None, terms=None) -> DataFrame:
    """PRI-01/02: one result row per key: gate error or the analysis struct.

    ``pages`` gives (key, url[, title]) of the catalogue; ``text_bodies`` and
    ``html_bodies`` are looked up through the capture fields ``text_ref`` /
    ``html_ref`` (both may be the same table keyed by version id); either may
    be a function of the wanted keys (``bodies_of``).
    ``strip_rules`` (``blocks.read_strip_rules`` reads a table) and
    ``status_overrides`` (``status.read_overrides``) replace the defaults.
    With ``store`` (``store.body_store``) bodies are looked up there instead;
    ``terms`` are the word lists of the dictionary (``automaton.collected``) whose words it knows.
    """
    kind, msg = G.gate(F.col("n_versions"))
    page_status = F.col("status") if "status" in pages.columns else F.lit(None)
    pg = pages.select(F.col(key), F.col("url").alias("page_url"), page_status.cast("int").alias("page_status"))
    p = (pairs.join(pg, key, "left")
         .withColumn("error_kind", kind).withColumn("error", msg)
         .withColumn("content", G.is_content_analyzable(F.coalesce(F.col("page_url"), F.col("b.url")))))
    ok = p.where(F.col("error_kind").isNull())
    e = ends(ok.select(key, "a", "b", "content"), key)

    # HTML bodies, read and parsed once: links, source, text blocks, client redirects.
    nodes = None
    # In a store the texts are measured where they are looked up, if its words are those of all terms.
    measured_text = store is not None and text_bodies is not None and (dictionary is None or terms is not None)
    if store is None:
        nodes = stage(html_nodes(_join_body(e, html_bodies, html_ref, html_key, html_col), strip_rules), "html_nodes")
        client = nodes.where(F.col("kind") == "doc").groupBy("pair_id").agg(
            F.max(F.when(F.col("side") == "a", F.col("client"))).alias("a_client"),
            F.max(F.when(F.col("side") == "b", F.col("client"))).alias("b_client"),
            F.count("*").alias("_ends"))
        of_kind = ("pair_id", "kind")
        html = stage(html_metrics(dif.with_runs(dif.label_units(html_units(nodes, strip_rules), of_kind), of_kind), ok, key), "html_metrics")
        of_html = [client, html]
    else:
        own = [dg.prefix(U.normalize_url(F.col(f"{s}.url"), F.col(f"{s}.url"))).alias(f"self_{s}") for s in "ab"]
        metrics = stage(store.pair_metrics(ends(ok.select(key, "a", "b", "content", *own), key, ("self_a", "self_b")), html_ref,
                                           text_ref if measured_text else None), "pair_metrics")
        of_html = [metrics.select("pair_id", "a_client", "b_client", F.col("ends").alias("_ends"), *dg.html_columns())]
        if text_bodies is None:
            nodes = stage(store.html_nodes(e, html_ref), "html_nodes")

    # Text: lines of the text bodies, or blocks of the HTML (BLK-14).
    text_flags = None
    if measured_text:
        text = metrics.select("pair_id", *dg.text_columns())
    else:
        if text_bodies is not None:
            read_text = e.where("content")
            tu = text_units(_join_body(read_text, text_bodies, text_ref, text_key, text_col)) if store is None else store.text_units(read_text, text_ref)
        else:
            tu, text_flags = html_text_units(nodes, strip_rules)
        labelled = stage(trm.with_lines(dif.with_runs(dif.label_units(tu))), "text_labelled")
        text = dif.text_metrics(labelled)
    if text_flags is not None:
        text = text.join(text_flags, "pair_id", "left")
    else:
        text = text.select("*", F.lit("no").alias("readable"), F.lit(False).alias("found_content_area"))
    if dictionary is not None:
        sw = stop_words if stop_words is not None else trm.default_stop_words(pairs.sparkSession)
        if measured_text:
            lines = metrics.select("pair_id", F.inline("lines")).withColumn("repeated", F.lit(False))
            again = metrics.where("repeated").select("pair_id")
            if not again.isEmpty():  # several texts of an end share places: all their words count
                tu = store.text_units(e.where("content").join(again, "pair_id", "left_semi"), text_ref)
                lines = lines.unionByName(trm.with_lines(dif.label_units(tu)).select(lines.columns))
            ngrams = automaton.term_hits(lines, *terms)
        else:
            ngrams = trm.changed_ngrams(labelled, dictionary, sw)
        kt = trm.key_term_summary(trm.key_term_net(ngrams))
        text = text.join(kt, "pair_id", "left")
    else:
        text = text.select("*", F.lit(None).cast("map<string,bigint>").alias("key_terms"),
                           F.lit(None).cast("boolean").alias("key_terms_changed"),
                           F.lit(None).cast("bigint").alias("key_terms_change_count"))

    t = F.col
    j = ok
    for part in of_html:
        j = j.join(part.withColumnRenamed("pair_id", key), key, "left")
    j = (j.join(text.select(t("pair_id").alias(key), F.struct(
             F.coalesce(t("readable"), F.lit("no")).alias("readable"),
             F.coalesce(t("found_content_area"), F.lit(False)).alias("found_content_area"),
             F.coalesce(t("key_terms"), F.create_map().cast("map<string,bigint>")).alias("key_terms"),
             F.coalesce(t("key_terms_changed"), F.lit(False)).alias("key_terms_changed"),
             F.coalesce(t("key_terms_change_count"), F.lit(0)).cast("bigint").alias("key_terms_change_count"),
             "percent_changed", "diff_hash", "diff_count", "diff_length", "diff_max_length").alias("text")), key, "left"))
    # Content pairs without any text units still get an (empty) text result.
    empty_text = F.struct(
        F.lit("no").alias("readable"), F.lit(False).alias("found_content_area"),
        F.create_map().cast("map<string,bigint>").alias("key_terms"), F.lit(False).alias("key_terms_changed"),
        F.lit(0).cast("bigint").alias("key_terms_change_count"), F.lit(0.0).alias("percent_changed"),
        F.lit(dif.EMPTY_HASH).alias("diff_hash"), F.lit(0).cast("bigint").alias("diff_count"),
        F.lit(0).cast("bigint").alias("diff_length"), F.lit(0).cast("bigint").alias("diff_max_length"))
    j = j.withColumn("text", F.when(t("content"), F.coalesce(t("text"), empty_text)))
    j = j.withColumn("links", F.when(t("content"), F.coalesce(t("links"), F.struct(
        F.lit(dif.EMPTY_HASH).alias("diff_hash"), F.lit(0).cast("bigint").alias("diff_length"),
        F.lit(0.0).alias("diff_ratio"), F.lit(False).alias("removed_self_link")))))
    j = j.withColumn("source", F.when(t("content"), F.coalesce(t("source"), F.struct(
        F.lit(dif.EMPTY_HASH).alias("diff_hash"), F.lit(0).cast("bigint").alias("diff_count"),
        F.lit(0).cast("bigint").alias("diff_length"), F.lit(0.0).alias("diff_ratio")))))

    fields = pairs.schema["a"].dataType.fieldNames()
    j = (j.withColumn("status_a", effective("a", t("a_client"), fields, status_overrides))
          .withColumn("status_b", effective("b", t("b_client"), fields, status_overrides))
          .withColumn("redirect", R.compare(t("a.url"), t("a.redirects"), t("a_client"),
                                            t("b.url"), t("b.redirects"), t("b_client"))))
    home = U.is_home_page(F.coalesce(t("page_url"), t("b.url")))
    st_changed = ST.status_changed(t("status_a"), t("status_b"))
    prio = priority(t("content"), t("links.diff_length"), t("links.diff_ratio"), t("links.removed_self_link"),
                    t("text.key_terms_changed"), t("text.key_terms_change_count"), t("text.diff_count"),
                    t("text.percent_changed"), t("text.diff_max_length"),
                    st_changed, ST.status_factor(t("status_a"), t("status_b")), t("redirect.change_type"), home)
    vu = F.format_string(view_url.replace("{page}", "%s").replace("{a}", "%s").replace("{b}", "%s"),
                         t(key).cast("string"), t("a.version_id").cast("string"), t("b.version_id").cast("string"))
    analysis = F.struct(
        prio.alias("priority"), t("n_versions").alias("versions"), home.alias("root_page"),
        F.coalesce(t("page_status"), t("b.status")).alias("status"), st_changed.alias("status_changed"),
        t("status_a"), t("status_b"), vu.alias("view_url"),
        t("links"), t("source"), t("text"), t("redirect"))
    # PRI-02: a pair with an end whose body is missing or unreadable failed.
    whole = F.coalesce(t("_ends"), F.lit(0)) == 2
    done = j.select(
        key, "n_versions", "a", "b", F.when(~whole, F.lit("failed")).alias("error_kind"),
        F.when(~whole, F.lit("A capture's body is missing or cannot be read")).alias("error"),
        F.when(whole, analysis).alias("analysis"))
    failed = p.where(F.col("error_kind").isNotNull()).select(
        key, "n_versions", "a", "b", "error_kind", "error",
        F.lit(None).cast(done.schema["analysis"].dataType).alias("analysis"))
    return done.unionByName(failed)
