"""Deep search: narrow a changed timeframe down to its individual changes
(VER-08, VER-09).

Level-synchronous bisection.  A *node* is a version list (rows keyed by
``node``).  Each round splits every node with >= 3 versions at n // 2 into an
older and a newer half (the split capture belongs to both), skips halves
whose end captures have the same body hash, re-selects and re-trims each
half inside (oldest + 1 min, newest + 1 min), analyses **all** halves of the
round in one job and keeps those with priority >= threshold (floor 0.2).
Kept halves become the next round's nodes.  At the end a kept node is a
change when no kept node names it as parent (anti join), in depth-first
order, older half first (path strings sort that way).

The driver loops over rounds only, until no half is left (about log2 of the
most versions of a page); every round's survivors are written to the shared
checkpoint folder, so plans stay small and a lost executor costs at most one
round.  Captures and bodies are read before the first round and never again:
rounds look them up in a ``store.BodyStore``, where every distinct body is
parsed once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelens.functions import gates as G
from changelens.operators import analysis as an
from changelens.operators import automaton
from changelens.operators import store as st
from changelens.operators import terms as trm
from changelens.operators import versions as ver
from changelens.operators.sequence import with_rank
from changelens.session import drop_since, stage_table, staged_since

MIN_THRESHOLD = 0.2


def _split(nodes: DataFrame, sizes: DataFrame, name: str) -> DataFrame:
    """Rows of the two halves of every node with >= 3 rows; child node key =
    parent key + '/0' (older half) or '/1' (newer half).  Rows are numbered
    from sorted ranges: at round 1 a node is a page's whole selection."""
    many = nodes.join(sizes.where("_n >= 3"), "node")
    x = with_rank(many, ["node"], [F.desc("capture_time"), F.desc("version_id")], name)
    at, s = F.col(name) - 1, F.floor(F.col("_n") / 2)
    halves = F.when(at == s, F.array(F.lit("0"), F.lit("1"))).when(
        at > s, F.array(F.lit("0"))).otherwise(F.array(F.lit("1")))
    y = x.select("*", F.explode(halves).alias("_half"))
    return y.select(*[c for c in nodes.columns if c not in ("node", "parent")],
                    F.col("node").alias("parent"), F.concat(F.col("node"), F.lit("/"), F.col("_half")).alias("node"))


def term_lists(spark, dictionary: DataFrame | None, stop_words: DataFrame | None) -> tuple[list[str], set[str]] | None:
    """The word lists of the terms, None without any or where they are beyond the automaton's bounds."""
    if dictionary is None:
        return None
    return automaton.collected(dictionary, trm.default_stop_words(spark) if stop_words is None else stop_words)


def overall_results(pairs: DataFrame, pages: DataFrame, text_bodies: DataFrame, html_bodies: DataFrame, dictionary=None,
                    stop_words=None, key: str = "page_id", strip_rules=None, status_overrides=None, **body_refs) -> DataFrame:
    """``analyze_pairs`` of the whole timeframe, through a store of the ends alone: the search parses them again only
    with the captures in between."""
    terms = term_lists(pairs.sparkSession, dictionary, stop_words)
    more = {} if strip_rules is None else {"strip_rules": strip_rules}
    kind, _ = G.gate(F.col("n_versions"))
    ends = pairs.where(kind.isNull()).select(F.col(key).alias("page_id"), F.inline(F.array("a", "b")))
    url = pages.select(key, F.col("url").alias("_url"))
    urls = pairs.join(url, key, "left").select(F.col(key).alias("page_id"), F.coalesce("_url", "b.url").alias("url"))
    store = st.body_store(ends, urls, html_bodies, text_bodies, **more, **body_refs, words=automaton.words_of(*terms) if terms else None)
    return an.analyze_pairs(pairs, pages, text_bodies, html_bodies, dictionary, stop_words, key=key, store=store, terms=terms,
                            status_overrides=status_overrides, **more, **body_refs)


def deep_changes(results: DataFrame, trimmed: DataFrame, v: DataFrame, pages: DataFrame, text_bodies: DataFrame,
                 html_bodies: DataFrame, threshold: float, dictionary=None, stop_words=None, strip_rules=None,
                 status_overrides=None, **body_refs) -> DataFrame:
    """Sub-changes of every result whose overall priority >= threshold.

    ``results``: output of ``analyze_pairs`` keyed by ``page_id``;
    ``trimmed``: the (narrow) trimmed selection the results came from; ``v``:
    the captures, for the fields of the halves' ends.
    Returns (page_id, node, depth, n_versions, a, b, analysis, error); rows
    with an error are halves whose analysis failed.  A node has fewer rows
    than its parent, so the rounds end."""
    t = max(MIN_THRESHOLD, threshold)
    gate = results.where(F.col("analysis.priority") >= F.lit(threshold)).select("page_id")
    cols = [c for c in trimmed.columns if c not in ("is_baseline",)]
    nodes = (trimmed.join(gate, "page_id", "left_semi").select(*cols)
             .withColumn("node", F.col("page_id").cast("string")).withColumn("parent", F.lit(None).cast("string")))
    page_urls = pages.select("page_id", "url")
    own = trimmed.join(gate, "page_id", "left_semi").select("version_id")
    more = {} if strip_rules is None else {"strip_rules": strip_rules}
    spark = v.sparkSession
    terms = term_lists(spark, dictionary, stop_words)
    first = len(staged_since(spark))
    store = st.body_store(v.join(own, "version_id", "left_semi"), page_urls, html_bodies, text_bodies, **more, **body_refs,
                          words=automaton.words_of(*terms) if terms else None)
    kept, failed, depth = None, None, 0
    while True:
        depth += 1
        before = len(staged_since(spark))
        sizes = nodes.groupBy("node").agg(F.count("*").alias("_n"))
        halves = _split(nodes, sizes, f"deep-{depth}-half")
        ends = halves.groupBy("node").agg(
            F.min(F.struct("capture_time", "version_id", "body_hash")).alias("_o"),
            F.max(F.struct("capture_time", "version_id", "body_hash")).alias("_e"))
        ends = ends.where(~F.col("_o.body_hash").eqNullSafe(F.col("_e.body_hash"))).select(
            "node", (F.col("_o.capture_time") + F.expr("INTERVAL 1 MINUTE")).alias("_after"),
            (F.col("_e.capture_time") + F.expr("INTERVAL 1 MINUTE")).alias("_before"))
        cand = stage_table(halves.join(ends, "node"), f"deep-{depth}-cand")
        if cand.isEmpty():
            break
        tr = stage_table(ver.select_and_trim(cand, F.col("_after"), F.col("_before"), key="node")
                         .drop("_after", "_before", "is_baseline"), f"deep-{depth}")
        pairs = ver.widen(ver.endpoints(tr.drop("parent", "page_id"), key="node").where(F.col("n_versions") >= 2),
                          store.captures.drop("page_id"), key="node")
        pairs = stage_table(pairs, f"deep-{depth}-pairs")
        info = tr.select("node", "parent", "page_id").distinct()
        node_pages = info.join(page_urls, "page_id").select("node", "url")
        res = an.analyze_pairs(pairs, node_pages, text_bodies, html_bodies,
                               dictionary, stop_words, key="node", store=store, terms=terms, status_overrides=status_overrides, **more, **body_refs)
        # All halves are written before they are chosen: a filter on the priority would work every analysis out twice.
        done = stage_table(res.join(info, "node").withColumn("depth", F.lit(depth)), f"deep-done-{depth}")
        passed = done.where((F.col("analysis.priority") >= F.lit(t)) | (F.col("error_kind") == "failed"))
        bad, good = passed.where(F.col("analysis").isNull()), passed.where(F.col("analysis").isNotNull())
        kept = good if kept is None else kept.unionByName(good)
        failed = bad if failed is None else failed.unionByName(bad)
        if good.isEmpty():
            break
        # The next round reads what is kept of this one; the rest of it goes.
        nodes = stage_table(tr.join(good.select("node"), "node", "left_semi"), f"deep-{depth}-nodes")
        drop_since(spark, before, (f"deep-done-{depth}", f"deep-{depth}-nodes"))
    drop_since(spark, first, tuple(f"deep-done-{d}" for d in range(1, depth + 1)))
    if kept is None:
        kept = results.where("false").select(
            "*", F.lit("").alias("node"), F.lit("").alias("parent"), F.lit(0).alias("depth"))
        failed = kept
    leaves = kept.join(kept.select(F.col("parent").alias("node")).distinct(), "node", "left_anti")
    return leaves.unionByName(failed).select("page_id", "node", "depth", "n_versions", "a", "b", "analysis", "error")


def with_changes(results: DataFrame, found: DataFrame, key: str = "page_id") -> DataFrame:
    """``results`` with ``changes`` (array of a, b, analysis; older first, by
    depth-first node path), and the error of a page with a failed half.  The
    changes of one page are as many as its captures at most."""
    per_page = found.groupBy(key).agg(
        F.array_sort(F.collect_list(F.when(F.col("analysis").isNotNull(), F.col("node")))).alias("_nodes"),
        F.map_from_entries(F.collect_list(F.when(F.col("analysis").isNotNull(), F.struct("node", F.struct("a", "b", "analysis"))))).alias("_of"),
        F.max("error").alias("_half"))
    joined = results.join(per_page, key, "left")
    none = F.filter(F.array(F.struct("a", "b", "analysis")), lambda _: F.lit(False))
    return joined.select(
        *[c for c in results.columns if c not in ("error", "error_kind")],
        F.coalesce("error_kind", F.when(F.col("_half").isNotNull(), F.lit("failed"))).alias("error_kind"),
        F.coalesce("error", "_half").alias("error"),
        F.coalesce(F.transform("_nodes", lambda n: F.element_at("_of", n)), none).alias("changes"))
