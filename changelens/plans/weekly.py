"""Weekly change sheets (the reference's main job) as one Spark plan.

versions -> selection -> trim -> endpoints -> gate -> late body joins ->
link/text/source/terms metrics -> status/redirect -> priority.  Nothing is
collected; the only actions are the dictionary size checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from changelens.functions import status as ST
from changelens.operators import analysis as an
from changelens.operators import blocks as bk
from changelens.operators import deep as dp
from changelens.operators import versions as ver
from changelens.operators.catalog import select_pages
from changelens.session import drop_since, stage_scope, stage_table, staged_since


def change_results(v: DataFrame, pages: DataFrame, text_bodies: DataFrame, html_bodies: DataFrame,
                   after, before, dictionary: DataFrame | None = None, stop_words: DataFrame | None = None,
                   key: str = "page_id", url_pattern: str | None = None, tags: list[str] | None = None,
                   deep: bool = False, threshold: float = 0.25, strip_rules=None, status_overrides=None,
                   **body_refs) -> DataFrame:
    """One row per page with captures: gate error or analysis.  ``url_pattern``
    and ``tags`` choose pages (SRC-01).  ``deep`` adds ``changes``: the parts
    of each result with priority >= ``threshold``, older first (VER-08/09).
    ``strip_rules`` and ``status_overrides`` are rule lists, or tables of them."""
    if isinstance(strip_rules, DataFrame):
        strip_rules = bk.read_strip_rules(strip_rules)
    if isinstance(status_overrides, DataFrame):
        status_overrides = ST.read_overrides(status_overrides)
    rules = {"status_overrides": status_overrides} | ({} if strip_rules is None else {"strip_rules": strip_rules})
    if url_pattern or tags:
        pages = select_pages(pages, url_pattern, tags)
        v = v.join(pages.select(key), key, "left_semi")
    # Selection runs on the narrow capture columns; the wide fields are
    # fetched for the two end captures of each page only.
    spark = v.sparkSession
    since = len(staged_since(spark))
    trimmed = ver.select_and_trim(ver.narrow(v, key), after, before, key=key)
    if deep:
        trimmed = stage_table(trimmed, "trimmed")
    pairs = stage_table(ver.widen(ver.endpoints(trimmed, key=key), v, key=key), "pairs")
    analyze = dp.overall_results if deep else an.analyze_pairs
    results = analyze(pairs, pages, text_bodies, html_bodies, dictionary, stop_words, key=key, **rules, **body_refs)
    if not deep:
        return results
    results = stage_table(results, "results")
    drop_since(spark, since, ("trimmed", "results"))
    found = dp.deep_changes(results, trimmed, v, pages, text_bodies, html_bodies, threshold, dictionary, stop_words, **rules, **body_refs)
    return dp.with_changes(results, found, key)


def weekly_job(spark: SparkSession, v: DataFrame, pages: DataFrame, text_bodies: DataFrame, html_bodies: DataFrame,
               after, before, out_dir: str, threshold: float = 0.0, deep: bool = False, **how) -> None:
    """``change_results`` and ``write_outputs`` as one job that leaves nothing
    but its outputs: what it stages is deleted at its end."""
    with stage_scope(spark):
        results = change_results(v, pages, text_bodies, html_bodies, after, before, deep=deep, **how, **({"threshold": threshold} if deep else {}))
        write_outputs(stage_table(results, "results"), pages, out_dir, threshold, deep)


def write_outputs(results: DataFrame, pages: DataFrame, out_dir: str, threshold: float = 0.0,
                  deep: bool = False, key: str = "page_id") -> None:
    """The job's outputs, all written by Spark writers:

    * ``_results.json.gz/`` raw results, no-change rows dropped (SNK-01);
    * ``sheets/sheet=<name>/`` one CSV per sheet, threshold applied (SNK-02);
    * ``_redirects-changed/`` and ``_redirects-current/`` (SNK-03/04).
    """
    from pyspark.sql import functions as F

    from changelens.operators import sheets as sh
    from changelens.sources import results_io as rio

    kept = sh.drop_no_change(results)
    meta = pages.select(key, "url", "title", "tags", "maintainers")
    rio.write_results(rio.raw_results(kept, meta, key), f"{out_dir}/_results.json.gz")
    joined = kept.join(meta, key, "left")
    ordered = sh.order_sheets(sh.threshold(joined, threshold), deep=deep)
    rio.write_sheets((sh.deep_sheet_rows if deep else sh.sheet_rows)(ordered, key), f"{out_dir}/sheets")
    with_sheet = joined.withColumn("sheet", sh.sheet_key(F.col("tags")))
    changed = sh.redirect_changes(with_sheet, key)
    rio.write_csv(changed.withColumn("_cat", F.col("Category")).withColumn("_dom", F.col("Domain")),
                  f"{out_dir}/_redirects-changed", ["_cat", "_dom", "_url"])
    current = sh.redirects_current(with_sheet, key).drop(key, "sheet")
    rio.write_csv(current.withColumn("_cat", F.col("Category")).withColumn("_dom", F.col("Domain")),
                  f"{out_dir}/_redirects-current", ["_cat", "_dom", "_url"])
