"""Sheet grouping, ordering and rows (AGG-01..03, SRT-01..04, SHT-01..05,
FLT-09, FLT-12).

Sheets are a partition column, so writing them is one
``write.partitionBy('sheet')``.  Rows of a sheet are numbered from sorted
ranges (``sequence.with_rank``) and a change group's priority is an aggregate
joined back, so neither one large sheet nor one large group (all errors share
one) ends up in a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelens.functions import formats as fm
from changelens.functions import redirects as RD
from changelens.functions import text as tx
from changelens.functions import urls as U
from changelens.operators.sequence import with_rank
from changelens.session import stage_table

# The reference's sheet prefixes, in order.
SHEET_PREFIXES = ["category:", "news", "2l-domain:"]
ERROR_GROUP = "__ERROR__"
METADATA_GROUP = "__METADATA__"


def sheet_key(tags: Column, prefixes: list[str] = SHEET_PREFIXES) -> Column:
    """AGG-01: per prefix, the first tag starting with it gives the prefix
    (exact match) or the rest; parts joined by '--'."""
    parts = []
    for p in prefixes:
        t = F.try_element_at(F.filter(tags, lambda x: x.startswith(p)), F.lit(1))
        parts.append(F.when(t == p, F.lit(p)).otherwise(F.substring(t, len(p) + 1, 1 << 30)))
    return F.array_join(F.array_compact(F.array(*parts)), "--")


def prefixed_values(tags: Column, prefix: str) -> Column:
    """FLT-12: values of the tags with ``prefix``, sorted, ', '-joined."""
    return F.array_join(F.array_sort(F.transform(F.filter(tags, lambda x: x.startswith(prefix)),
                                                 lambda x: F.substring(x, len(prefix) + 1, 1 << 30))), ", ")


def threshold(results: DataFrame, t: float) -> DataFrame:
    """FLT-09: keep errors and rows with priority >= t."""
    return results.where(F.col("analysis").isNull() | (F.col("analysis.priority") >= F.lit(t)))


def drop_no_change(results: DataFrame) -> DataFrame:
    """FLT-08."""
    return results.where(F.col("error_kind").isNull() | (F.col("error_kind") != "no_change"))


def change_group(results_analysis: Column) -> Column:
    return (F.when(results_analysis.isNull(), F.lit(ERROR_GROUP))
            .when(results_analysis["text"].isNull(), F.lit(METADATA_GROUP))
            .otherwise(results_analysis["text"]["diff_hash"]))


def order_sheets(results: DataFrame, tags_col: str = "tags", url_col: str = "url",
                 deep: bool = False) -> DataFrame:
    """AGG-02 + SRT-01/02: add sheet, change_group, group_priority and Index."""
    prio = F.coalesce(F.col("analysis.priority"), F.lit(0.0))
    r = results.withColumn("sheet", sheet_key(F.col(tags_col))).withColumn("_prio", prio)
    if deep:
        return with_rank(r, ["sheet"], [F.desc("_prio"), F.col(url_col)], "Index").drop("_prio")
    r = stage_table(r.withColumn("change_group", change_group(F.col("analysis"))), "sheeted")
    top = r.groupBy(F.col("sheet").alias("_s"), F.col("change_group").alias("_g")).agg(F.max("_prio").alias("group_priority"))
    r = r.join(top, F.col("sheet").eqNullSafe(F.col("_s")) & (F.col("change_group") == F.col("_g"))).drop("_s", "_g")
    order = [F.desc("group_priority"), F.col("change_group"), F.desc("_prio"), F.col(url_col)]
    return with_rank(r, ["sheet"], order, "Index").drop("_prio")


def hash_groups(results: DataFrame, tags_col: str = "tags", url_col: str = "url") -> DataFrame:
    """AGG-03: clusters of pages sharing one change (size, max priority)."""
    r = results.withColumn("sheet", sheet_key(F.col(tags_col))).withColumn(
        "change_group", change_group(F.col("analysis")))
    return r.groupBy("sheet", "change_group").agg(
        F.count("*").alias("pages"),
        F.max(F.coalesce(F.col("analysis.priority"), F.lit(0.0))).alias("group_priority"),
        F.min(url_col).alias("first_url"))


def top_k(ordered: DataFrame, k: int) -> DataFrame:
    """SRT-04: the first k rows of every sheet."""
    return ordered.where(F.col("Index") <= k)


VIEW_URL = "https://monitor.example.org/page/{page}/{a}..{b}"

# Sheet column headers (the duplicated '---' separators of the
# reference are not kept; names are unique).
SHEET_COLUMNS = [
    "Index", "Version", "Output Date/Time", "Maintainers", "Site Name", "Page Title", "URL",
    "Scanner Comparison", "IA Comparison", "Date Found - Latest", "Date Found - Base",
    "Diff Length", "Diff Hash", "Text Diff Length", "Text Diff Hash", "Priority", "Error",
    "Home page?", "Changed status?", "Effective Status", "Status", "Readable?", "Key Terms",
    "% Changed Text", "Longest Text Change", "Links diff hash", "Links changes", "% Changed Links",
    "Removed link to self", "Client Redirect?", "Redirects Changed?", "Prior Redirects", "Current Redirects",
]


def _fmt3(c: Column) -> Column:
    return F.format_string("%.3f", c)


def sheet_rows(ordered: DataFrame, key: str = "page_id", run_time: Column | None = None,
               view_url: str = VIEW_URL, version_label: Column | None = None,
               a: str = "a", b: str = "b", analysis: str = "analysis", keep: tuple[str, ...] = ()) -> DataFrame:
    """SHT-01: one formatted row per result (error rows: Priority '?' and the
    message)."""
    an = F.col(analysis)
    has = an.isNotNull()
    A, B = F.col(a), F.col(b)
    bstr = lambda c: F.when(c.isNull(), F.lit("")).otherwise(F.when(c, F.lit("True")).otherwise(F.lit("False")))
    fields = ordered.schema[a].dataType.fieldNames() if a in ordered.columns else []
    ia = (fm.archive_compare_url(A["source_type"], B["source_type"], A["url"], B["url"],
                                 A["capture_time"], B["capture_time"])
          if "source_type" in fields else F.lit(""))
    kt = F.array_join(F.transform(F.map_entries(an["text"]["key_terms"]),
                                  lambda e: F.concat(e["key"], F.lit(": "), e["value"].cast("string"))), ", ")
    cols = {
        "Index": F.col("Index").cast("string"),
        "Version": version_label if version_label is not None else B["version_id"].cast("string"),
        "Output Date/Time": fm.format_datetime(run_time if run_time is not None else F.current_timestamp()),
        "Maintainers": F.array_join(F.coalesce(F.col("maintainers"), F.array().cast("array<string>")), ", "),
        "Site Name": F.col("sheet"),
        "Page Title": tx.clean_string(F.col("title")),
        "URL": F.col("url"),
        "Scanner Comparison": fm.view_url(view_url, F.col(key), A["version_id"], B["version_id"]),
        "IA Comparison": ia,
        "Date Found - Latest": fm.format_datetime(B["capture_time"]),
        "Date Found - Base": fm.format_datetime(A["capture_time"]),
        "Diff Length": F.when(has, an["source"]["diff_length"].cast("string")),
        "Diff Hash": F.when(has & an["source"].isNotNull(), fm.format_hash(an["source"]["diff_hash"])),
        "Text Diff Length": F.when(has, an["text"]["diff_length"].cast("string")),
        "Text Diff Hash": F.when(has & an["text"].isNotNull(), fm.format_hash(an["text"]["diff_hash"])),
        "Priority": F.when(has, _fmt3(an["priority"])).otherwise(F.lit("?")),
        "Error": F.when(~has, F.col("error")),
        "Home page?": F.when(has, bstr(an["root_page"])),
        "Changed status?": F.when(has, bstr(an["status_changed"])),
        "Effective Status": F.when(has, fm.format_status(an["status_b"])),
        "Status": F.when(has, fm.format_status(B["status"])),
        "Readable?": F.when(has & an["text"].isNotNull(), an["text"]["readable"]),
        "Key Terms": F.when(has & an["text"].isNotNull(), kt),
        "% Changed Text": F.when(has & an["text"].isNotNull(), _fmt3(an["text"]["percent_changed"])),
        "Longest Text Change": F.when(has, an["text"]["diff_max_length"].cast("string")),
        "Links diff hash": F.when(has & an["links"].isNotNull(), fm.format_hash(an["links"]["diff_hash"])),
        "Links changes": F.when(has, an["links"]["diff_length"].cast("string")),
        "% Changed Links": F.when(has & an["links"].isNotNull(), _fmt3(an["links"]["diff_ratio"])),
        "Removed link to self": F.when(has & an["links"].isNotNull(), bstr(an["links"]["removed_self_link"])),
        "Client Redirect?": F.when(has, an["redirect"]["client_state"]),
        "Redirects Changed?": F.when(has, F.coalesce(an["redirect"]["change_type"], F.lit(""))),
        "Prior Redirects": F.when(has, fm.format_redirects(an["redirect"]["a_server"], an["redirect"]["a_client"])),
        "Current Redirects": F.when(has, fm.format_redirects(an["redirect"]["b_server"], an["redirect"]["b_client"])),
    }
    return ordered.select("sheet", F.col("Index").alias("_order"), *keep, *[v.alias(k) for k, v in cols.items()])


def deep_sheet_rows(ordered: DataFrame, key: str = "page_id", run_time: Column | None = None,
                    view_url: str = VIEW_URL) -> DataFrame:
    """SHT-02: every result as an ``OVERALL`` row, then one row ``i-j`` for
    each of its changes (``changes``: array of (a, b, analysis), older first)."""
    overall = sheet_rows(ordered, key, run_time, view_url, version_label=F.lit("OVERALL")).withColumn("_change", F.lit(0))
    parts = ordered.select(
        "sheet", key, "url", "title", "maintainers", F.col("Index").alias("_i"), F.lit(None).cast("string").alias("error"),
        F.posexplode("changes").alias("_j", "_c")).select("*", "_c.a", "_c.b", "_c.analysis").withColumn("Index", F.col("_i"))
    each = sheet_rows(parts, key, run_time, view_url, keep=("_j",)).withColumn(
        "Index", F.concat("Index", F.lit("-"), (F.col("_j") + 1).cast("string"))).withColumn("_change", F.col("_j") + 1).drop("_j")
    return overall.unionByName(each)


def redirect_changes(ordered: DataFrame, key: str = "page_id", view_url: str = VIEW_URL) -> DataFrame:
    """SHT-03: pages whose final redirect destination changed."""
    an = F.col("analysis")
    r = ordered.where(an.isNotNull() & an["redirect"]["change_type"].isNotNull())
    a_all = F.concat(an["redirect"]["a_server"], F.array_compact(F.array(an["redirect"]["a_client"])))
    b_all = F.concat(an["redirect"]["b_server"], F.array_compact(F.array(an["redirect"]["b_client"])))
    return r.select(
        fm.view_url(view_url, F.col(key), F.col("a.version_id"), F.col("b.version_id")).alias("Scanner"),
        F.regexp_extract("sheet", r"^(.*)--(.*?)$", 1).alias("Category"),
        F.when(F.col("sheet").contains("--"), F.regexp_extract("sheet", r"^(.*)--(.*?)$", 2))
        .otherwise(F.col("sheet")).alias("Domain"),
        fm.format_status(an["status_b"]).alias("Status"),
        an["redirect"]["change_type"].alias("Redirect Type"),
        F.col("b.url").alias("Monitored URL"),
        F.coalesce(F.try_element_at(a_all, F.lit(-1)), F.col("a.url")).alias("Redirect Old"),
        F.coalesce(F.try_element_at(b_all, F.lit(-1)), F.col("b.url")).alias("Redirect New"),
        fm.format_redirects(an["redirect"]["a_server"], an["redirect"]["a_client"]).alias("All Redirects Old"),
        fm.format_redirects(an["redirect"]["b_server"], an["redirect"]["b_client"]).alias("All Redirects New"),
        F.col("url").alias("_url"),
    )


def redirects_current(ordered: DataFrame, key: str = "page_id", view_url: str = VIEW_URL) -> DataFrame:
    """SHT-04: pages whose newest capture redirects to an effectively different URL."""
    done = ordered.where(F.col("analysis").isNotNull())
    hops = RD.all_redirects(F.col("b.redirects"), F.col("analysis.redirect.b_client"))
    last = F.try_element_at(hops, F.lit(-1))
    return done.where(F.size(hops) > 0).select(
        F.col(key), "sheet",
        fm.view_url(view_url, F.col(key), F.col("a.version_id"), F.col("b.version_id")).alias("Scanner"),
        F.regexp_extract("sheet", r"^(.*)--(.*?)$", 1).alias("Category"),
        F.when(F.col("sheet").contains("--"), F.regexp_extract("sheet", r"^(.*)--(.*?)$", 2))
        .otherwise(F.col("sheet")).alias("Domain"),
        fm.format_status(F.col("analysis.status_b")).alias("Status"),
        U.url_change_type(F.col("b.url"), last).alias("Redirect Type"),
        F.col("b.url").alias("Monitored URL"), last.alias("Redirected URL"),
        fm.format_redirects(F.col("analysis.redirect.b_server"), F.col("analysis.redirect.b_client")).alias("All Redirects"),
        F.col("url").alias("_url"),
    ).where(F.col("Redirect Type").isNotNull())


def failures(results: DataFrame) -> DataFrame:
    """PRI-03: the unexpected errors only (side output for operators)."""
    return results.where(F.col("error_kind") == "failed")
