"""Status sheet (SHT-05 / SNK-05): raw and effective status of every page
over the last 7 days, with agencies and offices from the tags."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelens.functions import formats as fm
from changelens.functions import redirects as RD
from changelens.functions import status as ST
from changelens.operators import sheets as sh
from changelens.operators import versions as ver
from changelens.operators.bodies import bodies_of
from changelens.operators.catalog import select_pages
from changelens.session import stage_table
from changelens.sources import results_io as rio

WINDOW_DAYS = 7
PAGE_URL = "https://monitor.example.org/page/%s"


def status_sheet(v: DataFrame, pages: DataFrame, html_bodies: DataFrame, before,
                 body_key: str = "version_id", body_col: str = "html", url_pattern: str | None = None,
                 tags: list[str] | None = None, status_overrides: list[tuple] | None = None) -> DataFrame:
    """One row per page with captures before ``before``: latest capture,
    latest valid capture (newest of the trimmed 7-day selection, else the
    latest) and its effective status; ``url_pattern`` and ``tags`` as in ``catalog.select_pages``."""
    pages = select_pages(pages, url_pattern, tags)
    b = _dt.datetime.fromisoformat(str(before)) if not isinstance(before, _dt.datetime) else before
    after = (b - _dt.timedelta(days=WINDOW_DAYS)).isoformat(sep=" ")
    vb = v.where(F.col("capture_time") < ver.ts_lit(before))
    lv = ver.latest_valid(vb, ver.select_and_trim(ver.narrow(v), after, before))
    vv = v.select(F.col("version_id").alias("valid_id"), F.struct(*v.columns).alias("vv"))
    lv = stage_table(lv, "latest-valid")
    body = bodies_of(html_bodies, lv.select("valid_id"), body_key).select(
        F.col(body_key).alias("valid_id"), RD.client_redirect(F.col(body_col)).alias("client"))
    j = lv.join(vv, "valid_id").join(body, "valid_id", "left")
    eff = ST.effective_status(F.col("vv.url"), F.col("vv.status"), F.col("vv.network_error"), F.col("vv.title"),
                              F.col("vv.headers") if "headers" in v.columns else None, RD.all_redirects(F.col("vv.redirects"), F.col("client")), status_overrides)
    m = pages.select("page_id", "url", "tags")  # pages without captures are absent
    return j.join(m, "page_id").select(
        sh.prefixed_values(F.col("tags"), "agency:").alias("agencies"),
        sh.prefixed_values(F.col("tags"), "office:").alias("offices"),
        "url", fm.format_status(F.col("latest.status")).alias("status"),
        fm.format_status(eff).alias("effective_status"),
        fm.format_datetime(F.col("latest.capture_time")).alias("capture_time"),
        fm.format_datetime(F.col("valid_time")).alias("valid_capture_time"),
        F.format_string(PAGE_URL, F.col("page_id").cast("string")).alias("page_link"))


# The sheet's headers, in the order of the columns above.
HEADERS = ["Agencies", "Offices", "URL", "Status", "Effective Status", "Capture Time", "Latest Valid Capture Time", "Scanner URL"]


def write_status_sheet(rows: DataFrame, path: str) -> None:
    """SNK-05: the status sheet as CSV, by URL."""
    rio.write_csv(rows.toDF(*HEADERS), path, ["URL"])
