"""Display formats of the sheets (SC-11..SC-16)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from changelens.functions import urls as U

EMPTY_HASH = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
ARCHIVE_DIFF_URL = "https://web.archive.org/web/diff/{a}/{b}/{url}"


def format_datetime(ts: Column) -> Column:
    """SC-11: ISO 8601 without fraction, 'Z' suffix; '' for null."""
    return F.coalesce(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(""))


def archive_timestamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMddHHmmss")


def format_hash(h: Column) -> Column:
    """SC-12."""
    return F.when(h.isNull() | (h == "") | (h == EMPTY_HASH), F.lit("[no change]")).otherwise(F.substring(h, 1, 10))


def format_redirects(server: Column, client: Column) -> Column:
    """SC-13: hops joined by ' → ', then ' ⇥ client' appended."""
    s = F.array_join(F.coalesce(server, F.array().cast("array<string>")), " → ")
    return F.when(client.isNotNull(), F.concat(s, F.lit(" ⇥ "), client)).otherwise(s)


def format_status(s: Column) -> Column:
    """SC-14."""
    return F.when(s.isNull() | (s == 600), F.lit("(offline)")).otherwise(s.cast("string"))


def view_url(base: str, page: Column, a: Column, b: Column) -> Column:
    """SC-16."""
    return F.format_string(base.replace("{page}", "%s").replace("{a}", "%s").replace("{b}", "%s"),
                           page.cast("string"), a.cast("string"), b.cast("string"))


def archive_compare_url(a_source: Column, b_source: Column, a_url: Column, b_url: Column,
                        a_time: Column, b_time: Column) -> Column:
    """DIF-11: archive compare link when both captures come from the archive
    and point at the same canonical URL, else ''."""
    same = (a_source == "internet_archive") & (b_source == "internet_archive") & \
        U.canonical_key(a_url).eqNullSafe(U.canonical_key(b_url))
    link = F.format_string(ARCHIVE_DIFF_URL.replace("{a}", "%s").replace("{b}", "%s").replace("{url}", "%s"),
                           archive_timestamp(a_time), archive_timestamp(b_time), b_url)
    return F.when(F.coalesce(same, F.lit(False)), link).otherwise(F.lit(""))
