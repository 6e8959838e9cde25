"""Driver tables and the fixture views built on them (FIXTURES.md, part B).

The driver data has pages, documents and events but no capture history, so
the views below re-read them as one:

* ``versions``   (F1) captures from ``events``; bodies by join to
                 ``documents`` (text) and ``pages`` (HTML)
* ``page_meta``  (F6) catalogue rows from ``customer ⋈ nation ⋈ region``
* ``doc_pairs``  (F2) previous document of the same source
* ``page_pairs`` (F3) previous page of the same host and language

Nothing is collected.  Scalar counts are scalar subqueries, planned by Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changelens.operators.sequence import previous_in_group

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


# Timeframes of FIXTURES.md F1 (all four paths: normal, questionable-only,
# no baseline, month end).
FRAMES = [
    ("2024-01-08", "2024-01-15"),
    ("2024-01-10", "2024-01-11"),
    ("2024-01-01", "2024-01-04"),
    ("2024-01-25", "2024-01-31"),
]

# Fixture dictionaries (FIXTURES.md F4).
TERMS = ["orantion", "Thanedble", "worthless", "license", "License", "MIT license", "released under",
         "orantion orantion", "eriner thanea", "anea eriner thanea", "Ñga", "rééaution", "inoran inoran"]
STOP_WORDS = ["the", "and", "of", "to", "a", "de", "la"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def host_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1)


def page_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one catalogue row per customer (page_id = c_custkey)."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    host = F.concat(F.replace(F.lower("n_name"), F.lit("_"), F.lit("-")), F.lit(".example.com"))
    path = F.when(F.col("c_custkey") % 7 == 0, F.lit("")).otherwise(
        F.concat(F.lit("p/"), F.col("c_custkey").cast("string")))
    tags = F.concat(
        F.array(
            F.concat(F.lit("category:"), "c_mktsegment"),
            F.concat(F.lit("2l-domain:"), "n_name"),
            F.concat(F.lit("agency:"), "n_name"),
            F.concat(F.lit("office:"), "r_name"),
        ),
        F.when(F.col("c_custkey") % 10 == 0, F.array(F.lit("news"))).otherwise(F.array().cast("array<string>")),
    )
    return j.select(
        F.col("c_custkey").alias("page_id"),
        F.concat(F.lit("https://"), host, F.lit("/"), path).alias("url"),
        F.col("c_name").alias("title"),
        tags.alias("tags"),
        F.array(F.col("n_name")).alias("maintainers"),
        F.lit(True).alias("active"),
        (F.lit("2023-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.col("c_custkey").cast("int"))).alias("created_at"),
    )


# Fixed title variants that exercise the effective-status title rules; keyed
# by event_id % 17 for non-error captures (FIXTURES.md F1 extension).
def _title_variant(eid: Column, base: Column) -> Column:
    k = eid % 17
    return (
        F.when(k == 0, F.concat(F.lit("404 Not Found | "), base))
        .when(k == 1, F.concat(base, F.lit(" - Access Denied")))
        .when(k == 2, F.lit("Error 503"))
        .when(k == 3, F.concat(base, F.lit(" | Site under maintenance")))
        .when(k == 4, F.lit("Error"))
        .when(k == 5, F.concat(F.lit("200 OK | "), base))
        .otherwise(base)
    )


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """capture history from ``events`` joined to its page row."""
    e = table(spark, sf_dir, "events")
    docs_n = table(spark, sf_dir, "documents").select(F.count("*")).scalar()
    pages_n = table(spark, sf_dir, "pages").select(F.count("*")).scalar()
    meta = page_meta(spark, sf_dir).select(
        F.col("page_id").alias("m_page_id"), F.col("url").alias("m_url"), F.col("title").alias("m_title"))
    is_err = F.col("event_type") == "error"
    status = F.when(is_err, F.when(F.col("event_id") % 3 == 0, 404).when(F.col("event_id") % 3 == 1, 503)).otherwise(200)
    ival = F.floor("value").cast("bigint")
    host = host_of(F.col("m_url"))
    redirects = (
        F.when((F.col("event_type") == "signup") & (ival % 5 == 0),
               F.array(F.col("m_url"), F.concat(F.lit("https://"), host, F.lit("/"))))
        .when((F.col("event_type") == "purchase") & (ival % 7 == 0),
              F.array(F.col("m_url"), F.concat(F.lit("https://moved.example.org/p/"), F.col("user_id").cast("string"))))
    )
    v = e.join(meta, e.user_id == meta.m_page_id, "left")
    return v.select(
        F.col("user_id").alias("page_id"),
        F.col("event_id").alias("version_id"),
        F.col("ts").alias("capture_time"),
        status.cast("int").alias("status"),
        F.when(is_err & (F.col("event_id") % 3 == 2), F.lit("timeout")).alias("network_error"),
        F.md5(F.concat(F.col("event_type"), F.lit("/"), F.floor(F.col("value") / 200).cast("bigint").cast("string"))).alias("body_hash"),
        F.when(F.coalesce(status, F.lit(600)) >= 400, F.lit(0.5)).otherwise(F.lit(1.0)).alias("quality"),
        (F.col("event_id") % docs_n).alias("doc_id"),
        (F.col("event_id") % pages_n).alias("html_id"),
        F.col("m_url").alias("url"),
        F.when(is_err, F.col("m_title")).otherwise(_title_variant(F.col("event_id"), F.col("m_title"))).alias("title"),
        F.lit("text/html").alias("media_type"),
        F.concat(F.lit("https://bodies.example.org/"), F.col("event_id").cast("string")).alias("body_url"),
        redirects.alias("redirects"),
        F.when(F.col("event_id") % 19 == 0, F.create_map(F.lit("apex-debug-id"), F.lit("user=1;LEVEL=ERROR"), F.lit("server"), F.lit("x")))
        .when(F.col("event_id") % 19 == 1, F.create_map(F.lit("apex-debug-id"), F.lit("level=info"))).alias("headers"),
    )


def doc_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pair_id, a_doc, b_doc): a document and the one before it of the same source."""
    g = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("grp"))
    p = previous_in_group(g, "grp", "doc_id")
    return p.where(F.col("prev_doc_id").isNotNull()).select(
        F.col("doc_id").alias("pair_id"),
        F.col("prev_doc_id").alias("a_doc"),
        F.col("doc_id").alias("b_doc"),
    )


def page_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """previous page of the same host and language (first path part)."""
    p = table(spark, sf_dir, "pages")
    lang = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]*)", 1)
    g = p.select("page_id", F.concat_ws("|", host_of(F.col("url")), lang).alias("grp"))
    pp = previous_in_group(g, "grp", "page_id")
    return pp.where(F.col("prev_page_id").isNotNull()).select(
        F.col("page_id").alias("pair_id"),
        F.col("prev_page_id").alias("a_page"),
        F.col("page_id").alias("b_page"),
    )


LINK_RE = r'<a[^>]+href="([^"]*)"'


def url_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of every page (regexp form of BLK-02) plus hrefs derived from
    the page URL that reach every branch of URL normalisation:
    (page_id, url, pos, href)."""
    p = table(spark, sf_dir, "pages")
    url = F.col("url")
    bare = F.regexp_replace(url, "[?#].*$", "")
    variants = F.array(
        F.lit("#"), F.lit("#top"), F.lit(""), F.lit("?page=3"), F.lit("a/../b.html"), F.lit("./c/./d"),
        F.lit("../up/x.html"), F.lit("//cdn.example.org/lib.js"), F.lit("mailto:news@example.org"),
        F.lit("javascript:void(0)"), F.lit("/(S(x1y2z3))/default.aspx"),
        F.concat(bare, F.lit(";jsessionid=AB12CD")),
        F.regexp_replace(url, "^https:", "http:"),
        F.concat(bare, F.lit("?SID=7&q=1&PHPSESSID=9&b=2")),
        F.concat(bare, F.lit("/#section-2")),
        F.upper(bare),
        F.lit("not a url"),
        F.lit("../../../../up4/x.html"), F.lit("../../../../../up5"), F.lit("a/b/../../../../../../x/y/../z/"),
        F.lit("/a/b/c/d/e/f/p.html/../../../../x"), F.lit("/a/b/c/d/e/f/g/../../../../../../../../x/.."),
        F.lit("/a/./b/../../c/./?q=/../x#/../y"), F.lit("/.."), F.lit("/a//b/../c/."), F.lit(".."),
        F.lit(" /c\n"), F.lit("\tx.html"), F.lit("a\nb/c\r\n.html"), F.lit("\n#top\n"), F.lit(" \t\x0b"), F.lit("java\nscript:void(0)"),
        F.lit("\n#\t"), F.lit("//cdn.exa\n  mple.org/x"),
    )
    hrefs = F.concat(F.regexp_extract_all(F.col("html"), F.lit(LINK_RE), 1), variants)
    return p.select("page_id", "url", F.posexplode(hrefs).alias("pos", "href"))


def encoded_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` as bytes in three charsets by page_id % 3: UTF-8 with a
    malformed byte and no charset stated, windows-1252 by the header,
    ISO-8859-15 by a meta element; the latter two with a euro sign, and with ?
    for what they lack."""
    p = table(spark, sf_dir, "pages").select("page_id", "html")
    plain = F.encode(F.regexp_replace("html", "[^\\x00-\\x7F\\xC0-\\xFF]", "?"), "ISO-8859-1")
    kind = F.col("page_id") % 3
    meta = F.lit('<META CHARSET="iso-8859-15">').cast("binary")
    return p.select(
        "page_id", F.when(kind == 1, F.lit("text/html; charset=Windows-1252")).otherwise(F.lit("text/html")).alias("content_type"),
        F.when(kind == 0, F.concat(F.col("html").cast("binary"), F.unhex(F.lit("FF"))))
        .when(kind == 1, F.concat(F.unhex(F.lit("80")), plain)).otherwise(F.concat(meta, F.unhex(F.lit("A4")), plain)).alias("content"))


def version_bodies(spark: SparkSession, sf_dir: str, wanted: DataFrame | None = None) -> DataFrame:
    """HTML body of each capture: the page row chosen by ``html_id``, with a
    refresh tag put in front for some captures so client redirects occur
    (to a moved page when version_id % 23 = 0; without target when % 29 = 0).
    With ``wanted`` (rows of version_id) bodies of those captures only: they are
    chosen before the pages are joined, so no other body is ever built."""
    v = versions(spark, sf_dir).select("version_id", "page_id", "html_id")
    if wanted is not None:
        v = v.join(wanted, "version_id", "left_semi")
    p = table(spark, sf_dir, "pages").select(F.col("page_id").alias("html_id"), "html")
    vid = F.col("version_id")
    tag = (F.when(vid % 23 == 0, F.concat(
        F.lit('<meta http-equiv="refresh" content="0; url=https://moved.example.org/r/'),
        F.col("page_id").cast("string"), F.lit('">')))
        .when(vid % 29 == 0, F.lit('<meta http-equiv="refresh" content="5">'))
        .otherwise(F.lit("")))
    return v.join(p, "html_id").select("version_id", F.concat(tag, F.col("html")).alias("html"))


# F8: markup put in right after <body>, picked by page_id % len, to reach the
# rules that the driver's pages have no case of: (html, texts kept by the strip
# rules, on news pages too or only there).
STRIP_MARKS = [
    ("", []),
    ('<div class="social-links"><p>Follow us</p></div><i>Italic stays</i>', ["Italic stays"]),
    ("<div id='sharing'>Share it</div><i class='fa'>icon</i><div class='feedback'>Feedback stays</div>", ["Feedback stays"]),
    ('<div class="Tweet-Feed-Box"><b>tweets</b></div><div class="related">Related stays</div>', ["Related stays"]),
    ('<nav><span class="news">Nav news</span></nav><p class="news">Plain news stays</p>', ["*Nav news", "Plain news stays"]),
    ('<div class="news box"><p>News box</p></div><p hidden>Hidden attribute stays</p>', ["*News box", "Hidden attribute stays"]),
    ('<select><option>1<option>2<option>3<option>4<option>5<option>6<option>7<option>8<option>9<option>10<option>11</select>'
     "<noscript>no script</noscript><template>no template</template>", []),
]
MAIN_MARKS = [
    "", "<header><p>Site head</p></header>", "<main><p>Main before the nav</p></main>",
    "<article><p>Second article</p></article>", '<div id="main"><p>Id before the nav</p></div>',
]
LINK_MARKS = [
    ("", None), ('<a aria-controls="m" href="#a9">Menu</a>', ("#", "Menu")),
    ('<a aria-controls="m" href="javascript:go()">Go</a>', ("#", "Go")),
    ('<a aria-controls="m" href="/real">Real <b>one</b></a>', ("/real", "Real one")),
    ("<a aria-controls='m'>None</a>", ("#", "None")), ("<A HREF='single'>Single</A>", ("single", "Single")),
    ('<!-- <a href="/commented">no</a> -->', None),
]


def marked_pages(spark: SparkSession, sf_dir: str, marks: list[str]) -> DataFrame:
    """``pages`` with one of ``marks`` after <body>."""
    p = table(spark, sf_dir, "pages")
    mark = F.element_at(F.array(*[F.lit(m) for m in marks]), (F.col("page_id") % len(marks) + 1).cast("int"))
    at = F.instr("html", "<body>")
    return p.withColumn("html", F.when(at > 0, F.concat(
        F.substr("html", F.lit(1), at + 5), mark, F.substr("html", at + 6))).otherwise(F.col("html")))
