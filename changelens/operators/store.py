"""Content-addressed store of parsed bodies (the body memo of VER-08).

A job that analyses many pairs of the same captures reads each capture and each
body once: captures are copied to the shared checkpoint folder, every *distinct*
body - known by the SHA-256 of its content, however many captures and pages share
it - is copied, parsed and measured once.  Its units are kept as ``digests``, a
row of numbers for each document, in parts that depend on as little as they can:

* ``views``: the source units without URLs, for each body and the strip rules that
  hold where it is read (news and host gates);
* ``documents``: links and source units with URLs, for each view and the URL that
  they are resolved against;
* ``texts``: the text lines of each body.

All are bucketed by their key, so a pair of ends is narrow lookups: reference to
body, body to digests.  Rounds shuffle the digests of a pair once and no rows of
units.  Those can still be had (``html_units``, ``text_units``, ``html_nodes``) for
what needs texts: text that is taken from the HTML, dictionaries beyond the
automaton's bounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelens.functions import gates as G
from changelens.functions import redirects as R
from changelens.functions import text as tx
from changelens.functions import urls as U
from changelens.operators import blocks as bk
from changelens.operators import digests as dg
from changelens.operators.bodies import bodies_of
from changelens.session import prepare_python, stage_bucketed, stage_table


def _news(url: Column, title: Column) -> Column:
    return G.is_news_page(url, title)


def document_id(body_id: Column, url: Column, news: Column) -> Column:
    """A body as it is read by a capture: what its units depend on.  Null for a missing body."""
    return F.sha2(F.concat(body_id, F.coalesce(news.cast("string"), F.lit("-")), F.lit(" "),
                           F.coalesce(F.concat(F.lit("="), url), F.lit(""))), 256)


def _view(body_id: Column, mask: Column) -> Column:
    return F.concat(body_id, F.lit(" "), mask.cast("string"))


def _located(body_id: Column, mask: Column, url: Column) -> Column:
    return F.sha2(F.concat(_view(body_id, mask), F.lit(" "), F.coalesce(F.concat(F.lit("="), url), F.lit(""))), 256)


class BodyStore(NamedTuple):
    captures: DataFrame           # the captures as they came, staged
    html_refs: DataFrame          # (_ref, body_id, client, readable): null body_id for a missing body
    units: DataFrame              # (document_id, kind, pos, unit): link and source units, and the doc or error row; worked out when read
    nodes: DataFrame              # marked node rows by body_id
    views: DataFrame              # (view, digest of the source units without URLs)
    documents: DataFrame          # (located, kind, digest of links and of source units with URLs)
    rules: list[bk.StripRule]
    text_refs: DataFrame | None   # (_ref, body_id)
    lines: DataFrame | None       # (body_id, pos, unit), worked out when read
    texts: DataFrame | None       # (body_id, digest of the lines)

    def _known(self, ends: DataFrame, ref: str) -> DataFrame:
        """The ends whose body is there, with body_id and client redirect."""
        e = ends.select("pair_id", "side", F.col(f"v.{ref}").alias("_ref"), F.col("v.url").alias("url"),
                        _news(F.col("v.url"), F.col("v.title")).alias("news"), "content")
        return e.join(self.html_refs.where(F.col("body_id").isNotNull()), "_ref").drop("_ref", "readable")

    def _documents(self, ends: DataFrame, ref: str) -> DataFrame:
        return self._known(ends, ref).select(
            "pair_id", "side", "content", "client", document_id(F.col("body_id"), F.col("url"), F.col("news")).alias("document_id"))

    def html_docs(self, ends: DataFrame, ref: str) -> DataFrame:
        """(pair_id, side, client) of the ends whose body is there and could be
        read; of pairs that are not content-analysable (FLT-06) it need not be."""
        d = self._documents(ends, ref).join(self.units.where(F.col("kind").isin("doc", "error")), "document_id")
        return d.where(~F.col("content") | (F.col("kind") == "doc")).select("pair_id", "side", "client")

    def html_units(self, ends: DataFrame, ref: str) -> DataFrame:
        """What ``analysis.html_units`` returns for the nodes of ``ends``."""
        d = self._documents(ends.where("content"), ref).select("pair_id", "side", "document_id")
        return d.join(self.units.where(F.col("kind").isin("link", "source")), "document_id").select("pair_id", "side", "kind", "pos", "unit")

    def html_nodes(self, ends: DataFrame, ref: str) -> DataFrame:
        """What ``analysis.html_nodes`` returns for ``ends``.  Pairs that are not
        content-analysable (FLT-06) have one row that says their body is there."""
        n = self._known(ends, ref).join(self.nodes, "body_id")
        whole = F.col("kind").isin("doc", "error")
        n = n.where(F.col("content") | whole).withColumn("kind", F.when(~F.col("content") & whole, F.lit("doc")).otherwise(F.col("kind")))
        return n.drop("body_id")

    def text_units(self, ends: DataFrame, ref: str) -> DataFrame:
        """What ``analysis.text_units`` returns for ``ends``."""
        e = ends.select("pair_id", "side", F.col(f"v.{ref}").alias("_ref"))
        return e.join(self.text_refs, "_ref").join(self.lines, "body_id").select("pair_id", "side", "pos", "unit")

    def pair_metrics(self, ends: DataFrame, html_ref: str, text_ref: str | None) -> DataFrame:
        """``digests.pair_metrics`` of ``ends``, which have ``self_a`` and ``self_b``, the hashes of both ends' own
        normalised URLs.  Without ``text_ref`` the text is left out."""
        e = ends.select("pair_id", "side", F.col(f"v.{html_ref}").alias("_ref"), "content", "self_a", "self_b", F.col("v.url").alias("url"),
                        bk.strip_mask(F.col("v.url"), _news(F.col("v.url"), F.col("v.title")), self.rules).alias("_mask"))
        known = stage_table(e.join(self.html_refs.where(F.col("body_id").isNotNull()), "_ref").select(
            "pair_id", "side", "content", "client", "readable", "self_a", "self_b", _view(F.col("body_id"), F.col("_mask")).alias("view"),
            _located(F.col("body_id"), F.col("_mask"), F.col("url")).alias("located")), "store-ends")
        read = known.where("content")
        rows = [known.where(~F.col("content") | F.col("readable")).withColumn("kind", F.lit(dg.END)),
                read.select("pair_id", "side", "view").join(self.views, "view").withColumn("kind", F.lit(dg.SOURCE)),
                read.select("pair_id", "side", "located", "self_a", "self_b").join(self.documents, "located")]
        if text_ref:
            t = ends.where("content").select("pair_id", "side", F.col(f"v.{text_ref}").alias("_ref"))
            rows.append(t.join(self.text_refs, "_ref").join(self.texts, "body_id").withColumn("kind", F.lit(dg.TEXT)))
        cols = [(f.name, f.dataType) for f in dg.ROW]
        same = [r.select("pair_id", *[(F.col(c) if c in r.columns else F.lit(None)).cast(t).alias(c) for c, t in cols]) for r in rows]
        sent = same[0]
        for r in same[1:]:
            sent = sent.unionByName(r)
        return dg.pair_metrics(sent)


#: Bodies that a task remembers to have copied.
SEEN = 100_000


def _once_a_task(copies: DataFrame) -> DataFrame:
    """``copies`` with ``_body`` only where its task has not had the same ``body_id`` just before."""
    schema = copies.schema
    of, body = copies.columns.index("body_id"), copies.columns.index("_body")

    def rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for b in it:
            new = []
            for i in b.column(of).to_pylist():
                new.append(i not in seen)
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(i)
            at = pa.array([k if n else None for k, n in enumerate(new)], pa.int32())
            yield pa.RecordBatch.from_arrays([c.take(at) if k == body else c for k, c in enumerate(b.columns)], b.schema.names)

    prepare_python(copies.sparkSession)
    return copies.mapInArrow(rows, T.StructType(schema.fields))


def _distinct(bodies: DataFrame, wanted: DataFrame, key: str, col: str, name: str, **more: Column) -> tuple[DataFrame, DataFrame]:
    """The wanted bodies, read once: (all references with ``more`` columns, one row for each distinct content).

    Bodies that a function looks up are those wanted; a table's are joined.  The copies are never shuffled, only one of
    each task's bodies is."""
    b = bodies_of(bodies, wanted.select("_ref"), key).select(F.col(key).alias("_ref"), F.col(col).cast("string").alias("_body"))
    b = b if callable(bodies) else b.join(wanted.select("_ref"), "_ref", "left_semi")
    b = b.select("_ref", "_body", F.sha2("_body", 256).alias("body_id"), *[c.alias(n) for n, c in more.items()])
    copied = stage_table(_once_a_task(b), name)
    refs = copied.select("_ref", "body_id", *more).join(wanted, "_ref")
    known = F.col("body_id").isNotNull()
    parse = refs.where(known).groupBy("body_id").agg(F.max("_parse").alias("_parse"))
    once = copied.where(known & F.col("_body").isNotNull()).groupBy("body_id").agg(F.first("_body").alias("_body")).join(parse, "body_id")
    return refs, once


def body_store(captures: DataFrame, page_urls: DataFrame, html_bodies: DataFrame, text_bodies: DataFrame | None,
               text_ref: str = "doc_id", html_ref: str = "html_id", text_key: str = "doc_id", text_col: str = "text",
               html_key: str = "html_id", html_col: str = "html",
               strip_rules: list[bk.StripRule] = bk.STRIP_RULES, words: set[str] | None = None) -> BodyStore:
    """The store of all bodies that ``captures`` (rows with ``page_id``) name.

    ``page_urls``: (page_id, url).  A body is parsed in full when some page
    that names it is content-analysable.  ``words`` are those of the terms that
    are searched for: lines that have one keep their text."""
    caps = stage_table(captures, "store-captures")
    urls = page_urls.select("page_id", F.col("url").alias("_page_url"))
    content = F.coalesce(G.is_content_analyzable(F.coalesce("_page_url", "url")), F.lit(False))
    refs = caps.join(urls, "page_id", "left").select(F.col(html_ref).alias("_ref"), content.alias("_parse"))
    copied, once = _distinct(html_bodies, refs.groupBy("_ref").agg(F.max("_parse").alias("_parse")), html_key, html_col, "store-html",
                             client=R.client_redirect(F.col("_body")))
    parsed = bk.parse_html(once.select("body_id", F.when(F.col("_parse"), F.col("_body")).otherwise(F.lit("")).alias("_body")),
                           "body_id", "_body", strip_rules)
    nodes = stage_bucketed(parsed, "store-nodes", "body_id")
    state = nodes.where(F.col("kind").isin("doc", "error")).select("body_id", (F.col("kind") == "doc").alias("readable"))
    html_refs = stage_table(copied.join(state, "body_id", "left").select("_ref", "body_id", "client", "readable"), "store-html-refs")
    views, documents = document_digests(caps, html_refs, nodes, html_ref, strip_rules)
    html = (caps, html_refs, document_units(caps, html_refs, nodes, html_ref, strip_rules), nodes,
            stage_bucketed(views, "store-views", "view"), stage_bucketed(documents, "store-documents", "located"), strip_rules)
    if text_bodies is None:
        return BodyStore(*html, None, None, None)
    wanted = caps.select(F.col(text_ref).alias("_ref"), F.lit(True).alias("_parse")).distinct()
    copied, once = _distinct(text_bodies, wanted, text_key, text_col, "store-text")
    lined = once.select("body_id", tx.normalized_lines(F.col("_body")).alias("lines"))
    texts = stage_bucketed(dg.text_digests(lined, words or set()), "store-texts", "body_id")
    return BodyStore(*html, copied.select("_ref", "body_id"), lined.select("body_id", F.inline("lines")), texts)


def _read(captures: DataFrame, html_refs: DataFrame, html_ref: str) -> DataFrame:
    c = captures.select(F.col(html_ref).alias("_ref"), "url", _news(F.col("url"), F.col("title")).alias("news"))
    return c.join(html_refs.where(F.col("body_id").isNotNull()), "_ref").select("body_id", "url", "news").distinct()


def document_digests(captures: DataFrame, html_refs: DataFrame, nodes: DataFrame, html_ref: str,
                     rules: list[bk.StripRule] = bk.STRIP_RULES) -> tuple[DataFrame, DataFrame]:
    """The digests of every document that ``captures`` read: (view, source units without URLs), and (located, kind,
    links or source units with URLs).  The nodes stay where they are bucketed, and go on as one row for each document."""
    read = stage_table(_read(captures, html_refs, html_ref).select(
        "body_id", "url", bk.strip_mask(F.col("url"), F.col("news"), rules).alias("_mask")).distinct(), "store-read")
    kept = (F.col("marks").bitwiseAND(F.col("_mask")) == 0)
    url = F.col("url")
    one = lambda: F.explode(F.array_remove(F.array(bk.source_unit(url)), "")).alias("unit")

    bare = read.select("body_id", "_mask").distinct().join(nodes, "body_id").where(kept & bk.is_sourced() & ~bk.has_url())
    bare = bare.withColumn("url", F.lit(None).cast("string")).select("body_id", "_mask", "pos", one()).where(F.col("unit").isNotNull())
    views = dg.packed(bare, ["body_id", "_mask"]).withColumn("view", _view(F.col("body_id"), F.col("_mask")))

    located = read.withColumn("located", _located(F.col("body_id"), F.col("_mask"), url)).join(
        nodes.where((F.col("kind") == "link") | bk.has_url()), "body_id").where(kept)
    keys = ["body_id", "located", "kind"]
    source = located.where(bk.is_sourced()).select("body_id", "located", F.lit(dg.SOURCE).alias("kind"), "pos", one()).where(F.col("unit").isNotNull())
    links = bk.links(located, url).select(
        "body_id", "located", F.lit(dg.LINK).alias("kind"), "pos", F.concat("href", F.lit("\t"), "text").alias("unit"))
    # The hash of an href is that of its unit up to the TAB.
    href = F.when(F.col("kind") == dg.LINK, dg.prefix(F.substring_index("unit", "\t", 1)))
    documents = dg.packed(source.unionByName(links), keys, href)
    digest = [*dg.FIELDS, "href"]
    return views.select("view", *digest), documents.select("located", "kind", *digest)


def document_units(captures: DataFrame, html_refs: DataFrame, nodes: DataFrame, html_ref: str,
                   strip_rules: list[bk.StripRule] = bk.STRIP_RULES) -> DataFrame:
    """(document_id, kind, pos, unit) of every document that ``captures`` read:
    its link and source units, and one row of kind doc (error: not readable)."""
    from changelens.operators import analysis as an

    docs = _read(captures, html_refs, html_ref)
    n = docs.withColumn("pair_id", document_id(F.col("body_id"), F.col("url"), F.col("news"))).join(nodes, "body_id").select(
        "*", F.lit(None).cast("string").alias("side"), F.lit(True).alias("content"))
    state = n.where(F.col("kind").isin("doc", "error")).select("pair_id", "kind", "pos", F.lit(None).cast("string").alias("unit"))
    units = an.html_units(n, strip_rules).select("pair_id", "kind", "pos", "unit")
    return state.unionByName(units).withColumnRenamed("pair_id", "document_id")
