"""Documents as one row of numbers each, and what a pair of them gives (DIF-01/02/03/05/07..10).

A *digest* has the units of a document as arrays: their places (``pos``), their
lengths (``len``) and the hashes that a change of them adds to the change hash
(``minus`` and ``plus``, of ``diffs.unit_hash_part``).  Both hashes together, 120
bits of SHA-256, tell units apart, so a diff needs no text: a pair is a few rows
that are shuffled once, and ``pair_metrics`` works out the bag diff and runs of
``diffs.label_units`` and ``with_runs`` for all pairs of a batch at once.

Only text lines with a word of some term keep their text (``hits``); they come
back with their ``op`` for the second comparison (TRM-01).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelens.operators import diffs as dif
from changelens.session import prepare_python

#: A unit's fields in a digest, and of links the hash of the href.
FIELDS = ["pos", "len", "minus", "plus"]
LINK, SOURCE, TEXT, END = "link", "source", "text", "end"
_KINDS = {LINK: 0, SOURCE: 1, TEXT: 2}

_INTS, _LONGS = T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType())


def _fields(**kinds: T.DataType) -> list[T.StructField]:
    return [T.StructField(name, kind) for name, kind in kinds.items()]


_INT, _LONG, _STR, _BOOL = T.IntegerType(), T.LongType(), T.StringType(), T.BooleanType()
HITS = T.ArrayType(T.StructType(_fields(at=_INT, unit=_STR)))
DIGEST = _fields(pos=_INTS, len=_INTS, minus=_LONGS, plus=_LONGS)
ROW = T.StructType([*_fields(side=_STR, kind=_STR, client=_STR, self_a=_LONG, self_b=_LONG), *DIGEST, *_fields(href=_LONGS, hits=HITS)])
LINES = T.ArrayType(T.StructType(_fields(side=_STR, pos=_INT, line=_INT, op=_INT, unit=_STR)))
METRICS = T.StructType(_fields(
    ends=_INT, a_client=_STR, b_client=_STR, ln=_LONG, lt=_LONG, lh=_STR, own=_BOOL, sn=_LONG, sc=_LONG, st=_LONG, sh=_STR, runs=_LONG,
    tn=_LONG, tc=_LONG, tt=_LONG, th=_STR, text_runs=_LONG, longest=_LONG, repeated=_BOOL, lines=LINES))


def prefix(c: Column) -> Column:
    """60 bits of a string's SHA-256, as ``diffs.unit_hash_part`` takes them."""
    return F.conv(F.substring(F.sha2(c, 256), 1, 15), 16, 10).cast("bigint")


def packed(units: DataFrame, keys: list[str], href: Column | None = None) -> DataFrame:
    """One digest for each document: ``units`` are rows of ``keys``, pos and unit, which meet in no shuffle
    when they are dealt out by one of the keys already."""
    part = lambda op: dif.unit_hash_part(F.lit(op), F.col("unit")).cast("bigint")
    sized = units.select(*keys, F.struct(
        F.col("pos").cast("int").alias("pos"), F.coalesce(F.length("unit"), F.lit(0)).alias("len"), F.coalesce(part(-1), F.lit(-1)).alias("minus"),
        F.coalesce(part(1), F.lit(-1)).alias("plus"), (F.lit(None).cast("bigint") if href is None else href).alias("href")).alias("_u"))
    rows = sized.groupBy(*keys).agg(F.collect_list("_u").alias("_u"))
    return rows.select(*keys, *[F.col(f"_u.{f}").alias(f) for f in (*FIELDS, "href")])


def text_digests(bodies: DataFrame, words: set[str]) -> DataFrame:
    """(body_id, pos, len, minus, plus, hits) of rows (body_id, lines): ``hits`` are the lines that have one of ``words``."""
    spark = bodies.sparkSession
    shared = spark.sparkContext.broadcast(words)
    schema = T.StructType([*_fields(body_id=_STR), *DIGEST, *_fields(hits=HITS)])
    kinds = [pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()),
             pa.list_(pa.struct([("at", pa.int32()), ("unit", pa.string())]))]

    def part(op: bytes, unit: str) -> int:
        return int(hashlib.sha256(op + unit.encode()).hexdigest()[:15], 16)

    def rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in it:
            lines = [[(u["pos"], u["unit"]) for u in of or ()] for of in b.column(1).to_pylist()]
            cols = [b.column(0), [[p for p, _ in of] for of in lines], [[len(u) for _, u in of] for of in lines],
                    [[part(b"-1\t", u) for _, u in of] for of in lines], [[part(b"1\t", u) for _, u in of] for of in lines],
                    [[{"at": i, "unit": u} for i, (_, u) in enumerate(of) if not known.isdisjoint(u.split(" "))] for of in lines]]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], schema.fieldNames())

    prepare_python(spark)
    return bodies.mapInArrow(rows, schema)


def _flat(column: pa.Array) -> np.ndarray:
    return pc.list_flatten(column).to_numpy(zero_copy_only=False)


def _sums(values: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    np.add.at(out, of, values)
    return out


class _Diffs:
    """The bag diffs and runs of ``n`` groups: units given by group, side (0, 1), place and two hashes."""

    def __init__(self, group, side, pos, size, minus, plus, n: int) -> None:
        order = np.lexsort((pos, side, plus, minus, group))
        g, s, m, p = group[order], side[order], minus[order], plus[order]
        new = np.ones(len(order), bool)
        new[1:] = (g[1:] != g[:-1]) | (m[1:] != m[:-1]) | (p[1:] != p[:-1])
        unit = np.cumsum(new) - 1
        of_side = np.zeros((unit[-1] + 1 if len(unit) else 0, 2), np.int64)
        np.add.at(of_side, (unit, s), 1)
        start = np.flatnonzero(new)
        k = np.arange(len(order)) - start[unit] - np.where(s == 1, of_side[unit, 0], 0)  # occurrences before this one
        changed = np.empty(len(order), bool)
        changed[order] = k >= of_side[unit, 1 - s]
        self.changed = changed
        # In document order: the runs of changed units, and each unit's line.
        order = np.lexsort((pos, side, group))
        g, s, ch, p = group[order], side[order], changed[order], pos[order]
        first = np.ones(len(order), bool)
        first[1:] = (g[1:] != g[:-1]) | (s[1:] != s[:-1])
        at = np.arange(len(order))
        self.line = np.empty(len(order), np.int64)
        self.line[order] = at - np.maximum.accumulate(np.where(first, at, 0)) + 1
        again = np.zeros(len(order), bool)
        again[1:] = ~first[1:] & (p[1:] == p[:-1])
        self.repeated = np.bincount(g[again], minlength=n) > 0
        begins = ch & (first | ~np.concatenate(([False], ch[:-1])))
        run = np.cumsum(begins) - 1
        runs = int(begins.sum())
        length = _sums(size[order][ch], run[ch], runs) + np.bincount(run[ch], minlength=runs) - 1
        self.runs = np.bincount(g[begins], minlength=n)
        self.longest = np.zeros(n, np.int64)
        np.maximum.at(self.longest, g[begins], length)
        # Sums for each group; hashes in halves, as their sum goes beyond 64 bits.
        self.n_changed = np.bincount(group[changed], minlength=n)
        shown = changed | (side == 0)
        self.n_shown = np.bincount(group[shown], minlength=n)
        self.size_changed, self.size_shown = _sums(size[changed], group[changed], n), _sums(size[shown], group[shown], n)
        part = np.maximum(np.where(side == 0, minus, plus)[changed], 0)
        low, high = _sums(part & 0x3FFFFFFF, group[changed], n), _sums(part >> 30, group[changed], n)
        self.hashes = [str((int(h) << 30) + int(x)) for h, x in zip(high, low, strict=True)]


def _measured(t: pa.Table, schema: T.StructType) -> pa.RecordBatch:
    """The metrics of the pairs of ``t``, whole pairs one after the other."""
    b = {name: t.column(name).combine_chunks() for name in t.column_names}
    coded = pc.dictionary_encode(b["pair_id"])
    pair, pairs = coded.indices.to_numpy(), coded.dictionary
    n = len(pairs)
    kind, side = b["kind"].to_pylist(), (pc.equal(b["side"], "b")).to_numpy(zero_copy_only=False).astype(np.int64)
    count = pc.fill_null(pc.list_value_length(b["pos"]), 0).to_numpy()
    row = np.repeat(np.arange(t.num_rows), count)
    code = np.array([_KINDS.get(k, 0) for k in kind], np.int64)
    pos, size, minus, plus = (_flat(b[f]).astype(np.int64) for f in FIELDS)
    group = (pair.astype(np.int64) * 3 + code)[row]
    d = _Diffs(group, side[row], pos, size, minus, plus, 3 * n)
    # a link to the page itself that went away
    selfs = [pc.fill_null(b[c], -1).to_numpy() for c in ("self_a", "self_b")]
    lost = np.flatnonzero((code[row] == 0) & (side[row] == 0) & d.changed)
    own = np.zeros(n, bool)
    if len(lost):
        starts = np.cumsum(count) - count
        href, has = np.full(len(row), -2, np.int64), count * (pc.fill_null(pc.list_value_length(b["href"]), 0).to_numpy() > 0)
        given = pc.fill_null(pc.list_flatten(b["href"]), -2).to_numpy()
        href[np.repeat(starts, has) + np.arange(int(has.sum())) - np.repeat(np.cumsum(has) - has, has)] = given
        mine = (href[lost] == selfs[0][row[lost]]) | (href[lost] == selfs[1][row[lost]])
        own[pair[row[lost][mine]]] = True
    # ends that are there, and their client redirects: as F.max takes them
    ends, clients = np.zeros(n, np.int64), ([None] * n, [None] * n)
    for i, (k, c) in enumerate(zip(kind, b["client"].to_pylist(), strict=True)):
        if k == END:
            ends[pair[i]] += 1
            of = clients[side[i]]
            of[pair[i]] = c if of[pair[i]] is None else max(of[pair[i]], c or "") if c is not None else of[pair[i]]
    # lines with a word of some term; those of repeated places are no lines of one text
    lines: list[list] = [[] for _ in range(n)]
    repeated = d.repeated[2::3]
    starts = np.cumsum(count) - count
    for i, hits in enumerate(b["hits"].to_pylist()):
        if not hits or repeated[pair[i]]:
            continue
        for h in hits:
            u = starts[i] + h["at"]
            op = 0 if not d.changed[u] else 1 if side[i] else -1
            lines[pair[i]].append({"side": "ab"[side[i]], "pos": int(pos[u]), "line": int(d.line[u]), "op": op, "unit": h["unit"]})
    link, source, text = (slice(k, None, 3) for k in range(3))
    out = [pairs, pa.array(ends, pa.int32()), pa.array(clients[0], pa.string()), pa.array(clients[1], pa.string()),
           d.n_changed[link], d.n_shown[link], pa.array(d.hashes[link], pa.string()), pa.array(own),
           d.n_changed[source], d.size_changed[source], d.size_shown[source], pa.array(d.hashes[source], pa.string()), d.runs[source],
           d.n_changed[text], d.size_changed[text], d.size_shown[text], pa.array(d.hashes[text], pa.string()), d.runs[text], d.longest[text],
           pa.array(repeated), pa.array(lines, pa.list_(pa.struct([("side", pa.string()), ("pos", pa.int32()), ("line", pa.int32()), ("op", pa.int32()), ("unit", pa.string())])))]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c.astype(np.int64)) for c in out], schema.fieldNames())


def pair_metrics(rows: DataFrame) -> DataFrame:
    """(pair_id, ``METRICS``) of rows (pair_id, ``ROW``): the digests of both ends of each pair, and a row of kind
    ``end`` for every end that could be read.  Rows are shuffled by the pair once, a pair is its documents."""
    schema = T.StructType([rows.schema["pair_id"], *METRICS.fields])

    def measured(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for b in it:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            t = t if rest is None else pa.concat_tables([rest, t])
            last = t.column("pair_id")[t.num_rows - 1]
            cut = pc.index(pc.equal(t.column("pair_id"), last), True).as_py()  # the last pair may go on
            if cut:
                yield _measured(t.slice(0, cut), schema)
            rest = t.slice(cut)
        if rest is not None:
            yield _measured(rest, schema)

    prepare_python(rows.sparkSession)
    sent = rows.where(F.col("pair_id").isNotNull()).select("pair_id", *[F.col(f.name).cast(f.dataType) for f in ROW])
    return sent.repartition("pair_id").sortWithinPartitions("pair_id").mapInArrow(measured, schema)


def _ratio(n: str, t: str) -> Column:
    return F.coalesce(F.round(F.col(n) / F.nullif(F.col(t), F.lit(0)), 4), F.lit(0.0)).cast("double")


def html_columns() -> list[Column]:
    """``links`` and ``source`` as of ``analysis.html_metrics``, from ``pair_metrics``."""
    return [
        F.struct(dif.multiset_hash(F.col("ln"), F.col("lh")).alias("diff_hash"), F.col("ln").alias("diff_length"),
                 _ratio("ln", "lt").alias("diff_ratio"), F.col("own").alias("removed_self_link")).alias("links"),
        F.struct(dif.multiset_hash(F.col("sn"), F.col("sh")).alias("diff_hash"), F.col("runs").alias("diff_count"),
                 (F.col("sc") + F.col("sn") - F.col("runs")).alias("diff_length"), _ratio("sc", "st").alias("diff_ratio")).alias("source")]


def text_columns() -> list[Column]:
    """The columns of ``diffs.text_metrics`` but for the key, from ``pair_metrics``."""
    return [_ratio("tc", "tt").alias("percent_changed"), dif.multiset_hash(F.col("tn"), F.col("th")).alias("diff_hash"),
            F.col("text_runs").alias("diff_count"), (F.col("tc") + F.col("tn") - F.col("text_runs")).alias("diff_length"),
            F.col("longest").alias("diff_max_length")]
