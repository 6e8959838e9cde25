"""DIF-06: shortest edit scripts of ordered units.

``diffs`` compares bags of units, where a moved unit is no change.  Here order
counts: the units that stay are a longest common subsequence of both sides, so
a moved unit is removed in one place and added in the other, and runs of
changes have exact borders.  Spark deals the pairs out; one pair of documents
is one group, and what it needs grows with its length only.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelens.session import prepare_python


def _increasing(places: Sequence[int]) -> list[int]:
    """Indices of a longest increasing subsequence, by patience: piles are kept by
    their top card, and each card remembers the top of the pile before it."""
    tops: list[int] = []
    at: list[int] = []
    before: list[int] = []
    for i, p in enumerate(places):
        k = bisect_left(tops, p)
        before.append(at[k - 1] if k else -1)
        if k == len(tops):
            tops.append(p)
            at.append(i)
        else:
            tops[k], at[k] = p, i
    out = []
    i = at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def _lengths(a: Sequence[int], b: Sequence[int]) -> np.ndarray:
    """For every prefix of ``b`` the length of its longest common subsequence with ``a``.

    One row of the table is one long integer whose zero bits say where the
    length grows; a unit of ``a`` is a few operations on it."""
    has: dict[int, int] = {}
    for j, y in enumerate(b):
        has[y] = has.get(y, 0) | 1 << j
    mask = (1 << len(b)) - 1
    v = mask
    for x in a:
        if u := v & has.get(x, 0):
            v = ((v + u) | (v - u)) & mask
    bits = np.unpackbits(np.frombuffer(v.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate(([0], np.cumsum(1 - bits, dtype=np.int64)))


def _common(a: Sequence[int], b: Sequence[int], at_a: int, at_b: int, out: list[tuple[int, int]]) -> None:
    """Add the places of a longest common subsequence of ``a`` and ``b`` to ``out``, in order."""
    n = min(len(a), len(b))
    front = next((i for i in range(n) if a[i] != b[i]), n)
    n -= front
    back = next((i for i in range(n) if a[-1 - i] != b[-1 - i]), n)
    out += [(at_a + i, at_b + i) for i in range(front)]
    inner_a, inner_b = a[front : len(a) - back], b[front : len(b) - back]
    both = set(inner_a) & set(inner_b)
    if both:
        left = [(front + i, x) for i, x in enumerate(inner_a) if x in both]
        right = [(front + j, y) for j, y in enumerate(inner_b) if y in both]
        if len(left) == len(right) == len(both):  # each once on either side
            place = {y: j for j, y in right}
            stay = _increasing([place[x] for _, x in left])
            out += [(at_a + left[i][0], at_b + place[left[i][1]]) for i in stay]
        elif len(left) == 1:
            out.append((at_a + left[0][0], at_b + right[0][0]))
        else:
            # cut the left side in the middle and the right side where both halves keep most
            half = len(left) // 2
            xs, ys = [x for _, x in left], [y for _, y in right]
            keeps = _lengths(xs[:half], ys) + _lengths(xs[half:][::-1], ys[::-1])[::-1]
            cut = int(np.argmax(keeps))
            found: list[tuple[int, int]] = []
            _common(xs[:half], ys[:cut], 0, 0, found)
            _common(xs[half:], ys[cut:], half, cut, found)
            out += [(at_a + left[i][0], at_b + right[j][0]) for i, j in found]
    out += [(at_a + len(a) - back + i, at_b + len(b) - back + i) for i in range(back)]


def kept_places(a: Sequence, b: Sequence) -> list[tuple[int, int]]:
    """Places (in ``a``, in ``b``) of a longest common subsequence, in order.

    Equal ends are set aside and units that only one side has are left out.
    Where each unit is there once, the rest is the longest increasing
    subsequence of its places (n log n); otherwise it is halved, with a row of
    bits as the only table, so memory is linear."""
    number: dict = {}
    out: list[tuple[int, int]] = []
    _common([number.setdefault(x, len(number)) for x in a], [number.setdefault(y, len(number)) for y in b], 0, 0, out)
    return out


def ordered_script(units: DataFrame) -> DataFrame:
    """(pair_id, seq, op, pos, unit) for (pair_id, side, pos, unit): the newer
    document in its order, and each removed unit after the last kept unit
    before it; ``pos`` is the unit's own, of its side.

    A side without units is an empty document; equal documents have no change."""
    pair = units.schema["pair_id"]
    at = units.schema["pos"]
    schema = T.StructType([pair, T.StructField("seq", T.IntegerType()), T.StructField("op", T.IntegerType()), at, units.schema["unit"]])

    def script(group: pa.Table) -> pa.Table:
        group = group.combine_chunks().sort_by("pos")
        sides = [group.filter(pa.compute.equal(group["side"], s)) for s in "ab"]
        (old_at, old), (new_at, new) = ((t["pos"].to_pylist(), t["unit"].to_pylist()) for t in sides)
        rows, i, j = [], 0, 0
        for x, y in [*kept_places(old, new), (len(old), len(new))]:
            rows += [(-1, old_at[k], old[k]) for k in range(i, x)]
            rows += [(1, new_at[k], new[k]) for k in range(j, y)]
            if y < len(new):
                rows.append((0, new_at[y], new[y]))
            i, j = x + 1, y + 1
        columns = [*zip(*rows, strict=True)] if rows else [[], [], []]
        of = group["pair_id"].combine_chunks().take(pa.array([0] * len(rows), pa.int64()))
        return pa.table([of, pa.array(range(1, len(rows) + 1), pa.int32()), pa.array(columns[0], pa.int32()),
                         pa.array(columns[1], group["pos"].type), pa.array(columns[2], group["unit"].type)], names=schema.fieldNames())

    prepare_python(units.sparkSession)
    return units.select("pair_id", "side", "pos", "unit").groupBy("pair_id").applyInArrow(script, schema)


def script_runs(script: DataFrame) -> DataFrame:
    """DIF-05 of a script: one row for each change with exact borders: (pair_id,
    run_id, op, n_units, length, first_pos), ``run_id`` counting the kept units before it."""
    w = Window.partitionBy("pair_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    r = script.withColumn("run_id", F.sum(F.when(F.col("op") == 0, 1).otherwise(0)).over(w))
    return (r.where("op <> 0").groupBy("pair_id", "run_id", "op")
            .agg(F.count("*").alias("n_units"), (F.sum(F.length("unit")) + F.count("*") - 1).alias("length"), F.min("pos").alias("first_pos")))
