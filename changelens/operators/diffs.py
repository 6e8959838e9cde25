"""Text, source and link diffs as multiset joins (DIF-03..10).

A pair is ``(pair_id, a, b)``.  Both sides are exploded into units (a
normalised line, a raw source line, a link); a unit's k-th occurrence on one
side matches the k-th occurrence on the other side, which is bag difference
(``EXCEPT ALL`` both ways) with positions kept.  A moved unit is therefore
never a change (DIF-04).  Contiguous changed units of one side form one
change (DIF-05); run ids come from a running count of unchanged units.

All windows are partitioned by ``(pair_id, side[, unit])`` - one document,
never one page's whole history - and the change hash is an order-free sum of
per-unit SHA-256 prefixes, so no step collects a group into an array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changelens.functions import text as tx

EMPTY_HASH = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def pair_ends(pairs: DataFrame, a: str, b: str, key: str = "pair_id") -> DataFrame:
    """(key, side, doc) for both ends of each pair."""
    return pairs.select(F.col(key).alias("pair_id"), F.lit("a").alias("side"), F.col(a).alias("doc")).unionByName(
        pairs.select(F.col(key).alias("pair_id"), F.lit("b").alias("side"), F.col(b).alias("doc")))


def text_units(pairs: DataFrame, bodies: DataFrame, a: str = "a_doc", b: str = "b_doc",
               body_key: str = "doc_id", body_col: str = "text", normalize: bool = True) -> DataFrame:
    """(pair_id, side, pos, unit): non-empty lines of each end's body.

    Bodies are joined late, only for the ends of ``pairs``; the ends table
    is tiny next to the bodies, so AQE broadcasts it and bodies stream
    through without a shuffle.
    """
    ends = pair_ends(pairs, a, b)
    j = bodies.select(F.col(body_key).alias("doc"), F.col(body_col).alias("_body")).join(ends, "doc")
    if normalize:
        lines = tx.normalized_lines(F.col("_body"))
    else:
        lines = F.filter(F.transform(F.split(F.col("_body"), "\n"),
                                     lambda l, i: F.struct(i.alias("pos"), l.alias("unit"))),
                         lambda x: F.trim(x["unit"]) != "")
    return j.select("pair_id", "side", F.inline(lines))


def label_units(units: DataFrame, group: tuple[str, ...] = ("pair_id",)) -> DataFrame:
    """DIF-03: add ``op`` (0 unchanged, -1 removed from a, +1 added in b).

    ``group`` identifies one diff (a pair, or a pair and a unit kind)."""
    # One shuffle by the pair serves these windows and all that follow: a pair is two documents.
    units = units.repartition(group[0])
    w_side = Window.partitionBy(*group, "unit", "side").orderBy("pos")
    w_unit = Window.partitionBy(*group, "unit")
    na = F.sum(F.when(F.col("side") == "a", 1).otherwise(0)).over(w_unit)
    nb = F.sum(F.when(F.col("side") == "b", 1).otherwise(0)).over(w_unit)
    k = F.row_number().over(w_side)
    other = F.when(F.col("side") == "a", nb).otherwise(na)
    op = F.when(k <= other, F.lit(0)).when(F.col("side") == "a", F.lit(-1)).otherwise(F.lit(1))
    return units.withColumn("op", op.cast("int"))


def with_runs(labelled: DataFrame, group: tuple[str, ...] = ("pair_id",)) -> DataFrame:
    """Add ``run_id``: the unchanged units of the side up to a unit.  Added before
    rows are staged, it lets ``text_metrics`` combine them where they are read."""
    w = Window.partitionBy(*group, "side").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return labelled.withColumn("run_id", F.sum(F.when(F.col("op") == 0, 1).otherwise(0)).over(w))


def runs(labelled: DataFrame) -> DataFrame:
    """DIF-05: one row per change: (pair_id, side, run_id, op, n_units, length, first_pos)."""
    r = with_runs(labelled)
    return (
        r.where(F.col("op") != 0)
        .groupBy("pair_id", "side", "run_id")
        .agg(
            F.first("op").alias("op"),
            F.count("*").alias("n_units"),
            (F.sum(F.length("unit")) + F.count("*") - 1).alias("length"),
            F.min("pos").alias("first_pos"),
        )
    )


def unit_hash_part(op: Column, unit: Column) -> Column:
    """60-bit prefix of SHA-256(op TAB unit) as DECIMAL(38,0) (summable)."""
    h = F.sha2(F.concat(op.cast("string"), F.lit("\t"), unit), 256)
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("decimal(38,0)")


def multiset_hash(n: Column, s: Column) -> Column:
    """DIF-09: hash of a multiset of changes from (count, sum of parts);
    SHA-256 of '' (the reference's empty-change constant) when nothing changed."""
    return F.when(F.coalesce(n, F.lit(0)) == 0, F.lit(EMPTY_HASH)).otherwise(
        F.sha2(F.concat(n.cast("string"), F.lit(":"), s.cast("string")), 256))


def text_metrics(labelled: DataFrame) -> DataFrame:
    """DIF-08/09/10 per pair: percent_changed, diff_hash, diff_count,
    diff_length, diff_max_length."""
    changed = F.col("op") != 0
    # Lengths and hashes of the units go on, the texts stay behind.
    known = [c for c in ("run_id",) if c in labelled.columns]
    sized = labelled.select("pair_id", "side", "pos", "op", *known, F.length("unit").alias("_len"),
                            F.when(changed, unit_hash_part(F.col("op"), F.col("unit"))).alias("_h"))
    per_run = (sized if known else with_runs(sized)).groupBy("pair_id", "side", "run_id", changed.alias("_changed")).agg(
        F.sum("_len").alias("_len"), F.count("*").alias("_units"), F.sum("_h").alias("_h"))
    length = F.when(F.col("_changed"), F.col("_len") + F.col("_units") - 1)
    per_pair = per_run.groupBy("pair_id").agg(
        F.sum(F.when(F.col("_changed"), F.col("_len")).otherwise(0)).alias("_chg"),
        F.sum(F.when(F.col("_changed") | (F.col("side") == "a"), F.col("_len")).otherwise(0)).alias("_tot"),
        F.sum(F.when(F.col("_changed"), F.col("_units")).otherwise(0)).alias("_nchg"),
        F.sum("_h").alias("_hs"),
        F.count(F.when(F.col("_changed"), 1)).alias("diff_count"),
        F.sum(length).alias("diff_length"),
        F.max(length).alias("diff_max_length"),
    )
    return per_pair.select(
        "pair_id",
        F.coalesce(F.round(F.col("_chg") / F.nullif(F.col("_tot"), F.lit(0)), 4), F.lit(0.0)).cast("double").alias("percent_changed"),
        multiset_hash(F.col("_nchg"), F.col("_hs")).alias("diff_hash"),
        F.coalesce(F.col("diff_count"), F.lit(0)).cast("bigint").alias("diff_count"),
        F.coalesce(F.col("diff_length"), F.lit(0)).cast("bigint").alias("diff_length"),
        F.coalesce(F.col("diff_max_length"), F.lit(0)).cast("bigint").alias("diff_max_length"),
    )


# ------------------------------------------------------------------ DIF-06
def ordered_diff(labelled: DataFrame) -> DataFrame:
    """DIF-06: both documents of each pair as one sequence of units
    (pair_id, seq, op, unit): the newer document in its order, and each
    removed unit right after the place, in the newer document, of the last
    kept unit before it.

    Kept units are partners when they are the same occurrence of the same
    unit on both sides; a window over those gives every kept unit of the older
    document its place in the newer one.  Windows are per pair, so rows stay
    where ``label_units`` brought them: one document."""
    occurrence = F.row_number().over(Window.partitionBy("pair_id", "unit", "side").orderBy("pos"))
    old, kept = F.col("side") == "a", F.col("op") == 0
    partner = F.max(F.when(~old & kept, F.col("pos"))).over(Window.partitionBy("pair_id", "unit", "k"))
    x = labelled.withColumn("k", occurrence).withColumn("b_pos", F.when(old, partner))
    before = Window.partitionBy("pair_id", "side").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    at = F.when(old, F.coalesce(F.last("b_pos", ignorenulls=True).over(before), F.lit(-1))).otherwise(F.col("pos"))
    rows = x.withColumn("at", at).where(~old | (F.col("op") == -1))
    seq = F.row_number().over(Window.partitionBy("pair_id").orderBy("at", "side_order", "pos"))
    return rows.withColumn("side_order", old.cast("int")).select("pair_id", seq.alias("seq"), "op", "unit")
