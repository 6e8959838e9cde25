"""Version selection: timeframe membership, baseline look-back, trimming,
endpoints, latest captures and change rate (VER-01..07, FLT-01/02).

Design
------
The reference walks each page's capture list newest-first.  Here every step
is a *per-page aggregate joined back to the rows*: counts and ``max``/``min``
of ``struct(capture_time, version_id, ...)`` (struct order = newest/oldest,
the id breaks ties).  Aggregates combine map-side, so a page holding a third
of all captures never lands in one task; the per-page summaries are small and
AQE broadcasts them once their real size is known (else a sort-merge join
with skew splitting).  No step sorts a page's captures.

``key`` is the grouping column: ``page_id`` for a whole timeframe, a node id
inside deep search (VER-08).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the reference's selection rules.
LOOKBACK_ROWS = 100          # captures examined below the first pre-range one
LOOKBACK_DAYS = 31           # "more than 30 whole days" stops the look-back


def ts_lit(value, like_type: str = "timestamp_ntz") -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, (_dt.datetime, _dt.date)):
        value = value.isoformat(sep=" ") if isinstance(value, _dt.datetime) else value.isoformat()
    return F.lit(str(value)).cast(like_type)


def _time_type(df: DataFrame) -> str:
    return dict(df.dtypes).get("capture_time", "timestamp_ntz")


def ok_col() -> Column:
    """Order key of a capture: newest = greatest."""
    return F.struct(F.col("capture_time"), F.col("version_id"))


def status_error_class(status: Column) -> Column:
    """VER-03: 4/5/6 for 4xx/5xx/no status (null and 0 count as 600), else 0."""
    s = F.coalesce(F.nullif(status, F.lit(0)), F.lit(600))
    cls = F.floor(s / 100).cast("int")
    return F.when(cls >= 4, cls).otherwise(F.lit(0))


def default_quality() -> Column:
    """FLT-02's input where captures carry no ``quality``: 0.5 for errors and
    captures without a status, else 1."""
    return F.when(F.coalesce(F.col("status"), F.lit(600)) >= 400, F.lit(0.5)).otherwise(F.lit(1.0))


def in_frame(after, before, time_type: str = "timestamp_ntz") -> Column:
    """FLT-01: half-open ``after <= capture_time < before``."""
    t = F.col("capture_time")
    return (t >= ts_lit(after, time_type)) & (t < ts_lit(before, time_type))


def _record(cols: list[str]) -> Column:
    return F.struct(*[F.col(c) for c in cols])


def _keys(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _newest(rec: Column, where: Column) -> Column:
    """The record of the newest row that qualifies.  The order is that of
    time and id alone, so records may hold maps."""
    return F.max_by(rec, F.when(where, ok_col()))


def select_versions(v: DataFrame, after, before, key: str | list[str] = "page_id",
                    quality: Column | str = "quality") -> DataFrame:
    """VER-01 + VER-02.  Returns the selected captures with ``is_baseline``.

    * in-frame captures of good quality; if there are none and an older
      capture exists, the questionable in-frame ones instead;
    * plus a baseline: the newest capture before ``after``; if that one is
      questionable, the newest good capture among the next 100 older ones
      and less than 31 days older than it, else the questionable one.

    One aggregate per key yields the counts, the newest older capture and the
    newest good older one (all good ones are older than a questionable
    newest).  A second one, for the keys with a questionable baseline only,
    counts the captures between the two.
    """
    tt = _time_type(v)
    keys = _keys(key)
    if isinstance(quality, str):
        quality = F.col(quality) if quality in v.columns else default_quality()
    q = quality
    cols = v.columns
    c = v.where(F.col("capture_time") < ts_lit(before, tt)).withColumn("_good", q >= 1.0)
    inr = F.col("capture_time") >= ts_lit(after, tt)
    rec = _record(cols + ["_good"])

    s = c.groupBy(*keys).agg(
        F.count(F.when(inr & F.col("_good"), 1)).alias("_n_good"),
        F.count(F.when(inr & ~F.col("_good"), 1)).alias("_n_q"),
        _newest(rec, ~inr).alias("_b0"),
        _newest(rec, ~inr & F.col("_good")).alias("_g"),
    )
    mode = (F.when(F.col("_n_good") > 0, F.lit(1))
            .when(F.col("_b0").isNotNull() & (F.col("_n_q") > 0), F.lit(2)))
    s = s.withColumn("_mode", mode).where(F.col("_mode").isNotNull())

    in_sel = (
        c.where(inr)
        .join(s.select(*keys, "_mode"), keys)
        .where(F.when(F.col("_mode") == 1, F.col("_good")).otherwise(~F.col("_good")))
        .select(*cols, F.lit(False).alias("is_baseline"))
    )

    near = F.col("_g.capture_time") > F.col("_b0.capture_time") - F.expr(f"INTERVAL {LOOKBACK_DAYS} DAYS")
    need = s.where(~F.col("_b0._good") & near).select(
        *keys, F.struct("_g.capture_time", "_g.version_id").alias("_g_ok"))
    between = (
        c.where(~inr).select(*keys, ok_col().alias("_ok")).join(need, keys).where(F.col("_ok") > F.col("_g_ok"))
        .groupBy(*keys).agg(F.count("*").alias("_between"))
    )
    reached = F.coalesce(F.col("_between") <= LOOKBACK_ROWS, F.lit(False))  # the questionable one itself counts
    base = (
        s.where(F.col("_b0").isNotNull()).select(*keys, "_b0", "_g").join(between, keys, "left")
        .select(F.when(~F.col("_b0._good") & reached, F.col("_g")).otherwise(F.col("_b0")).alias("_r"))
        .select(*[F.col(f"_r.{c}").alias(c) for c in cols], F.lit(True).alias("is_baseline"))
    )
    return in_sel.unionByName(base)


def in_frames(v: DataFrame, frames: list[tuple]) -> DataFrame:
    """Every capture once for each timeframe that it may matter to (all
    before the frame's end), with ``frame``, ``_after`` and ``_before``."""
    tt = _time_type(v)
    known = F.array(*[F.struct(F.lit(i).alias("frame"), ts_lit(a, tt).alias("_after"), ts_lit(b, tt).alias("_before"))
                      for i, (a, b) in enumerate(frames)])
    return v.select("*", F.inline(F.filter(known, lambda f: F.col("capture_time") < f["_before"])))


def select_frames(v: DataFrame, frames: list[tuple], key: str = "page_id") -> DataFrame:
    """``select_versions`` for several timeframes in the same passes; adds ``frame``."""
    return select_versions(in_frames(v, frames), F.col("_after"), F.col("_before"), ["frame", key]).drop("_after", "_before")


def trim_versions(sel: DataFrame, key: str | list[str] = "page_id") -> DataFrame:
    """VER-04: collapse a same-ish run at the newest end, then at the oldest.

    A run continues while the error class equals the end row's (when that is
    an error) or else while ``body_hash`` is null-safe equal; the innermost
    row of the run is kept.  Needs >= 3 rows, re-checked before the second
    end.  Three small aggregates find the bounds ``lo <= ok <= hi``.
    """
    ok = ok_col()
    keys = _keys(key)
    ec = status_error_class(F.col("status"))
    x = sel.withColumn("_ec", ec)
    S = x.groupBy(*keys).agg(
        F.count("*").alias("_n"),
        F.max(F.struct(ok.alias("ok"), F.col("_ec").alias("ec"), F.col("body_hash").alias("h"))).alias("_e"),
        F.min(F.struct(ok.alias("ok"), F.col("_ec").alias("ec"), F.col("body_hash").alias("h"))).alias("_o"),
    )

    def member(end: str) -> Column:
        return F.when(F.col(f"{end}.ec") != 0, F.col("_ec") == F.col(f"{end}.ec")).otherwise(
            F.col("body_hash").eqNullSafe(F.col(f"{end}.h")))

    T = (
        x.join(S.where(F.col("_n") >= 3), keys)
        .groupBy(*keys)
        .agg(
            F.first("_n").alias("_n"),
            F.first("_o").alias("_o"),
            F.max(F.when(~member("_e"), ok)).alias("_m1"),
            F.min(F.when(~member("_o"), ok)).alias("_M"),
        )
    )
    U = (
        x.join(T.where(F.col("_m1").isNotNull()).select(*keys, "_m1", "_M"), keys)
        .groupBy(*keys)
        .agg(
            F.min(F.when(ok > F.col("_m1"), ok)).alias("_succ"),
            F.count(F.when(ok > F.col("_m1"), 1)).alias("_newer"),
            F.max(F.when(ok < F.col("_M"), ok)).alias("_pred"),
            F.first("_M").alias("_M2"),
        )
    )
    TU = T.join(U, keys, "left")
    r1 = F.col("_n") - F.col("_newer") + 1
    lo = (F.when(F.col("_m1").isNull(), F.col("_o.ok"))
          .when(r1 < 3, F.lit(None))
          .when(F.col("_M2").isNull() | (F.col("_M2") > F.col("_succ")), F.col("_succ"))
          .otherwise(F.col("_pred")))
    hi = F.when(F.col("_m1").isNull(), F.col("_o.ok")).otherwise(F.col("_succ"))
    bounds = TU.select(*keys, lo.alias("_lo"), hi.alias("_hi"))
    out = x.drop("_ec").join(bounds, keys, "left").where(
        (F.col("_lo").isNull() | (ok >= F.col("_lo"))) & (F.col("_hi").isNull() | (ok <= F.col("_hi"))))
    return out.drop("_lo", "_hi")


def endpoints(trimmed: DataFrame, key: str = "page_id") -> DataFrame:
    """VER-05: one row per key with ``n_versions``, oldest ``a`` and newest ``b``."""
    rec = _record([c for c in trimmed.columns if c != key])
    return trimmed.groupBy(key).agg(
        F.count("*").cast("int").alias("n_versions"),
        F.min_by(rec, ok_col()).alias("a"),
        F.max_by(rec, ok_col()).alias("b"),
    )


def latest_valid(v: DataFrame, trimmed: DataFrame, key: str = "page_id") -> DataFrame:
    """VER-06: latest capture of each page and the latest *valid* one (the
    newest capture of the trimmed selection, else the latest capture)."""
    cols = [c for c in v.columns if c != key]
    latest = v.groupBy(key).agg(F.max_by(_record(cols), ok_col()).alias("latest"))
    valid = trimmed.groupBy(key).agg(F.max(ok_col()).alias("_s"))
    out = latest.join(valid, key, "left")
    return out.select(key, "latest", F.coalesce(F.col("_s.version_id"), F.col("latest.version_id")).alias("valid_id"),
                      F.coalesce(F.col("_s.capture_time"), F.col("latest.capture_time")).alias("valid_time"))


# Fixed values of the (unused by the reference) change-rate factor.
RATE_PEAK = 0.6       # changes/day with the highest factor
RATE_ZERO = 0.8       # changes/day above which the factor is negative
RATE_FLOOR = -1.0


def change_rate(trimmed: DataFrame, after, before, key: str = "page_id") -> DataFrame:
    """VER-07: versions/day over the timeframe (baseline not counted) and the
    change-rate factor."""
    tt = _time_type(trimmed)
    days = (F.unix_timestamp(ts_lit(before, "timestamp")) - F.unix_timestamp(ts_lit(after, "timestamp"))) / 86400
    whole_days = F.floor(days)
    n = F.count(F.when(F.col("capture_time") >= ts_lit(after, tt), 1))
    agg = trimmed.groupBy(key).agg(n.alias("n_changes"))
    rate = F.col("n_changes") / whole_days
    factor = F.when(rate <= RATE_PEAK, rate / RATE_PEAK).otherwise(
        F.greatest(1 - (rate - RATE_PEAK) / (RATE_ZERO - RATE_PEAK), F.lit(RATE_FLOOR)))
    return agg.select(key, F.col("n_changes").cast("bigint").alias("n_changes"),
                      F.round(rate, 6).alias("changes_per_day"), F.round(factor, 6).alias("rate_factor"))


def select_and_trim(v: DataFrame, after, before, key: str | list[str] = "page_id", stage: bool = True) -> DataFrame:
    """VER-01..04 with the selection written once to the shared checkpoint
    folder: trimming reads it four times (three aggregates and the final
    filter), and the staged copy keeps those reads off the source scan."""
    from changelens.session import stage_table

    sel = select_versions(v, after, before, key=key)
    if stage:
        sel = stage_table(sel, "selected")
    return trim_versions(sel, key=key)


SELECTION_COLUMNS = ["version_id", "capture_time", "status", "body_hash"]


def narrow(v: DataFrame, key: str = "page_id", quality: str = "quality") -> DataFrame:
    """The columns selection and trimming need; wide capture fields (URL,
    title, redirect chains, headers) stay behind until ``widen``."""
    q = F.col(quality) if quality in v.columns else default_quality().alias(quality)
    return v.select(key, *SELECTION_COLUMNS, q)


def widen(pairs: DataFrame, v: DataFrame, key: str = "page_id") -> DataFrame:
    """Replace the narrow ``a``/``b`` structs of ``endpoints`` by the full
    capture records: one scan of the captures, joined on the (small) set of
    end version ids, which AQE broadcasts."""
    ids = pairs.select(key, F.inline(F.array(
        F.struct(F.lit("a").alias("_side"), F.col("a.version_id").alias("_vid")),
        F.struct(F.lit("b").alias("_side"), F.col("b.version_id").alias("_vid")))))
    cols = [c for c in v.columns if c != key]
    full = v.select(F.col("version_id").alias("_vid"), _record(cols).alias("_rec"))
    recs = ids.join(full, "_vid").groupBy(key).agg(
        F.max_by("_rec", F.when(F.col("_side") == "a", F.col("_vid"))).alias("a"),
        F.max_by("_rec", F.when(F.col("_side") == "b", F.col("_vid"))).alias("b"))
    return pairs.select(key, "n_versions").join(recs, key)
