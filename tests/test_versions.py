"""Version selection and trimming (VER-01..06): the selected rows are stated
as sets (which captures qualify, which end runs are cut) and compared on
random histories; records with maps and string ids."""

import datetime as dt
from itertools import takewhile

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from changelens.operators import versions as ver

T0 = dt.datetime(2024, 1, 1)
AFTER, BEFORE = T0 + dt.timedelta(days=10), T0 + dt.timedelta(days=14)
SCHEMA = "page_id long, version_id long, capture_time timestamp_ntz, status int, body_hash string, quality double"


def kind(row):
    """What a run of captures has in common: an error class, or else the body."""
    family = (row["status"] or 600) // 100
    return family if family >= 4 else row["body_hash"]


def alike(end, row):
    return kind(row) == kind(end) if isinstance(kind(end), int) else row["body_hash"] == end["body_hash"]


def expected(rows):
    """ids of the selected captures of one page, trimmed."""
    rows = sorted(rows, key=lambda r: r["capture_time"])
    older = [r for r in rows if r["capture_time"] < AFTER]
    inside = [r for r in rows if AFTER <= r["capture_time"] < BEFORE]
    chosen = [r for r in inside if r["quality"] >= 1] or (inside if older else [])
    if not chosen:
        return set()
    if older:
        last = older[-1]
        reach = [r for r in older[-1 - ver.LOOKBACK_ROWS:]
                 if r["quality"] >= 1 and last["capture_time"] - r["capture_time"] < dt.timedelta(days=31)]
        chosen = [last if last["quality"] >= 1 or not reach else reach[-1], *chosen]
    if len(chosen) >= 3:
        same = len(list(takewhile(lambda r: alike(chosen[-1], r), reversed(chosen))))
        chosen = chosen[:len(chosen) - same + 1]
    if len(chosen) >= 3:
        same = len(list(takewhile(lambda r: alike(chosen[0], r), chosen)))
        chosen = chosen[same - 1:]
    return {r["version_id"] for r in chosen}


capture = st.tuples(st.integers(0, 40 * 24), st.sampled_from([200, 200, 200, 404, 503, None]), st.integers(0, 2))


@settings(max_examples=20, deadline=None)
@given(st.lists(st.lists(capture, min_size=1, max_size=12, unique_by=lambda c: c[0]), min_size=1, max_size=6))
def test_selection_is_the_stated_set(spark, pages):
    rows = []
    for pid, caps in enumerate(pages):
        for hours, status, h in caps:
            q = 0.5 if (status or 600) >= 400 else 1.0
            rows.append((pid, len(rows), T0 + dt.timedelta(hours=hours), status, f"h{h}", q))
    df = spark.createDataFrame(rows, SCHEMA)
    names = df.columns
    got = {}
    for r in ver.trim_versions(ver.select_versions(df, AFTER, BEFORE)).collect():
        got.setdefault(r.page_id, set()).add(r.version_id)
    for pid in range(len(pages)):
        assert got.get(pid, set()) == expected([dict(zip(names, r)) for r in rows if r[0] == pid]), pid


def test_lookback_reaches_a_hundred_rows(spark):
    def pages(n_bad):
        times = [AFTER - dt.timedelta(minutes=i + 1) for i in range(n_bad + 1)]
        bad = [(n_bad, i, t, 404, "x", 0.5) for i, t in enumerate(times[:-1])]
        return [*bad, (n_bad, n_bad, times[-1], 200, "g", 1.0), (n_bad, 999, AFTER, 200, "n", 1.0)]

    df = spark.createDataFrame(pages(100) + pages(101), SCHEMA)
    base = {r.page_id: r.version_id for r in ver.select_versions(df, AFTER, BEFORE).where("is_baseline").collect()}
    assert base == {100: 100, 101: 0}


def test_frames_in_one_pass_equal_one_by_one(spark):
    rows = [(p, 100 * p + i, T0 + dt.timedelta(hours=7 * i + p), 200 if i % 4 else 503, f"h{i % 3}", 1.0 if i % 4 else 0.5)
            for p in range(5) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    frames = [(AFTER, BEFORE), (T0, T0 + dt.timedelta(days=2)), (BEFORE, BEFORE + dt.timedelta(days=3))]
    together = ver.select_frames(df, frames)
    for i, (a, b) in enumerate(frames):
        one = ver.select_versions(df, a, b)
        assert sorted(map(tuple, together.where(F.col("frame") == i).select(one.columns).collect())) == sorted(map(tuple, one.collect()))


def test_records_with_maps_and_string_ids(spark):
    rows = [("p-1", f"v-{i}", T0 + dt.timedelta(days=10, hours=i), 200, f"h{i}", 1.0, {"k": str(i)}) for i in range(4)]
    df = spark.createDataFrame(rows, "page_id string, version_id string, capture_time timestamp_ntz, status int, body_hash string, "
                                     "quality double, headers map<string,string>")
    trimmed = ver.trim_versions(ver.select_versions(ver.narrow(df), AFTER, BEFORE))
    ends = ver.widen(ver.endpoints(trimmed), df).first()
    assert (ends.a.version_id, ends.b.version_id, ends.b.headers) == ("v-0", "v-3", {"k": "3"})
    assert ver.latest_valid(df, trimmed).first().latest.headers == {"k": "3"}


def test_default_quality(spark):
    rows = [(1, i, T0 + dt.timedelta(days=10, hours=i), status, f"h{i}") for i, status in enumerate((200, 404, None, 301))]
    df = spark.createDataFrame(rows, "page_id long, version_id long, capture_time timestamp_ntz, status int, body_hash string")
    assert {r.version_id for r in ver.select_versions(ver.narrow(df), AFTER, BEFORE).collect()} == {0, 3}
    assert {r.version_id for r in ver.select_versions(df, AFTER, BEFORE).collect()} == {0, 3}
