"""Exact dedup, sharding, quality rules, mixing and chat formatting against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from conftest import SF
from pyspark.sql import functions as F

from changelens.llm import chat, exact_dedup, hilbert, mixing, quality
from changelens.llm.common import table

from .conftest import LONG, ODD, frame

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- exact dedup ----------------------------------------------------------

def plain_dedup(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[(r[1] or "").translate(UPPER)].append(r[0])
    out = Counter()
    for r in rows:
        norm = (r[1] or "").translate(UPPER)
        ids = [x for x in groups[norm] if x is not None]
        keep = max(ids) if ids else None
        out[r[0], keep, len(groups[norm]), r[0] == keep, hashlib.sha256(norm.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("bucket_rows", [1, 3, 1 << 16])
def test_dedup_odd_rows(odd, bucket_rows):
    got = exact_dedup.exact_dedup(odd, bucket_rows)
    assert Counter(tuple(r)[:5] for r in got.collect()) == plain_dedup(ODD)


def test_directory_splits_only_overfull_buckets(spark):
    # 40 keys under one 3-bit prefix, one key under another
    rows = [((i << 55) | i,) for i in range(40)] + [(-1,)]
    entries, depth = exact_dedup.directory(spark.createDataFrame(rows, "h long"), 8)
    got = entries.collect()
    assert depth > 1
    assert max(r.local_depth for r in got) == depth
    assert min(r.local_depth for r in got) < depth  # the key apart didn't need the last doublings
    loads = Counter(next(e.bucket for e in got if e.entry == ((h[0] & (2**64 - 1)) >> (64 - depth))) for h in rows)
    assert max(loads.values()) <= 8


def test_colliding_hashes_are_chained(spark, monkeypatch):
    """With a hash of few values, texts that collide stay apart."""
    real = F.xxhash64
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: F.pmod(real(*c), F.lit(3)))
    rows = [(i, f"Text {i % 10}", "en", "a") for i in range(40)]
    got = exact_dedup.exact_dedup(frame(spark, rows)).collect()
    assert Counter(tuple(r)[:5] for r in got) == plain_dedup(rows)
    assert max(r.chain for r in got) > 0


def test_drop_copies_keeps_all_columns(odd, empty):
    left = exact_dedup.drop_copies(odd)
    assert left.columns == odd.columns
    keep = [r for r in plain_dedup(ODD).elements() if r[3]]
    assert Counter(r.doc_id for r in left.collect()) == Counter(r[0] for r in keep)
    assert exact_dedup.drop_copies(empty).count() == 0
    assert exact_dedup.exact_dedup(empty).count() == 0


# --- sharding -------------------------------------------------------------

def test_curve_visits_neighbours(spark):
    cells = sorted(hilbert.cells(spark, 3).collect(), key=lambda r: r.curve)
    assert [r.curve for r in cells] == list(range(512))
    at = [[(r.cell >> (3 * i)) & 7 for i in range(3)] for r in cells]
    assert all(sum(abs(a - b) for a, b in zip(x, y, strict=True)) == 1 for x, y in zip(at, at[1:], strict=False))


def check_shards(docs, rows, shards=8):
    got = hilbert.assign(docs, shards).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    counts = [len(by[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    in_order = sorted(got, key=lambda r: (r.shard, r.slot))
    key = [(r.curve, r.text_crc32, r.size) for r in in_order]
    assert key == sorted(key)


def test_shards_odd_rows(odd, empty):
    check_shards(odd, ODD)
    assert hilbert.assign(empty).count() == 0


def test_shards_whole_table(spark):
    docs = table(spark, SF, "documents")
    check_shards(docs, [(r.doc_id, r.text) for r in docs.collect()])
    got = hilbert.query(spark, SF)
    assert got.select("law").distinct().collect()[0].law == "rows"
    assert got.where("grown_shard is not null").count() == 0


def test_written_shards_prune(spark, odd, tmp_path):
    path, ranges = hilbert.write_shards(odd, f"{tmp_path}/out", 4)
    back = spark.read.parquet(path)
    assert back.count() == len(ODD)
    assert Counter(r.row.text for r in back.collect()) == Counter(r[1] for r in ODD)
    assert back.select("row.*").columns == odd.columns
    got = {r.shard: r for r in ranges.collect()}
    assert all(got[r.shard].min_size <= r.level_size <= got[r.shard].max_size for r in back.collect())


# --- quality rules --------------------------------------------------------

def plain_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, rep = len(words), len(covered)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), rep, n < 20 or 100 * rep > 30 * n


def test_measures_odd_rows(spark, odd, empty):
    r = random.Random(4)
    more = [(100 + i, "\n".join(" ".join(r.choice("ab#|") for _ in range(r.randint(0, 30))) for _ in range(r.randint(0, 5))), "en", "a") for i in range(60)]
    more.append((300, (LONG[:3000] + " ") * 9, "en", "a"))
    docs = odd.unionByName(frame(spark, more))
    got = quality.with_rates(quality.measures(docs))
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert Counter(map(tuple, got.select(*cols).collect())) == Counter((d[0], *plain_measures(d[1])) for d in ODD + more)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.judge(empty, labels).count() == 0
    assert all(x.kept == (not x.base_failed) for x in quality.judge(docs, labels).collect())


@pytest.mark.parametrize(("k", "n", "rate"), [(0, 1, 0.02), (0, 500, 0.02), (3, 700, 0.02), (9, 3000, 0.005), (50, 5000, 0.02), (90, 100, 0.5)])
def test_binomial_tail(spark, k, n, rate):
    got = spark.range(1).select(F.lit(k).cast("long").alias("k"), F.lit(n).cast("long").alias("n")).select(
        quality.binomial_tail("k", "n", rate).alias("p")).first().p
    want = sum(math.comb(n, j) * rate**j * (1 - rate) ** (n - j) for j in range(k + 1))
    assert got == pytest.approx(1.0 if k >= n * rate else want, rel=1e-9)


def test_cutoffs_hold_their_risk(spark):
    """Bad documents of one language shout; good ones hardly ever do: its rule is certified, a thin stratum's isn't."""
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefg") for _ in range(5))
    good = lambda: " ".join(word() for _ in range(40))
    bad = lambda: " ".join(word().upper() + "!!" for _ in range(40))
    rows = [(i, bad() if i % 10 == 0 else good(), "en" if i < 1500 else "xx", "a") for i in range(1600)]
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 10 != 0), 0) for i in range(1600)] + [(None, 1, 0), (3, None, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    used = quality.cutoffs(quality.with_rates(quality.measures(docs)), labels).collect()
    assert {(u.stratum, u.rule) for u in used} == {("en", "bangs_per_word"), ("en", "capital_share")}
    tests = sum(map(len, quality.GRID.values())) * 2
    for u in used:
        assert (u.k, u.caught) == (0, 150)
        assert (1 - quality.ALPHA) ** u.n <= quality.DELTA / tests
    kept = {x.doc_id for x in quality.keep_good(docs, labels).collect()}
    assert kept == {i for i in range(1600) if i % 10 or i >= 1500}
    assert quality.keep_good(docs, labels).columns == docs.columns


def test_strata_without_good_labels_are_no_tests(spark):
    """340 good documents certify a cutoff among the tests of one stratum, not among those of two."""
    bad = F.col("id") >= 340
    rated = spark.range(400).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 390, "en").otherwise("xx").alias("lang"), F.lit(False).alias("base_failed"),
        *[F.when(bad, 2.0 * (rule == "bangs_per_word")).otherwise(0.0).alias(rule) for rule in quality.GRID])
    labels = spark.range(400).select(F.col("id").alias("doc_id"), F.when(bad, 0).otherwise(1).alias("quality"))
    used = quality.cutoffs(rated, labels).collect()
    assert [(u.stratum, u.rule, u.n, u.caught) for u in used] == [("en", "bangs_per_word", 340, 50)]


# --- mixing ---------------------------------------------------------------

def plain_targets(sizes, cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > cap * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in free}
            break
        target |= {s: float(cap * sizes[s]) for s in over}
        left -= sum(cap * sizes[s] for s in over)
        free -= over
    return target


def check_mix(docs, rows):
    got = mixing.mix(docs).collect()
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += count(r[1])
    assert Counter((r.doc_id, r.size, r.source_size) for r in got) == Counter((r[0], count(r[1]), sizes[r[3]]) for r in rows)
    want = plain_targets(dict(sizes))
    taken, largest = Counter(), Counter()
    for r in got:
        assert r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r.size <= 3 * r.size
        assert abs(r.copies - (r.target / r.source_size if r.size else 0)) < 1
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s, t in want.items():
        assert abs(taken[s] - t) <= largest[s] / 2 + 1
    return got


def test_mix_odd_rows(odd, empty):
    check_mix(odd, ODD)
    assert mixing.mix(empty).count() == 0
    assert mixing.mixed_documents(empty).count() == 0


def test_mix_whole_table_and_rerun(spark):
    docs = table(spark, SF, "documents")
    got = check_mix(docs, [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()])
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_mix_hot_source_through_levels(spark):
    r = random.Random(6)
    rows = [(i, "w " * r.randint(0, 9), "en", "hot" if i < 9000 else f"s{i % 4}") for i in range(10_000)]
    check_mix(frame(spark, rows), rows)


def test_caps_are_shared_on(spark):
    rows = [(i, "w " * n, "en", s) for i, (s, n) in enumerate((("a", 100), ("b", 1), ("c", 1), ("d", 60), ("e", 2)))]
    check_mix(frame(spark, rows), rows)


def test_pivotal_settles_every_row_and_keeps_the_sum(spark):
    r = random.Random(7)
    rows = [("s", i, r.randint(1, 50), 0.3) for i in range(500)]
    got = mixing.pivotal(spark.createDataFrame(rows, "source string, id long, size long, p double"), block=8).collect()
    assert sorted(x.id for x in got) == list(range(500))
    assert abs(sum(rows[x.id][2] * x.up for x in got) - 0.3 * sum(x[2] for x in rows)) <= 25
    # expectation: over seeds, a document goes up in about 3 of 10
    ups = Counter(x.id for s in range(6) for x in mixing.pivotal(
        spark.createDataFrame(rows, "source string, id long, size long, p double"), seed=s, block=8).where("up").collect())
    assert 0.25 < sum(ups.values()) / 3000 < 0.35


def test_mixed_documents_repeat(odd):
    copies = Counter()
    for r in mixing.mix(odd).collect():
        copies[r.doc_id] += r.copies
    got = mixing.mixed_documents(odd)
    assert got.columns == odd.columns
    assert Counter(r.doc_id for r in got.collect()) == Counter({k: v for k, v in copies.items() if v})


def test_mixed_documents_share_no_copies(spark):
    """Null ids of one size in sources of different targets: every row has its own copies."""
    rows = [(None, f"w{i} x y", "en", "a" if i < 600 else "b" if i < 640 else "c") for i in range(700)]
    docs = frame(spark, rows)
    copies = Counter()
    for r in mixing.mix(docs).collect():
        copies[r.source] += r.copies
    got = mixing.mixed_documents(docs).collect()
    assert Counter(r.source for r in got) == copies
    by = Counter((r.source, r.text) for r in got)
    targets = plain_targets(Counter({s: 3 * n for s, n in (("a", 600), ("b", 40), ("c", 60))}))
    assert len({targets[s] / n for s, n in (("a", 600), ("b", 40), ("c", 60))}) > 1
    for _, text, _, s in rows:
        share = targets[s] / {"a": 1800, "b": 120, "c": 180}[s]
        assert abs(by[s, text] - share) < 1


# --- chat -----------------------------------------------------------------

CONV = [
    (1, 0, "user", "hi <s>[INST] & \\ &0; &1; <|end|>\n"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 2, "assistant", "two"),
    (2, None, None, None), (2, 0, "role\n<|end|>\n", "a\n\nb"), (2, 0, "assistant", ""), (2, 0, "assistant", ""),
    (None, 5, "system", "x"), (3, 0, "assistant", "é😀" * 40_000), (4, 0, "Human", "kept as it is"),
]


def plain_chat(rows):
    by = defaultdict(list)
    for c, turn, role, text in rows:
        by[c].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_chat_round_trip(spark):
    rows = spark.createDataFrame(CONV, "conv_id long, turn long, role string, text string").withColumn("record", F.lit("clash"))
    got = chat.digests(chat.format_conversations(rows)).collect()
    assert {r.conv_id: tuple(r)[1:5] for r in got} == plain_chat(CONV)
    assert chat.digests(chat.format_conversations(rows.limit(0))).count() == 0


def test_chat_markers_only_from_the_template(spark):
    rows = spark.createDataFrame(CONV[:2], "conv_id long, turn long, role string, text string")
    text = chat.format_conversations(rows).first().formatted
    assert text.count(chat.TURN) == text.count(chat.END) == 2
    assert "[INST]" not in text and "</s>" not in text


def test_chat_whole_table(spark):
    rows = table(spark, SF, "conversations").collect()
    want = plain_chat([tuple(r) for r in rows] + [(-7, 0, "user", chat.PROBE), (-7, 1, "assistant", chat.PROBE)])
    assert {r.conv_id: tuple(r)[1:5] for r in chat.query(spark, SF).collect()} == want


def test_chat_turns_are_those_of_the_mapping(spark, monkeypatch):
    """A mapping that gives roles their canonical names changes the turns; a string too long for JSON keeps its place."""
    monkeypatch.setattr(chat, "LAYOUTS", tuple(chat.Layout("turn", (), "turns", "role", "text", ("turns[].turn",), True) if x.name == "turn" else x for x in chat.LAYOUTS))
    long = "é\\u0001" * 400_000
    rows = spark.createDataFrame([(1, 0, "Human", 'a "b" \\ \n'), (1, 1, "GPT", long), (1, 2, None, None)], "conv_id long, turn long, role string, text string")
    r = chat.digests(chat.format_conversations(rows)).first()
    said = f'user\na "b" \\ \n\nassistant\n{long}\n\n\n'
    assert (r.n_turns, r.turns_sha256) == (3, hashlib.sha256(said.encode()).hexdigest())


def test_chat_text_longer_than_a_json_string(spark):
    n = chat.PARSED_CHARS + 1
    rows = spark.range(1).select(
        F.lit(1).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.lit("assistant").alias("role"),
        F.repeat(F.lit("x"), n).alias("text"))
    r = chat.digests(chat.format_conversations(rows)).first()
    assert (r.n_turns, r.loss_chars, r.loss_sha256) == (1, n, hashlib.sha256(b"x" * n).hexdigest())
    with pytest.raises(Exception, match="too long"):
        chat.canonical(rows.select(F.to_json(F.struct(F.array(F.struct("role", "text")).alias("turns"))).alias("record"))).collect()


def test_layouts(spark):
    cases = {
        '{"messages":[{"role":"user","content":"q"},{"role":"assistant","content":null}]}': ("messages", [("user", "q"), ("assistant", "")]),
        '{"id":5,"meta":{"role":[1]},"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}]}': ("conversations", [("user", "q"), ("assistant", "a")]),
        '{"instruction":"do","input":"x","output":"y"}': ("instruction", [("user", "do\n\nx"), ("assistant", "y")]),
        '{"instruction":"do","output":"y"}': ("instruction", [("user", "do"), ("assistant", "y")]),
        '{"prompt":"p","response":"r"}': ("prompt", [("user", "p"), ("assistant", "r")]),
        '{"system":"s","prompt":"p","completion":"r"}': ("completion", [("system", "s"), ("user", "p"), ("assistant", "r")]),
        '{"messages":[{"role":"user","content":"q","extra":{"a":[{"z":1}]}}]}': ("messages", [("user", "q")]),
        '{"messages":[]}': ("messages", []), '{"a":1}': ("unknown", []), "{bad": ("unknown", []), "[1]": ("unknown", []), "": ("unknown", []), None: ("unknown", []),
    }
    got = chat.canonical(spark.createDataFrame([(x,) for x in cases], "record string")).collect()
    assert {r.record: (r.layout, [tuple(t) for t in r.turns]) for r in got} == cases
