"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter

from conftest import SF

from changelens.llm import collocations
from changelens.llm.common import table

from .conftest import ODD, frame

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(rows, least, longest, top):
    f, n = {}, Counter()
    for text, lang in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        c = f.setdefault(lang or "und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\n-\r]", low):
            ws = re.findall("[^ \t]+", piece)
            n["und" if lang is None else lang] += len(ws)
            c.update(tuple(ws[i : i + k]) for k in range(1, longest + 1) for i in range(len(ws) - k + 1))
    out = []
    for lang, counts in f.items():
        grams = {p: a for p, a in counts.items() if a >= least}
        gone = {p[i : i + k] for p, a in grams.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if a >= grams[p[i : i + k]]}
        found = []
        for p, a in grams.items():
            if len(p) < 2 or p in gone:
                continue
            cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def check(df, rows, **how):
    got = collocations.collocations(df, **how)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect())) == plain(rows, how.get("least", 100), how.get("longest", 5), how.get("top", 2000))


def docs(spark, texts):
    return frame(spark, [(i, t, lang, "a") for i, (t, lang) in enumerate(texts)]), texts


MORE = [("a\tB  c. A b c! x a b c d e f g", "en"), ("a b c d e f g", "en"), ("ab c, a\x0bb c", "en"), ("É é É é. é É", "fr"), ("a b c", None), ("a b c", "und"),
        ("x\x1cy z\xa0q x\x1cy z\xa0q", "en"), ("of of of of of of of", "en"), (". , ; : ! ?", "en"), ("a b " * 30_000, "de"), ("w" * 50_000 + " v " + "w" * 50_000 + " v", "de")]


def test_odd_rows(spark, odd, empty):
    rows = [(r[1], r[2]) for r in ODD] + MORE
    df = odd.unionByName(frame(spark, [(i, t, lang, "b") for i, (t, lang) in enumerate(MORE)]))
    check(df, rows, least=2)
    check(df, rows, least=2, hot=3, top=7)
    check(df, rows, least=1, longest=3, top=50)
    assert collocations.collocations(empty).count() == 0


def test_whole_table(spark):
    df = table(spark, SF, "documents")
    rows = [(r.text, r.lang) for r in df.collect()]
    check(df, rows, least=20, hot=60)
    got = collocations.query(spark, SF)
    assert sorted(map(tuple, got.collect())) == plain(rows, 100, 5, 2000)


def test_hot_words_and_small_buffers(spark, monkeypatch):
    """Hot runs of words are routed by more words; a group may lie in many rows."""
    monkeypatch.setattr(collocations, "COMBINED", 50)
    rng = random.Random(3)
    words = ["a", "b", "c", "d", "a", "b", "a", "x1", "x2", "x3"]
    texts = [(" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) + rng.choice([".", "", "\n"]), rng.choice(["en", "en", "fr"])) for _ in range(300)]
    df, rows = docs(spark, texts)
    for hot in (5, 400, 2_000, 10**9):
        check(df.repartition(7), rows, least=9, hot=hot)


def test_three_way_drops_light_parts():
    rng = random.Random(1)
    rows = [([rng.choice([b"a", b"b", b"c", b"dd"]) for _ in range(rng.randint(0, 4))], rng.randint(1, 3)) for _ in range(500)]
    want = Counter()
    for ws, n in rows:
        for k in range(1, len(ws) + 1):
            want[b"p " + b" ".join(ws[:k])] += n
    for least in (1, 20, 90, 5_000):
        found = []
        collocations.three_way(rows, 0, b"p", least, found)
        assert sorted(found) == sorted((p, n) for p, n in want.items() if n >= least)


def test_scores_beyond_64_bits(spark):
    big = 4 * 10**15
    grams = spark.createDataFrame([("en", "a", big), ("en", "b", big - 1), ("en", "a b", big - 2), ("en", "a b c", 10**15), ("en", "b c", 10**15 + 1), ("en", "c", 10**15 + 7)], "lang string, phrase string, f long")
    n = 9 * 10**18
    got = {r.phrase: (r.l, r.r, r.score) for r in collocations.scored(grams, spark.createDataFrame([("en", n)], "lang string, n long")).collect()}
    assert got["a b"] == (big, big - 1, 1000 * (big - 2) * n // (big * (big - 1)))
    first, second = 1000 * 10**15 * n // (big * (10**15 + 1)), 1000 * 10**15 * n // ((big - 2) * (10**15 + 7))
    assert got["a b c"] == ((big, 10**15 + 1, first) if first <= second else (big - 2, 10**15 + 7, second))


def test_parts_of_longer_phrases_go(spark):
    grams = [("en", "a b c", 10), ("en", "a b", 10), ("en", "b c", 11), ("en", "c d", 10), ("fr", "a b", 5)]
    df = spark.createDataFrame(grams, "lang string, phrase string, f long")
    left = lambda share: {(r.lang, r.phrase) for r in collocations.without_parts(df.withColumnRenamed("f", "a"), df, share).collect()}
    assert left(100) == {("en", "a b c"), ("en", "b c"), ("en", "c d"), ("fr", "a b")}
    assert left(90) == {("en", "a b c"), ("en", "c d"), ("fr", "a b")}


def test_rows_of_partial_counts_do_not_grow_with_the_groups(spark):
    """A task sends a row for each part of a language, however many groups the suffixes have."""
    rng = random.Random(5)
    sent = []
    for n in (300, 3_000):
        texts = [(" ".join(f"w{rng.randrange(n)}" for _ in range(60)), rng.choice(["en", "fr"])) for _ in range(n)]
        df, _ = docs(spark, texts)
        df = df.select("lang", "text").coalesce(1)
        everything = bytes([0b01010101]) * ((1 << collocations.SLOT_BITS) // 4)
        shared = spark.sparkContext.broadcast((everything, everything))
        rows = collocations.suffixes(df, shared, 5, 64).collect()
        keys = {(r.lang, r.part) for r in rows}
        assert len(rows) == len(keys) <= 2 * 64
        groups = [(r.lang, g.split(b"\n")[0]) for r in rows for g in bytes(r.groups).split(collocations.END)]
        assert len(groups) == len(set(groups)) and len({g for _, g in groups}) == n  # a group for each word
        sent.append(len(rows))
    assert sent[1] <= 1.1 * sent[0]
