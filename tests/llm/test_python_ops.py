"""SimHash, BPE, token counts, language identification and HTML text against plain versions."""

import hashlib
import html
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from conftest import SF
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from changelens.llm import bpe, html_content, langid, simhash, token_counts
from changelens.llm.common import table

from .conftest import LONG, ODD, frame

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


# --- SimHash --------------------------------------------------------------

def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids_and_prints, radius=2):
    """{row: smallest id reachable}, by comparing all fingerprints."""
    prints = sorted({p for _, p in ids_and_prints})
    parent = {p: p for p in prints}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= radius:
                parent[top(a)] = top(b)
    low = {}
    for i, p in ids_and_prints:
        if i is not None:
            low[top(p)] = min(low.get(top(p), i), i)
    return Counter((i, p, low.get(top(p))) for i, p in ids_and_prints)


def as_counter(rows):
    return Counter((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in rows)


def test_simhash_odd_rows(odd, empty):
    want = plain_components([(r[0], plain_fingerprint(r[1])) for r in ODD])
    assert as_counter(simhash.near_duplicates(odd).collect()) == want
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.one_of_each(empty).count() == 0
    left = simhash.one_of_each(odd)
    assert left.columns == odd.columns


def test_simhash_whole_table(spark):
    docs = table(spark, SF, "documents").collect()
    got = simhash.query(spark, SF).collect()
    assert all(re.fullmatch("[0-9a-f]{16}", r.fingerprint) for r in got)
    want = plain_components([(r.doc_id, plain_fingerprint(r.text)) for r in docs])
    assert Counter((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in got) == want


def fps_frame(spark, values):
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    return spark.createDataFrame(signed, "fp long").select("fp", F.col("fp").alias("id"))


@pytest.mark.parametrize("shard_rows", [1, 2, 5, 4096])
def test_links_lose_nothing_however_shards_are_cut(spark, shard_rows):
    """Chains and clusters of fingerprints; tiny bounds force several cuts."""
    r = random.Random(shard_rows)
    values = {0, 1, 3, (1 << 64) - 1, 1 << 63}
    for _ in range(25):
        v = r.getrandbits(64)
        for _ in range(r.randint(1, 9)):
            values.add(v)
            for _ in range(r.randint(1, 3)):
                v ^= 1 << r.randrange(64)
    edges = simhash.links(fps_frame(spark, sorted(values)), 2, shard_rows)
    got = {x.id & (2**64 - 1): x.component & (2**64 - 1) for x in simhash.components(edges).collect()}
    groups = defaultdict(set)
    for v in values:
        groups[got.get(v, v)].add(v)
    want = defaultdict(set)
    for (i, _, low), n in plain_components([(v, v) for v in values]).items():
        assert n == 1
        want[low].add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))
    assert all((e.a ^ e.b).bit_count() <= 2 or ((e.a ^ e.b) & (2**64 - 1)).bit_count() <= 2 for e in edges.collect())


def test_bk_tree_search_is_exact():
    r = random.Random(1)
    values = list({r.getrandbits(10) for _ in range(300)})
    tree = simhash.BKTree(values[0])
    for i, v in enumerate(values[1:], 1):
        assert sorted(tree.add(v, 2)) == sorted(x for x in values[:i] if (x ^ v).bit_count() <= 2)


def test_components_of_a_long_path_and_a_hub(spark):
    n = 300
    order = list(range(n))
    random.Random(2).shuffle(order)
    path = list(zip(order, order[1:], strict=False))
    hub = [(1000, 1000 + i) for i in range(1, 400)]
    got = {r.id: r.component for r in simhash.components(spark.createDataFrame(path + hub + [(5000, 5000)], "a long, b long")).collect()}
    assert got == {i: 0 for i in range(n)} | {1000 + i: 1000 for i in range(400)}


# --- BPE ------------------------------------------------------------------

POOL = ["the", " ", "  ", "\n", "\t", "é", "ß", "語", "😀", "'s", "'ll", "123", "!!", "<|endoftext|>", "<|endof", "▁", " ", "　", "\x1c",
        "\x85", "​", "Th", "ing", "---", "\r\n", "</s>", "<s>", "<unk>", "﻿", "́", "½", "Ⅷ", "٣", " ", "\x00", "x" * 40]


def fuzz(n, seed):
    r = random.Random(seed)
    out = ["".join(r.choice(POOL) for _ in range(r.randint(0, 40))) for _ in range(n)]
    out += ["".join(chr(r.choice((r.randint(1, 0x2FF), r.randint(1, 0xD7FF), r.randint(0xE000, 0x1FFFF)))) for _ in range(25)) for _ in range(n)]
    return out + ["".join(r.choice("abcdeinorst") for _ in range(r.randint(1, 30))) for _ in range(n)]


def test_codec_equals_the_library():
    lib, own = Tokenizer.from_file(BYTE_BPE), bpe.Codec(BYTE_BPE)
    texts = fuzz(700, 3)
    got = own.encode(texts)
    want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in got] == want
    assert [own.decode(x) for x in got] == [lib.decode(x, skip_special_tokens=False) for x in want]


def test_pairs_stay_as_plain_merging_says():
    own, r = bpe.Codec(BYTE_BPE), random.Random(4)
    ids = [i for i, n in own.sizes.items() if n <= 10]
    for _ in range(3000):
        a, b = r.choice(ids), r.choice(ids)
        assert own.stays(a, b) == (own.merged(own.bytes_of[a] + own.bytes_of[b]) == [a, b])


def test_codec_in_pieces_and_with_a_full_cache(monkeypatch):
    monkeypatch.setattr(bpe, "BATCH_CHARS", 50)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 100)
    monkeypatch.setattr(bpe, "CACHE_PAIRS", 100)
    lib, own = Tokenizer.from_file(BYTE_BPE), bpe.Codec(BYTE_BPE)
    texts = [LONG[:20_000], *fuzz(60, 5)]
    for at in range(0, len(texts), 20):
        part = texts[at : at + 20]
        assert [x.tolist() for x in own.encode(part)] == [e.ids for e in lib.encode_batch(part, add_special_tokens=False)]


def test_bpe_texts_with_nul(spark):
    """Texts with NUL go through Arrow and the digests like any other."""
    lib = Tokenizer.from_file(BYTE_BPE)
    texts = ["\x00", "a\x00b", "\x00\x00 x", "end\x00", "é\x00\n😀"]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = Counter()
    for i, t in enumerate(texts):
        ids = lib.encode(t, add_special_tokens=False).ids
        assert lib.decode(ids, skip_special_tokens=False) == t
        want[i, len(ids), sha(",".join(map(str, ids))), sha(t)] += 1
    docs = frame(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    assert Counter(map(tuple, bpe.digests(docs, BYTE_BPE).collect())) == want


def test_bpe_odd_rows(spark, odd, empty):
    lib = Tokenizer.from_file(BYTE_BPE)
    rows = ODD + [(50 + i, t, "en", "a") for i, t in enumerate(fuzz(20, 6)) if "\x00" not in t]
    docs = odd.unionByName(frame(spark, rows[len(ODD):]))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = Counter()
    for i, t, *_ in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want[i, len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids, skip_special_tokens=False))] += 1
    assert Counter(map(tuple, bpe.digests(docs, BYTE_BPE).collect())) == want
    assert bpe.digests(empty, BYTE_BPE).count() == 0
    again = bpe.decode(bpe.encode(docs, BYTE_BPE), BYTE_BPE).collect()
    assert Counter((r.doc_id, r.decoded) for r in again) == Counter((i, t or "") for i, t, *_ in rows)


def test_bpe_whole_table(spark):
    lib = Tokenizer.from_file(BYTE_BPE)
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    for r in bpe.query(spark, SF).collect():
        ids = lib.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())


# --- token counts ---------------------------------------------------------

def test_counts_equal_the_library(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE_WORDS", 500)
    lib, own = sentencepiece.SentencePieceProcessor(model_file=PIECES), token_counts.Counts(PIECES)
    texts = [*fuzz(700, 7), "", " ", "\n", " \n ", "▁", "a ▁ b", LONG[:5000]]
    assert [own.count(t) for t in texts] == [len(x) for x in lib.encode(texts, num_threads=1)]


def test_counts_odd_rows(spark, odd, empty):
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = Counter((i, len((t or "").encode()), n, n > 4096) for i, t, *_ in ODD for n in [len(lib.encode(t or ""))])
    assert Counter(map(tuple, token_counts.token_counts(odd, PIECES).collect())) == want
    assert token_counts.token_counts(empty, PIECES).count() == 0
    # tier one changes nothing: a table of one word, and a sample of a few rows
    monkey = token_counts.frequent_words(odd, PIECES, 1, 3)
    assert len(monkey) <= 1


def test_counts_whole_table(spark):
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    got = {r.doc_id: r.n_tokens for r in token_counts.query(spark, SF).collect()}
    assert got == {i: len(lib.encode(t)) for i, t in docs.items()}


# --- language identification ----------------------------------------------

def test_language_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in table(spark, "/root/testdata/sf0.01", "documents").collect()}
    got = langid.query(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(docs)
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in held)
    assert right >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_odd_rows(spark, odd, empty):
    got = langid.identify(odd).collect()
    assert len(got) == len(ODD)
    assert {r.lang_pred for r in got} <= {"en", "de", "fr", "und"}
    assert all(r.lang_pred == "und" and r.score == 0 for r in got if r.doc_id in (2, 3, 4))
    assert langid.identify(empty).count() == 0
    unlabelled = frame(spark, [(1, "some words", None, "a"), (2, "12 34", "en", "a")])
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}


def test_language_matrix_equals_plain_counts(spark):
    texts = [("abc def", "en"), ("über", "de"), ("abc", "en")]
    langs, matrix = langid.train(spark.createDataFrame(texts, "text string, lang string"))
    counts = {lang: sum(langid.bucket_counts(t) for t, x in texts if x == lang) for lang in langs}
    for i, lang in enumerate(langs):
        own = counts[lang] + langid.SMOOTHING
        assert np.allclose(matrix[:-1, i], np.log(own / own.sum()))
    assert np.allclose(matrix[-1], np.log([1 / 3, 2 / 3]))
    p = langid.scores(["abc", "über", "def abc"], matrix)
    assert p.argmax(axis=1).tolist() == [1, 0, 1]


def test_bucket_counts_of_a_long_text_in_pieces(monkeypatch):
    whole = langid.bucket_counts(LONG[:5000])
    monkeypatch.setattr(langid, "PIECE", 37)
    assert (langid.bucket_counts(LONG[:5000]) == whole).all()
    n = 5002
    assert whole.sum() == n + n - 1 + n - 2


# --- HTML -----------------------------------------------------------------

def test_sum_product_equals_brute_force():
    """Marginals of a small tree against the sum over all labellings."""
    import math
    from itertools import product

    m = html_content.Model(html_content.labelled_pages(40))
    page = html_content.Page("<body><nav><a>x</a></nav><article><p>One two three.</p><div class='ad'>b</div></article></body>")
    nodes = page.nodes
    got = m.marginals(nodes)
    weight = Counter()
    total = 0.0
    for ys in product((0, 1), repeat=len(nodes)):
        y = dict(zip(nodes, ys, strict=True))
        log = m.root[y[nodes[0]]]
        for n in nodes:
            log += sum(m.evidence.get(f, (0, 0))[y[n]] for f in n.features)
            if n.parent:
                log += (m.pairs.get(n.kind) or m.pairs["any"])[y[n.parent]][y[n]]
        total += math.exp(log)
        for n in nodes:
            weight[n] += math.exp(log) * y[n]
    assert all(got[n] == pytest.approx(weight[n] / total, rel=1e-9) for n in nodes)


def test_html_held_out_layouts():
    m = html_content.model()
    right = total = 0
    for page in html_content.labelled_pages(150, seed=987):
        built = html_content.Page(page)
        p = m.marginals(built.nodes)
        for node, _ in built.pieces:
            total += 1
            right += (p[node] > 0.5) == node.label
    assert right >= 0.985 * total


CASES = {
    "": "", "   ": "", "<div></div>": "",
    "<html><head><title>t</title><body><nav><a href=x>Menu</a></nav><article><h1>T &amp; U</h1><p>a<b>b</b> c\n\n d<br>e<script>var x='<p>no';</script></p>"
    "<!-- no --><p>Second one.<p>Third.</article><footer>no</footer>": "T & U ab c d e Second one. Third.",
    "<body><header>no</header><div class='cookie-notice'>We use cookies here.</div><main><h1>Title</h1><p>Yes, this is the text of it.</p>"
    "<form>Sign up <input></form></main><aside><p>About us.</p></aside><div id='comments'><p>Nice one, I liked it a lot.</p></div></body>": "Title Yes, this is the text of it.",
}


def test_html_cases(spark):
    rows = [(i, f"u{i}", h) for i, h in enumerate(CASES)] + [(90, None, None), (90, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit(1))
    got = html_content.extract(df).collect()
    want = [(i, f"u{i}", t, len(t)) for i, t in enumerate(CASES.values())] + [(90, None, "", 0)] * 2
    assert Counter(map(tuple, got)) == Counter(want)
    assert html_content.extract(df.limit(0)).count() == 0


def test_html_never_fails():
    m = html_content.model()
    for h in ("<![if x]><p>a", "<!--", "<script>", "<p>" * 30_000, "<div>" * 30_000 + "x", "</p></div>", "&#0;&#xd800;&x;", "<a><a>", "<table><td>x<tr><td>y", "<?php ?>", "<li><li><ul><li>"):
        assert isinstance(m.text(h), str)


def test_html_whole_table(spark):
    got = {r.page_id: r.text for r in html_content.query(spark, SF).collect()}
    pages = table(spark, SF, "pages").collect()
    assert len(got) == len(pages)
    for r in pages:
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        inner = re.sub(r"<[^>]+>", " ", re.sub(r"</?b>", "", inner))
        assert got[r.page_id] == " ".join(html.unescape(inner).split())
