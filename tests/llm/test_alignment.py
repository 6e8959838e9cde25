"""Cross-tokenizer alignment against the libraries' encodings of whole texts and all link pairs."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import sentencepiece
from conftest import SF
from tokenizers import Tokenizer

from changelens.llm import alignment
from changelens.llm.bpe import byte_letters
from changelens.llm.common import table

from .conftest import ODD

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TOK = Tokenizer.from_file(A)
TOK.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=B)
LETTERS = byte_letters()


def bytes_a(i):
    return bytes(LETTERS[c] for c in TOK.id_to_token(i))


def bytes_b(i):
    piece = PIECES.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if PIECES.is_byte(i) else piece.replace("▁", " ").encode()


def ranges(parts):
    out, at = [], 0
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def plain_groups(text):
    """Groups by the byte ranges of whole texts: cut wherever both have an end."""
    if not text:
        return []
    a, b = TOK.encode(" " + text, add_special_tokens=False).ids, PIECES.encode(text)
    raw = (" " + text).encode()
    ra, rb = ranges(list(map(bytes_a, a))), ranges(list(map(bytes_b, b)))
    if b"".join(map(bytes_a, a)) != raw or b"".join(map(bytes_b, b)) != raw:
        return []
    cuts = sorted({e for _, e in ra} & {e for _, e in rb})
    group = lambda r: next(k for k, c in enumerate(cuts) if r[1] <= c) if len(cuts) < 300 else None
    if len(cuts) >= 300:
        import bisect

        group = lambda r: bisect.bisect_left(cuts, r[1])
    out = [([], []) for _ in cuts]
    for i, r in zip(a, ra, strict=True):
        out[group(r)][0].append(i)
    for j, r in zip(b, rb, strict=True):
        out[group(r)][1].append(j)
    return out


def plain(texts):
    grouped = [plain_groups(t) for t in texts]
    links = [Counter((i, j) for x, y in g for i in x for j in y) for g in grouped]
    held = Counter(p for ls in links for p in ls)
    most = defaultdict(int)
    for (i, _), n in held.items():
        most[i] = max(most[i], n)
    out = []
    for g, ls in zip(grouped, links, strict=True):
        told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append((
            sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(ls.values()),
            sum(n for p, n in ls.items() if held[p] == most[p[0]]), sum(n * held[p] for p, n in ls.items()),
            hashlib.sha256(told.encode()).hexdigest() if g else ""))
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def check(df, rows, **more):
    got = alignment.cross_tokenizer(df, A, B, **more)
    assert got.columns == COLUMNS
    want = Counter((r[0], *p) for r, p in zip(rows, plain([r[1] for r in rows]), strict=True))
    assert Counter(map(tuple, got.collect())) == want


MORE = [
    (20, "a  b\n  c\t d  "), (21, " "), (22, "  "), (23, "x ▁ y"), (24, "<|endoftext|> </s> <s>"), (25, "😀👍🏽 é́"), (26, "\x00 \x1c a"),
    (27, "a\x85 b　 c᠎ d"), (28, "a" * 30_000), (29, "日本語" * 3_000), (30, "don't we'll 123456789 ..."), (30, "don't we'll 123456789 ..."), (31, "\n"), (32, "ﬁ ½ Å")]


def test_odd_texts(spark, odd, empty):
    from .conftest import frame

    more = frame(spark, [(i, t, "en", "a") for i, t in MORE])
    rows = [*ODD, *MORE]
    check(odd.unionByName(more), rows)
    check(odd.unionByName(more), rows, table_pairs=20)  # most pairs by shuffle
    assert alignment.cross_tokenizer(empty, A, B).count() == 0


def test_query(spark):
    docs = table(spark, SF, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = Counter((r[0], *p) for r, p in zip(rows, plain([r[1] for r in rows]), strict=True))
    assert Counter(map(tuple, alignment.query(spark, SF).collect())) == want


def test_random_strings_word_by_word(monkeypatch):
    """Words are aligned alone and together with others; joined they must be the alignment of the whole text."""
    rng = random.Random(5)
    letters = ["a", "the", "  ", " ", " ", "\n", "\t", "\x0b", "\x1c", "\x85", "　", "᠎", "é", "日", "😀", "'s", "12", "...", "</s>", "​", "▁", "\x00", "ﬁ"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 24))) for _ in range(3_000)]
    texts += [" ".join(rng.choice(["ab", "the", "zq"]) for _ in range(n)) + end for n in (3, 9, 50) for end in ("", " ", "  ", "\n ")]
    got = list(alignment.Aligner(A, B).texts(texts))
    monkeypatch.setattr(alignment, "LARGE_GROUP", 2)
    monkeypatch.setattr(alignment, "CACHE_WORDS", 50)
    small = alignment.Aligner(A, B)
    again = [r for i in range(0, len(texts), 40) for r in small.texts(texts[i : i + 40])]
    for text, (n_a, n_b, n_groups, n_links, groups, pairs, times) in zip(texts, got, strict=True):
        want = plain_groups(text)
        told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in want)
        assert (groups, n_groups, n_links, sum(times)) == (told, len(want), sum(len(x) * len(y) for x, y in want), n_links), text
        assert (n_a, n_b) == (sum(len(x) for x, _ in want), sum(len(y) for _, y in want))
        assert pairs == sorted({i * alignment.PAIR + j for x, y in want for i in x for j in y})
    assert again == got
    assert all(len(w) <= alignment.CACHE_CHARS for w in small.words)


def test_new_words_are_encoded_in_lines(monkeypatch):
    """The libraries are called for lines of many words, not for each word; words that could touch others stay alone."""
    lines = alignment.Aligner.in_lines
    seen = []
    monkeypatch.setattr(alignment.Aligner, "in_lines", lambda self, words: seen.append(words) or lines(self, words))
    alone = alignment.Aligner.encoded
    monkeypatch.setattr(alignment.Aligner, "encoded", lambda self, words: seen.append(("alone", *words)) or alone(self, words))
    texts = [" ".join(f"w{i}x{k}" for i in range(2_500)) for k in range(2)] + ["an end \n", "a ▁ b"]
    got = list(alignment.Aligner(A, B).texts(texts))
    assert len(seen) == 2 and len(seen[0]) == 5_000 + 4 and set(seen[1]) == {"alone", "\n", "▁"}
    for text, r in zip(texts, got, strict=True):
        want = plain_groups(text)
        assert r[4] == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in want)
        assert r[:4] == (sum(len(x) for x, _ in want), sum(len(y) for _, y in want), len(want), sum(len(x) * len(y) for x, y in want))


def test_lines_that_lose_bytes_are_encoded_word_by_word(monkeypatch):
    texts = ["some words here", "and  more\nof them "]
    want = list(alignment.Aligner(A, B).texts(texts))
    monkeypatch.setattr(alignment.Aligner, "in_lines", lambda self, words: None)
    assert list(alignment.Aligner(A, B).texts(texts)) == want
