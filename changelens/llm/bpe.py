"""Byte-level BPE encoding and decoding by prefix-sharing trie traversal.

The encoding of a word is settled by one number for each of its prefixes, the
last token of that prefix's encoding: dropping it leaves the encoding of a
shorter prefix.  A token t that ends a prefix is its last token exactly when t
follows the last token t' of the prefix before it and BPE leaves the pair
(t', t) as it is.

The distinct words of a batch are put in byte order, which is the depth-first
order of their trie: the states of the current path are kept on a stack, and
the next word starts below the node where it leaves that path.  So a prefix
that many words share is settled once.  Every document's ids are then looked
up word by word in the task; nothing is shuffled.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterable, Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelens.llm.common import table
from changelens.session import prepare_python

#: Words, pairs of tokens that a worker remembers, and characters of text handled at once.
CACHE_WORDS = 250_000
CACHE_PAIRS = 200_000
BATCH_CHARS = 1 << 21
NEVER = 1 << 60

#: The pre-token pattern of this kind of byte-level vocabulary.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: The same for texts of ASCII characters only, for the faster engine.
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"
#: A place where no pre-token goes on: they have white space only in front.
CUT = regex.compile(r"(?<=\S)(?=\s)")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable
    Latin-1 characters stand for themselves, the others for 256, 257, ..."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokens:
    """The bytes of each id of a vocabulary file: all that decoding needs."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            self.load(json.load(f))

    def load(self, spec: dict) -> None:
        letters = byte_letters()
        self.raw = lambda token: bytes(letters[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: self.raw(t) for t, i in spec["model"]["vocab"].items() if t not in self.special}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


class Codec(Tokens):
    def load(self, spec: dict) -> None:
        super().load(spec)
        raw = self.raw
        self.ids = {b: i for i, b in self.bytes_of.items() if i not in self.special.values()}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.joins = {(self.ids[raw(a)], self.ids[raw(b)]): r for r, (a, b) in enumerate(pairs)}
        self.made_of: dict[int, tuple[int, int, int]] = {}
        for (a, b), r in self.joins.items():
            self.made_of.setdefault(self.ids[self.bytes_of[a] + self.bytes_of[b]], (a, b, r))
        self.spines: dict[tuple[int, int], tuple[list[int], list[int]]] = {}
        self.sizes = {i: len(b) for b, i in self.ids.items()}
        self.vocabulary: dict = {}  # trie of the tokens: byte to node, -1 to the token that ends here
        for b, i in self.ids.items():
            node = self.vocabulary
            for byte in b:
                node = node.setdefault(byte, {})
            node[-1] = i
        for b, i in self.ids.items():
            node = self.vocabulary
            for byte in b[:-1]:
                node = node[byte]
            if len(node[b[-1]]) == 1:  # a leaf is its token
                node[b[-1]] = i
        self.find = regex.compile(PATTERN).findall
        self.find_ascii = re.compile(ASCII_PATTERN, re.ASCII).findall
        self.parts = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")").split if self.special else lambda x: [x]
        self.words: dict[str, bytes] = {}  # ids as 32-bit integers
        self.pairs: dict[tuple[int, int], bool] = {}

    def merged(self, word: bytes) -> list[int]:
        """Plain BPE: merge the leftmost pair of the lowest rank until none is left.  For short words."""
        parts = [self.ids[word[i : i + 1]] for i in range(len(word))]
        while len(parts) > 1:
            rank, at = min((self.joins.get(p, NEVER), i) for i, p in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == NEVER:
                break
            parts[at : at + 2] = [self.ids[self.bytes_of[parts[at]] + self.bytes_of[parts[at + 1]]]]
        return parts

    def spine(self, token: int, side: int) -> tuple[list[int], list[int]]:
        """The parts of a token that touch its end (1) or start (0), small to large,
        and the rank of the merge that takes each into the next."""
        if (token, side) not in self.spines:
            parts, ranks = [token], [NEVER]
            while (made := self.made_of.get(parts[-1])) is not None:
                parts.append(made[side])
                ranks.append(made[2])
            self.spines[token, side] = parts[::-1], ranks[::-1]
        return self.spines[token, side]

    def stays(self, before: int, token: int) -> bool:
        """Whether BPE leaves ``token`` as it is after ``before`` (-1: at the start).

        Both sides of the border grow by their own merges, the lower rank (on
        the same rank the left) first; the pair goes if a merge across the
        border comes before the next one of either side.
        """
        if before < 0:
            known = self.merged(self.bytes_of[token]) == [token]
        else:
            (left, left_ranks), (right, right_ranks) = self.spine(before, 1), self.spine(token, 0)
            i = j = 0
            known = None
            while known is None:
                a, b = left_ranks[i], right_ranks[j]
                across = self.joins.get((left[i], right[j]), NEVER)
                if across < a and across <= b:
                    known = False
                elif a == b == NEVER:
                    known = True
                elif a <= b:
                    i += 1
                else:
                    j += 1
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        self.pairs[before, token] = known
        return known

    def traverse(self, words: Iterable[bytes]) -> Iterator[list[int]]:
        """The ids of distinct words in byte order, depth first through their trie.

        The state of a trie node is the last token of its prefix, and the walks
        through the vocabulary's own trie that are still alive there: pairs of
        the last token before the walk's start and its place in the vocabulary.
        """
        pairs, stays, sizes = self.pairs, self.stays, self.sizes
        start = self.vocabulary
        last, alive = [-1], [[(-1, start)]]
        path = b""
        for word in words:
            shared = len(commonprefix((path, word)))
            del last[shared + 1 :], alive[shared + 1 :]
            for byte in word[shared:]:
                walks, found = [], None
                for before, node in alive[-1]:
                    if (node := node.get(byte)) is None:
                        continue
                    if node.__class__ is int:  # a token that no longer one starts with
                        token = node
                    else:
                        walks.append((before, node))
                        token = node.get(-1)
                    if found is None and token is not None:
                        ok = pairs.get((before, token))
                        if ok or ok is None and stays(before, token):
                            found = token
                walks.append((found, start))
                last.append(found)
                alive.append(walks)
            path = word
            ids, end = [], len(word)
            while end:
                ids.append(last[end])
                end -= sizes[last[end]]
            ids.reverse()
            yield ids

    def pre_tokens(self, text: str) -> Iterator[list[str] | int]:
        """Lists of words, and the ids of special tokens between them; a long text comes in pieces."""
        for part in self.parts(text):
            if part in self.special:
                yield self.special[part]
                continue
            at = 0
            while at < len(part):
                cut = CUT.search(part, at + BATCH_CHARS)
                end = cut.start() if cut else len(part)
                piece = part[at:end]
                yield self.find_ascii(piece) if piece.isascii() else self.find(piece)
                at = end

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        docs = [list(self.pre_tokens(t)) for t in texts]
        used = set().union(*(p for d in docs for p in d if not isinstance(p, int)))
        new = used - self.words.keys()
        if len(self.words) + len(new) > CACHE_WORDS:
            self.words = {w: self.words[w] for w in used - new}  # the common ones are in any batch
        in_order = sorted(w.encode() for w in new)
        for word, ids in zip(in_order, self.traverse(in_order), strict=True):
            self.words[word.decode()] = array("i", ids).tobytes()
        get = self.words.__getitem__
        joined = lambda d: b"".join(array("i", [p]).tobytes() if isinstance(p, int) else b"".join(map(get, p)) for p in d)
        return [np.frombuffer(joined(d), np.int32) for d in docs]


_CODECS: dict[tuple[type, str], Tokens] = {}


def loaded(kind: type, path: str) -> Tokens:
    """The worker's ``Codec`` of a vocabulary file, with the words it has seen, or its ``Tokens``."""
    if (kind, path) not in _CODECS:
        _CODECS[kind, path] = kind(path)
    return _CODECS[kind, path]


def chunks(batch: pa.RecordBatch, column: str, limit: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``limit`` bytes of text: the memory a task needs doesn't depend on the batch."""
    ends = np.cumsum(np.nan_to_num(pa.compute.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(float))).astype(np.int64)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(at, end - at)
        at = end


def encode(docs: DataFrame, path: str, decoded: bool = False) -> DataFrame:
    """(doc_id, ids array<int>) of every whole text, as the vocabulary's own
    library gives them, and with ``decoded`` the text that those ids decode to.

    Strings of special tokens in a text become their ids, nothing is added.
    Defined cases: a null or empty text has no ids; rows that repeat are
    encoded alike; other columns are not read; an empty table gives an empty
    result.
    """

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = loaded(Codec, path)
        for b in it:
            for part in chunks(b, "text"):
                ids = c.encode([x or "" for x in part.column("text").to_pylist()])
                sizes = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                values = pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32))
                columns = {"doc_id": part.column("doc_id"), "ids": pa.ListArray.from_arrays(pa.array(sizes), values)}
                if decoded:
                    columns["decoded"] = pa.array([c.decode(x) for x in ids], pa.string())
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    prepare_python(docs.sparkSession)
    schema = "doc_id long, ids array<int>" + ", decoded string" * decoded
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(batches, schema)


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """``tokens`` (doc_id, ids) with ``decoded``: the text of the ids, special tokens as their strings."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = loaded(Tokens, path)
        for b in it:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                column = part.column("ids")
                texts = [c.decode(x.values.to_numpy()) if x.is_valid else "" for x in column]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), column, pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"])

    prepare_python(tokens.sparkSession)
    return tokens.select("doc_id", "ids").mapInArrow(batches, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encode(docs, path, decoded=True).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
