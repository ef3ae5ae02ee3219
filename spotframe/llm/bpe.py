"""Byte-pair encoding and decoding with a segment tree over the ranks of adjacent pairs."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import STEP_BYTES, ranges, steps, two_columns

# Pieces of text (between white space) whose tokens a task remembers before it starts anew.
CACHE_PIECES = 300_000

# Symbols of the words that one call of the merger lays side by side.
SYMBOLS = 1 << 20

NO_RANK = np.iinfo(np.int64).max

SPACE = regex.compile(r"\p{White_Space}+")


def byte_letters() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte.

    Printable Latin-1 characters stand for themselves; the other bytes take the code points from 256 on, in order.
    """
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in own else next(others)) for b in range(256)]


class Merger:
    """Merges of many words side by side.

    Every word has a segment tree whose leaves hold, for each symbol, the rank of the pair it forms with the next
    one, and whose nodes hold the smallest (rank, position) below. So the root is the leftmost pair of lowest rank. A
    merge writes at most three leaves (the pair, the one before it, and the one that ends) and the nodes above them.
    """

    def __init__(self, first: np.ndarray, second: np.ndarray, merged: np.ndarray):
        key = (first.astype(np.int64) << 32) | second
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.merged = key[order], order.astype(np.int64), merged[order].astype(np.int64)

    def _pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (or NO_RANK) and place in the table of pairs; a symbol below 0 is none."""
        key = (a << 32) | np.maximum(b, 0)
        slot = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        good = (self.keys[slot] == key) & (a >= 0) & (b >= 0)
        return np.where(good, self.ranks[slot], NO_RANK >> 20), slot

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all words one after the other, and their number per word; words are given the same way."""
        starts = np.cumsum(lengths) - lengths
        counts, found, size = np.zeros(len(lengths), dtype=np.int64), [], 1
        while size < 2 * int(lengths.max(initial=0)):
            # Words of (size / 2, size] symbols share trees of ``size`` leaves.
            chosen = np.flatnonzero((lengths > size // 2) & (lengths <= size))
            step = max(1, SYMBOLS // size)
            for i in range(0, len(chosen), step):
                part = chosen[i : i + step]
                tokens, counts[part] = self._trees(symbols[ranges(starts[part], lengths[part])], lengths[part], size)
                found.append((part, tokens))
            size *= 2
        tokens = np.empty(int(counts.sum()), dtype=np.int64)
        starts = np.cumsum(counts) - counts
        for part, own in found:
            tokens[ranges(starts[part], counts[part])] = own
        return tokens, counts

    def _trees(self, flat: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(lengths)
        # A rank and a position share one number, so that the smaller one is the lower rank, then the left one.
        bits = np.int64(max(1, size.bit_length()))
        symbols = np.full((n, size + 1), -1, dtype=np.int64)
        symbols[np.repeat(np.arange(n), lengths), ranges(np.zeros(n, dtype=np.int64), lengths)] = flat
        after = np.tile(np.arange(1, size + 2), (n, 1))
        before = np.tile(np.arange(-1, size), (n, 1))
        tree = np.full((n, 2 * size), NO_RANK, dtype=np.int64)
        rank, _ = self._pair(symbols[:, :-1], symbols[:, 1:])
        tree[:, size:] = (rank << bits) | np.arange(size)
        half = size // 2
        while half:
            tree[:, half : 2 * half] = np.minimum(tree[:, 2 * half : 4 * half : 2], tree[:, 2 * half + 1 : 4 * half : 2])
            half //= 2
        limit = np.int64(NO_RANK >> 20) << bits
        rows = np.arange(n)
        while True:
            root = tree[rows, 1]
            rows = rows[root < limit]
            if not len(rows):
                break
            root = tree[rows, 1]
            left = root & ((np.int64(1) << bits) - 1)
            right = after[rows, left]
            _, slot = self._pair(symbols[rows, left], symbols[rows, right])
            symbols[rows, left] = self.merged[slot]
            symbols[rows, right] = -1
            beyond = after[rows, right]
            after[rows, left] = beyond
            inside = beyond <= size
            before[rows[inside], beyond[inside]] = left[inside]
            self._put(tree, rows, right, np.full(len(rows), NO_RANK >> 20), size, bits)
            following = np.where(inside, symbols[rows, np.minimum(beyond, size)], -1)
            self._put(tree, rows, left, self._pair(symbols[rows, left], following)[0], size, bits)
            previous = before[rows, left]
            has = previous >= 0
            r, p = rows[has], previous[has]
            self._put(tree, r, p, self._pair(symbols[r, p], symbols[r, left[has]])[0], size, bits)
        kept = symbols >= 0
        return symbols[kept], kept.sum(axis=1)

    @staticmethod
    def _put(tree: np.ndarray, rows: np.ndarray, leaf: np.ndarray, rank: np.ndarray, size: int, bits: np.int64) -> None:
        """Point update: the leaf, then every node on its way to the root."""
        node = leaf + size
        tree[rows, node] = (rank << bits) | leaf
        while size > 1:
            node = node >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
            size //= 2


# Characters that newer Unicode versions count as letters or digits and the library does not, as first and last one.
NEITHER = (
    "0558-0558 058B-058C 088F-088F 0C5C-0C5C 0CDC-0CDC 208F-208F 209D-209F A7CE-A7CF A7D2-A7D2 A7D4-A7D4 A7DD-A7DD A7E2-A7E2 "
    "A7F1-A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A-11B0A 11DB0-11DDB 11DE0-11DE9 11DF1-11DF1 "
    "1246F-1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF3 16FF4-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 "
    "18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168-1B168 1D6A6-1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF "
    "1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E-2B81E 2CEA2-2CEAD 323B0-33479 "
    "3D000-3FC3F"
)
# First and last capital and the small letter of the first one, where the library knows more of them than Python may.
CAPITALS = (
    "1C89-1C89:1C8A A7CB-A7CB:0264 A7CC-A7CC:A7CD A7CE-A7CE:A7CF A7D2-A7D2:A7D3 A7D4-A7D4:A7D5 A7DA-A7DA:A7DB A7DC-A7DC:019B "
    "10D50-10D65:10D70 16EA0-16EB8:16EBB"
)
# A character that is neither letter nor digit nor white space in any version stands for those in the split.
STAND_IN = "\ue000"


def _neither() -> regex.Pattern:
    spans = [tuple(chr(int(x, 16)) for x in span.split("-")) for span in NEITHER.split()]
    return regex.compile("[" + "".join(f"{a}-{b}" for a, b in spans) + "]")


def _small() -> dict[int, int]:
    out = {}
    for row in CAPITALS.split():
        span, small = row.split(":")
        first, last = (int(x, 16) for x in span.split("-"))
        out.update({k: int(small, 16) + k - first for k in range(first, last + 1)})
    return out


NEITHER_CLASS, SMALL = _neither(), _small()


class Tokenizer:
    """Byte-level BPE with word ends, as described by a tokenizer file.

    Supported: the normalisers NFC, white space to one space and lower case; a split by pattern whose matches are the
    words; added tokens that are matched in the raw text. Other settings are refused. Letters, digits and lower case are
    those of the tokenizers library, whatever Unicode versions Python and the regex module have.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, splits = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        steps_of = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if (
            model["type"] != "BPE"
            or steps_of != ["NFC", "Replace", "Lowercase"]
            or [s["type"] for s in splits] != ["Split", "ByteLevel"]
            or splits[0]["behavior"] != "Removed"
            or not splits[0]["invert"]
            or any(model[k] for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
            or spec["decoder"] is not None
        ):
            raise ValueError(f"{path}: settings that this tokenizer doesn't know")
        vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        self.words = regex.compile(splits[0]["pattern"]["Regex"])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        size = max([*vocab.values(), *self.added.values()]) + 1
        tokens = [""] * size
        for token, i in [*vocab.items(), *self.added.items()]:
            tokens[i] = token
        self.tokens = pa.array(tokens)
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], dtype=np.int64)
        self.last = np.array([vocab[c + self.end] for c in letters], dtype=np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merger = Merger(
            np.array([vocab[a] for a, _ in pairs]), np.array([vocab[b] for _, b in pairs]), np.array([vocab[a + b] for a, b in pairs])
        )
        self._start()

    def _normal(self, piece: str) -> str:
        # Lower case is taken character by character, so a capital sigma never becomes a final one.
        small = unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()
        return small if small.isascii() else small.translate(SMALL)

    def _words(self, piece: str) -> list[str]:
        shown = piece if piece.isascii() else NEITHER_CLASS.sub(STAND_IN, piece)
        if shown == piece:
            return self.words.findall(piece)
        return [piece[m.start() : m.end()] for m in self.words.finditer(shown)]

    def _start(self) -> None:
        # Pieces by number, and their tokens one after the other. An added token is a piece; no other piece can hold
        # one, as those are cut out first.
        self.known: dict[str, int] = {token: k for k, token in enumerate(self.added)}
        self.flat = np.array(list(self.added.values()), dtype=np.int32)
        self.counts = np.ones(len(self.added), dtype=np.int64)

    def learn(self, pieces: set[str]) -> None:
        """Encode the pieces not known yet, all their words side by side."""
        if len(self.known) > CACHE_PIECES:
            self._start()
        new = list(pieces.difference(self.known))
        number: dict[str, int] = {}
        word_of, sizes = [], []
        for piece in new:
            words = self._words(self._normal(piece))
            word_of += [number.setdefault(w, len(number)) for w in words]
            sizes.append(len(words))
        data = [w.encode() for w in number]
        lengths = np.array([len(w) for w in data], dtype=np.int64)
        letters = np.frombuffer(b"".join(data), dtype=np.uint8)
        symbols = self.inner[letters]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last[letters[ends]]
        tokens, counts = self.merger.merge(symbols, lengths)
        word_of, sizes = np.array(word_of, dtype=np.int64), np.array(sizes, dtype=np.int64)
        own = counts[word_of]
        starts = np.cumsum(counts) - counts
        self.flat = np.concatenate([self.flat, tokens[ranges(starts[word_of], own)].astype(np.int32)])
        edges = np.concatenate([[0], np.cumsum(own)])[np.concatenate([[0], np.cumsum(sizes)])]
        self.counts = np.concatenate([self.counts, np.diff(edges)])
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))

    def pieces(self, text: str) -> list[str]:
        """Text between white space; added tokens are pieces of their own."""
        out: list[str] = []
        at = 0
        for found in self.special.finditer(text) if self.special else ():
            out += self._split(text[at : found.start()])
            out.append(found[0])
            at = found.end()
        return out + self._split(text[at:] if at else text)

    @staticmethod
    def _split(text: str) -> list[str]:
        # str.split also cuts at the four separators U+001C to U+001F, which aren't white space here.
        if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
            return [p for p in SPACE.split(text) if p]
        return text.split()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts one after the other, and where each text's ids start (with the end)."""
        split = [self.pieces(t) for t in texts]
        self.learn(set().union(*split))
        sizes = np.array([len(p) for p in split], dtype=np.int64)
        used = np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), dtype=np.int64, count=int(sizes.sum()))
        counts = self.counts[used]
        ids = self.flat[ranges((np.cumsum(self.counts) - self.counts)[used], counts)]
        edges = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], np.cumsum(sizes)])]
        return ids, edges

    def decode(self, ids: np.ndarray, edges: np.ndarray) -> pa.Array:
        """Tokens of every text joined by one space, as a tokenizer file without a decoder asks for."""
        tokens = self.tokens.take(pa.array(ids))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), tokens), " ")


_LOADED: dict[str, Tokenizer] = {}


def load(path: str) -> Tokenizer:
    """The tokenizer of a file, read once per process."""
    if path not in _LOADED:
        _LOADED[path] = Tokenizer(path)
    return _LOADED[path]




def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of every text and the text that they decode to: ``id_col``, ``ids``, ``decoded``.

    ``path`` is a tokenizer file at the same place on every executor. Added tokens that stand in a text become their
    ids; no others are added; nothing is cut or padded. A null text counts as empty: no ids, empty decoded text. Rows
    are independent of each other, so repeated ids and ties need no rule; a table without rows gives none; other
    columns are ignored.
    """
    rows = two_columns(docs, id_col, text_col)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(path)
        for batch in steps(batches, limit=STEP_BYTES // 2):
            texts = pc.fill_null(batch.column("_text"), "").to_pylist()
            ids, edges = tokenizer.encode(texts)
            lists = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(ids))
            decoded = tokenizer.decode(ids, edges)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), lists, decoded], ["_id", "ids", "decoded"])

    kind = rows.schema["_id"].dataType.simpleString()
    found = rows.mapInArrow(work, f"_id {kind}, ids array<int>, decoded string")
    return found.select(F.col("_id").alias(id_col), "ids", "decoded")
