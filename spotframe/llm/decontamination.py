"""Benchmark decontamination by Wu-Manber multi-pattern search over words."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.storage import stable
from .common import ALNUM_TABLE, ranges, raw_texts, steps, two_columns

WINDOW = 10
# Words of benchmark text that one pass searches for. A larger benchmark is searched in several passes.
BLOCK_WORDS = 1_000_000
# Words after which the scan starts another lane; lanes advance side by side.
LANE = 256


@dataclass
class Patterns:
    """Search tables for the patterns of one length (in words)."""

    width: int
    block: int
    keys: np.ndarray  # blocks of two words (of one word for patterns of one) that patterns hold, sorted
    shifts: np.ndarray  # how far the end of the window may move when it ends with that block
    buckets: np.ndarray  # per key, where its patterns start in ``order`` (those that end with the block)
    order: np.ndarray
    words: np.ndarray  # patterns x width
    owner_start: np.ndarray  # per pattern, where its items start in ``owners``
    owners: np.ndarray


class Search:
    """Shift tables and suffix buckets over the windows of some benchmark items."""

    def __init__(self, items: list[bytes], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        by_width: dict[int, dict[tuple[int, ...], list[int]]] = {}
        for number, text in enumerate(items):
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in text.translate(ALNUM_TABLE).split()]
            width = min(window, len(ids))
            for i in range(len(ids) - width + 1 if width else 0):
                owners = by_width.setdefault(width, {}).setdefault(tuple(ids[i : i + width]), [])
                if not owners or owners[-1] != number:
                    owners.append(number)
        self.base = len(self.vocabulary) + 1
        self.tables = [self._table(width, found) for width, found in sorted(by_width.items())]

    def _table(self, width: int, found: dict[tuple[int, ...], list[int]]) -> Patterns:
        words = np.array(list(found), dtype=np.int64).reshape(len(found), width)
        block = min(2, width)
        blocks = words if block == 1 else words[:, :-1] * self.base + words[:, 1:]
        far = np.broadcast_to(np.arange(width - block, -1, -1), blocks.shape)
        keys, where = np.unique(blocks, return_inverse=True)
        shifts = np.full(len(keys), width, dtype=np.int64)
        np.minimum.at(shifts, where.ravel(), far.ravel())
        last = np.searchsorted(keys, blocks[:, -1])
        order = np.argsort(last, kind="stable")
        counts = np.array([len(o) for o in found.values()])
        return Patterns(
            width,
            block,
            keys,
            shifts,
            np.searchsorted(last[order], np.arange(len(keys) + 1)),
            order,
            words,
            np.concatenate([[0], np.cumsum(counts)]),
            np.array([i for o in found.values() for i in o], dtype=np.int64),
        )

    def scan(
        self, texts: list[bytes], before: list[list[tuple[int, int]]] | None = None
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per text: number of words, covered spans (with those from ``before``) and the numbers of the items found."""
        get, parts, sizes = self.vocabulary.get, [], []
        for text in texts:
            words = text.translate(ALNUM_TABLE).split()
            sizes.append(len(words))
            parts.append(np.fromiter((i or 0 for i in map(get, words)), dtype=np.int64, count=len(words)))
            # The gap is a word of no pattern, so no match spans two texts.
            parts.append(np.zeros(1, dtype=np.int64))
        ids = np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum(np.array(sizes, dtype=np.int64) + 1)])
        edges = np.zeros(len(ids) + 1, dtype=np.int32)
        text_of, item_of = [], []
        for table in self.tables:
            end, pattern = self._matches(ids, table)
            np.add.at(edges, end - table.width + 1, 1)
            np.add.at(edges, end + 1, -1)
            count = table.owner_start[pattern + 1] - table.owner_start[pattern]
            item_of.append(table.owners[ranges(table.owner_start[pattern], count)])
            text_of.append(np.repeat(np.searchsorted(starts, end, side="right") - 1, count))
        for k, spans in enumerate(before or ()):
            for start, stop in spans:
                edges[starts[k] + start] += 1
                edges[starts[k] + stop] -= 1
        covered = np.cumsum(edges[:-1]) > 0
        change = np.diff(np.concatenate([[0], covered.view(np.int8), [0]]))
        first, after = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        owner = np.searchsorted(starts, first, side="right") - 1
        cut = np.searchsorted(owner, np.arange(len(sizes) + 1))
        pairs = np.stack([np.concatenate(text_of), np.concatenate(item_of)]) if text_of else np.empty((2, 0), dtype=np.int64)
        pairs = np.unique(pairs, axis=1)
        item_cut = np.searchsorted(pairs[0], np.arange(len(sizes) + 1))
        for k, n in enumerate(sizes):
            a, b = cut[k], cut[k + 1]
            yield n, np.stack([first[a:b], after[a:b]]) - starts[k], pairs[1, item_cut[k] : item_cut[k + 1]]

    def _matches(self, ids: np.ndarray, table: Patterns) -> tuple[np.ndarray, np.ndarray]:
        """Ends and patterns of all occurrences. Every lane moves its window by the shift of the block it ends with."""
        n, found = len(ids), []
        at = np.arange(0, n, LANE) + table.width - 1
        stop = np.minimum(at + LANE, n)
        default = table.width - table.block + 1
        while True:
            alive = at < stop
            at, stop = at[alive], stop[alive]
            if not len(at):
                break
            key = ids[at] if table.block == 1 else ids[at - 1] * self.base + ids[at]
            slot = np.minimum(np.searchsorted(table.keys, key), len(table.keys) - 1)
            known = table.keys[slot] == key
            shift = np.where(known, table.shifts[slot], default)
            ends = shift == 0
            if ends.any():
                bucket, end = slot[ends], at[ends]
                count = table.buckets[bucket + 1] - table.buckets[bucket]
                pattern = table.order[ranges(table.buckets[bucket], count)]
                end = np.repeat(end, count)
                # Word by word from the left, on those that still agree.
                for j in range(table.width):
                    same = ids[end - table.width + 1 + j] == table.words[pattern, j]
                    end, pattern = end[same], pattern[same]
                found.append((end, pattern))
            at = at + np.maximum(shift, 1)
        if not found:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        return np.concatenate([e for e, _ in found]), np.concatenate([p for _, p in found])


def _blocks(benchmark: DataFrame, limit: int) -> Iterator[tuple[list, list[bytes]]]:
    """Items in blocks of a bounded number of words; one partition at a time reaches the driver."""
    ids, texts, words = [], [], 0
    for row in benchmark.where(F.length("_text") > 0).toLocalIterator():
        text = row["_text"].encode()
        size = len(text.translate(ALNUM_TABLE).split())
        if texts and words + size > limit:
            yield ids, texts
            ids, texts, words = [], [], 0
        ids.append(row["_id"])
        texts.append(text)
        words += size
    yield ids, texts


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Where documents repeat ``window`` consecutive words of a benchmark item.

    Returns one row per document with its id under ``id_col``: ``n_words``, ``spans`` (disjoint word ranges,
    stop excluded, in order) and ``items`` (ids of the items with an occurring window, distinct). Items of
    fewer words, but not none, are one window.

    A null text has no words; an item without words never occurs; a null item id counts as an item; repeated
    documents and items each give their own result, repeated item ids count once. Without items or documents the
    result is empty of spans or rows. Other columns of either table are ignored.

    The search tables of at most ``block_words`` benchmark words travel to the executors; a larger benchmark takes
    several passes, whose results are merged per document.
    """
    rows = two_columns(docs, id_col, text_col)
    found = _search(rows, benchmark, item_id_col, item_text_col, window, block_words)
    return found.select(F.col("_id").alias(id_col), "n_words", "spans", "items")


def without_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Rows whose text repeats no window of a benchmark item, all columns as they were. No shuffle."""
    rest = [c for c in docs.columns if c != text_col]
    rows = docs.select(
        F.lit(None).cast("long").alias("_id"), F.col(text_col).alias("_text"), F.struct(F.lit(0).alias("_"), *rest).alias("_rest")
    )
    clean = _search(rows, benchmark, item_id_col, item_text_col, window, block_words).where(F.size("spans") == 0)
    return clean.select(*[F.col("_text").alias(c) if c == text_col else F.col("_rest")[c].alias(c) for c in docs.columns])


def _search(rows: DataFrame, benchmark: DataFrame, item_id: str, item_text: str, window: int, limit: int) -> DataFrame:
    """Rows with n_words, spans and items; a pass for each block of the benchmark, which adds to what is there."""
    items = two_columns(benchmark, item_id, item_text)
    item_arrow = items.select("_id").limit(0).toArrow().schema.field("_id").type
    item_kind = items.schema["_id"].dataType.simpleString()
    names = rows.columns
    no_spans, no_items = (F.array().cast(k) for k in ("array<struct<start:int,stop:int>>", f"array<{item_kind}>"))
    found = rows.select("*", F.lit(0).cast("long").alias("n_words"), no_spans.alias("spans"), no_items.alias("items"))
    schema = found.schema
    for number, (item_ids, texts) in enumerate(_blocks(items, limit)):
        search = rows.sparkSession.sparkContext.broadcast((Search(texts, window), item_ids))

        def scan(batches: Iterable[pa.RecordBatch], search=search) -> Iterator[pa.RecordBatch]:
            tables, ids = search.value
            ids = np.array([*ids, None], dtype=object)
            for batch in steps(batches):
                before = [[(x["start"], x["stop"]) for x in spans] for spans in batch.column("spans").to_pylist()]
                known = batch.column("items").to_pylist()
                done = list(tables.scan(raw_texts(batch), before))
                cuts = np.concatenate([[0], np.cumsum([s.shape[1] for _, s, _ in done])]).astype(np.int32)
                flat = np.concatenate([s for _, s, _ in done], axis=1).astype(np.int32)
                spans = pa.StructArray.from_arrays([pa.array(flat[0]), pa.array(flat[1])], ["start", "stop"])
                listed = [list(dict.fromkeys([*k, *ids[i]])) for k, (_, _, i) in zip(known, done, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c) for c in names],
                        pa.array([n for n, _, _ in done], type=pa.int64()),
                        pa.ListArray.from_arrays(pa.array(cuts), spans),
                        pa.array(listed, type=pa.list_(item_arrow)),
                    ],
                    [*names, "n_words", "spans", "items"],
                )

        found = (stable(found) if number else found).mapInArrow(scan, schema)
    return found
