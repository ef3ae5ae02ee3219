"""Removal of long repeated word sequences by super-k-mer partitioning.

Windows of a fixed number of words go to buckets by their minimiser, the smallest hash of the few-word pieces inside.
Consecutive windows of a document mostly share it, so they travel together as one packed string (a super-k-mer). Equal
windows have equal minimisers and meet in one bucket, where sorting counts them exactly.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, mixed, ranges, raw_texts, steps, two_columns, window_hashes

WINDOW = 35
PIECE = 4

# Text bytes whose super-k-mers a task packs together.
STEP = 5 << 20

# Words that a bucket should get, so that a task can hold it.
BUCKET_WORDS = 2_500_000

# Slots of minimisers whose size is measured first, per full bucket; those above a share of a bucket are heavy.
SLOTS_PER_BUCKET = 32
LEAST_SLOTS = 2_048
HEAVY_SHARE = 0.125
SLOTS_HELD = 1 << 20

LEVEL = 3

PACKED = "bucket long, texts binary, counts binary, keys binary, starts binary, known binary"
SPANS = "_key binary, start int, stop int"
PLACE = np.dtype([("key", "S16"), ("start", "<i4"), ("stop", "<i4")])


class Step:
    """Words of some documents one after the other, cut into runs of windows that share a minimiser."""

    def __init__(self, texts: list[bytes], hashes: WordHashes, window: int, piece: int):
        words = [t.split() for t in texts]
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        flat = [w for own in words for w in own]
        del words
        self.window = window
        self.first = np.cumsum(sizes) - sizes
        self.owner_of_run = self.at = self.number = np.empty(0, dtype=np.int64)
        self.minimiser = np.empty(0, dtype=np.uint64)
        if len(flat) < window:
            return
        lengths = np.fromiter(map(len, flat), dtype=np.int64, count=len(flat))
        self.offset = np.concatenate([[0], np.cumsum(lengths + 1)])
        self.joined = b" ".join(flat)
        pieces = mixed(window_hashes(hashes.of(flat), piece))
        least = _sliding_least(pieces, window - piece + 1)
        # Windows that lie in one document, and the runs of them.
        count = np.maximum(sizes - window + 1, 0)
        place = ranges(self.first, count)
        if not len(place):
            return
        owner = np.repeat(np.arange(len(sizes)), count)
        value = least[place]
        new = np.ones(len(place), dtype=bool)
        new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
        head = np.flatnonzero(new)
        self.at, self.owner_of_run, self.minimiser = place[head], owner[head], value[head]
        self.number = np.diff(np.concatenate([head, [len(place)]]))

    def split(self, heavy: np.ndarray) -> None:
        """Cut the flagged runs into single windows, which go by a hash of all their words."""
        if not heavy.any():
            return
        rest = ~heavy
        at = ranges(self.at[heavy], self.number[heavy])
        own = np.repeat(self.owner_of_run[heavy], self.number[heavy])
        ends = self.offset[at + self.window] - 1
        whole = np.fromiter(
            (xxhash.xxh3_64_intdigest(self.joined[a:b]) for a, b in zip(self.offset[at].tolist(), ends.tolist(), strict=True)), np.uint64, len(at)
        )
        self.minimiser = np.concatenate([self.minimiser[rest], whole])
        self.number = np.concatenate([self.number[rest], np.ones(len(at), dtype=np.int64)])
        self.owner_of_run = np.concatenate([self.owner_of_run[rest], own])
        self.at = np.concatenate([self.at[rest], at])

    def distinct(self) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Different strings of the runs, the run each stands for, and for every run the number of its string."""
        if not len(self.at):
            return [], np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        ends = self.offset[self.at + self.number + self.window - 1] - 1
        seen: dict[bytes, int] = {}
        joined = self.joined
        spans = zip(self.offset[self.at].tolist(), ends.tolist(), strict=True)
        number = np.fromiter((seen.setdefault(joined[a:b], len(seen)) for a, b in spans), dtype=np.int64, count=len(self.at))
        _, stands = np.unique(number, return_index=True)
        return list(seen), stands, number


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` consecutive values."""
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if width > size else x


def _pack(batches: Iterable[pa.RecordBatch], buckets: int, slots: int, heavy: np.ndarray, window: int, piece: int):
    hashes, press = WordHashes(), zstandard.ZstdCompressor(level=LEVEL)
    for batch in steps(batches, limit=STEP):
        keys = np.array(batch.column("_key").to_pylist(), dtype="S16")
        step = Step(raw_texts(batch), hashes, window, piece)
        if len(heavy):
            step.split(np.isin(step.minimiser % np.uint64(slots), heavy))
        texts, stands, number = step.distinct()
        if not texts:
            continue
        copies = np.bincount(number)
        start = step.at - step.first[step.owner_of_run]
        # A string that the step holds twice is settled: its places are results, and it travels without a place.
        twice = np.flatnonzero(copies[number] > 1)
        known = np.empty(len(twice), dtype=PLACE)
        known["key"] = keys[step.owner_of_run[twice]]
        known["start"] = start[twice]
        known["stop"] = start[twice] + step.number[twice] + window - 1
        bucket = (mixed(step.minimiser[stands]) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
        rows: list[tuple] = []
        for row, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            part = order[a:b]
            run = stands[part]
            rows.append(
                (
                    int(bucket[part[0]]),
                    press.compress(b"\n".join([texts[k] for k in part])),
                    step.number[run].astype("<i4").tobytes(),
                    np.where(copies[part] > 1, np.bytes_(b""), keys[step.owner_of_run[run]]).astype("S16").tobytes(),
                    np.where(copies[part] > 1, -1, start[run]).astype("<i4").tobytes(),
                    # The settled places ride along, spread over the rows.
                    known[row :: len(cuts) - 1].tobytes(),
                )
            )
            if len(rows) == 64:
                yield _packed(rows)
                rows = []
        if rows:
            yield _packed(rows)


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), *[pa.binary()] * 5]
    names = ["bucket", "texts", "counts", "keys", "starts", "known"]
    return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _sizes(batches: Iterable[pa.RecordBatch], slots: int, window: int, piece: int) -> Iterator[pa.RecordBatch]:
    """Words of the distinct strings per slot of minimisers, added up per task."""
    hashes = WordHashes()
    slots_seen, words_seen = np.empty(0, dtype=np.uint64), np.empty(0)
    for batch in steps(batches, limit=STEP):
        step = Step(raw_texts(batch), hashes, window, piece)
        _, stands, _ = step.distinct()
        slot = np.concatenate([slots_seen, step.minimiser[stands] % np.uint64(slots)])
        words = np.concatenate([words_seen, step.number[stands] + window - 1])
        slots_seen, where = np.unique(slot, return_inverse=True)
        words_seen = np.bincount(where, words, minlength=len(slots_seen))
        if len(slots_seen) > SLOTS_HELD:
            yield _slot_rows(slots_seen, words_seen)
            slots_seen, words_seen = slots_seen[:0], words_seen[:0]
    yield _slot_rows(slots_seen, words_seen)


def _slot_rows(slots: np.ndarray, words: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int64)), pa.array(words.astype(np.int64))], ["slot", "words"])


def _count(rows: pa.Table, window: int) -> pa.Table:
    """Places of the repeated windows of one bucket."""
    unpress = zstandard.ZstdDecompressor()
    names: dict[bytes, int] = {}
    ids, counts, keys, starts = [], [], [], []
    places = [np.frombuffer(b, dtype=PLACE) for b in rows.column("known").to_pylist()]
    for text, n, key, start in zip(*[rows.column(c) for c in ("texts", "counts", "keys", "starts")], strict=True):
        words = unpress.decompress(text.as_py()).split()
        ids.append(np.fromiter((names.setdefault(w, len(names)) for w in words), dtype=np.int32, count=len(words)))
        counts.append(np.frombuffer(n.as_py(), dtype="<i4"))
        keys.append(np.frombuffer(key.as_py(), dtype="S16"))
        starts.append(np.frombuffer(start.as_py(), dtype="<i4"))
    del words, names
    word, number = np.concatenate(ids), np.concatenate(counts).astype(np.int64)
    key, start = np.concatenate(keys), np.concatenate(starts)
    size = number + window - 1
    text = np.repeat(np.arange(len(number)), number)
    at = ranges(np.cumsum(size) - size, number)
    repeated = _repeated(word, at, start[text] < 0, window)
    # Runs of repeated windows of the strings that have a place.
    chosen = np.flatnonzero(repeated & (start[text] >= 0))
    if len(chosen):
        head = np.flatnonzero(np.diff(chosen, prepend=-2) != 1)
        head = np.union1d(head, np.flatnonzero(np.diff(text[chosen], prepend=-1) != 0))
        run = np.diff(np.concatenate([head, [len(chosen)]]))
        own = text[chosen[head]]
        found = np.empty(len(head), dtype=PLACE)
        found["key"] = key[own]
        found["start"] = start[own] + (at[chosen[head]] - (np.cumsum(size) - size)[own])
        found["stop"] = found["start"] + run + window - 1
        places.append(found)
    every = np.concatenate(places)
    # Sixteen bytes as they are: a numpy string would lose zeros at its end.
    raw = every["key"].tobytes()
    full = pa.Array.from_buffers(pa.binary(16), len(every), [None, pa.py_buffer(raw)]).cast(pa.binary())
    return pa.table([full, pa.array(every["start"]), pa.array(every["stop"])], names=["_key", "start", "stop"])


def _repeated(word: np.ndarray, at: np.ndarray, twice: np.ndarray, window: int) -> np.ndarray:
    """Which of the windows (starting at ``at``) hold the same words as another, or stand for two themselves.

    Hashes bring equal windows together, the words decide.
    """
    value = window_hashes(mixed(word.astype(np.uint64) + np.uint64(1)), window)[at]
    order = np.argsort(value, kind="stable")
    out = twice.copy()
    same = value[order[1:]] == value[order[:-1]]
    pairs = np.flatnonzero(same)
    equal = np.ones(len(pairs), dtype=bool)
    for i in range(0, len(pairs), 1 << 18):
        a, b = at[order[pairs[i : i + (1 << 18)]]], at[order[pairs[i : i + (1 << 18)] + 1]]
        for j in range(window):
            equal[i : i + (1 << 18)] &= word[a + j] == word[b + j]
    # Two sequences with one hash: sort the windows of that hash by their words.
    for clash in np.unique(value[order[pairs[~equal]]]):
        members = np.flatnonzero(value == clash)
        _, where, n = np.unique(word[at[members][:, None] + np.arange(window)], axis=0, return_inverse=True, return_counts=True)
        weight = np.bincount(where.ravel(), 1 + twice[members])
        out[members] |= weight[where.ravel()] > 1
        equal &= value[order[pairs]] != clash
    pairs = pairs[equal]
    out[order[pairs]] = True
    out[order[pairs + 1]] = True
    return out


def repeated_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    piece: int = PIECE,
    bucket_words: int = BUCKET_WORDS,
) -> DataFrame:
    """Rows with ``n_words``, ``spans`` (word ranges that repeat, disjoint, stop excluded) and ``kept`` (the other words).

    Words are what stands between ASCII white space, unchanged. A window is ``window`` consecutive words of one
    document; the words of each window that also starts elsewhere, in any document, are a span. Kept words are joined
    by one space.

    A first pass measures how many words the minimisers bring. Those that would fill a good part of a bucket, say of a
    passage in a third of all documents with small changes, are heavy: their windows travel singly, by a hash of all
    their words. Equal strings of a step of the map side travel once, so a passage that is everywhere costs one string
    per step. The list of heavy slots has at most one entry per HEAVY_SHARE of a bucket.

    A null text has no words; a null id is an id; rows that repeat an id and a text count as two occurrences, and both
    lose their words; ties need no rule, as every occurrence goes; an empty table gives no rows. Other columns are
    ignored.
    """
    spark = docs.sparkSession
    rows = two_columns(docs, id_col, text_col)
    key = F.unhex(F.md5(F.concat_ws("\0", F.coalesce(F.col("_id").cast("string"), F.lit("\1")), F.coalesce("_text", F.lit("")))))
    keyed = rows.select("*", key.alias("_key"))
    texts = rows.where(F.octet_length("_text") > 0)

    volume = texts.select(F.sum(F.octet_length("_text"))).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A super-k-mer string holds a word about three times, a word has about six bytes.
    buckets = max(4 * partitions, volume // (2 * bucket_words) + 1)
    slots = max(LEAST_SLOTS, SLOTS_PER_BUCKET * (volume // (2 * bucket_words) + 1))
    sizes = texts.select("_text").mapInArrow(lambda b: _sizes(b, slots, window, piece), "slot long, words long")
    heavy = sizes.groupBy("slot").agg(F.sum("words").alias("words")).where(F.col("words") > HEAVY_SHARE * bucket_words)
    flagged = spark.sparkContext.broadcast(np.sort(np.array([r["slot"] for r in heavy.collect()], dtype=np.uint64)))

    packed = keyed.where(F.octet_length("_text") > 0).select("_key", "_text").mapInArrow(
        lambda b: _pack(b, buckets, slots, flagged.value, window, piece), PACKED
    )
    spans = packed.groupBy("bucket").applyInArrow(lambda t: _count(t, window), SPANS)
    by_row = spans.groupBy("_key").agg(F.collect_set(F.struct("start", "stop")).alias("_spans"))
    joined = keyed.join(by_row.withColumnRenamed("_key", "_k"), F.col("_key") == F.col("_k"), "left")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            kept, numbers, merged = [], [], []
            for text, found in zip(raw_texts(batch), batch.column("_spans"), strict=True):
                words = text.split()
                numbers.append(len(words))
                spans = _merged(found)
                merged.append(spans)
                left = words
                if len(spans):
                    edges = [0, *spans.ravel().tolist(), len(words)]
                    left = [w for a, b in zip(edges[::2], edges[1::2], strict=True) for w in words[a:b]]
                kept.append(b" ".join(left))
            cuts = np.concatenate([[0], np.cumsum([len(m) for m in merged])]).astype(np.int32)
            flat = np.concatenate(merged).astype(np.int32)
            lists = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["start", "stop"])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    pa.array(numbers, type=pa.int64()),
                    pa.ListArray.from_arrays(pa.array(cuts), lists),
                    pa.array(kept, type=pa.binary()).cast(pa.string()),
                ],
                ["_id", "n_words", "spans", "kept"],
            )

    kind = rows.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, n_words long, spans array<struct<start:int,stop:int>>, kept string"
    out = joined.select("_id", "_text", "_spans").mapInArrow(cut, schema)
    return out.select(F.col("_id").alias(id_col), "n_words", "spans", "kept")


def _merged(found: pa.Scalar) -> np.ndarray:
    """Spans in order, those that meet or overlap put together."""
    if not found.is_valid or not len(found):
        return np.empty((0, 2), dtype=np.int64)
    start, stop = (pc.struct_field(found.values, [k]).to_numpy(zero_copy_only=False) for k in (0, 1))
    order = np.argsort(start, kind="stable")
    start, stop = start[order], np.maximum.accumulate(stop[order])
    new = np.concatenate([[True], start[1:] > stop[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(start) - 1]])
    return np.stack([start[new], stop[last]], axis=1)
