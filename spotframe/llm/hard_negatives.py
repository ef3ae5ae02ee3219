"""Hard negatives for anchors by a vertical scan with branch and bound over dimensions.

Rows are dealt to blocks that hold them by dimension, with the least and the largest value of each. An anchor reads the
dimensions in the order of its own falling magnitudes. After some of them a row's score lies between its partial sum plus the least
and plus the largest that the others can add; rows whose interval can't matter leave the candidates, until what is left
has exact scores. The first scan finds each anchor's positives, the second one the negatives in the windows below them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.storage import stable

POSITIVES = 5
NEGATIVES = 5
# A negative scores from LOW percent of the positive's score up to all of it.
LOW = 80
SCALE = 256
# Rows and anchors that meet in one step; a step holds both as integers.
BLOCK_ROWS = 2_048
BLOCK_ANCHORS = 4_096
# Dimensions read between two looks at the bounds.
STRIDE = 8
# Components and sums below these are exact in the arithmetic used.
LARGEST = float(1 << 26)
EXACT = 1 << 53

KEY = ["_block", "_chunk"]


def quantised(rows: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """(_id, _label, _v) with components floor(SCALE x); rows with a null label or vector or a null or non-finite component go."""
    x = F.col(vector_col).cast("array<double>")
    usable = x.isNotNull() & label.isNotNull()
    usable &= ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    kept = rows.where(F.coalesce(usable, F.lit(False)))
    fits = F.when(F.exists(x, lambda v: F.abs(v) * SCALE > LARGEST), F.raise_error(F.lit("a component is too large")))
    whole = F.transform(x, lambda v: F.floor(v * float(SCALE)).cast("long"))
    return kept.select(F.col(id_col).alias("_id"), label.cast("long").alias("_label"), F.coalesce(fits.cast("array<bigint>"), whole).alias("_v"))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as the columns of a matrix, a row per dimension; shorter ones end in zeros."""
    lists = column.combine_chunks()
    sizes = lists.value_lengths().to_numpy()
    out = np.zeros((width, len(sizes)), dtype=np.float64)
    ends = np.cumsum(sizes)
    place = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - sizes, sizes)
    out[place, np.repeat(np.arange(len(sizes)), sizes)] = lists.flatten().to_numpy()
    return out


class _Rows:
    """A block of rows by dimension, sorted by label and id."""

    def __init__(self, table: pa.Table, width: int):
        ids, label = table["_id"].to_numpy(), table["_label"].to_numpy()
        order = np.lexsort((ids, label))
        self.ids, self.label = ids[order], label[order]
        self.x = np.ascontiguousarray(_matrix(table["_v"], width)[:, order])
        # Fast arithmetic where its sums are exact, else whole numbers.
        self.kind = np.float64 if float(np.abs(self.x).max(initial=0.0)) * width < EXACT / LARGEST else np.int64
        self.x = self.x.astype(self.kind, copy=False)
        self.low, self.high = self.x.min(axis=1), self.x.max(axis=1)

    def scan(self, anchor: np.ndarray, rows: np.ndarray, drop: Callable) -> tuple[np.ndarray, np.ndarray]:
        """Rows left and their scores. ``drop`` says of partial sums with their bounds which rows still count."""
        order = np.argsort(-np.abs(anchor), kind="stable")
        anchor = anchor.astype(self.kind)
        ends = anchor * self.low, anchor * self.high
        most, least = np.maximum(*ends)[order], np.minimum(*ends)[order]
        # What the dimensions from a place on can add.
        most, least = (np.append(np.cumsum(v[::-1])[::-1], self.kind(0)) for v in (most, least))
        sums = np.zeros(len(rows), dtype=self.x.dtype)
        whole = len(rows) == len(self.ids)
        for at in range(0, len(order), STRIDE):
            dims = order[at : at + STRIDE]
            part = self.x[dims] if whole else self.x[np.ix_(dims, rows)]
            sums = sums + anchor[dims] @ part
            done = min(at + STRIDE, len(order))
            keep = drop(sums + least[done], sums + most[done])
            if not keep.all():
                rows, sums, whole = rows[keep], sums[keep], False
            if not len(rows):
                break
        return rows, sums.astype(np.int64)


def _at_least(values: np.ndarray, k: int) -> float:
    """The k-th largest value, or less than all if there are fewer."""
    return -np.inf if len(values) < k else np.partition(values, len(values) - k)[len(values) - k]


def _positives(rows: _Rows, anchor: np.ndarray, label: int, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best other rows of the label in the block."""
    same = np.arange(*np.searchsorted(rows.label, [label, label + 1]))
    same = same[rows.ids[same] != own]
    found, score = rows.scan(anchor, same, lambda low, high: high >= _at_least(low, k))
    best = np.lexsort((rows.ids[found], -score))[:k]
    return rows.ids[found[best]], score[best]


def _windows(rows: _Rows, anchor: np.ndarray, label: int, tops: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each score in ``tops`` the ids and scores of the k best rows of other labels in the block from LOW percent of it up to it."""
    first, last = np.searchsorted(rows.label, [label, label + 1])
    others = np.concatenate([np.arange(first), np.arange(last, len(rows.ids))])
    floors = -(-LOW * tops // 100)

    def drop(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        keep = np.zeros(len(low), dtype=bool)
        for bottom, top in zip(floors, tops, strict=True):
            sure = low[(low >= bottom) & (high <= top)]
            keep |= (low <= top) & (high >= max(bottom, _at_least(sure, k)))
        return keep

    found, score = rows.scan(anchor, others, drop)
    out = []
    for bottom, top in zip(floors, tops, strict=True):
        inside = np.flatnonzero((score >= bottom) & (score <= top))
        best = inside[np.lexsort((rows.ids[found[inside]], -score[inside]))[:k]]
        out.append((rows.ids[found[best]], score[best]))
    return out


def _meet(rows: DataFrame, anchors: DataFrame, n_blocks: int, n_chunks: int, run: Callable, schema: str) -> DataFrame:
    """Every block of rows with every chunk of anchors, by an equi-join on both numbers."""
    left = rows.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))))
    right = anchors.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    left, right = (df.toDF(*df.columns) for df in (left, right))
    return left.groupBy(*KEY).cogroup(right.groupBy(*KEY)).applyInArrow(run, schema)


def _pairs(rows: pa.Table, anchors: pa.Table) -> Iterator[tuple[_Rows, dict, np.ndarray]]:
    """The block with each anchor and its vector."""
    if not rows.num_rows or not anchors.num_rows:
        return
    width = max(max(t["_v"].combine_chunks().value_lengths().to_numpy()) for t in (rows, anchors))
    block, vectors = _Rows(rows, width), _matrix(anchors["_v"], width)
    for k, anchor in enumerate(anchors.drop_columns(["_v"]).to_pylist()):
        yield block, anchor, np.ascontiguousarray(vectors[:, k])


def _table(rows: list[tuple], **kinds: pa.DataType) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[] for _ in kinds]
    return pa.table({n: pa.array(np.asarray(c), t) for (n, t), c in zip(kinds.items(), columns, strict=True)})


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    n_positives: int = POSITIVES,
    n_negatives: int = NEGATIVES,
    block_rows: int = BLOCK_ROWS,
    block_anchors: int = BLOCK_ANCHORS,
) -> DataFrame:
    """Negatives per anchor and positive: (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A score is the inner product of components floor(256 x). An anchor's positives are the ``n_positives`` rows of its label with
    the highest scores, its negatives for each of them the ``n_negatives`` highest rows of other labels from 80 % of the positive's
    score up to it; equal scores come by ascending id. Ids and labels are whole numbers. All rows meet all anchors, in
    blocks of bounded size, and only the best of a block leave it.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part. Rows that repeat another row count as
    rows of their own, but an anchor that repeats another one entirely counts once, and rows with an anchor's id are never its positives. A
    shorter vector counts as if it ended in zeros. An empty table or one without anchors gives no rows; other columns are
    ignored. Components beyond 2^18 raise an error, as scores would not be exact.
    """
    label = F.col("label") if label is None else label
    usable = rows.where(F.col(id_col).isNotNull())
    flagged = usable.select(
        F.col(id_col).cast("long").alias("_i"), F.col(vector_col).alias("_x"), label.alias("_l"), F.coalesce(is_anchor, F.lit(False)).alias("_a")
    )
    every = stable(quantised(flagged.where("NOT _a"), "_i", "_x", F.col("_l")).withColumn("_a", F.lit(False)).unionByName(
        quantised(flagged.where("_a"), "_i", "_x", F.col("_l")).withColumn("_a", F.lit(True))
    ))
    number = F.xxhash64("_id", "_label", "_v")
    anchors = stable(every.where("_a").select("_id", "_label", "_v").distinct().withColumn("_key", number))
    size, asked = every.count(), anchors.count()
    n_blocks, n_chunks = max(-(-size // block_rows), 1), max(-(-asked // block_anchors), 1)
    blocks = every.select("_id", "_label", "_v", F.pmod(F.xxhash64("_v", "_id"), F.lit(n_blocks)).cast("int").alias("_block"))
    chunked = anchors.withColumn("_chunk", F.pmod("_key", F.lit(n_chunks)).cast("int"))

    def first(table: pa.Table, asking: pa.Table) -> pa.Table:
        out = []
        for block, a, vector in _pairs(table, asking):
            ids, scores = _positives(block, vector, a["_label"], a["_id"], n_positives)
            out += [(a["_id"], a["_key"], int(i), int(s)) for i, s in zip(ids, scores, strict=True)]
        return _table(out, _id=pa.int64(), _key=pa.int64(), _other=pa.int64(), _score=pa.int64())

    columns = "_id long, _key long, _other long, _score long"
    found = _meet(blocks, chunked, n_blocks, n_chunks, first, columns)
    best = Window.partitionBy("_id", "_key").orderBy(F.col("_score").desc(), "_other")
    positives = stable(found.withColumn("_place", F.row_number().over(best)).where(F.col("_place") <= n_positives))
    asks = positives.groupBy("_id", "_key").agg(F.sort_array(F.collect_list(F.struct("_place", "_score"))).alias("_tops"))
    asks = chunked.join(asks.withColumn("_tops", F.col("_tops._score")), ["_id", "_key"])

    def second(table: pa.Table, asking: pa.Table) -> pa.Table:
        out = []
        for block, a, vector in _pairs(table, asking):
            for place, (ids, scores) in enumerate(_windows(block, vector, a["_label"], np.array(a["_tops"]), n_negatives), 1):
                out += [(a["_id"], a["_key"], place, int(i), int(s)) for i, s in zip(ids, scores, strict=True)]
        return _table(out, _id=pa.int64(), _key=pa.int64(), _place=pa.int32(), _negative=pa.int64(), _lower=pa.int64())

    columns = "_id long, _key long, _place int, _negative long, _lower long"
    negatives = _meet(blocks, asks, n_blocks, n_chunks, second, columns)
    best = Window.partitionBy("_id", "_key", "_place").orderBy(F.col("_lower").desc(), "_negative")
    ranked = negatives.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n_negatives)
    return ranked.join(positives, ["_id", "_key", "_place"]).select(
        F.col("_id").alias("anchor_id"),
        F.col("_other").alias("positive_id"),
        "rank",
        F.col("_negative").alias("negative_id"),
        F.col("_score").alias("positive_score"),
        F.col("_lower").alias("negative_score"),
    )
