"""Per-spot vectors: dense ones over a bounded gene selection, sparse ones over any."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..functions.numeric import SPOT
from ..functions.storage import stable

MAX_DENSE_GENES = 20_000
# Tasks a core that fill in zeros.
SPREAD = 4


def gene_index(genes: DataFrame, limit: int = MAX_DENSE_GENES) -> DataFrame:
    """(var_id, pos) with dense positions in ``var_id`` order for a selection of at most ``limit`` genes.

    Dense vectors only make sense for a selection such as variable genes or a panel; a larger one is refused.
    """
    ids = stable(genes.select("var_id").distinct())
    n = ids.count()
    if n > limit:
        raise ValueError(f"{n} genes selected for dense vectors, the limit is {limit}: select genes first")
    return gene_positions(ids)


def gene_positions(genes: DataFrame) -> DataFrame:
    """(var_id, pos) with positions from 0 in ``var_id`` order for any part of the gene list."""
    ids = genes.select("var_id").distinct()
    return ids.select("var_id", (F.row_number().over(Window.orderBy("var_id")) - 1).alias("pos"))


def sparse_spots(
    counts: DataFrame, obs: DataFrame, index: DataFrame, value: str = "x", unique: bool = False
) -> DataFrame:
    """One row per spot with its stored values as a sparse ``features`` vector over ``index`` positions.

    With ``unique`` a position that a spot has twice is taken once, as in a dense row.
    ``obs`` keeps its other columns. Only non-zeros are packed, so the width of the vectors costs nothing; the table is
    written in the storage form of a vector and read back as one, without Python in between.
    """
    cell = F.struct(F.col("pos").cast("int").alias("pos"), F.col(value).cast("double").alias("v"))
    packed = (
        counts.where(F.col(value) != 0)
        .join(index, "var_id")
        .groupBy(*SPOT)
        .agg(F.array_sort(F.collect_list(cell)).alias("_cells"))
    )
    if unique:
        last = lambda c, i: (i + 1 == F.size("_cells")) | (F.get("_cells", i + 1)["pos"] != c["pos"])
        packed = packed.withColumn("_cells", F.filter("_cells", last))
    cells = F.coalesce("_cells", F.array().cast("array<struct<pos:int,v:double>>"))
    features = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        index.agg(F.count(F.lit(1)).cast("int")).scalar().alias("size"),
        cells["pos"].alias("indices"),
        cells["v"].alias("values"),
    )
    kept = [c for c in obs.columns if c != "features"]
    written = stable(obs.select(*kept).join(packed, SPOT, "left").select(*kept, features.alias("features")))
    schema = StructType([f for f in written.schema if f.name != "features"] + [StructField("features", VectorUDT())])
    out = counts.sparkSession.read.schema(schema).parquet(written._written)
    out._written = written._written
    return out


def stored_cells(vectors: DataFrame) -> DataFrame:
    """The table of ``sparse_spots`` with arrays ``pos`` and ``x`` in place of the vectors."""
    plain = vectors.sparkSession.read.parquet(vectors._written)
    kept = [c for c in plain.columns if c != "features"]
    return plain.select(*kept, F.col("features.indices").alias("pos"), F.col("features.values").alias("x"))


def dense_spots(
    counts: DataFrame,
    obs: DataFrame,
    index: DataFrame,
    value: str = "x",
    change: Callable[[np.ndarray], np.ndarray] | None = None,
) -> DataFrame:
    """One row per spot with ``values array<double>`` over ``index`` positions, zeros filled in.

    ``change`` is applied to the filled rows of a batch (spots x positions) where they are made.

    The non-zeros of a spot are packed first (at most one entry per selected gene), so only packed rows
    are shuffled and the zero grid never exists as rows. Packed rows are small and would be coalesced into a few tasks, so
    they are spread again before the zeros widen them.
    """
    width = index.count()
    spread = SPREAD * counts.sparkSession.sparkContext.defaultParallelism
    packed = (
        counts.join(F.broadcast(index), "var_id")
        .groupBy(*SPOT)
        .agg(F.collect_list(F.struct("pos", F.col(value).alias("v"))).alias("_cells"))
    )

    @F.pandas_udf("array<double>")
    def fill(pos: pd.Series, val: pd.Series) -> pd.Series:
        out = np.zeros((len(pos), width))
        for i, (p, v) in enumerate(zip(pos, val)):
            if p is not None:
                out[i, np.asarray(p, dtype=np.int64)] = v
        return pd.Series(list(change(out) if change else out))

    # By a hash of the keys: the join may have as many partitions by the keys themselves, and those would be coalesced.
    spots = obs.select(*SPOT).join(packed, SPOT, "left").repartition(spread, F.xxhash64(*SPOT))
    # Otherwise an explode of the values would infer a filter on them, which fills every spot twice, the first time before the spread.
    once = fill.asNondeterministic()
    return spots.select(*SPOT, once(F.col("_cells.pos"), F.col("_cells.v")).alias("values"))
