"""Library-size normalisation, log transform and value statistics."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import SPOT, exact_quantiles
from ..functions.storage import stable
from .qc import spot_totals

TARGET_SUM = 1e4
MAX_FRACTION = 0.05


def keep_raw(counts: DataFrame, column: str = "x_raw") -> DataFrame:
    """Snapshot of the current values beside the working ones."""
    return counts.withColumn(column, F.col("x"))


def dominating_genes(counts: DataFrame, max_fraction: float = MAX_FRACTION) -> DataFrame:
    """(sample_id, var_id) of genes that hold more than ``max_fraction`` of some spot's total."""
    spot = Window.partitionBy(*SPOT)
    share = counts.withColumn("_total", F.sum("x").over(spot))
    return share.where(F.col("x") > F.lit(max_fraction) * F.col("_total")).select("sample_id", "var_id").distinct()


def normalize_total(
    counts: DataFrame,
    target_sum: float | None = TARGET_SUM,
    exclude_highly_expressed: bool = True,
    max_fraction: float = MAX_FRACTION,
) -> DataFrame:
    """Scale every spot to ``target_sum`` (None: the sample's median size).

    With exclusion the size leaves out genes that dominate any spot of the sample, yet all genes are
    scaled. The size is a window over the spot, which holds one row per gene, so the counts are shuffled once.
    """
    columns = counts.columns
    sized = F.col("x")
    rows = counts
    if exclude_highly_expressed:
        genes = stable(dominating_genes(counts, max_fraction).withColumn("_dominates", F.lit(True)))
        rows = counts.join(genes, ["sample_id", "var_id"], "left")
        sized = F.when(F.col("_dominates").isNull(), F.col("x")).otherwise(F.lit(0.0))
    rows = rows.withColumn("_size", F.sum(sized).over(Window.partitionBy(*SPOT)))
    if target_sum is None:
        sizes = rows.groupBy(*SPOT).agg(F.max("_size").alias("_size")).where(F.col("_size") > 0)
        rows = rows.join(exact_quantiles(sizes, ["sample_id"], "_size", {"_target": 0.5}), "sample_id", "left")
        target = F.col("_target")
    else:
        target = F.lit(float(target_sum))
    scale = F.when(F.col("_size") == 0, F.lit(1.0)).otherwise(F.col("_size") / target)
    return rows.withColumn("x", F.col("x") / scale).select(*columns)


def total_stats(obs: DataFrame, counts: DataFrame, by: Sequence[str] = ("sample_id",)) -> DataFrame:
    """Mean, population std, min and max of the spot totals."""
    return spot_totals(obs, counts).groupBy(*by).agg(
        F.avg("total_counts").alias("mean"),
        F.stddev_pop("total_counts").alias("std"),
        F.min("total_counts").alias("min"),
        F.max("total_counts").alias("max"),
    )


def log1p(counts: DataFrame, base: float | None = None, column: str = "x") -> DataFrame:
    """ln(1 + x), or in the given base; zeros stay implicit."""
    logged = F.log1p(column)
    if base is not None:
        logged = logged / F.lit(math.log(base))
    return counts.withColumn(column, logged)


def value_stats(counts: DataFrame, by: Sequence[str] = ("sample_id",)) -> DataFrame:
    """Smallest non-zero value, min, max, mean over non-zero and over stored values."""
    nonzero = F.when(F.col("x") != 0, F.col("x"))
    return counts.groupBy(*by).agg(
        F.min(nonzero).alias("min_nonzero"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
        F.avg(nonzero).alias("mean_nonzero"),
        F.avg("x").alias("mean"),
    )


def log_layer(counts: DataFrame) -> DataFrame:
    """Plain normalisation to 10,000 followed by log1p."""
    return log1p(normalize_total(counts, exclude_highly_expressed=False))
