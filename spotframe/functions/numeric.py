"""Numeric helpers shared by the operators: guarded division, zero-aware statistics, exact quantiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import stable

SPOT = ["sample_id", "obs_id"]


def ratio(num: Column, den: Column) -> Column:
    """num / den, NULL where den is 0 (ANSI mode would raise)."""
    return F.try_divide(num, den)


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation as an aggregate, NULL when either side is constant."""
    return ratio(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2))


def with_group_size(df: DataFrame, obs: DataFrame, by: Sequence[str], name: str = "n_spots") -> DataFrame:
    """Attach the number of spots of the group (all spots when ``by`` is empty), counted on ``obs``."""
    by = list(by)
    if not by:
        return df.withColumn(name, obs.agg(F.count(F.lit(1))).scalar())
    return df.join(obs.groupBy(*by).agg(F.count(F.lit(1)).alias(name)), by)


def gene_stats(
    counts: DataFrame, obs: DataFrame, by: Sequence[str] = (), value: Column | str = "x", key: str = "var_id"
) -> DataFrame:
    """Zero-aware statistics of each stored gene over all spots of the group.

    One partial aggregation over the non-zeros; the missing cells are added back in closed form.
    """
    by = list(by)
    x = F.col(value) if isinstance(value, str) else value
    agg = (
        counts.select(*by, key, x.alias("_x"))
        .groupBy(*by, key)
        .agg(
            F.count("_x").alias("nnz"),
            F.sum("_x").alias("total"),
            F.sum(F.col("_x") * F.col("_x")).alias("sumsq"),
            F.min("_x").alias("_min"),
            F.max("_x").alias("_max"),
        )
    )
    n, total, sumsq = F.col("n_spots"), F.col("total"), F.col("sumsq")
    ss = F.greatest(sumsq - total * total / n, F.lit(0.0))
    full = F.col("nnz") == n
    return with_group_size(agg, obs, by).select(
        *by,
        key,
        "n_spots",
        "nnz",
        "total",
        "sumsq",
        (total / n).alias("mean"),
        ratio(ss, n - 1).alias("var_samp"),
        (ss / n).alias("var_pop"),
        F.when(full, F.col("_min")).otherwise(F.least("_min", F.lit(0.0))).alias("min"),
        F.when(full, F.col("_max")).otherwise(F.greatest("_max", F.lit(0.0))).alias("max"),
    )


def ordered_value_counts(
    df: DataFrame, by: Sequence[str], value: str, extra: Sequence[Column] = (), weight: str | None = None
) -> DataFrame:
    """Distinct values of each group in order, with frequency ``n``, ``n_below`` and ``n_total``.

    Repeated values collapse in a partial aggregation; the distinct values are then range-partitioned by
    (group, value), so a group of any size is spread over many tasks, and only per-partition totals are
    accumulated. The partition ids are frozen by a written table. ``weight`` is the multiplicity of a row,
    ``extra`` are further aggregates kept per distinct value.
    """
    by = list(by)
    size = F.sum(weight) if weight else F.count(F.lit(1))
    distinct = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(size.alias("n"), *extra)
    parts = stable(distinct.repartitionByRange(*by, value).withColumn("_part", F.spark_partition_id()))
    totals = parts.groupBy(*by, "_part").agg(F.sum("n").alias("_part_n"))
    group = Window.partitionBy(*by)
    before = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by,
        "_part",
        F.coalesce(F.sum("_part_n").over(before), F.lit(0)).alias("_offset"),
        F.sum("_part_n").over(group).alias("n_total"),
    )
    inside = Window.partitionBy(*by, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    kept = [c for c in distinct.columns if c not in by and c not in (value, "n")]
    # The running count comes before the join, which then finds its rows sorted: they are held by one sort, not by two.
    running = parts.withColumn("_below", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return running.join(offsets, [*by, "_part"]).select(
        *by, value, "n", (F.col("_offset") + F.col("_below")).alias("n_below"), "n_total", *kept
    )


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact, linearly interpolated quantiles per group; no group is ever gathered in one task."""
    by = list(by)
    counted = ordered_value_counts(df, by, value)
    aggs = []
    for name, p in probs.items():
        pos = F.lit(float(p)) * (F.col("n_total") - 1)
        for edge, at in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            hit = (F.col("n_below") <= at) & (at < F.col("n_below") + F.col("n"))
            aggs.append(F.max(F.when(hit, F.col(value))).alias(f"_{name}_{edge}"))
    found = counted.groupBy(*by).agg(F.max("n_total").alias("_n"), *aggs)
    out = []
    for name, p in probs.items():
        pos = F.lit(float(p)) * (F.col("_n") - 1)
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        out.append((lo + (hi - lo) * (pos - F.floor(pos))).alias(name))
    return stable(found.select(*by, *out))


def unpivot(df: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Long form (ids, metric, value) of numeric columns."""
    return df.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        list(ids), list(metrics), "metric", "value"
    )
