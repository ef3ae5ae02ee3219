"""Descriptive statistics, outlier rules and gene correlation."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import SPOT, exact_quantiles, gene_stats, ordered_value_counts, ratio
from ..functions.storage import stable
from .dense import gene_positions
from .permuted import places

OUTLIER_METHODS = ("iqr", "zscore", "mad")
# A block of values is a matrix of spots by genes; a product is one of genes by genes.
GENES = 512
SPOTS = 2_048
RUN = 64


def basic_stats(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Mean, median, population std, min, max, quartiles, IQR and CV (0 unless the mean is positive)."""
    by = list(by)
    moments = df.groupBy(*by).agg(
        F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max")
    )
    quartiles = exact_quantiles(df, by, value, {"q25": 0.25, "median": 0.5, "q75": 0.75})
    cv = F.when(F.col("mean") > 0, F.col("std") / F.col("mean")).otherwise(F.lit(0.0))
    return moments.join(quartiles, by).withColumns({"iqr": F.col("q75") - F.col("q25"), "cv": cv})


def outliers(
    df: DataFrame, value: str, by: Sequence[str], method: str = "iqr", threshold: float = 1.5
) -> DataFrame:
    """Add ``is_outlier`` by the ``iqr``, ``zscore`` or ``mad`` rule within each group."""
    by, x = list(by), F.col(value)
    if method == "iqr":
        limits = exact_quantiles(df, by, value, {"_q25": 0.25, "_q75": 0.75})
        width = F.lit(threshold) * (F.col("_q75") - F.col("_q25"))
        flag = (x < F.col("_q25") - width) | (x > F.col("_q75") + width)
    elif method == "zscore":
        limits = stable(df.groupBy(*by).agg(F.avg(value).alias("_mean"), F.stddev_pop(value).alias("_std")))
        flag = F.abs(ratio(x - F.col("_mean"), F.col("_std"))) > threshold
    elif method == "mad":
        medians = exact_quantiles(df, by, value, {"_median": 0.5})
        deviations = df.join(medians, by).select(*by, F.abs(x - F.col("_median")).alias("_dev"))
        limits = medians.join(exact_quantiles(deviations, by, "_dev", {"_mad": 0.5}), by)
        flag = F.abs(ratio(F.lit(0.6745) * (x - F.col("_median")), F.col("_mad"))) > threshold
    else:
        raise ValueError(f"unknown outlier method {method!r}; use one of {OUTLIER_METHODS}")
    return df.join(limits, by).select(*df.columns, F.coalesce(flag, F.lit(False)).alias("is_outlier"))


def average_ranks(counts: DataFrame, obs: DataFrame, value: str = "x") -> DataFrame:
    """Average rank of every stored value within its gene over all spots, implicit zeros included.

    Adds ``rank`` to the counts; the rank shared by a gene's missing cells is ``zero_rank``.
    """
    stored = counts.where(F.col(value) != 0)
    zeros = stored.groupBy("var_id").agg(
        F.count(F.lit(1)).alias("_nnz"), F.count_if(F.col(value) < 0).alias("_n_negative")
    )
    distinct = ordered_value_counts(stored, ["var_id"], value)
    n_spots = obs.agg(F.count(F.lit(1))).scalar()
    z = n_spots - F.col("_nnz")
    placed = distinct.join(zeros, "var_id").select(
        "var_id",
        value,
        (
            F.col("n_below")
            + F.when(F.col(value) > 0, z).otherwise(F.lit(0))
            + (F.col("n") + 1).cast("double") / F.lit(2.0)
        ).alias("rank"),
        F.when(z > 0, F.col("_n_negative") + (z + 1).cast("double") / F.lit(2.0))
        .otherwise(F.lit(0.0))
        .alias("zero_rank"),
    )
    return stored.join(placed, ["var_id", value])


def gene_correlation(
    counts: DataFrame, obs: DataFrame, genes: DataFrame, method: str = "pearson", value: str = "x"
) -> DataFrame:
    """Correlation of every pair of the chosen genes over all spots, as (var_a, var_b, corr).

    Any number of genes may be chosen; the products come from blocks of genes (see ``gram``). NULL where a gene is
    constant or there are no spots.
    """
    if method not in ("pearson", "spearman"):
        raise ValueError(f"unknown correlation method {method!r}")
    index = stable(gene_positions(genes))
    picked = counts.join(index.select("var_id"), "var_id", "left_semi").join(obs.select(*SPOT), SPOT, "left_semi")
    column = value
    if method == "spearman":
        ranked = average_ranks(picked, obs, value)
        # Ranks are shifted so that the missing cells stay at 0; a shift does not change a correlation.
        picked, column = ranked.withColumn("_shifted", F.col("rank") - F.col("zero_rank")), "_shifted"
    cells = stable(picked.join(index, "var_id").select(*SPOT, "pos", F.col(column).cast("double").alias("x")))
    x, n = F.col("x"), obs.agg(F.count(F.lit(1))).scalar()
    sums = cells.groupBy("pos").agg(F.sum(x).alias("s"), F.sum(x * x).alias("q"))
    side = stable(index.join(sums, "pos", "left").fillna(0.0, ["s", "q"]))
    pairs = gram(cells, places(obs), index.count())
    # Products are there for one order of a pair; the other has the same.
    both = F.explode(F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j"))).otherwise(
        F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j")))
    ))
    joined = (
        pairs.select(both.alias("_p"), "sxy")
        .select(F.col("_p.i").alias("i"), F.col("_p.j").alias("j"), "sxy")
        .join(side.toDF("i", "var_a", "sx", "sxx"), "i")
        .join(side.toDF("j", "var_b", "sy", "syy"), "j")
    )
    cov = F.col("sxy") - ratio(F.col("sx") * F.col("sy"), n)
    vx = F.greatest(F.col("sxx") - ratio(F.col("sx") * F.col("sx"), n), F.lit(0.0))
    vy = F.greatest(F.col("syy") - ratio(F.col("sy") * F.col("sy"), n), F.lit(0.0))
    return joined.select("var_a", "var_b", ratio(cov, F.sqrt(vx) * F.sqrt(vy)).alias("corr"))


def gram(cells: DataFrame, place: DataFrame, width: int, genes: int = GENES, spots: int = SPOTS, run: int = RUN) -> DataFrame:
    """Sums of products over all spots of every pair of gene positions i and j: (i, j, sxy), once per unordered pair.

    Values are packed by block of ``spots`` places and ``genes`` positions; blocks i and j of the same spots meet by an
    equi-join, and a task adds up the small products of about ``run`` spot blocks before it hands them on. No task holds
    more than one product of two blocks of genes. ``cells`` has (sample_id, obs_id, pos, x) and ``place`` numbers the
    spots of a sample; all ``width`` positions take part, stored or not.
    """
    blocks = -(-width // genes)
    spark = cells.sparkSession
    at, pos = F.col("at"), F.col("pos")
    cell = F.struct((at % spots).cast("int").alias("at"), (pos % genes).cast("int").alias("slot"), "x")
    packed = (
        cells.join(place, SPOT)
        .groupBy("sample_id", F.floor(at / spots).alias("spots"), F.floor(pos / genes).alias("block"))
        .agg(F.collect_list(cell).alias("c"))
        .select("sample_id", "spots", "block", *[F.col(f"c.{f}").alias(f) for f in ("at", "slot", "x")])
    )
    # An empty block of spots brings every pair of gene blocks up once, so pairs without a common spot are there too.
    empty = spark.range(blocks).select(
        F.lit("").alias("sample_id"),
        F.lit(-1).cast("long").alias("spots"),
        F.col("id").alias("block"),
        F.array().cast("array<int>").alias("at"),
        F.array().cast("array<int>").alias("slot"),
        F.array().cast("array<double>").alias("x"),
    )
    packed = stable(packed.unionByName(empty))
    runs = max(1, -(-packed.select("sample_id", "spots").distinct().count() // run))
    key = ["sample_id", "spots"]
    left = packed.select(
        *key, F.col("block").alias("i"), F.explode(F.sequence(F.col("block"), F.lit(blocks - 1))).alias("j"),
        *[F.col(f).alias(f"a_{f}") for f in ("at", "slot", "x")],
    )
    right = packed.select(
        *key, F.explode(F.sequence(F.lit(0).cast("long"), F.col("block"))).alias("i"), F.col("block").alias("j"),
        *[F.col(f).alias(f"b_{f}") for f in ("at", "slot", "x")],
    )
    task = ["i", "j", "run"]
    met = left.join(right, [*key, "i", "j"]).withColumn("run", F.pmod(F.xxhash64(*key), F.lit(runs)))
    met = met.repartition(*task).sortWithinPartitions(*task).drop(*key)

    def dense(at_, slot, x) -> np.ndarray:
        out = np.zeros((spots, genes))
        out[at_, slot] = x
        return out

    def rows(i: int, j: int, total: np.ndarray) -> pd.DataFrame:
        a, b = np.meshgrid(i * genes + np.arange(genes), j * genes + np.arange(genes), indexing="ij")
        kept = (a < width) & (b < width) & (a <= b)
        return pd.DataFrame({"i": a[kept], "j": b[kept], "sxy": total[kept]})

    def products(batches):
        at_key, total = None, None
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                if at_key != (r.i, r.j, r.run):
                    if at_key is not None:
                        yield rows(*at_key[:2], total)
                    at_key, total = (r.i, r.j, r.run), np.zeros((genes, genes))
                if len(r.a_at) and len(r.b_at):
                    total += dense(r.a_at, r.a_slot, r.a_x).T @ dense(r.b_at, r.b_slot, r.b_x)
        if at_key is not None:
            yield rows(*at_key[:2], total)

    summed = met.mapInPandas(products, "i long, j long, sxy double")
    return summed if runs == 1 else summed.groupBy("i", "j").agg(F.sum("sxy").alias("sxy"))


def expression_stats(counts: DataFrame, obs: DataFrame, members: DataFrame) -> DataFrame:
    """Mean, max, percentage of non-zero spots and CV of each available panel gene.

    ``members`` has (panel, gene, var_id).
    """
    wanted = counts.join(members.select("var_id").distinct(), "var_id", "left_semi")
    stats = gene_stats(wanted, obs)
    n_spots = obs.agg(F.count(F.lit(1))).scalar()
    out = members.join(stats, "var_id", "left")
    mean = F.coalesce("mean", F.lit(0.0))
    return out.select(
        "panel",
        "gene",
        mean.alias("mean"),
        F.coalesce("max", F.lit(0.0)).alias("max"),
        (F.lit(100.0) * F.coalesce("nnz", F.lit(0)) / n_spots).alias("pct_nonzero"),
        F.when(mean > 0, F.sqrt("var_pop") / mean).otherwise(F.lit(0.0)).alias("cv"),
    )


def top_variable(stats: DataFrame, n: int = 6) -> DataFrame:
    """The n panel genes of largest CV."""
    return stats.orderBy(F.col("cv").desc(), "gene", "panel").limit(n)
