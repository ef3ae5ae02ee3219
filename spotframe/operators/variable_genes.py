"""Highly variable gene selection in three flavours.

All three reduce the counts to one row per gene first; what follows works on that gene table, whose size
is the number of genes of the assay and does not grow with spots or samples.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import gene_stats, ratio
from ..functions.storage import stable

N_TOP_GENES = 2_000
METHODS = ("seurat_v3", "seurat", "cell_ranger")


def hvg_seurat(
    logs: DataFrame,
    obs: DataFrame,
    var: DataFrame,
    min_mean: float = 0.0125,
    max_mean: float = 3.0,
    min_disp: float = 0.5,
    n_bins: int = 20,
) -> DataFrame:
    """Log dispersion, z-scored within equal-width bins of the log mean; thresholds decide."""
    table = _dispersions(logs, obs, var)
    log_mean, log_disp = F.log1p("mean"), F.when(F.col("disp") > 0, F.ln("disp"))
    genes = stable(table.select("var_id", log_mean.alias("mean"), log_disp.alias("disp")))
    lo, hi = genes.agg(F.min("mean")).scalar(), genes.agg(F.max("mean")).scalar()
    place = F.ceil(ratio((F.col("mean") - lo) * n_bins, hi - lo))
    binned = genes.withColumn("bin", F.greatest(F.least(F.coalesce(place, F.lit(1)), F.lit(n_bins)), F.lit(1)))
    per_bin = binned.groupBy("bin").agg(
        F.count("disp").alias("_n"), F.avg("disp").alias("_avg"), F.stddev_samp("disp").alias("_std")
    )
    z = F.when(F.col("disp").isNull(), F.lit(0.0)).when(F.col("_n") == 1, F.lit(1.0)).otherwise(
        F.coalesce(ratio(F.col("disp") - F.col("_avg"), F.col("_std")), F.lit(0.0))
    )
    scored = binned.join(per_bin, "bin").withColumn("score", z)
    keep = (F.col("mean") > min_mean) & (F.col("mean") < max_mean) & (F.col("score") > min_disp)
    return scored.select("var_id", F.col("mean"), F.col("disp"), "score", keep.alias("highly_variable"))


def hvg_cell_ranger(
    logs: DataFrame, obs: DataFrame, var: DataFrame, n_top_genes: int = N_TOP_GENES
) -> DataFrame:
    """Dispersion normalised by the median and MAD of its percentile bin; the n-th largest is the cutoff."""
    genes = stable(_dispersions(logs, obs, var))
    probs = F.array(*[F.lit(p / 100.0) for p in range(10, 105, 5)])
    edges = genes.agg(F.percentile("mean", probs)).scalar()
    # Right-closed bins: the bin number is the count of edges strictly below the mean.
    place = F.size(F.filter(F.col("_edges"), lambda e: e < F.col("mean")))
    binned = genes.withColumn("_edges", edges).withColumn("bin", place).drop("_edges")
    centre = binned.groupBy("bin").agg(F.median("disp").alias("_med"))
    spread = (
        binned.join(centre, "bin")
        .groupBy("bin", "_med")
        .agg((F.median(F.abs(F.col("disp") - F.col("_med"))) / F.lit(0.6744897501960817)).alias("_mad"))
    )
    scored = stable(
        binned.join(spread, "bin").withColumn("score", ratio(F.col("disp") - F.col("_med"), F.col("_mad")))
    )
    top = scored.where(F.col("score").isNotNull()).orderBy(F.col("score").desc()).limit(n_top_genes)
    cutoff = top.agg(F.min("score")).scalar()
    keep = F.coalesce(F.col("score") >= cutoff, F.lit(False))
    return scored.select("var_id", "mean", "disp", "score", keep.alias("highly_variable"))


def _dispersions(logs: DataFrame, obs: DataFrame, var: DataFrame) -> DataFrame:
    """Mean and variance-to-mean ratio of every gene on the unlogged values, zeros included."""
    stats = gene_stats(logs, obs, value=F.expm1("x")).select("var_id", "mean", "var_samp")
    every = var.select("var_id").join(stats, "var_id", "left")
    mean = F.coalesce("mean", F.lit(0.0))
    safe = F.when(mean == 0, F.lit(1e-12)).otherwise(mean)
    return every.select(
        "var_id", safe.alias("mean"), (F.coalesce("var_samp", F.lit(0.0)) / safe).alias("disp")
    )


def hvg_seurat_v3(
    counts: DataFrame, obs: DataFrame, var: DataFrame, n_top_genes: int = N_TOP_GENES, span: float = 0.3
) -> DataFrame:
    """Variance of counts standardised by a local regression of log variance on log mean, clipped; top n."""
    stats = gene_stats(counts, obs).select("var_id", "n_spots", "mean", "var_samp")
    usable = (F.col("var_samp") > 0) & (F.col("mean") > 0)
    genes = stable(
        stats.select(
            "*", F.when(usable, F.log10("mean")).alias("lm"), F.when(usable, F.log10("var_samp")).alias("lv")
        )
    )
    fit = _local_fit(genes.where(usable), span)
    spread = counts.sparkSession.sparkContext.defaultParallelism
    # Genes of one mean share their fitted value.
    means = genes.where(usable).select("lm").distinct().repartition(spread, "lm")
    fitted = genes.where(usable).join(stable(means.withColumn("fit", fit(F.col("lm")))), "lm")
    std = F.sqrt(F.pow(F.lit(10.0), F.col("fit")))
    limits = stable(
        fitted.select(
            "var_id", "n_spots", "mean", "var_samp", std.alias("s"), (std * F.sqrt("n_spots") + F.col("mean")).alias("clip")
        )
    )
    clipped = (
        counts.select("var_id", "x")
        .join(limits.select("var_id", "clip"), "var_id")
        .groupBy("var_id")
        .agg(
            F.sum(F.least("x", "clip")).alias("_s1"), F.sum(F.least("x", "clip") * F.least("x", "clip")).alias("_s2")
        )
    )
    n, m = F.col("n_spots"), F.col("mean")
    score = (n * m * m + F.col("_s2") - F.lit(2.0) * m * F.col("_s1")) / ((n - 1) * F.col("s") * F.col("s"))
    scored = var.select("var_id").join(
        limits.join(clipped, "var_id").select("var_id", "mean", F.col("var_samp").alias("variance"), score.alias("score")),
        "var_id",
        "left",
    )
    scored = scored.fillna(0.0, ["mean", "variance", "score"])
    order = Window.orderBy(F.col("score").desc(), F.col("var_id"))
    return scored.withColumn("highly_variable", F.row_number().over(order) <= n_top_genes)


def local_quadratic(x: np.ndarray, xs: np.ndarray, ys: np.ndarray, span: float) -> np.ndarray:
    """Degree-2 local regression with tricube weights over the nearest ``span`` share of sorted ``xs``."""
    n = len(xs)
    q = min(n, max(int(np.floor(span * n + 1e-9)), 3))
    points, back = np.unique(x, return_inverse=True)
    # Weights depend on the place alone, so a window is summed over the different places in it.
    at_x, start = np.unique(xs, return_index=True)
    start, below = np.append(start, n), np.append(0.0, np.cumsum(ys))
    out = np.empty(len(points))
    for at, v in enumerate(points):
        lo = max(0, min(int(np.searchsorted(xs, v)) - q, n - q))
        # The window slides right while its left end is further from v than the next point on the right.
        stop = n - q
        while lo < stop:
            mid = (lo + stop) // 2
            if v - xs[mid] > xs[mid + q] - v:
                lo = mid + 1
            else:
                stop = mid
        first, last = np.searchsorted(start, lo, side="right") - 1, np.searchsorted(start, lo + q)
        ends = np.clip(start[first : last + 1], lo, lo + q)
        count, y = np.diff(ends), np.diff(below[ends])
        u = at_x[first:last] - v
        h = np.abs(u).max()
        if h == 0:
            out[at] = ys[lo : lo + q].mean()
            continue
        u = u / h
        w = (1.0 - np.abs(u) ** 3) ** 3
        wu, wuu = w * u, w * u * u
        s0, s1, s2, s3, s4 = w @ count, wu @ count, wuu @ count, (wuu * u) @ count, (wuu * u * u) @ count
        normal = np.array([[s0, s1, s2], [s1, s2, s3], [s2, s3, s4]])
        out[at] = (np.linalg.pinv(normal, hermitian=True) @ np.array([w @ y, wu @ y, wuu @ y]))[0]
    return out[back]


def _local_fit(genes: DataFrame, span: float):
    """UDF that evaluates the local regression; only the gene table's two columns reach the workers."""
    # Columns, not rows: a row of Python objects is many times the two numbers of a gene.
    pairs = genes.select("lm", "lv").orderBy("lm", "lv").toArrow()
    shared = genes.sparkSession.sparkContext.broadcast((pairs["lm"].to_numpy(), pairs["lv"].to_numpy()))

    @F.pandas_udf("double")
    def fit(lm: pd.Series) -> pd.Series:
        xs, ys = shared.value
        return pd.Series(local_quadratic(lm.to_numpy(dtype=float), xs, ys, span))

    return fit


def variable_genes(
    method: str,
    obs: DataFrame,
    var: DataFrame,
    counts: DataFrame,
    logs: DataFrame,
    n_top_genes: int = N_TOP_GENES,
) -> DataFrame:
    """Gene table with ``highly_variable`` by the named method."""
    if method == "seurat_v3":
        return hvg_seurat_v3(counts, obs, var, n_top_genes)
    if method == "seurat":
        return hvg_seurat(logs, obs, var)
    if method == "cell_ranger":
        return hvg_cell_ranger(logs, obs, var, n_top_genes)
    raise ValueError(f"unknown method {method!r}; use one of {METHODS}")


def hvg_stats(genes: DataFrame) -> DataFrame:
    """Number, fraction and total of genes."""
    n = F.count_if("highly_variable")
    return genes.agg(
        n.alias("n_hvg"),
        ratio(n.cast("double"), F.count(F.lit(1))).alias("hvg_fraction"),
        F.count(F.lit(1)).alias("total_genes"),
    )


def default_genes(genes: DataFrame | None, counts: DataFrame, obs: DataFrame, n: int = 100) -> DataFrame:
    """First n variable genes in gene order; without a selection the n of largest population variance."""
    if genes is not None:
        return genes.where("highly_variable").orderBy("var_id").limit(n).select("var_id")
    stats = gene_stats(counts, obs)
    return stats.orderBy(F.col("var_pop").desc(), "var_id").limit(n).select("var_id")
