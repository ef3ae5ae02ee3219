"""The tables behind the usual figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import SPOT, correlation, exact_quantiles, gene_stats, ratio, unpivot
from ..functions.storage import stable
from ..sources.names import lookup_name
from .dense import dense_spots, gene_index

BINS = 50
CLUSTER_COLUMNS = ("spatial_clusters", "leiden", "louvain")


def _binned(df: DataFrame, by: Sequence[str], x: Column, bins: int) -> DataFrame:
    """Counts per equal-width bin of ``x`` and group, empty bins included, last bin closed."""
    by = list(by)
    values = df.select(*by, x.alias("_x")).where(F.col("_x").isNotNull())
    lo, hi = F.min("_x"), F.max("_x")
    half = F.when(lo == hi, F.lit(0.5)).otherwise(F.lit(0.0))
    limits = stable(values.groupBy(*by).agg((lo - half).alias("_lo"), (hi + half).alias("_hi")))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    slot = F.least(F.floor((F.col("_x") - F.col("_lo")) / width), F.lit(bins - 1)).cast("int")
    counted = values.join(limits, by).groupBy(*by, slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = limits.select(*by, "_lo", width.alias("_w"), F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return every.join(counted, [*by, "bin"], "left").select(
        *by,
        "bin",
        (F.col("_lo") + F.col("_w") * F.col("bin")).alias("left"),
        (F.col("_lo") + F.col("_w") * (F.col("bin") + 1)).alias("right"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def histogram(df: DataFrame, value: str, by: Sequence[str], bins: int = BINS) -> DataFrame:
    """Linear histogram."""
    return _binned(df, by, F.col(value), bins)


def log_histogram(df: DataFrame, value: str, by: Sequence[str], edges: int = BINS) -> DataFrame:
    """Histogram between ``edges`` log-spaced edges, for groups whose values are all positive."""
    by = list(by)
    positive = stable(df.groupBy(*by).agg(F.min(value).alias("_min")).where(F.col("_min") > 0).select(*by))
    binned = _binned(df.join(positive, by, "left_semi"), by, F.log10(value), edges - 1)
    ten = F.lit(10.0)
    return binned.withColumns({"left": F.pow(ten, F.col("left")), "right": F.pow(ten, F.col("right"))})


def histogram_labels(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Mean, median and sample std printed next to a histogram."""
    by = list(by)
    moments = df.groupBy(*by).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))
    return moments.join(exact_quantiles(df, by, value, {"median": 0.5}), by)


def box_stats(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Quartiles and whiskers (furthest points within 1.5 IQR) of each column and group."""
    keys = [*by, "metric"]
    long = stable(unpivot(df, list(by), list(columns)))
    boxes = exact_quantiles(long, keys, "value", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    v = F.col("value")
    return long.join(boxes, keys).groupBy(*keys, "q1", "median", "q3").agg(
        F.min(F.when(v >= F.col("q1") - reach, v)).alias("whisker_low"),
        F.max(F.when(v <= F.col("q3") + reach, v)).alias("whisker_high"),
    )


def score_correlation(scores: DataFrame, by: Sequence[str] = ("sample_id",)) -> DataFrame:
    """Pearson correlation of every pair of panels over (sample_id, obs_id, panel, score) rows.

    A spot has one score per panel, so the self-join on the spot grows with panels squared only.
    """
    by = list(by)
    b = scores.select(*SPOT, F.col("panel").alias("panel_b"), F.col("score").alias("_b"))
    a = scores.select(*SPOT, F.col("panel").alias("panel_a"), F.col("score").alias("_a"))
    return a.join(b, SPOT).groupBy(*by, "panel_a", "panel_b").agg(correlation(F.col("_a"), F.col("_b")).alias("corr"))


def marker_heatmap(
    counts: DataFrame, obs: DataFrame, clusters: DataFrame, genes: DataFrame, value: str = "x"
) -> DataFrame:
    """Per-gene min-max scaled values of a short ordered marker list (var_id, ord), for every spot.

    Rows are (sample_id, obs_id, cluster, ord, var_id, value).
    """
    index = stable(gene_index(genes))
    chosen = counts.join(index.select("var_id"), "var_id", "left_semi")
    limits = stable(
        index.join(genes.select("var_id", "ord"), "var_id")
        .join(gene_stats(chosen, obs, value=value).select("var_id", "min", "max"), "var_id", "left")
        .fillna(0.0, ["min", "max"])
    )
    cells = dense_spots(chosen, obs, index, value).select(*SPOT, F.posexplode("values").alias("pos", "_v"))
    scaled = ratio(F.col("_v") - F.col("min"), F.col("max") - F.col("min")).alias("value")
    return (
        cells.join(limits, "pos")
        .join(clusters.select(*SPOT, "cluster"), SPOT)
        .select(*SPOT, "cluster", "ord", "var_id", scaled)
    )


def scatter(metrics: DataFrame, x: str = "total_counts", y: str = "n_genes_by_counts") -> DataFrame:
    """The pairs of a scatter figure."""
    return metrics.select(*SPOT, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))


def scatter_bins(
    metrics: DataFrame, x: str = "total_counts", y: str = "n_genes_by_counts", bins: int = BINS,
    by: Sequence[str] = ("sample_id",),
) -> DataFrame:
    """Spots per cell of a bins x bins grid over the pairs; occupied cells only."""
    by = list(by)
    pairs = metrics.select(*by, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    box = stable(
        pairs.groupBy(*by).agg(
            F.min("_x").alias("_x0"), F.max("_x").alias("_x1"), F.min("_y").alias("_y0"), F.max("_y").alias("_y1")
        )
    )

    def slot(v: str, lo: str, hi: str) -> Column:
        at = F.floor(ratio((F.col(v) - F.col(lo)) * bins, F.col(hi) - F.col(lo)))
        return F.coalesce(F.least(at, F.lit(bins - 1)), F.lit(0)).cast("int")

    cells = pairs.join(box, by).groupBy(*by, slot("_x", "_x0", "_x1").alias("bin_x"), slot("_y", "_y0", "_y1").alias("bin_y"))
    return cells.agg(F.count(F.lit(1)).alias("n"))


def spatial_layer(obs: DataFrame, value: str, scale: float | Column = 1.0) -> DataFrame:
    """(x, y, value) of a metric or label, coordinates in pixels of the scaled image."""
    factor = F.lit(scale) if isinstance(scale, (int, float)) else scale
    return obs.select(
        *SPOT, (F.col("px") * factor).alias("x"), (F.col("py") * factor).alias("y"), F.col(value).alias("value")
    )


def gene_layer(
    obs: DataFrame, var: DataFrame, counts: DataFrame, gene: str, scale: float = 1.0, value: str = "x"
) -> DataFrame:
    """Spatial layer of one gene; spots without it show 0."""
    ids = var.where(lookup_name(var) == gene).select("var_id")
    cells = counts.join(ids, "var_id", "left_semi").select(*SPOT, F.col(value).alias("_v"))
    shown = obs.join(cells, SPOT, "left").withColumn("_value", F.coalesce("_v", F.lit(0.0)))
    return spatial_layer(shown, "_value", scale)


def dataset_summary(metrics: DataFrame, var: DataFrame, cluster: str | None = None) -> DataFrame:
    """(metric, value) rows: spots, genes, mean UMI per spot, number of clusters."""
    aggs = [F.count(F.lit(1)).cast("double").alias("total_spots"), F.avg("total_counts").alias("mean_umi_per_spot")]
    if cluster:
        aggs.append(F.count_distinct(cluster).cast("double").alias("n_clusters"))
    genes = var.agg(F.count(F.lit(1)).cast("double")).scalar()
    wide = metrics.agg(*aggs).withColumn("total_genes", genes)
    return wide.unpivot([], wide.columns, "metric", "value")


def cluster_column(columns: Sequence[str]) -> str | None:
    """First known cluster column."""
    return next((c for c in CLUSTER_COLUMNS if c in columns), None)


def figure_tables(
    obs: DataFrame,
    var: DataFrame,
    edges: DataFrame | None = None,
    markers: DataFrame | None = None,
    panel_scores: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The figure tables that the available columns and tables allow."""
    columns, out = obs.columns, {}
    metrics = [m for m in ("total_counts", "n_genes_by_counts", "pct_counts_mt") if m in columns]
    for m in metrics:
        out[f"histogram_{m}"] = histogram(obs, m, ["sample_id"])
        out[f"spatial_{m}"] = spatial_layer(obs, m)
    if {"total_counts", "n_genes_by_counts"} <= set(columns):
        out["scatter"] = scatter_bins(obs)
    cluster = cluster_column(columns)
    if cluster:
        out["spatial_clusters"] = spatial_layer(obs, cluster)
        out["cluster_sizes"] = obs.groupBy("sample_id", F.col(cluster).alias("cluster")).count()
        boxes = [m for m in metrics if m != "pct_counts_mt"]
        if boxes:
            out["boxes"] = box_stats(obs.withColumnRenamed(cluster, "cluster"), boxes, ["cluster"])
    if "total_counts" in columns:
        out["summary"] = dataset_summary(obs, var, cluster)
    if edges is not None:
        out["edges"] = edges
    if markers is not None:
        out["markers"] = markers
    if panel_scores is not None:
        out["panel_correlation"] = score_correlation(panel_scores)
    return out
