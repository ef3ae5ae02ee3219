"""Quality-control metrics, outliers and filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import SPOT, distance, exact_quantiles, ratio, unpivot, with_group_size
from ..functions.storage import stable
from .neighbours import count_within

# Gene-name rules of the three families.
MT_PREFIX = "MT-"
RIBO_PREFIXES = ("RPS", "RPL")
HB_PATTERN = "^HB[^(P)]"

FAMILIES = ("mt", "ribo", "hb")
TOP_SIZES = (50, 100, 200, 500)


def gene_families(var: DataFrame, gene: str = "gene") -> DataFrame:
    """Boolean ``mt`` / ``ribo`` / ``hb`` flags from the gene name."""
    name = F.col(gene)
    ribo = name.startswith(RIBO_PREFIXES[0]) | name.startswith(RIBO_PREFIXES[1])
    return var.withColumns({"mt": name.startswith(MT_PREFIX), "ribo": ribo, "hb": name.rlike(HB_PATTERN)})


def spot_totals(obs: DataFrame, counts: DataFrame, value: str = "x") -> DataFrame:
    """Total per spot; a spot without counts keeps a row with 0."""
    totals = counts.groupBy(*SPOT).agg(F.sum(value).alias("_total"))
    return obs.join(totals, SPOT, "left").withColumn("total_counts", F.coalesce("_total", F.lit(0.0))).drop("_total")


def spot_metrics(
    obs: DataFrame, var: DataFrame, counts: DataFrame, families: Sequence[str] = FAMILIES, log_variants: bool = False
) -> DataFrame:
    """Totals, detected genes and per-family totals and percentages of every spot.

    ``var`` carries the family flags. The aggregation combines map-side before its only shuffle.
    """
    x = F.col("x")
    rows = counts
    if families:
        rows = counts.join(var.select("var_id", *families), "var_id", "left")
    aggs = [F.sum(x).alias("total_counts"), F.count(F.when(x > 0, 1)).alias("n_genes_by_counts")]
    aggs += [F.sum(F.when(F.col(f), x)).alias(f"total_counts_{f}") for f in families]
    agg = rows.groupBy(*SPOT).agg(*aggs)
    out = obs.join(agg, SPOT, "left")
    filled = ["total_counts", *[f"total_counts_{f}" for f in families]]
    out = out.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in filled})
    out = out.withColumn("n_genes_by_counts", F.coalesce("n_genes_by_counts", F.lit(0)))
    out = out.withColumns(
        {f"pct_counts_{f}": ratio(F.lit(100.0) * F.col(f"total_counts_{f}"), F.col("total_counts")) for f in families}
    )
    if log_variants:
        out = out.withColumns({f"log1p_{c}": F.log1p(c) for c in ("total_counts", "n_genes_by_counts")})
    return out


def gene_metrics(
    obs: DataFrame, var: DataFrame, counts: DataFrame, by: Sequence[str] = (), log_variants: bool = False
) -> DataFrame:
    """Detection and totals of every gene over all spots (or per group in ``by``, stored genes only)."""
    by = list(by)
    agg = counts.groupBy(*by, "var_id").agg(
        F.count(F.when(F.col("x") > 0, 1)).alias("n_cells_by_counts"), F.sum("x").alias("total_counts")
    )
    if by:
        out = agg.join(var, "var_id")
    else:
        out = var.join(agg, "var_id", "left")
    out = out.withColumns(
        {
            "n_cells_by_counts": F.coalesce("n_cells_by_counts", F.lit(0)),
            "total_counts": F.coalesce("total_counts", F.lit(0.0)),
        }
    )
    out = with_group_size(out, obs, by)
    n = F.col("n_spots")
    out = out.withColumns(
        {
            "mean_counts": ratio(F.col("total_counts"), n),
            "pct_dropout_by_counts": F.lit(100.0) * (F.lit(1.0) - ratio(F.col("n_cells_by_counts"), n)),
        }
    ).drop("n_spots")
    if log_variants:
        out = out.withColumns({f"log1p_{c}": F.log1p(c) for c in ("total_counts", "mean_counts")})
    return out


def top_gene_share(obs: DataFrame, var: DataFrame, counts: DataFrame, sizes: Sequence[int] = TOP_SIZES) -> DataFrame:
    """Percentage of a spot's counts in its n largest genes; NULL when n exceeds the number of genes.

    The window runs inside one spot, which holds at most one row per gene.
    """
    order = Window.partitionBy(*SPOT).orderBy(F.col("x").desc(), F.col("var_id"))
    ranked = counts.select(*SPOT, "x", F.row_number().over(order).alias("_rank"))
    aggs = [F.sum(F.when(F.col("_rank") <= n, F.col("x"))).alias(f"_top_{n}") for n in sizes]
    tops = ranked.groupBy(*SPOT).agg(F.sum("x").alias("_total"), *aggs)
    n_vars = var.agg(F.count(F.lit(1))).scalar()
    share = [
        F.when(n_vars >= n, ratio(F.lit(100.0) * F.col(f"_top_{n}"), F.col("_total"))).alias(
            f"pct_counts_in_top_{n}_genes"
        )
        for n in sizes
    ]
    return obs.join(tops, SPOT, "left").select(*obs.columns, *share)


def centre_distance(obs: DataFrame) -> DataFrame:
    """Distance of every spot to the mean coordinate of its sample."""
    centre = stable(obs.groupBy("sample_id").agg(F.avg("px").alias("_cx"), F.avg("py").alias("_cy")))
    d = distance(F.col("px"), F.col("py"), F.col("_cx"), F.col("_cy"))
    return obs.join(centre, "sample_id").withColumn("distance_to_center", d).drop("_cx", "_cy")


def local_density(obs: DataFrame, percentile: float = 0.10) -> DataFrame:
    """Number of other spots nearer than r, where r is a low percentile of the sample's centre distances."""
    located = centre_distance(obs)
    radius = exact_quantiles(located, ["sample_id"], "distance_to_center", {"radius": percentile})
    counted = count_within(obs, radius)
    return located.join(counted, SPOT, "left").withColumn("local_density", F.coalesce("n_within", F.lit(0))).drop(
        "n_within"
    )


def summary_metrics(columns: Sequence[str]) -> list[str]:
    """Metric columns that a summary covers, in order."""
    base = ["total_counts", "n_genes_by_counts", "total_counts_mt", "pct_counts_mt"]
    more = [c for c in columns if any(k in c for k in ("ribo", "hb", "top_"))]
    return [m for m in base + more if m in columns]


def metric_summary(
    metrics: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ("sample_id",)
) -> DataFrame:
    """Mean, median, sample std, min, max and quartiles of each metric."""
    columns = list(columns or summary_metrics(metrics.columns))
    keys = [*by, "metric"]
    # Read twice below; written once, so that the metrics themselves are computed once.
    long = stable(unpivot(metrics, list(by), columns))
    moments = long.groupBy(*keys).agg(
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = exact_quantiles(long, keys, "value", {"q25": 0.25, "median": 0.5, "q75": 0.75})
    return moments.join(quartiles, keys, "left")


def mad_bounds(metrics: DataFrame, columns: Sequence[str], n_mads: float, by: Sequence[str]) -> DataFrame:
    """Median, raw MAD and the limits median -/+ n_mads * MAD of each metric."""
    keys = [*by, "metric"]
    long = unpivot(metrics, list(by), columns)
    medians = exact_quantiles(long, keys, "value", {"median": 0.5})
    deviations = long.join(medians, keys).select(*keys, F.abs(F.col("value") - F.col("median")).alias("_dev"))
    mads = exact_quantiles(deviations, keys, "_dev", {"mad": 0.5})
    width = F.lit(float(n_mads)) * F.col("mad")
    return medians.join(mads, keys).withColumns({"lower": F.col("median") - width, "upper": F.col("median") + width})


def mad_outliers(
    metrics: DataFrame,
    columns: Sequence[str] = ("total_counts", "n_genes_by_counts", "pct_counts_mt"),
    n_mads: float = 3.0,
    high_only: Sequence[str] = ("pct_counts_mt",),
    by: Sequence[str] = ("sample_id",),
) -> DataFrame:
    """``outlier_<metric>`` flags: strictly outside the MAD limits, upper side only for ``high_only``."""
    by = list(by)
    # One row per spot, read three times below.
    metrics = stable(metrics)
    bounds = mad_bounds(metrics, columns, n_mads, by)
    wide = bounds.groupBy(*by).agg(
        *[F.max(F.when(F.col("metric") == c, F.col(e))).alias(f"_{c}_{e}") for c in columns for e in ("lower", "upper")]
    )
    wide = stable(wide)
    joined = metrics.join(wide, by)
    flags = {}
    for c in columns:
        flag = F.col(c) > F.col(f"_{c}_upper")
        if c not in high_only:
            flag = flag | (F.col(c) < F.col(f"_{c}_lower"))
        flags[f"outlier_{c}"] = F.coalesce(flag, F.lit(False))
    return joined.select(*metrics.columns, *[f.alias(n) for n, f in flags.items()])


def spot_steps(
    min_counts: float | None = None,
    max_counts: float | None = None,
    min_genes: int | None = None,
    max_genes: int | None = None,
    max_pct_mt: float | None = None,
    tissue_only: bool = True,
) -> list[tuple[str, Column]]:
    """The active filter steps in order; all limits are inclusive, an unknown value does not pass."""
    steps: list[tuple[str, Column]] = []
    if tissue_only:
        steps.append(("after_tissue", F.col("in_tissue")))
    if min_counts is not None:
        steps.append(("after_min_counts", F.col("total_counts") >= min_counts))
    if max_counts is not None:
        steps.append(("after_max_counts", F.col("total_counts") <= max_counts))
    if min_genes is not None:
        steps.append(("after_min_genes", F.col("n_genes_by_counts") >= min_genes))
    if max_genes is not None:
        steps.append(("after_max_genes", F.col("n_genes_by_counts") <= max_genes))
    if max_pct_mt is not None:
        steps.append(("after_mt_filter", F.col("pct_counts_mt") <= max_pct_mt))
    return [(name, F.coalesce(cond, F.lit(False))) for name, cond in steps]


def filter_spots(metrics: DataFrame, **limits) -> DataFrame:
    """Spots that pass every active step."""
    out = metrics
    for _, cond in spot_steps(**limits):
        out = out.where(cond)
    return out


def filter_cascade(metrics: DataFrame, by: Sequence[str] = ("sample_id",), **limits) -> DataFrame:
    """Survivors of each step, spots removed and retention rate, in one aggregation."""
    passed, aggs = F.lit(True), [F.count(F.lit(1)).alias("initial_spots")]
    for name, cond in spot_steps(**limits):
        passed = passed & cond
        aggs.append(F.count_if(passed).alias(name))
    aggs.append(F.count_if(passed).alias("final_spots"))
    out = metrics.groupBy(*by).agg(*aggs)
    return out.withColumns(
        {
            "spots_removed": F.col("initial_spots") - F.col("final_spots"),
            "retention_rate": ratio(F.col("final_spots").cast("double"), F.col("initial_spots")),
        }
    )


def restrict_counts(
    counts: DataFrame, spots: DataFrame | None = None, genes: DataFrame | None = None
) -> DataFrame:
    """Counts of the given spots and genes only."""
    if spots is not None:
        counts = counts.join(spots.select(*SPOT), SPOT, "left_semi")
    if genes is not None:
        counts = counts.join(genes.select("var_id"), "var_id", "left_semi")
    return counts


def filter_genes(
    var: DataFrame, counts: DataFrame, min_cells: int = 10, min_counts: float = 1.0
) -> DataFrame:
    """Genes detected in at least ``min_cells`` spots with at least ``min_counts`` in total."""
    kept = (
        counts.groupBy("var_id")
        .agg(F.count(F.when(F.col("x") > 0, 1)).alias("_cells"), F.sum("x").alias("_total"))
        .where((F.col("_cells") >= min_cells) & (F.col("_total") >= min_counts))
    )
    return var.join(kept.select("var_id"), "var_id", "left_semi")


def tissue_split(metrics: DataFrame, by: Sequence[str] = ("sample_id",)) -> DataFrame:
    """Spots and mean totals on and off tissue."""
    return metrics.groupBy(*by, "in_tissue").agg(
        F.count(F.lit(1)).alias("n_spots"),
        F.avg("total_counts").alias("mean_counts"),
        F.avg("n_genes_by_counts").alias("mean_genes"),
    )
