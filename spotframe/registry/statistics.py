"""Queries over descriptive statistics and figure tables."""

from __future__ import annotations

from .. import fixtures as fx
from ..operators import plotdata, stats
from .core import query, r, rounded, rs
from .quality import metrics

BY = ["cluster"]
QUANTILES = ", ".join(f"quantile_cont(x, {p}) AS {n}" for n, p in (("q25", 0.25), ("median", 0.5), ("q75", 0.75)))


@query(
    "h1_basic_stats",
    f"""SELECT cluster, {rs('mean std min max q25 median q75')}, {r('q75 - q25', 'iqr')},
{r('CASE WHEN mean > 0 THEN std / mean ELSE 0 END', 'cv')} FROM (SELECT cluster, avg(x) AS mean, stddev_pop(x) AS std,
min(x) AS min, max(x) AS max, {QUANTILES} FROM metric GROUP BY 1)""",
    "metric",
)
def _(spark, sf):
    return rounded(stats.basic_stats(fx.metric(spark, sf), "x", BY))


@query(
    "h2_outliers_iqr",
    f"""WITH q AS (SELECT cluster, {QUANTILES} FROM metric GROUP BY 1)
SELECT obs_id, x < q25 - 1.5 * (q75 - q25) OR x > q75 + 1.5 * (q75 - q25) AS is_outlier FROM metric JOIN q USING (cluster)""",
    "metric",
)
def _(spark, sf):
    return stats.outliers(fx.metric(spark, sf), "x", BY, "iqr", 1.5).select("obs_id", "is_outlier")


@query(
    "h3_outliers_zscore",
    """WITH q AS (SELECT cluster, avg(x) AS m, stddev_pop(x) AS s FROM metric GROUP BY 1)
SELECT obs_id, abs((x - m) / s) > 2 AS is_outlier FROM metric JOIN q USING (cluster)""",
    "metric",
)
def _(spark, sf):
    return stats.outliers(fx.metric(spark, sf), "x", BY, "zscore", 2.0).select("obs_id", "is_outlier")


@query(
    "h4_outliers_mad",
    """WITH q AS (SELECT cluster, median(x) AS m FROM metric GROUP BY 1),
d AS (SELECT cluster, median(abs(x - m)) AS mad FROM metric JOIN q USING (cluster) GROUP BY 1)
SELECT obs_id, abs(0.6745 * (x - m) / mad) > 3.5 AS is_outlier FROM metric JOIN q USING (cluster) JOIN d USING (cluster)""",
    "metric",
)
def _(spark, sf):
    return stats.outliers(fx.metric(spark, sf), "x", BY, "mad", 3.5).select("obs_id", "is_outlier")


def _histogram(x: str, bins: int, edge: str) -> str:
    return f"""WITH lim AS (SELECT cluster, min({x}) AS lo, (max({x}) - min({x})) / {bins}.0::DOUBLE AS w FROM metric GROUP BY 1),
c AS (SELECT cluster, least(floor(({x} - lo) / w), {bins - 1})::INT AS bin, count(*) AS n
  FROM metric JOIN lim USING (cluster) GROUP BY 1, 2)
SELECT cluster, bin::INT AS bin, {r(edge.format('lo + w * bin'), '"left"')}, {r(edge.format('lo + w * (bin + 1)'), '"right"')},
coalesce(n, 0) AS n FROM (SELECT *, unnest(generate_series(0, {bins - 1})) AS bin FROM lim) LEFT JOIN c USING (cluster, bin)"""


@query("i1_histogram", _histogram("x", 50, "{}"), "metric")
def _(spark, sf):
    return rounded(plotdata.histogram(fx.metric(spark, sf), "x", BY))


@query(
    "i1_histogram_labels",
    f"SELECT cluster, {r('avg(x)', 'mean')}, {r('median(x)', 'median')}, {r('stddev_samp(x)', 'std')} FROM metric GROUP BY 1",
    "metric",
)
def _(spark, sf):
    return rounded(plotdata.histogram_labels(fx.metric(spark, sf), "x", BY))


@query("i2_log_histogram", _histogram("log10(x)", 49, "pow(10.0, {})"), "metric")
def _(spark, sf):
    return rounded(plotdata.log_histogram(fx.metric(spark, sf), "x", BY))


@query(
    "i3_box_stats",
    f"""WITH l AS (SELECT cluster, 'total_counts' AS metric, total_counts AS x FROM metrics
  UNION ALL SELECT cluster, 'n_genes_by_counts', n_genes_by_counts FROM metrics),
q AS (SELECT cluster, metric, {QUANTILES} FROM l GROUP BY 1, 2)
SELECT cluster, metric, {r('q25', 'q1')}, {rs('median')}, {r('q75', 'q3')},
{r('min(x) FILTER (WHERE x >= q25 - 1.5 * (q75 - q25))', 'whisker_low')},
{r('max(x) FILTER (WHERE x <= q75 + 1.5 * (q75 - q25))', 'whisker_high')}
FROM l JOIN q USING (cluster, metric) GROUP BY cluster, metric, q25, median, q75""",
    "metrics",
)
def _(spark, sf):
    return rounded(plotdata.box_stats(metrics(spark, sf), ["total_counts", "n_genes_by_counts"], BY))


@query("i6_scatter", "SELECT sample_id, obs_id, total_counts AS x, n_genes_by_counts::DOUBLE AS y FROM totals", "totals")
def _(spark, sf):
    return plotdata.scatter(metrics(spark, sf, families=()))


@query(
    "i6_scatter_bins",
    """WITH b AS (SELECT sample_id, min(total_counts) AS x0, max(total_counts) AS x1, min(n_genes_by_counts)::DOUBLE AS y0,
  max(n_genes_by_counts)::DOUBLE AS y1 FROM totals GROUP BY 1)
SELECT sample_id, least(floor((total_counts - x0) * 50 / (x1 - x0)), 49)::INT AS bin_x,
least(floor((n_genes_by_counts - y0) * 50 / (y1 - y0)), 49)::INT AS bin_y, count(*) AS n
FROM totals JOIN b USING (sample_id) GROUP BY 1, 2, 3""",
    "totals",
)
def _(spark, sf):
    return plotdata.scatter_bins(metrics(spark, sf, families=()))


# Fixed value: scale factor from full-resolution coordinates to the large image.
HIRES_SCALE = 0.048109304


@query(
    "i7_metric_layer",
    f"SELECT sample_id, obs_id, {r(f'px * {HIRES_SCALE}', 'x')}, {r(f'py * {HIRES_SCALE}', 'y')}, total_counts AS value FROM metrics",
    "metrics",
)
def _(spark, sf):
    return rounded(plotdata.spatial_layer(metrics(spark, sf), "total_counts", HIRES_SCALE))


@query("i7_label_layer", f"SELECT sample_id, obs_id, {r('px', 'x')}, {r('py', 'y')}, cluster AS value FROM obs", "obs")
def _(spark, sf):
    return rounded(plotdata.spatial_layer(fx.sparse_obs(spark, sf), "cluster"))


@query(
    "i7_gene_layer",
    f"""SELECT o.sample_id, o.obs_id, {r('px', 'x')}, {r('py', 'y')}, coalesce(c.x, 0.0) AS value FROM obs o
LEFT JOIN (SELECT obs_id, c.x FROM counts c JOIN var USING (var_id) WHERE gene = (SELECT gene FROM var WHERE var_id = 1)) c USING (obs_id)""",
    "obs var counts",
)
def _(spark, sf):
    d = fx.sparse(spark, sf)
    gene = d.var.where("var_id = 1").first().gene
    return rounded(plotdata.gene_layer(d.obs, d.var, d.counts, gene))


@query(
    "i8_dataset_summary",
    f"""SELECT 'total_spots' AS metric, count(*)::DOUBLE AS value FROM metrics
UNION ALL SELECT 'mean_umi_per_spot', {r('avg(total_counts)', 'v')} FROM metrics
UNION ALL SELECT 'n_clusters', count(DISTINCT cluster)::DOUBLE FROM metrics
UNION ALL SELECT 'total_genes', count(*)::DOUBLE FROM var""",
    "var metrics",
)
def _(spark, sf):
    return rounded(plotdata.dataset_summary(metrics(spark, sf), fx.sparse_var(spark, sf), "cluster"))
