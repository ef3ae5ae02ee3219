"""Queries over validation and quality control."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..operators import plotdata, profile, qc
from .core import query, r, rounded, rs

LIMITS = dict(min_counts=200, max_counts=2000, min_genes=10, max_pct_mt=25.0)
MIN_CELLS = 30
MAX_GENES = 40


def metrics(spark, sf, **kw):
    d = fx.sparse(spark, sf)
    return qc.spot_metrics(d.obs, qc.gene_families(d.var), d.counts, **kw)


@query(
    "b1_structure",
    f"""SELECT 'n_obs' AS item, count(*)::VARCHAR AS value FROM obs
UNION ALL SELECT 'n_vars', count(*)::VARCHAR FROM var UNION ALL SELECT 'nnz', count(*)::VARCHAR FROM counts
UNION ALL SELECT 'obs_columns', 'sample_id,obs_id,cluster,in_tissue,array_row,array_col,px,py'
UNION ALL SELECT 'var_columns', 'var_id,gene,gene_dup,brand' UNION ALL SELECT 'tables', 'counts,obs,var'""",
    "obs var counts",
)
def _(spark, sf):
    return profile.structure_profile(fx.sparse(spark, sf))


@query(
    "b2_coordinate_bounds",
    f"""SELECT sample_id, count(*) AS n_located, {r('min(px)', 'min_x')}, {r('max(px)', 'max_x')},
{r('min(py)', 'min_y')}, {r('max(py)', 'max_y')} FROM obs GROUP BY 1""",
    "obs",
)
def _(spark, sf):
    return rounded(profile.coordinate_bounds(fx.sparse_obs(spark, sf)))


@query(
    "b3_matrix_profile",
    f"""WITH t AS (SELECT sample_id, obs_id, sum(x) AS total, count(*) FILTER (WHERE x <> 0) AS nnz, min(x) AS low
  FROM dense GROUP BY 1, 2)
SELECT sample_id, count(*) AS n_spots, sum(nnz)::BIGINT AS nnz, {r('min(total)', 'min_total')},
{r('max(total)', 'max_total')}, {r('avg(total)', 'mean_total')}, {r('stddev_pop(total)', 'std_total')},
bool_or(low < 0) AS has_negative, {r('1.0 - sum(nnz)::DOUBLE / (count(*) * (SELECT count(*) FROM var))', 'sparsity')}
FROM t GROUP BY 1""",
    "dense",
)
def _(spark, sf):
    d = fx.sparse(spark, sf)
    return rounded(profile.matrix_profile(d.obs, d.var, d.counts))


@query(
    "b3_signed_profile",
    f"""SELECT sample_id, {r('min(total)', 'min_total')}, {r('max(total)', 'max_total')}, bool_or(low < 0) AS has_negative
FROM (SELECT sample_id, obs_id, sum(x) AS total, min(x) AS low FROM signed_counts GROUP BY 1, 2) GROUP BY 1""",
    "signed_counts",
)
def _(spark, sf):
    d = fx.signed(spark, sf)
    p = profile.matrix_profile(d.obs, d.var, d.counts)
    return rounded(p.select("sample_id", "min_total", "max_total", "has_negative"))


@query(
    "b4_uniformity",
    f"""SELECT sample_id, {r('stddev_pop(total_counts)', 'std_total')}, stddev_pop(total_counts) < 1e-6 AS is_uniform
FROM totals GROUP BY 1""",
    "totals",
)
def _(spark, sf):
    d = fx.sparse(spark, sf)
    return rounded(profile.uniformity(profile.matrix_profile(d.obs, d.var, d.counts)))


@query(
    "b5_range_level",
    """SELECT sample_id, max(total_counts) AS max_total, CASE WHEN max(total_counts) < 1000 THEN 'low'
WHEN max(total_counts) > 100000 THEN 'high' ELSE 'ok' END AS level FROM totals GROUP BY 1""",
    "totals",
)
def _(spark, sf):
    d = fx.sparse(spark, sf)
    p = profile.matrix_profile(d.obs, d.var, d.counts)
    return p.select("sample_id", "max_total", profile.range_level(F.col("max_total")).alias("level"))


@query(
    "b6_tissue_coverage",
    f"""SELECT sample_id, count(*) AS n_spots, count(*) FILTER (WHERE in_tissue) AS tissue_spots,
{r('avg(in_tissue::INT)', 'tissue_fraction')} FROM obs GROUP BY 1""",
    "obs",
)
def _(spark, sf):
    return rounded(profile.tissue_coverage(fx.sparse_obs(spark, sf)))


@query(
    "b7_findings",
    """WITH f AS (SELECT sample_id, stddev_pop(total_counts) < 1e-6 AS uniform, max(total_counts) < 1000 AS low,
  max(total_counts) > 100000 AS high, bool_and(in_tissue) AS whole FROM totals JOIN obs USING (sample_id, obs_id) GROUP BY 1)
SELECT sample_id, 'issue' AS level, 'missing_spatial_metadata' AS code FROM f
UNION ALL SELECT sample_id, 'issue', unnest(['uniform_totals', 'no_variation']) FROM f WHERE uniform
UNION ALL SELECT sample_id, 'warning', 'low_totals' FROM f WHERE low
UNION ALL SELECT sample_id, 'warning', 'high_totals' FROM f WHERE high
UNION ALL SELECT sample_id, 'warning', 'all_in_tissue' FROM f WHERE whole""",
    "obs totals",
)
def _(spark, sf):
    return profile.findings(fx.sparse(spark, sf)).drop("message")


@query("b8_fix_uniformity", "SELECT sample_id, obs_id, var_id, x FROM counts", "counts")
def _(spark, sf):
    d = fx.sparse(spark, sf)
    return profile.fix_uniformity(d.obs, d.counts)[0].select("sample_id", "obs_id", "var_id", "x")


@query(
    "b9_light_findings",
    """SELECT 'warning' AS level, 'duplicate_genes' AS code FROM var HAVING count(gene_dup) > count(DISTINCT gene_dup)
UNION ALL SELECT 'warning', 'negative_values' FROM counts HAVING min(x) < 0
UNION ALL SELECT 'issue', 'no_spots' FROM obs HAVING count(*) = 0
UNION ALL SELECT 'issue', 'no_genes' FROM var HAVING count(*) = 0""",
    "obs var counts",
)
def _(spark, sf):
    d = fx.sparse(spark, sf)
    named = d.with_(var=d.var.select("var_id", F.col("gene_dup").alias("gene")))
    return profile.light_findings(named).drop("message")


@query(
    "b10_load_checked",
    """SELECT sample_id, 'issue' AS level, 'missing_spatial_metadata' AS code FROM obs GROUP BY 1
UNION ALL SELECT sample_id, 'warning', 'low_totals' FROM totals GROUP BY 1 HAVING max(total_counts) < 1000
UNION ALL SELECT sample_id, 'warning', 'high_totals' FROM totals GROUP BY 1 HAVING max(total_counts) > 100000
UNION ALL SELECT sample_id, 'warning', 'all_in_tissue' FROM obs GROUP BY 1 HAVING bool_and(in_tissue)""",
    "obs totals",
)
def _(spark, sf):
    return profile.load_checked(fx.sparse(spark, sf))[1].drop("message")


@query(
    "c1_gene_families",
    """SELECT var_id, gene, starts_with(gene, 'MT-') AS mt, starts_with(gene, 'RPS') OR starts_with(gene, 'RPL') AS ribo,
regexp_matches(gene, '^HB[^(P)]') AS hb FROM var""",
    "var",
)
def _(spark, sf):
    return qc.gene_families(fx.sparse_var(spark, sf)).select("var_id", "gene", "mt", "ribo", "hb")


METRIC_COLUMNS = (
    "total_counts_mt total_counts_ribo total_counts_hb total_counts pct_counts_mt pct_counts_ribo pct_counts_hb"
)


@query(
    "c2_spot_metrics",
    f"SELECT sample_id, obs_id, n_genes_by_counts, {rs(METRIC_COLUMNS)} FROM metrics",
    "metrics",
)
def _(spark, sf):
    return rounded(metrics(spark, sf).select("sample_id", "obs_id", "n_genes_by_counts", *METRIC_COLUMNS.split()))


@query(
    "c3_gene_metrics",
    f"""SELECT var_id, count(*) FILTER (WHERE x > 0) AS n_cells_by_counts, {r('sum(x)', 'total_counts')},
{r('avg(x)', 'mean_counts')}, {r('100.0 * avg((x <= 0)::INT)', 'pct_dropout_by_counts')},
{r('ln(1 + avg(x))', 'log1p_mean_counts')} FROM dense GROUP BY 1""",
    "dense",
)
def _(spark, sf):
    d = fx.sparse(spark, sf)
    out = qc.gene_metrics(d.obs, d.var, d.counts, log_variants=True)
    return rounded(
        out.select("var_id", "n_cells_by_counts", "total_counts", "mean_counts", "pct_dropout_by_counts", "log1p_mean_counts")
    )


def _top(n: int) -> str:
    expr = f"100.0 * sum(x) FILTER (WHERE k <= {n}) / nullif(sum(x), 0)"
    return r(f"CASE WHEN count(*) >= {n} THEN {expr} END", f"pct_counts_in_top_{n}_genes")


@query(
    "c4_top_gene_share",
    f"""SELECT sample_id, obs_id, {', '.join(_top(n) for n in qc.TOP_SIZES)}
FROM (SELECT *, row_number() OVER (PARTITION BY obs_id ORDER BY x DESC, var_id) AS k FROM dense) GROUP BY 1, 2""",
    "dense",
)
def _(spark, sf):
    d = fx.sparse(spark, sf)
    return rounded(qc.top_gene_share(d.obs.select("sample_id", "obs_id"), d.var, d.counts))


@query(
    "c5_log_metrics",
    f"""SELECT sample_id, obs_id, {r('ln(1 + total_counts)', 'log1p_total_counts')},
{r('ln(1 + n_genes_by_counts)', 'log1p_n_genes_by_counts')} FROM totals""",
    "totals",
)
def _(spark, sf):
    out = metrics(spark, sf, families=(), log_variants=True)
    return rounded(out.select("sample_id", "obs_id", "log1p_total_counts", "log1p_n_genes_by_counts"))


CENTRE = """centre AS (SELECT obs.*, sqrt((px - cx) * (px - cx) + (py - cy) * (py - cy)) AS distance_to_center
  FROM obs JOIN (SELECT sample_id, avg(px) AS cx, avg(py) AS cy FROM obs GROUP BY 1) USING (sample_id))"""


@query(
    "c6_centre_distance",
    f"WITH {CENTRE} SELECT sample_id, obs_id, {r('distance_to_center')} FROM centre",
    "obs",
)
def _(spark, sf):
    return rounded(qc.centre_distance(fx.sparse_obs(spark, sf)).select("sample_id", "obs_id", "distance_to_center"))


@query(
    "c7_local_density",
    f"""WITH {CENTRE}, radius AS (SELECT sample_id, quantile_cont(distance_to_center, 0.1) AS rad FROM centre GROUP BY 1)
SELECT a.sample_id, a.obs_id, count(b.obs_id) AS local_density FROM obs a JOIN radius USING (sample_id)
LEFT JOIN obs b ON a.sample_id = b.sample_id AND a.obs_id <> b.obs_id
  AND sqrt((a.px - b.px) * (a.px - b.px) + (a.py - b.py) * (a.py - b.py)) < rad GROUP BY 1, 2""",
    "obs",
)
def _(spark, sf):
    return qc.local_density(fx.sparse_obs(spark, sf)).select("sample_id", "obs_id", "local_density")


SUMMARY = """quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q75,
avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, max(value) AS max"""


@query(
    "c8_metric_summary",
    f"""WITH long AS (UNPIVOT (SELECT sample_id, total_counts, n_genes_by_counts::DOUBLE AS n_genes_by_counts,
  total_counts_mt, pct_counts_mt, total_counts_ribo, pct_counts_ribo, total_counts_hb, pct_counts_hb FROM metrics)
  ON COLUMNS(* EXCLUDE sample_id) INTO NAME metric VALUE value)
SELECT sample_id, metric, {rs('q25 median q75 mean std min max')}
FROM (SELECT sample_id, metric, {SUMMARY} FROM long GROUP BY 1, 2)""",
    "metrics",
)
def _(spark, sf):
    return rounded(qc.metric_summary(metrics(spark, sf)))


def _mad(c: str, low: bool = True) -> str:
    med = f"(median({c}) OVER (PARTITION BY sample_id))"
    return f"{c}, {med} AS med_{c}"


MAD_COLUMNS = ("total_counts", "n_genes_by_counts", "pct_counts_mt")


@query(
    "c9_mad_outliers",
    f"""WITH med AS (SELECT sample_id, {', '.join(f'median({c}) AS m_{c}' for c in MAD_COLUMNS)} FROM metrics GROUP BY 1),
mad AS (SELECT sample_id, {', '.join(f'median(abs({c} - m_{c})) AS d_{c}' for c in MAD_COLUMNS)}
  FROM metrics JOIN med USING (sample_id) GROUP BY 1)
SELECT sample_id, obs_id,
total_counts < m_total_counts - 3 * d_total_counts OR total_counts > m_total_counts + 3 * d_total_counts
  AS outlier_total_counts,
n_genes_by_counts < m_n_genes_by_counts - 3 * d_n_genes_by_counts
  OR n_genes_by_counts > m_n_genes_by_counts + 3 * d_n_genes_by_counts AS outlier_n_genes_by_counts,
coalesce(pct_counts_mt > m_pct_counts_mt + 3 * d_pct_counts_mt, false) AS outlier_pct_counts_mt
FROM metrics JOIN med USING (sample_id) JOIN mad USING (sample_id)""",
    "metrics",
)
def _(spark, sf):
    out = qc.mad_outliers(metrics(spark, sf))
    return out.select("sample_id", "obs_id", *[f"outlier_{c}" for c in MAD_COLUMNS])


PASS = "in_tissue AND total_counts >= 200 AND total_counts <= 2000 AND n_genes_by_counts >= 10 AND pct_counts_mt <= 25.0"


@query(
    "c10_filter_cascade",
    f"""SELECT sample_id, count(*) AS initial_spots, count(*) FILTER (WHERE in_tissue) AS after_tissue,
count(*) FILTER (WHERE in_tissue AND total_counts >= 200) AS after_min_counts,
count(*) FILTER (WHERE in_tissue AND total_counts >= 200 AND total_counts <= 2000) AS after_max_counts,
count(*) FILTER (WHERE in_tissue AND total_counts >= 200 AND total_counts <= 2000 AND n_genes_by_counts >= 10) AS after_min_genes,
count(*) FILTER (WHERE {PASS}) AS after_mt_filter, count(*) FILTER (WHERE {PASS}) AS final_spots,
count(*) - count(*) FILTER (WHERE {PASS}) AS spots_removed,
{r(f'count(*) FILTER (WHERE {PASS}) / count(*)::DOUBLE', 'retention_rate')} FROM metrics GROUP BY 1""",
    "metrics",
)
def _(spark, sf):
    return rounded(qc.filter_cascade(metrics(spark, sf), **LIMITS))


@query(
    "c10_max_genes",
    f"""SELECT sample_id, count(*) AS initial_spots, count(*) FILTER (WHERE in_tissue) AS after_tissue,
count(*) FILTER (WHERE in_tissue AND n_genes_by_counts <= {MAX_GENES}) AS after_max_genes,
count(*) FILTER (WHERE in_tissue AND n_genes_by_counts <= {MAX_GENES}) AS final_spots,
count(*) - count(*) FILTER (WHERE in_tissue AND n_genes_by_counts <= {MAX_GENES}) AS spots_removed,
{r(f'count(*) FILTER (WHERE in_tissue AND n_genes_by_counts <= {MAX_GENES}) / count(*)::DOUBLE', 'retention_rate')} FROM metrics GROUP BY 1""",
    "metrics",
)
def _(spark, sf):
    return rounded(qc.filter_cascade(metrics(spark, sf), max_genes=MAX_GENES))


@query("c10_filtered_spots", f"SELECT sample_id, obs_id, total_counts FROM metrics WHERE {PASS}", "metrics")
def _(spark, sf):
    return qc.filter_spots(metrics(spark, sf), **LIMITS).select("sample_id", "obs_id", "total_counts")


@query(
    "c11_filter_genes",
    f"""SELECT var_id, gene FROM var WHERE var_id IN (SELECT var_id FROM dense GROUP BY 1
HAVING count(*) FILTER (WHERE x > 0) >= {MIN_CELLS} AND sum(x) >= 1)""",
    "var dense",
)
def _(spark, sf):
    d = fx.sparse(spark, sf)
    return qc.filter_genes(d.var, d.counts, MIN_CELLS).select("var_id", "gene")


@query(
    "c13_tissue_split",
    f"""SELECT sample_id, in_tissue, count(*) AS n_spots, {r('avg(total_counts)', 'mean_counts')},
{r('avg(n_genes_by_counts)', 'mean_genes')} FROM metrics GROUP BY 1, 2""",
    "metrics",
)
def _(spark, sf):
    return rounded(qc.tissue_split(metrics(spark, sf)))


@query(
    "c13_tissue_histogram",
    f"""WITH lim AS (SELECT in_tissue, min(total_counts) AS lo, (max(total_counts) - min(total_counts)) / 50.0::DOUBLE AS w
  FROM metrics GROUP BY 1),
c AS (SELECT in_tissue, least(floor((total_counts - lo) / w), 49)::INT AS bin, count(*) AS n
  FROM metrics JOIN lim USING (in_tissue) GROUP BY 1, 2)
SELECT in_tissue, bin::INT AS bin, {r('lo + w * bin', '"left"')}, {r('lo + w * (bin + 1)', '"right"')}, coalesce(n, 0) AS n
FROM (SELECT *, unnest(generate_series(0, 49)) AS bin FROM lim) LEFT JOIN c USING (in_tissue, bin)""",
    "metrics",
)
def _(spark, sf):
    return rounded(plotdata.histogram(metrics(spark, sf), "total_counts", ["in_tissue"]))
