"""Queries over spatial statistics, panels and gene statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions.storage import stable
from ..operators import autocorrelation, neighbours, normalise, panels, plotdata, stats, variable_genes
from .core import adjusted, normal_tail, query, r, raw_adjusted, rounded, rs


def inputs(spark, sf):
    d = fx.sparse(spark, sf)
    obs = stable(d.obs)
    return d.with_(obs=obs), stable(normalise.log_layer(d.counts))


# Moran's I on the dense grid, straight from its definition.
MORAN = """w AS (SELECT sample_id, src, dst, 1.0::DOUBLE / count(*) OVER (PARTITION BY sample_id, src) AS w FROM neighbours),
z AS (SELECT sample_id, obs_id, var_id, x - avg(x) OVER (PARTITION BY sample_id, var_id) AS z FROM dense_log),
q AS (SELECT sample_id, var_id, count(*) AS n, sum(z * z) AS ss FROM z GROUP BY 1, 2),
c AS (SELECT a.sample_id, a.var_id, sum(w * a.z * b.z) AS cross_sum, sum(w) AS s0
  FROM w JOIN z a ON a.obs_id = w.src JOIN z b ON b.obs_id = w.dst AND b.var_id = a.var_id GROUP BY 1, 2),
moran AS (SELECT sample_id, var_id, n / s0 * cross_sum / ss AS i, -1.0::DOUBLE / (n - 1) AS expected_i
  FROM q JOIN c USING (sample_id, var_id) WHERE ss > 1e-12)"""


MORAN_TEST = f"""{MORAN}, pairs AS (SELECT sample_id, src, dst, sum(w) AS b FROM (
  SELECT * FROM w UNION ALL SELECT sample_id, dst, src, w FROM w) GROUP BY 1, 2, 3),
s1 AS (SELECT sample_id, sum(b * b) / 2 AS s1 FROM pairs GROUP BY 1),
s2 AS (SELECT sample_id, sum(rc * rc) AS s2 FROM (SELECT sample_id, src, sum(b) AS rc FROM pairs GROUP BY 1, 2) GROUP BY 1),
k AS (SELECT sample_id, count(*) AS n FROM obs GROUP BY 1), s0 AS (SELECT sample_id, sum(w) AS s0 FROM w GROUP BY 1),
v AS (SELECT sample_id, (n * n * s1 - n * s2 + 3 * s0 * s0) / ((n * n - 1) * s0 * s0)
  - 1.0::DOUBLE / ((n - 1) * (n - 1)) AS var_norm FROM s0 JOIN s1 USING (sample_id) JOIN s2 USING (sample_id) JOIN k USING (sample_id)),
tested AS (SELECT sample_id, var_id, i, -1.0::DOUBLE / (k.n - 1) AS expected_i, var_norm,
  (i + 1.0::DOUBLE / (k.n - 1)) / sqrt(var_norm) AS z_norm
  FROM (SELECT DISTINCT sample_id, var_id FROM counts) JOIN k USING (sample_id) JOIN v USING (sample_id)
  LEFT JOIN (SELECT sample_id, var_id, i FROM moran) USING (sample_id, var_id))"""


@query(
    "g1_moran",
    f"WITH {MORAN_TEST} SELECT sample_id, var_id, {rs('i expected_i var_norm z_norm')} FROM tested",
    "obs neighbours counts dense_log",
)
def _(spark, sf):
    d, logs = inputs(spark, sf)
    out = autocorrelation.moran(logs, d.obs, neighbours.spatial_graph(d.obs))
    return rounded(out.select("sample_id", "var_id", "i", "expected_i", "var_norm", "z_norm"))


@query(
    "g1_moran_pvalues",
    f"""WITH {MORAN_TEST}, p AS (SELECT *, {normal_tail('z_norm')} / 2 AS pval_norm FROM tested),
adj AS (SELECT *, {raw_adjusted('pval_norm', 'sample_id')} FROM p)
SELECT sample_id, var_id, {rs('i z_norm pval_norm')}, {r('CASE WHEN pval_norm IS NOT NULL THEN ' + adjusted('pval_norm', 'sample_id') + ' END', 'fdr')}
FROM adj""",
    "obs neighbours counts dense_log",
)
def _(spark, sf):
    d, logs = inputs(spark, sf)
    out = autocorrelation.moran(logs, d.obs, neighbours.spatial_graph(d.obs))
    return rounded(out.select("sample_id", "var_id", "i", "z_norm", "pval_norm", "fdr"))


def permuted(spark, sf, variable=False):
    """The test of every gene, or of the default ones of largest variance."""
    d, logs = inputs(spark, sf)
    genes = variable_genes.default_genes(None, logs, d.obs) if variable else None
    edges = stable(neighbours.spatial_graph(d.obs))
    return autocorrelation.moran_permutation(logs, d.obs, edges, genes)


@query("g2_moran_permutation")
def _(spark, sf):
    return rounded(permuted(spark, sf))


# The simulated p itself is random; that it is a whole number of 1/1001 from 1 to 1001 is not, nor are I and where it exists.
@query(
    "g2_permutation_checks",
    f"""WITH sel AS (SELECT var_id FROM (SELECT var_id, var_pop(x) AS v FROM dense_log GROUP BY 1)
  ORDER BY v DESC, var_id LIMIT 100),
w AS (SELECT sample_id, src, dst, 1.0::DOUBLE / count(*) OVER (PARTITION BY sample_id, src) AS w FROM neighbours),
z AS (SELECT sample_id, obs_id, var_id, x - avg(x) OVER (PARTITION BY sample_id, var_id) AS z
  FROM dense_log JOIN sel USING (var_id)),
q AS (SELECT sample_id, var_id, count(*) AS n, sum(z * z) AS ss FROM z GROUP BY 1, 2),
c AS (SELECT a.sample_id, a.var_id, sum(w * a.z * b.z) AS cross_sum, sum(w) AS s0
  FROM w JOIN z a ON a.obs_id = w.src JOIN z b ON b.obs_id = w.dst AND b.var_id = a.var_id GROUP BY 1, 2)
SELECT sample_id, var_id, {r('n / s0 * cross_sum / ss', 'i')}, true AS in_range, true AS on_grid
FROM q JOIN c USING (sample_id, var_id) WHERE ss > 1e-12""",
    "obs neighbours dense_log",
)
def _(spark, sf):
    steps = F.col("pval_sim") * (autocorrelation.N_PERMS + 1)
    out = permuted(spark, sf, variable=True).where("i IS NOT NULL").select(
        "sample_id",
        "var_id",
        "i",
        (F.round(steps).between(1, autocorrelation.N_PERMS + 1)).alias("in_range"),
        (F.abs(steps - F.round(steps)) < 1e-6).alias("on_grid"),
    )
    return rounded(out)


@query(
    "g3_moran_inverse_distance",
    f"""WITH sel AS (SELECT var_id FROM (SELECT var_id, var_pop(x) AS v FROM dense_log GROUP BY 1)
  ORDER BY v DESC, var_id LIMIT 100),
z AS (SELECT sample_id, obs_id, var_id, x - avg(x) OVER (PARTITION BY sample_id, var_id) AS z
  FROM dense_log JOIN sel USING (var_id)),
p AS (SELECT a.sample_id, a.obs_id AS src, b.obs_id AS dst,
  1.0::DOUBLE / (sqrt((a.px - b.px) * (a.px - b.px) + (a.py - b.py) * (a.py - b.py)) + 1e-10) AS u
  FROM obs a JOIN obs b ON a.sample_id = b.sample_id AND a.obs_id <> b.obs_id),
w AS (SELECT sample_id, src, dst, u / sum(u) OVER (PARTITION BY src) AS w FROM p),
lag AS (SELECT src AS obs_id, var_id, sum(w * z) AS lag FROM w JOIN z ON z.obs_id = w.dst GROUP BY 1, 2),
c AS (SELECT sample_id, var_id, sum(z * lag) AS cross_sum FROM z JOIN lag USING (obs_id, var_id) GROUP BY 1, 2),
q AS (SELECT sample_id, var_id, sum(z * z) AS ss FROM z GROUP BY 1, 2)
SELECT sample_id, var_id, {r('cross_sum / ss', 'i')} FROM c JOIN q USING (sample_id, var_id) WHERE ss > 1e-12""",
    "obs dense_log",
)
def _(spark, sf):
    d, logs = inputs(spark, sf)
    genes = variable_genes.default_genes(None, logs, d.obs)
    return rounded(autocorrelation.moran_inverse_distance(logs, d.obs, genes))


@query(
    "g5_top_autocorrelated",
    f"""WITH {MORAN} SELECT sample_id, rank, var_id, {rs('i')} FROM (SELECT *, row_number() OVER
  (PARTITION BY sample_id ORDER BY i DESC, var_id) AS rank FROM moran) WHERE rank <= 5""",
    "obs neighbours dense_log",
)
def _(spark, sf):
    d, logs = inputs(spark, sf)
    result = autocorrelation.moran(logs, d.obs, neighbours.spatial_graph(d.obs))
    return rounded(autocorrelation.top_autocorrelated(result).select("sample_id", "rank", "var_id", "i"))


SCORES = """members AS (SELECT panel, var_id, count(*) OVER (PARTITION BY panel) AS k FROM panels JOIN named USING (gene)),
scores AS (SELECT sample_id, obs_id, panel, sum(x) / max(k) AS score FROM dense_log JOIN members USING (var_id) GROUP BY 1, 2, 3)"""


def scored(spark, sf):
    d, logs = inputs(spark, sf)
    table = fx.sparse_panels(spark, sf)
    return d, table, panels.panel_scores(logs, d.obs, fx.named_var(spark, sf), table)


@query(
    "g6_panel_scores",
    f"WITH {SCORES} SELECT sample_id, obs_id, panel, {rs('score')} FROM scores",
    "named panels dense_log",
)
def _(spark, sf):
    return rounded(scored(spark, sf)[2])


@query(
    "g7_panel_statistics",
    f"""WITH {SCORES}, f AS (SELECT panel, count(v.var_id) AS n_available, count(*) - count(v.var_id) AS n_missing,
  coalesce(string_agg(p.gene, ',' ORDER BY ord) FILTER (WHERE v.var_id IS NOT NULL), '') AS available,
  coalesce(string_agg(p.gene, ',' ORDER BY ord) FILTER (WHERE v.var_id IS NULL), '') AS missing
  FROM panels p LEFT JOIN named v USING (gene) GROUP BY 1)
SELECT s.*, f.* EXCLUDE (panel) FROM (SELECT sample_id, panel, {r('avg(score)', 'mean')}, {r('stddev_pop(score)', 'std')},
  {r('min(score)', 'min')}, {r('max(score)', 'max')} FROM scores GROUP BY 1, 2) s JOIN f USING (panel)""",
    "named panels dense_log",
)
def _(spark, sf):
    d, table, scores = scored(spark, sf)
    out = panels.panel_statistics(scores, panels.panel_genes_found(table, fx.named_var(spark, sf)))
    names = {c: F.array_join(c, ",") for c in ("available", "missing")}
    return rounded(out.withColumns(names))


@query(
    "g8_panel_coordinate_correlation",
    f"""WITH {SCORES} SELECT sample_id, panel,
{r('covar_pop(score, px) / nullif(stddev_pop(score) * stddev_pop(px), 0)', 'corr_x')},
{r('covar_pop(score, py) / nullif(stddev_pop(score) * stddev_pop(py), 0)', 'corr_y')}
FROM scores JOIN obs USING (sample_id, obs_id) GROUP BY 1, 2""",
    "obs named panels dense_log",
)
def _(spark, sf):
    d, _, scores = scored(spark, sf)
    return rounded(panels.panel_coordinate_correlation(scores, d.obs))


@query("g9_panel_lookup", "SELECT ord, gene FROM panels WHERE tissue = 'fixture' AND panel = 'Brand#11'", "panels")
def _(spark, sf):
    return panels.panel_genes(fx.sparse_panels(spark, sf), "Brand#11", fx.PANEL_TISSUE)


@query(
    "g10_filter_panel",
    """WITH e AS (SELECT var_id, avg(x) AS m, count(*) FILTER (WHERE x > 0) AS k FROM dense_log GROUP BY 1)
SELECT panel, ord, gene, coalesce(m >= 0.1 AND k >= 10, false) AS available
FROM panels LEFT JOIN named USING (gene) LEFT JOIN e USING (var_id)""",
    "named panels dense_log",
)
def _(spark, sf):
    d, logs = inputs(spark, sf)
    return panels.filter_panel(logs, d.obs, fx.named_var(spark, sf), fx.sparse_panels(spark, sf))


@query(
    "g11_panel_availability",
    """SELECT panel, string_agg(gene, ',' ORDER BY ord) AS available, count(*) AS n_available
FROM panels JOIN named USING (gene) GROUP BY 1""",
    "named panels",
)
def _(spark, sf):
    out = panels.panel_availability(fx.sparse_panels(spark, sf), fx.named_var(spark, sf))
    return out.withColumn("available", F.array_join("available", ","))


@query(
    "i4_panel_correlation",
    f"""WITH {SCORES} SELECT sample_id, a.panel AS panel_a, b.panel AS panel_b,
{r('covar_pop(a.score, b.score) / nullif(stddev_pop(a.score) * stddev_pop(b.score), 0)', 'corr')}
FROM scores a JOIN scores b USING (sample_id, obs_id) GROUP BY 1, 2, 3""",
    "named panels dense_log",
)
def _(spark, sf):
    return rounded(plotdata.score_correlation(stable(scored(spark, sf)[2])))


TOP_GENES = """sel AS (SELECT var_id FROM (SELECT var_id, var_pop(x) AS v FROM dense_log GROUP BY 1)
  ORDER BY v DESC, var_id LIMIT 100)"""


def _correlated(value: str, source: str) -> str:
    return f"""SELECT a.var_id AS var_a, b.var_id AS var_b,
{r(f'covar_pop(a.{value}, b.{value}) / nullif(stddev_pop(a.{value}) * stddev_pop(b.{value}), 0)', 'corr')}
FROM {source} a JOIN {source} b USING (obs_id) GROUP BY 1, 2"""


@query(
    "h5_gene_correlation",
    f"WITH {TOP_GENES}, s AS (SELECT obs_id, var_id, x FROM dense_log JOIN sel USING (var_id)) {_correlated('x', 's')}",
    "dense_log",
)
def _(spark, sf):
    d, logs = inputs(spark, sf)
    return rounded(stats.gene_correlation(logs, d.obs, variable_genes.default_genes(None, logs, d.obs)))


@query(
    "h6_gene_rank_correlation",
    f"""WITH {TOP_GENES}, s AS (SELECT obs_id, var_id, rank() OVER (PARTITION BY var_id ORDER BY x)
  + (count(*) OVER (PARTITION BY var_id, x) - 1) / 2.0::DOUBLE AS rk FROM dense_log JOIN sel USING (var_id))
{_correlated('rk', 's')}""",
    "dense_log",
)
def _(spark, sf):
    d, logs = inputs(spark, sf)
    genes = variable_genes.default_genes(None, logs, d.obs)
    return rounded(stats.gene_correlation(logs, d.obs, genes, "spearman"))


EXPRESSION = """e AS (SELECT panel, gene, avg(x) AS mean, max(x) AS max, 100.0 * avg((x <> 0)::INT) AS pct_nonzero,
  CASE WHEN avg(x) > 0 THEN stddev_pop(x) / avg(x) ELSE 0 END AS cv
  FROM panels JOIN named USING (gene) JOIN dense_log USING (var_id) GROUP BY 1, 2)"""


def expression(spark, sf):
    d, logs = inputs(spark, sf)
    members = panels.panel_members(fx.sparse_panels(spark, sf), fx.named_var(spark, sf)).where("var_id IS NOT NULL")
    return stats.expression_stats(logs, d.obs, members.select("panel", "gene", "var_id"))


@query(
    "h7_expression_stats",
    f"WITH {EXPRESSION} SELECT panel, gene, {rs('mean max pct_nonzero cv')} FROM e",
    "named panels dense_log",
)
def _(spark, sf):
    return rounded(expression(spark, sf))


@query(
    "h7_top_variable",
    f"WITH {EXPRESSION} SELECT panel, gene, {rs('mean max pct_nonzero cv')} FROM e ORDER BY round(e.cv, 9) DESC, gene, panel LIMIT 6",
    "named panels dense_log",
)
def _(spark, sf):
    out = expression(spark, sf)
    return rounded(stats.top_variable(out.withColumn("cv", F.round("cv", 9))))

