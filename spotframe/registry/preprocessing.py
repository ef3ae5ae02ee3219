"""Queries over normalisation, variable genes, scaling and components."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions.storage import stable
from ..operators import normalise, reduction, variable_genes
from ..sources.names import unique_names
from .core import query, r, rounded, rs

MAX_FRACTION = 0.15
N_TOP = 200


def log_layer(spark, sf):
    d = fx.sparse(spark, sf)
    return d, normalise.log_layer(d.counts)


def ranger(spark, sf):
    """Dataset, log layer and the gene table with the 200 most variable genes."""
    d, logs = log_layer(spark, sf)
    logs = stable(logs)
    return d, logs, stable(variable_genes.hvg_cell_ranger(logs, d.obs, d.var, N_TOP))


@query(
    "a2_unique_names",
    """SELECT var_id, CASE WHEN k = 1 THEN gene_dup ELSE gene_dup || '-' || (k - 1) END AS gene_unique
FROM (SELECT *, row_number() OVER (PARTITION BY gene_dup ORDER BY var_id) AS k FROM var)""",
    "var",
)
def _(spark, sf):
    return unique_names(fx.sparse_var(spark, sf), "gene_dup").select("var_id", "gene_unique")


NORMALISED = f"""he AS (SELECT DISTINCT sample_id, var_id FROM (SELECT *, sum(x) OVER (PARTITION BY obs_id) AS t FROM counts)
  WHERE x > {MAX_FRACTION} * t),
sizes AS (SELECT obs_id, sum(CASE WHEN he.var_id IS NULL THEN x ELSE 0 END) AS size
  FROM counts c LEFT JOIN he USING (sample_id, var_id) GROUP BY 1),
norm AS (SELECT sample_id, obs_id, var_id, x AS x_raw,
  x / CASE WHEN size = 0 THEN 1 ELSE size / 10000.0::DOUBLE END AS x FROM counts JOIN sizes USING (obs_id))"""


@query(
    "a3_raw_snapshot",
    f"WITH {NORMALISED} SELECT sample_id, obs_id, var_id, {rs('x x_raw')} FROM norm",
    "counts",
)
def _(spark, sf):
    d = fx.sparse(spark, sf)
    out = normalise.normalize_total(normalise.keep_raw(d.counts), max_fraction=MAX_FRACTION)
    return rounded(out.select("sample_id", "obs_id", "var_id", "x", "x_raw"))


@query("d1_normalize_total", f"WITH {NORMALISED} SELECT sample_id, obs_id, var_id, {rs('x')} FROM norm", "counts")
def _(spark, sf):
    d = fx.sparse(spark, sf)
    return rounded(normalise.normalize_total(d.counts, max_fraction=MAX_FRACTION))


@query(
    "d1_normalize_median",
    f"""WITH t AS (SELECT sample_id, obs_id, sum(x) AS size FROM counts GROUP BY 1, 2),
m AS (SELECT sample_id, median(size) AS target FROM t WHERE size > 0 GROUP BY 1)
SELECT sample_id, obs_id, var_id, {r('x / (size / target)', 'x')} FROM counts JOIN t USING (sample_id, obs_id)
JOIN m USING (sample_id)""",
    "counts",
)
def _(spark, sf):
    d = fx.sparse(spark, sf)
    return rounded(normalise.normalize_total(d.counts, target_sum=None, exclude_highly_expressed=False))


STATS = ", ".join(r(f"{f}(t)", n) for f, n in (("avg", "mean"), ("stddev_pop", "std"), ("min", "min"), ("max", "max")))


@query(
    "d2_total_stats",
    f"""WITH {NORMALISED}, b AS (SELECT o.sample_id, o.obs_id, coalesce(sum(x_raw), 0) AS before, coalesce(sum(x), 0) AS after
  FROM obs o LEFT JOIN norm USING (sample_id, obs_id) GROUP BY 1, 2)
SELECT sample_id, 'before' AS stage, {STATS} FROM (SELECT sample_id, before AS t FROM b) GROUP BY 1
UNION ALL SELECT sample_id, 'after', {STATS} FROM (SELECT sample_id, after AS t FROM b) GROUP BY 1""",
    "obs counts",
)
def _(spark, sf):
    d = fx.sparse(spark, sf)
    after = normalise.normalize_total(d.counts, max_fraction=MAX_FRACTION)
    stages = [
        normalise.total_stats(d.obs, c).withColumn("stage", F.lit(n)) for n, c in (("before", d.counts), ("after", after))
    ]
    return rounded(stages[0].unionByName(stages[1]))


@query("d3_log1p", f"SELECT sample_id, obs_id, var_id, {rs('x')} FROM logs", "logs")
def _(spark, sf):
    return rounded(log_layer(spark, sf)[1])


@query("d3_log1p_base2", f"SELECT sample_id, obs_id, var_id, {r('ln(1 + x) / ln(2.0)', 'x')} FROM counts", "counts")
def _(spark, sf):
    return rounded(normalise.log1p(fx.sparse(spark, sf).counts, base=2.0))


VALUE_STATS = (
    f"{r('min(x) FILTER (WHERE x <> 0)', 'min_nonzero')}, {r('min(x)', 'min')}, {r('max(x)', 'max')}, "
    f"{r('avg(x) FILTER (WHERE x <> 0)', 'mean_nonzero')}, {r('avg(x)', 'mean')}"
)


@query("d4_value_stats", f"SELECT sample_id, {VALUE_STATS} FROM logs GROUP BY 1", "logs")
def _(spark, sf):
    return rounded(normalise.value_stats(log_layer(spark, sf)[1]))


@query(
    "d5_hvg_seurat",
    f"""WITH g AS (SELECT var_id, CASE WHEN avg(exp(x) - 1) = 0 THEN 1e-12 ELSE avg(exp(x) - 1) END AS m,
  var_samp(exp(x) - 1) AS v FROM dense_log GROUP BY 1),
d AS (SELECT var_id, ln(1 + m) AS mean, CASE WHEN v > 0 THEN ln(v / m) END AS disp FROM g),
b AS (SELECT *, greatest(least(coalesce(ceil((mean - (SELECT min(mean) FROM d)) * 20 / nullif((SELECT max(mean) - min(mean)
  FROM d), 0)), 1), 20), 1)::INT AS bin FROM d),
z AS (SELECT *, CASE WHEN disp IS NULL THEN 0 WHEN count(disp) OVER w = 1 THEN 1
  ELSE coalesce((disp - avg(disp) OVER w) / nullif(stddev_samp(disp) OVER w, 0), 0) END AS score
  FROM b WINDOW w AS (PARTITION BY bin))
SELECT var_id, {rs('mean disp score')}, mean > 0.0125 AND mean < 3.0 AND score > 0.5 AS highly_variable FROM z""",
    "dense_log",
)
def _(spark, sf):
    d, logs = log_layer(spark, sf)
    return rounded(variable_genes.hvg_seurat(logs, d.obs, d.var))


@query("d6_hvg_seurat_v3")
def _(spark, sf):
    d = fx.sparse(spark, sf)
    return rounded(variable_genes.hvg_seurat_v3(d.counts, d.obs, d.var, N_TOP))


@query("d7_hvg_cell_ranger", f"SELECT var_id, {rs('mean disp score')}, highly_variable FROM ranger", "ranger")
def _(spark, sf):
    d, logs = log_layer(spark, sf)
    return rounded(variable_genes.hvg_cell_ranger(logs, d.obs, d.var, N_TOP))


@query(
    "d8_hvg_stats",
    f"""SELECT count(*) FILTER (WHERE highly_variable) AS n_hvg,
{r('avg(highly_variable::INT)', 'hvg_fraction')}, count(*) AS total_genes FROM ranger""",
    "ranger",
)
def _(spark, sf):
    return rounded(variable_genes.hvg_stats(ranger(spark, sf)[2]))


SCALED = """sel AS (SELECT d.* FROM dense_log d JOIN ranger USING (var_id) WHERE highly_variable),
scaled AS (SELECT sample_id, obs_id, var_id, x, least(greatest((x - avg(x) OVER g) /
  coalesce(nullif(stddev_samp(x) OVER g, 0), 1), -10), 10) AS z FROM sel WINDOW g AS (PARTITION BY var_id))"""


@query("d9_scale", f"WITH {SCALED} SELECT sample_id, obs_id, var_id, {rs('z')} FROM scaled", "dense_log ranger")
def _(spark, sf):
    d, logs, genes = ranger(spark, sf)
    vectors, factors = reduction.scaled_spots(logs, d.obs, genes.where("highly_variable"))
    return rounded(reduction.scaled_cells(vectors, factors))


@query(
    "d9_scale_stats",
    f"""WITH {SCALED}
SELECT 'before' AS stage, {STATS} FROM (SELECT x AS t FROM scaled)
UNION ALL SELECT 'after', {STATS} FROM (SELECT z AS t FROM scaled)""",
    "dense_log ranger",
)
def _(spark, sf):
    d, logs, genes = ranger(spark, sf)
    vectors, factors = reduction.scaled_spots(logs, d.obs, genes.where("highly_variable"))
    plain = reduction.dense_spots(logs, d.obs, factors.select("var_id", "pos"))
    stages = [
        reduction.block_stats(v).withColumn("stage", F.lit(n)) for n, v in (("before", plain), ("after", vectors))
    ]
    return rounded(stages[0].unionByName(stages[1]))


@query("d10_pca_scores")
def _(spark, sf):
    d = fx.signed(spark, sf)
    return rounded(reduction.pca(d.counts, d.obs, d.var, 10)[0])


@query("d10_pca_loadings")
def _(spark, sf):
    d = fx.signed(spark, sf)
    return rounded(reduction.pca(d.counts, d.obs, d.var, 10)[1])


@query(
    "d10_pca_checks",
    f"""SELECT 'loadings' AS item, a, b, (a = b)::INT::DOUBLE AS value
FROM generate_series(0, 63) s(a) CROSS JOIN generate_series(0, 63) t(b)
UNION ALL SELECT 'scores', a, b, (a = b)::INT::DOUBLE FROM generate_series(0, 9) s(a) CROSS JOIN generate_series(0, 9) t(b)
UNION ALL SELECT 'means', a, 0, 0.0 FROM generate_series(0, 63) s(a)
UNION ALL SELECT 'total_variance', 0, 0, {r('sum(v)', 'value', 4)} FROM (SELECT var_samp(x) AS v FROM signed_counts GROUP BY var_id)""",
    "signed_obs signed_counts",
)
def _(spark, sf):
    """All components: loadings orthonormal, scores centred and uncorrelated, their variances the trace of the covariance."""
    d = fx.signed(spark, sf)
    scores, loadings, variance = reduction.pca(d.counts, d.obs, d.var, 64)

    def row(item, a, b, value, digits=6):
        # Adding zero turns a negative zero into a plain one.
        return [F.lit(item).alias("item"), a.cast("long").alias("a"), b.cast("long").alias("b"), (F.round(value, digits) + 0.0).alias("value")]

    pc, zero = F.col("pc"), F.lit(0)
    other = loadings.select("var_id", F.col("pc").alias("pc_b"), F.col("loading").alias("loading_b"))
    dots = loadings.join(other, "var_id").groupBy("pc", "pc_b").agg(F.sum(F.col("loading") * F.col("loading_b")).alias("v"))
    cells = stable(scores.select("obs_id", F.posexplode("pcs").alias("pc", "v")))
    first = cells.where(pc < 10)
    pairs = first.join(first.toDF("obs_id", "pc_b", "v_b"), "obs_id").groupBy("pc", "pc_b").agg(F.corr("v", "v_b").alias("v"))
    means = cells.groupBy("pc").agg(F.avg("v").alias("v"))
    total = variance.agg(F.sum("variance").alias("v"))
    return (
        dots.select(*row("loadings", pc, F.col("pc_b"), F.col("v")))
        .unionByName(pairs.select(*row("scores", pc, F.col("pc_b"), F.col("v"))))
        .unionByName(means.select(*row("means", pc, zero, F.col("v"))))
        .unionByName(total.select(*row("total_variance", zero, zero, F.col("v"), 4)))
    )


@query(
    "d10_randomised_checks",
    f"""SELECT 'loadings' AS item, a, b, (a = b)::INT::DOUBLE AS value
FROM generate_series(0, 19) s(a) CROSS JOIN generate_series(0, 19) t(b)
UNION ALL SELECT 'scores', a, b, (a = b)::INT::DOUBLE FROM generate_series(0, 19) s(a) CROSS JOIN generate_series(0, 19) t(b)
UNION ALL SELECT kind, a, 0, 0.0 FROM generate_series(0, 19) s(a) CROSS JOIN (VALUES ('means'), ('variances'), ('axes')) t(kind)
UNION ALL SELECT 'total_variance', 0, 0, {r('sum(v)', 'value', 4)} FROM (SELECT var_samp(x) AS v FROM dense_log GROUP BY var_id)""",
    "dense_log",
)
def _(spark, sf):
    """All genes, 20 components: orthonormal loadings, scores centred and uncorrelated, and each an axis of the covariance.

    The last is looked up apart from the search: the covariance of every gene with a component's scores is its loading
    times the component's variance, and the total follows from each component's share.
    """
    d, logs = log_layer(spark, sf)
    logs = stable(logs)
    scores, loadings, variance = reduction.pca(logs, d.obs, d.var, 20, solver="randomized")
    loadings, variance = stable(loadings), stable(variance)
    cells = stable(scores.select("obs_id", F.posexplode("pcs").alias("pc", "v")))
    pc, zero = F.col("pc"), F.lit(0)

    def row(item, a, b, value, digits=6):
        return [F.lit(item).alias("item"), a.cast("long").alias("a"), b.cast("long").alias("b"), (F.round(value, digits) + 0.0).alias("value")]

    other = loadings.select("var_id", F.col("pc").alias("pc_b"), F.col("loading").alias("loading_b"))
    dots = loadings.join(other, "var_id").groupBy("pc", "pc_b").agg(F.sum(F.col("loading") * F.col("loading_b")).alias("v"))
    pairs = cells.join(cells.toDF("obs_id", "pc_b", "v_b"), "obs_id").groupBy("pc", "pc_b").agg(F.corr("v", "v_b").alias("v"))
    spread = cells.groupBy("pc").agg(F.avg("v").alias("mean"), F.var_samp("v").alias("seen"))
    spread = spread.join(variance, "pc").withColumn("off", F.col("seen") / F.col("variance") - 1)
    n = d.obs.agg(F.count(F.lit(1))).scalar()
    # Scores have mean 0, so zeros of a gene add nothing to its products with them.
    products = logs.join(cells, "obs_id").groupBy("var_id", "pc").agg((F.sum(F.col("x") * F.col("v")) / (n - 1)).alias("cov"))
    largest = variance.agg(F.max("variance")).scalar()
    axes = loadings.join(products, ["var_id", "pc"], "left").join(variance, "pc")
    gap = F.coalesce("cov", F.lit(0.0)) - F.col("loading") * F.col("variance")
    axes = axes.groupBy("pc").agg((F.max(F.abs(gap)) / largest).alias("v"))
    total = variance.where(pc == 0).select((F.col("variance") / F.col("ratio")).alias("v"))
    return (
        dots.select(*row("loadings", pc, F.col("pc_b"), F.col("v")))
        .unionByName(pairs.select(*row("scores", pc, F.col("pc_b"), F.col("v"), 4)))
        .unionByName(spread.select(*row("means", pc, zero, F.col("mean"))))
        .unionByName(spread.select(*row("variances", pc, zero, F.col("off"))))
        .unionByName(axes.select(*row("axes", pc, zero, F.col("v"), 5)))
        .unionByName(total.select(*row("total_variance", zero, zero, F.col("v"), 4)))
    )


@query(
    "d11_variance_checks",
    f"""SELECT 200 AS n_components, {r('sum(v)', 'total_variance', 5)}, 1.0::DOUBLE AS ratio_sum, 0 AS n_rising, 1.0::DOUBLE AS last_cumulative
FROM (SELECT var_samp(x) AS v FROM dense_log JOIN ranger USING (var_id) WHERE highly_variable GROUP BY var_id)""",
    "dense_log ranger",
)
def _(spark, sf):
    """All components: variances add up to the trace, ratios to 1, and neither ever rises."""
    d, logs, genes = ranger(spark, sf)
    found = stable(reduction.variance_table(reduction.pca(logs, d.obs, genes.where("highly_variable"), 200)[2]))
    after = found.select((F.col("pc") - 1).alias("pc"), F.col("ratio").alias("next"))
    rising = found.join(after, "pc").agg(F.count_if(F.col("next") > F.col("ratio") + 1e-12).alias("n_rising"))
    sums = found.agg(
        F.count(F.lit(1)).alias("n_components"),
        F.round(F.sum("variance"), 5).alias("total_variance"),
        F.round(F.sum("ratio"), 6).alias("ratio_sum"),
        F.round(F.max("cumulative"), 6).alias("last_cumulative"),
    )
    return sums.withColumn("n_rising", rising.scalar())


@query("d11_variance_table")
def _(spark, sf):
    d, logs, genes = ranger(spark, sf)
    return rounded(reduction.variance_table(reduction.pca(logs, d.obs, genes.where("highly_variable"), 50)[2]))


@query("d11_variance_sums")
def _(spark, sf):
    d, logs, genes = ranger(spark, sf)
    return rounded(reduction.variance_sums(reduction.pca(logs, d.obs, genes.where("highly_variable"), 50)[2]))


@query(
    "g4_default_genes",
    "SELECT var_id FROM (SELECT var_id, var_pop(x) AS v FROM dense_log GROUP BY 1) ORDER BY v DESC, var_id LIMIT 100",
    "dense_log",
)
def _(spark, sf):
    d, logs = log_layer(spark, sf)
    return variable_genes.default_genes(None, logs, d.obs)


@query(
    "g4_first_variable_genes",
    "SELECT var_id FROM ranger WHERE highly_variable ORDER BY var_id LIMIT 100",
    "ranger",
)
def _(spark, sf):
    d, logs, genes = ranger(spark, sf)
    return variable_genes.default_genes(genes, logs, d.obs)
