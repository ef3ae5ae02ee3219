"""Registration of named queries with their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, tables: str = ""):
    """Register a query; ``tables`` names the fixture CTEs its SQL reads."""

    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_tables(tables, sql)
        return fn

    return wrap


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison, since sums depend on the order of addition."""
    kinds = dict(df.dtypes)
    return df.select(*[F.round(c, digits).alias(c) if kinds[c] == "double" else F.col(c) for c in df.columns])


# The fixture tables in SQL, each listed with the ones it reads.
CTES: dict[str, tuple[str, str]] = {
    "obs": (
        "",
        """SELECT n_regionkey::VARCHAR AS sample_id, c_custkey AS obs_id, c_mktsegment AS cluster,
  (c_nationkey % 8 <> 0) AS in_tissue, (c_custkey // 40)::INT AS array_row,
  (2 * (c_custkey % 40) + (c_custkey // 40) % 2)::INT AS array_col,
  c_acctbal / 100.0::DOUBLE AS px, ((c_custkey * 7919) % 10007) / 100.0::DOUBLE AS py
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "var": (
        "",
        """SELECT p_partkey AS var_id, p_name AS gene_dup, p_brand AS brand,
  CASE p_type WHEN 'ECONOMY' THEN 'MT-' WHEN 'PROMO' THEN 'RPS' WHEN 'STANDARD' THEN 'RPL'
    WHEN 'SMALL' THEN 'HBA' WHEN 'LARGE' THEN 'HBP' ELSE 'GENE_' END || p_partkey AS gene
FROM part""",
    ),
    "counts": (
        "obs",
        """SELECT sample_id, obs_id, var_id, x FROM (
  SELECT o_custkey AS obs_id, l_partkey AS var_id, sum(l_quantity)::DOUBLE AS x
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2) JOIN obs USING (obs_id)""",
    ),
    "named": (
        "var",
        """SELECT var_id, brand, CASE WHEN k = 1 THEN gene_dup ELSE gene_dup || '-' || (k - 1) END AS gene
FROM (SELECT *, row_number() OVER (PARTITION BY gene_dup ORDER BY var_id) AS k FROM var)""",
    ),
    "panels": (
        "named",
        """SELECT 'fixture' AS tissue, brand AS panel, var_id AS ord, gene FROM named
UNION ALL SELECT DISTINCT 'fixture', brand, 0, 'MISSING_' || brand FROM named
UNION ALL SELECT 'fixture', 'absent', 0, 'MISSING_absent'""",
    ),
    "flags": (
        "var",
        """SELECT var_id, starts_with(gene, 'MT-') AS mt, starts_with(gene, 'RPS') OR starts_with(gene, 'RPL') AS ribo,
  regexp_matches(gene, '^HB[^(P)]') AS hb FROM var""",
    ),
    "dense": (
        "obs var counts",
        """SELECT o.sample_id, o.obs_id, o.cluster, v.var_id, coalesce(c.x, 0.0) AS x
FROM obs o CROSS JOIN var v LEFT JOIN counts c ON c.obs_id = o.obs_id AND c.var_id = v.var_id""",
    ),
    "totals": (
        "dense",
        "SELECT sample_id, obs_id, sum(x) AS total_counts, count(*) FILTER (WHERE x > 0) AS n_genes_by_counts "
        "FROM dense GROUP BY ALL",
    ),
    "metrics": (
        "obs dense flags",
        """SELECT o.*, m.* EXCLUDE (sid, oid), 100.0 * total_counts_mt / nullif(total_counts, 0) AS pct_counts_mt,
  100.0 * total_counts_ribo / nullif(total_counts, 0) AS pct_counts_ribo,
  100.0 * total_counts_hb / nullif(total_counts, 0) AS pct_counts_hb
FROM obs o JOIN (SELECT d.sample_id AS sid, obs_id AS oid, sum(x) AS total_counts,
  count(*) FILTER (WHERE x > 0) AS n_genes_by_counts,
  coalesce(sum(x) FILTER (WHERE mt), 0) AS total_counts_mt, coalesce(sum(x) FILTER (WHERE ribo), 0) AS total_counts_ribo,
  coalesce(sum(x) FILTER (WHERE hb), 0) AS total_counts_hb
  FROM dense d JOIN flags USING (var_id) GROUP BY ALL) m ON o.obs_id = m.oid""",
    ),
    # Plain normalisation to 10,000 and log1p of every stored value.
    "logs": (
        "counts",
        "SELECT sample_id, obs_id, var_id, ln(1.0 + x / (sum(x) OVER (PARTITION BY obs_id) / 10000.0)) AS x FROM counts",
    ),
    "dense_log": (
        "obs var logs",
        """SELECT o.sample_id, o.obs_id, o.cluster, v.var_id, coalesce(c.x, 0.0) AS x
FROM obs o CROSS JOIN var v LEFT JOIN logs c ON c.obs_id = o.obs_id AND c.var_id = v.var_id""",
    ),
    "signed_obs": (
        "",
        """SELECT '0' AS sample_id, vec_id AS obs_id, label::VARCHAR AS cluster,
  embedding[1]::DOUBLE * 100 AS px, embedding[2]::DOUBLE * 100 AS py FROM embeddings""",
    ),
    "signed_counts": (
        "",
        """SELECT '0' AS sample_id, vec_id AS obs_id, unnest(generate_series(0, len(embedding) - 1)) AS var_id,
  unnest(embedding)::DOUBLE AS x FROM embeddings""",
    ),
    "metric": ("", "SELECT event_id AS obs_id, event_type AS cluster, value AS x FROM events"),
    # Variable genes by percentile-binned dispersion, 200 of them.
    "ranger_scores": (
        "dense_log",
        """WITH g AS (SELECT var_id, CASE WHEN avg(exp(x) - 1) = 0 THEN 1e-12 ELSE avg(exp(x) - 1) END AS mean,
    var_samp(exp(x) - 1) AS v FROM dense_log GROUP BY 1),
  d AS (SELECT var_id, mean, v / mean AS disp FROM g),
  e AS (SELECT unnest(quantile_cont(mean, [p / 100.0 FOR p IN range(10, 105, 5)])) AS edge FROM d),
  b AS (SELECT d.*, (SELECT count(*) FROM e WHERE edge < d.mean) AS bin FROM d),
  m AS (SELECT *, median(disp) OVER (PARTITION BY bin) AS med FROM b)
SELECT *, (disp - med) / nullif(median(abs(disp - med)) OVER (PARTITION BY bin) / 0.6744897501960817, 0) AS score FROM m""",
    ),
    "ranger": (
        "ranger_scores",
        """SELECT var_id, mean, disp, score, coalesce(score >= (SELECT min(score) FROM (
  SELECT score FROM ranger_scores WHERE score IS NOT NULL ORDER BY score DESC LIMIT 200)), false) AS highly_variable
FROM ranger_scores""",
    ),
    "neighbours": (
        "obs",
        """SELECT sample_id, src, dst, distance, rank FROM (
  SELECT a.sample_id, a.obs_id AS src, b.obs_id AS dst,
    sqrt((a.px - b.px) * (a.px - b.px) + (a.py - b.py) * (a.py - b.py)) AS distance,
    row_number() OVER (PARTITION BY a.sample_id, a.obs_id ORDER BY
      sqrt((a.px - b.px) * (a.px - b.px) + (a.py - b.py) * (a.py - b.py)), b.obs_id) AS rank
  FROM obs a JOIN obs b ON a.sample_id = b.sample_id AND a.obs_id <> b.obs_id) WHERE rank <= 10""",
    ),
}


def with_tables(names: str, sql: str) -> str:
    """Prefix ``sql`` with the named fixture CTEs and those they read."""
    order: list[str] = []

    def visit(name: str) -> None:
        for needed in CTES[name][0].split():
            visit(needed)
        if name not in order:
            order.append(name)

    for name in names.split():
        visit(name)
    if not order:
        return sql
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n][1]})" for n in order)
    # A query that brings CTEs of its own continues the list.
    body = sql.lstrip()
    joiner = ",\n" + body[5:] if body.upper().startswith("WITH ") else "\n" + body
    return f"WITH {ctes}{joiner}"


def normal_tail(z: str) -> str:
    """P(|Z| >= |z|) in SQL, by the positive series of the error function; below rounding beyond 7."""
    return f"""CASE WHEN {z} = 0 THEN 1.0::DOUBLE WHEN abs({z}) > 7 THEN 0.0 WHEN {z} IS NOT NULL THEN
  1 - 2 / sqrt(pi()) * list_sum([exp(-{z} * {z} / 2 + 2 * k * ln(2.0) + (2 * k + 1) * ln(abs({z}) / sqrt(2.0))
    + lgamma(k + 1) - lgamma(2 * k + 2)) FOR k IN range(150)]) END"""


def student_tail(t: str, df: str) -> str:
    """P(|T| >= |t|) in SQL, by the positive series of the incomplete beta function; 1 where t is undefined."""
    y, a = f"({t} * {t} / ({df} + {t} * {t}))", f"({df} / 2)"
    return f"""CASE WHEN {t} = 0 OR {t} IS NULL OR {df} IS NULL THEN 1.0::DOUBLE WHEN abs({t}) > 9 THEN 0.0 ELSE
  1 - list_sum([exp(0.5 * ln{y} + {a} * ln(1 - {y}) + ln(2.0) - lgamma(0.5) - lgamma{a} + lgamma(0.5 + {a} + k)
    - lgamma(1.5 + k) + lgamma(1.5) + k * ln{y}) FOR k IN range(400)]) END"""


def adjusted(p: str, by: str) -> str:
    """Benjamini-Hochberg in SQL over a table with (by, raw), where raw is p times the number of tests over its rank."""
    return f"least(min(raw) OVER (PARTITION BY {by} ORDER BY {p} NULLS LAST, var_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 1.0)"


def raw_adjusted(p: str, by: str) -> str:
    return f"{p} * count({p}) OVER (PARTITION BY {by}) / row_number() OVER (PARTITION BY {by} ORDER BY {p} NULLS LAST, var_id) AS raw"


def r(expr: str, name: str | None = None, digits: int = 6) -> str:
    """Rounded SQL expression under its own or a new name."""
    return f"round({expr}, {digits}) AS {name or expr}"


def rs(names: str) -> str:
    """Rounded list of plain columns."""
    return ", ".join(r(n) for n in names.split())
