"""Queries over neighbour graphs, clusters and domains."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions.storage import stable
from ..operators import communities, domains, neighbours
from .core import query, r, rounded, rs

RADIUS = 8.0


@query("e1_spatial_knn", f"SELECT sample_id, src, dst, rank, {rs('distance')} FROM neighbours", "neighbours")
def _(spark, sf):
    return rounded(neighbours.nearest_neighbours(fx.sparse_obs(spark, sf), 10))


PAIR = "sqrt((a.px - b.px) * (a.px - b.px) + (a.py - b.py) * (a.py - b.py))"


@query(
    "e2_radius_graph",
    f"""SELECT a.sample_id, a.obs_id AS src, b.obs_id AS dst, {r(PAIR, 'distance')}, 1.0::DOUBLE AS weight
FROM obs a JOIN obs b ON a.sample_id = b.sample_id AND a.obs_id <> b.obs_id WHERE {PAIR} <= {RADIUS}""",
    "obs",
)
def _(spark, sf):
    return rounded(neighbours.spatial_graph(fx.sparse_obs(spark, sf), radius=RADIUS))


STEPS = "(0, -2), (0, 2), (-1, -1), (-1, 1), (1, -1), (1, 1)"


@query(
    "e3_lattice_graph",
    f"""WITH s(dr, dc) AS (VALUES {STEPS}), one AS (SELECT a.obs_id AS src, b.obs_id AS dst FROM obs a, s
  JOIN obs b ON b.array_row = a.array_row + dr AND b.array_col = a.array_col + dc),
two AS (SELECT DISTINCT x.src, y.dst FROM one x JOIN one y ON x.dst = y.src WHERE x.src <> y.dst)
SELECT src, dst, 1 AS ring FROM one UNION ALL SELECT src, dst, 2 FROM (SELECT * FROM two EXCEPT SELECT * FROM one)""",
    "obs",
)
def _(spark, sf):
    return neighbours.lattice_graph(fx.sparse_obs(spark, sf), 2, by=[]).drop("weight")


DEGREE = f"count(*) AS n_spots, {r('avg(d)', 'mean_degree')}, {r('stddev_pop(d)', 'std_degree')}, " + (
    "min(d)::DOUBLE AS min_degree, max(d)::DOUBLE AS max_degree"
)


@query(
    "e4_degree_stats",
    f"""SELECT sample_id, {DEGREE} FROM (SELECT o.sample_id, o.obs_id, count(src) AS d FROM obs o
LEFT JOIN neighbours n ON n.src = o.obs_id GROUP BY 1, 2) GROUP BY 1""",
    "obs neighbours",
)
def _(spark, sf):
    obs = fx.sparse_obs(spark, sf)
    return rounded(neighbours.degree_stats(obs, neighbours.spatial_graph(obs)))


@query(
    "e4_lattice_degree",
    f"""WITH s(dr, dc) AS (VALUES {STEPS})
SELECT {DEGREE} FROM (SELECT a.obs_id, count(b.obs_id) AS d FROM obs a CROSS JOIN s
LEFT JOIN obs b ON b.array_row = a.array_row + dr AND b.array_col = a.array_col + dc GROUP BY 1)""",
    "obs",
)
def _(spark, sf):
    obs = fx.sparse_obs(spark, sf)
    return rounded(neighbours.degree_stats(obs, neighbours.lattice_graph(obs, by=[]), by=[]))


VECTOR_NEAREST = """near AS (SELECT src, dst, distance, rank FROM (SELECT src, dst, distance,
  row_number() OVER (PARTITION BY src ORDER BY distance, dst) AS rank FROM (
  SELECT a.vec_id AS src, b.vec_id AS dst, list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS distance
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)) WHERE rank <= 14)"""


@query("e5_vector_knn", f"WITH {VECTOR_NEAREST} SELECT '0' AS sample_id, src, dst, rank, {rs('distance')} FROM near")
def _(spark, sf):
    return rounded(neighbours.vector_neighbours(fx.signed_scores(spark, sf), 14))


@query("e5_expression_graph")
def _(spark, sf):
    return rounded(neighbours.expression_graph(fx.signed_scores(spark, sf), 15))


@query("e8_cluster_sizes", "SELECT sample_id, cluster, count(*) AS n_spots FROM obs GROUP BY 1, 2", "obs")
def _(spark, sf):
    return domains.cluster_sizes(fx.sparse_obs(spark, sf))


SILHOUETTE = f"""pairs AS (SELECT a.sample_id, a.obs_id, a.cluster, b.cluster AS other, {PAIR} AS d
  FROM obs a JOIN obs b ON a.sample_id = b.sample_id AND a.obs_id <> b.obs_id),
means AS (SELECT sample_id, obs_id, cluster, other, avg(d) AS m FROM pairs GROUP BY ALL),
sides AS (SELECT sample_id, obs_id, cluster, max(m) FILTER (WHERE other = cluster) AS a,
  min(m) FILTER (WHERE other <> cluster) AS b FROM means GROUP BY ALL),
points AS (SELECT sample_id, obs_id, cluster, CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END AS silhouette
  FROM sides)"""


@query("e9_silhouette", f"WITH {SILHOUETTE} SELECT sample_id, {r('avg(silhouette)', 'silhouette')} FROM points GROUP BY 1", "obs")
def _(spark, sf):
    obs = fx.sparse_obs(spark, sf)
    return rounded(domains.silhouette(domains.coordinate_vectors(obs), obs.select("sample_id", "obs_id", "cluster")))


@query("e9_silhouette_points", f"WITH {SILHOUETTE} SELECT sample_id, obs_id, cluster, {rs('silhouette')} FROM points", "obs")
def _(spark, sf):
    obs = fx.sparse_obs(spark, sf)
    vectors = domains.coordinate_vectors(obs)
    return rounded(domains.silhouette_points(vectors, obs.select("sample_id", "obs_id", "cluster")))


@query(
    "g12_domains",
    f"""WITH c AS (SELECT sample_id, cluster, count(*) AS n_spots, avg(px) AS centroid_x, avg(py) AS centroid_y
  FROM obs GROUP BY 1, 2 HAVING count(*) >= 2),
k AS (SELECT sample_id, cluster, avg(sqrt((px - centroid_x) * (px - centroid_x) + (py - centroid_y) * (py - centroid_y)))
  AS compactness FROM obs JOIN c USING (sample_id, cluster) GROUP BY 1, 2),
p AS (SELECT a.sample_id, a.cluster, a.obs_id, {PAIR} AS d FROM obs a JOIN obs b
  ON a.sample_id = b.sample_id AND a.cluster = b.cluster AND a.obs_id <> b.obs_id),
m AS (SELECT sample_id, cluster, avg(d) AS mean_pairwise_distance FROM p GROUP BY 1, 2),
n AS (SELECT sample_id, cluster, avg(d) AS mean_nn_distance
  FROM (SELECT sample_id, cluster, obs_id, min(d) AS d FROM p GROUP BY 1, 2, 3) GROUP BY 1, 2),
e AS (SELECT a.sample_id, a.cluster, a.px * b.py - b.px * a.py AS turn FROM obs a JOIN obs b
  ON a.sample_id = b.sample_id AND a.cluster = b.cluster AND a.obs_id <> b.obs_id
  WHERE NOT EXISTS (SELECT 1 FROM obs o WHERE o.sample_id = a.sample_id AND o.cluster = a.cluster
    AND o.obs_id <> a.obs_id AND o.obs_id <> b.obs_id
    AND (b.px - a.px) * (o.py - a.py) - (b.py - a.py) * (o.px - a.px) <= 0)),
h AS (SELECT sample_id, cluster, sum(turn) / 2 AS area FROM e GROUP BY 1, 2)
SELECT sample_id, cluster, n_spots, {rs('centroid_x centroid_y compactness mean_pairwise_distance mean_nn_distance')},
{r('CASE WHEN n_spots < 3 THEN 0 ELSE area END', 'hull_area', 4)}
FROM c JOIN k USING (sample_id, cluster) JOIN m USING (sample_id, cluster) JOIN n USING (sample_id, cluster)
LEFT JOIN h USING (sample_id, cluster)""",
    "obs",
)
def _(spark, sf):
    obs = stable(fx.sparse_obs(spark, sf))
    table = domains.domain_table(obs, obs.select("sample_id", "obs_id", "cluster"))
    # Coordinates have a few decimals, so the exact area often ends in a 5 at the seventh place.
    return rounded(table.withColumn("hull_area", F.round("hull_area", 4)))


@query("e6_leiden")
def _(spark, sf):
    obs = stable(fx.sparse_obs(spark, sf))
    return communities.leiden(stable(neighbours.spatial_graph(obs)), obs)


@query("e7_louvain")
def _(spark, sf):
    obs = stable(fx.sparse_obs(spark, sf))
    return communities.louvain(stable(neighbours.spatial_graph(obs)), obs)


PLANTED = """SELECT c_custkey AS obs_id, min(c_custkey) OVER (PARTITION BY c_nationkey) AS community FROM customer"""


def planted(spark, sf):
    """Every customer linked to 12 members of its nation, and the nations of a region to each other by one link each."""
    people = fx.table(spark, sf, "customer").join(fx.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    nation = Window.partitionBy("c_nationkey")
    placed = stable(
        people.select(
            F.col("n_regionkey").cast("string").alias("sample_id"),
            F.col("c_custkey").alias("obs_id"),
            "c_nationkey",
            (F.row_number().over(nation.orderBy("c_custkey")) - 1).alias("at"),
            F.count(F.lit(1)).over(nation).alias("size"),
        )
    )
    # The first step joins a nation in a ring, so it is connected; the others look random.
    step = F.transform(F.sequence(F.lit(1), F.lit(12)), lambda j: F.when(j == 1, 1).otherwise(j * j * 13 + F.col("at") * (j - 1) * 7))
    near = placed.select("sample_id", "c_nationkey", F.col("obs_id").alias("src"), "at", "size", F.explode(step).alias("step"))
    near = near.withColumn("at", F.pmod(F.col("at") + F.col("step"), F.col("size")))
    member = placed.select("c_nationkey", "at", F.col("obs_id").alias("dst"))
    links = near.join(member, ["c_nationkey", "at"]).select("sample_id", "src", "dst")
    heads = placed.where("at = 0").select("sample_id", "obs_id")
    chain = heads.withColumn("dst", F.lead("obs_id").over(Window.partitionBy("sample_id").orderBy("obs_id"))).where("dst IS NOT NULL")
    edges = links.unionByName(chain.select("sample_id", F.col("obs_id").alias("src"), "dst")).where("src <> dst")
    return stable(edges.withColumn("weight", F.lit(1.0))), placed.select("sample_id", "obs_id")


def by_lowest(clusters):
    lowest = clusters.groupBy("sample_id", "cluster").agg(F.min("obs_id").alias("community"))
    return clusters.join(lowest, ["sample_id", "cluster"]).select("obs_id", "community")


@query("e6_leiden_planted", PLANTED)
def _(spark, sf):
    return by_lowest(communities.leiden(*planted(spark, sf)))


@query("e7_louvain_planted", PLANTED)
def _(spark, sf):
    return by_lowest(communities.louvain(*planted(spark, sf)))


# Several blocks a sample, also on the smallest tables.
SEVERAL_BLOCKS = 1_500


@query("e6_leiden_blocks_planted", PLANTED)
def _(spark, sf):
    return by_lowest(communities.leiden(*planted(spark, sf), block_links=SEVERAL_BLOCKS))


@query("e7_louvain_blocks_planted", PLANTED)
def _(spark, sf):
    return by_lowest(communities.louvain(*planted(spark, sf), block_links=SEVERAL_BLOCKS))


@query(
    "e6_partition_quality",
    f"""WITH u AS (SELECT sample_id, src, dst, count(*)::DOUBLE AS w FROM (SELECT sample_id, src, dst FROM neighbours
  UNION ALL SELECT sample_id, dst, src FROM neighbours) GROUP BY 1, 2, 3),
k AS (SELECT sample_id, src AS obs_id, sum(w) AS k FROM u GROUP BY 1, 2),
m AS (SELECT sample_id, sum(k) AS m FROM k GROUP BY 1),
i AS (SELECT u.sample_id, sum(w) AS w FROM u JOIN obs a ON a.obs_id = src JOIN obs b ON b.obs_id = dst
  WHERE a.cluster = b.cluster GROUP BY 1),
s AS (SELECT sample_id, sum(t * t) AS s FROM (SELECT sample_id, cluster, sum(k) AS t FROM k JOIN obs USING (sample_id, obs_id)
  GROUP BY 1, 2) GROUP BY 1)
SELECT sample_id, {r('w / m - s / (m * m)', 'quality')} FROM m JOIN i USING (sample_id) JOIN s USING (sample_id)""",
    "obs neighbours",
)
def _(spark, sf):
    obs = stable(fx.sparse_obs(spark, sf))
    edges = neighbours.spatial_graph(obs)
    return rounded(communities.partition_quality(edges, obs.select("sample_id", "obs_id", "cluster")))
