import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from spotframe.operators import communities, domains, neighbours


def brute(points, k):
    out = set()
    for i, (_, a, x, y) in enumerate(points):
        d = sorted((float(np.hypot(x - u, y - v)), b) for j, (_, b, u, v) in enumerate(points) if j != i)
        out |= {(a, b, r + 1) for r, (_, b) in enumerate(d[:k])}
    return out


def listed(df):
    return {(r.src, r.dst, r["rank"]) for r in df.collect()}


@pytest.mark.parametrize("shape", ["uniform", "dense_and_lonely", "line", "copies"])
def test_nearest_neighbours_match_brute_force(spots, shape):
    rng = np.random.default_rng(3)
    xy = {
        "uniform": rng.integers(0, 1000, (150, 2)),
        "dense_and_lonely": np.vstack([rng.integers(0, 60, (140, 2)), [[90000, 5], [90010, 70000], [-50000, 3]]]),
        "line": np.column_stack([rng.integers(0, 500, 120), np.zeros(120, dtype=int)]),
        "copies": np.vstack([np.tile([[5, 5]], (60, 1)), rng.integers(0, 50, (60, 2))]),
    }[shape]
    points = [("s", i, int(x), int(y)) for i, (x, y) in enumerate(xy)]
    assert listed(neighbours.nearest_neighbours(spots(points), 4)) == brute(points, 4)


def test_fewer_points_than_neighbours(spots):
    obs = spots([("s", 1, 0, 0), ("s", 2, 1, 0), ("s", 3, 5, 0), ("t", 4, 0, 0)])
    got = listed(neighbours.nearest_neighbours(obs, 10))
    assert got == {(1, 2, 1), (1, 3, 2), (2, 1, 1), (2, 3, 2), (3, 2, 1), (3, 1, 2)}


def test_radius_graph_is_inclusive(spots):
    obs = spots([("s", 1, 0, 0), ("s", 2, 3, 4), ("s", 3, 9, 9)])
    assert {(r.src, r.dst) for r in neighbours.spatial_graph(obs, radius=5.0).collect()} == {(1, 2), (2, 1)}


def test_lattice_rings(spark):
    rows = [("s", r * 10 + c // 2, r, c) for r in range(5) for c in range(r % 2, 10, 2)]
    obs = spark.createDataFrame(rows, "sample_id string, obs_id long, array_row int, array_col int")
    centre = 2 * 10 + 2
    rings = neighbours.lattice_graph(obs, 2).where(f"src = {centre}").groupBy("ring").count().collect()
    assert {r.ring: r["count"] for r in rings} == {1: 6, 2: 12}
    row = neighbours.degree_stats(obs, neighbours.lattice_graph(obs)).first()
    assert row.max_degree == 6 and row.min_degree >= 2


def test_fuzzy_weights_are_symmetric_and_bounded(spark):
    rng = np.random.default_rng(0)
    scores = spark.createDataFrame(
        [("s", i, [float(v) for v in rng.normal(size=5)]) for i in range(60)],
        "sample_id string, obs_id long, pcs array<double>",
    )
    for block in (16, 2048):
        near = neighbours.vector_neighbours(scores, 7, block=block)
        assert near.count() == 420
    edges = neighbours.expression_graph(scores, 8).toPandas()
    wide = edges.pivot(index="src", columns="dst", values="weight").fillna(0.0)
    assert np.allclose(wide, wide.T) and 0 < edges.weight.min() and edges.weight.max() <= 1 + 1e-12
    # Each spot's nearest neighbour has membership 1.
    assert (edges.groupby("src").weight.max() > 1 - 1e-9).all()


def test_memberships_sum_to_target():
    d = np.array([0.0, 1.0, 1.5, 2.0, 4.0, 9.0])
    assert abs(neighbours._memberships(d, np.log2(6)).sum() - np.log2(6)) < 1e-4


def planted(spark, n=240, groups=4, inside=0.25, outside=0.01):
    rng = np.random.default_rng(1)
    label = np.arange(n) % groups
    p = np.where(label[:, None] == label[None, :], inside, outside)
    i, j = np.nonzero(np.triu(rng.random((n, n)) < p, 1))
    rows = [("s", int(a), int(b), 1.0) for a, b in zip(i, j)]
    obs = spark.createDataFrame([("s", i) for i in range(n + 1)], "sample_id string, obs_id long")
    return spark.createDataFrame(rows, "sample_id string, src long, dst long, weight double"), obs, label


@pytest.mark.parametrize("method, links", [("leiden", 1_500), ("louvain", 500_000), ("louvain", 1_500)])
def test_planted_groups_are_found(spark, method, links):
    edges, obs, label = planted(spark)
    found = getattr(communities, method)(edges, obs, resolution=1.0, block_links=links)
    found = found.toPandas().sort_values("obs_id")
    # The last spot has no edge and stays alone.
    assert found.cluster.nunique() == 5 and (found.cluster == found.cluster.iloc[-1]).sum() == 1
    table = pd.crosstab(found.cluster.iloc[:-1], label)
    assert table.max(axis=1).sum() >= 0.99 * len(label)
    sizes = found.cluster.value_counts()
    assert list(sizes.sort_index().index) == ["0", "1", "2", "3", "4"] and sizes["0"] == sizes.max()
    planted_q = spark.createDataFrame([("s", i, str(g)) for i, g in enumerate(label)], "sample_id string, obs_id long, cluster string")
    want = communities.partition_quality(edges, planted_q).first().quality
    got = communities.partition_quality(edges, spark.createDataFrame(found[["sample_id", "obs_id", "cluster"]])).first()
    assert got.quality >= want - 0.002


def test_refined_rounds_give_connected_parts(spark):
    edges, obs, label = planted(spark, n=80, groups=2)
    links = communities.undirected(edges).toPandas()
    found = communities.leiden(edges, obs, resolution=1.0, n_iterations=1, block_links=150).toPandas()
    group = dict(zip(found.obs_id, found.cluster))
    inner = links[links.src.map(group) == links.dst.map(group)]
    for name, members in found.groupby("cluster").obs_id:
        seen, todo = set(), [members.iloc[0]]
        while todo:
            at = todo.pop()
            if at not in seen:
                seen.add(at)
                todo += inner.dst[inner.src == at].tolist()
        assert seen == set(members)


def test_connected_splits_a_broken_community(spark):
    nodes = spark.createDataFrame([("s", i, 1.0, 8.0, 0) for i in range(6)], "sample_id string, node long, k double, mass double, to long")
    chain = [(0, 1), (1, 2), (3, 4), (4, 5)]
    edges = spark.createDataFrame(
        [("s", a, b, 1.0) for u, v in chain for a, b in ((u, v), (v, u))], "sample_id string, src long, dst long, w double"
    )
    for links in (1, 100):
        layout = communities._layout(edges, nodes.withColumn("comm", F.col("to")), links)
        got = {r.node: r.comm for r in communities._connected(layout, nodes).collect()}
        assert got == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 5: 3}


def labelled(spark, rows):
    return spark.createDataFrame(rows, "sample_id string, obs_id long, cluster string")


def test_silhouette_edge_cases(spark, spots):
    obs = spots([("s", 0, 0, 0), ("s", 1, 1, 0), ("s", 2, 10, 0), ("t", 3, 0, 0), ("t", 4, 1, 0)])
    clusters = labelled(spark, [("s", 0, "a"), ("s", 1, "a"), ("s", 2, "b"), ("t", 3, "a"), ("t", 4, "a")])
    for block in (1, 2048):
        points = domains.silhouette_points(domains.coordinate_vectors(obs), clusters, block=block)
        got = {r.obs_id: r.silhouette for r in points.collect()}
        assert got[0] == pytest.approx(0.9) and got[1] == pytest.approx(8 / 9) and got[2] == 0.0
    mean = {r.sample_id: r.silhouette for r in domains.silhouette(domains.coordinate_vectors(obs), clusters).collect()}
    assert mean["s"] == pytest.approx((0.9 + 8 / 9) / 3) and mean["t"] is None


def test_domain_geometry(spark, spots):
    square = [("s", i, x, y) for i, (x, y) in enumerate([(0, 0), (2, 0), (2, 2), (0, 2), (1, 1)])]
    line = [("s", 10 + i, i, i) for i in range(3)]
    pair = [("s", 20, 0, 0), ("s", 21, 3, 4)]
    single = [("s", 30, 7, 7)]
    groups = {"square": square, "line": line, "pair": pair, "single": single}
    obs = spots([p for g in groups.values() for p in g])
    clusters = labelled(spark, [(s, i, name) for name, g in groups.items() for s, i, _, _ in g])
    got = {r.cluster: r for r in domains.domain_table(obs, clusters).collect()}
    assert set(got) == {"square", "line", "pair"}
    assert got["square"].hull_area == 4.0 and got["line"].hull_area is None and got["pair"].hull_area == 0.0
    assert got["pair"].mean_pairwise_distance == 5.0 and got["pair"].compactness == 2.5
    assert got["line"].mean_nn_distance == pytest.approx(2**0.5)


def test_pairwise_means_do_not_depend_on_blocks(spots):
    rng = np.random.default_rng(5)
    xy = rng.normal(size=(40, 2))
    obs = spots([("s", i, x, y) for i, (x, y) in enumerate(xy)])
    d = [np.hypot(*(xy[i] - xy[j])) for i in range(40) for j in range(i)]
    for block in (7, 2048):
        got = domains.pairwise_means(obs, ["sample_id"], block=block).first()
        assert got.mean_pairwise_distance == pytest.approx(np.mean(d))


def test_points_on_a_line_have_no_hull():
    for points in ([(0.1, 0.3), (0.2, 0.6), (0.7, 2.1), (0.3, 0.9)], [(k * 0.1, k * 0.7 + 3) for k in range(50)], [(5e6 + k / 3, 7e6 + k / 7) for k in range(30)]):
        x, y = np.array(points).T
        assert len(domains.convex_hull(x, y)) == 2
    x, y = np.array([(0, 0), (1, 0), (1, 1), (0, 1), (0.5, 0), (0.5, 0.5)]).T
    assert domains.hull_area(domains.convex_hull(x, y)) == 1.0


def test_radius_zero_links_equal_places(spots):
    points = spots([("s", 1, 2, 3), ("s", 2, 2, 3), ("s", 3, 2, 4)])
    found = neighbours.radius_graph(points, 0.0).select("src", "dst").collect()
    assert sorted(map(tuple, found)) == [(1, 2), (2, 1)]


def ring_of_cliques(sample, first, n, size=5):
    rows = []
    for g in range(n):
        nodes = [first + g * size + i for i in range(size)]
        rows += [(sample, a, b, 1.0) for i, a in enumerate(nodes) for b in nodes[i + 1 :]]
        rows.append((sample, nodes[-1], first + (g + 1) % n * size, 1.0))
    return rows


@pytest.mark.parametrize("method", ["leiden", "louvain"])
def test_labels_depend_on_the_sample_alone(spark, method):
    """Neither the size of a sample nor that of its neighbours chooses the search."""
    edges, obs, _ = planted(spark, n=90, groups=3, inside=0.15, outside=0.05)
    other = spark.createDataFrame(ring_of_cliques("t", 10_000, 30), edges.schema)
    more = obs.unionByName(spark.createDataFrame([("t", 10_000 + i) for i in range(150)], obs.schema))

    def groups(found):
        return set(found.where("sample_id = 's'").groupBy("cluster").agg({"obs_id": "collect_set"}).toPandas().iloc[:, 1].map(frozenset))

    run = getattr(communities, method)
    small = groups(run(edges, obs, resolution=1.0))
    assert small == groups(run(edges.unionByName(other), more, resolution=1.0))


@pytest.mark.parametrize("method", ["leiden", "louvain"])
def test_labels_do_not_depend_on_partitions(spark, method):
    """Several blocks a sample, dealt to 2 and to 16 tasks."""
    edges, obs, _ = planted(spark, n=90, groups=3, inside=0.15, outside=0.05)
    found = []
    for n in ("2", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            rows = getattr(communities, method)(edges.repartition(int(n)), obs, resolution=1.0, block_links=200).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
        found.append(sorted(map(tuple, rows)))
    assert found[0] == found[1]


@pytest.mark.parametrize("block_links", [100, 1000, 100_000])
def test_local_moving_leaves_no_better_move(spark, block_links):
    edges, obs, _ = planted(spark, n=90, groups=3, inside=0.15, outside=0.05)
    links = communities.undirected(edges)
    degree = links.groupBy("sample_id", F.col("src").alias("node")).agg(F.sum("w").alias("k"))
    total = degree.agg(F.sum("k")).first()[0]
    start = degree.withColumn("mass", F.lit(total)).withColumn("comm", F.col("node"))
    found = communities._move(communities._layout(links, start, block_links), 1.0, 42, 0)[0].toPandas()
    comm, k = dict(zip(found.node, found.to)), dict(zip(found.node, found.k))
    held = found.groupby("to").k.sum().to_dict()
    near = links.toPandas()
    for node, own in near.groupby("src"):
        to = own.w.groupby(own.dst.map(comm)).sum()
        stay = to.get(comm[node], 0.0) - k[node] * (held[comm[node]] - k[node]) / total
        assert all(w - k[node] * held[c] / total <= stay + 1e-6 for c, w in to.items() if c != comm[node])


@pytest.mark.parametrize("block_links", [20, 100_000])
def test_refinement_leaves_no_linked_node_alone(spark, block_links):
    """A chain in one community: every node gains by joining a neighbour's part."""
    n = 200
    rows = [("s", a, b, 1.0) for i in range(n - 1) for a, b in ((i, i + 1), (i + 1, i))]
    edges = spark.createDataFrame(rows, "sample_id string, src long, dst long, w double")
    nodes = [("s", i, 2.0 if 0 < i < n - 1 else 1.0, 2.0 * (n - 1), 0) for i in range(n)]
    nodes = spark.createDataFrame(nodes, "sample_id string, node long, k double, mass double, comm long")
    layout = communities._layout(edges, nodes, block_links)
    found = communities._refine(layout, nodes.withColumnRenamed("comm", "to"), 0.5, 42, 0)[0].select("node", "to").toPandas()
    parts = found.groupby("to").node.agg(["count", "min", "max"])
    # Every part is a piece of the chain.
    assert (parts["count"] > 1).all() and (parts["max"] - parts["min"] + 1 == parts["count"]).all()


def cliques(spark, n):
    links = communities.undirected(spark.createDataFrame(ring_of_cliques("s", 0, n), "sample_id string, src long, dst long, weight double"))
    degree = links.groupBy("sample_id", F.col("src").alias("node")).agg(F.sum("w").alias("k"))
    return links, degree.withColumn("mass", F.lit(float(22 * n)))


def test_a_community_lies_in_as_few_blocks_as_hold_it(spark):
    """Cliques of five, 22 links each, stay whole; one community of all lies in several blocks, which travel together."""
    links, degree = cliques(spark, 30)
    for comm, together in ((F.floor(F.col("node") / 5), True), (F.lit(0), False)):
        layout = communities._layout(links, degree.withColumn("comm", comm.cast("long")), 60)
        blocks = layout.homes.groupBy("comm").agg(F.countDistinct("block").alias("n")).toPandas()
        assert (blocks.n == 1).all() if together else blocks.n[0] > 5
        assert layout.homes.select("block").distinct().count() > 5
        assert layout.links.select(*communities.GROUP).distinct().count() == 1
        layout.drop()


def test_samples_of_several_blocks_start_from_a_sketch(spark):
    """They begin with communities in place of single nodes; other samples begin as they are."""
    links, degree = cliques(spark, 30)
    start = degree.withColumn("comm", F.col("node"))
    assert communities._sketched(links, start, 0.5, 42, 10_000) is start
    drawn = communities._sketched(links, start, 0.5, 42, 200).toPandas()
    assert sorted(drawn.node) == list(range(150)) and drawn.comm.nunique() <= 30
