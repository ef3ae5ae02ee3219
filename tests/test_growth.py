"""Steps whose cost must not grow faster than their input: plans, sizes of task rows, and equal results."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from spotframe import fixtures
from spotframe.dataset import SpatialDataset
from spotframe.functions import numeric, special
from spotframe.operators import autocorrelation, blocks, dense, neighbours, permuted, reduction
from spotframe.sources.visium import read_visium


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString().lower()


def test_adjusted_pvalues_walk_each_row_once(spark):
    p = np.round(np.random.default_rng(3).random(300), 2)
    rows = [(c, i, float(v) if i % 11 else None) for c in ("a", None) for i, v in enumerate(p)]
    out = special.adjust_pvalues(spark.createDataFrame(rows, "cluster string, var_id long, pval double"), "pval", ["cluster"])
    assert "currentrow$(), unboundedfollowing$()" not in plan_of(out)
    known = sorted((v, i) for _, i, v in rows[:300] if v is not None)
    best, want = 1.0, {}
    for rank in range(len(known), 0, -1):
        v, i = known[rank - 1]
        best = min(best, v * len(known) / rank)
        want[i] = best
    got = out.collect()
    assert len(got) == 600
    for r in got:
        assert abs(r["pval_adj"] - want.get(r["var_id"], 1.0)) < 1e-12


def test_packed_blocks_never_travel_through_the_driver(spark):
    points = spark.range(40).select(F.lit("s").alias("sample_id"), F.col("id").alias("obs_id"), F.col("id").cast("double").alias("px"))
    met = blocks.block_pairs(blocks.pack_blocks(points, ["sample_id"], ["obs_id", "px"], block=10), ["sample_id"])
    assert "broadcast" not in plan_of(met)


def test_nearest_measures_few_and_keeps_ties():
    rng = np.random.default_rng(5)
    b = np.round(rng.random((60, 3)), 1)
    ids, aid, k = rng.permutation(60), np.arange(20), 5
    a = b[np.argsort(ids)][:20]
    src, dst, d = neighbours._nearest(aid, a, ids, b, k)
    want = []
    for i, v in zip(aid, a):
        far = sorted((float(np.sqrt(((v - w) ** 2).sum())), int(j)) for j, w in zip(ids, b) if j != i)
        want += [(int(i), j) for _, j in far[:k]]
    assert list(zip(src.tolist(), dst.tolist())) == want


def test_sparse_cells_sum_like_a_matrix():
    rng, n = np.random.default_rng(6), 400

    class Row:
        at, slot = rng.integers(0, n, 12), rng.integers(0, 3, 12)
        var_id, x = slot + 10, rng.random(12)
        src_at, dst_at, w = rng.integers(0, n, 4000), rng.integers(0, n, 4000), rng.random(4000)

    ends = np.bincount(Row.src_at, Row.w, n) + np.bincount(Row.dst_at, Row.w, n)
    cells = permuted._Cells(Row, n)
    var_ids, x = permuted._matrix(Row.at, Row.slot, Row.var_id, Row.x, n)
    assert var_ids.tolist() == cells.var_ids.tolist()
    for perm in range(40):
        taken = permuted.permutation(n, perm)
        moved = np.empty_like(ends)
        moved[taken] = ends
        t1, t2 = cells.sums(taken, ends)
        assert np.allclose(t1, permuted._cross(x, taken[Row.src_at], taken[Row.dst_at], Row.w))
        assert np.allclose(t2, moved @ x)


def test_cross_products_make_rows_of_shared_genes_only(spark):
    cells = [("s", 1, 7, 2.0), ("s", 1, 8, 1.0), ("s", 2, 7, 3.0), ("s", 2, 7, 1.0), ("s", 3, 9, 5.0)]
    counts = spark.createDataFrame(cells, "sample_id string, obs_id long, var_id long, x double")
    w = spark.createDataFrame([("s", 1, 2, 0.5), ("s", 2, 3, 1.0), ("s", 3, 1, 1.0)], "sample_id string, src long, dst long, w double")
    out = autocorrelation._cross_products(counts, w)
    assert "array_intersect" in plan_of(out)
    assert [(r["var_id"], r["t1"]) for r in out.collect()] == [(7, 4.0)]


def test_dense_rows_are_filled_once_and_spread(spark, cells, spots, genes):
    obs = spots([("s", i, 0, 0) for i in range(40)])
    counts = cells([("s", 3, 0, 2.0), ("s", 7, 2, 5.0)])
    var = genes("abc")
    vectors, factors = reduction.scaled_spots(counts, obs, var, max_value=None)
    out = reduction.scaled_cells(vectors, factors)
    assert plan_of(out).count("arrowevalpython") == 1
    assert vectors.rdd.getNumPartitions() == dense.SPREAD * spark.sparkContext.defaultParallelism
    x = np.zeros((40, 3))
    x[3, 0], x[7, 2] = 2.0, 5.0
    std = x.std(axis=0, ddof=1)
    want = (x - x.mean(axis=0)) / np.where(std > 0, std, 1.0)
    got = {(r["obs_id"], r["var_id"]): r["z"] for r in out.collect()}
    assert len(got) == 120
    assert all(abs(got[i, g] - want[i, g]) < 1e-12 for i in range(40) for g in range(3))


def test_running_counts_are_sorted_once(spark):
    rows = [(g, float(v % 7), c) for g in (1, None, 2) for v, c in enumerate("abcabcabcab")]
    df = spark.createDataFrame(rows, "g long, x double, c string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = numeric.ordered_value_counts(df, ["g"], "x")
        rows_sorted = plan_of(out).split("sortmergejoin")[1].split("sortmergejoin")[0]
        left = rows_sorted[: rows_sorted.index("sum(_part_n")] if "sum(_part_n" in rows_sorted else rows_sorted
        assert left.index("window") < left.index("sort [")
        got = {(r["g"], r["x"]): (r["n"], r["n_below"], r["n_total"]) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    counts = [2, 2, 2, 2, 1, 1, 1]
    assert got == {(g, float(v)): (counts[v], sum(counts[:v]), 11) for g in (1, 2) for v in range(7)}


def test_matrices_are_written_in_parts_and_read_back(spark, tmp_path):
    obs = spark.createDataFrame(
        [(s, i, i % 2 == 0, i, i, float(i), 1.0) for s in ("a", "b", "empty") for i in range(5, 15)],
        "sample_id string, obs_id long, in_tissue boolean, array_row int, array_col int, px double, py double",
    )
    var = spark.createDataFrame([(3, "x"), (9, "y"), (4, "z")], "var_id long, gene string")
    cells = [(s, i, g, i + g / 10) for s in ("a", "b") for i in range(5, 15) for g in (3, 9) if s == "a" or i > 9]
    counts = spark.createDataFrame(cells, "sample_id string, obs_id long, var_id long, x double").repartition(3)
    fixtures.write_samples(SpatialDataset(obs=obs, var=var, counts=counts), str(tmp_path))
    for sample, n in (("a", 20), ("b", 10), ("empty", 0)):
        folder = tmp_path / sample / "filtered_feature_bc_matrix"
        assert (folder / "matrix.mtx").read_text().splitlines()[1:] == [f"3 10 {n}"]
        parts = [p.read_text().splitlines() for p in folder.glob("matrix.mtx.part-*")]
        assert all(p[0] == f"3 10 {n}" for p in parts) and sum(len(p) - 1 for p in parts) == n
    back = read_visium(spark, f"{tmp_path}/*", load_images=False)
    named = back.counts.join(back.obs.select("sample_id", "obs_id", "barcode"), ["sample_id", "obs_id"])
    named = named.join(back.var.select("var_id", "gene"), "var_id").collect()
    name = {3: "x", 9: "y", 4: "z"}
    assert sorted((r["sample_id"], r["barcode"], r["gene"], r["x"]) for r in named) == sorted((s, f"B{i}", name[g], x) for s, i, g, x in cells)
    assert back.obs.count() == 30


def test_dense_rows_stay_spread_beside_as_many_shuffle_partitions(spark, cells, spots, genes):
    spread = dense.SPREAD * spark.sparkContext.defaultParallelism
    settings = {"spark.sql.shuffle.partitions": str(spread), "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        obs = spots([("s", i, 0, 0) for i in range(400)])
        rows = dense.dense_spots(cells([("s", 3, 0, 2.0)]), obs, dense.gene_index(genes("abc")))
        assert rows.select(F.spark_partition_id().alias("p")).distinct().count() > spread // 2
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_exact_components_never_fill_rows(spark, cells, spots, genes, monkeypatch):
    """Components come from stored values alone; a cell that is there twice counts once, as in a dense row."""
    monkeypatch.setattr(reduction, "dense_spots", None)
    rng = np.random.default_rng(2)
    x = np.where(rng.random((30, 4)) < 0.5, rng.random((30, 4)), 0.0)
    obs = spots([("s", i, 0, 0) for i in range(30)])
    counts = cells([("s", i, j, float(v)) for (i, j), v in np.ndenumerate(x) if v])
    scores, loadings, variance = reduction.pca(counts, obs, genes("abcd"), 3)
    values, axes = np.linalg.eigh(np.cov(x.T))
    got = {r["pc"]: (r["variance"], r["ratio"]) for r in variance.collect()}
    assert np.allclose([got[c] for c in range(3)], [(v, v / values.sum()) for v in values[::-1][:3]])
    found = {(r["var_id"], r["pc"]): r["loading"] for r in loadings.collect()}
    pcs = {r["obs_id"]: r["pcs"] for r in scores.collect()}
    w = np.array([[found[g, c] for c in range(3)] for g in range(4)])
    assert np.allclose(np.abs(w.T @ axes[:, ::-1][:, :3]), np.eye(3))
    assert np.allclose([pcs[i] for i in range(30)], (x - x.mean(axis=0)) @ w)
    twice = counts.unionByName(counts.where("obs_id = 3"))
    cells_of = dense.stored_cells(dense.sparse_spots(twice, obs.select("sample_id", "obs_id"), dense.gene_index(genes("abcd")), unique=True))
    assert all(r["pos"] == list(np.flatnonzero(x[r["obs_id"]])) for r in cells_of.collect())


def test_permutation_query_tests_every_gene(spark, monkeypatch):
    """More genes than any default selection: each gets its p."""
    from spotframe.registry import spatial
    from spotframe.registry.core import QUERIES

    rng = np.random.default_rng(8)
    obs = spark.createDataFrame([("s", i, float(i % 4), float(i // 4)) for i in range(12)], "sample_id string, obs_id long, px double, py double")
    rows = [("s", int(i), g, float(1 + rng.integers(5))) for g in range(130) for i in rng.choice(12, 3, replace=False)]
    logs = spark.createDataFrame(rows, "sample_id string, obs_id long, var_id long, x double")
    monkeypatch.setattr(spatial, "inputs", lambda spark, sf: (type("D", (), {"obs": obs}), logs))
    found = QUERIES["g2_moran_permutation"](spark, "").collect()
    assert sorted(r.var_id for r in found) == list(range(130))
    assert all(1 / 1001 - 1e-6 <= r.pval_sim <= 1 for r in found)


def test_permuted_counts_match_a_loop(spark):
    rng, perms = np.random.default_rng(12), 9
    samples = {"s": 23, "t": 9}
    x = {s: np.where(rng.random((n, 5)) < 0.5, rng.integers(1, 9, (n, 5)), 0).astype(float) for s, n in samples.items()}
    links = {s: [(i, j, float(rng.random())) for i in range(n) for j in range(n) if i != j and rng.random() < 0.4] for s, n in samples.items()}
    obs = spark.createDataFrame([(s, 100 + 7 * i) for s, n in samples.items() for i in range(n)], "sample_id string, obs_id long")
    cells = spark.createDataFrame(
        [(s, 100 + 7 * i, g, float(v)) for s in samples for (i, g), v in np.ndenumerate(x[s]) if v],
        "sample_id string, obs_id long, var_id long, x double",
    )
    w = spark.createDataFrame(
        [(s, 100 + 7 * i, 100 + 7 * j, v) for s in samples for i, j, v in links[s]], "sample_id string, src long, dst long, w double"
    )
    # Gene 9 has no value at any spot, so all of its permutations are alike.
    want, tests = {}, []
    for s, n in samples.items():
        for g in [*range(5), 9]:
            values = []
            for p in range(1, perms + 1):
                a = x[s][permuted.permutation(n, p, 5), g] if g < 5 else np.zeros(n)
                values.append(2.0 * (sum(v * a[i] * a[j] for i, j, v in links[s]) - 0.5 * sum(v * (a[i] + a[j]) for i, j, v in links[s]) + 3.0))
            least = float(np.median(values)) - 1e-9
            tests.append((s, g, 0.5, 2.0, 3.0, least))
            want[s, g] = int(sum(v >= least for v in values))
    tests = spark.createDataFrame(tests, "sample_id string, var_id long, mean double, unit double, constant double, least double")
    small = dict(links=13, values=50, perms=2)
    for sizes in ({}, small, {"max_spots": 10, **small}, {"max_links": 40}):
        rows = permuted.permuted_counts(cells, obs, w, tests, perms, 5, **sizes).collect()
        assert {(r.sample_id, r.var_id): r.larger for r in rows} == want and len(rows) == len(want), sizes


def test_inverse_distance_sums_meet_each_pair_once(spark, monkeypatch):
    """Most spots have no value; a pair of different blocks is met once, for both of them."""
    rng, n = np.random.default_rng(13), 60
    xy = rng.random((n, 2)) * 9
    obs = spark.createDataFrame([("s", i, float(a), float(b)) for i, (a, b) in enumerate(xy)], "sample_id string, obs_id long, px double, py double")
    x = np.zeros((n, 2))
    x[:5, 0], x[3:9, 1] = rng.integers(1, 9, 5), rng.integers(1, 9, 6)
    rows = [("s", i, g, float(v)) for (i, g), v in np.ndenumerate(x) if v]
    counts = spark.createDataFrame(rows, "sample_id string, obs_id long, var_id long, x double")
    w = 1 / (np.hypot(*(xy[:, None] - xy[None, :]).transpose(2, 0, 1)) + 1e-10)
    np.fill_diagonal(w, 0)
    w /= w.sum(axis=1, keepdims=True)
    z = x - x.mean(axis=0)
    met, one = [], autocorrelation.each_pair

    def counted(rows, *rest):
        met.append([(r.i, r.j) for r in rows.select("i", "j").collect()])
        return one(rows, *rest)

    monkeypatch.setattr(autocorrelation, "each_pair", counted)
    for block in (13, 1024):
        found = autocorrelation.moran_inverse_distance(counts, obs, counts.select("var_id").distinct(), block=block)
        got = {r.var_id: r.i for r in found.collect()}
        for g in (0, 1):
            assert abs(got[g] - (z[:, g] @ w @ z[:, g]) / (z[:, g] @ z[:, g])) < 1e-9, block
    assert met and all(len({frozenset(p) for p in pairs}) == len(pairs) for pairs in met)


def test_large_groups_have_few_meeting_blocks(spark):
    """What pairs of blocks send grows with the points of a group: the number of its blocks has an end."""
    points = spark.range(60).selectExpr("'s' AS sample_id", "id AS obs_id").unionByName(spark.range(5).selectExpr("'t' AS sample_id", "id AS obs_id"))
    for options, want in (({}, {"s": 15, "t": 2}), ({"meeting": 3}, {"s": 3, "t": 2}), ({"meeting": 3, "widest": 10}, {"s": 6, "t": 2})):
        packed = blocks.pack_blocks(points, ["sample_id"], ["obs_id"], block=4, **options).collect()
        assert {r.sample_id: r.n_blocks for r in packed} == want
        assert sorted((r.sample_id, p.obs_id) for r in packed for p in r.pts) == sorted(map(tuple, points.collect()))
    assert [(p.start, p.stop) for p in blocks.pieces(5, 3, 6)] == [(0, 2), (2, 4), (4, 6)]
    assert len(list(blocks.pieces(3, 100, 6))) == 3


def test_local_fit_reads_columns(spark, monkeypatch):
    """The driver holds two numbers a gene, not a Python row."""
    from pyspark.sql.classic.dataframe import DataFrame as Classic

    from spotframe.operators import variable_genes

    rng = np.random.default_rng(14)
    x, y = np.round(rng.random(40), 2), rng.random(40)
    genes = spark.createDataFrame(list(zip(x.tolist(), y.tolist())), "lm double, lv double")

    def refused(*_):
        raise AssertionError("rows in the driver")

    for name in ("toPandas", "collect"):
        monkeypatch.setattr(Classic, name, refused)
    fit = variable_genes._local_fit(genes, 0.3)
    monkeypatch.undo()
    got = {r.lm: r.fit for r in genes.select("lm", fit("lm").alias("fit")).collect()}
    order = np.lexsort((y, x))
    want = variable_genes.local_quadratic(np.unique(x), x[order], y[order], 0.3)
    assert all(abs(got[v] - w) < 1e-12 for v, w in zip(np.unique(x).tolist(), want))
