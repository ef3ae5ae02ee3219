import math

import numpy as np
import pytest

from spotframe.functions.special import incomplete_beta
from spotframe.operators import autocorrelation, krylov, markers, normalise, panels, permuted, reduction, stats, variable_genes
from spotframe.operators.neighbours import lattice_graph
from spotframe.sources.names import unique_names


def dense(cells, spots, genes, matrix, sample="s"):
    n, g = matrix.shape
    counts = cells([(sample, i, j, float(matrix[i, j])) for i in range(n) for j in range(g) if matrix[i, j] != 0])
    return counts, spots([(sample, i, i, 0) for i in range(n)]), genes([f"G{j}" for j in range(g)])


def test_unique_names_skip_taken_numbers(spark):
    rows = list(enumerate(["g", "g", "g-1", "h", "g", "h"]))
    var = spark.createDataFrame(rows, "var_id long, gene string")
    got = {r.var_id: r.gene_unique for r in unique_names(var).collect()}
    assert got == {0: "g", 1: "g-2", 2: "g-1", 3: "h", 4: "g-3", 5: "h-1"}


def test_excluded_genes_are_scaled_but_not_counted(cells):
    counts = cells([("s", 0, 0, 90.0), ("s", 0, 1, 10.0), ("s", 1, 1, 5.0), ("s", 1, 2, 5.0), ("s", 2, 0, 3.0)])
    out = normalise.normalize_total(counts, target_sum=100.0, max_fraction=0.6)
    got = {(r.obs_id, r.var_id): r.x for r in out.collect()}
    assert got == {(0, 0): 900.0, (0, 1): 100.0, (1, 1): 50.0, (1, 2): 50.0, (2, 0): 3.0}


def test_scale_constant_and_clipped_gene(cells, spots, genes):
    m = np.zeros((30, 2))
    m[:, 0], m[0, 1] = 3.0, 100.0
    counts, obs, var = dense(cells, spots, genes, m)
    vectors, factors = reduction.scaled_spots(counts, obs, var, max_value=2.0)
    z = {(r.obs_id, r.var_id): r.z for r in reduction.scaled_cells(vectors, factors).collect()}
    assert len(z) == 60 and all(z[(i, 0)] == 0.0 for i in range(30)) and z[(0, 1)] == 2.0
    plain, _ = reduction.scaled_spots(counts, obs, var, max_value=None, zero_center=False)
    assert min(min(r["values"]) for r in plain.collect()) == 0.0


def test_pca_matches_numpy(cells, spots, genes):
    rng = np.random.default_rng(2)
    m = rng.poisson(2.0, (80, 12)) * np.linspace(1, 4, 12)
    counts, obs, var = dense(cells, spots, genes, m)
    scores, loadings, variance = reduction.pca(counts, obs, var, 4)
    c = m - m.mean(axis=0)
    values, axes = np.linalg.eigh(c.T @ c / 79)
    values, axes = values[::-1], axes[:, ::-1][:, :4]
    axes *= np.where(axes[np.abs(axes).argmax(axis=0), np.arange(4)] < 0, -1, 1)
    got = {r.obs_id: r.pcs for r in scores.collect()}
    assert np.allclose([got[i] for i in range(80)], c @ axes, atol=1e-8)
    table = {r.pc: r for r in reduction.variance_table(variance).collect()}
    assert np.allclose([table[k].variance for k in range(4)], values[:4])
    assert np.allclose([table[k].ratio for k in range(4)], values[:4] / values.sum())
    assert table[3].cumulative == pytest.approx(values[:4].sum() / values.sum())
    l = {(r.var_id, r.pc): r.loading for r in loadings.collect()}
    assert np.allclose([[l[(j, k)] for k in range(4)] for j in range(12)], axes)
    sums = reduction.variance_sums(variance).first()
    assert sums.top10 == pytest.approx(sums.top50)


def test_randomised_components_match_numpy(cells, spots, genes, monkeypatch):
    rng = np.random.default_rng(5)
    # Three blocks a search before it starts again, and runs of a few spots.
    monkeypatch.setattr(krylov, "_CHUNK", 200)
    m = rng.poisson(0.4, (150, 60)) * np.linspace(1, 3, 60)
    m[:, 7] = 0
    m[[0, 77, 149]] = 0
    counts, obs, var = dense(cells, spots, genes, m)
    scores, loadings, variance = krylov.leading_components(counts, obs, var, 4, oversample=3, depth=3, tolerance=1e-10)
    c = m - m.mean(axis=0)
    values, axes = np.linalg.eigh(c.T @ c / 149)
    values, axes = values[::-1], axes[:, ::-1][:, :4]
    axes *= np.where(axes[np.abs(axes).argmax(axis=0), np.arange(4)] < 0, -1, 1)
    got = {r.obs_id: r.pcs for r in scores.collect()}
    assert np.allclose([got[i] for i in range(150)], c @ axes, atol=1e-6)
    l = {(r.var_id, r.pc): r.loading for r in loadings.collect()}
    assert np.allclose([[l[(j, k)] for k in range(4)] for j in range(60)], axes, atol=1e-6)
    table = {r.pc: r for r in variance.collect()}
    assert np.allclose([table[k].variance for k in range(4)], values[:4])
    assert np.allclose([table[k].ratio for k in range(4)], values[:4] / values.sum())
    assert max(table[k].residual for k in range(4)) <= 1e-10


def test_randomised_components_tell_when_cut_short(cells, spots, genes):
    m = np.random.default_rng(6).random((90, 50))
    counts, obs, var = dense(cells, spots, genes, m)
    rows = krylov.leading_components(counts, obs, var, 3, oversample=1, passes=1)[2].collect()
    assert max(r.residual for r in rows) > 1e-3


@pytest.mark.parametrize("m", [np.zeros((3, 4)), np.full((4, 3), 2.0), np.eye(1, 2), np.outer(np.arange(5.0), [1.0, 2.0])])
def test_randomised_components_of_low_rank(cells, spots, genes, m):
    counts, obs, var = dense(cells, spots, genes, m)
    scores, loadings, variance = reduction.pca(counts, obs, var, 2, solver="randomized")
    c = m - m.mean(axis=0)
    k = min(2, *m.shape)
    want = np.linalg.svd(c, compute_uv=False)[:k] ** 2 / max(len(m) - 1, 1)
    got = [r.variance for r in variance.orderBy("pc").collect()]
    assert np.allclose(got, want, atol=1e-9)
    assert scores.count() == len(m) and loadings.count() == k * m.shape[1]
    assert all((r.ratio is None) == (want.sum() == 0) for r in variance.collect())


def test_randomised_components_of_nothing(cells, spots, genes):
    none = genes(["a"]).limit(0)
    for obs, var in ((spots([("s", 0, 0, 0)]), none), (spots([("s", 0, 0, 0)]).limit(0), genes(["a"]))):
        for table in krylov.leading_components(cells([("s", 0, 0, 1.0)]), obs, var, 3):
            assert table.count() == 0
    with pytest.raises(ValueError):
        reduction.pca(cells([("s", 0, 0, 1.0)]), spots([("s", 0, 0, 0)]), none, solver="qr")


def test_seurat_v3_matches_dense_formula(cells, spots, genes):
    rng = np.random.default_rng(4)
    m = rng.negative_binomial(3, 0.3, (60, 25)) * (rng.random((60, 25)) < 0.5)
    m[:, 7] = 0
    m[0, 3] = 400
    counts, obs, var = dense(cells, spots, genes, m.astype(float))
    got = {r.var_id: r for r in variable_genes.hvg_seurat_v3(counts, obs, var, 5).collect()}
    mean, v = m.mean(axis=0), m.var(axis=0, ddof=1)
    ok = v > 0
    order = np.argsort(np.log10(mean[ok]), kind="stable")
    lx, ly = np.log10(mean[ok])[order], np.log10(v[ok])[order]
    q = int(0.3 * ok.sum())
    for j in np.flatnonzero(ok):
        at = np.log10(mean[j])
        near = np.argsort(np.abs(lx - at), kind="stable")[:q]
        w = (1 - (np.abs(lx[near] - at) / np.abs(lx[near] - at).max()) ** 3) ** 3
        fit = np.polyval(np.polyfit(lx[near] - at, ly[near], 2, w=np.sqrt(np.maximum(w, 0))), 0)
        s = np.sqrt(10**fit)
        c = np.minimum(m[:, j], s * np.sqrt(60) + mean[j])
        want = ((c - mean[j]) ** 2).sum() / (59 * s * s)
        assert got[j].score == pytest.approx(want, rel=1e-6)
    assert got[7].score == 0.0 and sum(r.highly_variable for r in got.values()) == 5


def ranks(v):
    order = np.argsort(v, kind="stable")
    out = np.empty(len(v))
    for value in np.unique(v):
        at = np.flatnonzero(v[order] == value)
        out[order[at]] = at.mean() + 1
    return out


@pytest.mark.parametrize("signed", [False, True])
def test_wilcoxon_matches_numpy_ranks(spark, cells, spots, genes, signed):
    rng = np.random.default_rng(6)
    m = rng.integers(0, 4, (40, 5)).astype(float)
    m[:, 4] = 1.0
    if signed:
        m[:, :4] -= 1
    counts, obs, var = dense(cells, spots, genes, m)
    label = np.array(["a", "b", "c", "a"] * 10)
    label[0] = "one"
    clusters = spark.createDataFrame([("s", i, str(g)) for i, g in enumerate(label)], "sample_id string, obs_id long, cluster string")
    got = {(r.cluster, r.var_id): r for r in markers.wilcoxon(counts, var, clusters).collect()}
    assert len(got) == 20
    for g in np.unique(label):
        k = (label == g).sum()
        for j in range(5):
            r = ranks(m[:, j])[label == g].sum()
            z = (r - k * 41 / 2) / math.sqrt(k * (40 - k) * 41 / 12)
            row = got[(g, j)]
            assert row.score == pytest.approx(z, abs=1e-9)
            assert row.pval == pytest.approx(math.erfc(abs(z) / math.sqrt(2)))
    for g in np.unique(label):
        ps = sorted(r.pval for (c, _), r in got.items() if c == g)
        adj = sorted(r.pval_adj for (c, _), r in got.items() if c == g)
        want = np.minimum.accumulate((np.array(ps) * 5 / np.arange(1, 6))[::-1])[::-1]
        assert np.allclose(adj, np.minimum(want, 1.0))


def test_t_test_constant_gene_and_p(spark, cells, spots, genes):
    m = np.array([[1.0, 5.0], [1.0, 6.0], [1.0, 7.0], [1.0, 1.0], [1.0, 2.0], [1.0, 0.0]])
    counts, obs, var = dense(cells, spots, genes, m)
    clusters = spark.createDataFrame([("s", i, "ab"[i // 3]) for i in range(6)], "sample_id string, obs_id long, cluster string")
    got = {(r.cluster, r.var_id): r for r in markers.t_test(counts, var, clusters).collect()}
    assert got[("a", 0)].score == 0.0 and got[("a", 0)].pval == 1.0
    # t = 5 / sqrt(2/3), 4 degrees of freedom.
    t = 5 / math.sqrt(2 / 3)
    exact = 1 - t * (t * t + 6) / (t * t + 4) ** 1.5
    assert got[("a", 1)].score == pytest.approx(t) and got[("a", 1)].pval == pytest.approx(exact, rel=1e-9)


def test_incomplete_beta_known_values():
    x = np.linspace(0, 1, 11)
    assert np.allclose(incomplete_beta(1.0, 1.0, x), x)
    assert np.allclose(incomplete_beta(2.0, 2.0, x), x * x * (3 - 2 * x))


def test_logreg_ranks_the_planted_gene_first(spark, cells, spots, genes):
    rng = np.random.default_rng(8)
    m = rng.random((60, 6))
    label = np.arange(60) % 3
    m[np.arange(60), label] += 3
    counts, obs, var = dense(cells, spots, genes, m)
    clusters = spark.createDataFrame([("s", i, f"c{g}") for i, g in enumerate(label)], "sample_id string, obs_id long, cluster string")
    ranking = markers.logreg(counts, obs, var, clusters)
    first = {r.cluster: r.var_id for r in ranking.where("rank = 1").collect()}
    assert first == {"c0": 0, "c1": 1, "c2": 2}
    # Without fold changes the cut is skipped.
    assert markers.top_markers(ranking, 2).count() == 6


def test_logreg_fit_is_the_optimum_on_a_wide_assay(spark):
    """More genes than dense vectors allow, a spot without values, a gene without any: the gradient by numpy is 0."""
    rng = np.random.default_rng(4)
    width, used = 30_000, [0, 5, 17_000, 29_999]
    x = np.where(rng.random((40, 4)) < 0.6, rng.normal(size=(40, 4)) * 2, 0.0)
    x[7] = 0
    label = np.arange(40) % 3
    obs = spark.createDataFrame([("s", i) for i in range(40)], "sample_id string, obs_id long")
    counts = spark.createDataFrame(
        [("s", i, used[j], float(v)) for (i, j), v in np.ndenumerate(x) if v], "sample_id string, obs_id long, var_id long, x double"
    )
    clusters = spark.createDataFrame([("s", i, f"c{g}") for i, g in enumerate(label)], "sample_id string, obs_id long, cluster string")
    var = spark.range(width).withColumnRenamed("id", "var_id")
    coefficients, intercepts = markers.logreg_fit(counts, obs, var, clusters)
    rows = {(r.cluster, r.var_id): r.coefficient for r in coefficients.collect()}
    assert len(rows) == 3 * width and rows["c0", 1] == 0
    w = np.array([[rows[f"c{c}", g] for g in used] for c in range(3)])
    b = {r.cluster: r.intercept for r in intercepts.collect()}
    z = x @ w.T + [b[f"c{c}"] for c in range(3)]
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    off = p - np.eye(3)[label]
    assert np.abs(off.T @ x + w).max() < 1e-4 and np.abs(off.sum(axis=0)).max() < 1e-4
    got = markers.logreg_gradient(counts, obs, clusters, coefficients, intercepts)
    assert {(r.cluster, r.var_id) for r in got.collect()} == set(rows)
    # Away from the optimum the operator gives what numpy gives.
    moved = coefficients.withColumn("coefficient", coefficients.coefficient + 0.5)
    z = x @ (w + 0.5).T + [b[f"c{c}"] for c in range(3)]
    off = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True) - np.eye(3)[label]
    want = off.T @ x + w + 0.5
    far = {(r.cluster, r.var_id): r.gradient for r in markers.logreg_gradient(counts, obs, clusters, moved, intercepts).collect()}
    assert all(far[f"c{c}", g] == pytest.approx(want[c, j]) for c in range(3) for j, g in enumerate(used))


def board(spark, values):
    """A 6 x 6 square board as lattice spots with the rook graph."""
    obs = spark.createDataFrame(
        [("s", r * 6 + c, float(c), float(r)) for r in range(6) for c in range(6)],
        "sample_id string, obs_id long, px double, py double",
    )
    near = [(r * 6 + c, (r + a) * 6 + c + b) for r in range(6) for c in range(6) for a, b in ((0, 1), (1, 0), (0, -1), (-1, 0))
            if 0 <= r + a < 6 and 0 <= c + b < 6]
    edges = spark.createDataFrame([("s", a, b, 1.0) for a, b in near], "sample_id string, src long, dst long, weight double")
    rows = [("s", r * 6 + c, g, float(f(r, c))) for g, f in enumerate(values) for r in range(6) for c in range(6) if f(r, c)]
    return spark.createDataFrame(rows, "sample_id string, obs_id long, var_id long, x double"), obs, edges


def test_moran_signs_and_permutation(spark):
    counts, obs, edges = board(spark, [lambda r, c: (r + c) % 2, lambda r, c: c, lambda r, c: 2])
    got = {r.var_id: r for r in autocorrelation.moran_permutation(counts, obs, edges, n_perms=99).collect()}
    assert got[0].i == pytest.approx(-1.0) and got[1].i > 0.7 and got[2].i is None
    assert got[0].expected_i == pytest.approx(-1 / 35)
    assert got[1].pval_sim == pytest.approx(0.01) and got[0].pval_sim == 1.0 and got[2].pval_sim is None
    assert got[1].pval_norm < 1e-6 and got[1].z_norm > 0
    moved = permuted.permutations(obs, 3)
    assert moved.groupBy("perm").agg({"as_id": "approx_count_distinct"}).count() == 3
    assert moved.select("perm", "as_id").distinct().count() == moved.count() == 108


def test_permuted_sums_match_a_loop(spark):
    rng = np.random.default_rng(11)
    samples = {"s": 23, "t": 9, "u": 1}
    x = {s: np.where(rng.random((n, 5)) < 0.6, rng.integers(1, 9, (n, 5)), 0).astype(float) for s, n in samples.items()}
    links = {s: [(i, j, float(rng.random())) for i in range(n) for j in range(n) if i != j and rng.random() < 0.4] for s, n in samples.items()}
    obs = spark.createDataFrame([(s, 100 + 7 * i) for s, n in samples.items() for i in range(n)], "sample_id string, obs_id long")
    cells = spark.createDataFrame(
        [(s, 100 + 7 * i, g, float(v)) for s in samples for (i, g), v in np.ndenumerate(x[s]) if v],
        "sample_id string, obs_id long, var_id long, x double",
    )
    w = spark.createDataFrame(
        [(s, 100 + 7 * i, 100 + 7 * j, v) for s in samples for i, j, v in links[s]], "sample_id string, src long, dst long, w double"
    )
    want = {}
    for s, n in samples.items():
        for p in range(1, 8):
            taken = permuted.permutation(n, p, 5)
            assert sorted(taken) == list(range(n))
            for g in range(5):
                a = x[s][taken, g]
                want[s, p, g] = (sum(v * a[i] * a[j] for i, j, v in links[s]), sum(v * (a[i] + a[j]) for i, j, v in links[s]))
    small = dict(links=13, values=50, perms=3)
    for sizes in ({}, small, {"max_spots": 0}, {"max_spots": 10, **small}):
        rows = permuted.permuted_sums(cells, obs, w, 7, 5, **sizes).collect()
        got = {(r.sample_id, r.perm, r.var_id): (r.t1, r.t2) for r in rows}
        assert len(got) == len(rows)
        for key, sums in want.items():
            assert got.get(key, (0.0, 0.0)) == pytest.approx(sums), (sizes, key)
    assert permuted.permuted_sums(cells.limit(0), obs.limit(0), w.limit(0), 3).count() == 0


def test_inverse_distance_moran_matches_dense(spark):
    counts, obs, _ = board(spark, [lambda r, c: c, lambda r, c: (r * c) % 3, lambda r, c: 2])
    genes = counts.select("var_id").distinct()
    xy = np.array([(i % 6, i // 6) for i in range(36)], dtype=float)
    d = np.hypot(*(xy[:, None] - xy[None, :]).transpose(2, 0, 1))
    w = 1 / (d + 1e-10)
    np.fill_diagonal(w, 0)
    w /= w.sum(axis=1, keepdims=True)
    x = np.zeros((36, 3))
    for r in counts.collect():
        x[r.obs_id, r.var_id] = r.x
    z = x - x.mean(axis=0)
    for block in (10, 1024):
        got = {r.var_id: r.i for r in autocorrelation.moran_inverse_distance(counts, obs, genes, block=block).collect()}
        for g in (0, 1):
            assert got[g] == pytest.approx((z[:, g] @ w @ z[:, g]) / (z[:, g] @ z[:, g]))
        assert got[2] == 0.0


def test_correlations_with_constant_gene(cells, spots, genes):
    rng = np.random.default_rng(9)
    m = rng.integers(0, 5, (50, 4)).astype(float)
    m[:, 3] = 2.0
    counts, obs, var = dense(cells, spots, genes, m)
    for method, data in (("pearson", m), ("spearman", np.column_stack([ranks(m[:, j]) for j in range(4)]))):
        got = {(r.var_a, r.var_b): r.corr for r in stats.gene_correlation(counts, obs, var, method).collect()}
        want = np.corrcoef(data[:, :3].T)
        assert all(got[(i, j)] == pytest.approx(want[i, j]) for i in range(3) for j in range(3))
        assert got[(0, 3)] is None
    with pytest.raises(ValueError):
        stats.gene_correlation(counts, obs, var, "kendall")


def test_gram_in_blocks_matches_numpy(spark):
    rng = np.random.default_rng(12)
    samples = {"": 9, "t": 14}
    x = {s: np.where(rng.random((n, 11)) < 0.3, rng.normal(size=(n, 11)), 0.0) for s, n in samples.items()}
    for m in x.values():
        m[:, 4] = 0
    obs = spark.createDataFrame([(s, 3 * i) for s, n in samples.items() for i in range(n)], "sample_id string, obs_id long")
    cells = spark.createDataFrame(
        [(s, 3 * i, g, float(v)) for s in samples for (i, g), v in np.ndenumerate(x[s]) if v],
        "sample_id string, obs_id long, pos long, x double",
    )
    whole = np.vstack(list(x.values()))
    want = whole.T @ whole
    for genes_, spots_, run in ((512, 2048, 64), (4, 5, 2), (3, 100, 1)):
        rows = stats.gram(cells, permuted.places(obs), 11, genes_, spots_, run).collect()
        got = {(r.i, r.j): r.sxy for r in rows}
        assert len(rows) == len(got) == 66
        assert all(got[i, j] == pytest.approx(want[i, j], abs=1e-12) for i in range(11) for j in range(i, 11))


def test_panel_without_genes_is_skipped(spark, cells, spots, genes):
    counts, obs, var = dense(cells, spots, genes, np.array([[1.0, 3.0], [0.0, 0.0]]))
    table = spark.createDataFrame(
        [("t", "p", 0, "G0"), ("t", "p", 1, "none"), ("t", "p", 2, "G1"), ("t", "q", 0, "none")],
        "tissue string, panel string, ord long, gene string",
    )
    scores = {(r.obs_id, r.panel): r.score for r in panels.panel_scores(counts, obs, var, table).collect()}
    assert scores == {(0, "p"): 2.0, (1, "p"): 0.0}
    found = {r.panel: (r.available, r.missing) for r in panels.panel_genes_found(table, var).collect()}
    assert found == {"p": (["G0", "G1"], ["none"]), "q": ([], ["none"])}
    with pytest.raises(ValueError):
        panels.panel_genes(table, "p", "other")
    with pytest.raises(ValueError):
        panels.panel_genes(table, "z", "t")


def test_built_in_panels(spark):
    from spotframe.sources.panels import panel_table

    table = panel_table(spark)
    assert table.select("tissue", "panel").distinct().count() == 17
    assert [r.gene for r in panels.panel_genes(table, "neurons", "brain").orderBy("ord").collect()][:2] == ["RBFOX3", "SYP"]


def test_unknown_methods_raise(spark, cells, spots, genes):
    counts, obs, var = dense(cells, spots, genes, np.ones((2, 2)))
    with pytest.raises(ValueError):
        variable_genes.variable_genes("other", obs, var, counts, counts)
    with pytest.raises(ValueError):
        markers.rank_genes("other", counts, obs, var, obs)
    with pytest.raises(ValueError):
        stats.outliers(counts, "x", ["sample_id"], "other")


def test_lattice_graph_feeds_moran(spark):
    rows = [("s", r * 10 + c // 2, r, c) for r in range(6) for c in range(r % 2, 12, 2)]
    obs = spark.createDataFrame(rows, "sample_id string, obs_id long, array_row int, array_col int")
    counts = spark.createDataFrame([("s", i, 0, float(c + 1)) for _, i, _, c in rows], "sample_id string, obs_id long, var_id long, x double")
    assert autocorrelation.moran(counts, obs, lattice_graph(obs)).first().i > 0.5
