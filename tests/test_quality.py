import pytest
from pyspark.sql import functions as F

from spotframe import SpatialDataset
from spotframe.functions.numeric import exact_quantiles
from spotframe.operators import profile, qc


def uniform(cells, spots, genes):
    """Three spots with the same total."""
    counts = cells([("s", i, g, 2.0) for i in range(3) for g in range(2)])
    return SpatialDataset(obs=spots([("s", i, i, 0) for i in range(3)]), var=genes(["A", "B"]), counts=counts)


def test_uniform_sample_is_found_and_fixed(cells, spots, genes):
    data = uniform(cells, spots, genes)
    codes = {r.code for r in profile.findings(data).collect()}
    assert {"uniform_totals", "no_variation", "low_totals", "all_in_tissue", "missing_spatial_metadata"} == codes
    fixed, found = profile.load_checked(data)
    assert "uniform_totals" not in {r.code for r in found.collect()}
    factors = [r.x / 2.0 for r in fixed.counts.collect()]
    assert all(0.7 <= f < 1.3 for f in factors) and len(set(factors)) == 3
    again, provenance = profile.fix_uniformity(data.obs, data.counts.repartition(7))
    assert sorted(again.collect()) == sorted(fixed.counts.collect())
    row = provenance.first()
    assert row.applied and row.original_total == 4.0 and row.new_min_total < row.new_max_total


def test_check_without_fix_keeps_counts(cells, spots, genes):
    data = uniform(cells, spots, genes)
    kept, found = profile.load_checked(data, fix=False)
    assert kept.counts is data.counts and found.where("code = 'uniform_totals'").count() == 1


def test_missing_columns_are_reported(cells, spots, genes):
    data = uniform(cells, spots, genes)
    bare = data.with_(obs=data.obs.drop("px", "in_tissue"))
    assert {"missing_coordinates", "missing_in_tissue"} <= {r.code for r in profile.findings(bare).collect()}
    light = {(r.level, r.code) for r in profile.light_findings(bare).collect()}
    assert light == {("issue", "missing_coordinates"), ("warning", "missing_in_tissue")}


def test_light_findings_on_empty_and_negative(cells, spots, genes):
    data = uniform(cells, spots, genes)
    empty = data.with_(obs=data.obs.limit(0), counts=cells([("s", 0, 0, -1.0)]), var=genes(["A", "A"]))
    codes = {r.code for r in profile.light_findings(empty).collect()}
    assert codes == {"no_spots", "negative_values", "duplicate_genes"}


def test_empty_spot_keeps_a_row(cells, spots, genes):
    obs = spots([("s", 0, 0, 0), ("s", 1, 1, 0)])
    var = qc.gene_families(genes(["MT-1", "HBA1", "HBP1", "RPS2", "RPL3", "X"]))
    flags = {r.gene: (r.mt, r.ribo, r.hb) for r in var.collect()}
    assert flags["MT-1"] == (True, False, False) and flags["RPS2"] == flags["RPL3"] == (False, True, False)
    assert flags["HBA1"] == (False, False, True) and flags["HBP1"] == flags["X"] == (False, False, False)
    rows = {r.obs_id: r for r in qc.spot_metrics(obs, var, cells([("s", 0, 0, 3.0), ("s", 0, 5, 1.0)])).collect()}
    assert rows[0].pct_counts_mt == 75.0 and rows[0].n_genes_by_counts == 2
    assert rows[1].total_counts == 0 and rows[1].n_genes_by_counts == 0 and rows[1].pct_counts_mt is None
    cascade = qc.filter_cascade(qc.spot_metrics(obs, var, cells([("s", 0, 0, 3.0)])), max_pct_mt=100.0).first()
    assert (cascade.after_tissue, cascade.after_mt_filter, cascade.spots_removed) == (2, 1, 1)


def test_top_share_beyond_gene_count_is_null(cells, spots, genes):
    obs = spots([("s", 0, 0, 0)])
    counts = cells([("s", 0, 0, 3.0), ("s", 0, 1, 1.0)])
    row = qc.top_gene_share(obs, genes(["A", "B"]), counts, sizes=(1, 2, 3)).first()
    assert row.pct_counts_in_top_1_genes == 75.0 and row.pct_counts_in_top_2_genes == 100.0
    assert row.pct_counts_in_top_3_genes is None


def test_zero_radius_density_is_zero(spots):
    same = spots([("s", i, 4, 4) for i in range(5)])
    assert {r.local_density for r in qc.local_density(same).collect()} == {0}


def test_density_counts_coincident_points(spark, spots):
    obs = spots([("s", 0, 0, 0), ("s", 1, 0, 0), ("s", 2, 1, 0), ("s", 3, 2, 0), ("t", 4, 0, 0)])
    radius = spark.createDataFrame([("s", 1.5), ("t", 1.5)], "sample_id string, radius double")
    for block in (1, 2048):
        got = {r.obs_id: r.n_within for r in qc.count_within(obs, radius, block=block).collect()}
        assert got == {0: 2, 1: 2, 2: 3, 3: 1, 4: 0}


@pytest.mark.parametrize("parts", [1, 5])
def test_quantiles_match_numpy_with_a_hot_value(spark, parts):
    import numpy as np

    values = [1.0] * 500 + [float(v) for v in range(2, 400)]
    df = spark.createDataFrame([("g", v) for v in values] + [("h", 7.0)], "k string, v double").repartition(parts)
    got = {r.k: r for r in exact_quantiles(df, ["k"], "v", {"q1": 0.25, "q2": 0.5, "q9": 0.9}).collect()}
    want = np.quantile(values, [0.25, 0.5, 0.9])
    assert np.allclose([got["g"].q1, got["g"].q2, got["g"].q9], want) and got["h"].q9 == 7.0


def test_gene_filter_honours_both_limits(cells, genes):
    counts = cells([("s", i, 0, 1.0) for i in range(3)] + [("s", 0, 1, 9.0)])
    assert [r.var_id for r in qc.filter_genes(genes(["A", "B"]), counts, min_cells=2).collect()] == [0]
    assert qc.filter_genes(genes(["A", "B"]), counts, min_cells=1, min_counts=5).collect()[0].var_id == 1


def test_one_spot_summary_has_no_spread(cells, spots, genes):
    metrics = qc.spot_metrics(spots([("s", 0, 0, 0)]), genes(["A"]), cells([("s", 0, 0, 2.0)]), families=())
    row = qc.metric_summary(metrics).where(F.col("metric") == "total_counts").first()
    assert row["median"] == 2.0 and row["std"] is None
