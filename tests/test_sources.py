import gzip
import json
import re
import struct
import zlib

import pytest

from spotframe import SpatialDataset
from spotframe.plans import report, standard
from spotframe.operators import panels, plotdata
from spotframe.sources import storage, visium
from spotframe.sources.names import unique_names


def png(path, width, height):
    raw = b"".join(b"\0" + bytes((3 * (y * width + x) + c) % 256 for x in range(width) for c in range(3)) for y in range(height))

    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def sample(root, name, cells, header, packed):
    matrix, spatial = root / name / visium.COUNT_DIR, root / name / "spatial"
    matrix.mkdir(parents=True)
    spatial.mkdir()

    def put(file, text):
        if packed:
            (matrix / f"{file}.gz").write_bytes(gzip.compress(text.encode()))
        else:
            (matrix / file).write_text(text)

    lines = ["%%MatrixMarket matrix coordinate integer general", '%metadata_json: {"v": 2}', f"3 2 {len(cells)}"]
    put("matrix.mtx", "\n".join(lines + [f"{g} {s} {v}" for g, s, v in cells]) + "\n")
    put("features.tsv", "E1\tKRT19\tGene Expression\nE2\tACTB\tGene Expression\nE3\tKRT19\tGene Expression\n")
    put("barcodes.tsv", "AAA-1\nCCC-1\n")
    titles = "barcode,in_tissue,array_row,array_col,pxl_row_in_fullres,pxl_col_in_fullres\n"
    rows = "CCC-1,0,1,3,40,30\nAAA-1,1,0,2,20,10\n"
    file = "tissue_positions.csv" if header else "tissue_positions_list.csv"
    (spatial / file).write_text((titles if header else "") + rows)
    (spatial / "scalefactors_json.json").write_text(json.dumps({f: i + 0.5 for i, f in enumerate(visium.SCALE_FIELDS)}, indent=1))
    png(spatial / "tissue_hires_image.png", 8, 5)


@pytest.fixture
def folder(tmp_path):
    # The first triplet equals the size line on purpose.
    sample(tmp_path, "one", [(3, 2, 3), (1, 1, 5), (2, 1, 1)], header=False, packed=True)
    sample(tmp_path, "two", [(1, 2, 7)], header=True, packed=False)
    return tmp_path


def test_read_folders(spark, folder):
    data = visium.read_visium(spark, f"{folder}/*")
    assert [(r.var_id, r.gene_id, r.gene_unique) for r in data.var.orderBy("var_id").collect()] == [
        (1, "E1", "KRT19"), (2, "E2", "ACTB"), (3, "E3", "KRT19-1"),
    ]
    got = {(r.sample_id, r.obs_id, r.var_id): r.x for r in data.counts.collect()}
    assert got == {("one", 2, 3): 3.0, ("one", 1, 1): 5.0, ("one", 1, 2): 1.0, ("two", 2, 1): 7.0}
    spots = {(r.sample_id, r.barcode): r for r in data.obs.collect()}
    assert len(spots) == 4
    row = spots[("one", "AAA-1")]
    assert (row.obs_id, row.in_tissue, row.array_row, row.array_col, row.px, row.py) == (1, True, 0, 2, 10.0, 20.0)
    assert spots[("two", "CCC-1")].in_tissue is False
    factors = {r.sample_id: r.spot_diameter_fullres for r in data.scalefactors.collect()}
    assert factors == {"one": 3.5, "two": 3.5}
    shown = {(r.sample_id, r.image_key): r for r in visium.image_inventory(data.images).collect()}
    assert set(shown) == {("one", "hires"), ("two", "hires")}
    image = shown[("one", "hires")]
    assert (image.height, image.width, image.n_channels, image.dtype, image.min, image.max) == (5, 8, 3, "uint8", 0, 119)


def test_one_folder_without_images(spark, folder):
    data = visium.read_visium(spark, f"{folder}/one", load_images=False)
    assert data.images is None and data.counts.count() == 3


def small(cells, spots, genes):
    rows = [("0", i, g, float(1 + (i * g) % 5)) for i in range(12) for g in range(8)]
    more = [("1", i, g, float(1 + (i + g) % 4)) for i in range(9) for g in range(8)]
    places = [("0", i, i % 4, i // 4) for i in range(12)] + [("1", i, i % 3, i // 3) for i in range(9)]
    return SpatialDataset(obs=spots(places), var=genes(["MT-A", "KRT19", "ACTB", *"CDEFG"]), counts=cells(rows + more))


def test_save_load_snapshot(spark, tmp_path, cells, spots, genes):
    data = small(cells, spots, genes)
    data = data.with_(clusters=data.obs.select("sample_id", "obs_id"))
    path = storage.snapshot(data, str(tmp_path), "run")
    assert re.search(r"/run_\d{8}_\d{6}$", path)
    again = storage.load(spark, path)
    assert set(again.tables()) == set(data.tables())
    for name, df in data.tables().items():
        other = again.tables()[name]
        assert other.schema.simpleString() == df.schema.simpleString()
        assert sorted(map(str, other.collect())) == sorted(map(str, df.collect()))
    assert "sample_id=0" in " ".join(str(p) for p in (tmp_path / path.split("/")[-1] / "counts").iterdir())


def test_chains_and_report(spark, tmp_path, cells, spots, genes):
    from spotframe.sources.panels import panel_table

    data = small(cells, spots, genes)
    checked = standard.quality_control(data, min_cells=5, min_counts=None, max_counts=None, min_genes=1, max_pct_mt=None)
    assert checked.obs.count() == 21 and checked.extras["qc_cascade"].count() == 2
    ready = standard.preprocess(checked, n_top_genes=6, n_pcs=3)
    assert {"x", "x_raw"} <= set(ready.counts.columns) and ready.extras["hvg"].where("highly_variable").count() == 6
    assert len(ready.extras["scores"].first().pcs) == 3
    table = panel_table(spark, {"t": {"p": ["KRT19", "none"]}})
    done = standard.spatial_analysis(ready, table, n_neighbors=3, cluster_method="louvain")
    assert done.extras["edges"].count() == 63 and done.extras["panel_scores"].count() == 21
    assert done.obs.where("spatial_clusters IS NULL").count() == 0
    figures = plotdata.figure_tables(done.obs, done.var, done.extras["edges"], done.extras["markers"], done.extras["panel_scores"])
    assert {"histogram_total_counts", "scatter", "boxes", "summary", "edges", "markers", "panel_correlation"} <= set(figures)
    rows = report.analysis_report(checked.obs, checked.var, done.extras["clusters"], "louvain", done.extras["panel_statistics"].select("panel", "n_available").distinct())
    facts = {(r.section, r.metric): r.value for r in rows.collect()}
    assert facts[("dataset", "spots")] == "21" and facts[("gene panels", "p")] == "1"
    report.write_report(rows, f"{tmp_path}/report")
    assert spark.read.text(f"{tmp_path}/report").where("value LIKE '%louvain%'").count() == 1
    written = storage.export_tables(str(tmp_path), qc_metrics=checked.extras["qc_metrics"], cluster_markers=done.extras["markers"])
    assert written == ["qc_metrics", "cluster_markers"]
    assert spark.read.csv(f"{tmp_path}/qc_metrics.csv", header=True).count() == 21


def test_expression_graph_chain(spark, cells, spots, genes):
    ready = standard.preprocess(small(cells, spots, genes), hvg_method="cell_ranger", n_top_genes=6, n_pcs=3, scale=False)
    done = standard.spatial_analysis(ready, n_neighbors=3, graph="expression", cluster_method="louvain", marker_method="t-test")
    assert done.extras["clusters"].count() == 21 and done.extras["moran"].count() > 0


def test_panels_find_genes_by_unique_names(spark, cells, spots):
    var = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a-1"), (4, "b-99999999999999999999")], "var_id long, gene string")
    named = unique_names(var)
    assert {r.var_id: r.gene_unique for r in named.collect()} == {1: "a", 2: "a-2", 3: "a-1", 4: "b-99999999999999999999"}
    counts = cells([("s", 1, 1, 4.0), ("s", 1, 2, 2.0)])
    obs = spots([("s", 1, 0, 0), ("s", 2, 1, 0)])
    panel = spark.createDataFrame([("p", 1, "a"), ("q", 1, "a-2"), ("q", 2, "c")], "panel string, ord long, gene string")
    scores = {(r.obs_id, r.panel): r.score for r in panels.panel_scores(counts, obs, named, panel).collect()}
    assert scores == {(1, "p"): 4.0, (2, "p"): 0.0, (1, "q"): 2.0, (2, "q"): 0.0}
    found = {r.panel: (r.available, r.missing) for r in panels.panel_genes_found(panel, named).collect()}
    assert found == {"p": (["a"], []), "q": (["a-2"], ["c"])}
    layer = plotdata.gene_layer(obs, named, counts, "a").orderBy("obs_id").collect()
    assert [(r.obs_id, r.value) for r in layer] == [(1, 4.0), (2, 0.0)]


def test_intermediates_are_shared_and_can_go(spark):
    import os

    from spotframe.functions.storage import release, shared_dir, stable

    table = stable(spark.range(5))
    path = table._written
    assert path.startswith(shared_dir(spark)) and table.count() == 5
    local = path.removeprefix("file:")
    assert os.path.isdir(local)
    release(table)
    assert not os.path.isdir(local)


def test_permutation_query_runs_the_default_number(monkeypatch):
    """A smallest p of 1/1001, as the operator and not a query's own number has it."""
    from spotframe.operators import autocorrelation
    from spotframe.registry import spatial
    from spotframe.registry.core import QUERIES

    drawn = []
    monkeypatch.setattr(spatial, "inputs", lambda spark, sf: (type("D", (), {"obs": None}), None))
    monkeypatch.setattr(spatial.variable_genes, "default_genes", lambda *a: None)
    monkeypatch.setattr(spatial.neighbours, "spatial_graph", lambda obs: None)
    monkeypatch.setattr(spatial, "stable", lambda df: df)
    monkeypatch.setattr(spatial, "rounded", lambda df: df)
    monkeypatch.setattr(autocorrelation, "moran_permutation", lambda *a, n_perms=autocorrelation.N_PERMS: drawn.append(n_perms))
    QUERIES["g2_moran_permutation"](None, "")
    assert drawn == [1_000]
