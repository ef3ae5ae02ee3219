"""Views of the driver tables as datasets: sparse counts, signed vectors, and a long metric column."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .dataset import SpatialDataset
from .functions.numeric import ordered_value_counts
from .functions.storage import stable
from .sources.names import unique_names
from .sources.visium import SCALE_FIELDS

PANEL_TISSUE = "fixture"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sparse(spark: SparkSession, sf_dir: str) -> SpatialDataset:
    """Spot = customer, gene = part, value = summed quantity."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    obs = sparse_obs(spark, sf_dir)
    cells = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("obs_id"), F.col("l_partkey").alias("var_id"))
        .agg(F.sum("l_quantity").cast("double").alias("x"))
    )
    counts = cells.join(obs.select("obs_id", "sample_id"), "obs_id").select("sample_id", "obs_id", "var_id", "x")
    return SpatialDataset(obs=obs, var=sparse_var(spark, sf_dir), counts=counts)


def sparse_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    row = F.floor(key / 40)
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("n_regionkey").cast("string").alias("sample_id"),
            key.alias("obs_id"),
            F.col("c_mktsegment").alias("cluster"),
            (F.col("c_nationkey") % 8 != 0).alias("in_tissue"),
            row.cast("int").alias("array_row"),
            (2 * (key % 40) + row % 2).cast("int").alias("array_col"),
            (F.col("c_acctbal") / 100.0).alias("px"),
            (((key * 7919) % 10007) / F.lit(100.0)).alias("py"),
        )
    )


# Gene-name prefix by part type; HBP must not match the haemoglobin rule.
PREFIXES = {"ECONOMY": "MT-", "PROMO": "RPS", "STANDARD": "RPL", "SMALL": "HBA", "LARGE": "HBP"}


def sparse_var(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = F.lit("GENE_")
    for kind, start in PREFIXES.items():
        prefix = F.when(F.col("p_type") == kind, start).otherwise(prefix)
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("var_id"),
        F.concat(prefix, F.col("p_partkey").cast("string")).alias("gene"),
        F.col("p_name").alias("gene_dup"),
        F.col("p_brand").alias("brand"),
    )


def named_var(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genes whose names repeat, with their unique names, as a sample reader returns them."""
    var = sparse_var(spark, sf_dir).select("var_id", F.col("gene_dup").alias("gene"), "brand")
    return unique_names(var)


def sparse_panels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One panel per brand with the unique names of all its genes plus one that does not exist, and a panel with none at all."""
    var = named_var(spark, sf_dir)
    tissue = F.lit(PANEL_TISSUE).alias("tissue")
    present = var.select(tissue, F.col("brand").alias("panel"), F.col("var_id").alias("ord"), F.col("gene_unique").alias("gene"))
    missing = var.select(tissue, F.col("brand").alias("panel")).distinct().select(
        "tissue", "panel", F.lit(0).cast("long").alias("ord"), F.concat(F.lit("MISSING_"), "panel").alias("gene")
    )
    absent = spark.createDataFrame([(PANEL_TISSUE, "absent", 0, "MISSING_absent")], missing.schema)
    return present.unionByName(missing).unionByName(absent)


def signed(spark: SparkSession, sf_dir: str) -> SpatialDataset:
    """Spot = vector, gene = position, value of either sign."""
    vectors = table(spark, sf_dir, "embeddings")
    place = lambda i: F.element_at("embedding", i).cast("double") * 100
    obs = vectors.select(
        F.lit("0").alias("sample_id"),
        F.col("vec_id").alias("obs_id"),
        F.col("label").cast("string").alias("cluster"),
        F.lit(True).alias("in_tissue"),
        place(1).alias("px"),
        place(2).alias("py"),
    )
    cells = vectors.select(F.col("vec_id").alias("obs_id"), F.posexplode("embedding").alias("pos", "v"))
    counts = cells.select(
        F.lit("0").alias("sample_id"), "obs_id", F.col("pos").cast("long").alias("var_id"), F.col("v").cast("double").alias("x")
    ).where(F.col("x") != 0)
    var = cells.select(F.col("pos").cast("long").alias("var_id")).distinct().select(
        "var_id", F.concat(F.lit("GENE_"), F.col("var_id").cast("string")).alias("gene")
    )
    return SpatialDataset(obs=obs, var=var, counts=counts)


def signed_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors themselves as score vectors."""
    return table(spark, sf_dir, "embeddings").select(
        F.lit("0").alias("sample_id"),
        F.col("vec_id").alias("obs_id"),
        F.col("embedding").cast("array<double>").alias("pcs"),
    )


def metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One value per event, grouped by event type."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("obs_id"), F.col("event_type").alias("cluster"), F.col("value").alias("x")
    )


def write_samples(data: SpatialDataset, path: str) -> None:
    """Sample folders in the usual layout: features, barcodes and positions in one file each, the matrix in parts.

    Each part of a matrix starts with the line that gives its size, which the reader drops from every file; the file
    ``matrix.mtx`` holds the banner and the size alone.
    """
    spark = data.obs.sparkSession
    obs = stable(data.obs)
    genes = stable(data.var.select("var_id", "gene"))
    n_genes = genes.count()
    features = genes.select(
        F.col("var_id").alias("ord"), F.concat_ws("\t", F.concat(F.lit("G"), "var_id"), "gene", F.lit("Gene Expression")).alias("value")
    )
    line_of_spot = _lines(obs, "obs_id", ["sample_id"])
    cells = data.counts.join(_lines(genes, "var_id"), "var_id").join(line_of_spot, ["sample_id", "obs_id"])
    # Every sample's cells are numbered in one pass and lie in a folder of their own.
    cells = stable(cells.select("sample_id", "line_var_id", "line_obs_id", "x"), by=["sample_id"])
    n_cells = {r["sample_id"]: r["count"] for r in cells.groupBy("sample_id").count().collect()}
    spots_of = {r["sample_id"]: r["count"] for r in obs.groupBy("sample_id").count().collect()}
    for sample in sorted(spots_of, key=lambda s: (s is not None, s)):
        folder, of = f"{path}/{sample}", F.col("sample_id") == sample
        spots = obs.where(of)
        size = [str(n_genes), str(spots_of[sample]), str(n_cells.get(sample, 0))]
        head = spark.createDataFrame([(-2, "%%MatrixMarket matrix coordinate real general"), (-1, " ".join(size))], "ord long, value string")
        barcodes = spots.select(F.col("obs_id").alias("ord"), F.concat(F.lit("B"), "obs_id").alias("value"))
        places = spots.select(
            F.col("obs_id").alias("ord"),
            F.concat_ws(",", F.concat(F.lit("B"), "obs_id"), F.col("in_tissue").cast("int"), "array_row", "array_col", "py", "px").alias("value"),
        )
        _one_file(head, f"{folder}/filtered_feature_bc_matrix", "matrix.mtx")
        _parts(cells.where(of), " ".join(size), f"{folder}/filtered_feature_bc_matrix", "matrix.mtx")
        _one_file(features, f"{folder}/filtered_feature_bc_matrix", "features.tsv")
        _one_file(barcodes, f"{folder}/filtered_feature_bc_matrix", "barcodes.tsv")
        _one_file(places, f"{folder}/spatial", "tissue_positions_list.csv")
        factors = ", ".join(f'"{name}": 1.0' for name in SCALE_FIELDS)
        _one_file(head.limit(1).select("ord", F.lit(f"{{{factors}}}").alias("value")), f"{folder}/spatial", "scalefactors_json.json")


def _lines(rows: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Line, from 1, of every key in ascending order, within the groups of ``by``."""
    placed = ordered_value_counts(rows.withColumn("_all", F.lit(0)), ["_all", *by], key)
    return placed.select(*by, key, (F.col("n_below") + 1).alias(f"line_{key}"))


def _one_file(rows: DataFrame, folder: str, name: str) -> None:
    """The format is one file per sample and table, so a single task writes it."""
    rows.orderBy("ord").select("value").coalesce(1).write.text(f"{folder}/_{name}")
    _rename_parts(rows.sparkSession, f"{folder}/_{name}", lambda i: f"{folder}/{name}")


def _parts(cells: DataFrame, size: str, folder: str, name: str) -> None:
    """Triplets as the tasks write them, the size as the first line of every part."""
    line = F.concat_ws(" ", "line_var_id", "line_obs_id", "x").alias(size)
    # A separator that is in no line keeps the text as it is.
    cells.select(line).write.csv(f"{folder}/_{name}", header=True, sep="\t")
    _rename_parts(cells.sparkSession, f"{folder}/_{name}", lambda i: f"{folder}/{name}.part-{i:05d}")


def _rename_parts(spark: SparkSession, written: str, target: Callable[[int], str]) -> None:
    """Move the files of a written folder to their names in the layout."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    source = hadoop.Path(written)
    fs = source.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    parts = sorted(f.getPath().getName() for f in fs.listStatus(source) if f.getPath().getName().startswith("part-"))
    for i, part in enumerate(parts):
        fs.rename(hadoop.Path(f"{written}/{part}"), hadoop.Path(target(i)))
    fs.delete(source, True)
