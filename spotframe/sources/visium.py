"""Reader for sample folders with a sparse matrix, positions, scale factors and images."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..dataset import SpatialDataset
from ..functions.numeric import ordered_value_counts
from ..functions.storage import stable
from .names import unique_names

COUNT_DIR = "filtered_feature_bc_matrix"
# File layout and column order of the format.
POSITIONS = "barcode string, in_tissue string, array_row string, array_col string, py string, px string"
SCALE_FIELDS = (
    "tissue_hires_scalef",
    "tissue_lowres_scalef",
    "fiducial_diameter_fullres",
    "spot_diameter_fullres",
)


def _sample(folder: str) -> Column:
    """Name of the sample folder above ``folder``."""
    return F.regexp_extract(F.col("_metadata.file_path"), f"([^/]+)/{folder}/[^/]+$", 1)


def _numbered(spark: SparkSession, path: str, folder: str, schema: str) -> DataFrame:
    """Rows of tab-separated files with their 1-based line number within the sample's file."""
    rows = spark.read.csv(path, sep="\t", schema=schema)
    columns = rows.columns
    # Position in the file: blocks in order, lines in order within a block.
    at = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("at"))
    rows = rows.select("*", _sample(folder).alias("sample_id"), at.alias("_key"))
    placed = ordered_value_counts(rows, ["sample_id"], "_key", [F.first(c).alias(c) for c in columns])
    return stable(placed.select("sample_id", (F.col("n_below") + 1).alias("line"), *columns))


def read_visium(
    spark: SparkSession, path: str, count_file: str = COUNT_DIR, load_images: bool = True
) -> SpatialDataset:
    """Read one sample folder, or many by a glob such as ``/data/*``, into one dataset.

    The matrix folder holds matrix.mtx, features.tsv and barcodes.tsv, plain or gzipped. The sample is the
    folder's name. Repeated gene names get a suffix in ``gene_unique``.
    """
    base = f"{path.rstrip('/')}/{count_file}"
    features = _numbered(spark, f"{base}/features.tsv*", count_file, "gene_id string, gene string, feature_type string")
    barcodes = _numbered(spark, f"{base}/barcodes.tsv*", count_file, "barcode string")
    first = features.groupBy("gene_id").agg(F.min(F.struct("line", "gene")).alias("_f"))
    var = first.select(
        F.row_number().over(Window.orderBy("_f.line", "gene_id")).cast("long").alias("var_id"),
        "gene_id",
        F.col("_f.gene").alias("gene"),
    )
    var = stable(var)
    # The line after the comments gives the matrix size; as the "header" of each file it is dropped.
    triplets = spark.read.csv(
        f"{base}/matrix.mtx*", sep=" ", comment="%", header=True, enforceSchema=True,
        schema="_feature long, _barcode long, x double",
    ).select("*", _sample(count_file).alias("sample_id"))
    genes = features.join(var.select("gene_id", "var_id"), "gene_id").select(
        "sample_id", F.col("line").alias("_feature"), "var_id"
    )
    counts = (
        triplets.join(genes, ["sample_id", "_feature"])
        .where(F.col("x") != 0)
        .groupBy("sample_id", F.col("_barcode").alias("obs_id"), "var_id")
        .agg(F.sum("x").alias("x"))
    )
    places = spark.read.csv(f"{path.rstrip('/')}/spatial/tissue_positions*.csv", schema=POSITIONS).select(
        "*", _sample("spatial").alias("sample_id")
    )
    places = places.where(F.col("barcode") != "barcode")
    obs = barcodes.join(places, ["sample_id", "barcode"], "left").select(
        "sample_id",
        F.col("line").alias("obs_id"),
        "barcode",
        (F.col("in_tissue").cast("int") == 1).alias("in_tissue"),
        F.col("array_row").cast("int").alias("array_row"),
        F.col("array_col").cast("int").alias("array_col"),
        F.col("px").cast("double").alias("px"),
        F.col("py").cast("double").alias("py"),
    )
    return SpatialDataset(
        obs=obs,
        var=unique_names(var),
        counts=counts,
        scalefactors=read_scalefactors(spark, path),
        images=read_images(spark, path) if load_images else None,
    )


def read_scalefactors(spark: SparkSession, path: str) -> DataFrame:
    schema = ", ".join(f"{f} double" for f in SCALE_FIELDS)
    files = spark.read.json(f"{path.rstrip('/')}/spatial/scalefactors_json.json", schema=schema, multiLine=True)
    return files.select(_sample("spatial").alias("sample_id"), *SCALE_FIELDS)


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """(sample_id, image_key, image) of the tissue images."""
    files = spark.read.format("image").load(f"{path.rstrip('/')}/spatial/tissue_*_image.png")
    origin = F.col("image.origin")
    return files.select(
        F.regexp_extract(origin, "([^/]+)/spatial/[^/]+$", 1).alias("sample_id"),
        F.regexp_extract(origin, "tissue_([^/]+)_image", 1).alias("image_key"),
        "image",
    )


def image_inventory(images: DataFrame) -> DataFrame:
    """Height, width, channels, value type and range of every image."""

    @F.pandas_udf("low int, high int")
    def span(data: pd.Series) -> pd.DataFrame:
        values = [np.frombuffer(d, dtype=np.uint8) for d in data]
        return pd.DataFrame({"low": [int(v.min()) for v in values], "high": [int(v.max()) for v in values]})

    ranged = images.withColumn("_r", span("image.data"))
    return ranged.select(
        "sample_id",
        "image_key",
        F.col("image.height").alias("height"),
        F.col("image.width").alias("width"),
        F.col("image.nChannels").alias("n_channels"),
        F.lit("uint8").alias("dtype"),
        F.col("_r.low").alias("min"),
        F.col("_r.high").alias("max"),
    )
