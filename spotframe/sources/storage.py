"""Saving, loading and exporting datasets."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..dataset import SpatialDataset

MANIFEST = "manifest"


def save(data: SpatialDataset, path: str, mode: str = "errorifexists") -> None:
    """Write every table as gzipped parquet, those with samples in one folder per sample.

    Rows are ranged by (sample, spot) first: a large sample spreads over many tasks, and a task holds few
    samples, so the number of files stays near tasks plus samples.
    """
    spark = data.obs.sparkSession
    manifest = []
    for name, df in data.tables().items():
        manifest.append((name, df.schema.json()))
        out = df
        keys = [c for c in ("sample_id", "obs_id", "src") if c in df.columns]
        if "sample_id" in keys:
            out = df.repartitionByRange(*keys)
        writer = out.write.mode(mode).option("compression", "gzip")
        if "sample_id" in keys:
            writer = writer.partitionBy("sample_id")
        writer.parquet(f"{path}/{name}")
    listed = spark.createDataFrame(manifest, "name string, schema string")
    listed.coalesce(1).write.mode(mode).json(f"{path}/{MANIFEST}")


def load(spark: SparkSession, path: str) -> SpatialDataset:
    """Read a saved dataset back with the column order and types it had."""
    tables: dict[str, DataFrame] = {}
    for row in spark.read.json(f"{path}/{MANIFEST}", schema="name string, schema string").collect():
        schema = StructType.fromJson(json.loads(row.schema))
        tables[row.name] = spark.read.schema(schema).parquet(f"{path}/{row.name}").select(*schema.fieldNames())
    core = {k: tables.pop(k) for k in ("obs", "var", "counts")}
    return SpatialDataset(**core, images=tables.pop("images", None), scalefactors=tables.pop("scalefactors", None), extras=tables)


def snapshot(data: SpatialDataset, folder: str, prefix: str = "snapshot") -> str:
    """Save under ``<prefix>_<date>_<time>`` and return the path."""
    stamp = data.obs.sparkSession.range(1).select(F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss")).first()[0]
    path = f"{folder.rstrip('/')}/{prefix}_{stamp}"
    save(data, path)
    return path


def export_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a table as CSV with a header; nested columns become JSON text."""
    nested = ("array", "struct", "map")
    columns = [F.to_json(c).alias(c) if t.startswith(nested) else F.col(c) for c, t in df.dtypes]
    df.select(*columns).write.mode(mode).option("header", True).csv(path)


def export_tables(
    folder: str,
    qc_metrics: DataFrame | None = None,
    hvg_list: DataFrame | None = None,
    cluster_markers: DataFrame | None = None,
) -> list[str]:
    """Write the given result tables under their usual names."""
    named = {"qc_metrics": qc_metrics, "hvg_list": hvg_list, "cluster_markers": cluster_markers}
    written = []
    for name, df in named.items():
        if df is not None:
            export_csv(df, f"{folder.rstrip('/')}/{name}.csv")
            written.append(name)
    return written
