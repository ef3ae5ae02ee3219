"""The analysis report as a table and as text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OVERVIEW, QUALITY, SPATIAL, PANELS = "dataset", "quality control", "spatial analysis", "gene panels"


def analysis_report(
    metrics: DataFrame,
    var: DataFrame,
    clusters: DataFrame | None = None,
    method: str | None = None,
    panels_found: DataFrame | None = None,
) -> DataFrame:
    """(section, metric, value) rows: sizes, mean UMI and genes, clustering, genes per panel."""

    def rows(section: str, df: DataFrame, names: list[str]) -> DataFrame:
        text = df.select(*[F.col(n).cast("string").alias(n) for n in names])
        return text.unpivot([], names, "metric", "value").select(F.lit(section).alias("section"), "metric", "value")

    sizes = metrics.agg(
        F.count(F.lit(1)).alias("spots"),
        F.round(F.avg("total_counts"), 2).alias("mean_umi"),
        F.round(F.avg("n_genes_by_counts"), 2).alias("mean_genes"),
    )
    out = rows(OVERVIEW, sizes, ["spots"])
    out = out.unionByName(rows(OVERVIEW, var.agg(F.count(F.lit(1)).alias("genes")), ["genes"]))
    out = out.unionByName(rows(QUALITY, sizes, ["mean_umi", "mean_genes"]))
    if clusters is not None:
        found = clusters.agg(F.count_distinct("cluster").alias("n_clusters")).withColumn("method", F.lit(method))
        out = out.unionByName(rows(SPATIAL, found, ["method", "n_clusters"]))
    if panels_found is not None:
        counted = panels_found.where(F.col("n_available") > 0)
        out = out.unionByName(
            counted.select(
                F.lit(PANELS).alias("section"),
                F.col("panel").alias("metric"),
                F.col("n_available").cast("string").alias("value"),
            )
        )
    return out


def write_report(report: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One text line per report row, in section order."""
    line = F.concat_ws(" | ", "section", "metric", F.coalesce("value", F.lit("n/a")))
    report.orderBy("section", "metric").select(line.alias("value")).coalesce(1).write.mode(mode).text(path)
