"""Validation and profiling of a dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..dataset import SpatialDataset
from ..functions.numeric import SPOT, ratio
from ..functions.storage import stable
from .qc import spot_totals

# Limits of the checks.
UNIFORM_STD = 1e-6
LOW_TOTAL = 1_000.0
HIGH_TOTAL = 100_000.0

ISSUE, WARNING = "issue", "warning"
MESSAGES = {
    "uniform_totals": "artificial uniformity: all spots have the same total count",
    "no_variation": "no biological variation: data look pre-processed or synthetic",
    "missing_coordinates": "spatial coordinates are missing",
    "missing_in_tissue": "the in_tissue annotation is missing",
    "missing_spatial_metadata": "spatial metadata are missing",
    "missing_images": "spatial metadata without images",
    "low_totals": "very low total counts: data may be pre-normalised",
    "high_totals": "very high total counts: check for count inflation",
    "all_in_tissue": "every spot is marked in tissue, unusual for measured data",
    "no_spots": "no spots",
    "no_genes": "no genes",
    "negative_values": "negative values in the matrix",
    "duplicate_genes": "gene names repeat",
}


def structure_profile(data: SpatialDataset) -> DataFrame:
    """Sizes and column lists as (item, value) rows."""
    spark = data.obs.sparkSession

    def rows(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).cast("string").alias("value")).select(F.lit(name).alias("item"), "value")

    listed = {
        "obs_columns": data.obs.columns,
        "var_columns": data.var.columns,
        "tables": sorted(data.tables()),
    }
    sizes = rows("n_obs", data.obs).unionByName(rows("n_vars", data.var)).unionByName(rows("nnz", data.counts))
    lists = spark.createDataFrame([(k, ",".join(v)) for k, v in listed.items()], "item string, value string")
    return sizes.unionByName(lists)


def coordinate_bounds(obs: DataFrame) -> DataFrame:
    """Bounding box and presence of coordinates per sample."""
    return obs.groupBy("sample_id").agg(
        F.count_if(F.col("px").isNotNull() & F.col("py").isNotNull()).alias("n_located"),
        F.min("px").alias("min_x"),
        F.max("px").alias("max_x"),
        F.min("py").alias("min_y"),
        F.max("py").alias("max_y"),
    )


def matrix_profile(obs: DataFrame, var: DataFrame, counts: DataFrame) -> DataFrame:
    """Sparsity, range / mean / population std of spot totals and sign of the values, per sample."""
    x = F.col("x")
    per_spot = counts.groupBy(*SPOT).agg(
        F.sum("x").alias("_total"), F.count_if(x != 0).alias("_nnz"), F.count_if(x < 0).alias("_neg")
    )
    filled = obs.select(*SPOT).join(per_spot, SPOT, "left").fillna(0)
    n_vars = var.agg(F.count(F.lit(1))).scalar()
    return (
        filled.groupBy("sample_id")
        .agg(
            F.count(F.lit(1)).alias("n_spots"),
            F.sum("_nnz").alias("nnz"),
            F.min("_total").alias("min_total"),
            F.max("_total").alias("max_total"),
            F.avg("_total").alias("mean_total"),
            F.stddev_pop("_total").alias("std_total"),
            (F.sum("_neg") > 0).alias("has_negative"),
        )
        .withColumn("sparsity", F.lit(1.0) - ratio(F.col("nnz").cast("double"), F.col("n_spots") * n_vars))
    )


def uniformity(profile: DataFrame) -> DataFrame:
    """Flag samples whose spot totals do not vary."""
    return profile.select("sample_id", "std_total", (F.col("std_total") < UNIFORM_STD).alias("is_uniform"))


def range_level(max_total: Column) -> Column:
    """``low`` / ``high`` / ``ok`` by the largest spot total."""
    return F.when(max_total < LOW_TOTAL, "low").when(max_total > HIGH_TOTAL, "high").otherwise("ok")


def tissue_coverage(obs: DataFrame) -> DataFrame:
    """In-tissue spots and fraction per sample."""
    return obs.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("n_spots"),
        F.count_if(F.col("in_tissue")).alias("tissue_spots"),
        F.avg(F.col("in_tissue").cast("int")).alias("tissue_fraction"),
    )


def _finding(level: str, code: str, cond: Column | None = None) -> Column:
    row = F.struct(F.lit(level).alias("level"), F.lit(code).alias("code"), F.lit(MESSAGES[code]).alias("message"))
    return row if cond is None else F.when(cond, row)


def _explode_findings(df: DataFrame, keys: Sequence[str], found: list[Column]) -> DataFrame:
    if not found:
        found = [F.lit(None).cast("struct<level:string,code:string,message:string>")]
    rows = df.select(*keys, F.explode(F.array_compact(F.array(*found))).alias("_f"))
    return rows.select(*keys, "_f.level", "_f.code", "_f.message")


def findings(data: SpatialDataset) -> DataFrame:
    """One row per issue or warning and sample."""
    obs, columns = data.obs, data.obs.columns
    facts = matrix_profile(obs, data.var, data.counts)
    std, largest = F.col("std_total"), F.col("max_total")
    found = []
    if not {"px", "py"} <= set(columns):
        found.append(_finding(ISSUE, "missing_coordinates"))
    found += [
        _finding(ISSUE, "uniform_totals", std < UNIFORM_STD),
        _finding(ISSUE, "no_variation", std < UNIFORM_STD),
        _finding(WARNING, "low_totals", range_level(largest) == "low"),
        _finding(WARNING, "high_totals", range_level(largest) == "high"),
    ]
    if "in_tissue" in columns:
        facts = facts.join(tissue_coverage(obs).drop("n_spots"), "sample_id")
        found.append(_finding(WARNING, "all_in_tissue", F.col("tissue_spots") == F.col("n_spots")))
    else:
        found.append(_finding(ISSUE, "missing_in_tissue"))
    if data.scalefactors is None and data.images is None:
        found.append(_finding(ISSUE, "missing_spatial_metadata"))
    elif data.images is None:
        found.append(_finding(WARNING, "missing_images"))
    return _explode_findings(facts, ["sample_id"], found)


def light_findings(data: SpatialDataset) -> DataFrame:
    """The short structural check: emptiness, coordinates, recommended columns, sign, repeated names."""
    columns = data.obs.columns
    negatives = data.counts.agg(F.count_if(F.col("x") < 0)).scalar()
    repeated = data.var.agg(F.count("gene") - F.count_distinct("gene")).scalar()
    facts = data.obs.agg(F.count(F.lit(1)).alias("n_obs")).select(
        "n_obs",
        data.var.agg(F.count(F.lit(1))).scalar().alias("n_vars"),
        negatives.alias("n_negative"),
        repeated.alias("n_repeated"),
    )
    found = [
        _finding(ISSUE, "no_spots", F.col("n_obs") == 0),
        _finding(ISSUE, "no_genes", F.col("n_vars") == 0),
        _finding(WARNING, "negative_values", F.col("n_negative") > 0),
        _finding(WARNING, "duplicate_genes", F.col("n_repeated") > 0),
    ]
    if not {"px", "py"} <= set(columns):
        found.append(_finding(ISSUE, "missing_coordinates"))
    if "in_tissue" not in columns:
        found.append(_finding(WARNING, "missing_in_tissue"))
    return _explode_findings(facts, [], found)


def fix_uniformity(
    obs: DataFrame, counts: DataFrame, low: float = 0.7, high: float = 1.3, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Scale every spot of a uniform sample by a factor in [low, high); other samples stay as they are.

    The factor is a pure function of (seed, sample, spot), so it does not depend on partitioning and a
    recomputed task repeats it. Returns the counts and one provenance row per sample.
    """
    totals = spot_totals(obs, counts)
    state = stable(
        totals.groupBy("sample_id").agg(
            F.coalesce(F.stddev_pop("total_counts") <= UNIFORM_STD, F.lit(False)).alias("applied"),
            F.max("total_counts").alias("original_total"),
        )
    )
    unit = F.pmod(F.xxhash64(F.lit(seed), *SPOT), F.lit(2**52)) / F.lit(float(2**52))
    factor = F.when(F.col("applied"), F.lit(low) + F.lit(high - low) * unit).otherwise(F.lit(1.0))
    columns = counts.columns
    fixed = (
        counts.join(state, "sample_id", "left")
        .withColumn("x", F.col("x") * factor)
        .select(*columns)
    )
    scaled = totals.join(state, "sample_id").withColumn("_new", F.col("total_counts") * factor)
    provenance = scaled.groupBy("sample_id", "applied", "original_total").agg(
        F.min("_new").alias("new_min_total"), F.max("_new").alias("new_max_total")
    )
    return fixed, provenance.withColumns({"low": F.lit(low), "high": F.lit(high), "seed": F.lit(seed)})


def load_checked(data: SpatialDataset, fix: bool = True) -> tuple[SpatialDataset, DataFrame]:
    """Validate, repair uniform samples when asked, and validate again."""
    found = findings(data)
    if fix and not found.where(F.col("code") == "uniform_totals").isEmpty():
        counts, provenance = fix_uniformity(data.obs, data.counts)
        data = data.with_(counts=counts, provenance=provenance)
        found = findings(data)
    return data, found
