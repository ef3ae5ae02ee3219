"""Tail probabilities Spark SQL has no function for, as Arrow-batched UDFs over small result tables."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


@F.pandas_udf(DoubleType())
def normal_two_sided(z: pd.Series) -> pd.Series:
    """P(|Z| >= |z|) of the standard normal distribution."""
    return z.map(lambda v: math.erfc(abs(v) / math.sqrt(2.0)), na_action="ignore")


def incomplete_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray, steps: int = 300) -> np.ndarray:
    """Regularised incomplete beta function by its continued fraction (modified Lentz)."""
    a, b, x = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(a, b, x))
    swap = x > (a + 1.0) / (a + b + 2.0)
    p, q, t = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1.0 - x, x)
    inner = np.clip(t, 1e-300, 1.0 - 1e-16)
    beta = np.vectorize(lambda u, v: math.lgamma(u + v) - math.lgamma(u) - math.lgamma(v), otypes=[float])(p, q)
    front = np.exp(beta + p * np.log(inner) + q * np.log1p(-inner)) / p
    tiny = 1e-300
    c = np.ones_like(inner)
    d = 1.0 - (p + q) * inner / (p + 1.0)
    d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
    f = d.copy()
    for m in range(1, steps):
        for term in (
            m * (q - m) * inner / ((p + 2 * m - 1) * (p + 2 * m)),
            -(p + m) * (p + q + m) * inner / ((p + 2 * m) * (p + 2 * m + 1)),
        ):
            d = 1.0 + term * d
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1.0 + term / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            f = f * c * d
        if np.all(np.abs(c * d - 1.0) < 1e-14):
            break
    value = np.where(t <= 0.0, 0.0, np.where(t >= 1.0, 1.0, front * f))
    return np.where(swap, 1.0 - value, value)


@F.pandas_udf(DoubleType())
def student_two_sided(t: pd.Series, df: pd.Series) -> pd.Series:
    """P(|T| >= |t|) of Student's t with ``df`` degrees of freedom."""
    known = (t.notna() & df.notna()).to_numpy()
    out = np.full(len(t), np.nan)
    tv, dv = t.to_numpy(dtype=float)[known], df.to_numpy(dtype=float)[known]
    out[known] = incomplete_beta(dv / 2.0, 0.5, dv / (dv + tv * tv))
    return pd.Series(out).where(pd.Series(known), None)


def adjust_pvalues(df: DataFrame, p: str, by: list[str], out: str = "pval_adj") -> DataFrame:
    """Benjamini-Hochberg within ``by`` (one row per gene): minimum over later ranks of p * m / rank.

    The minimum runs from the last rank to the first, so each row costs one step; a frame from the current row to the end
    would be walked again for every row.
    """
    group = Window.partitionBy(*by)
    ascending = group.orderBy(F.col(p).asc_nulls_last(), F.col("var_id"))
    falling = group.orderBy(F.col("_rank").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = df.withColumns({"_rank": F.row_number().over(ascending), "_raw": F.count(F.col(p)).over(group)})
    ranked = ranked.withColumn("_raw", F.col(p) * F.col("_raw") / F.col("_rank"))
    return ranked.withColumn(out, F.least(F.min("_raw").over(falling), F.lit(1.0))).drop("_raw", "_rank")
