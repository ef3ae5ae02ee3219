"""Reliable materialisation of intermediate tables."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

_FOLDERS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder of this application for written intermediates, on storage that all executors share.

    It lies in ``spark.checkpoint.dir`` of the session, or where that is unset below ``spark.sql.warehouse.dir``, and is
    removed when the Python process ends.
    """
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        base = base or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate"
        _FOLDERS[app] = f"{base.rstrip('/')}/spotframe-{app}-{uuid.uuid4().hex[:8]}"
        atexit.register(_remove, spark, _FOLDERS[app])
    return _FOLDERS[app]


def _remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's file systems; a session that has ended leaves it to the storage's retention."""
    if spark.sparkContext._jsc is None:
        return
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def stable(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once, in folders by ``by``, and read it back.

    Cuts lineage so that a lost executor never replays the upstream plan, freezes values that depend on
    the physical layout (partition ids), and gives Catalyst the true size of the table, so that a later
    join broadcasts it exactly when it is small.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def release(*frames: DataFrame) -> None:
    """Remove the tables that ``stable`` wrote for these frames; nothing that reads them may run afterwards."""
    for df in frames:
        path = getattr(df, "_written", None)
        if path:
            _remove(df.sparkSession, path)
            df._written = None
