"""The shared folder for written stage tables and models.

A cluster names it in ``spark.checkpoint.dir``; every executor can reach it, so what is
written there survives a lost executor. A temporary folder stands in only where driver
and executors are one process (master ``local``), as in tests.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

_fallback: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    application = spark.sparkContext.applicationId
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return f"{named.rstrip('/')}/tollgate-{application}"
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors reach")
    if application not in _fallback:
        _fallback[application] = tempfile.mkdtemp(prefix="tollgate-")
    return f"file:{_fallback[application]}"


def write_and_read(df: DataFrame, path: str) -> DataFrame:
    """Store a frame and continue from the stored rows: lineage ends, statistics are exact."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    place, files = _file_system(spark, path)
    return files.exists(place)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that this run has written and nothing reads any more."""
    place, files = _file_system(spark, path)
    files.delete(place, True)


def remove_run_folder(spark: SparkSession) -> None:
    """Remove all that this application has written to the shared folder; call it when the results are out."""
    remove_folder(spark, shared_folder(spark))
    _fallback.pop(spark.sparkContext.applicationId, None)
