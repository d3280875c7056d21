"""Reading the driver's Parquet tables."""

from __future__ import annotations

import os
import weakref

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
]

_scans: weakref.WeakKeyDictionary[SparkSession, dict[tuple, DataFrame]] = weakref.WeakKeyDictionary()


def version(spark: SparkSession, path: str) -> tuple[int, int]:
    """Modification time and length of a file or folder (one file-system call)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    status = p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p)
    return status.getModificationTime(), status.getLen()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy Parquet scan; Catalyst prunes columns and pushes filters into it.

    The scan DataFrame (a plan, not data) is reused within a session as long as
    the path is unchanged, so building many queries does not re-list files or
    re-read footers, and new files are seen.
    """
    path = os.path.join(sf_dir, f"{name}.parquet")
    held = _scans.setdefault(spark, {})
    key = (path, *version(spark, path))
    if key not in held:
        held[key] = spark.read.parquet(path)
    return held[key]
