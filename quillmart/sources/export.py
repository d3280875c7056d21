"""Parquet export of the marts into dated folders, in order where one is asked for."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmart.session import release_shuffles

# The most rows and bytes of a Parquet row group.
ROW_GROUP_ROWS = 100_000
ROW_GROUP_BYTES = 128 * 1024 * 1024
# Types that an export as text turns into text; numbers and booleans keep theirs.
TEXT_TYPES = ("date", "timestamp", "timestamp_ntz")


def as_text(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text; a null stays null."""
    return df.select(*[F.col(c).cast("string").alias(c) if t in TEXT_TYPES else F.col(c) for c, t in df.dtypes])


def export_table(df: DataFrame, export_dir: str, name: str, stringify: bool = False, rows_per_file: int = 0,
                 order_by: tuple[str, ...] = (), row_group_rows: int = ROW_GROUP_ROWS) -> str:
    """Write one mart as snappy Parquet under ``export_dir/<name>.parquet``, in files of at most
    ``rows_per_file`` rows (0: one file per task) and row groups of at most ``row_group_rows``.

    ``order_by``: rows are dealt out by ranges of these columns and sorted inside (nulls
    first), so that files follow each other and their footers' least and greatest values
    let a reader of a range skip the others; a hot value may fill one file. Native column types are
    kept; ``stringify=True`` casts dates and timestamps to text instead.
    """
    if order_by:
        df = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    if stringify:
        df = as_text(df)
    path = os.path.join(export_dir, f"{name}.parquet")
    (df.write.mode("overwrite")
     .option("compression", "snappy")
     .option("maxRecordsPerFile", rows_per_file)
     .option("parquet.block.size", ROW_GROUP_BYTES)
     .option("parquet.block.row.count.limit", row_group_rows)
     .parquet(path))
    release_shuffles(df.sparkSession)
    return path


def read_in_order(spark: SparkSession, path: str) -> DataFrame:
    """An ordered export with ``position``, each row's place (from 0) in the written order.

    Files are named in the order of their ranges; a row's place is the rows of
    earlier files (counted from one row per file) and its index in its own.
    """
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_index"))
    files = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    first = files.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"))
    return rows.join(first, "_file").withColumn("position", F.col("_first") + F.col("_index")).drop("_file", "_index", "_first")


def export_all(marts: dict[str, DataFrame], base_dir: str, export_date: dt.date,
               rows_per_file: int = 0, order_by: dict[str, tuple[str, ...]] | None = None,
               stringify: bool = False) -> dict[str, list]:
    """Export every mart into ``base_dir/exports/<date>/``; one failure does not stop the rest.

    Returns {"ok": [(name, path)], "failed": [(name, error)]}. The loop is over
    table names only; each write is a distributed Spark job.
    """
    export_dir = os.path.join(base_dir, "exports", export_date.isoformat())
    ok, failed = [], []
    for name, df in marts.items():
        try:
            ok.append((name, export_table(df, export_dir, name, stringify, rows_per_file, (order_by or {}).get(name, ()))))
        except Exception as e:  # noqa: BLE001 - reported, not raised
            failed.append((name, f"{type(e).__name__}: {e}"))
    return {"ok": ok, "failed": failed}
