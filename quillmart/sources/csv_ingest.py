"""CSV drops in and out.

Layouts read:
  * dated drops ``<raw>/<YYYY-MM-DD>/<table>.csv`` plus ``<raw>/static/<table>.csv``:
    one scan per table over all dates, in byte ranges (``csv_splits``); the date comes
    from the path; directories whose name is not an ISO date are skipped;
    ``<table>.csv`` may be a file or a directory of part files.
  * our own partitioned drops ``<raw>/<table>/load_date=<date>/`` written by
    ``write_daily`` (dynamic partition overwrite: re-loading a day replaces
    it, so a load is idempotent).

Values follow the usual CSV rules: quotes are doubled inside quotes, a quoted
value may hold commas and line ends, blanks belong to the value. Columns are
matched by name, extras dropped and missing ones NULL; empty text is NULL; types
come from an explicit schema (all text by default), never inference. A bad record ends
the read with its reason; ``load_checked`` returns bad records and values as a table
instead. Row counts are observed on the scan itself, without a second pass.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmart.constants import DAILY_TABLES, RAW_COLUMNS, STATIC_TABLES
from quillmart.session import scratch_path
from quillmart.sources import dirty
from quillmart.sources.csv_splits import list_files, scan
from quillmart.sources.versions import Versions

CSV_FORM = {"header": "true", "nullValue": "", "emptyValue": "", "quote": '"', "escape": '"',
         "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
FILE_RECORDS = 500_000  # of a file that is written: files of one split are read without a copy
_DATE_DIR = r"/(\d{4}-\d{2}-\d{2})/[^/]+\.csv(/|$)"


def text_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS[table]])


def scan_table(spark: SparkSession, pattern: str, table: str) -> DataFrame:
    """The table's columns as text from all matched files, ``_file``, ``_text`` and ``_reason``
    (see ``csv_splits``); a folder whose state is committed is read in its latest state."""
    return scan(spark, list_files(spark, _resolved(spark, pattern)), RAW_COLUMNS[table])


def _resolved(spark: SparkSession, pattern: str) -> str:
    state = None if "*" in pattern else Versions(spark, pattern).current()
    return f"{pattern}/{state.folders['all']}" if state is not None and state.folders else pattern


def whole(rows: DataFrame) -> DataFrame:
    """The records; a bad one ends the read with its reason."""
    why = F.concat_ws(": ", F.col("_file"), F.col("_reason"), F.col("_text"))
    return rows.where(F.when(F.col("_reason").isNull(), True).otherwise(F.raise_error(why).isNotNull()))


def _project(df: DataFrame, table: str, schema: T.StructType | None,
             keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns by name in load order; missing → NULL; then explicit casts."""
    present = set(df.columns)
    types = {f.name: f.dataType for f in (schema or text_schema(table)).fields}
    cols = []
    for c in RAW_COLUMNS[table]:
        src = F.col(c) if c in present else F.lit(None).cast("string")
        dtype = types.get(c, T.StringType())
        if isinstance(dtype, T.StringType):
            cols.append(src.cast("string").alias(c))
        else:
            cols.append(F.nullif(F.trim(src.cast("string")), F.lit("")).cast(dtype).alias(c))
    return df.select(*cols, *keep)


def _observed(df: DataFrame, observe: Observation | None) -> DataFrame:
    return df if observe is None else df.observe(observe, F.count(F.lit(1)).alias("rows"))


def read_csv(spark: SparkSession, pattern: str, table: str,
             schema: T.StructType | None = None, observe: Observation | None = None) -> DataFrame:
    """Scan CSV files (header row) as text and project the table's columns; no files give no rows."""
    return _observed(_project(whole(scan_table(spark, pattern, table)), table, schema), observe)


def load_checked(spark: SparkSession, pattern: str, table: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(clean rows, rejects) of dirty files: one scan writes both, see ``sources.dirty``."""
    path = scratch_path(spark, f"checked-{table}")
    rows = dirty.checked(scan_table(spark, pattern, table), schema)
    rows.write.parquet(path)
    held = spark.read.schema(rows.schema).parquet(path)
    return dirty.clean(held).drop("_file"), dirty.rejects(held)


def read_static(spark: SparkSession, raw_dir: str, schemas: dict[str, T.StructType] | None = None,
                observe: dict[str, Observation] | None = None) -> dict[str, DataFrame]:
    schemas, observe = schemas or {}, observe or {}
    return {t: read_csv(spark, os.path.join(raw_dir, "static", f"{t}.csv"), t, schemas.get(t), observe.get(t))
            for t in STATIC_TABLES}


def read_dated(spark: SparkSession, raw_dir: str, table: str, date: dt.date | None = None,
               schema: T.StructType | None = None, observe: Observation | None = None) -> DataFrame:
    """Dated drops ``<raw>/<date>/<table>.csv``: one day, or every ISO-dated directory.

    Adds ``load_date`` taken from the directory name; other directories
    (``static``, ``not-a-date``) are skipped.
    """
    sub = date.isoformat() if date is not None else "*"
    rows = whole(scan_table(spark, os.path.join(raw_dir, sub, f"{table}.csv"), table))
    day = F.try_to_date(F.regexp_extract(F.col("_file"), _DATE_DIR, 1), "yyyy-MM-dd")
    dated = rows.withColumn("load_date", day).where(F.col("load_date").isNotNull())
    return _observed(_project(dated, table, schema, keep=("load_date",)), observe)


def read_daily(spark: SparkSession, raw_dir: str, table: str, date: dt.date | None = None,
               schema: T.StructType | None = None, observe: Observation | None = None) -> DataFrame:
    """Partitioned drops ``<raw>/<table>/load_date=<date>/`` (one day or all)."""
    sub = f"load_date={date.isoformat()}" if date else "load_date=*"
    return read_csv(spark, os.path.join(raw_dir, table, sub), table, schema, observe)


def write_daily(df: DataFrame, raw_dir: str, table: str, date_col: str, grain: str = "day") -> None:
    """Write a table as CSV drops partitioned by load date; re-writing a drop replaces it.

    ``grain="month"`` groups a month of days into one drop (the partition
    value is the month's first day). Dynamic partition overwrite makes a
    re-run of the same drops idempotent. A rebalance on the drop date lets AQE
    split a hot day over several tasks and pack small days together, instead
    of one task per day.
    """
    day = F.col(date_col).cast("date")
    part = F.trunc(day, "month") if grain == "month" else day
    columns = [c for c in RAW_COLUMNS[table] if c in df.columns]
    dealt = df.select(*columns, part.alias("load_date")).hint("rebalance", "load_date")  # typed rows are narrower than text
    (dealt.select(*[F.col(c).cast("string").alias(c) for c in columns], "load_date").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", FILE_RECORDS).partitionBy("load_date")
     .options(**CSV_FORM).csv(os.path.join(raw_dir, table)))


def write_dated(df: DataFrame, raw_dir: str, table: str, date_col: str, grain: str = "day") -> None:
    """Write drops ``<raw>/<date>/<table>.csv`` (a folder of part files each); a drop that is written
    again is replaced.

    One Spark job writes all dates to a folder beside; then each date's folder is
    moved to its place (a rename, no data). Rows without a date go nowhere.
    """
    beside = os.path.join(raw_dir, f"_writing-{uuid.uuid4().hex}")
    write_daily(df.where(F.col(date_col).isNotNull()), beside, table, date_col, grain)
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    found = path(os.path.join(beside, table, "load_date=*"))
    fs = found.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.globStatus(found) or []:
        folder = status.getPath()
        day = path(os.path.join(raw_dir, folder.getName().split("=", 1)[1]))
        target = path(os.path.join(day.toString(), f"{table}.csv"))
        fs.mkdirs(day)
        fs.delete(target, True)
        if not fs.rename(folder, target):
            raise OSError(f"cannot move {folder} to {target}")
    fs.delete(path(beside), True)


def append_static(df: DataFrame, raw_dir: str, table: str) -> None:
    """Add the rows of ``df`` whose key (the first column) the table does not hold yet.

    Of several new rows of one key one is added. The result is a new state of the table,
    so what is read is never overwritten.
    """
    spark, key = df.sparkSession, RAW_COLUMNS[table][0]
    held = read_csv(spark, os.path.join(raw_dir, "static", f"{table}.csv"), table)
    new = df.select(*[F.col(c).cast("string").alias(c) for c in RAW_COLUMNS[table]]).dropDuplicates([key])
    write_static(held.unionByName(new.join(held.select(key), key, "left_anti")), raw_dir, table)


def write_static(df: DataFrame, raw_dir: str, table: str) -> None:
    """Full reload of a static table, also with no rows: the header alone is then left.

    The files go to a new folder inside ``static/<table>.csv``, which one commit puts in
    place; a reader sees the old or the new table, also when the writer dies.
    """
    states = Versions(df.sparkSession, os.path.join(raw_dir, "static", f"{table}.csv"))
    now, folder = states.current(), states.new_folder()
    (df.select(*[F.col(c).cast("string").alias(c) for c in RAW_COLUMNS[table] if c in df.columns])
     .write.options(**CSV_FORM).csv(f"{states.path}/{folder}"))
    states.commit(now, {"all": folder})
    states.vacuum(keep=2)  # readers of the state before may still be at work


def load_counts(observations: dict[str, Observation]) -> dict[str, int]:
    """Rows read per table, available after the scans have run."""
    return {t: int(o.get.get("rows", 0)) for t, o in observations.items()}


__all__ = ["read_csv", "read_static", "read_dated", "read_daily", "write_daily", "write_static",
           "write_dated", "append_static", "load_checked", "scan_table", "text_schema", "load_counts", "DAILY_TABLES"]
