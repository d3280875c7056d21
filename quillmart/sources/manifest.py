"""Loads that remember what they have loaded.

A loaded table keeps a manifest with one row per drop (a CSV file, or a folder ``<name>.csv``
of part files): its length, latest change, number of files and rows, and the load that took it.
A load takes the drops that are new or have changed and passes over those it holds as they
are. Its rows and the new manifest are written first and become visible together, by one commit
(``sources.versions``). Rows of earlier loads are never rewritten: a drop's rows are those of
the load that its manifest row names, so a changed drop replaces its rows, and a drop
whose file is gone keeps them unless ``forget_missing`` is set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from quillmart.constants import RAW_COLUMNS
from quillmart.sources import dirty
from quillmart.sources.csv_splits import scan
from quillmart.sources.versions import Versions

MANIFEST = "drop_path string, length long, modified timestamp, files long, rows long, load int"
LISTING = "file string, drop_path string, length long, modified timestamp"


def _plain(path: Column) -> Column:
    """One spelling of a path: a scheme and three slashes where there is no authority."""
    return F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*):/(?!/)", "$1:///")


def drop_of(path: Column) -> Column:
    return F.regexp_extract(_plain(path), r"^(.*?\.csv)(/[^/]*)?$", 1)


def listing(spark: SparkSession, pattern: str) -> DataFrame:
    """(file, drop_path, length, modified) of matched files; Spark lists them, in parallel where there are many."""
    try:
        files = spark.read.format("binaryFile").load(pattern)
    except AnalysisException:  # nothing matches
        return spark.createDataFrame([], LISTING)
    return files.select("path", drop_of(F.col("path")).alias("drop_path"), "length",
                        F.col("modificationTime").alias("modified")).toDF("file", "drop_path", "length", "modified")


class LoadedTable:
    """The rows of all loaded drops of ``table``, and their manifest, under ``path``."""

    def __init__(self, spark: SparkSession, path: str, table: str, schema: T.StructType):
        self.spark, self.table, self.schema = spark, table, schema
        self.states = Versions(spark, path)
        self.row_schema = T.StructType([*schema.fields, T.StructField("_drop", T.StringType()),
                                        T.StructField("_load", T.IntegerType())])

    def manifest(self, state=None) -> DataFrame:
        paths = self.states.paths(state or self.states.current(), {"manifest"})
        return self.spark.read.schema(MANIFEST).parquet(*paths) if paths else self.spark.createDataFrame([], MANIFEST)

    def _part(self, prefix: str, schema, state) -> DataFrame:
        paths = self.states.paths(state, {p for p in state.folders if p.startswith(prefix)})
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _held(self, part: DataFrame, state) -> DataFrame:
        """Rows whose drop is held by the load they came with."""
        drops = self.manifest(state).select(F.col("drop_path").alias("_drop"), F.col("load").alias("_load"))
        return part.join(drops, ["_drop", "_load"], "left_semi")

    def rows(self) -> DataFrame:
        """Clean rows of all drops held, with ``_drop`` and ``_load``."""
        state = self.states.current()
        return self._held(self._part("rows-", self.row_schema, state), state).select(*self.row_schema.names)

    def rejects(self) -> DataFrame:
        state = self.states.current()
        return self._held(self._part("rejects-", dirty.REJECTS + ", _drop string, _load int", state), state).drop("_drop")

    def load(self, pattern: str, forget_missing: bool = False) -> dict[str, int]:
        """Take new and changed drops; the number of drops that are new, changed, same and missing."""
        spark, state = self.spark, self.states.current()
        files = listing(spark, pattern)
        found = files.groupBy("drop_path").agg(F.sum("length").alias("length"), F.max("modified").alias("modified"),
                                               F.count(F.lit(1)).alias("files")).alias("f")
        held = self.manifest(state).alias("h")
        same = (F.col("f.length") == F.col("h.length")) & (F.col("f.modified") == F.col("h.modified")) & (
            F.col("f.files") == F.col("h.files"))
        status = (F.when(F.col("h.load").isNull(), "new").when(F.col("f.files").isNull(), "missing")
                  .when(same, "same").otherwise("changed"))
        compared = found.join(held, F.col("f.drop_path") == F.col("h.drop_path"), "full").select(
            F.coalesce("f.drop_path", "h.drop_path").alias("drop_path"), status.alias("status"),
            F.coalesce("f.length", "h.length").alias("length"), F.coalesce("f.modified", "h.modified").alias("modified"),
            F.coalesce("f.files", "h.files").alias("files"), F.col("h.rows").alias("rows"), F.col("h.load").alias("load"))
        compared.write.parquet(f"{self.states.path}/{(folder := self.states.new_folder())}")  # the listing as it was
        compared = spark.read.schema(compared.schema).parquet(f"{self.states.path}/{folder}")
        counts = {"new": 0, "changed": 0, "same": 0, "missing": 0}
        counts |= {r["status"]: r["count"] for r in compared.groupBy("status").count().collect()}
        taken = compared.where(F.col("status").isin("new", "changed"))
        if not counts["new"] + counts["changed"] + (counts["missing"] if forget_missing else 0):
            return counts
        number = state.number + 1
        rows_at, rejects_at, manifest_at = (self.states.new_folder() for _ in range(3))
        # the reader needs the paths of the files it reads, as any scan does
        paths = [(r["file"], r["length"]) for r in files.join(taken, "drop_path", "left_semi").select("file", "length").collect()]
        checked = dirty.checked(scan(spark, paths, RAW_COLUMNS[self.table]), self.schema).withColumns(
            {"_drop": drop_of(F.col("_file")), "_load": F.lit(number)})
        both = self.states.new_folder()
        checked.write.parquet(f"{self.states.path}/{both}")
        checked = spark.read.schema(checked.schema).parquet(f"{self.states.path}/{both}")
        dirty.clean(checked).select(*self.row_schema.names).write.parquet(f"{self.states.path}/{rows_at}")
        lost = checked.where(F.size("_errors") > 0).select("_file", "_record", "_drop", "_load", F.explode("_errors").alias("e"))
        lost.select(F.col("_file").alias("file"), F.col("_record").alias("record"), "e.column", "e.value", "e.reason",
                    "_drop", "_load").write.parquet(f"{self.states.path}/{rejects_at}")
        counted = (spark.read.schema(self.row_schema).parquet(f"{self.states.path}/{rows_at}")
                   .groupBy(F.col("_drop").alias("drop_path")).agg(F.count(F.lit(1)).alias("n")))
        fresh = taken.drop("rows", "load").join(counted, "drop_path", "left").select(
            "drop_path", "length", "modified", "files", F.coalesce("n", F.lit(0)).alias("rows"), F.lit(number).alias("load"))
        kept = compared.where(F.col("status").isin("same", *([] if forget_missing else ["missing"]))).select(*fresh.columns)
        fresh.unionByName(kept).write.parquet(f"{self.states.path}/{manifest_at}")
        self.states.commit(state, {**state.folders, "manifest": manifest_at, f"rows-{number:09d}": rows_at,
                                   f"rejects-{number:09d}": rejects_at}, **counts)
        return counts
