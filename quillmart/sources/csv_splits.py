"""Reading CSV files in byte ranges, with line ends inside quoted values.

Spark's text source cuts files into splits at line ends, but whether a line end stands
inside quotes follows from all quotes before it. A split's task therefore finds out
its own start from its first quotes: in well-formed CSV a quote opens a value after a
comma or line end and closes one before it, so that a quote with other text on one side
proves where it stands. (A split without such a quote is taken to start outside.) Records are
parsed with that start; the part before the first and after the last record end is a
fragment. Every split also reports its start and the parity of its quotes, and a prefix
sum of these over a file's splits checks all starts: splits that began wrongly are read once
more from the start now known. Then fragments of neighbouring splits are put together.

So the bytes are read once and by as many tasks as there are splits; headers come from the
first bytes of a file. What is read in several splits is written to the shared folder
(fragments and records together); files of one split are parsed lazily.

Dialect: comma, double quotes, a quote in a quoted value is doubled, blanks belong to
values, empty values are null, empty lines are nothing, lines end with LF or CRLF. A
record with more or fewer values than the header, or whose quote never ends, is a bad
record: it is returned with its text and the reason instead of values.
"""

from __future__ import annotations

import csv
import io
import re
import sys
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmart.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

HEADER_BYTES = 1 << 16
HEADER_READERS = 16
CORES_MORE = 4
QUOTES = re.compile(r'"+')
# Kinds of rows that a split gives: a record, a bad record, fragments, and the split's report.
RECORD, BAD, HEAD, WHOLE, TAIL, REPORT = range(6)
EXTRA = "_file string, _block long, _kind int, _text string, _reason string, _inside boolean"


def list_files(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """(path, length) of the files matched by a glob; a matched folder gives its part files, and
    one listing serves all folders of a pattern."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(pattern).getFileSystem(spark._jsc.hadoopConfiguration())
    found = list(fs.globStatus(path(pattern)) or [])
    out = [(s.getPath().toString(), s.getLen()) for s in found if s.isFile()]
    if any(s.isDirectory() for s in found):
        out += [(s.getPath().toString(), s.getLen()) for s in fs.globStatus(path(f"{pattern}/*")) or []
                if s.isFile() and not s.getPath().getName().startswith(("_", "."))]
    return sorted(out)


def header(spark: SparkSession, file: str) -> list[str]:
    """Column names from the file's first bytes."""
    path = spark._jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8"), HEADER_BYTES)
        return names(reader.readLine() or "")
    finally:
        stream.close()


def names(line: str) -> list[str]:
    return next(csv.reader([line.removeprefix("﻿").rstrip("\r\n")]), [])


def starts_inside(text: str) -> bool | None:
    """Whether ``text``, from a line start on, starts inside quotes; None if it holds no proof."""
    before = 0
    for run in QUOTES.finditer(text):
        count = run.end() - run.start()
        left = text[run.start() - 1] if run.start() else "\n"
        right = text[run.end()] if run.end() < len(text) else "\n"
        if count % 2 and right not in ",\r\n":  # it can't close, so it opens
            return before % 2 == 1
        if left not in ",\n" or (count % 2 == 0 and right not in ",\r\n"):  # it can't open
            return before % 2 == 0
        before += count
    return None


def parse(text: str, columns: list[str]) -> tuple[pa.Table, list[tuple[str, str]]]:
    """(records as text columns, [(bad record, reason)]) of whole records."""
    bad: list[tuple[str, str]] = []

    def refuse(row):
        bad.append((row.text, f"{row.actual_columns} values for {row.expected_columns} columns"))
        return "skip"

    raw = text.encode("utf-8", "surrogatepass")
    if not raw.strip(b"\r\n"):
        return pa.table({c: pa.array([], pa.string()) for c in dict.fromkeys(columns)}), bad
    table = pacsv.read_csv(
        io.BytesIO(raw), pacsv.ReadOptions(use_threads=False, block_size=len(raw) + 1, column_names=columns),
        pacsv.ParseOptions(newlines_in_values=True, invalid_row_handler=refuse),
        pacsv.ConvertOptions(column_types={c: pa.string() for c in columns}, null_values=[""], strings_can_be_null=True,
                             quoted_strings_can_be_null=True, check_utf8=False))
    return table, bad


class Split:
    """One split in progress: feeds lines in order, gives rows."""

    def __init__(self, file: str, block: int, wanted: list[str], columns: list[str] | None, inside: bool | None):
        self.file, self.block, self.wanted, self.columns = file, block, wanted, columns
        self.start = inside if block else False
        self.state = 0  # parity of all quotes from the file's start, as far as known
        self.quotes = 0
        self.open: list[str] = []  # lines of a record that has not ended
        self.ended = block == 0  # a record has ended in this split, or the split begins with one
        self.first = block == 0

    def rows(self, kind, text=None, reason=None, inside=None) -> pa.RecordBatch:
        return self._batch(1, {c: pa.nulls(1, pa.string()) for c in self.wanted}, kind, [text], [reason], inside)

    def _batch(self, n, values, kind, texts, reasons, inside=None) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [values[c] for c in self.wanted] + [
                pa.array([self.file] * n, pa.string()), pa.array([self.block] * n, pa.int64()), pa.array([kind] * n, pa.int32()),
                pa.array(texts, pa.string()), pa.array(reasons, pa.string()), pa.array([inside] * n, pa.bool_())],
            names=[*self.wanted, "_file", "_block", "_kind", "_text", "_reason", "_inside"])

    def records(self, text: str):
        table, bad = parse(text, self.columns)
        n = table.num_rows
        if n:
            values = {c: (table.column(self.columns.index(c)).combine_chunks() if c in self.columns
                          else pa.nulls(n, pa.string())) for c in self.wanted}
            values = {c: v if isinstance(v, pa.Array) else pa.concat_arrays(v.chunks) for c, v in values.items()}
            yield self._batch(n, values, RECORD, [None] * n, [None] * n)
        for text, reason in bad:
            yield self.rows(BAD, text, reason)

    def feed(self, lines: pa.Array):
        if self.first and len(lines):
            self.first = False
            if self.columns is None:
                self.columns = names(lines[0].as_py() or "")
            lines = lines.slice(1)
        if not len(lines):
            return
        if self.start is None:  # the first lines of a split whose start nobody knows
            self.start = bool(starts_inside("\n".join(lines.to_pylist())))
        if not self.quotes and not self.open and not self.ended:
            self.state = int(self.start)
            self.ended = not self.start
        counts = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)
        after = (self.state + np.cumsum(counts)) & 1
        self.quotes += int(counts.sum())
        ends = np.flatnonzero(after == 0)
        self.state = int(after[-1])
        if not len(ends):
            self.open += lines.to_pylist()
            return
        done = lines.slice(0, int(ends[-1]) + 1).to_pylist()
        if self.ended:
            done = self.open + done
        else:  # up to the first end it belongs to a record of an earlier split
            cut = int(ends[0]) + 1
            yield self.rows(HEAD, "\n".join(self.open + done[:cut]))
            done, self.ended = done[cut:], True
        self.open = lines.slice(int(ends[-1]) + 1).to_pylist()
        if done:
            yield from self.records("\n".join(done))

    def finish(self):
        if self.open:
            yield self.rows(TAIL if self.ended else WHOLE, "\n".join(self.open))
        yield self.rows(REPORT, str(self.quotes & 1), inside=bool(self.start))


def _splits(lines: DataFrame, wanted: list[str], columns: list[str] | None, known: bool = False) -> DataFrame:
    """Rows of all kinds from (value, file, block[, inside]), each split's lines in order."""
    def apply(batches):
        now = None
        for batch in batches:
            if not batch.num_rows:
                continue
            value, file, block = (batch.column(i) for i in range(3))
            place = list(zip(file.dictionary_encode().indices.to_pylist(), block.to_pylist()))
            cuts = [0, *(i for i in range(1, len(place)) if place[i] != place[i - 1]), len(place)]
            for a, z in zip(cuts[:-1], cuts[1:]):
                at = (file[a].as_py(), block[a].as_py())
                if now is None or (now.file, now.block) != at:
                    if now is not None:
                        yield from now.finish()
                    now = Split(*at, wanted, columns, batch.column(3)[a].as_py() if known else None)
                yield from now.feed(value.slice(a, z - a))
        if now is not None:
            yield from now.finish()

    return lines.mapInArrow(apply, ", ".join(f"`{c}` string" for c in wanted) + ", " + EXTRA)


def _lines(spark: SparkSession, files: list[str], uncut: bool = False) -> DataFrame:
    """Lines with file and block; with ``uncut``, a file that comes in several splits ends the read."""
    block = F.col("_metadata.file_block_start")
    if uncut:
        block = F.when(F.col("_metadata.file_block_length") == F.col("_metadata.file_size"), block).otherwise(F.raise_error(
            F.lit("a file was split that is meant to be read whole: set spark.sql.files.minPartitionNum")))
    return spark.read.option("lineSep", "\n").text(files).select(
        "value", F.col("_metadata.file_path").alias("file"), block.alias("block"))


def uncut_bytes(spark: SparkSession, lengths: list[int]) -> int:
    """Length up to which files are read in one split if those up to it are read together.

    Spark cuts at maxPartitionBytes, or at a core's share of all bytes where that is less; ``CORES_MORE`` times the
    cores that there are now are allowed for. Never under what Spark opens a file for.
    """
    least, most = (_bytes(spark, f"spark.sql.files.{k}") for k in ("openCostInBytes", "maxPartitionBytes"))
    cores = CORES_MORE * int(spark.conf.get("spark.sql.files.minPartitionNum", None) or spark.sparkContext.defaultParallelism)
    while True:
        together = [n for n in lengths if n <= most]
        bound = min(most, max(least, sum(together) // cores))
        if bound == most:
            return most
        most = bound


def true_starts(rows: DataFrame) -> DataFrame:
    """(file, block, inside, wrong): each split's start by the parity of all splits before it."""
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # a row per split
    reports = rows.where(F.col("_kind") == REPORT)
    inside = (F.coalesce(F.sum(F.col("_text").cast("int")).over(before), F.lit(0)) % 2 == 1)
    return reports.select(F.col("_file").alias("file"), F.col("_block").alias("block"), inside.alias("inside"),
                          (inside != F.col("_inside")).alias("wrong"))


def _written(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "csv")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _several_splits(spark: SparkSession, files: list[str], wanted: list[str], columns: list[str]) -> DataFrame:
    """Records and bad records of files with one header that are read in several splits."""
    lines = _lines(spark, files)
    rows = _written(_splits(lines, wanted, columns))
    wrong = true_starts(rows).where("wrong").select("file").distinct()
    again = [r["file"] for r in wrong.collect()]  # files of this read
    if again:
        starts = true_starts(rows).where(F.col("file").isin(again)).select("file", "block", "inside")
        numbered = _lines(spark, again).withColumn("at", F.monotonically_increasing_id())
        # a join may deal lines out anew: each split's lines are brought back into order
        known = (numbered.join(starts, ["file", "block"], "left").repartition("file", "block")
                 .sortWithinPartitions("file", "block", "at").select(
                     "value", "file", "block", F.when(F.col("inside").isNull(), F.raise_error(
                         F.lit("a file was split another way than before: set spark.sql.files.minPartitionNum")))
                     .otherwise(F.col("inside")).alias("inside")))
        rows = _written(rows.where(~F.col("_file").isin(again)).unionByName(_splits(known, wanted, columns, known=True)))
    return rows.where(F.col("_kind") <= BAD).unionByName(_joined_fragments(rows, wanted, columns))


def _joined_fragments(rows: DataFrame, wanted: list[str], columns: list[str]) -> DataFrame:
    """Records whose lines lie in several splits: a tail, whole splits, and a head."""
    order = Window.partitionBy("_file").orderBy("_block", "_kind")  # at most two fragments per split
    parts = rows.where(F.col("_kind").isin(HEAD, WHOLE, TAIL)).select(
        "_file", "_block", "_kind", "_text",
        F.sum((F.col("_kind") == TAIL).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("record"))
    whole = parts.groupBy("_file", "record").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_block", "_kind", "_text"))),
                                 lambda p: p["_text"]), "\n").alias("text"),
        F.max((F.col("_kind") == HEAD).cast("int")).alias("closed"), F.min("_block").alias("block"))

    def apply(batches):
        for batch in batches:
            for file, text, closed, block in zip(*(batch.column(c).to_pylist() for c in ("_file", "text", "closed", "block"))):
                split = Split(file, block, wanted, columns, False)
                if closed:
                    yield from split.records(text)
                else:
                    yield split.rows(BAD, text, "a quote never ends")

    return whole.select("_file", "text", "closed", "block").mapInArrow(apply, rows.schema)


def scan(spark: SparkSession, files: list[tuple[str, int]], wanted: list[str]) -> DataFrame:
    """``wanted`` columns as text by name (missing ones null), ``_file``, and for bad records
    ``_text`` and ``_reason`` (null otherwise)."""
    one_split = uncut_bytes(spark, [n for _, n in files])
    small = [f for f, n in files if n <= one_split]
    large = [f for f, n in files if n > one_split]
    parts = []
    if small:
        rows = _splits(_lines(spark, small, uncut=True), wanted, None)
        unended = F.when(F.col("_kind") == TAIL, F.lit("a quote never ends")).otherwise(F.col("_reason"))
        parts.append(rows.where(F.col("_kind").isin(RECORD, BAD, TAIL)).withColumn("_reason", unended))
    if large:
        with ThreadPoolExecutor(HEADER_READERS) as pool:
            heads = list(pool.map(lambda f: tuple(header(spark, f)), large))
        for columns in sorted(set(heads)):
            parts.append(_several_splits(spark, [f for f, h in zip(large, heads) if h == columns], wanted, list(columns)))
    if not parts:
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in wanted) + ", _file string, _text string, _reason string")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*[F.col(f"`{c}`") for c in wanted], "_file", "_text", "_reason")


def _bytes(spark: SparkSession, key: str) -> int:
    """A size setting in bytes."""
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)))
