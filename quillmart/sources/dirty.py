"""Dirty text: typed rows and a table of rejects beside them.

A value that isn't empty and can't be cast to its column's type, and a record with the wrong
number of values or without an end of its quote, rejects its row. Rejects name the file,
the column, the value and the reason, one row for each, with the row's text; nothing fails
and nothing vanishes: every record read is either clean or rejected.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REJECTS = "file string, record string, column string, value string, reason string"
_ERROR = "array<struct<column:string,value:string,reason:string>>"


def checked(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed columns of ``schema`` (null where a value can't be cast), ``_errors`` and ``_record``, from
    text columns with ``_file``, ``_text`` and ``_reason`` (null for whole records); other columns stay."""
    cast, typed, wrong, errors = [], [], [F.col("_reason").isNotNull()], []
    for i, f in enumerate(schema.fields):
        text, value = F.col(f"`{f.name}`"), F.col(f"_typed{i}")
        if isinstance(f.dataType, T.StringType):
            typed.append(text)
            continue
        cast.append(F.nullif(F.trim(text), F.lit("")).try_cast(f.dataType).alias(f"_typed{i}"))
        typed.append(value.alias(f.name))
        wrong.append(value.isNull() & text.isNotNull() & (F.trim(text) != ""))
        errors.append(F.when(wrong[-1], F.struct(
            F.lit(f.name).alias("column"), text.alias("value"),
            F.lit(f"not a value of type {f.dataType.simpleString()}").alias("reason"))))
    broken = F.when(F.col("_reason").isNotNull(), F.struct(
        F.lit(None).cast("string").alias("column"), F.col("_text").alias("value"), F.col("_reason").alias("reason")))
    names = [f.name for f in schema.fields]
    record = F.coalesce("_text", F.to_json(F.struct(*[F.col(f"`{c}`") for c in names])))
    rest = [c for c in rows.columns if c not in {*names, "_text", "_reason"}]
    found = F.array_compact(F.array(broken, *errors)).cast(_ERROR)
    # Each value is cast once, in a projection of its own; errors and record are built for wrong rows only.
    flagged = rows.select("*", *cast).select("*", functools.reduce(operator.or_, wrong).alias("_wrong"))
    none = F.array().cast(_ERROR)
    return flagged.select(*typed, *rest, F.when(F.col("_wrong"), found).otherwise(none).alias("_errors"),
                          F.when(F.col("_wrong"), record).alias("_record"))


def clean(rows: DataFrame) -> DataFrame:
    """The rows of ``checked`` without any error."""
    return rows.where(F.size("_errors") == 0).drop("_errors", "_record")


def rejects(rows: DataFrame) -> DataFrame:
    """One row per error of the rows of ``checked``."""
    return (rows.where(F.size("_errors") > 0).select("_file", "_record", F.explode("_errors").alias("e"))
            .select(F.col("_file").alias("file"), F.col("_record").alias("record"), "e.column", "e.value", "e.reason"))
