"""Registered queries about written tables: layers, loads, merges, exports."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from quillmart.plans import oracle as O
from quillmart.plans.registry import _DELIV, _EXPORTED, _HASHED, ORACLE, _hash_sql, _hashes, _wh, register
from quillmart.session import release_shuffles, scratch_path


# ------------------------------------------------------------------ layers
_GOLD = {q: _HASHED[m] for m, q in _EXPORTED.items()} | {
    "forecast_actuals": ["revenue_month", "product_line", "revenue", "units_sold", "order_count", "is_forecast"]}


@register("gold_tables", _hash_sql({m: ORACLE[m] for m in _GOLD}, _GOLD))
def q_gold_tables(spark, sf_dir):
    """Write silver in buckets and gold over it as catalog tables, read gold back, hash its columns' values."""
    from quillmart.plans.catalog import materialize_gold, materialize_silver
    from quillmart.plans.warehouse import Warehouse
    w = Warehouse(spark, sf_dir)
    catalog, _ = materialize_silver(w, scratch_path(spark, "layers"))
    materialize_gold(w, catalog)
    return _hashes({m: catalog.table(m) for m in _GOLD}, _GOLD)


# ------------------------------------------------------------------- loads
@register("load_manifest", O.sql_for("""
SELECT return_id, order_id, return_date,
       CAST(CASE WHEN year(return_date) = 1997 THEN quantity_returned + 1 ELSE quantity_returned END AS INTEGER)
         AS quantity_returned, reason,
       CAST(CASE WHEN year(return_date) = 1997 THEN 2 ELSE 1 END AS INTEGER) AS load
FROM raw_returns WHERE return_date IS NOT NULL"""))
def q_load_manifest(spark, sf_dir):
    """Three loads of monthly drops: all are new; all are held already; one year has changed and the
    first month's drop is gone (its rows stay)."""
    from quillmart.sources import csv_ingest as CI
    from quillmart.sources.manifest import LoadedTable
    returns = _wh(spark, sf_dir).raw["returns"]
    raw = scratch_path(spark, "raw")
    pattern = os.path.join(raw, "*", "returns.csv")
    table = LoadedTable(spark, scratch_path(spark, "loaded"), "returns", returns.schema)
    CI.write_dated(returns, raw, "returns", "return_date", grain="month")
    first = table.load(pattern)
    if table.load(pattern) != {"new": 0, "changed": 0, "same": first["new"], "missing": 0}:
        raise RuntimeError("a second load of the same drops must take none")
    year = returns.where(F.year("return_date") == 1997).withColumn("quantity_returned", F.col("quantity_returned") + 1)
    CI.write_dated(year, raw, "returns", "return_date", grain="month")
    path = spark._jvm.org.apache.hadoop.fs.Path
    month = returns.agg(F.trunc(F.min("return_date"), "month")).head()[0]
    gone = path(os.path.join(raw, str(month)))
    gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    table.load(pattern)
    return table.rows().select(*returns.columns, F.col("_load").alias("load"))


_DIRTY = """
SELECT order_id, order_date, product_id, customer_id, rep_id, territory_id, quantity, list_price, discount_pct,
       net_price, gross_amount, net_amount, CAST(NULL AS VARCHAR) AS bad_column, CAST(NULL AS VARCHAR) AS bad_value,
       CAST(NULL AS VARCHAR) AS reason
FROM raw_orders WHERE NOT COALESCE(quantity % 7 = 0, FALSE) AND NOT COALESCE(product_id % 11 = 0, FALSE)
UNION ALL
SELECT order_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
       'quantity', quantity || ' pcs', 'not a value of type int' FROM raw_orders WHERE quantity % 7 = 0
UNION ALL
SELECT order_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
       'order_date', CAST(year(order_date) AS VARCHAR) || '-13-40', 'not a value of type date'
FROM raw_orders WHERE product_id % 11 = 0"""


@register("load_dirty", O.sql_for(_DIRTY))
def q_load_dirty(spark, sf_dir):
    """Bad text in two columns: clean rows, and a reject row for each bad value."""
    from quillmart.sources import csv_ingest as CI
    orders = _wh(spark, sf_dir).raw["orders"]
    spoilt = orders.select(*[F.col(c).cast("string") for c in orders.columns if c not in ("quantity", "order_date")],
                           F.when(F.col("quantity") % 7 == 0, F.concat(F.col("quantity").cast("string"), F.lit(" pcs")))
                           .otherwise(F.col("quantity").cast("string")).alias("quantity"),
                           F.when(F.col("product_id") % 11 == 0, F.concat(F.year("order_date").cast("string"), F.lit("-13-40")))
                           .otherwise(F.col("order_date").cast("string")).alias("order_date"))
    raw = scratch_path(spark, "raw")
    spoilt.write.options(**CI.CSV_FORM, maxRecordsPerFile=CI.FILE_RECORDS).csv(os.path.join(raw, "orders.csv"))
    clean, rejects = CI.load_checked(spark, os.path.join(raw, "orders.csv"), "orders", orders.schema)
    bad = rejects.select(F.get_json_object("record", "$.order_id").alias("order_id"), F.col("column").alias("bad_column"),
                         F.col("value").alias("bad_value"), "reason")
    return clean.unionByName(bad, allowMissingColumns=True)


# ------------------------------------------------------------------ merges
@register("incremental_merge", O.sql_for("""
SELECT order_id, order_date, product_id, customer_id, rep_id, territory_id, quantity, list_price,
       discount_pct, net_price, gross_amount, net_amount, _loaded_at
FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY _loaded_at DESC) AS rn
      FROM deliveries) d
WHERE rn = 1""", _DELIV))
def q_incremental_merge(spark, sf_dir):
    """Two streamed increments merged by key: the second's corrections replace the first's rows."""
    from quillmart.plans.registry import RUN_TS_LIT
    from quillmart.streaming.merge import KeyedTable, merge_stream
    rows = _wh(spark, sf_dir).order_deliveries
    base = scratch_path(spark, "merged")
    table = KeyedTable(spark, os.path.join(base, "table"), ["order_id"], ["_loaded_at"], buckets=16)
    first = F.col("_loaded_at") <= F.lit(RUN_TS_LIT).cast("timestamp_ntz")
    for part in (rows.where(first), rows.where(~first)):
        part.write.mode("append").option("compression", "zstd").parquet(os.path.join(base, "drops"))
        release_shuffles(spark)
        merge_stream(table, os.path.join(base, "drops"), os.path.join(base, "checkpoint"), rows.schema)
    table.vacuum()  # the first merge's state, which the second has replaced
    return table.read()


# ------------------------------------------------------------------ exports
EXPORT_FROM = "1997-01-01"


@register("export_ordered", f"SELECT * FROM ({ORACLE['time_intelligence']}) t WHERE order_date >= DATE '{EXPORT_FROM}'")
def q_export_ordered(spark, sf_dir):
    """A mart exported in order of its days, then read from a day on: the footers let earlier files be skipped."""
    from quillmart.sources.export import export_table
    mart = _wh(spark, sf_dir).time_intelligence("rows")
    path = export_table(mart, scratch_path(spark, "export"), "mart_time_intelligence",
                        order_by=("order_date", "product_line", "therapeutic_area"), row_group_rows=10_000)
    return spark.read.schema(mart.schema).parquet(path).where(F.col("order_date") >= F.lit(EXPORT_FROM).cast("date"))


@register("series_in_order", O.sql_for("""
SELECT *, CAST(row_number() OVER (ORDER BY product_line NULLS FIRST, revenue_month) - 1 AS BIGINT) AS position
FROM fc_series"""))
def q_series_in_order(spark, sf_dir):
    """The forecast's series written by line and month; ``position`` is each row's place as read."""
    from quillmart.sources.export import export_table, read_in_order
    path = export_table(_wh(spark, sf_dir).series, scratch_path(spark, "export"), "series", order_by=("product_line", "revenue_month"))
    return read_in_order(spark, path)


@register("waterfall_in_order", f"""
SELECT *, CAST(row_number() OVER (ORDER BY event_month) - 1 AS BIGINT) AS position FROM ({ORACLE['mrr_waterfall']}) t""")
def q_waterfall_in_order(spark, sf_dir):
    """The waterfall written by month; ``position`` is each row's place as read."""
    from quillmart.sources.export import export_table, read_in_order
    path = export_table(_wh(spark, sf_dir).mrr_waterfall(), scratch_path(spark, "export"), "waterfall", order_by=("event_month",))
    return read_in_order(spark, path)


@register("export_text", f"""
SELECT * REPLACE (CAST(contract_start_date AS VARCHAR) AS contract_start_date,
                  CAST(contract_end_date AS VARCHAR) AS contract_end_date, CAST(report_month AS VARCHAR) AS report_month,
                  CAST(last_order_date AS VARCHAR) AS last_order_date) FROM ({ORACLE['customer_health']}) t""")
def q_export_text(spark, sf_dir):
    """Customer health exported with dates as text."""
    import datetime as dt
    from quillmart.sources.export import export_all
    done = export_all({"mart_customer_health": _wh(spark, sf_dir).customer_health()}, scratch_path(spark, "export"),
                      dt.date(2001, 1, 1), stringify=True)
    if done["failed"]:
        raise RuntimeError(f"export failed: {done['failed']}")
    return spark.read.parquet(done["ok"][0][1])


@register("load_defaults", O.sql_for("SELECT * FROM raw_territories"))
def q_load_defaults(spark, sf_dir):
    """Territories from a file without the country column: staging fills in the default."""
    from quillmart.operators.staging import stage_territories
    from quillmart.sources import csv_ingest as CI
    territories = _wh(spark, sf_dir).raw["territories"]
    raw = scratch_path(spark, "raw")
    CI.write_static(territories.drop("country"), raw, "territories")
    return stage_territories(CI.read_static(spark, raw, {"territories": territories.schema})["territories"])
