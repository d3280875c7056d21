"""What building a query may do, and plans of the heavy ones."""

import pytest

from quillmart.plans.registry import QUERIES, _wh
from quillmart.plans.catalog import materialize_silver
from quillmart.plans.warehouse import Warehouse

SF = "/root/testdata/sf0.001"
# These write files to read them back: that is what they are about.
WRITERS = {"incremental_load", "load_daily_csv", "load_idempotent", "load_static_csv", "load_dated_csv",
           "load_one_day_csv", "export_roundtrip", "incremental_twice", "forecast_table", "gold_tables",
           "load_manifest", "load_dirty", "incremental_merge", "export_ordered", "series_in_order",
           "waterfall_in_order", "export_text", "load_defaults"}


def jobs(spark, group):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS))
def test_building_runs_no_job_but_checked_dimension_scans(spark, name):
    QUERIES[name](spark, SF)  # listing and the checked scans are kept after this
    spark.sparkContext.setJobGroup(f"build-{name}", name)
    try:
        QUERIES[name](spark, SF)
        assert jobs(spark, f"build-{name}") == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_territory_health_does_not_expand(spark):
    assert "Expand" not in plan(QUERIES["territory_health"](spark, SF))


def test_quality_report_reads_each_table_once(spark):
    w = _wh(spark, SF)
    from quillmart.operators.quality import dq_table
    from quillmart.plans.registry import raw_checks
    text = plan(dq_table(w.raw["products"], "products", raw_checks()["products"]))
    assert text.count("Relation [") + text.count("Relation[") == 1


def test_written_layer_never_joins_lines_to_headers_again(spark, tmp_path):
    w = Warehouse(spark, SF)
    materialize_silver(w, str(tmp_path))
    for df in (w.raw["orders"], w.raw["returns"], w.raw["costs"], w.raw["mrr_events"], w.stg["orders"]):
        text = plan(df)
        assert "l_extendedprice" not in text and "o_custkey#" not in text.split("Relation")[0]
