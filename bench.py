"""Benchmark: build the silver layer once, then time each headline mart/report.

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from quillmart.session import get_session, scratch_path
    ev_dir = tempfile.mkdtemp(prefix="bench-events-")
    spark = get_session(
        master=f"local[{cpus}]", shuffle_partitions=cpus,
        extra={"spark.ui.showConsoleProgress": "false",
               "spark.sql.files.maxPartitionBytes": str(8 * 1024 * 1024),
               "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{ev_dir}"})
    from quillmart.operators import forecast as FC
    from quillmart.operators import reports as RP
    from quillmart.plans.registry import QUERIES, silver_checks, use_warehouse
    from quillmart.plans.catalog import materialize_silver
    from quillmart.plans.warehouse import Warehouse

    def run(build) -> float:
        t0 = time.time()  # building a query counts: size checks and staged writes happen there
        build().write.format("noop").mode("overwrite").save()
        return time.time() - t0

    w = Warehouse(spark, sf_dir)
    use_warehouse(w)  # registered queries read the written layers too
    t0 = time.time()
    _, silver = materialize_silver(w, scratch_path(spark, "layers"), row_group_bytes=8 * 1024 * 1024, checks=silver_checks())
    times = {"silver_build": time.time() - t0}
    heads = {
        "sales_performance": lambda: w.sales_performance(),
        "cogs_margin": lambda: w.cogs_margin(),
        "customer_health": lambda: w.customer_health(),
        "mrr_waterfall": lambda: w.mrr_waterfall(),
        "time_intelligence": lambda: w.time_intelligence(),
        "forecast_actuals": lambda: w.forecast_actuals(),
        "forecast_linear": lambda: FC.forecast_linear(FC.monthly_series(w.forecast_actuals())),
        "forecast_holt_winters": lambda: FC.forecast_holt_winters(FC.monthly_series(w.forecast_actuals())),
        "sales_summary": lambda: RP.sales_summary(w.fact_sales, w.dims),
        "rep_performance": lambda: RP.rep_performance(w.fact_sales, w.dims),
        "dq_report": lambda: QUERIES["dq_report"](spark, sf_dir),
    }
    for name, build in heads.items():
        times[name] = run(build)
    total = sum(times.values())
    print(json.dumps({
        "metric": "pipeline_total", "value": round(total, 3), "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "silver_tables": {k: round(v, 3) for k, v in silver.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""), "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
