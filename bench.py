"""Stage benchmark: prints ONE JSON line.

model build and export as the stages to time):

  file_profile        discover + SHA-256 / header / separator of the ERP CSVs
  ingest_csv_append   incremental Bronze load of those CSVs (fresh warehouse)
  silver_erp          Bronze ERP -> typed Silver table
  mart_erp            Silver ERP -> mart.erp (one aggregate + metrics)
  mart_workflow       Silver workflow + invoice dimension -> mart.workflow
  export_parquet      mart.erp -> ZSTD Parquet export

Inputs are CSV files derived once (untimed) from $BENCH_SF_DIR's tables.
Each stage: one warm-up, then the median of 3 timed runs.
Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.session import build_session  # noqa: E402


def driver_memory_gb() -> int:
    """About 60% of physical memory (local mode: the driver is the executor),
    between 1 and 16 GiB."""
    try:
        with open("/proc/meminfo") as fh:
            kb = int(next(line for line in fh if line.startswith("MemTotal")).split()[1])
        return max(1, min(16, int(kb / 1024 / 1024 * 0.6)))
    except (OSError, StopIteration, ValueError):
        return 4


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", str(min(8, os.cpu_count() or 4))))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus * 2, 8),
                          extra={"spark.driver.memory": f"{driver_memory_gb()}g"})
    spark.sparkContext.setLogLevel("ERROR")

    from millrace.operators import marts, silver
    from millrace.plans.export import export_tables
    from millrace.plans.fixtures import (ERP_SOURCE_COLUMNS, FIXTURE_AS_OF,
                                         WORKFLOW_SOURCE_COLUMNS, bronze)
    from millrace.plans.ledger import Ledger, now
    from millrace.plans.pipeline import load_files
    from millrace.plans.scratch import scratch, write_csv
    from millrace.sources import files as src_files
    from millrace.store import TableStore

    root = scratch(spark, "bench")
    write_csv(bronze(spark, sf_dir, "erp").select(*ERP_SOURCE_COLUMNS), f"{root}/source/erp",
              key="ERP_RECORD_ID")
    write_csv(bronze(spark, sf_dir, "workflow").select(*WORKFLOW_SOURCE_COLUMNS),
              f"{root}/source/workflow", key="WORKFLOW_EVENT_ID")
    erp_cfg = {"source_folder": "source/erp", "source_pattern": "*.csv", "bronze_table": "bronze.erp"}
    wf_cfg = {"source_folder": "source/workflow", "source_pattern": "*.csv",
              "bronze_table": "bronze.workflow", "required_columns": ["WORKFLOW_ID", "SUPPLIER_ID"]}

    def fresh_store():
        store = TableStore(spark, f"{root}/warehouse-{uuid.uuid4().hex[:8]}")
        ledger = Ledger(spark, store)
        ledger.initialize()
        return store, ledger

    # Untimed setup of the tables the later stages read.
    store, ledger = fresh_store()
    load_files(spark, store, ledger, "erp", erp_cfg, root, "setup", now())
    load_files(spark, store, ledger, "workflow", wf_cfg, root, "setup", now())
    store.overwrite("silver.erp", silver.silver_erp(store.read("bronze.erp")))
    store.overwrite("silver.workflow", silver.silver_workflow(store.read("bronze.workflow")))
    store.overwrite("mart.dim_invoice", marts.dim_invoice(store.read("silver.erp")))
    store.overwrite("mart.erp", marts.mart_erp(store.read("silver.erp"), FIXTURE_AS_OF))

    def st_profile():
        found = src_files.discover(spark, f"{root}/source/erp", "*.csv")
        return src_files.profile(spark, found).select("path", "file_hash", "sep").collect()

    def st_ingest():
        s, l = fresh_store()
        load_files(spark, s, l, "erp", erp_cfg, root, "bench", now())

    stages = {
        "file_profile": st_profile,
        "ingest_csv_append": st_ingest,
        "silver_erp": lambda: store.overwrite("silver.erp", silver.silver_erp(store.read("bronze.erp"))),
        "mart_erp": lambda: store.overwrite(
            "mart.erp", marts.mart_erp(store.read("silver.erp"), FIXTURE_AS_OF)),
        "mart_workflow": lambda: store.overwrite("mart.workflow", marts.mart_workflow(
            store.read("silver.workflow"), store.read("mart.dim_invoice"))),
        "export_parquet": lambda: export_tables(store, ["mart.erp"], f"{root}/exports"),
    }
    results = {}
    for name, fn in stages.items():
        fn()  # warm-up
        times = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            fn()
            times.append(time.perf_counter() - t0)
        results[name] = round(statistics.median(times), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "pipeline_stage_seconds_total",
                      "value": round(sum(results.values()), 3), "unit": "sec",
                      "queries": results, "sf": float(m.group(1)) if m else sf_dir,
                      "cpus": cpus}))


if __name__ == "__main__":
    main()
