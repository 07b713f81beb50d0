"""Run pipelines from YAML configuration files.

    python -m millrace --pipelines config/pipelines.yml --app config/app.yml \
        [--pipeline erp] [--root .] [--as-of 2024-03-01]

The pipeline file has the reference's layout (``pipelines: {name: {enabled,
append, source_folder, source_pattern, bronze_table, required_columns,
excel, staging_folder, dbt_selector, mart_tables}}``); the app file's
``exports`` block (folder, parquet, csv) is used as is, and an optional
``warehouse`` key names the table-store folder.  Paths are relative to
``--root``.  Exit status 1 when any pipeline failed.
"""

from __future__ import annotations

import argparse
import sys

from millrace.plans.config import read_config
from millrace.plans.pipeline import run_all
from millrace.session import build_session


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="millrace")
    p.add_argument("--pipelines", default="config/pipelines.yml")
    p.add_argument("--app", default="config/app.yml")
    p.add_argument("--pipeline")
    p.add_argument("--root", default=".")
    p.add_argument("--as-of")
    a = p.parse_args(argv)
    pipes = read_config(a.pipelines).get("pipelines", {})
    if a.pipeline and a.pipeline not in pipes:
        p.error(f"unknown pipeline: {a.pipeline}")
    app = dict(read_config(a.app))
    app.setdefault("root", a.root)
    spark = build_session()
    status = run_all(spark, pipes, app, only=a.pipeline, as_of=a.as_of)
    rows = status.collect()
    for r in rows:
        print(f"{r.pipeline}: {r.status}" + (f" ({r.error})" if r.error else ""))
    failed = [r.pipeline for r in rows if r.status != "SUCCESS"]
    print("Failed: " + ", ".join(failed) if failed else "ELT completed successfully.")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
