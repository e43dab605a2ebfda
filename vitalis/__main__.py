"""Command line: ``python -m vitalis analyze|dashboard PATH [options]``.

``analyze`` runs the analyzer flow on JSON lines or Parquet readings (quality
report, clean, store as Parquet, grouped statistics, SQL on the stored
table) and prints each result; ``dashboard`` prints the data of each
dashboard panel.  PATH may also be a driver data folder (``events.parquet``).
"""

from __future__ import annotations

import argparse

from vitalis.plans.analysis import dashboard_data, run_analysis
from vitalis.session import build_session, clear_scratch
from vitalis.sources.files import exists, read_jsonl, read_parquet
from vitalis.sources.readings import readings


def _load(spark, path: str):
    """Readings at a path of any file system that Spark reaches."""
    if exists(spark, f"{path}/events.parquet"):
        return readings(spark, path)
    if path.rstrip("/").endswith(".parquet") or exists(spark, f"{path}/*.parquet") or exists(spark, f"{path}/*/*.parquet"):
        return read_parquet(spark, path)
    return read_jsonl(spark, path)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="vitalis")
    ap.add_argument("command", choices=["analyze", "dashboard"])
    ap.add_argument("path")
    ap.add_argument("--master", default=None, help="default: that of spark-submit")
    ap.add_argument("--out", default=None, help="where the cleaned Parquet goes and stays (default: a scratch folder that is removed at the end)")
    ap.add_argument("--as-of", default=None, help="reference time for the dashboard age (default: newest row)")
    ap.add_argument("--rows", type=int, default=20, help="rows to print per result")
    args = ap.parse_args(argv)
    spark = build_session(args.master)
    data = _load(spark, args.path)
    if args.command == "analyze":
        results = run_analysis(spark, data, args.out)
    else:
        as_of = args.as_of or str(data.agg({"ts": "max"}).first()[0])
        results = dashboard_data(data, as_of)
    for name, df in results.items():
        print(f"== {name}")
        df.show(args.rows, truncate=False)
    if not args.out:
        clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
