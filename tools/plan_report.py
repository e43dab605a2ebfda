"""Write docs/PLANS.md: the physical-plan shape of every registered query on readings.

For each query: scans (pushed filters, read schema), shuffles, joins and
windows, taken from ``explain("formatted")`` at the given scale factor.
Stream and round-trip queries are planned on what they read back.
"""

from __future__ import annotations

import contextlib
import io
import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def summarize(text: str) -> dict:
    nodes = re.findall(r"^\(\d+\) (.+)$", text, flags=re.M)
    names = [n.strip() for n in nodes]
    pushed = re.findall(r"^PushedFilters: (.+)$", text, flags=re.M)
    schema = re.findall(r"^ReadSchema: (.+)$", text, flags=re.M)
    exch = [n for n in names if n.startswith("Exchange") or n.startswith("BroadcastExchange")]
    parts = re.findall(r"^Arguments: (hashpartitioning\([^)]*\)|rangepartitioning\([^)]*\)|SinglePartition)", text, flags=re.M)
    joins = [n for n in names if "Join" in n]
    return {
        "scans": len([n for n in names if n.startswith("Scan")]),
        "pushed": sorted({p for p in pushed if p != "[]"}),
        "schema": sorted(set(schema)),
        "exchanges": len(exch),
        "partitioning": sorted(set(parts)),
        "joins": sorted(set(joins)),
        "windows": sum(n.startswith("Window") for n in names),
        "single": "SinglePartition" in text,
        "topk": any(n.startswith("TakeOrderedAndProject") for n in names),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from vitalis.plans.registry import QUERIES
    from vitalis.session import build_session

    spark = build_session("local[8]", 8)
    lines = [
        "# Physical plans of the registered queries",
        "",
        f"Generated by `python tools/plan_report.py {sf_dir}` from `explain(\"formatted\")`",
        "(AQE initial plans; AQE may later coalesce partitions or switch a join to broadcast).",
        "",
        "| query | scans | pushed filters | exchanges | joins | windows | single partition | top-k |",
        "| --- | --- | --- | --- | --- | --- | --- | --- |",
    ]
    for name, fn in QUERIES.items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fn(spark, sf_dir).explain("formatted")
        s = summarize(buf.getvalue())
        pushed = "<br>".join(p.replace("|", "\\|") for p in s["pushed"]) or "-"
        lines.append(
            f"| {name} | {s['scans']} | {pushed} | {s['exchanges']} | {', '.join(s['joins']) or '-'} | "
            f"{s['windows']} | {'yes' if s['single'] else 'no'} | {'yes' if s['topk'] else 'no'} |"
        )
    lines += [
        "",
        "Reading the table: `single partition = yes` appears for global aggregates",
        "(one output row); Spark aggregates partially in every task first, so that",
        "exchange carries one partial row per task, never the data.  For",
        "`sensor_distribution` it carries the already grouped rows (one per sensor).",
        "Broadcast joins are the 5-row range table, the per-sensor bounds of a",
        "histogram (one row per listed sensor) or AQE's run-time choice for a side",
        "measured under the broadcast threshold.  Trailing windows partition by",
        "(key, time bucket) and never use a single partition.",
    ]
    out = Path(__file__).resolve().parents[1] / "docs" / "PLANS.md"
    out.write_text("\n".join(lines) + "\n")
    print(out)
    spark.stop()


if __name__ == "__main__":
    main()
