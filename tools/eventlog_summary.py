"""Summarise a Spark event log: stage count, stage time and tasks per job description.

Usage: python tools/eventlog_summary.py EVENT_LOG (file or eventlog_v2_* folder)
bench.py tags every query's jobs with the query name as job description.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    """Event lines of a plain log file or of a rolling (``eventlog_v2_*``)
    folder of zstd / plain parts."""
    files = [path]
    if os.path.isdir(path):
        files = sorted(glob.glob(os.path.join(path, "events_*")), key=lambda p: int(os.path.basename(p).split("_")[1]))
    for fp in files:
        if fp.endswith(".zstd"):
            import zstandard

            with open(fp, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(fp) as f:
                yield from f


def find_log(log_dir: str, app_id: str) -> str | None:
    for cand in (os.path.join(log_dir, app_id), os.path.join(log_dir, f"eventlog_v2_{app_id}")):
        if os.path.exists(cand):
            return cand
    return None


def summarize(path: str) -> dict[str, dict]:
    stage_owner: dict[int, str] = {}
    out: dict[str, dict] = defaultdict(lambda: {"jobs": 0, "stages": 0, "tasks": 0, "stage_ms": 0, "max_stage_ms": 0})
    for line in _lines(path):
        if not line.strip():
            continue
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            name = (ev.get("Properties") or {}).get("spark.job.description") or "untagged"
            out[name]["jobs"] += 1
            for sid in ev.get("Stage IDs", []):
                stage_owner[sid] = name
        elif kind == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            if info.get("Submission Time") and info.get("Completion Time"):
                ms = info["Completion Time"] - info["Submission Time"]
                rec = out[stage_owner.get(info["Stage ID"], "untagged")]
                rec["stages"] += 1
                rec["tasks"] += info.get("Number of Tasks", 0)
                rec["stage_ms"] += ms
                rec["max_stage_ms"] = max(rec["max_stage_ms"], ms)
    return dict(out)


if __name__ == "__main__":
    print(json.dumps(summarize(sys.argv[1]), indent=1))
