"""Summarize a Spark event log: per job its duration, stages (tasks, ms) and
the driver-side gap before it; per job group the total.

    python scripts/eventlog_summary.py <event log dir or file> [--last N]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def read_events(path: str) -> list[dict]:
    files = [path] if os.path.isfile(path) else sorted(
        f for f in glob.glob(os.path.join(path, "**", "*"), recursive=True)
        if os.path.isfile(f) and not os.path.basename(f).startswith("appstatus"))
    events = []
    for f in files:
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        events += [json.loads(line) for line in raw.decode().splitlines() if line.strip()]
    return events


def main() -> None:
    path = sys.argv[1]
    last = int(sys.argv[sys.argv.index("--last") + 1]) if "--last" in sys.argv else None
    jobs, stage_job, stages = {}, {}, {}
    for e in read_events(path):
        ev = e["Event"]
        if ev == "SparkListenerJobStart":
            desc = (e.get("Properties") or {}).get("spark.job.description") or ""
            jobs[e["Job ID"]] = {"start": e["Submission Time"], "end": None, "desc": desc}
            for s in e["Stage IDs"]:
                stage_job[s] = e["Job ID"]
        elif ev == "SparkListenerJobEnd":
            jobs[e["Job ID"]]["end"] = e["Completion Time"]
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            if "Submission Time" in si:
                stages.setdefault(stage_job.get(si["Stage ID"]), []).append(
                    (si["Number of Tasks"], si["Completion Time"] - si["Submission Time"]))
    ids = sorted(jobs)[-last:] if last else sorted(jobs)
    prev = None
    busy = 0
    for j in ids:
        job = jobs[j]
        dur = (job["end"] or job["start"]) - job["start"]
        busy += dur
        gap = job["start"] - prev if prev is not None else 0
        print(f"job {j:4d} {dur:6d} ms  gap {gap:6d} ms  stages (tasks, ms) {stages.get(j, [])} {job['desc'][:40]}")
        prev = job["end"] or job["start"]
    groups: dict[str, list[int]] = {}
    for j in ids:
        groups.setdefault(jobs[j]["desc"], []).append(j)
    for desc, js in groups.items():
        if desc:
            span = (jobs[js[-1]]["end"] or 0) - jobs[js[0]]["start"]
            busy_g = sum((jobs[j]["end"] or jobs[j]["start"]) - jobs[j]["start"] for j in js)
            print(f"  {desc:28s} jobs {len(js):3d}  in jobs {busy_g:6d} ms  span {span:6d} ms")
    if ids:
        span = (jobs[ids[-1]]["end"] or jobs[ids[-1]]["start"]) - jobs[ids[0]]["start"]
        print(f"{len(ids)} jobs, {busy} ms in jobs, {span} ms span, {span - busy} ms between jobs")


if __name__ == "__main__":
    main()
