"""Summarise a Spark event log folder (as written with ZONECAST_EVENT_LOG):
stage count, summed stage time and the slowest stages.

    python tools/stage_times.py <event-log-folder> [top]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard

        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main() -> None:
    root = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    files = [f for f in glob.glob(os.path.join(root, "**", "*"), recursive=True)
             if os.path.isfile(f) and os.path.basename(f).startswith(("events", "local-", "app-"))]
    stages = {}
    for f in files:
        for line in _lines(f):
            try:
                e = json.loads(line)
            except ValueError:
                continue
            if e.get("Event") == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                ms = si.get("Completion Time", 0) - si.get("Submission Time", 0)
                stages[si["Stage ID"]] = (ms, si["Number of Tasks"], si["Stage Name"][:70])
    print(f"{len(stages)} stages, {sum(v[0] for v in stages.values())} ms summed")
    for sid, (ms, n, name) in sorted(stages.items(), key=lambda kv: -kv[1][0])[:top]:
        print(f"stage {sid:5d} {ms:7d} ms {n:4d} tasks  {name}")


if __name__ == "__main__":
    main()
