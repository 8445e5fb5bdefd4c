"""Stage times from a Spark event log written to a scratch folder.

    BENCH_EVENT_LOG_DIR=$(mktemp -d /tmp/run-XXXXXX) python bench.py
    python tools/stage_times.py <that folder> [top_n]

Reads the (rolling) event log files and prints the slowest stages with
their task count and duration: where a query's time goes, without the web
UI.
"""

from __future__ import annotations

import json
import os
import sys


def _lines(path: str):
    if path.endswith(".zstd"):
        import io

        import zstandard

        with open(path, "rb") as raw:
            text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
            yield from text
    else:
        with open(path, encoding="utf-8") as f:
            yield from f


def events(root: str):
    for dirpath, _, files in os.walk(root):
        for name in sorted(files):
            if name.startswith("appstatus"):
                continue
            for line in _lines(os.path.join(dirpath, name)):
                if '"SparkListenerStageCompleted"' in line:
                    yield json.loads(line)


def main() -> None:
    root = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    rows = []
    for e in events(root):
        info = e["Stage Info"]
        if "Submission Time" in info and "Completion Time" in info:
            rows.append((info["Completion Time"] - info["Submission Time"], info["Stage ID"],
                         info["Number of Tasks"], info["Stage Name"][:70]))
    rows.sort(reverse=True)
    print(f"{len(rows)} stages, {sum(r[0] for r in rows)} ms in total")
    for ms, sid, tasks, name in rows[:top]:
        print(f"{ms:7d} ms  stage {sid:5d}  tasks {tasks:5d}  {name}")


if __name__ == "__main__":
    main()
