"""Longest stages of a Spark application, from its event log.

    BENCH_EVENT_LOG_DIR=$(mktemp -d /tmp/run-XXXXXX) python bench.py
    python tools/stage_times.py <that folder>/<application log> [top_n]

Reads the JSON-lines event log (no UI, no server) and prints, per stage,
its duration, task count and the first line of its call site.
"""

from __future__ import annotations

import json
import os
import sys


def read_lines(fname: str):
    """Lines of one event-log file; ``.zstd`` files (Spark's default
    event-log codec) are decompressed on the fly."""
    if fname.endswith(".zstd"):
        import io
        import zstandard
        with open(fname, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(fname, encoding="utf-8") as f:
            yield from f


def event_files(path: str) -> list[str]:
    """A plain log file, or the files of a rolling log folder in order."""
    if not os.path.isdir(path):
        return [path]
    names = [n for n in os.listdir(path) if n.startswith("events_")]
    return [os.path.join(path, n) for n in sorted(names, key=lambda n: int(n.split("_")[1]))]


def main() -> None:
    path, top = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages = []
    for fname in event_files(path):
        for line in read_lines(fname):
            ev = json.loads(line)
            if ev.get("Event") == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                start, end = info.get("Submission Time"), info.get("Completion Time")
                if start and end:
                    stages.append((end - start, info["Stage ID"], info["Number of Tasks"],
                                   info.get("Stage Name", "").split("\n")[0][:90]))
    stages.sort(reverse=True)
    print(f"{'ms':>8} {'stage':>6} {'tasks':>6}  call site")
    for ms, sid, n, name in stages[:top]:
        print(f"{ms:>8} {sid:>6} {n:>6}  {name}")
    print(f"total stage time {sum(s[0] for s in stages)} ms over {len(stages)} stages")


if __name__ == "__main__":
    main()
