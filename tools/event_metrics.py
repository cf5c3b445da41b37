"""Shuffle and spill bytes per bench query from a Spark event log.
Usage: LODESTAR_EVENT_LOG_DIR=<dir> python bench.py; python tools/event_metrics.py <dir>"""

from __future__ import annotations

import collections
import glob
import json
import os
import sys


def _lines(files):
    for p in files:
        if p.endswith(".zstd"):
            import zstandard
            with open(p, "rb") as f:
                data = zstandard.ZstdDecompressor().stream_reader(f).read()
            yield from data.decode().splitlines()
        else:
            with open(p) as f:
                yield from f


def main() -> None:
    d = sys.argv[1]
    path = max(glob.glob(os.path.join(d, "*")), key=os.path.getmtime)
    # rolling logs (Spark 4) are a directory of event files
    files = sorted(glob.glob(os.path.join(path, "events_*")), key=lambda p: int(os.path.basename(p).split("_")[1])) \
        if os.path.isdir(path) else [path]
    stage_group: dict[int, str] = {}
    tot = collections.defaultdict(lambda: collections.Counter())
    for line in _lines(files):
        if True:
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                g = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in ev.get("Stage IDs", []):
                    stage_group[sid] = g or "-"
            elif kind == "SparkListenerTaskEnd":
                m = ev.get("Task Metrics") or {}
                g = stage_group.get(ev.get("Stage ID"), "-")
                sw = m.get("Shuffle Write Metrics") or {}
                tot[g]["shuffle_write_bytes"] += sw.get("Shuffle Bytes Written", 0)
                tot[g]["spill_memory_bytes"] += m.get("Memory Bytes Spilled", 0)
                tot[g]["spill_disk_bytes"] += m.get("Disk Bytes Spilled", 0)
                tot[g]["tasks"] += 1
    print("| query | tasks | shuffle written MB | spilled (disk) MB |")
    print("| --- | --- | --- | --- |")
    for g, c in sorted(tot.items(), key=lambda kv: -kv[1]["shuffle_write_bytes"]):
        print(f"| {g} | {c['tasks']} | {c['shuffle_write_bytes'] / 1e6:.1f} | {c['spill_disk_bytes'] / 1e6:.1f} |")


if __name__ == "__main__":
    main()
