"""Job and stage durations from a Spark event log (no UI needed).

Run a session with ``spark.eventLog.enabled=true`` and
``spark.eventLog.dir=file:///<scratch>``, then:

    python tools/stage_times.py <scratch>

Prints, per job: the driver-side gap before it, its duration, and each
stage's name, task count and duration.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path):
    raw = open(path, "rb").read()
    try:
        import zstandard
        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
    except Exception:  # noqa: BLE001  (uncompressed log)
        pass
    return raw.decode(errors="ignore").splitlines()


def main(folder: str) -> None:
    files = sorted(glob.glob(os.path.join(folder, "*", "*")) + glob.glob(os.path.join(folder, "*")))
    stages, jobs = {}, {}
    for f in files:
        if os.path.isdir(f):
            continue
        for line in _lines(f):
            try:
                e = json.loads(line)
            except ValueError:
                continue
            ev = e.get("Event")
            if ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = (si["Stage Name"][:40], si["Number of Tasks"],
                                          (si["Completion Time"] - si["Submission Time"]) / 1000)
            elif ev == "SparkListenerJobStart":
                jobs[e["Job ID"]] = [e["Submission Time"], e["Stage IDs"], None]
            elif ev == "SparkListenerJobEnd" and e["Job ID"] in jobs:
                jobs[e["Job ID"]][2] = e["Completion Time"]
    prev = None
    for j, (start, ids, end) in sorted(jobs.items()):
        gap = None if prev is None else round((start - prev) / 1000, 2)
        dur = None if end is None else round((end - start) / 1000, 2)
        print(f"job {j} gap {gap} dur {dur}", [stages[i] for i in ids if i in stages])
        prev = end or start


if __name__ == "__main__":
    main(sys.argv[1])
