"""Stage timings of one registered query from Spark's event log.

    python tools/stage_profile.py <query> [sf_dir]

Runs the query twice (the second run is measured) with the event log
written to a fresh scratch folder, then prints each stage of the second
run: start offset, duration, task count.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def _events(log_dir: str):
    import zstandard
    out = []
    for fn in sorted(glob.glob(os.path.join(log_dir, "*", "events_*")) + glob.glob(os.path.join(log_dir, "app*"))):
        with open(fn, "rb") as fh:
            raw = fh.read()
        if fn.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(__import__("io").BytesIO(raw)).read()
        out += [json.loads(x) for x in raw.decode().splitlines() if x.strip()]
    return out


def main(argv):
    name = argv[1]
    sf_dir = argv[2] if len(argv) > 2 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    from ledgerlens.queries import queries
    from ledgerlens.session import build_session
    spark = build_session("local[8]", 8, extra={"spark.eventLog.enabled": "true",
                                                 "spark.eventLog.dir": log_dir})
    q = queries()[name]
    q(spark, sf_dir).write.format("noop").mode("overwrite").save()
    t0 = int(time.time() * 1000)
    t = time.time()
    q(spark, sf_dir).write.format("noop").mode("overwrite").save()
    print(f"total {time.time() - t:.2f}s")
    spark.stop()
    stages = [e["Stage Info"] for e in _events(log_dir) if e["Event"] == "SparkListenerStageCompleted"]
    for si in sorted(stages, key=lambda s: s["Submission Time"]):
        if si["Submission Time"] < t0:
            continue
        print(f"stage {si['Stage ID']:4d} +{si['Submission Time'] - t0:6d}ms {si['Completion Time'] - si['Submission Time']:6d}ms "
              f"tasks {si['Number of Tasks']:3d}")


if __name__ == "__main__":
    main(sys.argv)
