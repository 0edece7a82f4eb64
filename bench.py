"""Benchmark: the six incident reports on the test data at ``$BENCH_SF_DIR``.

The SIS tables are derived from the test data once and stored as Parquet (timed separately
as ``fixtures_sec``); each report then runs from the stored tables the way a deployment reads
its SIS tables, and is executed completely into Spark's ``noop`` sink (no driver collect).
Every report runs once to warm up and is then timed ``BENCH_REPEAT`` times (best kept).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from incidentlens.plans import catalog  # noqa: E402
from incidentlens.session import build_session, checkpoint_dir  # noqa: E402
from incidentlens.sources.fixtures import materialize  # noqa: E402

REPORTS = ["report_selection", "report_school", "report_district",
           "report_selection_detailed", "report_school_detailed", "report_district_detailed"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    scratch = tempfile.mkdtemp(prefix="incidentlens-bench-")
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", 2 * cpus))
    spark = build_session(master=f"local[{cpus}]", app="incidentlens-bench", shuffle_partitions=partitions,
                          extra={"spark.ui.showConsoleProgress": "false",
                                 "spark.eventLog.enabled": "false",
                                 "spark.local.dir": scratch})
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", f"{scratch}/checkpoints")
    root = checkpoint_dir(spark)

    t0 = time.perf_counter()
    materialize(spark, sf_dir, f"{root.rstrip('/')}/fixtures")
    fixtures_sec = time.perf_counter() - t0

    def run(name: str) -> float:
        start = time.perf_counter()
        df = catalog.QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in REPORTS:
        run(name)
    timings = {name: round(min(run(name) for _ in range(repeat)), 3) for name in REPORTS}
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "six_reports_total", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": sf, "cpus": cpus, "fixtures_sec": round(fixtures_sec, 3)}))
    spark.stop()


if __name__ == "__main__":
    main()
