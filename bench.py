"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is planned and executed into Spark's ``noop`` sink (full
execution, no driver collect); the first run warms the JVM and the reported
time is the best of the warm runs.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from panelkit.registry.all import all_queries  # noqa: E402
from panelkit.session import get_session  # noqa: E402

HEADLINE = [
    "reference_month",
    "dictionary_code_normalize",
    "microdata_counts",
    "clean_counts",
    "panel_full",
    "panel_with_geo",
    "control_totals",
    "referential_check",
    "series_slice",
    "series_wide",
    "date_bounds",
    "mom_yoy_change",
    "series_summary",
    "revision_diff",
    "panel_update",
    "panel_write_read",
    "historical_panel",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "2"))
    keys = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", app="panelkit-bench", shuffle_partitions=int(cpus))
    qs = all_queries()
    times: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for k in keys:
        best = None
        try:
            for _ in range(reps):
                t0 = time.perf_counter()
                run(qs[k](spark, sf_dir))
                dt_ = time.perf_counter() - t0
                best = dt_ if best is None else min(best, dt_)
            times[k] = round(best, 3)
        except Exception as e:  # noqa: BLE001 - report and keep benchmarking
            times[k] = None
            errors[k] = str(e).splitlines()[0][:300]
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(t for t in times.values() if t is not None), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
