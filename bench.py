"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (sum of query seconds), "unit",
"queries": {name: seconds}, "sf"}. Each query runs once to warm up and is
then timed; a query is forced with the no-op sink (full computation, nothing
collected). `ingest_batch` is the whole batch job on all raw lines: parse,
quarantine, flag, dims, fact, written to a fresh lake folder.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from weblake.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "unified_events", "anomaly_flagging", "behavioral_windowed", "geo_enrich",
    "multiline_stitch", "replacing_dedupe",
    "kpi_summary", "requests_by_class_per_minute", "requests_by_country",
    "error_rate_by_country", "top_pages", "top_ips_by_traffic", "top_ips_by_errors",
    "error_heatmap", "anomaly_timeline", "anomaly_summary", "top_error_messages",
    "recent_errors", "hourly_actuals", "forecast_additive", "scaling_advice",
]


def _force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(f"local[{CPUS}]", shuffle_partitions=int(CPUS),
                          extra={"spark.local.dir": tempfile.mkdtemp(prefix="bench-local-")})
    from weblake import queries as Q
    from weblake.plans.ingest import ensure_lake

    qs = Q.registered()
    inputs = [f"{SF_DIR}/{t}.parquet" for t in ("events", "nation")]

    def ingest():
        base = tempfile.mkdtemp(prefix="bench-lake-")
        ensure_lake(spark, Q.lines(spark, SF_DIR), inputs, Q.ranges(spark, SF_DIR),
                    Q.STAR_CONFIG, base=base)

    times: dict[str, float] = {}
    for timed in (False, True):
        t = time.perf_counter()
        ingest()
        if timed:
            times["ingest_batch"] = time.perf_counter() - t
        for name in HEADLINE:
            t = time.perf_counter()
            _force(qs[name](spark, SF_DIR))
            if timed:
                times[name] = time.perf_counter() - t
    sf = re.search(r"sf([0-9.]+)", SF_DIR)
    print(json.dumps({
        "metric": "sum_of_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": float(sf.group(1)) if sf else SF_DIR,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
