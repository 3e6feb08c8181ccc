"""Benchmark: run every query of the reference's operators at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
{"metric": "total_query_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Every query is executed in full through the ``noop`` sink (nothing is
collected to the driver).  An untimed pass over the smallest scale first
warms the JVM (JIT and codegen), so the timings are steady-state.
Set BENCH_QUERIES to a comma list to time a subset.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from curato.catalog import QUERIES  # noqa: E402
from curato.plans.selection import select_and_reconcile  # noqa: E402
from curato.catalog import POLICY_A  # noqa: E402
from curato.session import build_session, ensure_checkpoint_dir, table_scope  # noqa: E402
from curato.sources.tables import images_view, picks_view, tags_view  # noqa: E402

def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def flagship_run(spark, sf: str) -> None:
    """The whole job once: score, pick, reconcile, and every output, with
    the scored relation staged so the outputs share it."""
    images = images_view(spark, sf)
    sel = select_and_reconcile(images, tags_view(spark, sf), picks_view(spark, sf, images),
                               POLICY_A, materialize=True)
    for df in (sel.snapshot, sel.cdc, sel.metrics, sel.updated_picks):
        run_noop(df)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    names = only or list(QUERIES)
    spark = (build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), app_name="curato-bench"))
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)

    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir) and os.environ.get("BENCH_WARM", "1") != "0":
        with table_scope(spark):
            for name in names:
                run_noop(QUERIES[name](spark, warm_dir))
            flagship_run(spark, warm_dir)

    timings: dict[str, float] = {}
    for name in names:
        with table_scope(spark):
            t0 = time.perf_counter()
            run_noop(QUERIES[name](spark, sf_dir))
            timings[name] = round(time.perf_counter() - t0, 3)
    with table_scope(spark):
        t0 = time.perf_counter()
        flagship_run(spark, sf_dir)
        timings["flagship_run"] = round(time.perf_counter() - t0, 3)

    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    print(json.dumps({"metric": "total_query_sec", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
