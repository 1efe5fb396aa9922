"""Scaling run on synthetic listings (S5): N rows rendered to text, then the
listing reports and a running report with real hot keys over those lines.

Usage: SCALE_ROWS=10000000 BENCH_CPUS=8 python scale_bench.py
Prints one JSON line.  The lines are written once per N under the shared
folder (spark.checkpoint.dir) and reused.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    n = int(os.environ.get("SCALE_ROWS", "10000000"))
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    from pyspark.sql import functions as F

    from keyfold import fs
    from keyfold.operators.parse import parse_listings
    from keyfold.plans import run_report
    from keyfold.plans.running import running_report
    from keyfold.session import local_session, shared_path
    from keyfold.sources.fixtures import header_for, write_with_headers
    from keyfold.sources.synth import synth_listings_range, to_listing_lines

    spark = local_session(cpus, partitions=int(cpus) * 4 if cpus.isdigit() else None,
                          app="keyfold-scale")
    path = shared_path(spark, "scale", f"synth-{n}")
    t0 = time.time()
    if not fs.exists(spark, path + "/_SUCCESS"):
        lines = to_listing_lines(synth_listings_range(spark, n, seed=42))
        write_with_headers(spark, lines, header_for("listing"), path, n_files=max(8, n // 1_000_000))
    render = time.time() - t0
    lines = spark.read.text(path)
    lines.selectExpr("sum(length(value))").collect()  # warm-up: JIT and file cache
    times = {}
    tables = os.environ.get("SCALE_REPORTS", "district_stats,neighborhood_avg_price,"
                            "year_avg_elevator_ratio,orientation_focus_count,word_count")
    for table in [t for t in tables.split(",") if t]:
        t = time.time()
        run_report(table, lines).write.format("noop").mode("overwrite").save()
        times[table] = round(time.time() - t, 3)
    # Running district count: the largest district holds 30% of the rows.
    t = time.time()
    rows = parse_listings(lines).select(F.col("id").cast("bigint").alias("id"), "district")
    running_report("district_stats", rows, "id").write.format("noop").mode("overwrite").save()
    times["running_district_stats"] = round(time.time() - t, 3)
    print(json.dumps({"metric": "synthetic_listing_report_seconds", "rows": n, "cpus": cpus,
                      "render_sec": round(render, 3), "queries": times,
                      "rows_per_sec_j1": round(n / times["district_stats"])
                      if "district_stats" in times else None,
                      "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
