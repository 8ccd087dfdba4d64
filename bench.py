"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
Each query runs to completion into Spark's no-op sink (full plan, no
collect).  ``etl_wide`` builds the integrated sales table and writes it as
Parquet partitioned by (anio, mes); the KPIs then read that table, as the
KPI step of the batch job reads the integration output.  ``stream_batch`` stages the
sale-event messages and runs the micro-batch job over them.  A warm-up pass
of the same jobs over the smaller sf0.01 data runs first (set BENCH_WARMUP=0
to skip), so the numbers are steady-state rather than JVM start-up and JIT.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shopflow.operators import documents, quality  # noqa: E402
from shopflow.plans import jobs  # noqa: E402
from shopflow.plans.context import Retail  # noqa: E402
from shopflow.plans.queries import REGISTRY  # noqa: E402
from shopflow.session import build_session, work_path  # noqa: E402
from shopflow.sinks import files as sinks  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = build_session(f"local[{cpus}]", app="shopflow-bench", shuffle_partitions=cpus * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "6g")})
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)

    # Warm-up: the same jobs once on the smallest data set, so the timings
    # below are steady-state (JIT, codegen and class loading are paid here).
    smaller = [f"sf{x}" for x in ("0.01", "0.001") if sf is None or float(x) < sf]
    warm = os.environ.get("BENCH_WARMUP_DIR",
                          os.path.join(os.path.dirname(sf_dir), smaller[0]) if smaller else "")
    if warm and os.path.isdir(warm) and os.environ.get("BENCH_WARMUP", "1") == "1":
        wr, wroot = Retail(spark, warm), work_path(spark, "bench-warmup")
        jobs.write_wide(wr, f"{wroot}/w")
        for df in jobs.kpi_tables(spark, f"{wroot}/w", wr.inventory).values():
            run(df)
        run(documents.monthly_report(spark.read.parquet(f"{wroot}/w")))
        jobs.run_stream(spark, warm, f"{wroot}/s", f"{wroot}/ck", run_id="warm")

    r = Retail(spark, sf_dir)
    root = work_path(spark, "bench")
    wide_path = f"{root}/ventas_enriquecidas"
    timed("etl_wide", lambda: jobs.write_wide(r, wide_path))
    timed("inventory", lambda: sinks.write_parquet(r.inventory, f"{root}/inventario"))
    inventory = spark.read.parquet(f"{root}/inventario")
    for name, df in jobs.kpi_tables(spark, wide_path, inventory).items():
        timed(f"kpi_{name}", lambda df=df: run(df))
    wide = spark.read.parquet(wide_path)
    downstream = {
        "monthly_report_docs": documents.monthly_report(wide),
        "product_profile_docs": documents.product_profile(r.games, wide, r.scores),
        "null_profile": quality.null_profile(wide),
        "sales_docs": documents.sales_documents(wide),
    }
    for name, df in downstream.items():
        timed(name, lambda df=df: run(df))
    timed("log_activity", lambda: run(REGISTRY["log_activity"](spark, sf_dir)))
    timed("stream_batch", lambda: jobs.run_stream(spark, sf_dir, f"{root}/stream",
                                                  f"{root}/stream-ckpt", run_id="bench"))

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
