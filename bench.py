"""Benchmark: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and print one JSON line.

Each query is forced to completion with the no-op sink (full computation, nothing collected to
the driver). The stored layers are built first and timed on their own: ``bars_build`` and ``bronze_build``
synthesise the raw inputs (archive CSV lines and live JSON messages) from the tick table and parse
them with the real source readers; ``silver_build``, ``dim_build`` and ``fact_build`` are the
layers the pipeline it re-expresses stores once and every gold table reads.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [a for a in sys.argv[1:] if not a.startswith("-")]
    from candela.session import get_spark
    from candela.plans import catalog

    spark = get_spark(f"local[{cpus}]", int(cpus) * 2, app_name="candela-bench")
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    # JVM / code-generation / parquet-writer warm-up on a trivial job, not timed.
    from candela.session import scratch_path
    warm = spark.range(0, 100_000, 1, int(cpus)).selectExpr("id", "cast(id as decimal(18,8)) AS d",
                                                              "timestamp_seconds(id) AS t")
    warm.write.parquet(scratch_path(spark, "warmup"))
    warm.selectExpr("sum(d)", "count(distinct id % 7)").collect()

    def run(name, build):
        t0 = time.time()
        df = build()
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)

    for name, layer in (("bars_build", catalog.bars_frame), ("bronze_build", catalog.bronze_frame),
                        ("silver_build", catalog.staged_frame), ("dim_build", catalog.dim_frame),
                        ("fact_build", catalog.fact_frame)):
        t0 = time.time()
        layer(spark, sf_dir)
        times[name] = round(time.time() - t0, 3)
    qs = catalog.queries()
    for name, fn in qs.items():
        if only and name not in only:
            continue
        run(name, lambda fn=fn: fn(spark, sf_dir))
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
