"""Bench: run the pipeline and every registered query; print ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Timings:
  silver_materialize  raw trips landed -> bronze (dedup) -> silver, each written and read back
  gold_and_marts_materialize  facts, dims and the ten marts written from silver (the built tables
                      the tests, profile and questions read)
  warehouse_write     the same write once more, into a folder of its own
  files_build         monthly raw files landed, bronze and silver built from them
  incremental_build   all raw files refreshed into one store up to the marts, then one file replaced
  <query>             each registered query executed in full into a no-op sink, twice;
                      "queries" holds the faster (warm) run, "queries_first_run" the first
"value" is the sum of the warm runs over the registered queries (pipeline steps reported separately).
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from fareline.plans import registry, tpch_trips
    from fareline.plans.warehouse import write_warehouse
    from fareline.session import get_session, shared_dir
    from fareline.sources import fixture

    spark = get_session(
        f"local[{cpus}]",
        shuffle_partitions=max(8, 2 * cpus),
        **{"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")},
    )
    steps: dict[str, float] = {}

    t = time.perf_counter()
    silver = tpch_trips.silver(spark, sf_dir, materialize=True)
    steps["silver_materialize"] = time.perf_counter() - t

    t = time.perf_counter()
    tpch_trips.warehouse(spark, sf_dir, materialize="all")
    steps["gold_and_marts_materialize"] = time.perf_counter() - t

    out_dir = shared_dir(spark, f"bench-warehouse-{os.getpid()}-{int(time.time())}")
    wh = tpch_trips.warehouse(spark, sf_dir, materialize="silver")
    t = time.perf_counter()
    write_warehouse(
        spark, wh, out_dir, fixture.vendors(spark), fixture.payment_types(spark), fixture.zones(spark, sf_dir),
        airport=fixture.FIXTURE_AIRPORTS,
    )
    steps["warehouse_write"] = time.perf_counter() - t

    t = time.perf_counter()
    tpch_trips.file_build(spark, sf_dir)
    steps["files_build"] = time.perf_counter() - t

    t = time.perf_counter()
    tpch_trips.incremental_build(spark, sf_dir)
    steps["incremental_build"] = time.perf_counter() - t

    queries: dict[str, float] = {}
    first: dict[str, float] = {}
    for name, fn in registry.QUERIES.items():
        runs = []
        for _ in range(2):
            t = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t)
        first[name] = round(runs[0], 3)
        queries[name] = round(min(runs), 3)

    rows = silver.count()
    print(
        json.dumps(
            {
                "metric": "registered_queries_total",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "queries_first_run": first,
                "pipeline": {k: round(v, 3) for k, v in steps.items()},
                "silver_rows": rows,
                "sf": os.path.basename(sf_dir).replace("sf", ""),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
