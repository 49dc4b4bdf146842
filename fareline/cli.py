"""Command line: the pipeline steps as spark-submit-able subcommands.

    python -m fareline.cli bronze    --raw-dir RAW --out BRONZE
    python -m fareline.cli silver    --bronze BRONZE --out SILVER
    python -m fareline.cli warehouse --silver SILVER --zones ZONES.csv --out WAREHOUSE [--check]
    python -m fareline.cli check     --warehouse WAREHOUSE --silver SILVER
    python -m fareline.cli profile   --warehouse WAREHOUSE
    python -m fareline.cli ask       --warehouse WAREHOUSE --question window_kpis [--days 30] [--today D]
    python -m fareline.cli stream    --raw-dir RAW --bronze BRONZE --silver SILVER --checkpoint CKPT

Each prints a JSON summary (counters, or all rows of a result) on stdout; ``ask --out DIR``
writes the rows as JSON lines instead. A folder without a written warehouse raises.
Vendor and payment seeds default to the built-in values; pass CSVs to override.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession

from fareline.plans.warehouse import TABLE_LAYERS, read_warehouse

QUESTIONS = (
    "window_kpis", "kpi_daily_series", "kpi_alerts", "payment_mix", "payment_mix_daily_share",
    "mix_sensitivity", "mix_impact", "vendor_cards", "vendor_gap", "airport_vs_city",
    "top_zones", "borough_dow_skew", "top_corridors", "zone_hotspots",
)


def _seeds(spark: SparkSession, args):
    from fareline.sources import seeds

    vendors = seeds.read_vendors_csv(spark, args.vendors) if args.vendors else seeds.vendors_seed(spark)
    payments = seeds.read_payment_types_csv(spark, args.payments) if args.payments else seeds.payment_types_seed(spark)
    zones = seeds.read_zones_csv(spark, args.zones)
    return vendors, payments, zones


def _rows(df: DataFrame) -> list[dict]:
    """All rows of a result, fetched partition by partition."""
    return [r.asDict(recursive=True) for r in df.toLocalIterator()]


def _answer(df: DataFrame, out: str | None) -> dict:
    """The whole result: written as JSON lines to ``out``, or returned."""
    if not out:
        return {"rows": _rows(df)}
    df.write.mode("overwrite").json(out)
    return {"out": out, "rows_written": df.sparkSession.read.schema(df.schema).json(out).count()}


def run(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    p = argparse.ArgumentParser(prog="fareline")
    sub = p.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("bronze")
    b.add_argument("--raw-dir", required=True)
    b.add_argument("--out", required=True)
    s = sub.add_parser("silver")
    s.add_argument("--bronze", required=True)
    s.add_argument("--out", required=True)
    for name in ("warehouse", "check"):
        w = sub.add_parser(name)
        w.add_argument("--silver", required=True)
        w.add_argument("--zones", required=name == "warehouse")
        w.add_argument("--vendors")
        w.add_argument("--payments")
        if name == "warehouse":
            w.add_argument("--out", required=True)
            w.add_argument("--check", action="store_true")
        else:
            w.add_argument("--warehouse", required=True)
    pr = sub.add_parser("profile")
    pr.add_argument("--warehouse", required=True)
    a = sub.add_parser("ask")
    a.add_argument("--warehouse", required=True)
    a.add_argument("--question", required=True, choices=QUESTIONS)
    a.add_argument("--days", type=int, default=30)
    a.add_argument("--today")
    a.add_argument("--min-trips", type=int)
    a.add_argument("--out", help="folder for the whole result as JSON lines")
    st = sub.add_parser("stream")
    st.add_argument("--raw-dir", required=True)
    st.add_argument("--bronze", required=True)
    st.add_argument("--silver", required=True)
    st.add_argument("--checkpoint", required=True)
    args = p.parse_args(argv)

    if spark is None:
        from fareline.session import get_session

        spark = get_session(master=None)

    if args.cmd == "bronze":
        from fareline.plans.bronze import run_bronze

        return run_bronze(spark, args.raw_dir, args.out)
    if args.cmd == "silver":
        from fareline.plans.silver import read_bronze, run_silver

        return run_silver(read_bronze(spark, args.bronze), args.out)
    if args.cmd in ("warehouse", "check"):
        from fareline.operators.checks import DEFAULT_SUITE, run_checks
        from fareline.plans.silver import SPLIT_COLUMN, read_silver
        from fareline.plans.warehouse import build_warehouse, write_warehouse

        silver = read_silver(spark, args.silver)
        if args.cmd == "warehouse":
            vendors, payments, zones = _seeds(spark, args)
            lazy = build_warehouse(silver, vendors, payments, zones)
            built = write_warehouse(spark, lazy, args.out, vendors, payments, zones)
            out = {"tables": sorted(built.tables)}
            if not args.check:
                return out
        else:
            built = read_warehouse(spark, args.warehouse)
            out = {}
        from fareline.operators.star import stg_trips
        from fareline.operators.quality import split

        stg = stg_trips(split(silver, "trips_clean", SPLIT_COLUMN).drop(SPLIT_COLUMN))
        res = run_checks(built.tables | {"stg_trips": stg}, DEFAULT_SUITE)
        out["checks"] = _rows(res)  # one row per check
        out["failed"] = res.where("not passed").count()
        return out
    if args.cmd == "profile":
        from fareline.operators.catalog import profile_tables, relationship_report

        built = read_warehouse(spark, args.warehouse)
        layers = {n: TABLE_LAYERS[n] for n in built.tables}
        return {
            "tables": _rows(profile_tables(built.tables, layers)),
            "relationships": _rows(relationship_report(built.tables, layers)),
        }
    if args.cmd == "ask":
        from fareline.operators import insights as B

        wh = read_warehouse(spark, args.warehouse)
        w = B.reporting_window(wh["mart_kpi_daily"], args.days, today=args.today)
        q = args.question
        mix = B.payment_mix(wh["mart_payment_mix_daily"], wh["dim_payment"], w)
        calls = {
            "window_kpis": lambda: B.window_kpis(wh["mart_kpi_daily"], w),
            "kpi_daily_series": lambda: B.kpi_daily_series(wh["mart_kpi_daily"], w),
            "kpi_alerts": lambda: B.kpi_alerts(B.window_kpis(wh["mart_kpi_daily"], w)),
            "payment_mix": lambda: mix,
            "payment_mix_daily_share": lambda: B.payment_mix_daily_share(wh["mart_payment_mix_daily"], wh["dim_payment"], w),
            "mix_sensitivity": lambda: B.mix_sensitivity(mix, wh["mart_kpi_daily"], w),
            "mix_impact": lambda: B.mix_impact(mix, wh["mart_kpi_daily"], w),
            "vendor_cards": lambda: B.vendor_cards(wh["fact_trips"], wh["dim_vendor"], w),
            "vendor_gap": lambda: B.vendor_gap(wh["fact_trips"], wh["dim_vendor"], w),
            "airport_vs_city": lambda: B.airport_vs_city(wh["mart_kpi_daily"], wh["mart_airport_daily"], w),
            "top_zones": lambda: B.top_zones(wh["mart_revenue_daily_zone"], wh["dim_zone"], w),
            "borough_dow_skew": lambda: B.borough_dow_skew(wh["mart_revenue_daily_zone"], wh["dim_zone"], wh["dim_date"], w),
            "top_corridors": lambda: B.top_corridors(wh["mart_od_matrix_monthly"], wh["mart_revenue_daily_zone"], wh["dim_zone"], w),
            "zone_hotspots": lambda: B.zone_hotspots(
                wh["mart_anomaly_summary_daily"], wh["mart_revenue_daily_zone"], wh["dim_zone"], w, min_trips=args.min_trips
            ),
        }
        return {"question": q} | _answer(calls[q](), args.out)
    if args.cmd == "stream":
        from fareline.streaming.landing import start_landing_stream

        query = start_landing_stream(spark, args.raw_dir, args.bronze, args.silver, args.checkpoint)
        query.awaitTermination()
        return {"stream": "done"}
    raise SystemExit(f"unknown command {args.cmd}")


def main(argv: list[str] | None = None) -> None:
    print(json.dumps(run(argv), default=str))


if __name__ == "__main__":
    main(sys.argv[1:])
