"""Executive questions over the marts (current vs previous reporting windows).

The reporting window is four dates derived from the KPI mart. By default they
are resolved once (one tiny job returning one row) and used as literals, so
every date predicate is pushed into the Parquet scan (row-group skipping) and
prunes month partitions of written facts at planning time. With
``eager=False`` they stay scalar subqueries (``DataFrame.scalar()``) inside a
single lazy plan (runtime partition pruning only). Either way there is no
join with the window row. Totals for shares are scalar subqueries or window
sums over already-aggregated rows (a handful per group).

pandas' ``groupby`` drops NULL keys; where the reference groups in pandas
the operators filter NULL keys explicitly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareline.config import DEFAULT_DASHBOARD, DashboardRules
from fareline.functions.expressions import clamp, safe_ratio

CURRENT, PREVIOUS = "current", "previous"


@dataclass
class ReportWindow:
    """One-row frame: today, current_start, previous_start, previous_end, window_days.

    ``values`` holds the resolved dates when the window was built eagerly.
    """

    bounds: DataFrame
    window_days: int
    values: dict | None = None

    def col(self, name: str) -> Column:
        if self.values is not None:
            v = self.values.get(name)
            return F.lit(v) if v is not None else F.lit(None).cast("date")
        return self.bounds.select(name).scalar()

    @property
    def today(self) -> Column:
        return self.col("today")

    @property
    def current_start(self) -> Column:
        return self.col("current_start")

    @property
    def previous_start(self) -> Column:
        return self.col("previous_start")

    @property
    def previous_end(self) -> Column:
        return self.col("previous_end")

    def current(self, c: str | Column = "date_day") -> Column:
        x = F.col(c) if isinstance(c, str) else c
        return x.between(self.current_start, self.today)

    def previous(self, c: str | Column = "date_day") -> Column:
        x = F.col(c) if isinstance(c, str) else c
        return x.between(self.previous_start, self.previous_end)

    def both(self, c: str | Column = "date_day") -> Column:
        x = F.col(c) if isinstance(c, str) else c
        return x.between(self.previous_start, self.today)

    def period(self, c: str | Column = "date_day") -> Column:
        return F.when(self.current(c), F.lit(CURRENT)).when(self.previous(c), F.lit(PREVIOUS))


def reporting_window(
    kpi_daily: DataFrame,
    window_days: int = 30,
    today: str | None = None,
    min_date: str | None = DEFAULT_DASHBOARD.min_date,
    eager: bool = True,
) -> ReportWindow:
    """B1: today (default: last day with data) clamped to [min_date, last day]; n-day windows.

    current = [today - (n-1), today]; previous = the n days before it.
    ``min_date`` defaults to the first day with data.
    """
    b = kpi_daily.agg(F.min("date_day").alias("_lo"), F.max("date_day").alias("_hi"))
    t = F.lit(today).cast("date") if today else F.col("_hi")
    lo = F.lit(min_date).cast("date") if min_date else F.col("_lo")
    b = b.select(clamp(t, lo, F.col("_hi")).alias("today"))
    b = b.select(
        "today",
        F.date_sub("today", window_days - 1).alias("current_start"),
        F.lit(window_days).alias("window_days"),
    ).select(
        "today",
        "current_start",
        F.date_sub("current_start", window_days).alias("previous_start"),
        F.date_sub("current_start", 1).alias("previous_end"),
        "window_days",
    )
    if not eager:
        return ReportWindow(b, window_days)
    row = b.first()  # one row of four dates
    values = {k: row[k] for k in ("today", "current_start", "previous_start", "previous_end")} if row else {}
    return ReportWindow(b, window_days, values)


def _rel_delta(cur: Column, prev: Column) -> Column:
    return F.when(prev != 0, (cur - prev) / prev).otherwise(F.lit(0.0))


def window_kpis(kpi_daily: DataFrame, w: ReportWindow, weighted: bool = False) -> DataFrame:
    """B2: trips, revenue, avg ticket and tip rate, current vs previous, with deltas.

    The tip rate is the unweighted mean of the daily rates (as in the original);
    ``weighted=True`` uses window tips / window revenue instead.
    """
    rows = kpi_daily.where(w.both()).select(
        w.period().alias("period"),
        F.coalesce(F.col("trips"), F.lit(0)).alias("trips"),
        F.coalesce(F.col("gross_revenue"), F.lit(0.0)).alias("revenue"),
        "tip_rate",
        "tips",
    )

    def cond(p: str) -> Column:
        return F.col("period") == p

    agg = rows.agg(
        *[
            x
            for p in (CURRENT, PREVIOUS)
            for x in (
                F.count(F.when(cond(p), 1)).alias(f"days_{p}"),
                F.coalesce(F.sum(F.when(cond(p), F.col("trips"))), F.lit(0)).cast("long").alias(f"trips_{p}"),
                F.coalesce(F.sum(F.when(cond(p), F.col("revenue"))), F.lit(0.0)).alias(f"revenue_{p}"),
                (
                    F.coalesce(safe_ratio(F.sum(F.when(cond(p), F.col("tips"))), F.sum(F.when(cond(p), F.col("revenue")))), F.lit(0.0))
                    if weighted
                    # NULL daily rates are filled with the window mean, i.e. ignored
                    else F.coalesce(F.avg(F.when(cond(p), F.col("tip_rate"))), F.lit(0.0))
                ).alias(f"tip_rate_{p}"),
            )
        ]
    )
    bounds = agg.select(
        F.lit(w.window_days).alias("window_days"),
        w.today.alias("today"),
        w.current_start.alias("current_start"),
        w.previous_start.alias("previous_start"),
        w.previous_end.alias("previous_end"),
        "*",
    )
    return with_deltas(bounds)


def with_deltas(windows: DataFrame) -> DataFrame:
    """Average tickets and deltas of windows whose bounds, days, trips, revenue and tip rates are known."""
    for p in (CURRENT, PREVIOUS):
        windows = windows.withColumn(
            f"avg_ticket_{p}",
            F.when(F.col(f"trips_{p}") != 0, F.col(f"revenue_{p}") / F.col(f"trips_{p}")).otherwise(F.lit(0.0)),
        )
    return windows.select(
        "window_days",
        "today",
        "current_start",
        "previous_start",
        "previous_end",
        "days_current",
        "days_previous",
        "trips_current",
        "trips_previous",
        "revenue_current",
        "revenue_previous",
        "avg_ticket_current",
        "avg_ticket_previous",
        "tip_rate_current",
        "tip_rate_previous",
        _rel_delta(F.col("trips_current"), F.col("trips_previous")).alias("trips_delta"),
        _rel_delta(F.col("revenue_current"), F.col("revenue_previous")).alias("revenue_delta"),
        _rel_delta(F.col("avg_ticket_current"), F.col("avg_ticket_previous")).alias("avg_ticket_delta"),
        F.when(F.col("days_previous") > 0, F.col("tip_rate_current") - F.col("tip_rate_previous"))
        .otherwise(F.lit(0.0))
        .alias("tip_rate_delta"),
    )


# sums of the cumulative table; doubles are added as decimals, so that differences are exact
EXACT = "decimal(38,12)"


def kpi_prefix(kpi_daily: DataFrame) -> DataFrame:
    """Cumulative KPIs of every calendar day from the first day with data to the last.

    Days are added up within their month and months among each other, so no task adds
    up more than a month's days or the months.
    """
    day = kpi_daily.select(
        "date_day",
        F.lit(1).cast("long").alias("days"),
        F.coalesce("trips", F.lit(0)).cast("long").alias("trips"),
        F.coalesce("gross_revenue", F.lit(0.0)).cast(EXACT).alias("revenue"),
        F.coalesce("tip_rate", F.lit(0.0)).cast(EXACT).alias("rates"),
        F.col("tip_rate").isNotNull().cast("long").alias("rated"),
    )
    sums = ("days", "trips", "revenue", "rates", "rated")
    span = kpi_daily.agg(F.min("date_day").alias("lo"), F.max("date_day").alias("hi"))
    days = span.where("lo is not null").select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date_day"))
    month = F.trunc("date_day", "MM")
    filled = days.join(day, "date_day", "left").withColumn("month", month).fillna(0, ["days", "trips", "rated"])
    filled = filled.withColumns({c: F.coalesce(c, F.lit(0).cast(EXACT)) for c in ("revenue", "rates")})
    upto = Window.partitionBy("month").orderBy("date_day")
    months = filled.groupBy("month").agg(*[F.sum(c).cast(EXACT if c in ("revenue", "rates") else "long").alias(f"m_{c}") for c in sums])
    before = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    months = months.select("month", *[F.coalesce(F.sum(f"m_{c}").over(before), F.lit(0)).alias(f"m_{c}") for c in sums])
    return filled.join(months, "month").select("date_day", *[(F.sum(c).over(upto) + F.col(f"m_{c}")).alias(c) for c in sums])


def window_kpis_of_days(kpi_daily: DataFrame, window_days=(7, 30, 90), prefix: DataFrame | None = None) -> DataFrame:
    """B1, B2, B2a for every day as today and every window length, from differences of cumulative sums.

    One pass over the daily mart serves all windows: a window's value is the cumulative
    value at its last day less the one before its first day (0 before the first day with
    data). ``prefix`` may pass a written ``kpi_prefix`` table.
    """
    c = kpi_prefix(kpi_daily) if prefix is None else prefix
    sums = [x for x in c.columns if x != "date_day"]
    asked = c.select(F.col("date_day").alias("today"), F.explode(F.array(*[F.lit(n) for n in window_days])).alias("window_days"))
    # a row per (today, n) and bound; the bounds meet the cumulative table once
    at = {"t0": F.col("today"), "t1": F.expr("date_sub(today, window_days)"), "t2": F.expr("date_sub(today, 2 * window_days)")}
    bounds = asked.select("today", "window_days", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), d.alias("date_day")) for k, d in at.items()])).alias("b"))
    met = bounds.select("today", "window_days", "b.k", "b.date_day").join(c, "date_day")
    # the value at each bound; a bound before the first day has no row and counts as 0
    value = {f"{x}_{k}": F.coalesce(F.max(F.when(F.col("k") == k, F.col(x))), F.lit(0)) for x in sums for k in at}
    rows = met.groupBy("today", "window_days").agg(*[v.alias(k) for k, v in value.items()])

    def part(x: str, p: str) -> Column:
        return F.col(f"{x}_t0") - F.col(f"{x}_t1") if p == CURRENT else F.col(f"{x}_t1") - F.col(f"{x}_t2")

    out = rows.select(
        "window_days", "today",
        F.expr("date_sub(today, window_days - 1)").alias("current_start"),
        F.expr("date_sub(today, 2 * window_days - 1)").alias("previous_start"),
        F.expr("date_sub(today, window_days)").alias("previous_end"),
        *[part("days", p).alias(f"days_{p}") for p in (CURRENT, PREVIOUS)],
        *[part("trips", p).alias(f"trips_{p}") for p in (CURRENT, PREVIOUS)],
        *[part("revenue", p).cast("double").alias(f"revenue_{p}") for p in (CURRENT, PREVIOUS)],
        *[F.coalesce(safe_ratio(part("rates", p).cast("double"), part("rated", p)), F.lit(0.0)).alias(f"tip_rate_{p}") for p in (CURRENT, PREVIOUS)],
    )
    return with_deltas(out)


def kpi_daily_series(kpi_daily: DataFrame, w: ReportWindow) -> DataFrame:
    """Daily trips and revenue of both windows and their shared axis maxima."""
    rows = kpi_daily.where(w.both()).select(
        "date_day",
        w.period().alias("period"),
        F.coalesce(F.col("trips"), F.lit(0)).alias("trips"),
        F.coalesce(F.col("gross_revenue"), F.lit(0.0)).alias("gross_revenue"),
    )
    top = rows.agg(F.max("trips").alias("t"), F.max("gross_revenue").alias("r"))
    return rows.withColumns(
        {"trips_axis_max": top.select("t").scalar(), "revenue_axis_max": top.select("r").scalar()}
    )


def kpi_alerts(kpis: DataFrame, rules: DashboardRules = DEFAULT_DASHBOARD) -> DataFrame:
    """Alert flags from the B2 row (none for the long window)."""
    on = F.col("window_days") != rules.no_alert_window_days
    return kpis.select(
        "window_days",
        on.alias("alerts_enabled"),
        (on & (F.col("trips_delta") < rules.trips_alert)).alias("trips_alert"),
        (on & (F.col("revenue_delta") < rules.revenue_alert)).alias("revenue_alert"),
        (on & (F.col("tip_rate_delta") < rules.tip_alert)).alias("tip_rate_alert"),
        "trips_delta",
        "revenue_delta",
        "tip_rate_delta",
    )


def payment_mix(mix_daily: DataFrame, dim_payment: DataFrame, w: ReportWindow, weighted: bool = False) -> DataFrame:
    """Per period and payment label: trips, mean ticket, share of trips.

    The ticket is the unweighted mean of the daily average tickets (as in the
    original); ``weighted=True`` uses window revenue / window trips instead.
    """
    rows = (
        mix_daily.where(w.both())
        .join(dim_payment, "payment_type", "left")
        .where(F.col("payment_desc").isNotNull())
        .select(w.period().alias("period"), "payment_desc", "trips", "avg_ticket", "revenue")
    )
    ticket = safe_ratio(F.sum("revenue"), F.sum("trips")) if weighted else F.avg("avg_ticket")
    g = rows.groupBy("period", "payment_desc").agg(
        F.sum("trips").cast("long").alias("trips"), ticket.alias("avg_ticket")
    )
    total = F.sum("trips").over(Window.partitionBy("period"))
    return g.withColumn("share", F.when(total != 0, F.col("trips") / total).otherwise(F.lit(0.0)))


def payment_mix_daily_share(mix_daily: DataFrame, dim_payment: DataFrame, w: ReportWindow) -> DataFrame:
    """Mean share per day and payment label, current window."""
    return (
        mix_daily.where(w.current())
        .join(dim_payment, "payment_type", "left")
        .where(F.col("payment_desc").isNotNull())
        .groupBy("date_day", "payment_desc")
        .agg(F.avg("share").alias("share"))
    )


def _window_trips(kpi_daily: DataFrame, w: ReportWindow) -> Column:
    return kpi_daily.where(w.current()).agg(F.coalesce(F.sum("trips"), F.lit(0)).cast("long")).scalar()


def _aligned_mix(mix: DataFrame) -> DataFrame:
    """Current and previous shares per label over the union of labels, missing -> 0."""
    cur = mix.where(F.col("period") == CURRENT).select(
        "payment_desc", F.col("share").alias("s1"), F.col("avg_ticket").alias("p1"), F.lit(True).alias("in_cur")
    )
    prev = mix.where(F.col("period") == PREVIOUS).select("payment_desc", F.col("share").alias("s0"))
    return cur.join(prev, "payment_desc", "full").select(
        "payment_desc",
        F.coalesce("s1", F.lit(0.0)).alias("s1"),
        F.coalesce("p1", F.lit(0.0)).alias("p1"),
        F.coalesce("s0", F.lit(0.0)).alias("s0"),
        F.coalesce("in_cur", F.lit(False)).alias("in_cur"),
        F.col("s0").isNotNull().alias("in_prev"),
    )


def _label_array(labels: DataFrame) -> DataFrame:
    """One row holding the aligned labels as an array sorted by label.

    The label set is bounded by the payment-type seed (a handful of rows), so
    gathering it into one array is safe; the mix arithmetic then runs as array
    expressions in a single projection (no chain of scalar subqueries).
    """
    fields = ["payment_desc", "s1", "p1", "s0", "in_cur", "in_prev"]
    return labels.agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("L"))


def _card_label(arr: Column, rules: DashboardRules) -> Column:
    """First current label containing the card token, else the current label with the largest share."""
    cur = F.filter(arr, lambda x: x["in_cur"])
    by_token = F.get(F.filter(cur, lambda x: F.lower(x["payment_desc"]).contains(rules.card_token)), 0)["payment_desc"]
    top = F.array_max(F.transform(cur, lambda x: x["s1"]))
    by_share = F.get(F.filter(cur, lambda x: x["s1"] == top), 0)["payment_desc"]
    return F.coalesce(by_token, by_share)


def _dot(arr: Column, a: str, b: str) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x[a] * x[b])


def mix_sensitivity(
    mix: DataFrame, kpi_daily: DataFrame, w: ReportWindow, shift_pp: float | None = None,
    rules: DashboardRules = DEFAULT_DASHBOARD,
) -> DataFrame:
    """Revenue change if ``shift_pp`` points of share moved to card (from cash, else the largest other).

    Shares are clamped to [0, 1], renormalised, and valued at each label's
    mean ticket over the window's trips. One row (none without current data).
    """
    pp = (rules.shift_pp if shift_pp is None else shift_pp) / 100.0
    L = F.col("L")
    df = _label_array(_aligned_mix(mix)).withColumn("card", _card_label(L, rules))
    cash = F.get(
        F.filter(L, lambda x: x["in_cur"] & F.lower(x["payment_desc"]).contains(rules.cash_token)), 0
    )["payment_desc"]
    df = df.withColumn(
        "A1",
        F.transform(
            L,
            lambda x: x.withField(
                "s_adj",
                F.when(x["payment_desc"] == F.col("card"), F.least(F.greatest(x["s1"] + pp, F.lit(0.0)), F.lit(1.0)))
                .otherwise(x["s1"]),
            ),
        ),
    )
    others = F.filter(F.col("A1"), lambda x: x["payment_desc"] != F.col("card"))
    top_other = F.array_max(F.transform(others, lambda x: x["s_adj"]))
    largest_other = F.get(F.filter(others, lambda x: x["s_adj"] == top_other), 0)["payment_desc"]
    df = df.withColumn("take_from", F.coalesce(cash, largest_other))
    df = df.withColumn(
        "A2",
        F.transform(
            F.col("A1"),
            lambda x: x.withField(
                "s_adj",
                F.when(x["payment_desc"] == F.col("take_from"), F.greatest(x["s_adj"] - pp, F.lit(0.0)))
                .otherwise(x["s_adj"]),
            ),
        ),
    )
    df = df.withColumn("tot", F.aggregate(F.col("A2"), F.lit(0.0), lambda acc, x: acc + x["s_adj"]))
    df = df.withColumn(
        "A3",
        F.transform(
            F.col("A2"),
            lambda x: x.withField(
                "s_adj", F.when(F.col("tot") != 0, x["s_adj"] / F.col("tot")).otherwise(x["s_adj"])
            ),
        ),
    )
    trips = _window_trips(kpi_daily, w)
    base, adj = _dot(F.col("A3"), "s1", "p1"), _dot(F.col("A3"), "s_adj", "p1")
    return df.where(F.size(F.filter(L, lambda x: x["in_cur"])) > 0).select(
        F.col("card").alias("card_label"),
        F.col("take_from").alias("take_from_label"),
        F.lit(pp * 100.0).alias("shift_pp"),
        trips.alias("window_trips"),
        (trips * base).alias("base_revenue"),
        (trips * adj).alias("sensitivity_revenue"),
        (trips * adj - trips * base).alias("delta_revenue"),
    )


def mix_impact(mix: DataFrame, kpi_daily: DataFrame, w: ReportWindow, rules: DashboardRules = DEFAULT_DASHBOARD) -> DataFrame:
    """Card share change (pp) and revenue effect of the mix change T * sum((s1 - s0) * p1).

    One row when both windows have payment data, none otherwise.
    """
    L = F.col("L")
    df = _label_array(_aligned_mix(mix)).withColumn("card", _card_label(L, rules))
    trips = _window_trips(kpi_daily, w)
    card_row = F.get(F.filter(L, lambda x: x["payment_desc"] == F.col("card")), 0)
    mix_sum = F.aggregate(L, F.lit(0.0), lambda acc, x: acc + (x["s1"] - x["s0"]) * x["p1"])
    has_cur = F.size(F.filter(L, lambda x: x["in_cur"])) > 0
    has_prev = F.size(F.filter(L, lambda x: x["in_prev"])) > 0
    return df.where(has_cur & has_prev).select(
        F.col("card").alias("card_label"),
        ((card_row["s1"] - card_row["s0"]) * 100.0).alias("card_share_change_pp"),
        (trips * mix_sum).alias("mix_impact"),
    )


def vendor_window(fact: DataFrame, dim_vendor: DataFrame, w: ReportWindow) -> DataFrame:
    """Per vendor in the current window: trips, revenue, avg ticket, tip rate, share, revenue per trip."""
    from fareline.plans.warehouse import month_filter

    v = (
        month_filter(fact, w.current_start, w.today)
        .join(dim_vendor, "vendor_id", "left")
        .groupBy("vendor_id", "vendor_name")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            F.sum("total_amount").alias("revenue"),
            F.avg("total_amount").alias("avg_ticket"),
            safe_ratio(F.sum("tip_amount"), F.sum("total_amount")).alias("tip_rate"),
        )
    )
    # one row per vendor: the window over all of them is as long as the vendor list
    total = F.sum("trips").over(Window.partitionBy())
    return v.withColumns(
        {"share": F.col("trips") / total, "revenue_per_trip": safe_ratio("revenue", "trips")}
    )


def vendor_cards(fact: DataFrame, dim_vendor: DataFrame, w: ReportWindow, rules: DashboardRules = DEFAULT_DASHBOARD) -> DataFrame:
    """Top vendors by trips among known vendors (top-k is the feature)."""
    v = vendor_window(fact, dim_vendor, w)
    known = v.where(
        F.col("vendor_name").isNotNull()
        & ~F.col("vendor_name").ilike(f"%{rules.unknown_vendor_token}%")
        & (F.col("trips") > 0)
    )
    return known.orderBy(F.desc("trips"), F.asc("vendor_id")).limit(rules.top_vendors).select(
        "vendor_id", "vendor_name", "trips", "revenue", "share", "revenue_per_trip", "tip_rate"
    )


def vendor_gap(fact: DataFrame, dim_vendor: DataFrame, w: ReportWindow) -> DataFrame:
    """(revenue per trip - median over vendors) x trips; the worst vendor.

    The exact median runs over the per-vendor aggregate (one row per vendor).
    """
    v = vendor_window(fact, dim_vendor, w)
    med = v.agg(F.median("revenue_per_trip")).scalar()
    g = v.withColumns({"median_revenue_per_trip": med, "gap": (F.col("revenue_per_trip") - med) * F.col("trips")})
    return g.orderBy(F.asc_nulls_last("gap"), F.asc("vendor_id")).limit(1).select(
        "vendor_id", "vendor_name", "trips", "revenue_per_trip", "median_revenue_per_trip", "gap"
    )


def airport_vs_city(kpi_daily: DataFrame, airport_daily: DataFrame, w: ReportWindow) -> DataFrame:
    """Daily revenue split into airport and city segments (long format)."""
    total = kpi_daily.where(w.current()).select(
        "date_day", F.col("gross_revenue").alias("total_revenue"), "trips"
    )
    ap = (
        airport_daily.where(w.current())
        .groupBy("date_day")
        .agg(F.sum("total_revenue").alias("airport_revenue"), F.sum("trips").alias("airport_trips"))
    )
    j = total.join(ap, "date_day", "left").select(
        "date_day",
        "total_revenue",
        F.coalesce("airport_revenue", F.lit(0.0)).alias("airport_revenue"),
    )
    j = j.withColumn("city_revenue", F.col("total_revenue") - F.col("airport_revenue"))
    return j.unpivot("date_day", ["airport_revenue", "city_revenue"], "segment", "revenue")


def zone_window(revenue_daily_zone: DataFrame, dim_zone: DataFrame, w: ReportWindow) -> DataFrame:
    """Daily zone revenue of the current window with borough and zone names."""
    return (
        revenue_daily_zone.where(w.current())
        .join(dim_zone.select("location_id", "borough", "zone"), "location_id", "left")
        .select(
            "date_day",
            "location_id",
            "borough",
            "zone",
            F.coalesce("trips", F.lit(0)).alias("trips"),
            F.coalesce("total_revenue", F.lit(0.0)).alias("total_revenue"),
        )
    )


def zone_totals(revenue_daily_zone: DataFrame, dim_zone: DataFrame, w: ReportWindow, rules: DashboardRules = DEFAULT_DASHBOARD) -> DataFrame:
    zd = zone_window(revenue_daily_zone, dim_zone, w).where(F.col("borough").isNotNull() & F.col("zone").isNotNull())
    z = zd.groupBy("location_id", "borough", "zone").agg(
        F.sum("trips").cast("long").alias("trips"), F.sum("total_revenue").alias("revenue")
    )
    total = z.agg(F.sum("revenue")).scalar()
    return z.withColumns(
        {
            "avg_ticket": safe_ratio("revenue", "trips"),
            "rev_share": F.when(total != 0, F.col("revenue") / total).otherwise(F.lit(0.0)),
            "label": F.concat_ws(rules.label_separator, "borough", "zone"),
        }
    )


def top_zones(revenue_daily_zone: DataFrame, dim_zone: DataFrame, w: ReportWindow, rules: DashboardRules = DEFAULT_DASHBOARD) -> DataFrame:
    """Top zones by revenue with trips, avg ticket and share of all zones' revenue."""
    z = zone_totals(revenue_daily_zone, dim_zone, w, rules)
    return z.orderBy(F.desc("revenue"), F.asc("location_id")).limit(rules.top_zones)


def borough_dow_skew(revenue_daily_zone: DataFrame, dim_zone: DataFrame, dim_date: DataFrame, w: ReportWindow) -> DataFrame:
    """Revenue per borough and weekday, as a share of the borough's window revenue."""
    zd = zone_window(revenue_daily_zone, dim_zone, w)
    dow = dim_date.where(w.current()).select("date_day", "day_name")
    s = (
        zd.join(dow, "date_day", "left")
        .where(F.col("borough").isNotNull() & F.col("day_name").isNotNull())
        .groupBy("borough", "day_name")
        .agg(F.sum("total_revenue").alias("revenue"))
    )
    return s.withColumn("pct_of_borough", safe_ratio("revenue", F.sum("revenue").over(Window.partitionBy("borough"))))


def top_corridors(
    od_monthly: DataFrame, revenue_daily_zone: DataFrame, dim_zone: DataFrame, w: ReportWindow,
    rules: DashboardRules = DEFAULT_DASHBOARD,
) -> DataFrame:
    """Strongest OD corridors from the top pickup zones over the months the window touches."""
    first_month = F.date_format(w.current_start, "yyyy-MM")
    last_month = F.date_format(w.today, "yyyy-MM")
    od = od_monthly.where(F.col("year_month").between(first_month, last_month))
    top_ids = top_zones(revenue_daily_zone, dim_zone, w, rules).select(F.col("location_id").alias("pu_location_id"))
    z = dim_zone.select("location_id", "zone", "borough")
    pu = z.select(F.col("location_id").alias("pu_location_id"), F.col("zone").alias("pu_zone"), F.col("borough").alias("pu_borough"))
    do = z.select(F.col("location_id").alias("do_location_id"), F.col("zone").alias("do_zone"), F.col("borough").alias("do_borough"))
    keys = ["pu_location_id", "do_location_id", "pu_zone", "do_zone", "pu_borough", "do_borough"]
    j = (
        od.join(top_ids, "pu_location_id", "left_semi")
        .join(pu, "pu_location_id", "left")
        .join(do, "do_location_id", "left")
    )
    g = (
        j.where(F.col("pu_zone").isNotNull() & F.col("do_zone").isNotNull()
                & F.col("pu_borough").isNotNull() & F.col("do_borough").isNotNull()
                & F.col("do_location_id").isNotNull())
        .groupBy(*keys)
        .agg(F.sum("trips").cast("long").alias("trips"), F.sum("revenue").alias("revenue"))
    )
    sep = rules.label_separator
    corridor = F.concat(
        F.col("pu_borough"), F.lit(sep), F.col("pu_zone"), F.lit(rules.corridor_arrow),
        F.col("do_borough"), F.lit(sep), F.col("do_zone"),
    )
    return (
        g.withColumn("corridor", corridor)
        .orderBy(F.desc("revenue"), F.asc("pu_location_id"), F.asc("do_location_id"))
        .limit(rules.top_corridors)
    )


def zone_hotspots(
    anomaly_daily: DataFrame, revenue_daily_zone: DataFrame, dim_zone: DataFrame, w: ReportWindow,
    min_trips: int | None = None, rules: DashboardRules = DEFAULT_DASHBOARD,
) -> DataFrame:
    """Zones with the highest anomaly rate (anomalies / trips) among zones with enough trips."""
    floor = rules.hotspot_min_trips if min_trips is None else min_trips
    a = (
        anomaly_daily.where(w.current())
        .groupBy("location_id")
        .agg(F.coalesce(F.sum("anomalies"), F.lit(0)).cast("long").alias("anomalies"))
    )
    z = zone_totals(revenue_daily_zone, dim_zone, w, rules).select("location_id", "borough", "zone", "trips", "label")
    hot = a.join(z, "location_id", "left").withColumn("anomaly_rate", safe_ratio("anomalies", "trips"))
    return (
        hot.where(F.col("trips") >= floor)
        .orderBy(F.desc_nulls_last("anomaly_rate"), F.asc("location_id"))
        .limit(rules.top_hotspots)
        .select("location_id", "borough", "zone", "label", "anomalies", "trips", "anomaly_rate")
    )
