"""Serving queries behind the reference's HTTP endpoints.

No server: each query is a function returning a DataFrame. Non-additive
measures (distinct buyers, medians) are recomputed from clean rows, not
summed from marts, except in ``revenue_rollup``, which merges HLL sketches
kept in the revenue mart. Optional dimension filters default to ``"all"``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.functions import expressions as X
from tidepool.operators import marts

# Time granularities and the date_trunc unit of each (V1).
GRANULARITIES = {"hourly": "hour", "daily": "day", "weekly": "week", "monthly": "month"}
ALL = "all"


def _check_range(name: str, value: int, lo: int, hi: int) -> int:
    if not lo <= int(value) <= hi:
        raise ValueError(f"{name} must be in [{lo}, {hi}], got {value}")
    return int(value)


def _dim(df: DataFrame, column: str, value: str | None) -> tuple[DataFrame, F.Column]:
    if value is None:
        return df, F.lit(ALL)
    return df.filter(F.col(column) == value), F.lit(value)


def revenue_query(clean: DataFrame, start_date: str, end_date: str, granularity: str = "daily",
                  category: str | None = None, channel: str | None = None,
                  country: str | None = None, limit: int = 100) -> DataFrame:
    """V1: revenue per period over clean purchases, optional dimension filters."""
    unit = GRANULARITIES[granularity]
    limit = _check_range("limit", limit, 1, 1000)
    df = clean.filter((F.col("event_type") == "purchase")
                      & F.col("event_date").between(start_date, end_date))
    df, cat = _dim(df, "category", category)
    df, ch = _dim(df, "channel_group", channel)
    df, co = _dim(df, "country", country)
    period = F.date_trunc(unit, F.col("event_timestamp"))
    hour = F.hour(period) if unit == "hour" else F.lit(None).cast("int")
    amt = F.col("total_amount")
    return (
        df.groupBy(F.date_format(period, "yyyy-MM-dd").alias("event_date"), hour.alias("event_hour"))
        .agg(
            F.sum(amt).alias("_rev"),
            F.count("event_id").alias("order_count"),
            F.count_distinct("user_id").alias("unique_buyers"),
            X.exact_avg(amt).alias("avg_order_value"),
        )
        .select(
            "event_date", "event_hour",
            cat.alias("category"), ch.alias("channel_group"), co.alias("country"),
            F.col("_rev").cast("double").alias("total_revenue"),
            "order_count", "unique_buyers", "avg_order_value",
            X.null_ratio(F.col("_rev"), F.col("unique_buyers"), 2).alias("revenue_per_buyer"),
        )
        .orderBy("event_date", "event_hour")
        .limit(limit)
    )


def revenue_rollup(revenue: DataFrame, start_date: str, end_date: str,
                   granularity: str = "daily", category: str | None = None,
                   channel: str | None = None, country: str | None = None,
                   limit: int = 100) -> DataFrame:
    """V1 served from the hourly revenue mart (built with ``buyers_sketch``).

    Revenue and orders add up; distinct buyers come from the union of the
    rows' HLL sketches (approximate; exact for small sets). Reads the mart,
    not the clean purchases, so the work scales with mart rows.
    """
    unit = GRANULARITIES[granularity]
    limit = _check_range("limit", limit, 1, 1000)
    df = revenue.filter(F.col("event_date").between(start_date, end_date))
    df, cat = _dim(df, "category", category)
    df, ch = _dim(df, "channel_group", channel)
    df, co = _dim(df, "country", country)
    hour_ts = F.to_timestamp(F.col("event_date")) + F.make_interval(
        hours=F.col("event_hour")) if unit == "hour" else F.to_timestamp(F.col("event_date"))
    period = F.date_trunc(unit, hour_ts)
    hour = F.hour(period) if unit == "hour" else F.lit(None).cast("int")
    rev = F.round(F.sum("total_revenue"), 2).cast("double")
    buyers = F.hll_sketch_estimate(F.hll_union_agg("buyers_sketch"))
    return (
        df.groupBy(F.date_format(period, "yyyy-MM-dd").alias("event_date"), hour.alias("event_hour"))
        .agg(rev.alias("total_revenue"), F.sum("order_count").alias("order_count"),
             buyers.alias("unique_buyers"))
        .select(
            "event_date", "event_hour",
            cat.alias("category"), ch.alias("channel_group"), co.alias("country"),
            "total_revenue", "order_count", "unique_buyers",
            (F.col("total_revenue") / F.col("order_count")).alias("avg_order_value"),
            X.null_ratio(F.col("total_revenue"), F.col("unique_buyers"), 2).alias("revenue_per_buyer"),
        )
        .orderBy("event_date", "event_hour")
        .limit(limit)
    )


def session_summary(sessions: DataFrame, start_date: str, end_date: str,
                    device_type: str | None = None) -> DataFrame:
    """V2: per date over whole sessions: mart rows are parts of a session (D13), so they are
    folded to one row per (session, date) before any rate is taken."""
    df = sessions.filter(F.col("event_date").between(start_date, end_date))
    if device_type is not None:
        df = df.filter(F.col("device_type") == device_type)
    whole = df.groupBy("session_id", "event_date").agg(
        F.max("session_duration_seconds").alias("duration"),
        F.sum("total_events").alias("events"),
        F.sum("page_views").alias("views"),
        F.sum("purchase_count").alias("purchases"),
        F.sum("session_revenue").alias("revenue"),
    )
    return whole.groupBy("event_date").agg(
        F.count("session_id").alias("total_sessions"),
        F.round(F.avg("duration"), 2).alias("avg_session_duration"),
        F.round(F.avg("views"), 2).alias("avg_page_views"),
        F.round(F.avg((F.col("events") == 1).cast("int")), 4).alias("bounce_rate"),
        F.round(F.avg((F.col("purchases") > 0).cast("int")), 4).alias("conversion_rate"),
        F.round(F.sum("revenue"), 2).cast("double").alias("total_revenue"),
    )


def top_products(products: DataFrame, start_date: str, end_date: str,
                 category: str | None = None, top_n: int = 20) -> DataFrame:
    """V3: product mart re-aggregated over dates, top N by revenue (L4).

    Ranking key (our choice): revenue descending, then product id, category,
    name ascending. ``limit`` after ``orderBy`` plans as TakeOrdered: each
    task keeps its own top N, so no full sort.
    """
    top_n = _check_range("top_n", top_n, 1, 100)
    df = products.filter(F.col("event_date").between(start_date, end_date))
    if category is not None:
        df = df.filter(F.col("category") == category)
    return (
        df.groupBy("product_id", "product_name", "category")
        .agg(
            F.sum("views").alias("views"),
            F.sum("purchases").alias("purchases"),
            F.round(F.sum("total_revenue"), 2).cast("double").alias("total_revenue"),
        )
        .withColumn("view_to_purchase_rate", X.guarded_ratio("purchases", "views"))
        .orderBy(F.col("total_revenue").desc(), "product_id", "category", "product_name")
        .limit(top_n)
    )


def funnel_query(clean: DataFrame, start_date: str, end_date: str,
                 channel: str | None = None) -> DataFrame:
    """V4: funnel per date (and channel), recomputed from clean rows."""
    df = clean.filter(F.col("event_date").between(start_date, end_date))
    df, ch = _dim(df, "channel_group", channel)
    counts = marts.funnel_counts(df, ["event_date"])
    return marts.with_funnel_rates(counts).select(
        "event_date", ch.alias("channel_group"), *[c for c in counts.columns if c != "event_date"],
        "view_to_cart_rate", "cart_to_checkout_rate", "checkout_to_purchase_rate",
        "overall_conversion_rate")


def latest_kpis(clean: DataFrame, now=None, minutes: int = 5) -> DataFrame:
    """V5: KPIs of the last ``minutes`` up to ``now`` (default: latest event time).

    ``now`` defaults to a scalar subquery, so the result is one row and the
    whole computation stays on the executors.
    """
    if now is None:
        now = clean.select(F.max("event_timestamp")).scalar()
    elif isinstance(now, str):
        now = F.lit(now).cast("timestamp_ntz")
    lo = now - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    w = clean.filter((F.col("event_timestamp") > lo) & (F.col("event_timestamp") <= now))
    purchase = F.col("event_type") == "purchase"
    return w.agg(
        F.count_distinct("user_id").alias("active_users"),
        (F.count(F.lit(1)) / F.lit(60.0 * minutes)).alias("events_per_second"),
        F.sum(F.when(purchase, F.col("total_amount"))).cast("double").alias("revenue_last_window"),
        F.count_if(purchase).alias("orders_last_window"),
        # most frequent type; ties go to the smallest name
        F.mode("event_type", True).alias("top_event_type"),
    )


def layer_counts(raw: DataFrame, clean: DataFrame, marts_count: int = len(marts.MARTS)) -> DataFrame:
    """V6: raw rows, clean rows, number of marts, as one row of scalar subqueries."""
    spark = raw.sparkSession
    return spark.range(1).select(
        raw.select(F.count(F.lit(1))).scalar().alias("bronze_records"),
        clean.select(F.count(F.lit(1))).scalar().alias("silver_records"),
        F.lit(marts_count).alias("gold_tables"),
    )
