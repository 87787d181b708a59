"""Aggregate marts over the clean table.

Money columns stay exact decimals through every sum and are cast to double
only at the output. ``computed_at`` is added by ``stamp`` at write time,
not here, so mart results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.functions import expressions as X

REVENUE_KEYS = ["event_date", "event_hour", "category", "channel_group",
                "device_type", "country", "currency"]
SESSION_KEYS = ["session_id", "user_id", "device_type", "channel_group", "country", "event_date"]
PRODUCT_KEYS = ["product_id", "product_name", "category", "event_date"]
FUNNEL_KEYS = ["event_date", "channel_group", "device_type"]
# Funnel stages in order.
FUNNEL_STAGES = [
    ("stage_1_viewers", "page_view"),
    ("stage_2_cart_adders", "add_to_cart"),
    ("stage_3_checkout", "checkout"),
    ("stage_4_purchasers", "purchase"),
]


def _is(t: str):
    return F.col("event_type") == t


def stamp(df: DataFrame) -> DataFrame:
    """Add ``computed_at`` (load time; left out of compared outputs, C12)."""
    return df.withColumn("computed_at", F.current_timestamp())


def revenue_mart(clean: DataFrame, buyers_sketch: bool = False,
                 median_accuracy: int = 10000) -> DataFrame:
    """A1: hourly revenue by seven dimensions, purchases only.

    ``buyers_sketch`` adds a mergeable HLL sketch of the buyers, so coarser
    periods and dimension roll-ups (V1) can be served from the mart: distinct
    buyers do not add up across rows, sketches do.
    """
    amt = F.col("total_amount")
    extra = [F.hll_sketch_agg("user_id").alias("buyers_sketch")] if buyers_sketch else []
    sold = clean.filter(_is("purchase"))
    sums = sold.groupBy(*REVENUE_KEYS).agg(
        F.sum(amt).alias("total_revenue"),
        F.count("event_id").alias("order_count"),
        X.exact_avg(amt).alias("avg_order_value"),
        F.sum("quantity").cast("long").alias("total_items_sold"),
        F.min(amt).alias("min_order_value"),
        F.max(amt).alias("max_order_value"),
        # exact while a group holds fewer values than the accuracy
        F.percentile_approx(amt, 0.5, median_accuracy).alias("median_order_value"),
        *extra,
    )
    # distinct buyers in a branch of their own: a distinct next to the other
    # aggregates would carry percentile buffers keyed by user
    buyers = sold.select(*REVENUE_KEYS, "user_id").distinct().groupBy(*REVENUE_KEYS).agg(
        F.count("user_id").alias("unique_buyers"))
    same = [F.col(f"s.{k}").eqNullSafe(F.col(f"b.{k}")) for k in REVENUE_KEYS]
    return (
        sums.alias("s").join(buyers.alias("b"), same).select("s.*", "b.unique_buyers")
        .withColumn("revenue_per_buyer", X.null_ratio(F.col("total_revenue"), F.col("unique_buyers"), 2))
        .withColumn("items_per_order", X.null_ratio(F.col("total_items_sold"), F.col("order_count"), 2))
    )


def session_bounds(clean: DataFrame) -> DataFrame:
    """W2 as an aggregate: first and last event time of each session.

    Same result as the whole-frame ``first``/``last`` window when event time
    is non-null, but partially aggregated: the defaulted ``unknown`` session,
    however large, is reduced map-side instead of landing in one window task.
    """
    return clean.groupBy("session_id").agg(
        F.min("event_timestamp").alias("session_start"),
        F.max("event_timestamp").alias("session_end"),
    )


def session_mart(clean: DataFrame, with_sequence: bool = False) -> DataFrame:
    """A2: one row per (session, user, device, channel, country, date) (D13 kept).

    ``with_sequence`` adds ``event_sequence``: one array per row, built in one
    task per row and as long as the row's events; ``session_sequences`` gives
    the same order in long form without that limit. Without it distinct types
    come from a set bounded by the event-type domain.

    One pass over the clean rows: each group also keeps its own first/last
    event time; the session bounds (W2) are then an aggregate over those
    group rows, joined back on ``session_id`` (the group rows' exchange is
    reused; AQE splits a skewed session or broadcasts small bounds).
    """
    ev = F.struct(F.col("event_timestamp").alias("t"), F.col("event_id").alias("i"),
                  F.col("event_type").alias("e"))
    per_row = clean.groupBy(*SESSION_KEYS).agg(
        F.min("event_timestamp").alias("_first"),
        F.max("event_timestamp").alias("_last"),
        F.count("event_id").alias("total_events"),
        F.count_if(_is("page_view")).alias("page_views"),
        F.count_if(_is("add_to_cart")).alias("add_to_cart_count"),
        F.count_if(_is("purchase")).alias("purchase_count"),
        F.sum(F.when(_is("purchase"), F.col("total_amount")).otherwise(F.lit(0))).alias("session_revenue"),
        # ordered by (time, id): collect_list order is undefined after a shuffle
        *([F.transform(F.array_sort(F.collect_list(ev)), lambda x: x["e"]).alias("event_sequence")]
          if with_sequence else [F.collect_set("event_type").alias("_types")]),
    )
    # distinct types from the collected values: no count(distinct) rewrite,
    # which would add a second aggregation level over all rows
    types = F.col("event_sequence") if with_sequence else F.col("_types")
    per_row = per_row.withColumn("distinct_event_types", F.size(F.array_distinct(
        F.filter(types, lambda x: x.isNotNull()))).cast("long")).drop("_types")
    bounds = per_row.groupBy("session_id").agg(
        F.min("_first").alias("session_start"), F.max("_last").alias("session_end"))
    return (
        per_row.join(bounds, "session_id")
        .withColumns({
            "session_duration_seconds": X.epoch_seconds("session_end") - X.epoch_seconds("session_start"),
            "is_bounce": F.col("total_events") == 1,
            "has_conversion": F.col("purchase_count") > 0,
        })
        .select(*SESSION_KEYS, "session_start", "session_end", "total_events",
                "distinct_event_types", "page_views", "add_to_cart_count", "purchase_count",
                "session_revenue", *(["event_sequence"] if with_sequence else []),
                "session_duration_seconds", "is_bounce", "has_conversion")
    )


def session_sequences(clean: DataFrame, keys: list[str] = SESSION_KEYS) -> DataFrame:
    """A16 in long form: each event's 1-based position in its session row.

    Same order as ``event_sequence`` (event time, then event id), but no
    group is ever held by one task: events are counted per (group, second)
    with partial aggregation, a running sum over the group's seconds gives
    each second's offset (a window over at most 86,400 rows per group, as
    ``event_date`` is a key), and positions are numbered within each
    (group, second). A hot group is therefore spread over its seconds.
    """
    sec = F.date_trunc("second", F.col("event_timestamp")).alias("_sec")
    events = clean.select(*keys, "event_timestamp", "event_id", "event_type", sec)
    per_sec = events.groupBy(*keys, "_sec").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_sec").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_sec.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    within = Window.partitionBy(*keys, "_sec").orderBy("event_timestamp", "event_id")
    e, o = events.alias("e"), offsets.drop("_n").alias("o")
    # null-safe: a NULL key value is a group like any other (as in groupBy)
    on = [F.col(f"e.{k}").eqNullSafe(F.col(f"o.{k}")) for k in [*keys, "_sec"]]
    return (e.join(o, on)
            .select("e.*", "o._offset")
            .withColumn("position", (F.col("_offset") + F.row_number().over(within)).cast("long"))
            .select(*keys, "position", "event_timestamp", "event_id", "event_type"))


def product_mart(clean: DataFrame) -> DataFrame:
    """A3: per product and date; three guarded rates to 4 decimals."""
    purchase = _is("purchase")
    return (
        clean.filter(F.col("product_id").isNotNull())
        .groupBy(*PRODUCT_KEYS)
        .agg(
            F.count_if(_is("page_view")).alias("views"),
            F.count_if(_is("add_to_cart")).alias("adds_to_cart"),
            F.count_if(purchase).alias("purchases"),
            F.sum(F.when(purchase, F.col("total_amount")).otherwise(F.lit(0))).alias("total_revenue"),
            X.exact_avg(F.when(purchase, F.col("price"))).alias("avg_selling_price"),
            F.count_distinct("user_id").alias("unique_users"),
        )
        .withColumns({
            "view_to_cart_rate": X.guarded_ratio("adds_to_cart", "views"),
            "cart_to_purchase_rate": X.guarded_ratio("purchases", "adds_to_cart"),
            "view_to_purchase_rate": X.guarded_ratio("purchases", "views"),
        })
    )


def funnel_counts(clean: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct users per funnel stage, exact, without a 4-way Expand.

    Step 1 groups by (keys, user) with one ``max`` flag per stage: partial
    aggregation shrinks every map output to one row per user and key.
    Step 2 sums the flags. Same numbers as four ``count(distinct when …)``.
    """
    # a NULL user is never counted, but its group still gets a row (of zeros)
    known = F.col("user_id").isNotNull()
    flags = [F.max(F.when(_is(t) & known, 1).otherwise(0)).alias(name) for name, t in FUNNEL_STAGES]
    per_user = clean.groupBy(*keys, "user_id").agg(*flags)
    return per_user.groupBy(*keys).agg(
        *[F.sum(name).cast("long").alias(name) for name, _ in FUNNEL_STAGES])


def with_funnel_rates(df: DataFrame) -> DataFrame:
    return df.withColumns({
        # unguarded in the reference: NULL, not an error, when no viewers
        "view_to_cart_rate": X.null_ratio("stage_2_cart_adders", "stage_1_viewers", 4),
        "cart_to_checkout_rate": X.guarded_ratio("stage_3_checkout", "stage_2_cart_adders"),
        "checkout_to_purchase_rate": X.guarded_ratio("stage_4_purchasers", "stage_3_checkout"),
        "overall_conversion_rate": X.guarded_ratio("stage_4_purchasers", "stage_1_viewers"),
    })


def funnel_mart(clean: DataFrame) -> DataFrame:
    """A4: stages are independent distinct-user counts (no order in time)."""
    return with_funnel_rates(funnel_counts(clean, FUNNEL_KEYS))


def kpi_windows(clean: DataFrame, length: str = "5 minutes", slide: str = "1 minute") -> DataFrame:
    """A5 (batch form): sliding-window KPIs by event type.

    Each event falls in length/slide windows. ``active_users`` is exact.
    """
    return (
        clean.groupBy(F.window("event_timestamp", length, slide).alias("window"), "event_type")
        .agg(
            F.count("event_id").alias("event_count"),
            F.count_distinct("user_id").alias("active_users"),
            F.sum(F.when(_is("purchase"), F.col("total_amount")).otherwise(F.lit(0)))
             .cast("double").alias("window_revenue"),
        )
        .select(F.col("window.start").alias("window_start"),
                F.col("window.end").alias("window_end"),
                "event_type", "event_count", "active_users", "window_revenue")
    )


MARTS = {
    "revenue_metrics": revenue_mart,
    "session_analytics": session_mart,
    "product_performance": product_mart,
    "funnel_analysis": funnel_mart,
}


def compute_all(clean: DataFrame) -> dict[str, DataFrame]:
    """The four batch marts (KPIs excluded), lazily; the caller writes them."""
    return {name: fn(clean) for name, fn in MARTS.items()}
