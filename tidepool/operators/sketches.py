"""Marts that merge: sketches for what does not add up.

Medians, distinct users of several stages and the best products cannot be added over the rows of a mart. These marts
keep a sketch a row instead, so any coarser period or dimension is served from the mart, without a scan of clean rows:

* KLL sketches of order values: medians with a bound on the rank error;
* theta sketches of each funnel stage's users: unions over dates and channels, intersections of two stages;
* count-min rows of product revenue with a candidate list a part: the top products, never too low, with a bound
  on how much too high. Its cells are plain sums, so parts are merged by adding them.

All of them are partially aggregated before a shuffle, and their size a group is fixed, whatever the group's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.operators import marts, serve

# ------------------------------------------------------------------ medians (KLL)

KLL_K = 400               # rank error below 1 % at this size (exact while a group has fewer values)
RANK_ERROR = 0.02         # the bound that holds with a wide margin
CENTS = 100


def order_value_mart(clean: DataFrame, keys: Sequence[str] = marts.REVENUE_KEYS, k: int = KLL_K) -> DataFrame:
    """A1, A10: purchases by the revenue mart's dimensions with a mergeable sketch of their values (in cents: exact integers)."""
    cents = (F.col("total_amount") * CENTS).cast("long")
    return clean.filter(F.col("event_type") == "purchase").groupBy(*keys).agg(
        F.sum("total_amount").alias("total_revenue"), F.count("event_id").alias("order_count"),
        F.kll_sketch_agg_bigint(cents, F.lit(k)).alias("values_sketch"))


def median_rollup(mart: DataFrame, granularity: str = "daily", category: str | None = None, channel: str | None = None,
                  country: str | None = None, quantiles: Sequence[float] = (0.5,)) -> DataFrame:
    """V1 with medians: sketches of the mart's rows merged by period; columns ``q<per cent>``."""
    df, cat = serve._dim(mart, "category", category)
    df, ch = serve._dim(df, "channel_group", channel)
    df, co = serve._dim(df, "country", country)
    merged = df.groupBy(period(granularity)).agg(
        F.sum("total_revenue").cast("double").alias("total_revenue"), F.sum("order_count").alias("order_count"),
        F.kll_merge_agg_bigint("values_sketch").alias("s"))
    values = [(F.kll_sketch_get_quantile_bigint("s", F.lit(float(q))) / CENTS).alias(f"q{round(100 * q)}") for q in quantiles]
    return merged.select("event_date", cat.alias("category"), ch.alias("channel_group"), co.alias("country"), "total_revenue", "order_count", *values)


def period(granularity: str) -> Column:
    """First day of the period that ``event_date`` lies in."""
    return F.date_format(F.date_trunc(serve.GRANULARITIES[granularity], F.to_timestamp("event_date")), "yyyy-MM-dd").alias("event_date")


# ------------------------------------------------------------------ funnels (theta)

THETA_LGK = 12            # 4,096 entries: exact below as many users, about 1.6 % beyond
STAGES = [name for name, _ in marts.FUNNEL_STAGES]


def funnel_sketch_mart(clean: DataFrame, keys: Sequence[str] = marts.FUNNEL_KEYS, lgk: int = THETA_LGK) -> DataFrame:
    """A4: per dimension, one sketch of each stage's users."""
    return clean.groupBy(*keys).agg(*[
        F.theta_sketch_agg(F.when(F.col("event_type") == kind, F.col("user_id")), F.lit(lgk)).alias(name) for name, kind in marts.FUNNEL_STAGES])


def funnel_rollup(mart: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """V4 over any dates and channels: users of each stage, and of each stage who were also in the one before.

    ``kept_2`` are viewers who added to a cart, and so on: an intersection, which no sums over a mart can give.
    """
    merged = mart.groupBy(*by).agg(*[F.theta_union_agg(s).alias(s) for s in STAGES])
    counts = {s: F.theta_sketch_estimate(s) for s in STAGES}
    kept = {f"kept_{i + 2}": F.theta_sketch_estimate(F.theta_intersection(a, b)) for i, (a, b) in enumerate(zip(STAGES, STAGES[1:], strict=False))}
    return merged.select(*by, *[v.alias(n) for n, v in (kept | counts).items()])


# ------------------------------------------------------------------ top products (count-min)

DEPTH, WIDTH = 5, 2048
SHARE = 1 / 500           # of a part's revenue that makes a product a candidate
PRODUCT = ["product_id", "product_name", "category"]


def _cells(depth: int, width: int) -> Column:
    """One cell in each of ``depth`` rows for a product."""
    return F.array(*[F.struct(F.lit(d).alias("depth"), F.pmod(F.xxhash64(F.lit(d), *PRODUCT), F.lit(width)).cast("int").alias("cell")) for d in range(depth)])


def revenue_cells(products: DataFrame, part: str = "event_date", depth: int = DEPTH, width: int = WIDTH) -> DataFrame:
    """Count-min rows of the product mart: (part, depth, cell, revenue), ``depth * width`` rows a part at most."""
    return (products.select(part, F.explode(_cells(depth, width)).alias("c"), "total_revenue")
            .groupBy(part, "c.depth", "c.cell").agg(F.sum("total_revenue").alias("revenue")))


def candidates(products: DataFrame, part: str = "event_date", share: float = SHARE) -> DataFrame:
    """(part, product): products with at least ``share`` of their part's revenue, ``1 / share`` a part at most.

    A product with that share of the revenue of several parts together has it in one of them at least, so none is missed.
    """
    total = products.groupBy(part).agg(F.sum("total_revenue").alias("_all"))
    own = products.groupBy(part, *PRODUCT).agg(F.sum("total_revenue").alias("_own"))
    return own.join(total, part).filter(F.col("_own") >= share * F.col("_all")).select(part, *PRODUCT).distinct()


def top_products(cells: DataFrame, named: DataFrame, top_n: int = 20, depth: int = DEPTH, width: int = WIDTH) -> DataFrame:
    """V3 from merged parts: the candidates' revenue, estimated as the least of their cells (too high by ``error_bound`` at most,
    but for a chance of ``exp(-depth)``; never too low). ``cells`` and ``named`` may be filtered to any parts first."""
    merged = cells.groupBy("depth", "cell").agg(F.sum("revenue").alias("revenue"))
    total = merged.filter("depth = 0").agg(F.sum("revenue")).scalar()
    place = named.select(*PRODUCT).distinct().withColumn("c", F.explode(_cells(depth, width))).select(*PRODUCT, "c.depth", "c.cell")
    estimate = place.join(merged, ["depth", "cell"]).groupBy(*PRODUCT).agg(F.min("revenue").alias("revenue_estimate"))
    best = [F.col("revenue_estimate").desc(), F.col("product_id"), F.col("category"), F.col("product_name")]
    return (estimate.orderBy(*best).limit(top_n).withColumn("error_bound", F.lit(2.718281828459045 / width) * total)
            .withColumn("rank", F.row_number().over(Window.orderBy(*best))))
