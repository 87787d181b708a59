"""Column expressions shared by the operators.

All are built-in Spark expressions (JVM side, whole-stage codegen); none is
a Python UDF. Each function returns a ``Column``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

# Marketing channel rules, checked in this order.
# ``utm_source``/``utm_medium`` are matched as given, not lower-cased.
CHANNEL_RULES = [
    ("source", ["direct"], "Direct"),
    ("medium", ["cpc", "ppc", "paid"], "Paid Search"),
    ("medium", ["organic"], "Organic Search"),
    ("medium", ["social"], "Social"),
    ("medium", ["email"], "Email"),
    ("medium", ["referral"], "Referral"),
]
CHANNEL_OTHER = "Other"

# The ten fields of the completeness score.
QUALITY_FIELDS = [
    "event_id", "event_type", "user_id", "session_id", "event_timestamp",
    "product_id", "category", "price", "device_type", "country",
]
# Marker strings that count as missing in string fields.
MISSING_MARKERS = ["unknown", ""]


def channel_group(source: str = "utm_source", medium: str = "utm_medium") -> Column:
    cols = {"source": F.col(source), "medium": F.col(medium)}
    expr = None
    for which, values, label in CHANNEL_RULES:
        cond = cols[which].isin(*values)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(CHANNEL_OTHER)


def is_present(df: DataFrame, name: str) -> Column:
    """Non-null; for strings also not a missing marker (typed, SURVEY D5)."""
    c = F.col(name)
    cond = c.isNotNull()
    if isinstance(df.schema[name].dataType, T.StringType):
        cond = cond & ~c.isin(*MISSING_MARKERS)
    return F.coalesce(cond, F.lit(False))


def quality_score(df: DataFrame, fields: Iterable[str] = QUALITY_FIELDS) -> Column:
    fields = list(fields)
    hits = [is_present(df, f).cast("int") for f in fields]
    total = hits[0]
    for h in hits[1:]:
        total = total + h
    return total / F.lit(len(fields))


def quality_flags() -> Column:
    """Comma list of issues; ``''`` when none (``concat_ws`` skips NULLs)."""
    return F.concat_ws(
        ",",
        F.when(F.col("user_id") == "anonymous", F.lit("missing_user")),
        F.when(F.col("price") <= 0, F.lit("zero_price")),
        F.when(F.col("product_id").isNull(), F.lit("missing_product")),
    )


def row_hash(*cols: str) -> Column:
    """sha-256 of the ``||``-joined fields; NULLs are skipped."""
    return F.sha2(F.concat_ws("||", *[F.col(c) for c in cols]), 256)


def money(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(MONEY)


def to_double(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("double")


def exact_avg(value: Column) -> Column:
    """Average as exact (decimal) sum / count, as a double; NULL when empty."""
    return F.try_divide(F.sum(value).cast("double"), F.count(value))


def guarded_ratio(num: Column | str, den: Column | str, digits: int = 4) -> Column:
    """``round(num/den, digits)``, 0 when the denominator is 0."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return F.round(F.when(den > 0, num / den).otherwise(F.lit(0.0)), digits)


def null_ratio(num: Column | str, den: Column | str, digits: int) -> Column:
    """``round(num/den, digits)``, NULL when the denominator is 0."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return F.round(F.try_divide(num.cast("double"), den), digits)


def epoch_seconds(c: Column | str) -> Column:
    """Whole seconds since the epoch, for ``timestamp`` and ``timestamp_ntz``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_seconds(c.cast("timestamp"))


def is_nan_safe(df: DataFrame, name: str) -> Column:
    """NaN test only where NaN exists (float/double); FALSE elsewhere."""
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return F.isnan(F.col(name))
    return F.lit(False)
