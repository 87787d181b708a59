"""Independent DuckDB SQL for every compared query (the correctness oracle).

Written from the operator semantics, not generated from the Spark plans.
Tables are the driver's pre-registered views (``events`` etc.); the raw-event
view is the shared fixture text from ``tidepool.sources.fixtures``.
"""

from __future__ import annotations

from tidepool.sources import fixtures as FX

BRONZE_BATCH = "bronze_fixture"


def _chain(p: str, src: str) -> list[str]:
    """CTEs bronze → dedup → clean over raw rows ``src``, names prefixed by ``p``."""
    return [
        f"""{p}bronze AS (
  SELECT *, '{BRONZE_BATCH}' AS batch_id, 'kafka_streaming' AS source_system,
         strftime(event_timestamp, '%Y-%m-%d') AS event_date,
         cast(hour(event_timestamp) AS integer) AS event_hour,
         sha256(concat_ws('||', event_id, "timestamp", user_id)) AS row_hash
  FROM {src})""",
        f"""{p}dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id
                                 ORDER BY kafka_timestamp DESC, kafka_offset DESC) AS rn
    FROM {p}bronze) WHERE rn = 1)""",
        f"""{p}nulls AS (
  SELECT * REPLACE (
    coalesce(user_id, 'anonymous') AS user_id,
    coalesce(session_id, 'unknown') AS session_id,
    coalesce(currency, 'USD') AS currency,
    coalesce(device_type, 'unknown') AS device_type,
    coalesce(country, 'unknown') AS country,
    coalesce(city, 'unknown') AS city,
    coalesce(price, cast(0 AS decimal(18,2))) AS price,
    coalesce(quantity, 1) AS quantity,
    coalesce(utm_source, 'direct') AS utm_source,
    coalesce(utm_medium, 'none') AS utm_medium)
  FROM {p}dedup)""",
        f"""{p}std AS (
  SELECT * REPLACE (
    lower(trim(event_type)) AS event_type,
    lower(trim(coalesce(category, 'uncategorized'))) AS category,
    lower(trim(device_type)) AS device_type,
    lower(trim(coalesce(browser, 'unknown'))) AS browser,
    lower(trim(coalesce(os, 'unknown'))) AS os,
    lower(trim(country)) AS country,
    lower(trim(city)) AS city,
    CASE WHEN referrer IS NULL THEN 'direct' ELSE lower(trim(referrer)) END AS referrer)
  FROM {p}nulls)""",
        f"""{p}derived AS (
  SELECT *, price * quantity AS total_amount,
    CASE WHEN utm_source = 'direct' THEN 'Direct'
         WHEN utm_medium IN ('cpc', 'ppc', 'paid') THEN 'Paid Search'
         WHEN utm_medium = 'organic' THEN 'Organic Search'
         WHEN utm_medium = 'social' THEN 'Social'
         WHEN utm_medium = 'email' THEN 'Email'
         WHEN utm_medium = 'referral' THEN 'Referral'
         ELSE 'Other' END AS channel_group
  FROM {p}std)""",
        f"""{p}scored AS (
  SELECT *,
    ((CASE WHEN event_id IS NOT NULL AND event_id NOT IN ('unknown', '') THEN 1 ELSE 0 END)
   + (CASE WHEN event_type IS NOT NULL AND event_type NOT IN ('unknown', '') THEN 1 ELSE 0 END)
   + (CASE WHEN user_id IS NOT NULL AND user_id NOT IN ('unknown', '') THEN 1 ELSE 0 END)
   + (CASE WHEN session_id IS NOT NULL AND session_id NOT IN ('unknown', '') THEN 1 ELSE 0 END)
   + (CASE WHEN event_timestamp IS NOT NULL THEN 1 ELSE 0 END)
   + (CASE WHEN product_id IS NOT NULL AND product_id NOT IN ('unknown', '') THEN 1 ELSE 0 END)
   + (CASE WHEN category IS NOT NULL AND category NOT IN ('unknown', '') THEN 1 ELSE 0 END)
   + (CASE WHEN price IS NOT NULL THEN 1 ELSE 0 END)
   + (CASE WHEN device_type IS NOT NULL AND device_type NOT IN ('unknown', '') THEN 1 ELSE 0 END)
   + (CASE WHEN country IS NOT NULL AND country NOT IN ('unknown', '') THEN 1 ELSE 0 END)
    ) / 10 AS data_quality_score,
    concat_ws(',',
      CASE WHEN user_id = 'anonymous' THEN 'missing_user' END,
      CASE WHEN price <= 0 THEN 'zero_price' END,
      CASE WHEN product_id IS NULL THEN 'missing_product' END) AS quality_flags,
    batch_id AS bronze_batch_id
  FROM {p}derived)""",
        f"""{p}clean AS (
  SELECT event_id, event_type, user_id, session_id, event_timestamp, product_id,
         product_name, category, price, quantity, total_amount, currency, device_type,
         browser, os, country, city, referrer, utm_source, utm_medium, utm_campaign,
         channel_group, row_hash, bronze_batch_id, data_quality_score, quality_flags,
         event_date, event_hour, kafka_timestamp, kafka_offset, ip_address
  FROM {p}scored)""",
    ]


def _ctes(*extra: str, chains: tuple[tuple[str, str], ...] = ()) -> str:
    """WITH raw, the main chain, optional extra chains (prefix, raw-where), extra CTEs."""
    parts = [f"raw AS (SELECT * FROM {FX.raw_events_sql()} r)"]
    parts += _chain("", "raw")
    for prefix, where in chains:
        parts.append(f"{prefix}raw AS (SELECT * FROM raw WHERE {where})")
        parts += _chain(prefix, f"{prefix}raw")
    return "WITH " + ",\n".join(parts + list(extra)) + "\n"


CLEAN_COLS = (
    "event_id, event_type, user_id, session_id, event_timestamp, product_id, product_name, "
    "category, cast(price AS double) AS price, quantity, cast(total_amount AS double) AS total_amount, "
    "currency, device_type, browser, os, country, city, referrer, utm_source, utm_medium, "
    "utm_campaign, channel_group, row_hash, bronze_batch_id, data_quality_score, quality_flags, "
    "event_date, event_hour"
)

REVENUE = _ctes() + """
SELECT event_date, event_hour, category, channel_group, device_type, country, currency,
  cast(sum(total_amount) AS double) AS total_revenue,
  count(event_id) AS order_count,
  count(DISTINCT user_id) AS unique_buyers,
  cast(sum(total_amount) AS double) / count(total_amount) AS avg_order_value,
  cast(sum(quantity) AS bigint) AS total_items_sold,
  cast(min(total_amount) AS double) AS min_order_value,
  cast(max(total_amount) AS double) AS max_order_value,
  cast(quantile_disc(total_amount, 0.5) AS double) AS median_order_value,
  cast(round(cast(cast(sum(total_amount) AS double) / nullif(count(DISTINCT user_id), 0) AS decimal(38,10)), 2) AS double) AS revenue_per_buyer,
  cast(round(cast(cast(sum(quantity) AS double) / nullif(count(event_id), 0) AS decimal(38,10)), 2) AS double) AS items_per_order
FROM clean WHERE event_type = 'purchase'
GROUP BY event_date, event_hour, category, channel_group, device_type, country, currency
"""


MONEY_OUT = "* REPLACE (cast(price AS double) AS price)"
MONEY_OUT2 = "* REPLACE (cast(price AS double) AS price, cast(total_amount AS double) AS total_amount)"

# integer columns holding NULLs are compared as double (pandas dtypes differ by engine)
RAW_OUT = "* REPLACE (cast(price AS double) AS price, cast(quantity AS double) AS quantity)"
ENRICH_RAW = _ctes() + f"SELECT {RAW_OUT} FROM bronze"
DATE_RANGE = _ctes() + (f"SELECT {RAW_OUT} FROM bronze "
                        "WHERE event_date >= '2024-01-08' AND event_date <= '2024-01-21'")
DEDUP = _ctes() + f"SELECT {RAW_OUT} FROM dedup"
NULLS = _ctes() + f"SELECT {MONEY_OUT} FROM nulls"
STANDARDIZE = _ctes() + f"SELECT {MONEY_OUT} FROM std"
DERIVE = _ctes() + f"SELECT {MONEY_OUT2} FROM derived"
SCORE = _ctes() + ("SELECT * EXCLUDE (bronze_batch_id) REPLACE (cast(price AS double) AS price, "
                   "cast(total_amount AS double) AS total_amount) FROM scored")
CLEAN_ALL = _ctes() + f"SELECT {CLEAN_COLS} FROM clean"

SESSION = _ctes("""bounds AS (
  SELECT session_id, min(event_timestamp) AS session_start, max(event_timestamp) AS session_end
  FROM clean GROUP BY session_id)""") + """
SELECT c.session_id, c.user_id, c.device_type, c.channel_group, c.country, c.event_date,
  min(b.session_start) AS session_start, min(b.session_end) AS session_end,
  count(c.event_id) AS total_events,
  count(DISTINCT c.event_type) AS distinct_event_types,
  count(*) FILTER (WHERE c.event_type = 'page_view') AS page_views,
  count(*) FILTER (WHERE c.event_type = 'add_to_cart') AS add_to_cart_count,
  count(*) FILTER (WHERE c.event_type = 'purchase') AS purchase_count,
  cast(sum(CASE WHEN c.event_type = 'purchase' THEN c.total_amount ELSE 0 END) AS double) AS session_revenue,
  cast(floor(epoch(min(b.session_end))) AS bigint) - cast(floor(epoch(min(b.session_start))) AS bigint)
    AS session_duration_seconds,
  count(c.event_id) = 1 AS is_bounce,
  count(*) FILTER (WHERE c.event_type = 'purchase') > 0 AS has_conversion
FROM clean c JOIN bounds b USING (session_id)
GROUP BY c.session_id, c.user_id, c.device_type, c.channel_group, c.country, c.event_date
"""

PRODUCT_AGG = """
  SELECT product_id, product_name, category, event_date,
    count(*) FILTER (WHERE event_type = 'page_view') AS views,
    count(*) FILTER (WHERE event_type = 'add_to_cart') AS adds_to_cart,
    count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
    cast(sum(CASE WHEN event_type = 'purchase' THEN total_amount ELSE 0 END) AS double) AS total_revenue,
    cast(sum(price) FILTER (WHERE event_type = 'purchase') AS double)
      / nullif(count(price) FILTER (WHERE event_type = 'purchase'), 0) AS avg_selling_price,
    count(DISTINCT user_id) AS unique_users
  FROM {src} WHERE product_id IS NOT NULL
  GROUP BY product_id, product_name, category, event_date"""

PRODUCT_RATES = """
  cast(round(cast(CASE WHEN views > 0 THEN adds_to_cart / views ELSE 0 END AS decimal(38,10)), 4) AS double) AS view_to_cart_rate,
  cast(round(cast(CASE WHEN adds_to_cart > 0 THEN purchases / adds_to_cart ELSE 0 END AS decimal(38,10)), 4) AS double) AS cart_to_purchase_rate,
  cast(round(cast(CASE WHEN views > 0 THEN purchases / views ELSE 0 END AS decimal(38,10)), 4) AS double) AS view_to_purchase_rate"""

PRODUCT = _ctes(f"pagg AS ({PRODUCT_AGG.format(src='clean')})") + """
SELECT *,
  cast(round(cast(CASE WHEN views > 0 THEN adds_to_cart / views ELSE 0 END AS decimal(38,10)), 4) AS double) AS view_to_cart_rate,
  cast(round(cast(CASE WHEN adds_to_cart > 0 THEN purchases / adds_to_cart ELSE 0 END AS decimal(38,10)), 4) AS double) AS cart_to_purchase_rate,
  cast(round(cast(CASE WHEN views > 0 THEN purchases / views ELSE 0 END AS decimal(38,10)), 4) AS double) AS view_to_purchase_rate
FROM pagg
"""


def _funnel(keys: str, where: str = "") -> str:
    return f"""
  SELECT {keys},
    count(DISTINCT CASE WHEN event_type = 'page_view' THEN user_id END) AS stage_1_viewers,
    count(DISTINCT CASE WHEN event_type = 'add_to_cart' THEN user_id END) AS stage_2_cart_adders,
    count(DISTINCT CASE WHEN event_type = 'checkout' THEN user_id END) AS stage_3_checkout,
    count(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS stage_4_purchasers
  FROM clean {where} GROUP BY {keys}"""


FUNNEL_RATES = """
  cast(round(cast(stage_2_cart_adders / nullif(stage_1_viewers, 0) AS decimal(38,10)), 4) AS double) AS view_to_cart_rate,
  cast(round(cast(CASE WHEN stage_2_cart_adders > 0 THEN stage_3_checkout / stage_2_cart_adders ELSE 0 END AS decimal(38,10)), 4) AS double)
    AS cart_to_checkout_rate,
  cast(round(cast(CASE WHEN stage_3_checkout > 0 THEN stage_4_purchasers / stage_3_checkout ELSE 0 END AS decimal(38,10)), 4) AS double)
    AS checkout_to_purchase_rate,
  cast(round(cast(CASE WHEN stage_1_viewers > 0 THEN stage_4_purchasers / stage_1_viewers ELSE 0 END AS decimal(38,10)), 4) AS double)
    AS overall_conversion_rate"""

FUNNEL = _ctes(f"f AS ({_funnel('event_date, channel_group, device_type')})") + \
    f"SELECT *, {FUNNEL_RATES} FROM f"

KPI_WINDOWS = _ctes("""w AS (
  SELECT *, unnest(generate_series(date_trunc('minute', event_timestamp) - INTERVAL 4 MINUTE,
                                   date_trunc('minute', event_timestamp), INTERVAL 1 MINUTE)) AS window_start
  FROM clean)""") + """
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, event_type,
  count(event_id) AS event_count, count(DISTINCT user_id) AS active_users,
  cast(sum(CASE WHEN event_type = 'purchase' THEN total_amount ELSE 0 END) AS double) AS window_revenue
FROM w GROUP BY window_start, event_type
"""

# ---------------------------------------------------------------- JSON ingest

_PAYLOAD_STR = ["event_id", "event_type", "user_id", "session_id", "timestamp", "product_id",
                "product_name", "category", "currency", "device_type", "browser", "os",
                "ip_address", "country", "city", "referrer", "utm_source", "utm_medium",
                "utm_campaign"]


def _parsed_sql() -> str:
    ok = "json_valid(value)"
    fields = [f"CASE WHEN {ok} THEN json_extract_string(value, '$.{f}') END AS \"{f}\""
              for f in _PAYLOAD_STR]
    fields.append(f"CASE WHEN {ok} THEN cast(cast(json_extract_string(value, '$.price') "
                  "AS decimal(18,2)) AS double) END AS price")
    fields.append(f"CASE WHEN {ok} THEN cast(cast(json_extract_string(value, '$.quantity') AS integer) "
                  "AS double) END AS quantity")
    body = ",\n    ".join(fields)
    return f"""(SELECT key AS kafka_key, topic AS kafka_topic, "partition" AS kafka_partition,
    "offset" AS kafka_offset, "timestamp" AS kafka_timestamp,
    {body},
    NOT {ok} AS is_corrupt,
    CASE WHEN {ok} THEN NULL ELSE value END AS corrupt_record
  FROM {FX.raw_json_sql()} j)"""


def _parsed_ctes() -> str:
    return f"""WITH p0 AS (SELECT * FROM {_parsed_sql()} p),
parsed AS (
  SELECT *, try_cast("timestamp" AS timestamp) AS event_timestamp,
         sha256(concat_ws('||', event_id, "timestamp", user_id)) AS row_hash
  FROM p0)
"""


PARSE_JSON = _parsed_ctes() + "SELECT * EXCLUDE (corrupt_record) FROM parsed"
DEAD_LETTER = _parsed_ctes() + """
SELECT event_id AS key, kafka_offset,
  concat_ws(',', CASE WHEN is_corrupt THEN 'malformed_json' END,
    CASE WHEN NOT is_corrupt AND event_id IS NULL THEN 'missing_event_id' END,
    CASE WHEN NOT is_corrupt AND event_type IS NULL THEN 'missing_event_type' END,
    CASE WHEN NOT is_corrupt AND "timestamp" IS NULL THEN 'missing_timestamp' END,
    CASE WHEN NOT is_corrupt AND "timestamp" IS NOT NULL AND event_timestamp IS NULL
         THEN 'bad_timestamp' END) AS error_reason,
  corrupt_record
FROM parsed
WHERE is_corrupt OR event_id IS NULL OR event_type IS NULL OR "timestamp" IS NULL
   OR event_timestamp IS NULL
"""
REPLAY = _parsed_ctes() + f"""SELECT * EXCLUDE (corrupt_record) FROM parsed
WHERE kafka_offset >= {FX.DUP_OFFSET_SHIFT}"""


# ---------------------------------------------------------------- change log

SHIFT = FX.DUP_OFFSET_SHIFT
BATCH = FX.BATCH_ID_SQL
COMMITTED = FX.COMMITTED_AT_SQL
CLEAN_KEYED = CLEAN_COLS + ", kafka_timestamp, kafka_offset"

# Upsert of re-deliveries (source) into originals (target): both forms must
# equal the latest row per key over all deliveries.
UPSERT_WINDOW = _ctes(chains=(("t_", f"kafka_offset < {SHIFT}"), ("s_", f"kafka_offset >= {SHIFT}"))) + f"""
SELECT {CLEAN_KEYED} FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id
                               ORDER BY kafka_timestamp DESC, kafka_offset DESC) AS rn
  FROM (SELECT * FROM t_clean UNION ALL SELECT * FROM s_clean)) WHERE rn = 1
"""
UPSERT_JOIN = _ctes(chains=(("t_", f"kafka_offset < {SHIFT}"), ("s_", f"kafka_offset >= {SHIFT}"))) + f"""
SELECT {CLEAN_KEYED} FROM t_clean t WHERE NOT EXISTS (SELECT 1 FROM s_clean s WHERE s.event_id = t.event_id)
UNION ALL
SELECT {CLEAN_KEYED} FROM s_clean
"""
AS_OF_VERSION_V = 14
AS_OF_TS = "2024-01-10 00:00:00"
AS_OF_VERSION = _ctes(chains=(("v_", f"{BATCH} <= {AS_OF_VERSION_V}"),)) + \
    f"SELECT {CLEAN_KEYED} FROM v_clean"
AS_OF_TIMESTAMP = _ctes(chains=(("v_", f"{COMMITTED} <= TIMESTAMP '{AS_OF_TS}'"),)) + \
    f"SELECT {CLEAN_KEYED} FROM v_clean"
HISTORY = f"""
SELECT {BATCH} AS batch_id, max({COMMITTED}) AS committed_at, 'MERGE' AS operation,
  cast(0 AS integer) AS generation, count(*) AS num_rows, cast(0 AS bigint) AS num_deleted,
  min(kafka_timestamp) AS first_event_time, max(kafka_timestamp) AS last_event_time
FROM {FX.raw_events_sql()} r
GROUP BY 1 ORDER BY batch_id DESC LIMIT 20
"""
ROLLBACK = AS_OF_VERSION
REPLACE_FROM = "2024-01-21"
REPLACE_FROM_MIN = _ctes(
    f"old AS ({PRODUCT_AGG.format(src='o_clean')})",
    f"new AS ({PRODUCT_AGG.format(src='clean')})",
    chains=(("o_", f"kafka_offset < {SHIFT}"),)) + f"""
SELECT *, {PRODUCT_RATES} FROM old WHERE event_date < '{REPLACE_FROM}'
UNION ALL
SELECT *, {PRODUCT_RATES} FROM new WHERE event_date >= '{REPLACE_FROM}'
"""
EVOLVE_APPEND = _ctes() + f"""
SELECT {CLEAN_COLS}, CASE WHEN {BATCH} >= 15 THEN ip_address END AS ip_address FROM clean
"""

TABLE_STATS = _ctes() + """
SELECT count(*) AS total_records, count(DISTINCT event_date) AS partitions,
  string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS event_types,
  min(event_date) AS min_date, max(event_date) AS max_date
FROM bronze
"""

# ---------------------------------------------------------------- quality


def _rule(name, level, threshold, passing, table):
    rate = f"(CASE WHEN count(*) = 0 THEN 1.0 ELSE ({passing}) / count(*) END)"
    return (f"SELECT '{name}' AS \"check\", '{level}' AS level, "
            f"cast({threshold} AS double) AS threshold, "
            f"cast(round(cast({rate} AS decimal(38,10)), 4) AS double) AS actual, {rate} >= {threshold} AS passed, "
            f"cast(NULL AS varchar) AS error, count(*) AS total_records FROM {table}")


def _broken_rule(name, level, threshold, error, table):
    return (f"SELECT '{name}' AS \"check\", '{level}' AS level, cast({threshold} AS double) AS threshold, "
            f"cast(NULL AS double) AS actual, false AS passed, '{error}' AS error, count(*) AS total_records FROM {table}")


def _nn(c):
    return f"count(*) FILTER (WHERE {c} IS NOT NULL)"


def _uq(c):
    return f"count(DISTINCT {c}) + coalesce(max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 0)"


# The rule sets of SURVEY Q6 and Q7.
DQ_BRONZE_RULES = [
    ("not_null_event_id", "CRITICAL", 1.0, _nn("event_id")),
    ("not_null_event_type", "CRITICAL", 1.0, _nn("event_type")),
    ("not_null_timestamp", "CRITICAL", 0.99, _nn('"timestamp"')),
    ("unique_event_id", "WARNING", 0.95, _uq("event_id")),
]
DQ_SILVER_RULES = [
    ("not_null_event_id", "CRITICAL", 1.0, _nn("event_id")),
    ("not_null_event_type", "CRITICAL", 1.0, _nn("event_type")),
    ("not_null_event_timestamp", "CRITICAL", 1.0, _nn("event_timestamp")),
    ("unique_event_id", "CRITICAL", 0.999, _uq("event_id")),
    ("range_price", "WARNING", 0.99, "count(*) FILTER (WHERE price BETWEEN 0 AND 100000)"),
    ("range_quantity", "WARNING", 0.99, "count(*) FILTER (WHERE quantity BETWEEN 1 AND 1000)"),
    ("allowed_values_event_type", "WARNING", 0.95,
     "count(*) FILTER (WHERE event_type IN ('page_view', 'add_to_cart', 'remove_from_cart', "
     "'checkout', 'purchase', 'search'))"),
]
DQ_BRONZE = _ctes() + "\nUNION ALL\n".join(_rule(*r, "bronze") for r in DQ_BRONZE_RULES)
DQ_SILVER = _ctes() + "\nUNION ALL\n".join(_rule(*r, "clean") for r in DQ_SILVER_RULES)
DQ_ERRORING = _ctes() + "\nUNION ALL\n".join([
    _rule("not_null_event_id", "CRITICAL", 1.0, _nn("event_id"), "clean"),
    _rule("range_user_id", "WARNING", 0.95, "count(*) FILTER (WHERE try_cast(user_id AS double) BETWEEN 0 AND 10)", "clean"),
    _broken_rule("not_null_no_such_column", "CRITICAL", 0.99, "column not found: no_such_column", "clean"),
    _broken_rule("bad_name", "WARNING", 1.0, "not evaluable: UNRESOLVED_COLUMN", "clean")])
DQ_SUMMARY = _ctes("rep AS (" + " UNION ALL ".join(_rule(*r, "clean")
                                                   for r in DQ_SILVER_RULES) + ")") + """
SELECT max(total_records) AS total_records,
  count(*) FILTER (WHERE passed) AS checks_passed,
  count(*) FILTER (WHERE NOT passed AND level = 'CRITICAL') AS checks_failed,
  count(*) FILTER (WHERE NOT passed AND level <> 'CRITICAL' AND error IS NULL) AS checks_warned,
  count(*) FILTER (WHERE NOT passed AND level = 'CRITICAL') = 0 AS overall_pass
FROM rep
"""

COMPLETENESS = _ctes() + """
SELECT event_id, data_quality_score,
  concat_ws(',', CASE WHEN event_id IS NULL THEN 'missing_event_id' END,
    CASE WHEN event_type IS NULL THEN 'missing_event_type' END,
    CASE WHEN event_timestamp IS NULL THEN 'missing_event_timestamp' END,
    CASE WHEN data_quality_score < 0.8 THEN 'low_completeness' END) AS error_reason
FROM clean
"""
CONFORM_V1 = _ctes() + "SELECT " + CLEAN_COLS.replace(
    "utm_campaign,", "cast(NULL AS varchar) AS utm_campaign,") + " FROM clean"

# ---------------------------------------------------------------- serving

FULL_RANGE = ("2024-01-01", "2024-12-31")
REVENUE_QUERY = _ctes() + f"""
SELECT strftime(date_trunc('week', event_timestamp), '%Y-%m-%d') AS event_date,
  cast(NULL AS double) AS event_hour, 'all' AS category, 'all' AS channel_group, 'all' AS country,
  cast(sum(total_amount) AS double) AS total_revenue, count(event_id) AS order_count,
  count(DISTINCT user_id) AS unique_buyers,
  cast(sum(total_amount) AS double) / count(total_amount) AS avg_order_value,
  cast(round(cast(cast(sum(total_amount) AS double) / nullif(count(DISTINCT user_id), 0) AS decimal(38,10)), 2) AS double) AS revenue_per_buyer
FROM clean
WHERE event_type = 'purchase' AND event_date BETWEEN '{FULL_RANGE[0]}' AND '{FULL_RANGE[1]}'
GROUP BY 1 ORDER BY 1 LIMIT 100
"""
SESSION_SUMMARY = _ctes("""whole AS (
  SELECT session_id, floor(epoch(max(event_timestamp))) - floor(epoch(min(event_timestamp))) AS duration
  FROM clean GROUP BY session_id)""", f"""per_date AS (
  SELECT c.session_id, c.event_date, any_value(w.duration) AS duration, count(c.event_id) AS events,
    count(*) FILTER (WHERE c.event_type = 'page_view') AS views,
    count(*) FILTER (WHERE c.event_type = 'purchase') AS purchases,
    coalesce(sum(c.total_amount) FILTER (WHERE c.event_type = 'purchase'), 0) AS revenue
  FROM clean c JOIN whole w USING (session_id)
  WHERE c.event_date BETWEEN '{FULL_RANGE[0]}' AND '{FULL_RANGE[1]}' AND c.device_type = 'mobile'
  GROUP BY c.session_id, c.event_date)""") + """
SELECT event_date, count(*) AS total_sessions,
  cast(round(cast(avg(duration) AS decimal(38,10)), 2) AS double) AS avg_session_duration,
  cast(round(cast(avg(views) AS decimal(38,10)), 2) AS double) AS avg_page_views,
  cast(round(cast(avg(CASE WHEN events = 1 THEN 1 ELSE 0 END) AS decimal(38,10)), 4) AS double) AS bounce_rate,
  cast(round(cast(avg(CASE WHEN purchases > 0 THEN 1 ELSE 0 END) AS decimal(38,10)), 4) AS double) AS conversion_rate,
  cast(round(cast(sum(revenue) AS decimal(38,10)), 2) AS double) AS total_revenue
FROM per_date GROUP BY event_date
"""
TOP_PRODUCTS = _ctes(f"pagg AS ({PRODUCT_AGG.format(src='clean')})") + f"""
SELECT product_id, product_name, category, cast(sum(views) AS bigint) AS views,
  cast(sum(purchases) AS bigint) AS purchases, cast(round(cast(sum(total_revenue) AS decimal(38,10)), 2) AS double) AS total_revenue,
  cast(round(cast(CASE WHEN sum(views) > 0 THEN sum(purchases) / sum(views) ELSE 0 END AS decimal(38,10)), 4) AS double) AS view_to_purchase_rate
FROM pagg WHERE event_date BETWEEN '{FULL_RANGE[0]}' AND '{FULL_RANGE[1]}'
GROUP BY product_id, product_name, category
ORDER BY total_revenue DESC, product_id, category, product_name LIMIT 20
"""
FUNNEL_QUERY = _ctes("f AS (" + _funnel("event_date",
    f"WHERE event_date BETWEEN '{FULL_RANGE[0]}' AND '{FULL_RANGE[1]}'") + ")") + \
    f"SELECT event_date, 'all' AS channel_group, stage_1_viewers, stage_2_cart_adders, " \
    f"stage_3_checkout, stage_4_purchasers, {FUNNEL_RATES} FROM f"
LATEST_KPIS = _ctes("""w AS (SELECT * FROM clean
  WHERE event_timestamp > (SELECT max(event_timestamp) FROM clean) - INTERVAL 5 MINUTE
    AND event_timestamp <= (SELECT max(event_timestamp) FROM clean))""") + """
SELECT count(DISTINCT user_id) AS active_users,
  count(*) / cast(300 AS double) AS events_per_second,
  cast(sum(CASE WHEN event_type = 'purchase' THEN total_amount END) AS double) AS revenue_last_window,
  count(*) FILTER (WHERE event_type = 'purchase') AS orders_last_window,
  (SELECT event_type FROM w GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1) AS top_event_type
FROM w
"""
LAYER_COUNTS = _ctes() + """
SELECT (SELECT count(*) FROM bronze) AS bronze_records, (SELECT count(*) FROM clean) AS silver_records,
  4 AS gold_tables
"""


REVENUE_QUERY_HOURLY = _ctes() + f"""
SELECT strftime(date_trunc('hour', event_timestamp), '%Y-%m-%d') AS event_date,
  cast(hour(date_trunc('hour', event_timestamp)) AS double) AS event_hour,
  'electronics' AS category, 'Paid Search' AS channel_group, 'all' AS country,
  cast(sum(total_amount) AS double) AS total_revenue, count(event_id) AS order_count,
  count(DISTINCT user_id) AS unique_buyers,
  cast(sum(total_amount) AS double) / count(total_amount) AS avg_order_value,
  cast(round(cast(cast(sum(total_amount) AS double) / nullif(count(DISTINCT user_id), 0) AS decimal(38,10)), 2) AS double) AS revenue_per_buyer
FROM clean
WHERE event_type = 'purchase' AND event_date BETWEEN '{FULL_RANGE[0]}' AND '{FULL_RANGE[1]}'
  AND category = 'electronics' AND channel_group = 'Paid Search'
GROUP BY 1, 2 ORDER BY 1, 2 LIMIT 100
"""
REVENUE_QUERY_MONTHLY = _ctes() + f"""
SELECT strftime(date_trunc('month', event_timestamp), '%Y-%m-%d') AS event_date,
  cast(NULL AS double) AS event_hour, 'all' AS category, 'all' AS channel_group, 'us' AS country,
  cast(sum(total_amount) AS double) AS total_revenue, count(event_id) AS order_count,
  count(DISTINCT user_id) AS unique_buyers,
  cast(sum(total_amount) AS double) / count(total_amount) AS avg_order_value,
  cast(round(cast(cast(sum(total_amount) AS double) / nullif(count(DISTINCT user_id), 0) AS decimal(38,10)), 2) AS double) AS revenue_per_buyer
FROM clean
WHERE event_type = 'purchase' AND event_date BETWEEN '{FULL_RANGE[0]}' AND '{FULL_RANGE[1]}'
  AND country = 'us'
GROUP BY 1 ORDER BY 1 LIMIT 100
"""
TOP_PRODUCTS_CATEGORY = _ctes(f"pagg AS ({PRODUCT_AGG.format(src='clean')})") + f"""
SELECT product_id, product_name, category, cast(sum(views) AS bigint) AS views,
  cast(sum(purchases) AS bigint) AS purchases, cast(round(cast(sum(total_revenue) AS decimal(38,10)), 2) AS double) AS total_revenue,
  cast(round(cast(CASE WHEN sum(views) > 0 THEN sum(purchases) / sum(views) ELSE 0 END AS decimal(38,10)), 4) AS double) AS view_to_purchase_rate
FROM pagg WHERE event_date BETWEEN '{FULL_RANGE[0]}' AND '{FULL_RANGE[1]}' AND category = 'clothing'
GROUP BY product_id, product_name, category
ORDER BY total_revenue DESC, product_id, category, product_name LIMIT 3
"""
FUNNEL_QUERY_CHANNEL = _ctes("f AS (" + _funnel("event_date",
    f"WHERE event_date BETWEEN '{FULL_RANGE[0]}' AND '{FULL_RANGE[1]}' "
    "AND channel_group = 'Organic Search'") + ")") + \
    f"SELECT event_date, 'Organic Search' AS channel_group, stage_1_viewers, stage_2_cart_adders, " \
    f"stage_3_checkout, stage_4_purchasers, {FUNNEL_RATES} FROM f"


SESSION_SEQUENCES = _ctes() + """
SELECT session_id, user_id, device_type, channel_group, country, event_date,
  row_number() OVER (PARTITION BY session_id, user_id, device_type, channel_group, country, event_date
                     ORDER BY event_timestamp, event_id) AS position,
  event_timestamp, event_id, event_type
FROM clean
"""


DEAD_LETTER_JSON = DEAD_LETTER.replace("SELECT event_id AS key, kafka_offset,", "SELECT *, error_reason AS reason_in_json FROM (SELECT event_id AS key, kafka_offset, kafka_key,") + ")"
REPLAY_BOUNDED = _parsed_ctes() + f"""SELECT * EXCLUDE (corrupt_record) FROM parsed
WHERE kafka_offset >= 100 AND kafka_offset < 700"""
CONFORM_REJECTS = _ctes() + "SELECT event_id, 'null_event_timestamp' AS error_reason FROM clean WHERE quantity > 3"
ZORDER_ROWS = _ctes() + """SELECT event_date, count(*) AS n, count(DISTINCT event_id) AS ids,
  cast(sum(total_amount) AS double) AS amount FROM clean GROUP BY event_date"""
REVENUE_ROLLUP = f"SELECT event_date, event_hour, category, channel_group, country, total_revenue, order_count, avg_order_value, " \
    f"true AS buyers_within_bound FROM ({REVENUE_QUERY})"


CURRENT_BUCKETS = _ctes() + f"SELECT {CLEAN_COLS} FROM clean WHERE cast(substring(event_id, 5) AS integer) % 41 <> 0"

# Three writers: day batches of the stream, two noon batches of a backfill, evening batches of the re-deliveries.
_AGAIN, _TENTH = f"kafka_offset >= {SHIFT}", "kafka_offset % 10 = 3"
WRITERS = f"""SELECT *,
    CASE WHEN {_AGAIN} THEN 'repeats' WHEN {_TENTH} THEN 'backfill' ELSE 'stream' END AS writer,
    cast(CASE WHEN {_AGAIN} THEN {BATCH} // 2 WHEN {_TENTH} THEN CASE WHEN {BATCH} >= 15 THEN 1 ELSE 0 END ELSE {BATCH} END AS integer) AS batch_no,
    CASE WHEN {_AGAIN} THEN TIMESTAMP '2024-01-01 18:00:00' + to_days(cast({BATCH} // 2 * 2 AS integer))
         WHEN {_TENTH} THEN CASE WHEN {BATCH} >= 15 THEN TIMESTAMP '2024-01-23 12:00:00' ELSE TIMESTAMP '2024-01-08 12:00:00' END
         ELSE {COMMITTED} END AS committed"""
COMMITS = """SELECT cast(row_number() OVER (ORDER BY committed_at, writer, batch_id) - 1 AS integer) AS version, * FROM (
  SELECT writer, batch_no AS batch_id, max(committed) AS committed_at, count(*) AS num_rows FROM w GROUP BY writer, batch_no)"""
HISTORY_WRITERS = f"WITH w AS ({WRITERS} FROM {FX.raw_events_sql()} r) SELECT * FROM ({COMMITS}) ORDER BY version DESC LIMIT 100"
AS_OF_VERSION_WRITERS = (
    f"WITH w AS ({WRITERS} FROM {FX.raw_events_sql()} r), commits AS ({COMMITS}),\n"
    "raw AS (SELECT w.* EXCLUDE (writer, batch_no, committed) FROM w JOIN commits c ON c.writer = w.writer AND c.batch_id = w.batch_no WHERE c.version <= 22),\n"
    + ",\n".join(_chain("", "raw")) + f"\nSELECT {CLEAN_KEYED} FROM clean")

EXACT_KPI_DAYS = _ctes() + """
SELECT date_trunc('day', event_timestamp)::timestamp AS window_start, date_trunc('day', event_timestamp)::timestamp + INTERVAL 1 DAY AS window_end, event_type,
  count(event_id) AS event_count, count(DISTINCT user_id) AS active_users,
  cast(sum(CASE WHEN event_type = 'purchase' THEN total_amount ELSE 0 END) AS double) AS window_revenue
FROM clean GROUP BY ALL"""
RECORDS_LIMITED = f"""
SELECT "partition", count(*) AS n, count(DISTINCT "offset") AS offsets, cast(sum("offset") AS bigint) AS offset_sum, true AS limit_kept
FROM {FX.raw_json_sql()} j GROUP BY 1"""
ZONE_SKIPPING = _ctes() + """
SELECT 'user' AS filter, event_id, true AS most_closed FROM clean WHERE user_id = 'user_7'
UNION ALL SELECT 'week', event_id, true FROM clean WHERE event_date BETWEEN '2024-01-08' AND '2024-01-14'"""
_WHOLE = f"SELECT * FROM {FX.raw_json_sql()} j WHERE json_valid(value)"
PAYLOAD_DRIFT = f"""
SELECT 'loyalty_tier' AS field, 'STRING' AS seen_type, cast(NULL AS varchar) AS declared_type, 'unknown' AS status, count(*) AS rows
FROM ({_WHOLE}) WHERE "offset" % 50 = 0 HAVING count(*) > 0
UNION ALL
SELECT 'session_id', 'BIGINT', 'string', 'retyped', count(*) FROM ({_WHOLE}) WHERE "offset" % 70 = 0 AND json_extract_string(value, '$.session_id') IS NOT NULL
HAVING count(*) > 0"""
UNKNOWN_FIELDS = f"SELECT \"offset\", 'gold' AS loyalty_tier, cast(1 AS bigint) AS n_unknown FROM ({_WHOLE}) WHERE \"offset\" % 50 = 0"
DQ_INCREMENTAL = f"""SELECT * REPLACE (CASE WHEN "check" LIKE 'unique%' THEN 1.0 ELSE actual END AS actual), true AS within_bound FROM ({DQ_SILVER})"""

MEDIAN_ROLLUP = _ctes() + """
SELECT strftime(date_trunc('week', event_timestamp), '%Y-%m-%d') AS event_date, cast(sum(total_amount) AS double) AS total_revenue,
  count(event_id) AS order_count, true AS median_within_bound
FROM clean WHERE event_type = 'purchase' GROUP BY 1"""
FUNNEL_ROLLUP = _ctes() + """
SELECT DISTINCT channel_group, true AS stage_1_viewers_ok, true AS stage_2_cart_adders_ok, true AS stage_3_checkout_ok, true AS stage_4_purchasers_ok,
  true AS kept_2_ok, true AS kept_3_ok, true AS kept_4_ok FROM clean"""
TOP_PRODUCTS_SKETCH = _ctes() + """
SELECT *, true AS not_too_low, true AS within_bound FROM (
  SELECT product_id, product_name, category, row_number() OVER (ORDER BY revenue DESC, product_id, category, product_name) AS rank,
    cast(revenue AS double) AS total_revenue
  FROM (SELECT product_id, product_name, category, sum(CASE WHEN event_type = 'purchase' THEN total_amount ELSE 0 END) AS revenue
        FROM clean WHERE product_id IS NOT NULL GROUP BY ALL)) WHERE rank <= 20"""


def queries() -> dict[str, str]:
    return {
        "current_buckets": CURRENT_BUCKETS,
        "as_of_version_writers": AS_OF_VERSION_WRITERS,
        "history_writers": HISTORY_WRITERS,
        "rollback_writers": AS_OF_VERSION_WRITERS,
        "median_rollup": MEDIAN_ROLLUP,
        "zone_skipping": ZONE_SKIPPING,
        "exact_kpi_days": EXACT_KPI_DAYS,
        "records_limited": RECORDS_LIMITED,
        "payload_drift": PAYLOAD_DRIFT,
        "unknown_fields": UNKNOWN_FIELDS,
        "dq_incremental": DQ_INCREMENTAL,
        "funnel_rollup": FUNNEL_ROLLUP,
        "top_products_sketch": TOP_PRODUCTS_SKETCH,
        "enrich_raw": ENRICH_RAW,
        "date_range_read": DATE_RANGE,
        "parse_json": PARSE_JSON,
        "dead_letter_split": DEAD_LETTER,
        "replay_range": REPLAY,
        "dedup_latest": DEDUP,
        "dedup_window_form": DEDUP,
        "dedup_aggregate_form": DEDUP,
        "dead_letter_json": DEAD_LETTER_JSON,
        "replay_bounded": REPLAY_BOUNDED,
        "dq_erroring": DQ_ERRORING,
        "conform_rejects": CONFORM_REJECTS,
        "kpi_chained": KPI_WINDOWS,
        "zorder_rows": ZORDER_ROWS,
        "revenue_rollup": REVENUE_ROLLUP,
        "null_defaults": NULLS,
        "standardize": STANDARDIZE,
        "derive": DERIVE,
        "quality_score": SCORE,
        "clean_all": CLEAN_ALL,
        "revenue_mart": REVENUE,
        "session_mart": SESSION,
        "session_sequences": SESSION_SEQUENCES,
        "product_mart": PRODUCT,
        "funnel_mart": FUNNEL,
        "kpi_windows": KPI_WINDOWS,
        "upsert_window_form": UPSERT_WINDOW,
        "upsert_join_form": UPSERT_JOIN,
        "as_of_version": AS_OF_VERSION,
        "as_of_timestamp": AS_OF_TIMESTAMP,
        "history": HISTORY,
        "rollback": ROLLBACK,
        "replace_from_min": REPLACE_FROM_MIN,
        "evolve_append": EVOLVE_APPEND,
        "table_stats": TABLE_STATS,
        "dq_bronze": DQ_BRONZE,
        "dq_silver": DQ_SILVER,
        "dq_summary": DQ_SUMMARY,
        "completeness_gate": COMPLETENESS,
        "conform_v1": CONFORM_V1,
        "revenue_query": REVENUE_QUERY,
        "session_summary": SESSION_SUMMARY,
        "top_products": TOP_PRODUCTS,
        "funnel_query": FUNNEL_QUERY,
        "latest_kpis": LATEST_KPIS,
        "layer_counts": LAYER_COUNTS,
        "revenue_query_hourly": REVENUE_QUERY_HOURLY,
        "revenue_query_monthly": REVENUE_QUERY_MONTHLY,
        "top_products_category": TOP_PRODUCTS_CATEGORY,
        "funnel_query_channel": FUNNEL_QUERY_CHANNEL,
    }
