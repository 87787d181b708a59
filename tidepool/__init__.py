"""tidepool: a Spark-native event analytics engine.

Raw JSON events (batch or stream) become a cleaned, de-duplicated,
quality-scored event table with upsert, as-of reads and rollback; from it
come revenue, session, product and funnel marts and sliding-window KPIs,
declarative quality rules, schema gates, serving queries and layout jobs.

Every operator is a ``DataFrame -> DataFrame`` function on the public
PySpark API. Nothing inside a transform triggers an action.
"""

__version__ = "0.1.0"
