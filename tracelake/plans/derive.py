"""Inputs the registered queries derive from the driver's tables.

* trace lines are rendered from ``events`` (every ``event_id % 10 = 3`` row becomes a stack-trace continuation
  line that the parser must reject);
* ``users(id, name)`` is ``customer(c_custkey, c_name)``;
* ``roles(user_id, role)`` is ``orders(o_custkey, o_orderpriority)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Session setting: deal the rows of ``events`` over so many tasks first (for test tables of one row group; unset: no).
SPREAD = "spark.tracelake.spread"


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt round-robin over as many tasks as the session setting ``SPREAD`` asks for; by default unchanged."""
    n = df.sparkSession.conf.get(SPREAD, None)
    return df.repartition(int(n)) if n else df


def ntz_text(ts) -> "F.Column":
    """``yyyy-MM-dd HH:mm:ss.SSS`` of a ``timestamp_ntz`` (milliseconds truncated), without any time zone.

    ``date_format`` would cast to a session-time-zone timestamp first, which shifts wall-clock times that fall
    into a daylight-saving gap. The string form of a ``timestamp_ntz`` involves no zone; it drops trailing zeros of
    the fraction (and the dot when the fraction is zero), so it is padded back to three digits and cut.
    """
    s = ts.cast("string")
    with_dot = F.when(F.length(s) == 19, F.concat(s, F.lit("."))).otherwise(s)
    return F.substring(F.rpad(with_dot, 23, "0"), 1, 23)


def trace_lines(events: DataFrame) -> DataFrame:
    """Render one trace line (column ``value``) per event, plus ``event_id`` for ordering."""
    events = spread(events)
    e = F.col
    line = F.when(e("event_id") % 10 == 3, F.concat(F.lit("  at frame "), e("event_id").cast("string"))).otherwise(
        F.concat(
            F.lit("["),
            e("user_id").cast("string"),
            F.lit("]{-1}["),
            (e("event_id") % 5).cast("string"),
            F.lit("/-1] "),
            ntz_text(e("ts")),
            F.lit(" "),
            F.substring(e("event_type"), 1, 1),
            F.lit(" "),
            F.upper(e("event_type")),
            F.lit("    "),
            e("event_type"),
            F.lit(".cpp("),
            F.format_string("%05d", e("event_id")),
            F.lit(") : value="),
            e("props"),
        )
    )
    return events.select(e("event_id"), line.alias("value"))


def users(customer: DataFrame) -> DataFrame:
    return customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))


def roles(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("o_custkey").alias("user_id"), F.col("o_orderpriority").alias("role"))
