"""The driver's tables in the shapes that the operators take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_millis(ts: str) -> Column:
    """Milliseconds of a timestamp without time zone, rounded down; the session's time zone plays no part."""
    return F.expr(f"datediff({ts}, DATE'1970-01-01') * 86400000L + hour({ts}) * 3600000L + minute({ts}) * 60000L + cast(floor(extract(SECOND FROM {ts}) * 1000) AS bigint)")


def event_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, event_id, event_type, value, start_ms, end_ms): each event lasts ten minutes and its value in seconds."""
    start = epoch_millis("ts")
    return table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", start.alias("start_ms"), (start + 600_000 + F.floor(F.col("value") * 1000)).alias("end_ms"))


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, region_start, region_end): united sign-ups."""
    from spanframe.operators.intervals import coalesce_intervals

    found = coalesce_intervals(event_intervals(spark, sf_dir).filter("event_type = 'signup'"), ["user_id"])
    return found.select("user_id", F.col("start_ms").alias("region_start"), F.col("end_ms").alias("region_end"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_intervals(spark, sf_dir).filter("event_type IN ('click', 'view')")


#: The same relations for the SQL of the queries.
IV = "iv AS (SELECT user_id, event_id, event_type, value, epoch_us(ts) // 1000 AS start_ms, epoch_us(ts) // 1000 + 600000 + CAST(floor(value * 1000) AS BIGINT) AS end_ms FROM events)"


def union_sql(source: str, keys: str, gap: int = 0, start: str = "start_ms", end: str = "end_ms") -> str:
    return f"""SELECT {keys}, min({start}) AS {start}, max({end}) AS {end}, CAST(count(*) AS BIGINT) AS n_merged FROM (
      SELECT *, sum(opens) OVER (PARTITION BY {keys} ORDER BY {start}, {end} ROWS UNBOUNDED PRECEDING) AS island FROM (
        SELECT *, CASE WHEN {start} <= max({end}) OVER (PARTITION BY {keys} ORDER BY {start}, {end} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + ({gap}) THEN 0 ELSE 1 END AS opens FROM {source}))
    GROUP BY {keys}, island"""


REGIONS = f"""{IV}, signups AS (SELECT * FROM iv WHERE event_type = 'signup'), items AS (SELECT * FROM iv WHERE event_type IN ('click', 'view')),
  regions AS (SELECT user_id, start_ms AS region_start, end_ms AS region_end FROM ({union_sql('signups', 'user_id')})),
  clipped AS (SELECT r.user_id, region_start, region_end, greatest(region_start, start_ms) AS start_ms, least(region_end, end_ms) AS end_ms
              FROM regions r JOIN items i ON r.user_id = i.user_id AND i.start_ms < region_end AND region_start < i.end_ms),
  covered AS ({union_sql('clipped', 'user_id, region_start, region_end')}),
  stops AS (SELECT user_id, region_start, region_end, start_ms AS gap_end, end_ms AS reach FROM covered UNION ALL SELECT user_id, region_start, region_end, region_end, region_end FROM regions),
  gaps AS (SELECT * FROM (SELECT user_id, region_start, region_end, coalesce(lag(reach) OVER (PARTITION BY user_id, region_start, region_end ORDER BY gap_end, reach), region_start) AS gap_start, gap_end FROM stops) WHERE gap_start < gap_end)"""
