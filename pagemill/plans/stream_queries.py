"""Streaming queries over the events, drained and held against the same batch result."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.sources.tables import table
from pagemill.streaming import ledgers, pool


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledgers.read(spark, sf_dir, "events.parquet", table(spark, sf_dir, "events").schema)


def _name() -> str:
    return f"stream_{uuid.uuid4().hex}"


def stream_daily_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledgers.drained(ledgers.daily(_events(spark, sf_dir), "ts", "user_id"), "complete", _name())


def stream_latest_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = _events(spark, sf_dir).select(F.concat_ws("|", "user_id", "event_type").alias("key"), F.col("event_id").alias("seq"), "value")
    return ledgers.drained(ledgers.latest(keyed, "key", "seq", "value"), "complete", _name())


def stream_sliding_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ledgers.drained(ledgers.sliding(_events(spark, sf_dir), "ts", "event_type", "2 hours", "1 hour"), "complete", _name())
    return out.select("event_type", F.unix_seconds("start").alias("start_s"), "calls")


def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ledgers.drained(ledgers.sessions(_events(spark, sf_dir), "ts", "user_id", "30 minutes"), "complete", _name())
    return out.select("user_id", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"), "calls")


def stream_staleness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as decisions on what a user does; the item's fingerprint follows from the user, the decision's from the event."""
    keyed = F.concat_ws("|", "user_id", "event_type").alias("key")
    items = table(spark, sf_dir, "events").where("user_id % 7 <> 0").select(keyed, (F.col("user_id") % 3).alias("fp")).distinct()
    decisions = _events(spark, sf_dir).select(keyed, F.col("event_id").alias("seq"), F.when(F.col("event_id") % 2 == 0, "confirm").otherwise("edit").alias("action"), (F.col("event_id") % 3).alias("fp"))
    latest = ledgers.upserted(ledgers.judged(decisions, items, "key", "fp"), "key", "seq", _name())
    return latest.select("key", "seq", "state")


def stream_key_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as calls of twenty pools of three keys; errors are of a minute's quota, a day's, or a refused key."""
    i = F.col("event_id")
    outcome = F.when(F.col("event_type") != "error", "ok").when(i % 3 == 0, "per_minute").when(i % 7 == 0, "per_day").when(i % 11 == 0, "bad_key").otherwise("ok")
    calls = _events(spark, sf_dir).select((F.col("user_id") % 20).alias("pool"), i.alias("seq"), F.col("ts").cast("timestamp").alias("ts"), outcome.alias("outcome"))
    return ledgers.drained(pool.rotated(calls, keys=3, day=40), "append", _name())


QUERIES = {f.__name__: f for f in (stream_daily_quota, stream_latest_decision, stream_sliding_rate, stream_sessions, stream_staleness, stream_key_pool)}
ORACLES = {
    "stream_daily_quota": "SELECT user_id, ts::DATE AS day, count(*) AS calls FROM events GROUP BY 1, 2",
    "stream_latest_decision": "SELECT user_id || '|' || event_type AS key, max(event_id) AS seq, arg_max(value, event_id) AS value FROM events GROUP BY 1",
    "stream_sliding_rate": "SELECT event_type, s AS start_s, count(*) AS calls FROM (SELECT event_type, unnest([epoch_us(ts) // 3600000000 * 3600, epoch_us(ts) // 3600000000 * 3600 - 3600]) AS s FROM events) GROUP BY 1, 2",
    "stream_staleness": """SELECT key, seq, CASE WHEN u % 7 = 0 THEN 'gone' WHEN seq % 3 = u % 3 THEN 'decided:' || a ELSE 'stale:' || a END AS state FROM (
SELECT key, seq, u, CASE seq % 2 WHEN 0 THEN 'confirm' ELSE 'edit' END AS a FROM (SELECT user_id || '|' || event_type AS key, any_value(user_id) AS u, max(event_id) AS seq FROM events GROUP BY 1))""",
    "stream_sessions": """WITH f AS (SELECT user_id, epoch_us(ts) AS t, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER w < 1800000000 THEN 0 ELSE 1 END AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS k FROM f) SELECT user_id, min(t) AS start_us, max(t) + 1800000000 AS end_us, count(*) AS calls FROM s GROUP BY user_id, k""",
}
