"""Ledger, review, gate, quota and lookup queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions import text as T
from pagemill.operators import review
from pagemill.sources import sinks
from pagemill.sources.tables import table


def latest_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a ledger: one key for each user and kind, the event id as the order of rows."""
    events = table(spark, sf_dir, "events").select(F.concat_ws("|", "user_id", "event_type").alias("key"), F.col("event_id").alias("seq"), "value")
    return review.latest(events, "key", "seq")


LATEST_DECISION = "SELECT user_id || '|' || event_type AS key, max(event_id) AS seq, arg_max(value, event_id) AS value FROM events GROUP BY 1"


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as review items; labels as decisions, made on the present text where quality is 1."""
    items = table(spark, sf_dir, "documents").select("doc_id", "source", T.fingerprint("text").alias("fp"))
    labels = table(spark, sf_dir, "labels").join(items.select("doc_id", "fp"), "doc_id")
    decisions = labels.select("doc_id", F.when(F.col("toxic") == 1, "reject").otherwise("approve").alias("action"), F.when(F.col("quality") == 1, F.col("fp")).otherwise("older").alias("decided_fp"))
    return review.review_states(items, decisions, "doc_id", "fp")


def review_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _states(spark, sf_dir).select("doc_id", "state")


_STATES = """states AS (SELECT d.doc_id, d.source, CASE WHEN l.doc_id IS NULL THEN 'pending' WHEN l.quality = 1 THEN 'decided:' ELSE 'stale:' END
  || CASE WHEN l.doc_id IS NULL THEN '' WHEN l.toxic = 1 THEN 'reject' ELSE 'approve' END AS state FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""


def pending_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.pending_counts(_states(spark, sf_dir), "source")


PENDING = "SELECT source, count(*) FILTER (state = 'pending' OR state LIKE 'stale:%') AS pending FROM states GROUP BY source"


def export_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a source as its chapters; only those of labelled documents are up for review."""
    labelled = table(spark, sf_dir, "labels").select("doc_id")
    states = _states(spark, sf_dir).join(labelled, "doc_id")
    return review.export_gate(table(spark, sf_dir, "documents").where("lang <> 'fr'"), review.pending_counts(states, "source"), "source")


EXPORT_GATE = f"""WITH {_STATES},
p AS (SELECT source, count(*) FILTER (state LIKE 'stale:%') AS pending FROM states WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY source),
c AS (SELECT source, count(*) AS chapters FROM documents WHERE lang <> 'fr' GROUP BY source),
b AS (SELECT coalesce(c.source, p.source) AS source, coalesce(chapters, 0) AS chapters, coalesce(pending, 0) AS pending FROM c FULL JOIN p ON c.source = p.source),
r AS (SELECT *, CASE WHEN chapters = 0 THEN 'no chapters' WHEN pending > 0 THEN 'review pending' ELSE 'open' END AS reason FROM b)
SELECT *, reason = 'open' AS is_open FROM r"""


def receipt(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _states(spark, sf_dir)
    return s.groupBy("source").agg(
        F.count("*").alias("n_items"),
        F.count_if(F.col("state").startswith("decided:")).alias("decided"),
        F.count_if(F.col("state").startswith("stale:")).alias("stale"),
        F.count_if(F.col("state").endswith(":approve")).alias("approvals"),
        F.count_if(F.col("state").endswith(":reject")).alias("rejections"),
        F.count_distinct("fp").alias("texts"),
    )


RECEIPT = f"""WITH {_STATES} SELECT s.source, count(*) AS n_items, count(*) FILTER (state LIKE 'decided:%') AS decided, count(*) FILTER (state LIKE 'stale:%') AS stale,
count(*) FILTER (state LIKE '%:approve') AS approvals, count(*) FILTER (state LIKE '%:reject') AS rejections, count(DISTINCT md5(text)) AS texts FROM states s JOIN documents d USING (doc_id) GROUP BY s.source"""


def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _states(spark, sf_dir).groupBy("source", "state").agg(F.count("*").alias("n"))


def rate_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as calls of a key each; a window of an hour, as events are sparse."""
    calls = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return review.rate_window(calls, "user_id", "ts", "event_id", seconds=3600, most=2).select("event_id", "recent", "allowed")


RATE_WINDOW = "SELECT event_id, recent, recent <= 2 AS allowed FROM (SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW) AS recent FROM events)"


def daily_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.daily_quota(table(spark, sf_dir, "events"), "user_id", "ts", most=3)


DAILY_QUOTA = "SELECT user_id, ts::DATE AS day, count(*) AS calls, count(*) >= 3 AS exhausted FROM events GROUP BY 1, 2"


def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "lineitem").where("l_returnflag = 'A'").select(F.col("l_orderkey").alias("o_orderkey"))
    return review.left_to_do(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), done, "o_orderkey")


def edits_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the status and priority that the latest event of their key writes."""
    base = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    ledger = table(spark, sf_dir, "events").select((F.col("event_id") % 997).alias("o_orderkey"), "event_id", F.when(F.col("event_type") != "view", F.col("event_type")).alias("o_orderstatus"), F.when(F.col("value") > 50, F.lit("9-EDITED")).alias("o_orderpriority"))
    return review.edits_applied(base, review.latest(ledger, "o_orderkey", "event_id"), "o_orderkey", ("o_orderstatus", "o_orderpriority"))


EDITS_APPLIED = """WITH e AS (SELECT event_id % 997 AS k, max(event_id) AS event_id FROM events GROUP BY 1)
SELECT o_orderkey, coalesce(CASE WHEN event_type <> 'view' THEN event_type END, o_orderstatus) AS o_orderstatus, coalesce(CASE WHEN value > 50 THEN '9-EDITED' END, o_orderpriority) AS o_orderpriority, k IS NOT NULL AS edited
FROM orders LEFT JOIN e ON k = o_orderkey LEFT JOIN events USING (event_id)"""


def _ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.format_string("BOOK-%03d-%03d", F.col("l_suppkey"), F.col("l_linenumber")).alias("q_id"), "l_orderkey", "_metadata.file_path", "_metadata.row_index")


def lookup_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one id as they stand in the table, however many tasks read it."""
    return review.lookup(_ids(spark, sf_dir), "q_id", "7-3", ties=["file_path", "row_index"]).select("q_id", "l_orderkey")


def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.point_lookup(_ids(spark, sf_dir).select("q_id"), "q_id", "book-007-003")


_IDS = "ids AS (SELECT printf('BOOK-%03d-%03d', l_suppkey, l_linenumber) AS q_id, l_orderkey FROM lineitem)"


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.concat_ws("|", "event_type", "user_id", "event_id").alias("key"), F.when(F.col("event_id") % 3 == 0, F.lit("ent")).when(F.col("event_id") % 3 == 1, F.lit("")).alias("subject"))


def ledger_subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ledger(spark, sf_dir).select("event_id", sinks.ledger_subject().alias("owner"))


def purge_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.purged(_ledger(spark, sf_dir), "click").select("event_id", "key")


_OWNER = "CASE WHEN event_id % 3 = 0 THEN 'ENT' ELSE upper(event_type) END"


def regression_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders before and after a pass that drops some, adds some and changes two fields."""
    from pagemill.operators import fidelity

    before = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    after = before.where("o_orderkey % 13 <> 0").select(F.when(F.col("o_orderkey") % 17 == 0, -F.col("o_orderkey")).otherwise(F.col("o_orderkey")).alias("o_orderkey"), F.when(F.col("o_orderkey") % 5 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"), F.when(F.col("o_orderkey") % 7 == 0, None).otherwise(F.col("o_totalprice")).alias("o_totalprice"))
    return fidelity.regression(before, after, "o_orderkey", ("o_orderstatus", "o_totalprice"))


REGRESSION_DIFF = """WITH a AS (SELECT CASE WHEN o_orderkey % 17 = 0 THEN -o_orderkey ELSE o_orderkey END AS k, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS s, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS p FROM orders WHERE o_orderkey % 13 <> 0),
b AS (SELECT coalesce(o_orderkey, k) AS o_orderkey, CASE WHEN o_orderkey IS NULL THEN 'added' WHEN k IS NULL THEN 'removed' ELSE concat_ws(',', CASE WHEN s IS DISTINCT FROM o_orderstatus THEN 'o_orderstatus' END, CASE WHEN p IS DISTINCT FROM o_totalprice THEN 'o_totalprice' END) END AS change FROM orders FULL JOIN a ON k = o_orderkey)
SELECT * FROM b WHERE change <> ''"""

QUERIES = {
    f.__name__: f
    for f in (
        latest_decision, review_state, pending_count, export_gate, receipt, status_counts, rate_window, daily_quota, resume_pending, edits_applied,
        lookup_questions, point_lookup, ledger_subject, purge_filter, regression_diff,
    )
}
ORACLES = {
    "latest_decision": LATEST_DECISION,
    "review_state": f"WITH {_STATES} SELECT doc_id, state FROM states",
    "pending_count": f"WITH {_STATES} {PENDING}",
    "export_gate": EXPORT_GATE,
    "receipt": RECEIPT,
    "status_counts": f"WITH {_STATES} SELECT source, state, count(*) AS n FROM states GROUP BY 1, 2",
    "rate_window": RATE_WINDOW,
    "daily_quota": DAILY_QUOTA,
    "resume_pending": "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A')",
    "edits_applied": EDITS_APPLIED,
    "lookup_questions": f"WITH {_IDS} SELECT * FROM ids WHERE contains(q_id, '7-3') OR ends_with(q_id, '-007-003') ORDER BY q_id LIMIT 20",
    "point_lookup": f"WITH {_IDS} SELECT q_id FROM ids WHERE q_id = 'BOOK-007-003' LIMIT 1",
    "ledger_subject": f"SELECT event_id, {_OWNER} AS owner FROM events",
    "purge_filter": f"SELECT event_id, event_type || '|' || user_id || '|' || event_id AS key FROM events WHERE {_OWNER} <> 'CLICK'",
    "regression_diff": REGRESSION_DIFF,
}
