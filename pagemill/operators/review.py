"""Append-only ledgers, review states, the export gate, quotas and resuming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """The last row of each key. A grouped maximum, combined before the shuffle; no sort of a key's rows."""
    others = [x for x in rows.columns if x != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*others), seq).alias("r")).select(key, "r.*")


def decision_key(subject: Column, q_id: Column, table_id: Column) -> Column:
    return F.concat_ws("|", subject, q_id, table_id)


def review_states(items: DataFrame, decisions: DataFrame, key: str, fp: str, reopen: bool = False) -> DataFrame:
    """``items`` with ``state``: pending, decided:action or, where the text changed since, stale:action.

    ``decisions`` has one row for each key (see ``latest``) with ``action`` and ``decided_fp``.
    With ``reopen`` a rejection counts as pending again.
    """
    joined = items.join(decisions.select(key, "action", "decided_fp"), key, "left")
    state = F.when(F.col("action").isNull() | (F.lit(reopen) & (F.col("action") == "reject")), F.lit("pending"))
    state = state.when(~F.col(fp).eqNullSafe(F.col("decided_fp")), F.concat(F.lit("stale:"), F.col("action"))).otherwise(F.concat(F.lit("decided:"), F.col("action")))
    return joined.withColumn("state", state).drop("action", "decided_fp")


def is_open(state: str = "state") -> Column:
    return (F.col(state) == "pending") | F.col(state).startswith("stale:")


def pending_counts(states: DataFrame, subject: str) -> DataFrame:
    return states.groupBy(subject).agg(F.count_if(is_open()).alias("pending"))


def export_gate(chapters: DataFrame, pending: DataFrame, subject: str, force: bool = False) -> DataFrame:
    """``subject, chapters, pending, is_open, reason`` for each subject with chapters or open items."""
    n = chapters.groupBy(subject).agg(F.count("*").alias("chapters"))
    both = n.join(pending, subject, "full_outer").select(subject, F.coalesce("chapters", F.lit(0)).alias("chapters"), F.coalesce("pending", F.lit(0)).alias("pending"))
    reason = F.when(F.col("chapters") == 0, "no chapters").when((F.col("pending") > 0) & F.lit(not force), "review pending").otherwise("open")
    return both.withColumn("reason", reason).withColumn("is_open", F.col("reason") == "open")


def rate_window(calls: DataFrame, key: str, ts: str, order: str, seconds: int = 60, most: int = 12) -> DataFrame:
    """``calls`` with ``recent``, the key's calls of the last ``seconds`` (strictly less), itself included, and ``allowed``."""
    # a day ahead of each call bounds what one task sorts; calls near midnight look back into a copy of the day before
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    rows = calls.withColumns({"_us": micros, "_day": F.floor(micros / 86_400_000_000)}).withColumn("_own", F.lit(True))
    spill = rows.where(F.pmod("_us", F.lit(86_400_000_000)) >= 86_400_000_000 - seconds * 1_000_000).withColumns({"_day": F.col("_day") + 1, "_own": F.lit(False)})
    w = W.partitionBy(key, "_day").orderBy("_us").rangeBetween(-seconds * 1_000_000 + 1, 0)
    counted = rows.unionByName(spill).withColumn("recent", F.count("*").over(w)).where("_own")
    return counted.drop("_us", "_day", "_own").withColumn("allowed", F.col("recent") <= most)


def daily_quota(calls: DataFrame, key: str, ts: str, most: int = 480) -> DataFrame:
    """``key, day, calls, exhausted``: counters that start anew each day."""
    return calls.groupBy(key, F.to_date(F.col(ts)).alias("day")).agg(F.count("*").alias("calls")).withColumn("exhausted", F.col("calls") >= most)


def left_to_do(chapters: DataFrame, done: DataFrame, key: str, force: bool = False) -> DataFrame:
    """Chapters without a mark of completeness; all of them if forced."""
    return chapters if force else chapters.join(done.select(key).distinct(), key, "left_anti")


def edits_applied(base: DataFrame, edits: DataFrame, key: str, fields: tuple[str, ...]) -> DataFrame:
    """``base`` with the fields of each key's edit in place of its own, where the edit has them, and ``edited``."""
    own = edits.select(key, *[F.col(f).alias(f"_new_{f}") for f in fields], F.lit(True).alias("_edited"))
    joined = base.join(own, key, "left")
    return joined.select(*[(F.coalesce(f"_new_{x}", x).alias(x) if x in fields else F.col(x)) for x in base.columns], F.coalesce("_edited", F.lit(False)).alias("edited"))


LOOKUP_LIMIT = 20


def lookup(rows: DataFrame, q_id: str, term: str, limit: int = LOOKUP_LIMIT, ties: Sequence[str] = ()) -> DataFrame:
    """The first ``limit`` rows, by id, that a search term means: a part of the id, or chapter-number, or a bare number. A blank term means none.

    Rows of one id come by ``ties``, without which any of them may come."""
    whole, upper = F.upper(F.col(q_id)), term.strip().upper()
    if not upper:
        return rows.where(F.lit(False))
    hit = whole.contains(upper)
    parts = upper.split("-")
    if all(p.isdigit() for p in parts) and (len(parts) == 1 or (len(parts) == 2 and max(map(len, parts)) <= 3)):
        hit = hit | whole.endswith("".join(f"-{int(p):03d}" for p in parts))
    return rows.where(hit).orderBy(q_id, *ties).limit(limit)


def point_lookup(rows: DataFrame, q_id: str, term: str) -> DataFrame:
    return rows.where(F.upper(F.col(q_id)) == term.strip().upper()).limit(1)


def key_states(calls: DataFrame, key: str, ts: str, order: str, outcome: str, most: int = 480, cooldown: int = 60) -> DataFrame:
    """``calls`` with ``calls``, the key's number of the day, and ``status`` after each: exhausted, cooldown or active.

    A key is spent for the day by its last allowed call, a refusal of the day's quota or of the key
    itself; after a refusal of the minute's quota it rests. A day starts anew. A key's day is one
    window, bounded by the quota but for calls that should not have been made.
    """
    w = W.partitionBy(key, F.to_date(ts)).orderBy(ts, order).rowsBetween(W.unboundedPreceding, 0)
    spent = F.max(F.col(outcome).isin("per_day", "bad_key")).over(w)
    rests = F.max(F.when(F.col(outcome) == "per_minute", F.col(ts))).over(w) + F.expr(f"INTERVAL {cooldown} SECONDS")
    out = calls.withColumns({"calls": F.count("*").over(w), "_spent": spent, "_rests": rests})
    return out.withColumn("status", F.when(F.col("_spent") | (F.col("calls") >= most), "exhausted").when(F.col(ts) < F.col("_rests"), "cooldown").otherwise("active")).drop("_spent", "_rests")


def key_summary(states: DataFrame, key: str, order: str) -> DataFrame:
    """``key, calls, status`` as the last state of each key has it."""
    return states.groupBy(key).agg(F.max_by(F.struct("calls", "status"), order).alias("r")).select(key, "r.*")


def whole_questions(questions: DataFrame, answers: DataFrame, solutions: DataFrame, q_id: str = "q_id") -> DataFrame:
    """Questions with their answer and solution, ids compared without case; either may be absent."""
    keyed = lambda df, name: df.select(F.upper(q_id).alias("_q"), F.struct(*[c for c in df.columns if c != q_id]).alias(name)).groupBy("_q").agg(F.first(name).alias(name))
    return questions.withColumn("_q", F.upper(q_id)).join(keyed(answers, "answer"), "_q", "left").join(keyed(solutions, "solution"), "_q", "left").drop("_q")


def tables_edited(rows: DataFrame, edits: DataFrame, key: str, tables: str = "tables") -> DataFrame:
    """``rows`` whose tables (array of structs with ``table_id`` and ``markdown``) take their edit, or go where it deletes them.

    ``edits`` are the latest for each ``key`` and ``table_id``: ``markdown``, or null to delete. A row's edits
    are gathered, few for each row; nothing is done to rows without any.
    """
    own = edits.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("table_id", F.struct("markdown").alias("e")))).alias("_e"))
    edit = lambda t: F.try_element_at(F.col("_e"), t["table_id"])
    kept = F.filter(tables, lambda t: edit(t).isNull() | edit(t)["markdown"].isNotNull())
    changed = F.transform(kept, lambda t: t.withField("markdown", F.coalesce(edit(t)["markdown"], t["markdown"])))
    return rows.join(own, key, "left").withColumn(tables, F.when(F.col("_e").isNull(), F.col(tables)).otherwise(changed)).drop("_e")


def pages_to_crop(tables: DataFrame, done: DataFrame, subject: str) -> DataFrame:
    """``subject, page``: pages of flagged tables that have no crop yet, each once."""
    wanted = tables.select(subject, F.explode("source_pages").alias("page")).distinct()
    return wanted.join(done.select(subject, "page").distinct(), [subject, "page"], "left_anti")


def upload_faults(files: DataFrame, content: str, most_bytes: int = 400 << 20) -> DataFrame:
    """``files`` with ``fault``: null, or why one is no book."""
    head = F.decode(F.substring(content, 1, 5), "ISO-8859-1")
    return files.withColumn("fault", F.when(F.octet_length(content) > most_bytes, "too large").when(head != "%PDF-", "no PDF"))
