"""The reviewer's desk and the verifier's zones: joined questions, edited tables, crops, uploads, caches, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.operators import proposals, review, rows, tables, verify
from pagemill.plans import proposal_queries
from pagemill.sources import sinks
from pagemill.sources import tables as sources
from pagemill.sources.tables import table

_L = "l AS (SELECT l_orderkey AS o, l_linenumber AS n, l_partkey AS p, l_suppkey AS s FROM lineitem)"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"))


def _zoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line's part makes it a header of some kind, an option or prose."""
    k, s = F.col("p") % 9, F.col("s").cast("string")
    text = (
        F.when(k == 0, F.concat(F.lit("Question "), s, F.lit(":"))).when(k == 1, "answer key").when(k == 2, F.concat(F.lit("Solution to Question "), s, F.lit(" :"))).when(k == 3, F.concat(F.lit("a) one "), s))
        .when(k == 4, F.concat(s, F.lit(" b"))).when(k == 5, "Detailed Explanations").otherwise(F.concat(F.lit("it's "), s, F.lit("-fold")))
    )
    return verify.zones(_lines(spark, sf_dir).withColumn("text", text), "o", ["n", "p", "s"], "text")


_ZONED = f"""{_L}, t AS (SELECT *, p % 9 AS k, row_number() OVER (PARTITION BY o ORDER BY n, p, s) AS rn FROM l), f AS (SELECT o, min(rn) FILTER (k = 1) AS key FROM t GROUP BY 1), g AS (SELECT o, min(rn) AS sol FROM t JOIN f USING (o) WHERE k = 2 AND rn > key GROUP BY 1),
z AS (SELECT t.*, CASE WHEN key IS NULL OR rn < key THEN 'Q' WHEN sol IS NULL OR rn < sol THEN 'K' ELSE 'S' END AS zone FROM t JOIN f USING (o) LEFT JOIN g USING (o) WHERE key IS NULL OR rn <> key)"""


def verifier_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zoned(spark, sf_dir).select("o", "n", "p", "s", "zone")


VERIFIER_ZONES = f"WITH {_ZONED} SELECT o, n, p, s, zone FROM z"


def verifier_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.zone_texts(_zoned(spark, sf_dir), "o", ["n", "p", "s"], "text")


VERIFIER_TEXTS = f"WITH {_ZONED} SELECT o, zone, string_agg(CASE WHEN k = 3 THEN 'one' || s ELSE 'its' || s || 'fold' END, '' ORDER BY rn) AS printed FROM z WHERE k = 3 OR k > 5 OR (k = 4 AND s > 999) GROUP BY 1, 2"
VERIFIER_TEXTS = VERIFIER_TEXTS.replace("CASE WHEN k = 3 THEN", "CASE WHEN k = 4 THEN s || 'b' WHEN k = 3 THEN")


def key_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    outcome = F.when(F.col("event_type") != "error", "ok").when(i % 3 == 0, "per_minute").when(i % 11 == 0, "bad_key").when(i % 7 == 0, "per_day").otherwise("ok")
    calls = table(spark, sf_dir, "events").select((F.col("user_id") % 20).alias("key"), "event_id", "ts", outcome.alias("outcome"))
    states = review.key_states(calls, "key", "ts", "event_id", "outcome", most=40)
    return review.key_summary(states.withColumn("at", F.struct("ts", "event_id")), "key", "at")


KEY_SUMMARY = f"WITH s AS ({proposal_queries.KEY_STATES.replace('SELECT key, event_id, calls,', 'SELECT key, event_id, ts, calls,')}) SELECT key, arg_max(calls, (ts, event_id)) AS calls, arg_max(status, (ts, event_id)) AS status FROM s GROUP BY 1"


def joined_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as questions; some have an answer or a solution, under ids of other case."""
    orders = table(spark, sf_dir, "orders")
    ident = rows.q_id(F.lit("ord"), F.lit(1), F.col("o_orderkey"))
    answers = orders.where("o_custkey % 3 = 0").select(F.upper(ident).alias("q_id"), F.col("o_orderstatus").alias("letter"))
    solutions = orders.where("o_custkey % 4 = 0").select(ident.alias("q_id"), F.col("o_orderpriority").alias("text"))
    out = review.whole_questions(orders.select(ident.alias("q_id"), "o_orderkey"), answers, solutions)
    return out.select("q_id", "o_orderkey", F.col("answer.letter").alias("letter"), F.col("solution.text").alias("solution"))


JOINED_QUESTIONS = "SELECT printf('ord-001-%03d', o_orderkey) AS q_id, o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN o_orderstatus END AS letter, CASE WHEN o_custkey % 4 = 0 THEN o_orderpriority END AS solution FROM orders"


def edited_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order's lines as its tables; some are edited, some deleted."""
    lines = _lines(spark, sf_dir).groupBy("o", "n").agg(F.min("p").alias("p"))
    base = lines.groupBy("o").agg(F.array_sort(F.collect_list(F.struct(F.col("n").alias("table_id"), F.col("p").cast("string").alias("markdown")))).alias("tables"))
    edits = lines.where("p % 4 < 2").select("o", F.col("n").alias("table_id"), F.when(F.col("p") % 4 == 0, F.concat(F.lit("new "), "p")).alias("markdown"))
    out = review.tables_edited(base, edits, "o")
    return out.select("o", F.array_join(F.transform("tables", lambda t: F.concat_ws(":", t["table_id"].cast("string"), t["markdown"])), ",").alias("tables"))


EDITED_TABLES = f"WITH {_L}, g AS (SELECT o, n, min(p) AS p FROM l GROUP BY 1, 2) SELECT o, coalesce(string_agg(n || ':' || CASE WHEN p % 4 = 0 THEN 'new ' ELSE '' END || p, ',' ORDER BY n) FILTER (p % 4 <> 1), '') AS tables FROM g GROUP BY 1"


def pages_to_crop(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir).withColumn("subject", F.col("o") % 10)
    flagged = lines.where("s % 4 = 0").select("subject", F.array(F.col("p") % 300, F.col("p") % 300 + 1).alias("source_pages"))
    return review.pages_to_crop(flagged, lines.where("s % 5 = 0").select("subject", (F.col("p") % 300).alias("page")), "subject")


PAGES_TO_CROP = f"""WITH {_L}, w AS (SELECT DISTINCT o % 10 AS subject, unnest([p % 300, p % 300 + 1]) AS page FROM l WHERE s % 4 = 0)
SELECT * FROM w WHERE (subject, page) NOT IN (SELECT (o % 10, p % 300) FROM l WHERE s % 5 = 0)"""


def upload_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as uploads, some with a book's first bytes; a small bound."""
    body = F.concat(F.when(F.col("page_id") % 3 == 0, "%PDF-").otherwise(""), F.coalesce("html", F.lit("")))
    return review.upload_faults(table(spark, sf_dir, "pages").select("page_id", body.cast("binary").alias("content")), "content", 1500).select("page_id", "fault")


UPLOAD_FAULTS = "SELECT page_id, CASE WHEN strlen(coalesce(html, '')) + CASE WHEN page_id % 3 = 0 THEN 5 ELSE 0 END > 1500 THEN 'too large' WHEN page_id % 3 <> 0 AND NOT starts_with(coalesce(html, ''), '%PDF-') THEN 'no PDF' END AS fault FROM pages"


def cached_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests by model, page and content; a response is kept for some of them, under the digest of the request."""
    request = F.concat_ws("|", F.lit("table"), F.lit("m1"), F.col("o").cast("string"), F.col("n").cast("string"), F.col("p").cast("string"))
    asked = _lines(spark, sf_dir).select("o", "n", "p", request.alias("request"))
    kept = asked.where("p % 3 = 0").select(F.sha1("request").alias("fp"), (F.col("p") * 2).alias("proposal")).distinct()
    return proposals.remembered(asked, F.col("request"), kept).select("o", "n", "p", "fp", "proposal")


CACHED_RESPONSES = f"WITH {_L} SELECT o, n, p, sha1(concat_ws('|', 'table', 'm1', o, n, p)) AS fp, CASE WHEN p % 3 = 0 THEN p * 2 END AS proposal FROM l"


def bare_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(proposals.content(F.col("text"))).alias("content_md5"))


BARE_CONTENTS = f"SELECT doc_id, md5(lower(regexp_replace(coalesce(text, ''), '{proposal_queries._WS}+', '', 'g'))) AS content_md5 FROM documents"


def registered_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as registered books; some are registered again, a few twice."""
    old = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 7).alias("subject"), F.col("s_suppkey").alias("seq"), "s_name")
    old = sinks.upsert(old.limit(0), old, "subject", "seq")
    new = table(spark, sf_dir, "customer").where("c_custkey % 5 < 3").select((F.col("c_custkey") % 10).alias("subject"), (F.col("c_custkey") + 100000).alias("seq"), F.col("c_name").alias("s_name"))
    return sinks.upsert(old, new, "subject", "seq")


REGISTERED_BOOKS = """WITH e AS (SELECT s_suppkey % 7 AS subject, s_suppkey AS seq, s_name FROM supplier UNION ALL SELECT c_custkey % 10, c_custkey + 100000, c_name FROM customer WHERE c_custkey % 5 < 3)
SELECT subject, max(seq) AS seq, arg_max(s_name, seq) AS s_name FROM e GROUP BY 1"""


def output_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    roots = _lines(spark, sf_dir).select((F.col("s") % 30).alias("subject"), (F.col("o") * 100_000_000 + F.col("n") * 10_000_000 + F.col("p")).alias("root_order"))
    return sources.first_root(roots, "subject", "root_order")


OUTPUT_ROOTS = f"WITH {_L} SELECT s % 30 AS subject, min(o * 100000000 + n * 10000000 + p) AS root_order FROM l GROUP BY 1"


def table_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The regions of a question that are its table's, questions before solutions."""
    lines = _lines(spark, sf_dir)
    regions = lines.where("p % 2 = 0").select("o", (F.col("p") % 5).alias("table_id"), "n").unionByName(lines.where("p % 2 = 1").select("o", (F.col("p") % 5).alias("table_id"), (F.col("n") + 100).alias("n")))
    wanted = lines.groupBy("o").agg(F.min(F.col("s") % 5).alias("table_id"))
    return tables.regions_of(regions, wanted, ["o", "table_id"], "n").withColumn("regions", F.array_join("regions", ","))


TABLE_REGIONS = f"""WITH {_L}, w AS (SELECT o, min(s % 5) AS table_id FROM l GROUP BY 1), r AS (SELECT o, p % 5 AS table_id, CASE WHEN p % 2 = 0 THEN n ELSE n + 100 END AS n FROM l)
SELECT w.o, w.table_id, coalesce(string_agg(n, ',' ORDER BY n), '') AS regions FROM w LEFT JOIN r ON r.o = w.o AND r.table_id = w.table_id GROUP BY 1, 2"""

QUERIES = {f.__name__: f for f in (verifier_zones, verifier_texts, key_summary, joined_questions, edited_tables, pages_to_crop, upload_faults, cached_responses, bare_contents, registered_books, output_roots, table_regions)}
ORACLES = {name: globals()[name.upper()] for name in QUERIES}
