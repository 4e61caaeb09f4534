"""Model answers, errors, links, spelling, spacing, breaks, memos; the verifier's plain forms and cells; key states."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.operators import proposals, review, verify
from pagemill.sources.tables import table


def answer_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as responses: with a thought before the answer, blocked, cut off, empty, or without anything."""
    turns = table(spark, sf_dir, "conversations")
    k = F.col("turn") % 5
    part = lambda text, thought: F.struct(text.alias("text"), F.lit(thought).alias("thought"))
    whole = F.to_json(F.struct(F.array(F.struct(F.struct(F.array(part(F.lit("hm"), True), part(F.concat(F.lit(" "), "text"), False)).alias("parts")).alias("content"), F.lit("STOP").alias("finishReason"))).alias("candidates")))
    body = F.when(k == 0, whole).when(k == 1, '{"candidates": [], "promptFeedback": {"blockReason": "SAFETY"}}').when(k == 2, '{"candidates": [{"content": {"parts": []}, "finishReason": "MAX_TOKENS"}]}').when(k == 3, '{"candidates": [{"content": {"parts": [{"text": " "}]}}]}').otherwise("{}")
    return turns.select("conv_id", "turn", "role", proposals.answer_text(body).alias("a")).select("conv_id", "turn", "role", F.md5("a.text").alias("text_md5"), F.col("a.reason").alias("reason"))


ANSWER_TEXTS = """SELECT conv_id, turn, role, md5(CASE WHEN turn % 5 = 0 THEN trim(text, ' ') ELSE '' END) AS text_md5, CASE turn % 5 WHEN 0 THEN CASE WHEN trim(text, ' ') <> '' THEN '' ELSE 'empty answer (finishReason=STOP)' END
WHEN 1 THEN 'no candidates returned (blockReason=SAFETY)' WHEN 2 THEN 'finishReason=MAX_TOKENS — the answer hit the output cap (thinking tokens count towards it); retrying with a bigger budget'
WHEN 3 THEN 'empty answer (finishReason=unknown)' ELSE 'no candidates returned (blockReason=none)' END AS reason FROM conversations"""


def _failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as failed calls; a body is an error in JSON, JSON of another kind, or plain text."""
    i = F.col("event_id")
    code = F.when(i % 5 == 0, 400).when(i % 5 == 1, 403).when(i % 5 == 2, 401).otherwise(404)
    message = F.concat(F.when(i % 7 == 0, "API key not valid").when(i % 7 == 1, "Quota exceeded").when(i % 7 == 2, "Unauthenticated").otherwise("model not found"), F.lit(" "), "event_type")
    body = F.when(i % 4 == 0, F.to_json(F.struct(F.struct(F.upper("event_type").alias("status"), message.alias("message")).alias("error")))).when(i % 4 == 1, F.lit('{"other": 1}')).when(i % 4 == 2, F.concat(F.lit(" "), message, F.lit(" "))).otherwise(F.lit("[1]"))
    return table(spark, sf_dir, "events").select("event_id", code.alias("code"), body.alias("body"))


_FAILURES = """f AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN 400 WHEN 1 THEN 403 WHEN 2 THEN 401 ELSE 404 END::INTEGER AS code, event_id % 4 AS k, upper(event_type) AS status,
CASE event_id % 7 WHEN 0 THEN 'API key not valid' WHEN 1 THEN 'Quota exceeded' WHEN 2 THEN 'Unauthenticated' ELSE 'model not found' END || ' ' || event_type AS message FROM events)"""


def error_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _failures(spark, sf_dir).select("event_id", proposals.error_text(F.col("code"), F.col("body")).alias("said"))


ERROR_TEXTS = f"WITH {_FAILURES} SELECT event_id, 'HTTP ' || code || CASE k WHEN 0 THEN ' ' || status || ' ' || message WHEN 1 THEN '' WHEN 2 THEN ' ' || message ELSE ' [1]' END AS said FROM f"


def key_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _failures(spark, sf_dir).select("event_id", proposals.is_key_fault(F.col("code"), F.col("body")).alias("fault"))


KEY_FAULTS = f"""WITH {_FAILURES}, b AS (SELECT *, lower(CASE k WHEN 0 THEN status || message WHEN 2 THEN message ELSE '' END) AS t FROM f)
SELECT event_id, CASE WHEN code IN (400, 401) THEN regexp_matches(t, 'api key|api_key|apikey|credential|unauthorized|unauthenticated') WHEN code = 403 THEN regexp_matches(t, 'quota|exhaust|rate|limit|permission|forbidden|api key') ELSE false END AS fault FROM b"""


def budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    cap = F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("event_id") % 70000)
    return table(spark, sf_dir, "events").select("event_id", proposals.doubled_budget(cap).alias("cap"))


BUDGETS = "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0 WHEN event_id % 70000 = 0 OR event_id % 70000 >= 65536 THEN event_id % 70000 ELSE least(2 * (event_id % 70000), 65536) END AS cap FROM events"


def download_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, ident = F.col("page_id"), F.format_string("id_%09d", "page_id")
    url = F.when(i % 4 == 0, F.concat(F.lit("https://drive.google.com/file/d/"), ident, F.lit("/view"))).when(i % 4 == 1, F.concat(F.lit("https://drive.google.com/open?usp=x&id="), ident)).when(i % 4 == 2, F.concat(F.lit("https://example.org/file/d/"), ident)).otherwise(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", proposals.download_link(url).alias("url"))


DOWNLOAD_LINKS = """SELECT page_id, CASE WHEN page_id % 4 < 2 THEN 'https://drive.google.com/uc?export=download&id=id_' || printf('%09d', page_id) WHEN page_id % 4 = 2 THEN 'https://example.org/file/d/id_' || printf('%09d', page_id) ELSE url END AS url FROM pages"""


def change_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a model says of its evidence and how sure it is."""
    i = F.col("l_partkey")
    said = F.when(i % 6 == 0, " Crop ").when(i % 6 == 1, "image+medical").when(i % 6 == 2, "Knowledge").when(i % 6 == 3, "").when(i % 6 == 4, "wrap").otherwise("hearsay")
    raw = F.when(i % 5 == 0, "true").when(i % 5 == 1, "0.98765").when(i % 5 == 2, "1").when(i % 5 == 3, "1e-1").otherwise('"high"')
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", proposals.evidence(said).alias("evidence"), proposals.confidence(raw).alias("confidence"))


CHANGE_RECORDS = """SELECT l_orderkey, l_linenumber, l_partkey, CASE l_partkey % 6 WHEN 0 THEN 'visual' WHEN 1 THEN 'visual+medical' WHEN 2 THEN 'medical' WHEN 4 THEN 'spacing' WHEN 5 THEN 'hearsay' END AS evidence,
CASE l_partkey % 5 WHEN 1 THEN 0.988 WHEN 2 THEN 1.0 WHEN 3 THEN 0.1 END::DOUBLE AS confidence FROM lineitem"""


def mid_word_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names with breaks put for a space, into a word, or both; some lose a letter."""
    name, k = F.col("p_name"), F.col("p_partkey") % 5
    inside = F.concat(F.left(name, F.lit(2)), F.lit("<br>"), F.substr(name, F.lit(3)))
    after = F.when(k == 0, F.replace(name, F.lit(" "), F.lit("<BR/>"))).when(k == 1, inside).when(k == 2, F.replace(inside, F.lit(" "), F.lit("<br />"))).when(k == 3, F.substr(inside, F.lit(2))).otherwise(F.concat(F.lit("<br>"), inside, F.lit("<br>")))
    return table(spark, sf_dir, "part").select("p_partkey", proposals.mid_word_breaks(name, after).alias("breaks"))


MID_WORD_BREAKS = "SELECT p_partkey, CASE WHEN p_partkey % 5 IN (0, 3) OR length(replace(p_name, ' ', '')) <= 2 OR regexp_matches(p_name, '^.{1,2} ') THEN 0 ELSE 1 END::INTEGER AS breaks FROM part"

_TOKENS = "tok AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS at, lower(w) AS word FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z]{3,}')) AS w, generate_subscripts(regexp_extract_all(text, '[A-Za-z]{3,}'), 1) AS i FROM documents))"


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.regexp_extract_all("text", F.lit("[A-Za-z]{3,}"), F.lit(0))).alias("at", "word"))
    return docs.select("doc_id", (F.col("at") + 1).cast("long").alias("at"), F.lower("word").alias("word"))


def spacing_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as readings of a cell; the book is all of them."""
    found = F.regexp_extract_all("text", F.lit("[A-Za-z]{3,}"), F.lit(0))
    texts = table(spark, sf_dir, "documents").select("doc_id", F.transform(found, F.lower).alias("words"))
    pairs = proposals.neighbours(texts).groupBy("w1", "w2").agg(F.count("*").alias("n"))
    vocabulary = texts.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return proposals.spacing_scores(texts, vocabulary, pairs, "doc_id")


SPACING_SCORES = f"""WITH {_TOKENS}, v AS (SELECT word, count(*) AS n FROM tok GROUP BY 1), nb AS (SELECT a.doc_id, a.word AS w1, b.word AS w2 FROM tok a JOIN tok b ON b.doc_id = a.doc_id AND b.at = a.at + 1),
p AS (SELECT w1, w2, count(*) AS n FROM nb GROUP BY 1, 2), l AS (SELECT doc_id, min(n) AS least FROM tok JOIN v USING (word) GROUP BY 1), t AS (SELECT doc_id, sum(n) AS total FROM nb JOIN p USING (w1, w2) GROUP BY 1)
SELECT doc_id, CASE WHEN least < 2 THEN -1 ELSE coalesce(total, 0) END::BIGINT AS score FROM l LEFT JOIN t USING (doc_id)"""


def harmonised_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _tokens(spark, sf_dir)
    return proposals.harmonised(words, words.groupBy("word").agg(F.count("*").alias("n")))


HARMONISED_WORDS = f"""WITH {_TOKENS}, v AS (SELECT word, count(*) AS n FROM tok GROUP BY 1)
SELECT a.word, CASE WHEN contains(a.word, 'ou') AND coalesce(b.n, 0) > a.n THEN b.word ELSE a.word END AS spelling FROM v a LEFT JOIN v b ON b.word = replace(a.word, 'ou', 'o') AND b.word <> a.word"""


def remembered_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each distinct text is asked for once; its proposal reaches every copy."""
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    asked = docs.select(F.sha1("text").alias("fp"), F.length("text").alias("proposal")).distinct()
    return proposals.remembered(docs.select("doc_id", "text"), F.col("text"), asked).select("doc_id", "fp", "proposal")


REMEMBERED_PROPOSALS = "SELECT doc_id, sha1(text) AS fp, length(text)::INTEGER AS proposal FROM documents WHERE text IS NOT NULL"


def plain_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with full-width digits and ligatures put in, which stand for plain ones."""
    text = F.concat(F.when(F.col("doc_id") % 3 == 0, "ﬁn １２ “x”—").when(F.col("doc_id") % 3 == 1, "5'-3' | →").otherwise(""), F.coalesce("text", F.lit("")))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(verify.plain(text)).alias("plain_md5"))


_WS = r"[\s\x0b\x1c-\x1f\x85\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
PLAIN_TEXTS = f"""SELECT doc_id, md5(CASE doc_id % 3 WHEN 0 THEN 'fin12“x”' WHEN 1 THEN '53' ELSE '' END || regexp_replace(translate(coalesce(text, ''), '°→Δ■"''’‘-–—|', ''), '{_WS}+', '', 'g')) AS plain_md5 FROM documents"""


def printed_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order's lines as printed ones; its cells join some of them, in order or not."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", (F.col("l_suppkey") % 2).alias("zone")).agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: (x["l_partkey"] % 20).cast("string")).alias("lines"))
    pick = F.filter("lines", lambda _, i: i % 2 == 0)
    forwards, backwards = F.array_join(pick, ""), F.array_join(F.reverse("lines"), "")
    cells = lines.where("zone = 0").select("l_orderkey", F.explode(F.array(forwards, F.when(F.col("l_orderkey") % 3 == 0, backwards).otherwise(""))).alias("cell"))
    return verify.cells_printed(cells, lines, "l_orderkey", "zone")


PRINTED_CELLS = """WITH RECURSIVE li AS (SELECT l_orderkey AS o, l_suppkey % 2 AS zone, list((l_partkey % 20)::VARCHAR ORDER BY l_linenumber, l_partkey) AS ls FROM lineitem GROUP BY 1, 2),
c AS (SELECT DISTINCT o, unnest([array_to_string([ls[i] for i in range(1, len(ls) + 1, 2)], ''), CASE WHEN o % 3 = 0 THEN array_to_string(list_reverse(ls), '') ELSE '' END]) AS cell FROM li WHERE zone = 0),
r AS (SELECT c.o, cell, zone, 0 AS i, [0::BIGINT] AS reached, ls FROM c JOIN li USING (o) WHERE cell <> ''
UNION ALL SELECT o, cell, zone, i + 1, list_distinct(list_concat(reached, [p + len(ls[i + 1]) for p in reached if substr(cell, p + 1, len(ls[i + 1])) = ls[i + 1]])), ls FROM r WHERE i < len(ls)),
f AS (SELECT o, cell, bool_or(list_contains(reached, len(cell))) AS ok FROM r GROUP BY 1, 2)
SELECT o AS l_orderkey, coalesce(min(ok), true) AS ok FROM (SELECT DISTINCT o FROM c) LEFT JOIN f USING (o) GROUP BY 1"""


def key_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as calls of twenty keys; errors are of a minute's quota, a day's, or a refused key."""
    i = F.col("event_id")
    outcome = F.when(F.col("event_type") != "error", "ok").when(i % 3 == 0, "per_minute").when(i % 11 == 0, "bad_key").when(i % 7 == 0, "per_day").otherwise("ok")
    calls = table(spark, sf_dir, "events").select((F.col("user_id") % 20).alias("key"), "event_id", "ts", outcome.alias("outcome"))
    return review.key_states(calls, "key", "ts", "event_id", "outcome", most=40).select("key", "event_id", "calls", "status")


KEY_STATES = """WITH c AS (SELECT user_id % 20 AS key, event_id, ts, CASE WHEN event_type <> 'error' THEN 'ok' WHEN event_id % 3 = 0 THEN 'per_minute' WHEN event_id % 11 = 0 THEN 'bad_key' WHEN event_id % 7 = 0 THEN 'per_day' ELSE 'ok' END AS o FROM events),
n AS (SELECT *, count(*) OVER w AS calls, bool_or(o IN ('bad_key', 'per_day')) OVER w AS spent, max(CASE WHEN o = 'per_minute' THEN ts END) OVER w AS hit FROM c WINDOW w AS (PARTITION BY key, ts::DATE ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
SELECT key, event_id, calls, CASE WHEN spent OR calls >= 40 THEN 'exhausted' WHEN ts < hit + INTERVAL 60 SECONDS THEN 'cooldown' ELSE 'active' END AS status FROM n"""

QUERIES = {f.__name__: f for f in (answer_texts, error_texts, key_faults, budgets, download_links, change_records, mid_word_breaks, spacing_scores, harmonised_words, remembered_proposals, plain_texts, printed_cells, key_states)}
ORACLES = {name: globals()[name.upper()] for name in QUERIES}
