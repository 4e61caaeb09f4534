"""Refinement audits, receipts, bundles, counts, subsets, patches, logs; chapter lines in reading order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.operators import pages, report
from pagemill.sources.tables import table


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"))


_L = "l AS (SELECT l_orderkey AS o, l_linenumber AS n, l_partkey AS p, l_suppkey AS s FROM lineitem)"
_STATUSES = ("accepted", "no_change", "skip", "rejected", "invalid", "review", "empty")


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line as a table's refinement: status, kinds of changes and reasons by part and supplier; every ninth has none."""
    p, s = F.col("p"), F.col("s")
    status = F.element_at(F.array(*map(F.lit, _STATUSES)), (p % 7 + 1).cast("int"))
    kinds = F.when(s % 9 == 0, F.lit(None)).when(s % 9 == 1, F.array()).when(s % 9 < 4, F.array(F.lit("presentation"), F.lit("presentation"))).when(s % 9 < 6, F.array(F.lit("spacing"), F.lit("presentation"))).when(s % 9 == 6, F.array(F.lit("word_restore"))).otherwise(F.array(F.lit("number_repair"), F.lit("spacing")))
    reasons = F.when(p % 5 == 0, F.array(F.lit("deletion:x:y"), F.lit("changed_number:1"))).when(p % 5 == 1, F.array(F.lit("hallucinated_addition"))).when(p % 5 == 2, F.array(F.lit("structural_change:2x2->1x1"), F.lit("other")))
    return _lines(spark, sf_dir).select((F.col("o") % 10).alias("subject"), F.concat_ws("|", (F.col("o") % 10).cast("string"), F.col("o").cast("string"), F.col("n").cast("string"), p.cast("string")).alias("key"), status.alias("status"), (s % 4 == 0).alias("cross_page"),
                                        kinds.cast("array<string>").alias("kinds"), reasons.alias("reject_reasons"), (p % 6 == 0).alias("render_findings"))


_LEDGER = f"""{_L}, r AS (SELECT o % 10 AS subject, o % 10 || '|' || o || '|' || n || '|' || p AS key, ['accepted', 'no_change', 'skip', 'rejected', 'invalid', 'review', 'empty'][p % 7 + 1] AS status, s % 4 = 0 AS cross_page,
CASE s % 9 WHEN 0 THEN [] WHEN 1 THEN [] WHEN 2 THEN ['presentation', 'presentation'] WHEN 3 THEN ['presentation', 'presentation'] WHEN 4 THEN ['spacing', 'presentation'] WHEN 5 THEN ['spacing', 'presentation'] WHEN 6 THEN ['word_restore'] ELSE ['number_repair', 'spacing'] END AS kinds, p % 5 AS why, p % 6 = 0 AS render FROM l)"""


def refinement_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.refinement_audit(_ledger(spark, sf_dir), "subject")


REFINEMENT_AUDIT = f"""WITH {_LEDGER} SELECT subject, count(*) AS total_tables, count(*) FILTER (status IN ('no_change', 'skip')) AS tables_unchanged, count(*) FILTER (status = 'accepted') AS tables_refined, count(*) FILTER (status IN ('rejected', 'invalid')) AS tables_rejected,
count(*) FILTER (status = 'review') AS tables_review, count(*) FILTER (status = 'empty') AS tables_no_answer, count(*) FILTER (status = 'accepted' AND list_contains(kinds, 'spacing')) AS spacing_repairs,
count(*) FILTER (status = 'accepted' AND list_contains(kinds, 'word_restore')) AS medical_spelling_repairs, count(*) FILTER (status = 'accepted' AND list_contains(kinds, 'number_repair')) AS number_repairs,
count(*) FILTER (status = 'accepted' AND kinds = ['presentation', 'presentation']) AS presentation_only_refinements, count(*) FILTER (cross_page) AS cross_page_tables_checked,
sum(CASE why WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 0 END)::BIGINT AS fidelity_violations, count(*) FILTER (why = 1) AS rejected_hallucinations, count(*) FILTER (why = 0) AS rejected_deletions, count(*) FILTER (why = 0) AS rejected_number_changes,
count(*) FILTER (why = 2) AS structural_rejections, count(*) FILTER (render) AS render_page_waste_issues FROM r GROUP BY 1"""


def refinement_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.corrections(_ledger(spark, sf_dir))


REFINEMENT_CORRECTIONS = f"WITH {_LEDGER}, e AS (SELECT key, (unnest(range(len(kinds))))::INTEGER AS at, unnest(kinds) AS kind FROM r WHERE status = 'accepted') SELECT * FROM e WHERE kind <> 'presentation'"


def refined_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key that has no bar belongs to no subject."""
    keys = _lines(spark, sf_dir).select(F.when(F.col("p") % 8 == 0, F.col("p").cast("string")).otherwise(F.concat((F.col("o") % 10).cast("string"), F.lit("|"), F.col("s"))).alias("key"))
    return report.refined_count(keys)


REFINED_COUNTS = f"WITH {_L} SELECT (o % 10)::VARCHAR AS subject, count(DISTINCT s) AS refined FROM l WHERE p % 8 <> 0 GROUP BY 1"


def export_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir).withColumn("subject", F.col("o") % 10)
    manifest = lines.where("p % 3 = 0 AND subject <> 4").select("subject", (F.col("p") % 50).alias("file"))
    decisions = lines.where("s % 5 = 0").select("subject", F.concat_ws("|", F.col("o"), F.col("n")).alias("key"))
    return report.receipt(lines.select("subject", "o").distinct(), manifest, decisions, lines.where("p % 11 = 0 AND subject <> 5").select("subject"), "subject")


EXPORT_RECEIPTS = f"""WITH {_L}, t AS (SELECT *, o % 10 AS subject FROM l) SELECT subject, count(DISTINCT o) AS chapters, count(DISTINCT p % 50) FILTER (p % 3 = 0 AND subject <> 4) AS images_shipped, count(DISTINCT o || '|' || n) FILTER (s % 5 = 0) AS review_decisions,
count(*) FILTER (p % 11 = 0 AND subject <> 5) AS human_edits FROM t GROUP BY 1"""


def export_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders' split files, and parts as pictures that suppliers' lines name."""
    split = table(spark, sf_dir, "orders").select(F.concat(F.lit("split/"), F.col("o_orderkey"), F.lit("/questions.jsonl")).alias("path"))
    named = _lines(spark, sf_dir).where("s % 7 = 0").select(F.concat(F.col("p"), F.lit(".webp")).alias("file"))
    there = table(spark, sf_dir, "part").where("p_size % 2 = 0").select(F.concat(F.col("p_partkey"), F.lit(".webp")).alias("file"))
    return report.bundle(split, named, there)


EXPORT_BUNDLE = f"""WITH {_L} SELECT 'split/' || o_orderkey || '/questions.jsonl' AS path, 'data' AS kind FROM orders UNION ALL
SELECT 'images/' || p_partkey || '.webp', 'asset' FROM part WHERE p_size % 2 = 0 AND p_partkey IN (SELECT p FROM l WHERE s % 7 = 0)"""


def safe_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("page_id")
    path = F.when(i % 6 == 0, F.concat(F.lit("a/../../"), i)).when(i % 6 == 1, F.concat(F.lit("/etc/"), i)).when(i % 6 == 2, F.concat(F.lit("./a//b/../"), i)).when(i % 6 == 3, F.concat(F.lit("../"), i)).when(i % 6 == 4, F.concat(F.lit("a/..b/"), i)).otherwise(F.lit("a/b/../../.."))
    return table(spark, sf_dir, "pages").select("page_id", report.is_safe(path).alias("safe"))


SAFE_PATHS = "SELECT page_id, page_id % 6 IN (2, 4) AS safe FROM pages"


def regression_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = F.when(F.col("p") % 4 == 0, F.array(F.struct((F.col("s") % 2 == 0).alias("merged_continuation")), F.struct(F.lit(True).alias("merged_continuation")))).otherwise(F.array().cast("array<struct<merged_continuation: boolean>>"))
    records = _lines(spark, sf_dir).select("o", F.when(F.col("s") % 3 == 0, "").otherwise("A").alias("correct_option"), F.when(F.col("p") % 5 == 0, " ").when(F.col("p") % 5 != 1, "text").alias("solution_text"), tables.alias("tables"))
    return report.regression_counts(records, "o")


REGRESSION_COUNTS = f"WITH {_L} SELECT o, count(*) AS questions, count(*) FILTER (s % 3 <> 0) AS answers, count(*) FILTER (p % 5 > 1) AS solutions, 2 * count(*) FILTER (p % 4 = 0) AS tables, (count(*) FILTER (p % 4 = 0) + count(*) FILTER (p % 4 = 0 AND s % 2 = 0)) AS cross_page_tables FROM l GROUP BY 1"


def chapter_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.of_chapters(_lines(spark, sf_dir), "n", "1, 3-5,,7").groupBy("n").agg(F.count("*").alias("rows"))


CHAPTER_SUBSET = f"WITH {_L} SELECT n, count(*) AS rows FROM l WHERE n IN (1, 3, 4, 5, 7) GROUP BY 1"


def edit_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    patch = F.create_map(F.lit("question_text"), F.col("p").cast("string"), F.lit("q_id"), F.lit("X"), F.when(F.col("s") % 2 == 0, "correct_option").otherwise("subject"), F.lit("B"))
    return _lines(spark, sf_dir).select("o", "n", "p", "s", F.array_join(F.map_keys(report.editable(patch)), ",").alias("fields"))


EDIT_PATCHES = f"WITH {_L} SELECT o, n, p, s, 'question_text' || CASE WHEN s % 2 = 0 THEN ',correct_option' ELSE '' END AS fields FROM l"


def log_tails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the log lines of their user's jobs, the last five of each; times as rows carry them."""
    log = table(spark, sf_dir, "events").select("user_id", "event_id", report.stamp(F.col("ts")).alias("ts"))
    return report.last_lines(log, "user_id", "event_id", 5)


LOG_TAILS = "SELECT user_id, event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) <= 5"


def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    chapters = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 20).alias("subject"), F.col("o_orderkey").alias("chapter"), F.col("o_orderstatus").alias("status"), (F.col("o_orderkey") % 7 != 0).alias("census_ok"))
    return report.run_totals(chapters, "subject", "status").withColumn("failed", F.array_join("failed", ","))


RUN_TOTALS = "SELECT o_custkey % 20 AS subject, o_orderstatus AS status, count(*) AS n, coalesce(string_agg(o_orderkey, ',' ORDER BY o_orderkey) FILTER (o_orderkey % 7 = 0), '') AS failed FROM orders GROUP BY 1, 2"


def chapter_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the pages of a range, numbered in reading order within each page."""
    lines = _lines(spark, sf_dir).select(F.col("o").alias("page"), "n", "p", (F.col("p") % 9 * 1.5).alias("y0"), (F.col("s") % 50).cast("double").alias("x0"))
    return pages.chapter_lines(lines, "page", 20, 400, ["n", "p"]).select("page", "n", "p", "at")


CHAPTER_LINES = f"WITH {_L} SELECT o AS page, n, p, row_number() OVER (PARTITION BY o ORDER BY round_even(p % 9 * 1.5 / 3, 0), s % 50, n, p)::INTEGER AS at FROM l WHERE o BETWEEN 20 AND 400"

QUERIES = {f.__name__: f for f in (refinement_audit, refinement_corrections, refined_counts, export_receipts, export_bundle, safe_paths, regression_counts, chapter_subset, edit_patches, log_tails, run_totals, chapter_lines)}
ORACLES = {name: globals()[name.upper()] for name in QUERIES}
