"""Records, their four kinds of rows, completeness, chapter ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.operators import rows
from pagemill.sources.tables import table


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record for each number of an order; what it lacks depends on its part and supplier."""
    base = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("chapter_no"), F.col("l_linenumber").alias("q_no")).agg(F.min("l_partkey").alias("p"), F.min("l_suppkey").alias("s"))
    p, s, q_no = F.col("p"), F.col("s"), F.col("q_no")
    has_q, has_k, has_s = p % 13 != 0, s % 7 != 0, s % 5 != 0
    flags = F.array_compact(F.array(F.when(s % 29 == 0, F.lit("unknown_glyph")), F.when(~has_q, F.lit("no_question_header")), F.when(~has_k, F.lit("no_key_row")), F.when(~has_s, F.lit("no_solution_header"))))
    option = lambda x: F.when(has_q, F.concat(F.lit(x), F.lit(" "), p))
    options = F.create_map(F.lit("A"), option("first"), F.lit("B"), option("second"), F.lit("C"), F.when(p % 23 != 0, option("third")), F.lit("D"), F.when(has_q & (p % 19 == 0), F.lit(" ")).otherwise(option("last")))
    pages = [F.when(has_q, 10 + q_no).alias("q_header_page"), F.when(has_k, F.lit(40)).alias("key_page"), F.when(has_s, 50 + q_no).alias("s_header_page")]
    out = base.select(
        F.lit("ORD").alias("subject"), "chapter_no", "q_no", F.when(has_q & (p % 11 != 0), F.concat(F.lit("Stem "), p)).otherwise(F.lit("")).alias("question_text"),
        F.map_filter(options, lambda _, v: v.isNotNull()).alias("options"), F.when(has_k, F.substring(F.lit("ABCD"), 1 + s % 4, F.lit(1))).otherwise(F.lit("")).alias("correct_option"),
        F.when(has_s & (p % 17 != 0), F.concat(F.lit("Because "), s)).otherwise(F.lit("")).alias("solution_text"), *pages, flags.alias("flags"),
        F.create_map(F.lit("delta_greek"), s % 3, F.lit("stray_drop"), p % 2, F.lit("unknown_glyph"), F.when(s % 29 == 0, 2).otherwise(0)).alias("glyph_fixes"),
    )
    return rows.graded(out.withColumn("source_pages", F.array_sort(F.array_compact(F.array("q_header_page", "key_page", "s_header_page")))))


_REC = """b AS (SELECT l_orderkey AS chapter_no, l_linenumber AS q_no, min(l_partkey) AS p, min(l_suppkey) AS s FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, p % 13 <> 0 AS hq, s % 7 <> 0 AS hk, s % 5 <> 0 AS hs, CASE WHEN p % 13 <> 0 AND p % 11 <> 0 THEN 'Stem ' || p ELSE '' END AS question_text,
  CASE WHEN s % 7 <> 0 THEN substr('ABCD', (1 + s % 4)::INTEGER, 1) ELSE '' END AS correct_option, CASE WHEN s % 5 <> 0 AND p % 17 <> 0 THEN 'Because ' || s ELSE '' END AS solution_text,
  p % 13 <> 0 AND p % 23 <> 0 AND p % 19 <> 0 AS four, printf('ORD-%03d-%03d', l_orderkey, q_no) AS q_id,
  [x for x in [CASE WHEN p % 13 <> 0 THEN 10 + q_no END, CASE WHEN s % 7 <> 0 THEN 40 END, CASE WHEN s % 5 <> 0 THEN 50 + q_no END] if x IS NOT NULL] AS pages FROM (SELECT *, chapter_no AS l_orderkey FROM b)),
g AS (SELECT *, CASE WHEN hq AND hk AND hs THEN 'RESOLVED_ANCHORED' ELSE 'RESOLVED' END AS q_id_grade,
  concat_ws(',', CASE WHEN NOT hq THEN 'no_question_header' END, CASE WHEN NOT hk THEN 'no_key_row' END, CASE WHEN NOT hs THEN 'no_solution_header' END, CASE WHEN s % 29 = 0 THEN 'unknown_glyph' END,
    CASE WHEN question_text = '' THEN 'missing:question_text' END, CASE WHEN NOT four THEN 'missing:options' END, CASE WHEN correct_option = '' THEN 'missing:correct_option' END, CASE WHEN solution_text = '' THEN 'missing:solution_text' END) AS qa_reasons FROM r),
rec AS (SELECT *, CASE WHEN contains(qa_reasons, 'missing:') THEN 'INCOMPLETE' WHEN qa_reasons <> '' THEN 'REVIEW_NEEDED' ELSE 'READY' END AS qa_status FROM g)"""
_JOINED = "array_to_string(pages, ',')"


def _flat(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.array_join(c, ",") for c in ("qa_reasons", "missing_fields", "source_pages") if c in df.columns})


def record_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_records(spark, sf_dir).select("q_id", "q_id_grade", "qa_status", "qa_reasons"))


def question_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rows.fan_out(_records(spark, sf_dir))["question"]
    texts = F.array_join(F.transform("options", lambda o: F.concat(o["id"], F.lit(")"), o["text"])), "/")
    return _flat(out.select("q_id", "q_id_grade", "question_text", texts.alias("options"), "question_text_prov", "extraction_status", "missing_fields", "qa_status", "source_pages"))


def answer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(rows.fan_out(_records(spark, sf_dir))["answer"].select("q_id", "correct_option", "correct_option_prov", "extraction_status", "missing_fields", "qa_status", "source_pages"))


def solution_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(rows.fan_out(_records(spark, sf_dir))["solution"].select("q_id", "solution_text", "solution_text_prov", "extraction_status", "missing_fields", "qa_reasons", "source_pages"))


def unresolved_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(rows.fan_out(_records(spark, sf_dir))["unresolved"].select("q_id", "kind", "reason", "source_pages"))


def record_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _records(spark, sf_dir).select("q_id", rows.anchors().alias("a"))
    fixes = F.array_join(F.transform(F.array_sort(F.map_entries("a.glyph_fixes")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",")
    return a.select("q_id", F.array_join(F.map_keys("a.field_provenance"), ",").alias("fields"), F.col("a.printed_question_header.page").alias("question_page"), F.col("a.printed_key_row.page").alias("key_page"),
                    F.col("a.printed_solution_header.page").alias("solution_page"), F.array_join("a.section_position.pages", ",").alias("pages"), fixes.alias("glyph_fixes"))


def chapter_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rows.completeness(_records(spark, sf_dir)).drop("subject")
    return out.withColumn("unresolved_qid_q_nos", F.array_join("unresolved_qid_q_nos", ","))


def shipped_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By status: shipped questions, and their glyph repairs but for unknown glyphs."""
    kept = _records(spark, sf_dir).where(~F.array_contains("flags", "no_question_header"))
    repairs = F.aggregate(F.map_values(F.map_filter("glyph_fixes", lambda k, _: k != "unknown_glyph")), F.lit(0).cast("long"), lambda a, x: a + x)
    return kept.groupBy("qa_status").agg(F.count("*").alias("shipped"), F.sum(repairs).alias("glyph_fix_total"))


def chapter_advisories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per hundred chapters, those whose census fails and their unresolved numbers; they lock nothing."""
    done = rows.completeness(_records(spark, sf_dir)).withColumn("part", F.floor(F.col("chapter_no") / 100).cast("long"))
    bad = F.when((F.col("unresolved_qid_count") > 0) | (F.col("rows_incomplete") > 0), F.col("chapter_no"))
    return done.groupBy("part").agg(F.array_join(F.array_sort(F.collect_list(bad)), ",").alias("census_failed_chapters"), F.sum("unresolved_qid_count").alias("unresolved_qids"))


def records_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines are question headers, key rows or solution headers of a number; a key may be doubled."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("ch"), (F.col("l_suppkey") % 5).alias("q_no"), "l_partkey", F.col("l_linenumber").alias("page"))
    kind = F.col("l_partkey") % 3
    first = lambda k, name: lines.where(kind == k).groupBy("ch", "q_no").agg(F.min("page").alias(name))
    keys = lines.where(kind == 1).select("ch", "q_no", F.substring(F.lit("abcd"), (1 + F.col("l_partkey") % 4).cast("int"), F.lit(1)).alias("letter"), F.col("page").alias("key_page"), F.struct("page", "l_partkey").alias("pos"))
    out = rows.records(first(0, "q_header_page"), keys, first(2, "s_header_page"), ["ch", "q_no"])
    return out.withColumns({c: F.array_join(c, ",") for c in ("flags", "source_pages")})


def _chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nation's suppliers as chapters; some starts fall back, some lie outside, some are equal."""
    from pyspark.sql import Window as W

    n = F.row_number().over(W.partitionBy("s_nationkey").orderBy("s_suppkey"))
    start = F.when(F.col("s_suppkey") % 6 == 0, n * 10 - 25).when(F.col("s_suppkey") % 11 == 0, n * 10 + 500).otherwise(n * 10)
    return table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("subject"), n.alias("chapter_no"), start.cast("int").alias("printed_start"))


def chapter_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.chapter_faults(_chapters(spark, sf_dir), 2, 400)


QUERIES = {f.__name__: f for f in (record_grades, question_rows, answer_rows, solution_rows, unresolved_rows, record_anchors, chapter_completeness, shipped_totals, chapter_advisories, records_assembly, chapter_ranges)}

_WITH = f"WITH {_REC}"
_STEM_MISSING = "concat_ws(',', CASE WHEN question_text = '' THEN 'question_text' END, CASE WHEN NOT four THEN 'options' END)"
ORACLES = {
    "record_grades": f"{_WITH} SELECT q_id, q_id_grade, qa_status, qa_reasons FROM rec",
    "question_rows": f"""{_WITH} SELECT q_id, q_id_grade, question_text, 'A)first ' || p || '/B)second ' || p || '/C)' || CASE WHEN p % 23 = 0 THEN '' ELSE 'third ' || p END || '/D)' || CASE WHEN p % 19 = 0 THEN ' ' ELSE 'last ' || p END AS options,
CASE WHEN question_text <> '' THEN 'TEXT_LAYER' END AS question_text_prov, CASE WHEN {_STEM_MISSING} <> '' THEN 'INCOMPLETE' ELSE 'COMPLETE' END AS extraction_status, {_STEM_MISSING} AS missing_fields, qa_status, {_JOINED} AS source_pages FROM rec WHERE hq""",
    "answer_rows": f"""{_WITH} SELECT q_id, nullif(correct_option, '') AS correct_option, CASE WHEN correct_option <> '' THEN 'TEXT_LAYER' END AS correct_option_prov, CASE WHEN correct_option = '' THEN 'INCOMPLETE' ELSE 'COMPLETE' END AS extraction_status,
CASE WHEN correct_option = '' THEN 'correct_option' ELSE '' END AS missing_fields, qa_status, {_JOINED} AS source_pages FROM rec WHERE hq""",
    "solution_rows": f"""{_WITH} SELECT q_id, solution_text, CASE WHEN solution_text <> '' THEN 'TEXT_LAYER' END AS solution_text_prov, CASE WHEN solution_text = '' THEN 'INCOMPLETE' ELSE 'COMPLETE' END AS extraction_status,
CASE WHEN solution_text = '' THEN 'solution_text' ELSE '' END AS missing_fields, qa_reasons, {_JOINED} AS source_pages FROM rec WHERE hq""",
    "unresolved_rows": f"""{_WITH} SELECT q_id, 'unresolved_qid' AS kind, CASE WHEN correct_option <> '' AND solution_text <> '' THEN 'missing_question_for_solution' WHEN solution_text <> '' THEN 'solution_q_no_not_in_printed_header'
WHEN correct_option <> '' THEN 'answer_q_no_not_in_printed_key' ELSE 'no_anchor_at_all' END AS reason, {_JOINED} AS source_pages FROM rec WHERE NOT hq""",
    "record_anchors": f"""{_WITH} SELECT q_id, concat_ws(',', CASE WHEN question_text <> '' THEN 'question_text' END, CASE WHEN hq THEN 'options' END, CASE WHEN correct_option <> '' THEN 'correct_option' END, CASE WHEN solution_text <> '' THEN 'solution_text' END) AS fields,
CASE WHEN hq THEN 10 + q_no END AS question_page, CASE WHEN hk THEN 40 END AS key_page, CASE WHEN hs THEN 50 + q_no END AS solution_page, CASE WHEN len(pages) > 0 THEN {_JOINED} END AS pages,
concat_ws(',', CASE WHEN s % 3 > 0 THEN 'delta_greek=' || s % 3 END, CASE WHEN p % 2 > 0 THEN 'stray_drop=' || p % 2 END, CASE WHEN s % 29 = 0 THEN 'unknown_glyph=2' END) AS glyph_fixes FROM rec""",
    "chapter_completeness": f"""{_WITH}, c AS (SELECT chapter_no, count(*) FILTER (hq) AS question_records, count(*) FILTER (hq AND (question_text = '' OR NOT four)) AS incomplete_questions, count(*) FILTER (hq AND correct_option = '') AS incomplete_answers,
count(*) FILTER (hq AND solution_text = '') AS incomplete_solutions, count(*) FILTER (NOT hq) AS unresolved_qid_count, coalesce(string_agg(q_no, ',' ORDER BY q_no) FILTER (NOT hq), '') AS unresolved_qid_q_nos,
count(*) FILTER (hq AND q_id_grade = 'RESOLVED_ANCHORED') AS grade_resolved_anchored, count(*) FILTER (hq AND q_id_grade = 'RESOLVED') AS grade_resolved,
count(*) FILTER (hq AND qa_status = 'INCOMPLETE') AS qa_incomplete, count(*) FILTER (hq AND qa_status = 'REVIEW_NEEDED') AS qa_review_needed, count(*) FILTER (hq AND qa_status = 'READY') AS qa_ready FROM rec GROUP BY 1)
SELECT *, incomplete_questions + incomplete_answers + incomplete_solutions AS rows_incomplete, 3 * question_records - (incomplete_questions + incomplete_answers + incomplete_solutions) AS rows_complete FROM c""",
    "shipped_totals": f"{_WITH} SELECT qa_status, count(*) AS shipped, sum(s % 3 + p % 2)::BIGINT AS glyph_fix_total FROM rec WHERE hq GROUP BY 1",
    "chapter_advisories": f"""{_WITH}, c AS (SELECT chapter_no, bool_or(NOT hq OR question_text = '' OR NOT four OR correct_option = '' OR solution_text = '') AS bad, count(*) FILTER (NOT hq) AS n FROM rec GROUP BY 1)
SELECT (chapter_no // 100)::BIGINT AS part, coalesce(string_agg(chapter_no, ',' ORDER BY chapter_no) FILTER (bad), '') AS census_failed_chapters, sum(n)::BIGINT AS unresolved_qids FROM c GROUP BY 1""",
    "records_assembly": """WITH l AS (SELECT l_orderkey AS ch, l_suppkey % 5 AS q_no, l_partkey AS p, l_linenumber AS page FROM lineitem),
a AS (SELECT ch, q_no, min(page) FILTER (p % 3 = 0) AS q_header_page, max((page, p)) FILTER (p % 3 = 1) AS k, min(page) FILTER (p % 3 = 2) AS s_header_page FROM l GROUP BY 1, 2)
SELECT ch, q_no, q_header_page, coalesce(upper(substr('abcd', (1 + k[2] % 4)::INTEGER, 1)), '') AS correct_option, k[1] AS key_page, s_header_page,
concat_ws(',', CASE WHEN q_header_page IS NULL THEN 'no_question_header' END, CASE WHEN k IS NULL THEN 'no_key_row' END, CASE WHEN s_header_page IS NULL THEN 'no_solution_header' END) AS flags,
array_to_string(list_sort(list_distinct([x for x in [q_header_page, k[1], s_header_page] if x IS NOT NULL])), ',') AS source_pages FROM a""",
    "chapter_ranges": """WITH n AS (SELECT s_nationkey AS subject, s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS n FROM supplier),
c AS (SELECT subject, n::INTEGER AS chapter_no, CASE WHEN s_suppkey % 6 = 0 THEN n * 10 - 25 WHEN s_suppkey % 11 = 0 THEN n * 10 + 500 ELSE n * 10 END::INTEGER AS printed_start FROM n),
e AS (SELECT *, printed_start + 2 AS file_start, coalesce(lead(printed_start + 2) OVER w - 1, 400) AS file_end, lag(printed_start) OVER w AS b FROM c WINDOW w AS (PARTITION BY subject ORDER BY chapter_no))
SELECT subject, chapter_no, printed_start, file_start, file_end, CASE WHEN printed_start <= b THEN 'pages not increasing' WHEN file_start NOT BETWEEN 1 AND 400 THEN 'start page outside the file' WHEN file_end < file_start THEN 'empty page range' END AS fault FROM e""",
}
