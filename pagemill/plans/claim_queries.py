"""Owners of figures, manifests and ledgers; table records, chains, cells and their statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.operators import claims, layout, rows, tables
from pagemill.sources.tables import table

_L = "l AS (SELECT l_orderkey AS ch, l_linenumber AS n, l_partkey AS p, l_suppkey AS s FROM lineitem)"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("ch"), F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"))


def _owned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fourth part's line is a head: of a question, the answer key (the fourth line) or a solution; the others are figures."""
    lines = _lines(spark, sf_dir)
    zone = F.when(F.col("n") < 4, "Q").when(F.col("n") == 4, "KEY").otherwise("SOL")
    heads = lines.where("p % 4 = 0").select("ch", (F.col("n") * 10).alias("pos"), zone.alias("zone"), F.col("n").alias("q_no")).distinct()
    figures = lines.where("p % 4 <> 0").select("ch", "n", "p", "s", (F.col("n") * 10 + F.col("p") % 17 - 5).alias("pos"), (F.col("n") + 100).alias("page"))
    return claims.owners(figures, heads, "ch", "pos")


_OWNED = f"""{_L}, h AS (SELECT DISTINCT ch, n * 10 AS pos, CASE WHEN n < 4 THEN 'Q' WHEN n = 4 THEN 'KEY' ELSE 'SOL' END AS zone, n AS q_no FROM l WHERE p % 4 = 0),
fig AS (SELECT *, n * 10 + p % 17 - 5 AS pos, n + 100 AS page, row_number() OVER () AS id FROM l WHERE p % 4 <> 0),
hat AS (SELECT fig.id, max(h.pos) AS hp FROM fig JOIN h ON h.ch = fig.ch AND h.pos <= fig.pos GROUP BY 1),
own AS (SELECT fig.*, CASE WHEN h.zone <> 'KEY' THEN h.zone END AS zone, CASE WHEN h.zone <> 'KEY' THEN h.q_no END AS q_no,
CASE WHEN h.zone = 'KEY' THEN 'image_in_answer_key_zone' WHEN h.zone IS NULL THEN 'image_outside_blocks' END AS reason FROM fig LEFT JOIN hat USING (id) LEFT JOIN h ON h.ch = fig.ch AND h.pos = hat.hp)"""


def figure_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _owned(spark, sf_dir).select("ch", "n", "p", "s", "zone", "q_no", "reason")


def orphan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims.orphan_rows(_owned(spark, sf_dir), "ch").withColumn("source_pages", F.array_join("source_pages", ","))


def _claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims of figures; option markers stand at places that the supplier decides, letters may come back."""
    lines = _lines(spark, sf_dir)
    markers = lines.where("n < 4 AND p % 4 = 1").groupBy("ch", F.col("n").alias("q_no"), (F.col("n") * 10 + F.col("s") % 9).alias("pos")).agg(F.min(F.substring(F.lit("abcd"), (1 + F.col("s") % 4).cast("int"), F.lit(1))).alias("letter"))
    out = claims.option_owners(_owned(spark, sf_dir).where("zone IS NOT NULL"), markers, "ch", "pos")
    name = F.concat(F.lit("f"), F.col("p") % 7, F.lit(".webp"))
    return out.select("ch", "n", "p", "s", "q_no", "kind", "letter", "page", name.alias("file"), F.when(F.col("s") % 5 == 0, -1).otherwise(F.col("p")).cast("long").alias("xref"), (F.col("s") % 3).alias("merged"), F.when(F.col("s") % 10 == 0, F.concat(F.lit("T"), F.col("s"))).alias("table_id"))


_CLAIMS = f"""{_OWNED}, mk AS (SELECT ch, n AS q_no, n * 10 + s % 9 AS pos, min(substr('abcd', (1 + s % 4)::INTEGER, 1)) AS letter FROM l WHERE n < 4 AND p % 4 = 1 GROUP BY 1, 2, 3),
mx AS (SELECT own.id, arg_max(mk.letter, mk.pos) AS letter FROM own JOIN mk ON mk.ch = own.ch AND mk.q_no = own.q_no AND mk.pos <= own.pos WHERE own.zone = 'Q' GROUP BY 1),
cl AS (SELECT own.*, CASE WHEN zone = 'SOL' THEN 'SOL' WHEN mx.letter IS NOT NULL THEN 'OPT' ELSE 'Q' END AS kind, upper(mx.letter) AS letter, 'f' || p % 7 || '.webp' AS file, CASE WHEN s % 5 = 0 THEN -1 ELSE p END AS xref, s % 3 AS merged,
CASE WHEN s % 10 = 0 THEN 'T' || s END AS table_id, printf('ORD-%03d-%03d', own.ch, own.q_no) AS q_id FROM own LEFT JOIN mx USING (id) WHERE zone IS NOT NULL)"""


def _q_id() -> object:
    return rows.q_id(F.lit("ORD"), F.col("ch"), F.col("q_no"))


def option_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _claims(spark, sf_dir).select("ch", "n", "p", "s", "q_no", "kind", "letter")


def image_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims.manifest(_claims(spark, sf_dir), _q_id()).withColumn("source_pages", F.array_join("source_pages", ","))


def files_by_slot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the page of each file's first claim in the chapter's question."""
    c = _claims(spark, sf_dir).withColumn("seq", F.struct("n", "p", "s"))
    slots = claims.files_by_slot(c, ["ch", "q_no"], "seq")
    return slots.withColumn("files", F.array_join("files", ","))


def first_file_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims.first_pages(_claims(spark, sf_dir).withColumn("seq", F.struct("ch", "n", "p", "s")), "seq")


def ownership_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims.ownership(_claims(spark, sf_dir), _q_id())


def table_renders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as table regions of two boxes a chapter; tables of some suppliers have text."""
    regions = _lines(spark, sf_dir).select("ch", (F.col("p") % 2).alias("box"), F.col("s").cast("string").alias("table_id"), "n", "p")
    structured = table(spark, sf_dir, "supplier").where("s_suppkey % 3 <> 0").select(F.col("s_suppkey").cast("string").alias("table_id"))
    return claims.renders(regions, structured, ["ch", "box"], ["n", "p", "table_id"])


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order as a logical table: its pages, warnings and suspects come from its lines."""
    listed = lambda c: F.sort_array(F.collect_list(c))
    base = _lines(spark, sf_dir).groupBy("ch").agg(
        F.sort_array(F.collect_set("n")).alias("pages"), listed(F.when(F.col("p") % 3 == 0, F.concat(F.lit("suspect_lost_space:"), F.col("p") % 11))).alias("warnings"), listed(F.when(F.col("s") % 4 == 0, F.concat(F.lit("tok"), F.col("s") % 13))).alias("suspects"),
        F.sum(F.col("p") % 2).alias("joins"), F.count_if(F.col("s") % 9 == 0).alias("llm_fixes"), F.max(F.col("p") % 5 == 0).alias("header_deduplicated"),
    )
    return tables.logical_records(base.withColumns({"table_id": F.format_string("%03d-T01", "ch"), "markdown": F.lit("")}))


def table_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _records(spark, sf_dir)
    return r.select("table_id", F.array_join("source_pages", ",").alias("source_pages"), "merged_continuation", "header_deduplicated", "extraction", F.col("validation.status").alias("status"), F.col("validation.line_joins").alias("line_joins"),
                    F.col("validation.table_qa.status").alias("qa"), F.array_join("validation.table_qa.suspect_fragments", ",").alias("suspects"), F.array_join("validation.warnings", ",").alias("warnings"), tables.is_flagged().alias("flagged"))


def table_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hundred orders are a chapter."""
    return tables.table_stats(_records(spark, sf_dir).withColumn("chapter", F.substring("table_id", 1, 2)), "chapter")


_TABLES = f"""{_L}, t AS (SELECT ch, list_sort(list(DISTINCT n)) AS pages, list_sort(list(DISTINCT 'suspect_lost_space:' || p % 11) FILTER (p % 3 = 0)) AS w, list_sort(list(DISTINCT 'tok' || s % 13) FILTER (s % 4 = 0)) AS q,
sum(p % 2)::BIGINT AS joins, count(*) FILTER (s % 9 = 0) AS fixes, bool_or(p % 5 = 0) AS dedup FROM l GROUP BY 1)"""


def shipped_table_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A supplier's lines carry tables by their number; as the part comes first, so does the table's state."""
    refs = _lines(spark, sf_dir).select(F.col("s").alias("subject"), F.col("n").alias("table_id"), (F.col("p") % 3).alias("llm_space_repairs"), F.when(F.col("p") % 2 == 0, "REVIEW").otherwise("ok").alias("qa_status"), (F.col("p") % 4 == 0).alias("in_solution"), "ch", "p")
    return tables.shipped_table_stats(refs, "subject", ["in_solution", "ch", "p"])


def table_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    firsts = _lines(spark, sf_dir).groupBy("ch", (F.col("p") % 4).alias("box")).agg(F.min(F.struct("n", "p")).alias("first_ref"))
    return tables.table_numbers(firsts, "ch", "first_ref").select("ch", "box", F.col("table_no").cast("long").alias("table_no"))


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line as a ruled box; headers, variants and columns by part and supplier."""
    p, s = F.col("p"), F.col("s")
    lines = _lines(spark, sf_dir)
    firsts = layout.dealt(lines, lines.count(), "ch").groupBy(F.col("ch").alias("subject"), F.col("n").alias("page")).agg(F.min("p").alias("p"), F.min("s").alias("s"))
    head = F.array(F.when(p % 3 == 0, "Drug").when(p % 3 == 1, "drug.").otherwise("Dose"))
    body = F.array(F.when(s % 5 == 0, "same").otherwise(p.cast("string")))
    return firsts.select("subject", "page", p.alias("y0"), (p + 300 + s % 300).alias("y1"), F.lit(842).alias("height"), F.array(F.lit(50.0), 200.0 + s % 3 * 4).alias("columns"), F.array(head, body).alias("rows")).withColumn("y0", F.col("y0") % 400)


def box_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.chains(tables.continuation(_boxes(spark, sf_dir))).select("subject", "page", "goes_on", "chain")


BOX_CHAINS = """WITH f AS (SELECT l_orderkey AS subject, l_linenumber AS page, min(l_partkey) AS p, min(l_suppkey) AS s FROM lineitem GROUP BY 1, 2),
b AS (SELECT *, p % 400 AS y0, p + 300 + s % 300 AS y1, CASE WHEN p % 3 < 2 THEN 'drug' ELSE 'dose' END AS h, CASE WHEN s % 5 = 0 THEN 'same' ELSE p::VARCHAR END AS r2, s % 3 * 4 AS c FROM f),
n AS (SELECT *, lead(page) OVER w AS np, lead(y0) OVER w AS ny, lead(h) OVER w AS nh, lead(r2) OVER w AS nr, lead(c) OVER w AS nc FROM b WINDOW w AS (PARTITION BY subject ORDER BY page)),
g AS (SELECT subject, page, CASE WHEN np = page + 1 AND abs(c - nc) <= 6 THEN CASE WHEN h = nh THEN CASE WHEN r2 <> nr THEN 'dedup' END WHEN ny <= 0.25 * 842 AND y1 >= 0.6 * 842 THEN 'keep' END END AS goes_on FROM n)
SELECT *, sum(CASE WHEN prev IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY subject ORDER BY page)::BIGINT AS chain FROM (SELECT *, lag(goes_on) OVER (PARTITION BY subject ORDER BY page) AS prev FROM g)"""
BOX_CHAINS = BOX_CHAINS.replace("SELECT *, sum", "SELECT subject, page, goes_on, sum")


def join_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seams of lines by part and supplier: what ends, what begins, and how often the words occur."""
    p, s = F.col("p"), F.col("s")
    left = F.concat(F.lit("the "), F.when(p % 7 == 0, "osteo-").when(p % 7 == 1, "end.").when(p % 7 == 2, "1,").when(p % 7 == 3, "osteo").when(p % 7 == 4, "a").when(p % 7 == 5, "").otherwise("café"))
    right = F.concat(F.when(s % 5 == 0, "calcin").when(s % 5 == 1, "000").when(s % 5 == 2, "Bone").when(s % 5 == 3, "").otherwise("étude"), F.lit(" x"))
    how = tables.join_decision(left, right, p % 4, s % 4, p % 6, s % 2 == 0)
    return _lines(spark, sf_dir).select("ch", "n", "p", "s", how.alias("how"))


JOIN_DECISIONS = f"""WITH {_L}, t AS (SELECT *, rtrim('the ' || CASE p % 7 WHEN 0 THEN 'osteo-' WHEN 1 THEN 'end.' WHEN 2 THEN '1,' WHEN 3 THEN 'osteo' WHEN 4 THEN 'a' WHEN 5 THEN '' ELSE 'café' END) AS a,
ltrim(CASE s % 5 WHEN 0 THEN 'calcin' WHEN 1 THEN '000' WHEN 2 THEN 'Bone' WHEN 3 THEN '' ELSE 'étude' END || ' x') AS b FROM l),
w AS (SELECT *, regexp_extract(a, '(\\S+)$', 1) AS x, regexp_extract(b, '^(\\S+)', 1) AS y FROM t)
SELECT ch, n, p, s, CASE WHEN ends_with(a, '-') THEN 'hyphen' WHEN ends_with(a, '.') THEN 'space'
WHEN regexp_matches(x, '^\\pL+$') AND regexp_matches(y, '^\\pL+$') AND p % 6 >= 2 AND least(p % 4, s % 4) <= 2 AND ((p % 6 >= p % 4 AND p % 6 >= s % 4) OR length(x) = 1 OR length(y) = 1) THEN 'glue'
WHEN s % 2 <> 0 THEN 'space' WHEN ends_with(a, ',') AND regexp_matches(b, '^[0-9]') THEN 'glue' WHEN regexp_matches(a, '[\\pL\\pN]$') AND regexp_matches(b, '^\\p{{Ll}}') THEN 'glue' ELSE 'space' END AS how FROM w"""


def joined_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir).select("ch", (F.col("s") % 2).alias("col"), "n", "p", F.when(F.col("p") % 9 == 0, " ").otherwise(F.concat(F.lit(" w"), F.col("p"))).alias("text"), F.when(F.col("p") % 3 == 0, "glue").when(F.col("p") % 3 == 1, "hyphen").otherwise("space").alias("how"))
    return tables.joined_cells(lines, ["ch", "col"], ["n", "p"], "text", "how")


JOINED_CELLS = f"""WITH {_L}, o AS (SELECT *, s % 2 AS col, row_number() OVER (PARTITION BY ch, s % 2 ORDER BY n, p) AS rn FROM l WHERE p % 9 <> 0)
SELECT ch, col, string_agg(CASE WHEN rn > 1 AND p % 3 = 2 THEN ' ' ELSE '' END || 'w' || p, '' ORDER BY rn) AS cell, count(*) FILTER (rn > 1 AND p % 3 <> 2)::INTEGER AS joins FROM o GROUP BY 1, 2"""


def table_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", tables.table_context(F.when(F.col("doc_id") % 3 == 0, "").when(F.col("doc_id") % 3 == 1, F.col("lang")), F.col("text")).alias("context"))
    return docs


def flagged_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).where(tables.is_flagged()).select("table_id")


QUERIES = {f.__name__: f for f in (figure_owners, orphan_rows, option_owners, image_manifest, files_by_slot, first_file_pages, ownership_ledger, table_renders, table_records, table_stats, shipped_table_stats, table_numbers, box_chains, join_decisions, joined_cells, table_contexts, flagged_tables)}
ORACLES = {
    "figure_owners": f"WITH {_OWNED} SELECT ch, n, p, s, zone, q_no, reason FROM own",
    "orphan_rows": f"WITH {_OWNED} SELECT ch, page::VARCHAR AS source_pages, 'IMAGE_CLAIM' AS pass, reason, '' AS fragment FROM own WHERE zone IS NULL",
    "option_owners": f"WITH {_CLAIMS} SELECT ch, n, p, s, q_no, kind, letter FROM cl",
    "image_manifest": f"WITH {_CLAIMS} SELECT q_id, CASE kind WHEN 'Q' THEN 'QUESTION' WHEN 'SOL' THEN 'SOLUTION' ELSE 'OPTION' END AS type, letter AS option_letter, file, page::VARCHAR AS source_pages, page AS extraction_page, table_id FROM cl",
    "files_by_slot": f"WITH {_CLAIMS} SELECT ch, q_no, kind, letter, string_agg(file, ',' ORDER BY n, p, s) AS files FROM cl GROUP BY 1, 2, 3, 4",
    "first_file_pages": f"WITH {_CLAIMS} SELECT file, arg_min(page, (ch, n, p, s)) AS page FROM cl GROUP BY 1",
    "ownership_ledger": f"""WITH {_CLAIMS} SELECT q_id AS owner, file, page, CASE kind WHEN 'OPT' THEN 'option_' || lower(letter) WHEN 'Q' THEN 'question' ELSE 'solution' END AS slot,
CASE WHEN xref = -1 AND table_id IS NOT NULL THEN 'clip render of printed table region' WHEN merged > 0 THEN 'clip render merging ' || merged || ' adjacent placements of one figure' ELSE 'xref ' || xref || ' bbox center inside block interval' END AS evidence,
'textlayer_geometry' AS method, 'high' AS confidence, 'claimed' AS outcome FROM cl""",
    "table_renders": f"WITH {_L}, r AS (SELECT ch, p % 2 AS box, s::VARCHAR AS table_id, n, p FROM l WHERE s NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 3 <> 0)) SELECT ch, box, arg_min(table_id, (n, p, table_id)) AS table_id, arg_min(n, (n, p, table_id)) AS n, arg_min(p, (n, p, table_id)) AS p FROM r GROUP BY 1, 2",
    "table_records": f"""WITH {_TABLES} SELECT printf('%03d-T01', ch) AS table_id, array_to_string(pages, ',') AS source_pages, len(pages) > 1 AS merged_continuation, dedup AS header_deduplicated, CASE WHEN fixes > 0 THEN 'ruled_grid_geometry+gemini_transcription' ELSE 'ruled_grid_geometry' END AS extraction,
CASE WHEN w IS NOT NULL THEN 'warnings' ELSE 'ok' END AS status, joins AS line_joins, CASE WHEN q IS NOT NULL THEN 'REVIEW' ELSE 'ok' END AS qa, coalesce(array_to_string(q[1:12], ','), '') AS suspects, coalesce(array_to_string(w[1:8], ','), '') AS warnings, q IS NOT NULL AS flagged FROM t""",
    "table_stats": f"""WITH {_TABLES} SELECT substr(printf('%03d-T01', ch), 1, 2) AS chapter, count(*) AS logical_tables, count(*) FILTER (len(pages) > 1) AS cross_page_merges, count(*) FILTER (dedup) AS header_dedups, sum(joins)::BIGINT AS line_joins, sum(fixes)::BIGINT AS llm_space_repairs,
count(*) FILTER (q IS NOT NULL) AS tables_qa_review, count(*) FILTER (w IS NOT NULL) AS tables_with_warnings FROM t GROUP BY 1""",
    "shipped_table_stats": f"WITH {_L}, f AS (SELECT s AS subject, n, arg_min(p, (p % 4 = 0, ch, p)) AS p FROM l GROUP BY 1, 2) SELECT subject, count(*) AS tables, count(*) FILTER (p % 3 > 0) AS llm_tables_repaired, count(*) FILTER (p % 2 = 0) AS tables_qa_review FROM f GROUP BY 1",
    "table_numbers": f"WITH {_L}, f AS (SELECT ch, p % 4 AS box, min((n, p)) AS r FROM l GROUP BY 1, 2) SELECT ch, box, dense_rank() OVER (PARTITION BY ch ORDER BY r) AS table_no FROM f",
    "box_chains": BOX_CHAINS,
    "join_decisions": JOIN_DECISIONS,
    "joined_cells": JOINED_CELLS,
    "table_contexts": "SELECT doc_id, substr(CASE doc_id % 3 WHEN 0 THEN coalesce(text, '') WHEN 1 THEN coalesce(nullif(lang, ''), text, '') ELSE coalesce(text, '') END, 1, 300) AS context FROM documents",
    "flagged_tables": f"WITH {_L} SELECT DISTINCT printf('%03d-T01', ch) AS table_id FROM l WHERE s % 4 = 0",
}
