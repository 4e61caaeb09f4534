"""Baselines, footers, fonts, spans, chapter scans, key and contents rows, titles, grids, table membership."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.operators import boxes, pages
from pagemill.sources.tables import table


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"))


_L = "l AS (SELECT l_orderkey AS page, l_linenumber AS n, l_partkey AS p, l_suppkey AS s FROM lineitem)"


def baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tops are multiples of a point and a half, so every second one lies between two baselines."""
    lines = _lines(spark, sf_dir).select("page", "n", "p", (F.col("p") % 9 * 1.5).alias("y0"), (F.col("s") % 50).cast("double").alias("x0"))
    out = pages.baselines(lines, "page", ["n", "p"])
    return out.select("page", "bucket", F.round("y", 6).alias("y"), F.array_join(F.transform("lines", lambda x: x["p"].cast("string")), ",").alias("parts"))


BASELINES = f"""WITH {_L} SELECT page, round_even(p % 9 * 1.5 / 3, 0)::BIGINT AS bucket, round(avg(p % 9 * 1.5), 6)::DOUBLE AS y, string_agg(p, ',' ORDER BY s % 50, n, p) AS parts FROM l GROUP BY 1, 2"""


def footer_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third line is its page's printed number; the half of them that stand low are footers."""
    lines = _lines(spark, sf_dir).withColumns({"text": F.when(F.col("p") % 3 == 0, F.concat(F.lit(" "), F.col("page") - 2, F.lit(" "))).otherwise(F.col("p").cast("string")), "y1": F.col("s") % 100 * 8.42})
    foot = pages.is_footer(F.col("text"), F.col("page") - 2, F.col("y1"), F.lit(842.0))
    return lines.groupBy("page").agg(F.count_if(~foot).alias("kept"), F.count_if(foot).alias("footers"))


FOOTER_SPLIT = f"WITH {_L} SELECT page, count(*) FILTER (NOT f) AS kept, count(*) FILTER (f) AS footers FROM (SELECT page, (p % 3 = 0 OR p = page - 2) AND s % 100 * 8.42::DOUBLE > 842.0::DOUBLE * 0.88::DOUBLE AS f FROM l) GROUP BY 1"


def span_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = _lines(spark, sf_dir).select("page", F.struct("n", "p").alias("o"), (F.col("p") % 500).cast("double").alias("x0"), (F.col("p") % 500 + F.col("s") % 90).cast("double").alias("x1"), F.when(F.col("s") % 9 == 0, F.lit(" ")).otherwise(F.concat(F.lit("a"), F.col("p"), F.lit(" "))).alias("text"))
    return pages.clusters(spans, "page", "o", "text").withColumn("cluster", F.col("cluster").cast("long"))


SPAN_CLUSTERS = f"""WITH RECURSIVE {_L}, o AS (SELECT page, row_number() OVER (PARTITION BY page ORDER BY p % 500, n, p) AS rn, (p % 500)::DOUBLE AS x0, (p % 500 + s % 90)::DOUBLE AS x1, 'a' || p || ' ' AS text FROM l WHERE s % 9 <> 0),
r AS (SELECT page, rn, 0::BIGINT AS cluster, x0, x1, x1 AS edge, text FROM o WHERE rn = 1
UNION ALL SELECT o.page, o.rn, r.cluster + CASE WHEN o.x0 - r.edge > 22 THEN 1 ELSE 0 END, o.x0, o.x1, CASE WHEN o.x0 - r.edge > 22 THEN o.x1 ELSE greatest(r.edge, o.x1) END, o.text FROM r JOIN o ON o.page = r.page AND o.rn = r.rn + 1)
SELECT page, cluster, min(x0) AS x0, max(x1) AS x1, trim(string_agg(text, '' ORDER BY rn)) AS cell FROM r GROUP BY 1, 2"""


def word_fonts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as spans, and words that are shifted from them; some characters stand for others in two fonts."""
    lines = _lines(spark, sf_dir)
    font = F.when(F.col("s") % 3 == 0, "SymbolMT").when(F.col("s") % 3 == 1, "AdobePiStd").otherwise("Times")
    x0, y0 = (F.col("p") % 60).cast("double"), (F.col("n") % 3 * 10).cast("double")
    spans = lines.select("page", (F.col("n") * 10_000_000 + F.col("p")).alias("span"), x0.alias("x0"), (x0 + 20).alias("x1"), y0.alias("y0"), (y0 + 8).alias("y1"), font.alias("font"))
    words = lines.select("page", "n", "p", (x0 + F.col("s") % 40).alias("x0"), (x0 + F.col("s") % 40 + 6).alias("x1"), (y0 + F.col("p") % 5).alias("y0"), F.concat(F.lit("5°■"), F.col("p")).alias("text")).distinct()
    out = pages.word_fonts(words, spans, "page", ["n", "p", "x0", "y0"], "span")
    return out.select("page", "n", "p", "x0", "y0", "font", F.when(F.col("font").isNull(), F.col("text")).otherwise(pages.tagged(F.col("text"), F.col("font"))).alias("text"))


WORD_FONTS = f"""WITH {_L}, sp AS (SELECT page, n * 10000000 + p AS span, (p % 60)::DOUBLE AS x0, (n % 3 * 10)::DOUBLE AS y0, CASE s % 3 WHEN 0 THEN 'SymbolMT' WHEN 1 THEN 'AdobePiStd' ELSE 'Times' END AS font FROM l),
w AS (SELECT DISTINCT page, n, p, (p % 60 + s % 40)::DOUBLE AS x0, (n % 3 * 10 + p % 5)::DOUBLE AS y0, '5°■' || p AS text FROM l),
f AS (SELECT w.page, n, p, w.x0, w.y0, first(font ORDER BY span, font DESC) AS font FROM w JOIN sp ON sp.page = w.page AND w.x0 + 3 BETWEEN sp.x0 - 1 AND sp.x0 + 21 AND w.y0 BETWEEN sp.y0 - 2 AND sp.y0 + 10 GROUP BY ALL)
SELECT w.page, w.n, w.p, w.x0, w.y0, font, CASE font WHEN 'SymbolMT' THEN replace(text, '°', chr(57344)) WHEN 'AdobePiStd' THEN replace(text, '■', chr(57345)) ELSE text END AS text FROM w LEFT JOIN f USING (page, n, p, x0, y0)"""


def chapter_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line's part makes it a question header, the answer key, a solution header or prose."""
    lines = _lines(spark, sf_dir)
    number = (F.col("s") % 3 + 1).cast("string")
    text = F.when(F.col("p") % 6 == 0, F.concat(F.lit("Question "), number, F.lit(" : "))).when(F.col("p") % 6 == 1, "ANSWER KEY").when(F.col("p") % 6 == 2, F.concat(F.lit(" Solution to question "), number, F.lit(":"))).otherwise(F.concat(F.lit("Question "), number, F.lit(": prose")))
    out = pages.chapter_scans(lines.withColumn("text", text), "page", ["n", "p", "s"], "text")
    return out.select("page", F.col("key_pos.n").alias("key_at"), F.col("solution_pos.n").alias("solution_at"), F.array_join("question_numbers", ",").alias("questions"), F.array_join("solution_numbers", ",").alias("solutions"), F.array_join("anomalies", "|").alias("anomalies"))


CHAPTER_SCAN = f"""WITH {_L}, o AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY n, p, s) AS rn, p % 6 AS kind, s % 3 + 1 AS q FROM l),
k AS (SELECT page, min(rn) FILTER (kind = 1) AS key FROM o GROUP BY 1),
h AS (SELECT page, any_value(key) AS key, list(q ORDER BY rn) FILTER (kind = 0 AND (key IS NULL OR rn < key)) AS qs, list(q ORDER BY rn) FILTER (kind = 2 AND rn > key) AS ss, min(rn) FILTER (kind = 2 AND rn > key) AS sol FROM o JOIN k USING (page) GROUP BY 1),
c AS (SELECT page, key, sol, coalesce(qs, []) AS qs, coalesce(ss, []) AS ss FROM h)
SELECT c.page, a.n AS key_at, b.n AS solution_at, array_to_string(qs, ',') AS questions, array_to_string(ss, ',') AS solutions, concat_ws('|', CASE WHEN key IS NULL THEN 'no ''Answer Key'' marker in chapter' END,
CASE WHEN len(qs) = 0 THEN 'no ''Question N:'' headers in chapter' END, CASE WHEN len(ss) = 0 THEN 'no ''Solution to Question N:'' headers in chapter' END,
CASE WHEN len(qs) > 0 AND qs <> range(1, len(qs) + 1) THEN 'question headers not contiguous 1..' || len(qs) || ': [' || array_to_string(qs, ', ') || ']' END,
CASE WHEN len(ss) > 0 AND ss <> range(1, len(ss) + 1) THEN 'solution headers not contiguous 1..' || len(ss) || ': [' || array_to_string(ss, ', ') || ']' END) AS anomalies
FROM c LEFT JOIN o a ON a.page = c.page AND a.rn = key LEFT JOIN o b ON b.page = c.page AND b.rn = sol"""


def key_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visual rows of an order between its second line and its sixth; a part decides what a row says."""
    s = F.col("s").cast("string")
    letter = F.substring(F.lit("aBcDe"), (F.col("s") % 5 + 1).cast("int"), F.lit(1))
    words = (
        F.when(F.col("p") % 6 == 0, F.array(s, letter)).when(F.col("p") % 6 == 1, F.array(F.concat(F.col("s") % 1000, F.lit("  "), letter))).when(F.col("p") % 6 == 2, F.array(F.lit("Question No."), F.lit("Correct Option")))
        .when(F.col("p") % 6 == 3, F.array(F.lit("detailed"), F.lit("explanation"))).when(F.col("p") % 6 == 4, F.array(F.lit(" "))).otherwise(F.array(F.lit("stray"), s))
    )
    lines = _lines(spark, sf_dir)
    bounds = lines.groupBy("page").agg(F.lit(2).alias("key_pos"), F.when(F.max("n") >= 4, F.lit(6)).alias("solution_pos"))
    rows = pages.in_key_zone(lines.withColumn("words", words), bounds, "page", "n")
    return pages.key_rows(rows, "words").select("page", "n", "p", "q_no", "letter", "anomaly")


KEY_ROWS = f"""WITH {_L}, z AS (SELECT page FROM l GROUP BY 1 HAVING max(n) >= 4), r AS (SELECT l.*, substr('aBcDe', (s % 5 + 1)::INTEGER, 1) AS letter, p % 6 AS k FROM l JOIN z USING (page) WHERE n >= 2 AND n < 6),
j AS (SELECT *, CASE k WHEN 0 THEN s || ' ' || letter WHEN 1 THEN s % 1000 || '  ' || letter WHEN 5 THEN 'stray ' || s END AS text, k < 2 AND letter <> 'e' AS hit FROM r WHERE k IN (0, 1, 5))
SELECT page, n, p, CASE WHEN hit THEN CASE k WHEN 0 THEN s ELSE s % 1000 END::INTEGER END AS q_no, CASE WHEN hit THEN lower(letter) END AS letter, CASE WHEN NOT hit THEN 'answer-key zone line not a key row: ' || left(text, 60) END AS anomaly FROM j"""


def contents_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as rows of the contents pages: number, words of the name, number."""
    name = F.when(F.col("p_partkey") % 7 == 0, F.array(F.concat(F.col("p_size"), F.lit(".5")))).when(F.col("p_partkey") % 11 == 0, F.array().cast("array<string>")).otherwise(F.split("p_name", " "))
    rows = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") % 20 + 1).alias("page"), F.concat(F.array(F.concat(F.lit(" "), F.col("p_size"))), name, F.array(F.when(F.col("p_partkey") % 5 == 0, F.lit("12345")).otherwise((F.col("p_partkey") % 1000).cast("string")))).alias("words"))
    return pages.contents_rows(rows, "page", "words").select("p_partkey", "page", "chapter_no", "title", "printed_start")


CONTENTS_ROWS = "SELECT p_partkey, p_partkey % 20 + 1 AS page, p_size::INTEGER AS chapter_no, p_name AS title, (p_partkey % 1000)::INTEGER AS printed_start FROM part WHERE p_partkey % 20 + 1 <= 12 AND p_partkey % 7 <> 0 AND p_partkey % 11 <> 0 AND p_partkey % 5 <> 0"


def contents_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    starts = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.min("l_linenumber").alias("start"), F.max("l_linenumber").alias("start2"))
    starts = starts.select("l_suppkey", F.when(F.col("l_suppkey") % 3 == 0, F.col("start2")).otherwise(F.col("start")).alias("start"))
    return pages.contents_start(starts, "l_suppkey", "start")


CONTENTS_START = """WITH s AS (SELECT l_suppkey, CASE WHEN l_suppkey % 3 = 0 THEN max(l_linenumber) ELSE min(l_linenumber) END AS start FROM lineitem GROUP BY 1)
SELECT *, CASE WHEN start <> 1 THEN 'contents do not start at chapter 1 (starts ' || start || ')' END AS fault FROM s"""


def chapter_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("p") % 5 == 0, "Question 1:").otherwise(F.concat(F.lit(" Part "), F.col("p"), F.lit(" ")))
    lines = _lines(spark, sf_dir).withColumns({"text": text, "size": (F.col("s") % 20).cast("double")})
    toc = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("page"), F.concat(F.lit("Order ..."), F.col("o_custkey")).alias("toc"))
    return pages.chapter_titles(lines, "page", ["n", "p", "s"], "text", "size", toc, "toc")


CHAPTER_TITLES = f"""WITH {_L}, o AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY n, p, s) AS rn FROM l), h AS (SELECT page, min(rn) FILTER (p % 5 = 0) AS h FROM o GROUP BY 1),
t AS (SELECT page, string_agg('Part ' || p, ' ' ORDER BY rn) AS own FROM o JOIN h USING (page) WHERE s % 20 >= 16 AND p % 5 <> 0 AND (h IS NULL OR rn < h) GROUP BY 1)
SELECT o_orderkey AS page, coalesce(own, 'Order ...' || o_custkey) AS title FROM orders LEFT JOIN t ON t.page = o_orderkey"""


def table_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baselines of an order against two boxes that overlap."""
    rows = _lines(spark, sf_dir).groupBy("page", "n").agg(F.avg(F.col("n") * 10.0 + F.col("p") % 3).alias("y")).select("page", "n", F.round("y", 6).alias("y"))
    orders = table(spark, sf_dir, "orders")
    low, high = (F.col("o_custkey") % 30).cast("double"), (F.col("o_custkey") % 30 + 20).cast("double")
    box = lambda k: orders.select(F.col("o_orderkey").alias("page"), F.lit(k).alias("box"), (low + 12 * (k - 1)).alias("by0"), (high + 12 * (k - 1)).alias("by1"))
    return pages.table_membership(rows, box(1).unionByName(box(2)), "page", ["n"], "y", "box")


TABLE_MEMBERSHIP = f"""WITH {_L}, r AS (SELECT page, n, round(avg(n * 10.0::DOUBLE + p % 3), 6)::DOUBLE AS y FROM l GROUP BY 1, 2), b AS (SELECT o_orderkey AS page, (o_custkey % 30)::DOUBLE AS lo FROM orders)
SELECT r.page, n, y, CASE WHEN y BETWEEN lo - 3 AND lo + 23 THEN 1 WHEN y BETWEEN lo + 9 AND lo + 35 THEN 2 END::INTEGER AS box FROM r LEFT JOIN b USING (page)"""


def table_grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order's lines as rules of its box, some too short, some outside."""
    ruled = _lines(spark, sf_dir)
    x, y = (F.col("p") % 31 * 10).cast("double"), (F.col("s") % 21 * 10).cast("double")
    level = F.col("n") % 2 == 0
    segments = ruled.select("page", x.alias("x0"), y.alias("y0"), F.when(level, x + F.col("p") % 100).otherwise(x + 1).alias("x1"), F.when(level, y + 1).otherwise(y + F.col("s") % 30).alias("y1"))
    sides = {"bx0": F.lit(5.0), "by0": F.lit(5.0), "bx1": (F.col("o_custkey") % 200 + 60).cast("double"), "by1": (F.col("o_custkey") % 150 + 40).cast("double")}
    box = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("page"), F.lit(1).alias("box"), *[c.alias(n) for n, c in sides.items()])
    out = boxes.grids(boxes.rules(segments), box, "page", "box")
    return out.select("page", *[F.array_join(F.transform(c, lambda v: v.cast("int").cast("string")), ",").alias(c) for c in ("columns", "rows")])


TABLE_GRIDS = f"""WITH {_L}, g AS (SELECT page, n % 2 = 0 AS h, (p % 31 * 10)::DOUBLE AS x0, (s % 21 * 10)::DOUBLE AS y0, p % 100 AS w, s % 30 AS d FROM l),
r AS (SELECT page, h, x0, y0, CASE WHEN h THEN x0 + w ELSE x0 + 1 END AS x1, CASE WHEN h THEN y0 + 1 ELSE y0 + d END AS y1 FROM g WHERE (h AND w > 30) OR (NOT h AND d > 8)),
b AS (SELECT o_orderkey AS page, 5.0 AS bx0, 5.0 AS by0, (o_custkey % 200 + 60)::DOUBLE AS bx1, (o_custkey % 150 + 40)::DOUBLE AS by1 FROM orders),
e AS (SELECT b.page, any_value(bx1) AS bx1, any_value(by1) AS by1, list_sort(list(DISTINCT x0::INTEGER) FILTER (NOT h AND y0 >= by0 - 4 AND y1 <= by1 + 4 AND x0 BETWEEN bx0 - 4 AND bx1 + 4)) AS c,
list_sort(list(DISTINCT y0::INTEGER) FILTER (h AND x0 >= bx0 - 4 AND x1 <= bx1 + 4 AND y0 BETWEEN by0 - 4 AND by1 + 4)) AS r FROM b LEFT JOIN r USING (page) GROUP BY 1)
SELECT page, array_to_string(CASE WHEN coalesce(len(c) >= 2 AND c[1] <= 17 AND c[-1] >= bx1 - 12, false) THEN c ELSE [5, bx1::INTEGER] END, ',') AS columns,
CASE WHEN coalesce(len(r) >= 2 AND r[1] <= 17 AND r[-1] >= by1 - 12, false) THEN array_to_string(r, ',') ELSE '' END AS rows FROM e"""


def page_backgrounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of a figure group by the line number's parity; groups that fill their page."""
    pieces = _lines(spark, sf_dir).select("page", (F.col("n") % 2).alias("grp"), (F.col("p") % 30).cast("double").alias("x0"), (F.col("s") % 30).cast("double").alias("y0"), (F.col("p") % 30 + 60).cast("double").alias("x1"), (F.col("s") % 30 + 60).cast("double").alias("y1"))
    sizes = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("page"), F.lit(90.0).alias("width"), (F.col("o_custkey") % 40 + 60).cast("double").alias("height"))
    return boxes.page_backgrounds(boxes.union_boxes(pieces, ["page", "grp"]), sizes, "page")


PAGE_BACKGROUNDS = f"""WITH {_L}, u AS (SELECT page, n % 2 AS grp, min(p % 30)::DOUBLE AS x0, min(s % 30)::DOUBLE AS y0, max(p % 30 + 60)::DOUBLE AS x1, max(s % 30 + 60)::DOUBLE AS y1 FROM l GROUP BY 1, 2)
SELECT u.* FROM u JOIN orders ON o_orderkey = page WHERE (x1 - x0) * (y1 - y0) > 0.9::DOUBLE * 90 * (o_custkey % 40 + 60)"""


def line_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by the ruled band, or else the baseline, that holds their middle; orders without rules have baselines only."""
    edges = F.when(F.col("page") % 3 == 0, F.array().cast("array<double>")).otherwise(F.array(*[F.lit(float(x)) for x in (10, 40, 70)]))
    lines = _lines(spark, sf_dir).select("page", "n", "p", boxes.band_of(F.col("n") * 12.0 + F.col("p") % 5 * 1.5, edges).alias("b"))
    return lines.select("page", "n", "p", F.col("b.kind").alias("kind"), F.col("b.at").alias("at"))


LINE_BANDS = f"""WITH {_L}, m AS (SELECT *, n * 12.0 + p % 5 * 1.5 AS y FROM l)
SELECT page, n, p, CASE WHEN page % 3 <> 0 AND y BETWEEN 7 AND 73 THEN 'r' ELSE 'y' END AS kind, CASE WHEN page % 3 <> 0 AND y BETWEEN 7 AND 43 THEN 0 WHEN page % 3 <> 0 AND y BETWEEN 7 AND 73 THEN 1 ELSE round_even(y / 3, 0)::BIGINT END AS at FROM m"""

QUERIES = {f.__name__: f for f in (baselines, footer_split, span_clusters, word_fonts, chapter_scan, key_rows, contents_rows, contents_start, chapter_titles, table_membership, table_grids, page_backgrounds, line_bands)}
ORACLES = {name: globals()[name.upper()] for name in QUERIES}
