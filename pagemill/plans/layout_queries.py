"""Page order, tables, claims and verification queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions import markdown as M
from pagemill.operators import boxes, claims, fidelity, layout, tables, verify
from pagemill.sources.tables import table

# ---- order -----------------------------------------------------------------


def _numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Printed numbers of an order's lines; one in fifty is misread."""
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", F.when(F.col("l_partkey") % 50 == 0, F.col("l_linenumber") + 1).otherwise(F.col("l_linenumber")).cast("int").alias("q_no"))


_NUMBERS = "numbers AS (SELECT l_orderkey, l_partkey, CASE WHEN l_partkey % 50 = 0 THEN l_linenumber + 1 ELSE l_linenumber END AS q_no FROM lineitem)"
_CENSUS = "census AS (SELECT l_orderkey, count(*) AS n, max(q_no)::BIGINT AS expected, count(*) - count(DISTINCT q_no) AS duplicates, count(*) = count(DISTINCT q_no) AND min(q_no) = 1 AND max(q_no) = count(*) AS contiguous FROM numbers GROUP BY 1)"


def census(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.census(_numbers(spark, sf_dir), "l_orderkey", "q_no")


def contiguity_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.anomalies(_numbers(spark, sf_dir), "l_orderkey", "q_no")


def longest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey")
    return layout.longest_run(lines, "l_suppkey", ["l_orderkey", "l_linenumber", "l_partkey"], "l_linenumber", "l_partkey").withColumn("start", F.col("start").cast("long"))


LONGEST_RUN = """WITH o AS (SELECT *, row_number() OVER w AS rn, coalesce(l_linenumber = lag(l_linenumber) OVER w + 1 AND l_partkey > lag(l_partkey) OVER w, false) AS goes_on FROM lineitem WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey)),
r AS (SELECT *, sum(CASE WHEN goes_on THEN 0 ELSE 1 END) OVER (PARTITION BY l_suppkey ORDER BY rn) AS run FROM o),
s AS (SELECT l_suppkey, run, count(*) AS length, arg_min(l_linenumber, rn) AS start FROM r GROUP BY 1, 2)
SELECT l_suppkey, start::BIGINT AS start, length FROM s QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY length DESC, run) = 1"""


def offset_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    votes = table(spark, sf_dir, "lineitem").select("l_suppkey", (F.col("l_linenumber") - F.col("l_partkey") % 5).cast("long").alias("off"))
    return layout.offset_vote(votes, "l_suppkey", "off")


OFFSET_VOTE = """WITH v AS (SELECT l_suppkey, (l_linenumber - l_partkey % 5)::BIGINT AS o, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT l_suppkey, o AS "offset", n FROM v QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, abs(o), o) = 1"""


def question_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's turn as the header of the turns that follow."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return layout.owned(turns, "conv_id", ["turn"], F.col("role") == "user", F.col("turn"))


def solution_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return layout.owned(turns, "conv_id", ["turn"], F.col("role") == "assistant", F.col("turn"))


def _blocks_sql(role: str) -> str:
    return f"SELECT c.conv_id, c.turn, c.role, max(h.turn) AS block FROM conversations c JOIN conversations h ON h.conv_id = c.conv_id AND h.role = '{role}' AND h.turn < c.turn WHERE c.role <> '{role}' GROUP BY ALL"


def option_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line's part decides its marker letter; e stands for none."""
    letter = F.translate(F.char((97 + F.col("l_partkey") % 5).cast("int")), "e", "-")
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", letter.alias("x")))), lambda s: s["x"]).alias("letters"))
    return lines.select("l_orderkey", layout.assigned_options(F.col("letters")).alias("options"))


OPTION_ASSIGNMENT = """WITH RECURSIVE l AS (SELECT l_orderkey, translate(chr((97 + l_partkey % 5)::INTEGER), 'e', '-') AS x, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS rn FROM lineitem),
f AS (SELECT l_orderkey, 0::BIGINT AS rn, '' AS now, '' AS options FROM (SELECT DISTINCT l_orderkey FROM l)
UNION ALL SELECT l_orderkey, rn, now, options || CASE WHEN now = '' THEN '.' ELSE now END FROM (
  SELECT f.l_orderkey, l.rn, f.options, CASE WHEN CASE WHEN f.now = '' THEN l.x = 'a' ELSE l.x > f.now AND l.x <> '-' END THEN l.x ELSE f.now END AS now FROM f JOIN l ON l.l_orderkey = f.l_orderkey AND l.rn = f.rn + 1))
SELECT l_orderkey, arg_max(options, rn) AS options FROM f GROUP BY 1"""


def reflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of a conversation as lines of pages of four; the gap above depends on the turn."""
    at = F.col("turn")
    lines = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.floor(at / 4).alias("page"), (at * 20.0).alias("y0"), (at * 20.0 + 8.0 + at % 3 * 5.0).alias("y1"), F.concat(F.when(at % 2 == 0, F.lit(" \t")).otherwise(F.lit("")), F.when(at % 5 == 0, F.lit("(1) ")).otherwise(F.lit("")), F.regexp_replace(F.col("text"), r"(?U)\s+", " ")).alias("text"))
    return layout.reflow(lines, "conv_id", "turn", "page", "y0", "y1", "text")


_WS = r"[\s\x0b\x1c-\x1f\x85\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
REFLOW = f"""WITH l AS (SELECT conv_id, turn, turn // 4 AS page, turn * 20.0 AS y0, turn * 20.0 + 8.0 + turn % 3 * 5.0 AS y1, trim(CASE WHEN turn % 5 = 0 THEN '(1) ' ELSE '' END || regexp_replace(text, '{_WS}+', ' ', 'g')) AS text FROM conversations),
g AS (SELECT conv_id, CASE WHEN lag(page) OVER w = page THEN y0 - lag(y1) OVER w END AS gap FROM l WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
m AS (SELECT conv_id, list_sort(list(gap) FILTER (gap > 0)) AS gs FROM g GROUP BY 1),
t AS (SELECT conv_id, gs[len(gs) // 2 + 1] AS med FROM m),
b AS (SELECT *, CASE WHEN lag(page) OVER w = page THEN y0 - lag(y1) OVER w END AS gap, row_number() OVER w AS rn FROM l WHERE trim(coalesce(text, '')) <> '' WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
s AS (SELECT conv_id, turn, CASE WHEN rn = 1 THEN '' WHEN coalesce(gap > CASE WHEN med >= 3 THEN 0.5 * med ELSE 1.5 * med END, false) THEN chr(10) WHEN regexp_matches(text, '(?i)^(?:•|\\(\\d+\\)|\\d+\\.\\s|Option\\s+[A-D]\\s*:)') THEN chr(10) ELSE ' ' END || trim(text) AS t FROM b LEFT JOIN t USING (conv_id))
SELECT conv_id, string_agg(t, '' ORDER BY turn) AS text FROM s GROUP BY 1"""


def answer_key_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines are numbers, letters or other text, by their part."""
    kind = F.col("l_partkey") % 3
    lines = table(spark, sf_dir, "lineitem")
    return layout.key_pairs(lines, "l_orderkey", ["l_linenumber", "l_partkey"], F.when(kind == 0, F.col("l_suppkey") % 4), F.when(kind == 1, F.char((97 + F.col("l_suppkey") % 4).cast("int"))))


ANSWER_KEY_PAIRING = """WITH k AS (SELECT l_orderkey, row_number() OVER w AS rn, CASE WHEN l_partkey % 3 = 0 THEN l_suppkey % 4 END AS number, lead(CASE WHEN l_partkey % 3 = 1 THEN chr((97 + l_suppkey % 4)::INTEGER) END) OVER w AS letter FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey))
SELECT l_orderkey, number, arg_min(letter, rn) AS letter FROM k WHERE number IS NOT NULL AND letter IS NOT NULL GROUP BY 1, 2"""

# ---- tables ----------------------------------------------------------------


def _rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order's lines as a table of three columns."""
    row = F.array(F.col("l_linenumber").cast("string"), F.concat(F.lit("part "), F.col("l_partkey"), F.when(F.col("l_partkey") % 7 == 0, F.lit(" .")).otherwise(F.lit(""))), F.when(F.col("l_returnflag") == "R", F.lit("")).otherwise(F.concat_ws("; ", F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_suppkey").cast("string"))))
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", row.alias("row")))), lambda s: s["row"]).alias("rows"))
    return rows.select("l_orderkey", M.render("rows").alias("md"))


_ROW = "[l_linenumber::VARCHAR, 'part ' || l_partkey || CASE WHEN l_partkey % 7 = 0 THEN ' .' ELSE '' END, CASE WHEN l_returnflag = 'R' THEN '' ELSE l_returnflag || '; ' || l_linestatus || '; ' || l_suppkey END]"
_RENDERED = f"""rendered AS (SELECT l_orderkey, string_agg('| ' || array_to_string(r, ' | ') || ' |' || CASE WHEN rn = 1 THEN chr(10) || '|---|---|---|' ELSE '' END, chr(10) ORDER BY rn) AS md, list(r ORDER BY rn) AS rows
FROM (SELECT l_orderkey, {_ROW} AS r, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem) GROUP BY 1)"""


def table_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rendered(spark, sf_dir)


def table_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _rendered(spark, sf_dir).select("l_orderkey", F.posexplode(M.parse("md")).alias("r", "cells"))
    return parsed.select("l_orderkey", "r", F.array_join("cells", "|").alias("cells"))


def table_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rendered(spark, sf_dir).select("l_orderkey", M.shape("md").alias("columns"), M.even_shape("md").alias("even"))


def salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An answer that chats before the table; every third has a second one."""
    chat = F.concat(F.lit("Here it is:\n```\n"), "md", F.lit("\n```\nDone."), F.when(F.col("l_orderkey") % 3 == 0, F.concat(F.lit("\n"), "md")).otherwise(F.lit("")))
    return _rendered(spark, sf_dir).select("l_orderkey", M.salvage(chat).alias("md"))


def render_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rendered(spark, sf_dir).select("l_orderkey", F.array_join(M.render_findings("md"), ",").alias("findings"))


def precheck(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rendered(spark, sf_dir).select("l_orderkey", F.array_join(M.suspicions("md"), ",").alias("reasons"))


_EMPTY = "len(list_filter(flatten(rows), lambda x: x = ''))"
_NARROW = "list_min(list_transform([1, 2, 3], lambda k: list_max(list_transform(rows, lambda r: len(r[k])))))"
_FINDINGS = f"""concat_ws(',', CASE WHEN {_NARROW} <= 3 AND list_max(list_transform(flatten(rows), lambda x: len(x))) >= 30 THEN 'extremely_narrow_column' END,
CASE WHEN len(list_filter(flatten(rows), lambda x: regexp_matches(x, '\\S\\s+[.,;:!?\\)]$'))) > 0 THEN 'punctuation_spacing' END, CASE WHEN {_EMPTY} * 3 > len(flatten(rows)) THEN 'mostly_empty_cells' END)"""


def header_dedupe_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order in chunks of three; each chunk repeats the header row, but for one kind of order; another kind is not to lose it."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.floor((F.col("l_linenumber") - 1) / 3).alias("chunk"), "l_linenumber", F.array(F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string")).alias("row"))
    head = F.when(F.col("l_orderkey") % 4 == 0, F.array(F.lit("No"), F.concat(F.lit("Part "), F.col("chunk")))).otherwise(F.array(F.lit("No"), F.lit("Part")))
    chunks = lines.groupBy("l_orderkey", "chunk").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "row"))), lambda s: s["row"]).alias("rows")).select("l_orderkey", "chunk", F.concat(F.array(head), "rows").alias("rows"))
    chunks = chunks.withColumn("mode", F.when((F.col("chunk") > 0) & (F.col("l_orderkey") % 3 != 0), "dedup").otherwise("keep"))
    merged = tables.merged_chunks(chunks, "l_orderkey", "chunk", "rows")
    return merged.select("l_orderkey", F.array_join(F.transform("rows", lambda r: F.array_join(r, "|")), "\n").alias("body"), "header_deduplicated")


HEADER_DEDUPE_MERGE = """WITH c AS (SELECT l_orderkey, (l_linenumber - 1) // 3 AS chunk, string_agg(l_linenumber || '|' || l_partkey, chr(10) ORDER BY l_linenumber, l_partkey::VARCHAR) AS body FROM lineitem GROUP BY 1, 2),
f AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY chunk) AS rn, first_value(chunk) OVER (PARTITION BY l_orderkey ORDER BY chunk) AS c0 FROM c)
SELECT l_orderkey, string_agg(CASE WHEN rn > 1 AND chunk > 0 AND l_orderkey % 4 <> 0 AND l_orderkey % 3 <> 0 THEN '' ELSE 'No|Part' || CASE WHEN l_orderkey % 4 = 0 THEN ' ' || chunk ELSE '' END || chr(10) END || body, chr(10) ORDER BY chunk) AS body, count(*) > 1 AND l_orderkey % 4 <> 0 AND l_orderkey % 3 <> 0 AS header_deduplicated FROM f GROUP BY l_orderkey"""


def _perturbed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A proposal for each table: spacing, a break, an addition, a number, a lost row, or nothing."""
    k, md = F.col("l_orderkey") % 8, F.col("md")
    after = (
        F.when(k == 0, F.replace(md, F.lit("part "), F.lit("part")))
        .when(k == 1, F.replace(md, F.lit("; "), F.lit("<br>")))
        .when(k == 2, F.replace(md, F.lit("part "), F.lit("parts ")))
        .when(k == 3, F.replace(md, F.lit("part 1"), F.lit("part 2")))
        .when(k == 4, F.concat(md, F.lit("\n| 9 | x | y |")))
        .when(k == 5, F.replace(md, F.lit("part "), F.lit("art ")))
        .when(k == 6, F.regexp_replace(md, r"\|$", ""))
        .otherwise(md)
    )
    return _rendered(spark, sf_dir).select("l_orderkey", "md", after.alias("after"))


def cell_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fidelity.cell_changes(_perturbed(spark, sf_dir), "l_orderkey", "md", "after").select(F.col("key").alias("l_orderkey"), "r", "c", "kind")


def fidelity_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fidelity.verdicts(_perturbed(spark, sf_dir), "l_orderkey", "md", "after").select(F.col("key").alias("l_orderkey"), "verdict", "n_changed")


_CELLS = """cells AS (SELECT l_orderkey, l_orderkey % 8 AS k, unnest(range(1, len(rows) + 1)) AS r, rows FROM rendered),
kinds AS (SELECT l_orderkey, r::INTEGER AS r, CASE k WHEN 1 THEN 3 ELSE 2 END AS c, CASE k WHEN 0 THEN 'spacing' WHEN 1 THEN 'presentation' WHEN 2 THEN 'hallucinated_addition' WHEN 3 THEN 'changed_number' WHEN 5 THEN 'deletion' END AS kind
FROM cells WHERE k IN (0, 2, 5) OR (k = 1 AND rows[r][3] <> '') OR (k = 3 AND starts_with(rows[r][2], 'part 1')))"""
CELL_DIFF = f"WITH {_RENDERED}, {_CELLS} SELECT * FROM kinds"
FIDELITY_VERDICTS = f"""WITH {_RENDERED}, {_CELLS}, n AS (SELECT l_orderkey, count(*) AS n FROM kinds GROUP BY 1)
SELECT l_orderkey, CASE WHEN l_orderkey % 8 IN (2, 4, 5) OR (l_orderkey % 8 = 6 AND len(rows) > 1) OR (l_orderkey % 8 = 3 AND n > 0) THEN 'REJECT' ELSE 'ACCEPT' END AS verdict, coalesce(n, 0) AS n_changed FROM rendered LEFT JOIN n USING (l_orderkey)"""

# ---- geometry --------------------------------------------------------------


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order placed on its page: x by part, y by number."""
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_partkey") % 400 + 50.0).alias("x0"), (F.col("l_partkey") % 400 + 60.0 + F.col("l_suppkey") % 50).alias("x1"), (F.col("l_linenumber") * 30.0).alias("y0"), (F.col("l_linenumber") * 30.0 + 10.0).alias("y1"))


_PLACED = "placed AS (SELECT l_orderkey, l_linenumber, l_partkey, l_partkey % 400 + 50.0 AS x0, l_partkey % 400 + 60.0 + l_suppkey % 50 AS x1, l_linenumber * 30.0 AS y0, l_linenumber * 30.0 + 10.0 AS y1 FROM lineitem)"


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(100.0).alias("bx0"), (F.col("o_custkey") % 200 + 200.0).alias("bx1"), F.lit(45.0).alias("by0"), (F.col("o_custkey") % 90 + 80.0).alias("by1"))


def box_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boxes.lines_in_boxes(_placed(spark, sf_dir), _boxes(spark, sf_dir), "l_orderkey").select("l_orderkey", "l_linenumber", "l_partkey")


BOX_LINES = f"WITH {_PLACED} SELECT l_orderkey, l_linenumber, l_partkey FROM placed JOIN orders ON o_orderkey = l_orderkey WHERE x0 >= 98.0 AND x0 <= o_custkey % 200 + 202.0 AND (y0 + y1) / 2 BETWEEN 42.0 AND o_custkey % 90 + 83.0"


def cell_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = F.array(*[F.lit(float(x)) for x in (50, 150, 260, 380)])
    return _placed(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", boxes.column_of(F.col("x0"), edges).alias("col"))


def fill_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = F.array(*[F.lit(float(x)) for x in (50, 150, 260, 380)])
    placed = _placed(spark, sf_dir).withColumn("col", boxes.column_of(F.col("x0"), edges))
    return placed.groupBy("l_orderkey", "col").agg(F.max("x1").alias("fill"))


_COL = "len(list_filter([50.0, 150.0, 260.0, 380.0], lambda e: e <= x0 + 4)) - 1"


def ruled_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _placed(spark, sf_dir)
    across = p.select("l_orderkey", "x0", "y0", (F.col("x1") + 60).alias("x1"), F.col("y0").alias("y1"), F.lit("h").alias("kind"))
    down = p.select("l_orderkey", "x0", "y0", F.col("x0").alias("x1"), (F.col("y0") + F.col("l_partkey") % 3 * 15).alias("y1"), F.lit("v").alias("kind"))
    return boxes.ruled_boxes(across.unionByName(down), "l_orderkey")


def adjacent_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = _placed(spark, sf_dir).withColumn("img_no", F.col("l_linenumber") * 1_000_000 + F.col("l_partkey"))
    return boxes.adjacent_groups(images.select("l_orderkey", "img_no", "x0", "y0", "x1", (F.col("y1") + F.col("l_partkey") % 4 * 5).alias("y1")), "l_orderkey", "img_no")


def word_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _placed(spark, sf_dir).select("l_orderkey", "x0", (F.col("l_partkey") % 40).cast("double").alias("y0"), F.col("l_partkey").cast("string").alias("text"))
    return boxes.word_rows(words, "l_orderkey").groupBy("l_orderkey", "row").agg(F.count("*").alias("n"), F.min("y0").alias("top"))


_BOX = "STRUCT(x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE, h BIGINT, v BIGINT)"
_MEETS = "m.x0 <= b.x1 + {0} AND m.y0 <= b.y1 + {0} AND m.x1 >= b.x0 - {0} AND m.y1 >= b.y0 - {0}"
RULED_BOXES = f"""WITH RECURSIVE {_PLACED}, rules AS (SELECT l_orderkey, {{'x0': x0, 'y0': y0, 'x1': x1 + 60, 'y1': y0, 'h': 1, 'v': 0}}::{_BOX} AS m FROM placed
UNION ALL SELECT l_orderkey, {{'x0': x0, 'y0': y0, 'x1': x0, 'y1': y0 + l_partkey % 3 * 15, 'h': 0, 'v': 1}}::{_BOX} FROM placed WHERE l_partkey % 3 > 0),
o AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY m.y0, m.x0, m.v, m.x1, m.y1) AS rn FROM rules),
f AS (SELECT l_orderkey, 0::BIGINT AS rn, []::{_BOX}[] AS found FROM (SELECT DISTINCT l_orderkey FROM o)
UNION ALL SELECT l_orderkey, rn, CASE WHEN len(near) = 0 THEN list_append(found, m) ELSE list_append([b for b in found if NOT ({_MEETS.format(3)})], {{'x0': least(m.x0, list_min([b.x0 for b in near])), 'y0': least(m.y0, list_min([b.y0 for b in near])),
  'x1': greatest(m.x1, list_max([b.x1 for b in near])), 'y1': greatest(m.y1, list_max([b.y1 for b in near])), 'h': m.h + list_sum([b.h for b in near])::BIGINT, 'v': m.v + list_sum([b.v for b in near])::BIGINT}}) END
  FROM (SELECT f.l_orderkey, o.rn, m, found, [b for b in found if {_MEETS.format(3)}] AS near FROM f JOIN o ON o.l_orderkey = f.l_orderkey AND o.rn = f.rn + 1)),
e AS (SELECT l_orderkey, unnest(arg_max(found, rn)) AS b FROM f GROUP BY 1)
SELECT l_orderkey, b.x0 AS x0, b.y0 AS y0, b.x1 AS x1, b.y1 AS y1, b.h AS n_h, b.v AS n_v FROM e WHERE b.h >= 3 OR (b.h >= 2 AND b.v >= 2)"""

ADJACENT_GROUPS = f"""WITH RECURSIVE {_PLACED}, o AS (SELECT l_orderkey, l_linenumber * 1000000 + l_partkey AS img_no, {{'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1 + l_partkey % 4 * 5, 'h': 0, 'v': 0}}::{_BOX} AS m FROM placed),
n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY img_no) AS rn FROM o),
f AS (SELECT l_orderkey, 0::BIGINT AS rn, []::{_BOX}[] AS seen, 0::BIGINT AS made, NULL::BIGINT AS img_no, NULL::BIGINT AS grp FROM (SELECT DISTINCT l_orderkey FROM n)
UNION ALL SELECT l_orderkey, rn, list_append(seen, struct_update(m, h := g)), greatest(made, g + 1), img_no, g
  FROM (SELECT f.l_orderkey, n.rn, m, seen, made, n.img_no, coalesce(list_min([b.h for b in seen if {_MEETS.format(4)}]), made) AS g FROM f JOIN n ON n.l_orderkey = f.l_orderkey AND n.rn = f.rn + 1))
SELECT l_orderkey, img_no, grp FROM f WHERE rn > 0"""

WORD_ROWS = """WITH RECURSIVE w AS (SELECT l_orderkey, (l_partkey % 40)::DOUBLE AS y, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey % 40) AS rn FROM lineitem),
r AS (SELECT l_orderkey, rn, y, y AS top, 0::BIGINT AS "row" FROM w WHERE rn = 1
UNION ALL SELECT w.l_orderkey, w.rn, w.y, CASE WHEN w.y - top > 5 THEN w.y ELSE top END, "row" + CASE WHEN w.y - top > 5 THEN 1 ELSE 0 END FROM r JOIN w ON w.l_orderkey = r.l_orderkey AND w.rn = r.rn + 1)
SELECT l_orderkey, "row", count(*) AS n, min(y) AS top FROM r GROUP BY 1, 2"""

# ---- claims ----------------------------------------------------------------


def _figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as figure placements; every third order has headers at its even lines."""
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def figure_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = _figures(spark, sf_dir).where("l_partkey % 2 = 0").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("block"))
    return claims.claimed(_figures(spark, sf_dir).where("l_partkey % 2 = 1"), heads, "l_orderkey", "l_linenumber").select("l_orderkey", "l_linenumber", "l_partkey", "block")


FIGURE_CLAIMS = """WITH h AS (SELECT l_orderkey, l_linenumber, min(l_partkey) AS block FROM lineitem WHERE l_partkey % 2 = 0 GROUP BY 1, 2), f AS (SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey % 2 = 1)
SELECT f.*, h.block FROM f JOIN (SELECT f.l_orderkey, f.l_linenumber, f.l_partkey, max(h.l_linenumber) AS at FROM (SELECT DISTINCT * FROM f) f JOIN h ON h.l_orderkey = f.l_orderkey AND h.l_linenumber <= f.l_linenumber GROUP BY 1, 2, 3) m USING (l_orderkey, l_linenumber, l_partkey) JOIN h ON h.l_orderkey = f.l_orderkey AND h.l_linenumber = m.at"""


def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = _figures(spark, sf_dir).where("l_partkey % 2 = 0").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("block"))
    return claims.orphans(_figures(spark, sf_dir).where("l_partkey % 2 = 1"), heads, "l_orderkey", "l_linenumber").select("l_orderkey", "l_linenumber", "l_partkey", "reason")


ORPHANS = "SELECT l_orderkey, l_linenumber, l_partkey, 'image_outside_blocks' AS reason FROM lineitem f WHERE l_partkey % 2 = 1 AND NOT EXISTS (SELECT 1 FROM lineitem h WHERE h.l_orderkey = f.l_orderkey AND h.l_partkey % 2 = 0 AND h.l_linenumber <= f.l_linenumber)"


def slot_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims.slot_names(_figures(spark, sf_dir).withColumn("kind", F.when(F.col("l_suppkey") % 2 == 0, "Q").otherwise("SOL")), "l_orderkey", "kind", ["l_linenumber", "l_partkey"]).select("l_orderkey", "l_linenumber", "l_partkey", "name")


SLOT_NAMES = "SELECT l_orderkey, l_linenumber, l_partkey, printf('%d_%s_%02d', l_orderkey, kind, row_number() OVER (PARTITION BY l_orderkey, kind ORDER BY l_linenumber, l_partkey)) AS name FROM (SELECT *, CASE WHEN l_suppkey % 2 = 0 THEN 'Q' ELSE 'SOL' END AS kind FROM lineitem)"


def dedupe_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = _figures(spark, sf_dir).select(F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey").alias("name"), F.md5(F.col("l_partkey").cast("string")).alias("md5"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"))
    return claims.deduplicated(named, "md5", "seq", "name")


DEDUPE_ASSETS = "WITH n AS (SELECT l_orderkey || '_' || l_linenumber || '_' || l_partkey AS name, md5(l_partkey::VARCHAR) AS md5, l_orderkey * 10 + l_linenumber AS seq FROM lineitem), f AS (SELECT md5, min(name) AS file FROM (SELECT *, min(seq) OVER (PARTITION BY md5) AS s0 FROM n) WHERE seq = s0 GROUP BY 1) SELECT n.*, f.file, n.name <> f.file AS shared FROM n JOIN f USING (md5)"


def image_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _figures(spark, sf_dir)
    state = F.when(F.col("l_partkey") % 11 == 0, "skipped").when(F.col("l_partkey") % 7 == 0, "orphan").when(F.col("l_partkey") % 5 == 0, "merged").otherwise("claimed")
    return claims.conservation(f.withColumn("outcome", state), "l_suppkey", "outcome")


def referenced_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = _figures(spark, sf_dir).select("l_partkey")
    return claims.referenced(manifest, table(spark, sf_dir, "part").where("p_size > 10").select(F.col("p_partkey").alias("l_partkey")), "l_partkey")


# ---- verification ----------------------------------------------------------


def verify_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn's text against its conversation; one in nine has lost its e's."""
    turns = table(spark, sf_dir, "conversations")
    zones = turns.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), " ").alias("zone"))
    fields = turns.select("conv_id", "turn", F.when(F.col("turn") % 9 == 4, F.replace("text", F.lit("e"), F.lit(""))).otherwise(F.col("text")).alias("text"))
    return verify.not_printed(fields, zones, "conv_id", "text", "zone").select("conv_id", "turn")


_ZONES = "zones AS (SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS zone FROM conversations GROUP BY 1)"
_STRIP = "regexp_replace({0}, '[\\s\\x0b\\x1c-\\x1f\\x85\\x{{00a0}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]+', '', 'g')"
VERIFY_SUBSTRING = f"""WITH {_ZONES}, f AS (SELECT conv_id, turn, CASE WHEN turn % 9 = 4 THEN replace(text, 'e', '') ELSE text END AS text FROM conversations)
SELECT f.conv_id, f.turn FROM f JOIN zones USING (conv_id) WHERE {_STRIP.format('text')} <> '' AND NOT contains({_STRIP.format('zone')}, {_STRIP.format('text')})"""


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.length("text").alias("n"), (F.col("role") != "system").alias("covered"))
    return verify.coverage(turns, "conv_id", "n", "covered", least=0.9)


def key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    printed = lines.groupBy("l_orderkey", "l_linenumber").agg(F.min("l_returnflag").alias("letter"))
    answers = lines.groupBy("l_orderkey", "l_linenumber").agg(F.max(F.when(F.col("l_partkey") % 9 == 0, None).otherwise(F.col("l_returnflag"))).alias("answer"))
    return verify.key_differs(answers, printed, ["l_orderkey", "l_linenumber"], "answer", "letter")


QUERIES = {
    f.__name__: f
    for f in (
        census, contiguity_anomalies, longest_run, offset_vote, question_blocks, solution_blocks, option_assignment, reflow, answer_key_pairing,
        table_render, table_parse, table_shape, salvage, render_qa, precheck, header_dedupe_merge, cell_diff, fidelity_verdicts,
        box_lines, cell_assignment, fill_edge, ruled_boxes, adjacent_groups, word_rows,
        figure_claims, orphans, slot_names, dedupe_assets, image_conservation, referenced_assets, verify_substring, coverage, key_check,
    )
}
ORACLES = {
    "ruled_boxes": RULED_BOXES, "adjacent_groups": ADJACENT_GROUPS, "word_rows": WORD_ROWS,
    "census": f"WITH {_NUMBERS}, {_CENSUS} SELECT * FROM census",
    "contiguity_anomalies": f"WITH {_NUMBERS}, {_CENSUS} SELECT l_orderkey, 'duplicate number ' || q_no AS anomaly FROM numbers GROUP BY l_orderkey, q_no HAVING count(*) > 1 UNION ALL SELECT l_orderkey, 'numbers are not 1..' || n FROM census WHERE NOT contiguous",
    "longest_run": LONGEST_RUN,
    "offset_vote": OFFSET_VOTE,
    "question_blocks": _blocks_sql("user"),
    "solution_blocks": _blocks_sql("assistant"),
    "option_assignment": OPTION_ASSIGNMENT,
    "reflow": REFLOW,
    "answer_key_pairing": ANSWER_KEY_PAIRING,
    "table_render": f"WITH {_RENDERED} SELECT l_orderkey, md FROM rendered",
    "table_parse": f"WITH {_RENDERED} SELECT l_orderkey, (r - 1)::INTEGER AS r, array_to_string(rows[r], '|') AS cells FROM (SELECT l_orderkey, rows, unnest(range(1, len(rows) + 1)) AS r FROM rendered)",
    "table_shape": f"WITH {_RENDERED} SELECT l_orderkey, CASE WHEN len(rows) >= 2 AND {_EMPTY} = 0 THEN 3 END AS columns, len(rows) >= 2 AS even FROM rendered",
    "salvage": f"WITH {_RENDERED} SELECT l_orderkey, CASE WHEN len(rows) >= 2 AND {_EMPTY} = 0 AND l_orderkey % 3 <> 0 THEN md END AS md FROM rendered",
    "render_qa": f"WITH {_RENDERED} SELECT l_orderkey, {_FINDINGS} AS findings FROM rendered",
    "precheck": f"WITH {_RENDERED} SELECT l_orderkey, concat_ws(',', CASE WHEN list_max(list_transform(flatten(rows), lambda x: len(x))) > 70 THEN 'long_cell' END, CASE WHEN len(list_filter(rows, lambda r: r[3] <> '')) > 0 THEN 'list_like_cell' END, CASE WHEN contains(md, '  ') OR contains(md, ' .') THEN 'spacing_artifact' END) AS reasons FROM rendered",
    "header_dedupe_merge": HEADER_DEDUPE_MERGE,
    "cell_diff": CELL_DIFF,
    "fidelity_verdicts": FIDELITY_VERDICTS,
    "box_lines": BOX_LINES,
    "cell_assignment": f"WITH {_PLACED} SELECT l_orderkey, l_linenumber, l_partkey, ({_COL})::INTEGER AS col FROM placed",
    "fill_edge": f"WITH {_PLACED} SELECT l_orderkey, ({_COL})::INTEGER AS col, max(x1)::DOUBLE AS fill FROM placed GROUP BY 1, 2",
    "figure_claims": FIGURE_CLAIMS,
    "orphans": ORPHANS,
    "slot_names": SLOT_NAMES,
    "dedupe_assets": DEDUPE_ASSETS,
    "image_conservation": "SELECT l_suppkey, count(*) AS placements, count(*) FILTER (l_partkey % 11 <> 0 AND l_partkey % 7 <> 0 AND l_partkey % 5 <> 0) AS claimed, count(*) FILTER (l_partkey % 11 <> 0 AND l_partkey % 7 = 0) AS orphaned, count(*) FILTER (l_partkey % 11 = 0) AS skipped, count(*) FILTER (l_partkey % 11 <> 0 AND l_partkey % 7 <> 0 AND l_partkey % 5 = 0) AS merged, true AS ok FROM lineitem GROUP BY 1",
    "referenced_assets": "SELECT p_partkey AS l_partkey FROM part WHERE p_size > 10 AND p_partkey IN (SELECT l_partkey FROM lineitem)",
    "verify_substring": VERIFY_SUBSTRING,
    "coverage": "SELECT conv_id, covered_chars, total_chars, covered_chars / greatest(1, total_chars)::DOUBLE AS ratio, covered_chars / greatest(1, total_chars)::DOUBLE >= 0.9 AS ok FROM (SELECT conv_id, coalesce(sum(len(text)) FILTER (role <> 'system'), 0)::BIGINT AS covered_chars, sum(len(text))::BIGINT AS total_chars FROM conversations GROUP BY 1)",
    "key_check": "SELECT * FROM (SELECT l_orderkey, l_linenumber, max(CASE WHEN l_partkey % 9 <> 0 THEN l_returnflag END) AS answer, min(l_returnflag) AS letter FROM lineitem GROUP BY 1, 2) WHERE answer IS DISTINCT FROM letter",
}
