"""Proposed tables against the ones that stand: records of changes, kinds of changes, verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.operators import fidelity, vocab
from pagemill.sources.tables import table

from .audit_queries import ROW_WORDS

_TEAR, _CASES = "^(.*?[a-z]{3})([a-z]{3})", 12


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents as they stand and as they are proposed: the same, torn, mended, shown otherwise, in another order, with more, less or
    other letters and numbers, with a break in a word."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "t"))
    k, t = (F.col("doc_id") + F.col("line")) % _CASES, F.col("t")
    torn = lambda by: F.regexp_replace(t, _TEAR, f"$1{by}$2")
    stands = F.when(k == 1, torn(" ")).when(k == 10, F.concat(t, F.lit(" 5 6"))).otherwise(t)
    reversed_words = F.array_join(F.reverse(F.split("t", " ")), " ")
    proposed = (
        F.when(k == 2, torn(" ")).when(k == 3, F.replace(t, F.lit(" "), F.lit("<br>"))).when(k == 4, reversed_words).when(k == 5, F.concat(t, F.lit(" zz"))).when(k == 6, t.substr(F.lit(1), F.greatest(F.length(t) - 1, F.lit(0))))
        .when(k == 7, F.translate(t, "e", "o")).when(k.isin(8, 9), F.concat(t, F.lit(" 7"), k - 1)).when(k == 10, F.concat(t, F.lit(" 6 5"))).when(k == 11, torn("<br>")).otherwise(t)
    )
    return lines.select("doc_id", "line", stands.alias("b"), proposed.alias("a"))


def _said(line: Column, b: Column, a: Column) -> Column:
    """What a proposal says of every line but each fifth: by cell, by both texts, or by the text before."""
    cell = F.when(line % 3 == 0, F.concat(F.lit(" r"), line + 1, F.lit(" c2")))
    evidence = F.when(line % 4 == 0, "Knowledge").when(line % 4 == 1, "crop").when(line % 4 == 2, "")
    confidence = F.when(line % 7 == 0, "0.25").when(line % 7 == 1, "0.75").when(line % 7 == 2, "true")
    before, after = F.when(line % 3 != 0, F.concat(F.lit(" "), b)), F.when(line % 3 == 1, a).otherwise("?")
    said = F.struct(cell.alias("cell"), before.alias("before"), after.alias("after"), F.concat(F.lit("line "), line).alias("reason"), evidence.alias("evidence"), confidence.alias("confidence"))
    return F.when(line % 5 != 4, F.struct(F.md5(F.concat(b, line)).alias("h"), said.alias("said")))


def _proposed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document as a table of two columns; the numbers on its pages are known for every second one."""
    row = F.struct("line", F.array(F.col("line").cast("string"), "b").alias("b"), F.array(F.col("line").cast("string"), "a").alias("a"))
    grouped = _lines(spark, sf_dir).groupBy("doc_id").agg(F.array_sort(F.collect_list(row)).alias("rows"), F.array_sort(F.collect_list(_said(F.col("line"), F.col("b"), F.col("a")))).alias("said"))
    evidence = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("77"), F.lit("5")))
    action = F.when(F.col("doc_id") % 10 == 0, " review")
    return grouped.select("doc_id", F.transform("rows", lambda r: r["b"]).alias("b"), F.transform("rows", lambda r: r["a"]).alias("a"), F.transform("said", lambda s: s["said"]).alias("records"), evidence.alias("e"), action.alias("action"))


def matched_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = fidelity.matched_cells(_proposed(spark, sf_dir), "doc_id", "b", "a", "records")
    return cells.where("record IS NOT NULL").select(F.col("key").alias("doc_id"), "r", "c", F.col("record.reason").alias("reason"))


def judged_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = vocab.vocab_words(table(spark, sf_dir, "documents"), "text")
    return fidelity.cell_changes(_proposed(spark, sf_dir), "doc_id", "b", "a", "e", "records", words).select(F.col("key").alias("doc_id"), "r", "c", "kind", "evidence", "confidence")


def judged_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = vocab.vocab_words(table(spark, sf_dir, "documents"), "text")
    return fidelity.verdicts(_proposed(spark, sf_dir), "doc_id", "b", "a", "e", "action", "records", words).withColumnRenamed("key", "doc_id")


_S = r"[\s\x0b\x1c-\x1f\x85\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_BR = rf"</?[Bb][Rr]{_S}*/?>"
_NUM = r"\d[\d,]*(?:\.\d+)?"
_TORN = f"regexp_replace(t, '{_TEAR}', '\\1%s\\2')"
_LINES = f"""src AS (SELECT doc_id, string_split(text, chr(10)) AS ts FROM documents WHERE text IS NOT NULL), ls AS (SELECT doc_id, unnest(range(len(ts))) AS line, unnest(ts) AS t FROM src),
ba AS (SELECT doc_id, line, (doc_id + line) % {_CASES} AS k, CASE (doc_id + line) % {_CASES} WHEN 1 THEN {_TORN % " "} WHEN 10 THEN t || ' 5 6' ELSE t END AS b,
  CASE (doc_id + line) % {_CASES} WHEN 2 THEN {_TORN % " "} WHEN 3 THEN replace(t, ' ', '<br>') WHEN 4 THEN array_to_string(list_reverse(string_split(t, ' ')), ' ') WHEN 5 THEN t || ' zz' WHEN 6 THEN t[:greatest(length(t) - 1, 0)]
  WHEN 7 THEN translate(t, 'e', 'o') WHEN 8 THEN t || ' 77' WHEN 9 THEN t || ' 78' WHEN 10 THEN t || ' 6 5' WHEN 11 THEN {_TORN % "<br>"} ELSE t END AS a FROM ls)"""
_RECORDS = r"""said AS (SELECT doc_id, line, CASE WHEN line % 3 = 0 THEN 'R' || (line + 1) || 'C2' END AS cell, CASE WHEN line % 3 <> 0 THEN regexp_replace(b, '^@+|@+$', '', 'g') ELSE '' END AS b, CASE WHEN line % 3 = 1 THEN regexp_replace(a, '^@+|@+$', '', 'g') ELSE '?' END AS a,
  CASE line % 4 WHEN 0 THEN 'medical' WHEN 1 THEN 'visual' END AS evidence, CASE line % 7 WHEN 0 THEN 0.25 WHEN 1 THEN 0.75 END::DOUBLE AS confidence, row_number() OVER (PARTITION BY doc_id ORDER BY md5(b || line)) AS i FROM ba WHERE line % 5 <> 4),
recs AS (SELECT doc_id, list({'cell': cell, 'b': b, 'a': a, 'line': line, 'evidence': evidence, 'confidence': confidence} ORDER BY i) AS recs FROM said GROUP BY doc_id),
cells AS (SELECT doc_id, line, unnest([1, 2]) AS c, unnest([line::VARCHAR, regexp_replace(b, '^@+|@+$', '', 'g')]) AS b, unnest([line::VARCHAR, regexp_replace(a, '^@+|@+$', '', 'g')]) AS a FROM ba),
walk AS (SELECT doc_id, -1::BIGINT AS pos, []::BIGINT[] AS used, NULL::BIGINT AS pick FROM recs UNION ALL
  SELECT doc_id, pos, CASE WHEN m IS NULL THEN used ELSE list_append(used, m) END, m FROM (SELECT doc_id, pos, used, CASE WHEN named IS NOT NULL AND NOT list_contains(used, named) THEN named ELSE coalesce(list_min(list_filter(range(1, len(recs) + 1), lambda i: NOT list_contains(used, i) AND recs[i].b = b AND recs[i].a = a)),
    list_min(list_filter(range(1, len(recs) + 1), lambda i: NOT list_contains(used, i) AND recs[i].b = b))) END AS m
  FROM (SELECT w.doc_id, w.pos + 1 AS pos, w.used, recs, cells.b, cells.a, list_max(list_filter(range(1, len(recs) + 1), lambda i: recs[i].cell = 'R' || (line + 1) || 'C' || c)) AS named
    FROM walk w JOIN recs ON recs.doc_id = w.doc_id JOIN cells ON cells.doc_id = w.doc_id AND 2 * line + c - 1 = w.pos + 1))),
matched AS (SELECT walk.doc_id, pos // 2 AS line, pos % 2 + 1 AS c, recs[pick] AS rec FROM walk JOIN recs ON recs.doc_id = walk.doc_id WHERE pick IS NOT NULL)""".replace("@", _S)
MATCHED_CHANGES = f"WITH RECURSIVE {_LINES}, {_RECORDS} SELECT doc_id, (line + 1)::INTEGER AS r, c::INTEGER AS c, 'line ' || rec.line AS reason FROM matched"


def _shown(x: str) -> str:
    for pattern in (_BR, f"[;,]{_S}+", f"(?:^|{_S})[•·*+]{_S}+"):
        x = f"regexp_replace({x}, '{pattern}', ' ', 'g')"
    # no look-around: what stands before and behind a dash is put back
    x = f"regexp_replace(regexp_replace({x}, '^[-–—]{_S}+([^\\d]|$)', ' \\1'), '([^\\d.]){_S}[-–—]{_S}+([^\\d]|$)', '\\1 \\2', 'g')"
    return f"trim(regexp_replace({x}, '{_S}+', ' ', 'g'))"


def _more(a: str, b: str) -> str:
    return f"list_filter(list_distinct({a}), lambda x: len(list_filter({a}, lambda y: y = x)) > len(list_filter({b}, lambda y: y = x)))"


_BARE = f"regexp_replace(%s, '{_S}+', '', 'g')"
_KINDS = f"""s AS (SELECT doc_id, line, regexp_replace(b, '^{_S}+|{_S}+$', '', 'g') AS b, regexp_replace(a, '^{_S}+|{_S}+$', '', 'g') AS a FROM ba WHERE b IS DISTINCT FROM a),
sh AS (SELECT *, {_shown("b")} AS sb, {_shown("a")} AS sa FROM s WHERE b <> a),
l AS (SELECT *, list_filter(string_split(sb, ' '), lambda x: x <> '') AS tb, list_filter(string_split(sa, ' '), lambda x: x <> '') AS ta, list_transform(regexp_extract_all(b, '{_NUM}'), lambda x: replace(x, ',', '')) AS nb, list_transform(regexp_extract_all(a, '{_NUM}'), lambda x: replace(x, ',', '')) AS na,
  list_filter(string_split({_BARE % f"regexp_replace(sb, '{_NUM}', ' ', 'g')"}, ''), lambda x: x <> '') AS lb, list_filter(string_split({_BARE % f"regexp_replace(sa, '{_NUM}', ' ', 'g')"}, ''), lambda x: x <> '') AS la,
  regexp_split_to_array(a, '{_BR}') AS brs, regexp_split_to_array(b, '{_BR}|{_S}+') AS gaps FROM sh),
p AS (SELECT *, {_more("na", "nb")} AS added, {_more("nb", "na")} AS removed, len({_more("la", "lb")}) > 0 AS more, len({_more("lb", "la")}) > 0 AS less, CASE WHEN doc_id % 2 = 0 THEN ['77', '5'] END AS e,
  list_transform(range(1, len(brs)), lambda i: list_sum(list_transform(brs[1:i], lambda x: len({_BARE % "x"})))::BIGINT) AS br_at, list_transform(range(1, len(gaps)), lambda i: list_sum(list_transform(gaps[1:i], lambda x: len(x)))::BIGINT) AS gap_at,
  len({_BARE % f"regexp_replace(a, '{_BR}', '', 'g')"}) AS n, len({_BARE % f"regexp_replace(b, '{_BR}', '', 'g')"}) AS m FROM l),
joins AS (SELECT doc_id, line, lower(tb[i] || tb[i + 1]) AS word FROM (SELECT *, unnest(range(1, len(tb))) AS i FROM p WHERE len(tb) = len(ta) + 1 AND {_BARE % "sb"} = {_BARE % "sa"})
  WHERE ta[i] = tb[i] || tb[i + 1] AND tb[1:i - 1] = ta[1:i - 1] AND (i + 2 > len(tb) OR len(list_distinct(list_transform(tb[i + 1:], lambda x: lower(x)))) > 1)),
v AS (SELECT word FROM (SELECT unnest(ws) AS word FROM row_words) GROUP BY word HAVING count(*) >= 2), restored AS (SELECT DISTINCT doc_id, line FROM joins JOIN v USING (word)),
kinds AS (SELECT p.doc_id, p.line, CASE
  WHEN {_BARE % "sb"} = {_BARE % "sa"} THEN CASE WHEN n = m AND len(list_filter(br_at, lambda x: x > 0 AND x < n AND NOT list_contains(gap_at, x))) > 0 THEN 'mid_word_break' WHEN tb = ta THEN 'presentation' WHEN list_sort(tb) = list_sort(ta) THEN 'reorder' WHEN restored.doc_id IS NOT NULL THEN 'word_restore' ELSE 'spacing' END
  WHEN list_sort(nb) <> list_sort(na) AND NOT coalesce(len(added) > 0 AND list_has_all(e, added) AND NOT list_has_any(e, removed), false) THEN 'changed_number'
  WHEN list_sort(nb) = list_sort(na) AND nb <> na THEN 'reorder'
  WHEN array_to_string(lb, '') = array_to_string(la, '') THEN CASE WHEN list_sort(nb) <> list_sort(na) THEN 'number_repair' ELSE 'reorder' END
  WHEN more AND less THEN 'content_substitution' WHEN more THEN 'hallucinated_addition' WHEN less THEN 'deletion' ELSE 'reorder' END AS kind FROM p LEFT JOIN restored USING (doc_id, line)),
judged AS (SELECT k.doc_id, k.line, kind, CASE WHEN kind = 'number_repair' THEN 'page_text' WHEN kind IN ('spacing', 'word_restore') THEN coalesce(rec.evidence, 'not_reported') ELSE rec.evidence END AS evidence,
  CASE WHEN kind = 'number_repair' THEN 0.95 WHEN kind IN ('spacing', 'word_restore') THEN coalesce(rec.confidence, 0.9) ELSE rec.confidence END::DOUBLE AS confidence FROM kinds k LEFT JOIN matched m ON m.doc_id = k.doc_id AND m.line = k.line AND m.c = 2)"""
_JUDGED = f"WITH RECURSIVE {_LINES}, {_RECORDS}, {ROW_WORDS}, {_KINDS}"
JUDGED_CHANGES = f"{_JUDGED} SELECT doc_id, (line + 1)::INTEGER AS r, 2 AS c, kind, evidence, confidence FROM judged"
JUDGED_PROPOSALS = f"""{_JUDGED}, tag AS (SELECT *, ':R' || (line + 1) || 'C2' AS place, kind IN ('changed_number', 'hallucinated_addition', 'deletion', 'content_substitution') AS fatal, CASE WHEN kind IN ('reorder', 'mid_word_break') THEN kind WHEN kind IN ('spacing', 'word_restore') THEN
  CASE WHEN evidence = 'medical' THEN 'medical_only_evidence' WHEN confidence < 0.5 THEN 'low_confidence' END END AS doubt FROM judged),
r AS (SELECT doc_id, count(tag.doc_id) AS n, coalesce(string_agg(kind || place, ',' ORDER BY line) FILTER (fatal), '') AS bad, concat_ws(',', CASE WHEN doc_id % 10 = 0 THEN 'model_action_review' END, string_agg(doubt || place, ',' ORDER BY line) FILTER (doubt IS NOT NULL)) AS doubts FROM src LEFT JOIN tag USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CASE WHEN bad <> '' THEN 'REJECT' WHEN doubts <> '' THEN 'REVIEW' ELSE 'ACCEPT' END AS verdict, CASE WHEN bad <> '' THEN bad ELSE doubts END AS reason, n AS n_changed FROM r"""

QUERIES = {f.__name__: f for f in (matched_changes, judged_changes, judged_proposals)}
ORACLES = {"matched_changes": MATCHED_CHANGES, "judged_changes": JUDGED_CHANGES, "judged_proposals": JUDGED_PROPOSALS}
