"""Independent checks; an empty result, or ``ok`` everywhere, means that all is well."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def bare(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", "")


#: Characters that count for nothing when two readings of a page are compared.
EQUIVALENT = "°→Δ■\"'’‘-–—|"


@F.pandas_udf(StringType())
def _compatible(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def plain(text: Column) -> Column:
    """``text`` in compatibility form, without the characters of EQUIVALENT and without white space. Plain ASCII stays in the JVM."""
    text = F.coalesce(text, F.lit(""))
    composed = F.when(text.rlike(r"[^\x00-\x7F]"), _compatible(text)).otherwise(text)
    return bare(F.translate(composed, EQUIVALENT, ""))


def in_lines(cell: Column, lines: Column) -> Column:
    """Whether a cell is made of lines of an array, in their order and possibly with others between; an empty cell is.

    Keeps the places in the cell that some choice of lines so far reaches.
    """

    def step(reached: Column, line: Column) -> Column:
        fits = F.filter(reached, lambda at: F.substring(cell, at + 1, F.length(line)) == line)
        return F.when(line == "", reached).otherwise(F.array_distinct(F.concat(reached, F.transform(fits, lambda at: at + F.length(line)))))

    return (cell == "") | F.array_contains(F.aggregate(lines, F.array(F.lit(0)), step), F.length(cell))


def cells_printed(cells: DataFrame, lines: DataFrame, key: str, zone: str) -> DataFrame:
    """``key, ok``: whether each table's non-empty cells (``key, cell``, plain) are printed in the lines (``key, zone, lines``, plain) of one zone or another."""
    found = cells.where("cell <> ''").join(lines, key, "left").groupBy(key, "cell").agg(F.max(F.coalesce(in_lines(F.col("cell"), F.col("lines")), F.lit(False))).alias("_ok"))
    return cells.select(key).distinct().join(found.groupBy(key).agg(F.min("_ok").alias("_ok")), key, "left").select(key, F.coalesce("_ok", F.lit(True)).alias("ok"))


def not_printed(fields: DataFrame, zones: DataFrame, zone_key: str, text: str, zone: str) -> DataFrame:
    """Fields that their zone does not print, white space apart; blank fields pass."""
    joined = fields.join(zones.select(zone_key, bare(F.col(zone)).alias("_zone")), zone_key).withColumn("_own", bare(F.col(text)))
    return joined.where((F.col("_own") != "") & ~F.contains("_zone", "_own")).drop("_zone", "_own")


def coverage(lines: DataFrame, group: str, n_chars: str, covered: str, least: float = 0.97) -> DataFrame:
    """``group, covered_chars, total_chars, ratio, ok``."""
    sums = lines.groupBy(group).agg(F.coalesce(F.sum(F.when(F.col(covered), F.col(n_chars))), F.lit(0)).cast("long").alias("covered_chars"), F.sum(n_chars).cast("long").alias("total_chars"))
    return sums.withColumn("ratio", F.col("covered_chars") / F.greatest(F.lit(1), "total_chars")).withColumn("ok", F.col("ratio") >= least)


def key_differs(answers: DataFrame, printed: DataFrame, key: list[str], answer: str, letter: str) -> DataFrame:
    """Answers that differ from the key as read a second time; a missing one differs from a letter."""
    return answers.join(printed, key).where(~F.col(answer).eqNullSafe(F.col(letter))).select(*key, answer, letter)


def both(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys on both sides, where there should be none."""
    return a.select(key).join(b.select(key), key, "left_semi").distinct()


#: Lines that open the verifier's zones, and lines that are no content of a zone.
KEY_LINE, SOLUTION_LINE = r"(?i)^Answer\s*Key\s*$", r"(?i)^Solution\s+to\s+Question\s+(\d+)\s*:\s*$"
FURNITURE = (r"(?i)^Question\s+\d+\s*:\s*$", SOLUTION_LINE, r"(?i)^Detailed\s+Explanations?\s*$", r"^\d{1,3}\s+[a-dA-D]$", KEY_LINE)
MARKER = r"^[a-d]\)"


def zones(lines: DataFrame, chapter: str, order: list[str], text: str) -> DataFrame:
    """``lines`` with ``zone``: Q up to the first key line, which is in none, K up to the first solution header after it, S from there on."""
    pos = F.struct(*order)
    marked = lines.withColumn("_pos", pos)
    key = marked.groupBy(chapter).agg(F.min(F.when(F.col(text).rlike(KEY_LINE), F.col("_pos"))).alias("_k"))
    both = marked.join(key, chapter)
    sol = both.where(F.col(text).rlike(SOLUTION_LINE) & (F.col("_pos") > F.col("_k"))).groupBy(chapter).agg(F.min("_pos").alias("_s"))
    out = both.join(sol, chapter, "left").where(F.col("_k").isNull() | (F.col("_pos") != F.col("_k")))
    zone = F.when(F.col("_k").isNull() | (F.col("_pos") < F.col("_k")), "Q").when(F.col("_s").isNull() | (F.col("_pos") < F.col("_s")), "K").otherwise("S")
    return out.withColumn("zone", zone).drop("_pos", "_k", "_s")


def zone_texts(zoned: DataFrame, chapter: str, order: list[str], text: str) -> DataFrame:
    """``chapter, zone, printed``: the plain text of each zone's content, headers left out and option markers cut."""
    content = zoned
    for pattern in FURNITURE:
        content = content.where(~F.col(text).rlike(pattern))
    listed = F.array_sort(F.collect_list(F.struct(*order, F.regexp_replace(text, MARKER, "").alias("_t"))))
    joined = content.groupBy(chapter, "zone").agg(F.array_join(F.transform(listed, lambda x: x["_t"]), " ").alias("_t"))
    return joined.select(chapter, "zone", plain(F.col("_t")).alias("printed"))
