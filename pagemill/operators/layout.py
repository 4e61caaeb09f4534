"""Page order: zones, blocks, options, reflow, runs, votes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Lines that open a question, the answer key, a solution; lines that open a list item.
QUESTION = r"(?i)^Question\s+(\d+)\s*:\s*$"
ANSWER_KEY = r"(?i)^Answer\s*Key\s*$"
SOLUTION = r"(?i)^Solution\s+to\s+Question\s+(\d+)\s*:\s*$"
LIST_ITEM = r"(?i)^(?:•|\(\d+\)|\d+\.\s|Option\s+[A-D]\s*:)"


def owned(rows: DataFrame, group: str, order: list[str], is_header: Column, header: Column, strict: bool = True) -> DataFrame:
    """``rows`` with ``block``, the nearest header before each row of its group; header rows and rows before any go.

    An ordered window instead of a range join: blocks do not overlap. Groups are pages or
    chapters, which are bounded. ``strict`` leaves out rows at a header's own place.
    """
    w = W.partitionBy(group).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    place = F.struct(*order)
    out = rows.withColumn("_h", F.last(F.when(is_header, F.struct(header.alias("block"), place.alias("at"))), ignorenulls=True).over(w))
    keep = (place > F.col("_h.at")) if strict else (place >= F.col("_h.at"))
    return out.where(F.col("_h").isNotNull() & ~is_header & keep).withColumn("block", F.col("_h.block")).drop("_h")


def assigned_options(letters: Column) -> Column:
    """For an array of marker letters ('-' for none) the letter each place belongs to, as one string ('.': the stem).

    A marker counts if it is 'a' at first, and later if it is beyond the last one that counted.
    """
    start = F.struct(F.lit("").alias("out"), F.lit("").alias("now"))

    def step(acc: Column, x: Column) -> Column:
        counts = F.when(acc["now"] == "", x == "a").otherwise((x > acc["now"]) & (x != "-"))
        now = F.when(counts, x).otherwise(acc["now"])
        return F.struct(F.concat(acc["out"], F.when(now == "", ".").otherwise(now)).alias("out"), now.alias("now"))

    return F.aggregate(letters, start, step, lambda acc: acc["out"])


def upper_median(values: Column) -> Column:
    return F.get(F.array_sort(values), F.floor(F.size(values) / 2).cast("int"))


def reflow(lines: DataFrame, group: str, order: str, page: str, y0: str, y1: str, text: str) -> DataFrame:
    """``group, text``: non-empty lines joined by a space, or by a line break at a wide gap or a list item.

    The median gap is over all lines of a page; half of it is wide where it is 3 points or more,
    one and a half times it otherwise.
    """
    stripped = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"(?U)^\s+|\s+$", "")
    w = W.partitionBy(group).orderBy(order)
    gap = F.when(F.lag(page).over(w) == F.col(page), F.col(y0) - F.lag(y1).over(w))
    gaps = lines.withColumn("_gap", gap).groupBy(group).agg(upper_median(F.filter(F.collect_list("_gap"), lambda g: g > 0)).alias("med"))
    body = lines.withColumn(text, stripped).where(F.col(text) != "").withColumns({"_gap": gap, "_first": F.row_number().over(w) == 1, "_same": F.lag(page).over(w) == F.col(page)})
    wide = F.when(F.col("med") >= 3, 0.5 * F.col("med")).otherwise(1.5 * F.col("med"))
    sep = F.when(F.col("_first"), "").when(F.coalesce(F.col("_same") & (F.col("_gap") > wide), F.lit(False)), "\n").when(F.col(text).rlike(LIST_ITEM), "\n").otherwise(" ")
    joined = body.join(gaps, group, "left").select(group, F.col(order).alias("o"), F.concat(sep, F.col(text)).alias("t"))
    return joined.groupBy(group).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "t"))), lambda x: x["t"]), "").alias("text"))


def census(rows: DataFrame, group: str, number: str) -> DataFrame:
    """``group, n, expected, duplicates, contiguous`` of printed numbers that should be 1 to n."""
    agg = rows.groupBy(group).agg(F.count("*").alias("n"), F.max(number).alias("expected"), F.count_distinct(number).alias("d"), F.min(number).alias("lo"))
    contiguous = (F.col("n") == F.col("d")) & (F.col("lo") == 1) & (F.col("expected") == F.col("n"))
    return agg.select(group, "n", F.col("expected").cast("long").alias("expected"), (F.col("n") - F.col("d")).alias("duplicates"), contiguous.alias("contiguous"))


def anomalies(rows: DataFrame, group: str, number: str) -> DataFrame:
    """``group, anomaly``: doubled numbers, and groups whose numbers are not 1 to n."""
    c = census(rows, group, number)
    doubled = rows.groupBy(group, number).count().where("count > 1").select(group, F.concat(F.lit("duplicate number "), F.col(number).cast("string")).alias("anomaly"))
    broken = c.where("NOT contiguous").select(group, F.concat(F.lit("numbers are not 1.."), F.col("n").cast("string")).alias("anomaly"))
    return doubled.unionByName(broken)


#: Rows of one partition of a window, about: what its sort holds follows from that and not from the input.
DEALT = 1 << 19


def dealt(rows: DataFrame, n: int, *keys: str) -> DataFrame:
    """``rows`` (about ``n``) by ``keys``, in more partitions where they are many; at few rows the session's own number serves."""
    parts = -(-n // DEALT)
    return rows.repartition(parts, *keys) if parts > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) else rows


def longest_run(rows: DataFrame, group: str, order: list[str], number: str, page: str) -> DataFrame:
    """``group, start, length``: the longest stretch whose numbers step by one and whose pages rise; the first of equal ones."""
    rows = dealt(rows, rows.count(), group)
    w = W.partitionBy(group).orderBy(*order)
    broken = ~F.coalesce((F.col(number) == F.lag(number).over(w) + 1) & (F.col(page) > F.lag(page).over(w)), F.lit(False))
    runs = rows.select(group, *order, number, F.row_number().over(w).alias("rn"), broken.cast("int").alias("b")).withColumn("run", F.sum("b").over(W.partitionBy(group).orderBy("rn").rowsBetween(W.unboundedPreceding, 0)))
    sized = runs.groupBy(group, "run").agg(F.count("*").alias("length"), F.min_by(number, "rn").alias("start"))
    return sized.groupBy(group).agg(F.max_by(F.struct("start", "length"), F.struct("length", -F.col("run"))).alias("r")).select(group, "r.*")


def offset_vote(votes: DataFrame, group: str, offset: str) -> DataFrame:
    """``group, offset, n``: the commonest offset; of equal ones the nearest to zero, then the smaller."""
    n = votes.groupBy(group, offset).agg(F.count("*").alias("n"))
    best = F.max_by(F.struct(F.col(offset).alias("offset"), "n"), F.struct("n", -F.abs(offset), -F.col(offset)))
    return n.groupBy(group).agg(best.alias("r")).select(group, "r.*")


def key_pairs(lines: DataFrame, group: str, order: list[str], number: Column, letter: Column) -> DataFrame:
    """``group, number, letter``: a number line and the letter line just after it; the first pair of a number counts."""
    w = W.partitionBy(group).orderBy(*order)
    pairs = lines.select(group, F.row_number().over(w).alias("rn"), number.alias("number"), F.lead(letter).over(w).alias("letter")).where("number IS NOT NULL AND letter IS NOT NULL")
    return pairs.groupBy(group, "number").agg(F.min_by("letter", "rn").alias("letter"))
