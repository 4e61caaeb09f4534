"""A whole book: page lines and printed key rows to question, answer, solution and unresolved rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagemill.functions import text as T
from pagemill.operators import claims, layout, pages, rows
from pagemill.sources.scratch import Scratch

OPTION = r"(?s)^([a-d])\)\s*(.*)$"
ON = ["subject", "chapter_no", "q_no"]


def chapters(lines: DataFrame, toc: DataFrame, offset: int, last_page: int) -> DataFrame:
    """``lines`` (subject, page, line_no, x0, y0, y1, text, height) of chapters, without footers, with ``chapter_no`` and ``pos`` in reading order.

    ``toc`` is ``subject, chapter_no, title, printed_start``; faulty contents are an error.
    """
    spans = rows.chapter_ranges(toc, offset, last_page).select("subject", "chapter_no", "file_start", "file_end")
    foot = pages.is_footer(F.col("text"), F.col("page") - offset, F.col("y1"), F.col("height"))
    pages_of = spans.select("subject", "chapter_no", F.explode(F.sequence("file_start", "file_end")).alias("page"))
    return lines.where(~foot).join(pages_of, ["subject", "page"]).withColumn("pos", F.struct("page", "y0"))


def heads(lines: DataFrame) -> DataFrame:
    """The heads that count: question headers before the key, the first key line, solution headers after it."""
    t = F.trim("text")
    zone = F.when(t.rlike(layout.ANSWER_KEY), "KEY").when(t.rlike(layout.QUESTION), "Q").when(t.rlike(layout.SOLUTION), "SOL")
    marked = lines.withColumns({"zone": zone, "q_no": F.regexp_extract(t, r"(\d+)\s*:\s*$", 1).try_cast("int")}).where("zone IS NOT NULL").select("subject", "chapter_no", "pos", "page", "zone", "q_no")
    key = marked.groupBy("subject", "chapter_no").agg(F.min(F.when(F.col("zone") == "KEY", F.col("pos"))).alias("key_pos"))
    counts = F.when(F.col("zone") == "KEY", F.col("pos") == F.col("key_pos")).when(F.col("zone") == "Q", F.coalesce(F.col("pos") < F.col("key_pos"), F.lit(True))).otherwise(F.coalesce(F.col("pos") > F.col("key_pos"), F.lit(False)))
    return marked.join(key, ["subject", "chapter_no"]).where(counts).drop("key_pos")


def _repaired(text: Column) -> Column:
    """``text, counts``: glyphs and spacing repaired, and how often each glyph rule applied."""
    return T.let(T.glyph_repair(text), lambda g: F.struct(T.spacing_fix(g["text"]).alias("text"), g["counts"].alias("counts")))


def _fixes(parts: list[DataFrame]) -> DataFrame:
    """Glyph counts of all texts of a record, by rule."""
    each = reduce(DataFrame.unionByName, [p.select(*ON, F.explode("r.counts").alias("rule", "n")) for p in parts])
    sums = each.groupBy(*ON, "rule").agg(F.sum("n").alias("n"))
    return sums.groupBy(*ON).agg(F.map_from_entries(F.collect_list(F.struct("rule", "n"))).alias("glyph_fixes"))


def _prose(body: DataFrame, boxes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines outside ruled boxes, and the boxes that take the others: whole baselines by their mean top, as printed grids are no text."""
    base = body.withColumn("base", pages.bucket(F.col("y0")))
    rows_ = base.groupBy("subject", *ON[1:], "zone", "page", "base").agg(F.avg("y0").alias("mean"))
    rows_ = rows_.withColumn("sheet", F.struct("subject", "page"))
    ruled = boxes.select(F.struct("subject", "page").alias("sheet"), "box", "by0", "by1")
    placed = pages.table_membership(rows_, ruled, "sheet", ["chapter_no", "q_no", "zone", "base"], "mean", "box").select(*ON, "zone", "page", "base", "box")
    marked = base.join(placed, [*ON, "zone", "page", "base"])
    taken = placed.where("box IS NOT NULL").groupBy(*ON).agg(F.array_sort(F.collect_set(F.struct("zone", "page", "box"))).alias("table_regions"))
    return marked.where("box IS NULL").drop("box", "base"), taken


def records(lines: DataFrame, key_words: DataFrame, boxes: DataFrame | None = None) -> DataFrame:
    """Records of all numbers of the chapters' ``lines``; ``key_words`` are visual rows (subject, page, y0, words) of the pages.

    Texts are joined as pages break them, glyphs and spacing repaired. Of each block's lines the
    stem is what stands before its first option; a letter counts if it goes beyond the last that counted.
    ``glyph_fixes`` counts the repairs of all texts of a record; a glyph that no rule explains flags it. Lines inside
    ruled ``boxes`` (subject, page, box, by0, by1; those with readable cells) are no text: ``table_regions`` says which box took some.
    """
    scratch = Scratch(lines.sparkSession, "book")
    every = scratch.write(heads(lines), "heads")
    chapter = F.struct("subject", "chapter_no").alias("chapter")
    head = every.select(chapter, "pos", "zone", "q_no")
    keyed = lines.withColumn("chapter", chapter).join(every.select(chapter, "pos", F.lit(True).alias("_head")), ["chapter", "pos"], "left").where("_head IS NULL").drop("_head")
    body = claims.owners(keyed, head, "chapter", "pos").where("zone IS NOT NULL").withColumn("at", F.struct("page", "y0", "x0", "line_no"))
    body, regions = scratch.write(body, "lines"), None
    if boxes is not None:
        body, regions = _prose(body, boxes)
    letter = F.regexp_extract(F.trim("text"), OPTION, 1)

    blocks = body.where("zone = 'Q'").groupBy(*ON).agg(F.array_sort(F.collect_list(F.struct("at", F.when(letter == "", "-").otherwise(letter).alias("m"), "page", "y0", "y1", "text"))).alias("l"))
    slots = blocks.withColumn("s", F.split(layout.assigned_options(F.transform("l", lambda x: x["m"])), "")).select(*ON, F.posexplode(F.arrays_zip("l", "s")).alias("o", "x")).select(*ON, "o", "x.l.*", F.col("x.s").alias("slot"))
    # the line that opens an option gives what stands behind its marker
    opens = (F.col("m") == F.col("slot")) & (F.row_number().over(W.partitionBy(*ON, "slot").orderBy("o")) == 1)
    slots = slots.withColumn("text", F.when(opens, F.regexp_extract(F.trim("text"), OPTION, 2)).otherwise(F.col("text"))).withColumn("g", F.struct(*ON, "slot"))
    joined = layout.reflow(slots, "g", "o", "page", "y0", "y1", "text").select("g.*", _repaired(F.col("text")).alias("r"))
    joined = scratch.write(joined, "questions")
    stems = joined.where("slot = '.'").select(*ON, F.col("r.text").alias("question_text"))
    options = joined.where("slot <> '.'").groupBy(*ON).agg(F.map_from_entries(F.collect_list(F.struct(F.upper("slot"), "r.text"))).alias("options"))
    solved = body.where("zone = 'SOL'").withColumns({"g": F.struct(*ON)})
    solutions = layout.reflow(solved, "g", "at", "page", "y0", "y1", "text").select("g.*", _repaired(F.col("text")).alias("r"))
    solutions = scratch.write(solutions, "solutions")
    fixes = _fixes([joined, solutions])
    solutions = solutions.select(*ON, F.col("r.text").alias("solution_text"))

    at = lambda zone, name: every.where(F.col("zone") == zone).groupBy(*ON).agg(F.min("page").alias(name))
    bounds = every.groupBy("subject", "chapter_no").agg(F.min(F.when(F.col("zone") == "KEY", F.col("pos"))).alias("key_pos"), F.min(F.when(F.col("zone") == "SOL", F.col("pos"))).alias("solution_pos"))
    of_page = lines.select("subject", "chapter_no", "page").distinct()
    printed = pages.key_rows(key_words.join(of_page, ["subject", "page"]).withColumn("pos", F.struct("page", "y0")).join(bounds, ["subject", "chapter_no"]).where("pos >= key_pos AND pos < solution_pos"), "words")
    keys = printed.where("q_no IS NOT NULL").select(*ON, "letter", F.col("page").alias("key_page"), "pos")
    recs = rows.records(at("Q", "q_header_page"), keys, at("SOL", "s_header_page"), ON)
    read = body.groupBy(*ON).agg(F.collect_set("page").alias("_read"))
    for part in (stems, options, solutions, read, fixes, *([] if regions is None else [regions])):
        recs = recs.join(part, ON, "left")
    none = F.array().cast("array<int>")
    fixed = F.coalesce("glyph_fixes", F.create_map().cast("map<string,bigint>"))
    odd = F.coalesce(F.try_element_at(fixed, F.lit("unknown_glyph")) > 0, F.lit(False))
    return recs.withColumns({
        "question_text": F.coalesce("question_text", F.lit("")), "solution_text": F.coalesce("solution_text", F.lit("")), "options": F.coalesce("options", F.create_map().cast("map<string,string>")),
        "source_pages": F.array_sort(F.array_union(F.coalesce("source_pages", none), F.coalesce("_read", none))), "glyph_fixes": fixed,
        "flags": F.when(odd, F.concat(F.array(F.lit("unknown_glyph")), "flags")).otherwise(F.col("flags")),
    }).drop("_read")


def rows_of(lines: DataFrame, key_words: DataFrame, toc: DataFrame, offset: int, last_page: int, boxes: DataFrame | None = None) -> dict[str, DataFrame]:
    """The four kinds of rows, and ``completeness``, of a book. Lines by zone, repaired texts and records are written, as all rows come of them."""
    recs = rows.graded(records(chapters(lines, toc, offset, last_page), key_words, boxes))
    recs = Scratch(lines.sparkSession, "book").write(recs, "records")
    return rows.fan_out(recs) | {"completeness": rows.completeness(recs)}
