"""Output rows: ids, anchors, grades, the four row kinds of a chapter, completeness, chapter ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LETTERS = ("A", "B", "C", "D")
#: Where a field comes from; grades and statuses of a record.
TEXT_LAYER = "TEXT_LAYER"
GRADES = ("RESOLVED_ANCHORED", "RESOLVED")
STATUSES = ("INCOMPLETE", "REVIEW_NEEDED", "READY")


def q_id(subject: Column, chapter: Column, number: Column) -> Column:
    return F.format_string("%s-%03d-%03d", subject, chapter, number)


def filled(x: Column) -> Column:
    return F.trim(F.coalesce(x, F.lit(""))) != ""


def some(x: Column) -> Column:
    """Whether there is any text, blanks included."""
    return F.coalesce(x, F.lit("")) != ""


def _named(*parts: tuple[Column, str]) -> Column:
    """The names of those parts whose condition holds, in order."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for cond, name in parts]))


def four_options(options: Column) -> Column:
    four = F.lit(True)
    for letter in LETTERS:
        four = four & filled(F.try_element_at(options, F.lit(letter)))
    return four


def missing_fields(stem: Column, options: Column, answer: Column, solution: Column) -> Column:
    return _named((~filled(stem), "question_text"), (~four_options(options), "options"), (~some(answer), "correct_option"), (~filled(solution), "solution_text"))


def reasons(flags: Column, missing: Column) -> Column:
    """Flags, an unknown glyph last of them, then the missing fields."""
    odd = lambda f: f == "unknown_glyph"
    return F.concat(F.filter(flags, lambda f: ~odd(f)), F.slice(F.filter(flags, odd), 1, 1), F.transform(missing, lambda m: F.concat(F.lit("missing:"), m)))


def qa_status(missing: Column, flags: Column) -> Column:
    return F.when(F.size(missing) > 0, STATUSES[0]).when(F.size(flags) > 0, STATUSES[1]).otherwise(STATUSES[2])


def grade(has_question: Column, has_key: Column, has_solution: Column) -> Column:
    """All three printed anchors, or fewer."""
    return F.when(has_question & has_key & has_solution, GRADES[0]).otherwise(GRADES[1])


def unresolved_reason(answer: Column, solution: Column) -> Column:
    """Why a number without a question header has no row."""
    return (
        F.when(some(answer) & some(solution), "missing_question_for_solution")
        .when(some(solution), "solution_q_no_not_in_printed_header")
        .when(some(answer), "answer_q_no_not_in_printed_key")
        .otherwise("no_anchor_at_all")
    )


def records(questions: DataFrame, keys: DataFrame, solutions: DataFrame, on: list[str]) -> DataFrame:
    """Every number that any of the three has, with what each has, and the ``flags`` of what is absent; of doubled key rows the last one counts.

    ``questions`` and ``solutions`` have a page column each (``q_header_page``, ``s_header_page``), keys ``letter, key_page, pos``.
    """
    last = keys.groupBy(*on).agg(F.max_by(F.struct(F.upper("letter").alias("letter"), "key_page"), "pos").alias("k")).select(*on, F.col("k.letter").alias("correct_option"), "k.key_page")
    both = questions.join(last, on, "full_outer").join(solutions, on, "full_outer")
    absent = _named((F.col("q_header_page").isNull(), "no_question_header"), (F.col("key_page").isNull(), "no_key_row"), (F.col("s_header_page").isNull(), "no_solution_header"))
    pages = F.array_sort(F.array_distinct(F.array_compact(F.array("q_header_page", "key_page", "s_header_page"))))
    return both.withColumns({"flags": absent, "source_pages": pages, "correct_option": F.coalesce("correct_option", F.lit(""))})


def graded(recs: DataFrame) -> DataFrame:
    """``recs`` (``records`` with texts, options, flags and anchor pages) with ``q_id, missing, q_id_grade, qa_status, qa_reasons``."""
    out = recs.withColumn("missing", missing_fields(F.col("question_text"), F.col("options"), F.col("correct_option"), F.col("solution_text")))
    has = [F.coalesce(F.col(c) > 0, F.lit(False)) for c in ("q_header_page", "key_page", "s_header_page")]
    return out.withColumns({
        "q_id": q_id(F.col("subject"), F.col("chapter_no"), F.col("q_no")),
        "q_id_grade": grade(*has),
        "qa_status": qa_status(F.col("missing"), F.col("flags")),
        "qa_reasons": reasons(F.col("flags"), F.col("missing")),
    })


def anchors() -> Column:
    """What of a record is printed where; absent parts and zero counts are left out (null, or an empty map)."""
    known = [("question_text", some(F.col("question_text"))), ("options", F.size("options") > 0), ("correct_option", some(F.col("correct_option"))), ("solution_text", some(F.col("solution_text")))]
    sources = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(k), F.when(c, F.lit(TEXT_LAYER)).alias("v")) for k, c in known]), lambda e: e["v"].isNotNull()))
    at = lambda page: F.when(F.col(page) > 0, F.struct(F.col(page).alias("page")))
    return F.struct(
        F.col("q_no").alias("model_q_no"), sources.alias("field_provenance"), at("q_header_page").alias("printed_question_header"), at("key_page").alias("printed_key_row"),
        at("s_header_page").alias("printed_solution_header"), F.when(F.size("source_pages") > 0, F.struct(F.lit("page_set").alias("kind"), F.array_sort("source_pages").alias("pages"))).alias("section_position"),
        F.map_filter("glyph_fixes", lambda _, n: n > 0).alias("glyph_fixes"),
    )


def image_refs(files: Column, pages: Column) -> Column:
    """``files`` with the page that each was first seen on; ``pages`` is a map."""
    return F.transform(files, lambda f: F.struct(f.alias("file"), F.array(F.try_element_at(pages, f)).alias("source_pages")))


def _extraction(missing: Column) -> list[Column]:
    return [F.when(F.size(missing) > 0, "INCOMPLETE").otherwise("COMPLETE").alias("extraction_status"), missing.alias("missing_fields")]


def fan_out(recs: DataFrame) -> dict[str, DataFrame]:
    """The ``question``, ``answer``, ``solution`` and ``unresolved`` rows of graded records.

    A number without a printed question header makes an unresolved row only: a stem is never
    invented. Each other record makes a row of each of the three kinds, with its own missing fields.
    """
    full = recs.withColumn("q_no_anchors", anchors())
    lost = F.array_contains("flags", "no_question_header")
    kept = full.where(~lost)
    ids = ["q_id", "subject", "chapter_no", "q_no", "q_id_grade", "q_no_anchors", "source_pages", "qa_status", "qa_reasons"]
    options = F.array(*[F.struct(F.lit(x).alias("id"), F.coalesce(F.try_element_at("options", F.lit(x)), F.lit("")).alias("text")) for x in LETTERS])
    stem_missing = _named((~filled(F.col("question_text")), "question_text"), (~four_options(F.col("options")), "options"))
    source = lambda c: F.when(some(F.col(c)), F.lit(TEXT_LAYER)).alias(f"{c}_prov")
    return {
        "question": kept.select(*ids, "question_text", options.alias("options"), source("question_text"), *_extraction(stem_missing)),
        "answer": kept.select(*ids, F.nullif("correct_option", F.lit("")).alias("correct_option"), source("correct_option"), *_extraction(_named((~some(F.col("correct_option")), "correct_option")))),
        "solution": kept.select(*ids, "solution_text", source("solution_text"), *_extraction(_named((~filled(F.col("solution_text")), "solution_text")))),
        "unresolved": full.where(lost).select("q_id", "subject", "chapter_no", "q_no", F.lit("unresolved_qid").alias("kind"), unresolved_reason(F.col("correct_option"), F.col("solution_text")).alias("reason"), "q_no_anchors", "source_pages"),
    }


def completeness(recs: DataFrame) -> DataFrame:
    """One row for each chapter of graded records: counts of rows, of incomplete ones, of grades and statuses, and the unresolved numbers.

    One aggregate over the records instead of one over each kind of row.
    """
    lost = F.array_contains("flags", "no_question_header")
    kept = ~lost
    stem_short = kept & (~filled(F.col("question_text")) | ~four_options(F.col("options")))
    no_answer, no_solution = kept & ~some(F.col("correct_option")), kept & ~filled(F.col("solution_text"))
    n = F.count_if
    out = recs.groupBy("subject", "chapter_no").agg(
        n(kept).alias("question_records"), n(stem_short).alias("incomplete_questions"), n(no_answer).alias("incomplete_answers"), n(no_solution).alias("incomplete_solutions"),
        n(lost).alias("unresolved_qid_count"), F.array_sort(F.collect_list(F.when(lost, F.col("q_no")))).alias("unresolved_qid_q_nos"),
        *[n(kept & (F.col("q_id_grade") == g)).alias(f"grade_{g.lower()}") for g in GRADES], *[n(kept & (F.col("qa_status") == s)).alias(f"qa_{s.lower()}") for s in STATUSES],
    )
    short = F.col("incomplete_questions") + F.col("incomplete_answers") + F.col("incomplete_solutions")
    return out.withColumns({"rows_incomplete": short, "rows_complete": 3 * F.col("question_records") - short})


def chapter_faults(chapters: DataFrame, offset: int, last_page: int, subject: str = "subject") -> DataFrame:
    """``chapters`` with the file pages they span and ``fault``: null, or why the contents cannot be right.

    Printed starts must rise, a start must lie in the file, a range must hold a page.
    """
    w = W.partitionBy(subject).orderBy("chapter_no")
    out = chapters.withColumn("file_start", F.col("printed_start") + offset)
    out = out.withColumns({"file_end": F.coalesce(F.lead("file_start").over(w) - 1, F.lit(last_page)), "_before": F.lag("printed_start").over(w)})
    fault = (
        F.when(F.col("printed_start") <= F.col("_before"), "pages not increasing")
        .when(~F.col("file_start").between(1, last_page), "start page outside the file")
        .when(F.col("file_end") < F.col("file_start"), "empty page range")
    )
    return out.withColumn("fault", fault).drop("_before")


def chapter_ranges(chapters: DataFrame, offset: int, last_page: int, subject: str = "subject") -> DataFrame:
    """Chapters with the file pages they span; any fault is an error."""
    found = chapter_faults(chapters, offset, last_page, subject)
    failed = F.raise_error(F.concat(F.lit("chapter "), F.col("chapter_no").cast("string"), F.lit(": "), F.col("fault"))).cast("int")
    return found.withColumn("file_end", F.when(F.col("fault").isNull(), F.col("file_end")).otherwise(failed)).drop("fault")


def first_seen(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key."""
    return rows.groupBy(key).agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("r")).select("r.*")
