"""Reports: refinement audits, receipts, export bundles, regression counts, status listings, chapter subsets, edit patches."""

from __future__ import annotations

import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Fields of a question that people may edit; kinds of repairs and of rejections that a report counts.
EDITABLE = ("question_text", "options", "solution_text", "correct_option")
REPAIRS = {"spacing_repairs": "spacing", "medical_spelling_repairs": "word_restore", "number_repairs": "number_repair"}
REJECTIONS = {"rejected_hallucinations": "hallucinated_addition", "rejected_deletions": "deletion", "rejected_number_changes": "changed_number", "structural_rejections": "structural_change"}


def refinement_audit(ledger: DataFrame, subject: str) -> DataFrame:
    """One row for each subject of the latest ledger rows (``status, cross_page, kinds, reject_reasons, render_findings``; arrays may be null).

    ``kinds`` are those of a refinement's changes and count where it was accepted; a reason's head is
    what stands before its colon.
    """
    accepted, kinds = F.col("status") == "accepted", F.coalesce("kinds", F.array().cast("array<string>"))
    heads = F.transform(F.coalesce("reject_reasons", F.array().cast("array<string>")), lambda r: F.substring_index(r, ":", 1))
    n = lambda *names: F.count_if(F.col("status").isin(*names))
    times = lambda arr, value: F.coalesce(F.sum(F.size(F.filter(arr, lambda x: x == value))), F.lit(0))
    only_shown = accepted & (F.size(kinds) > 0) & F.forall(kinds, lambda k: k == "presentation")
    return ledger.groupBy(subject).agg(
        F.count("*").alias("total_tables"), n("no_change", "skip").alias("tables_unchanged"), n("accepted").alias("tables_refined"), n("rejected", "invalid").alias("tables_rejected"),
        n("review").alias("tables_review"), n("empty").alias("tables_no_answer"), *[times(F.when(accepted, kinds), k).alias(c) for c, k in REPAIRS.items()], F.count_if(only_shown).alias("presentation_only_refinements"),
        F.count_if("cross_page").alias("cross_page_tables_checked"), F.sum(F.size(heads)).alias("fidelity_violations"), *[times(heads, k).alias(c) for c, k in REJECTIONS.items()], F.count_if("render_findings").alias("render_page_waste_issues"),
    )


def corrections(ledger: DataFrame, limit: int | None = None) -> DataFrame:
    """The changes of accepted refinements that are not of presentation only, by key and place; the first ``limit`` of them if given."""
    rows = ledger.where("status = 'accepted'").select("key", F.posexplode("kinds").alias("at", "kind")).where("kind <> 'presentation'")
    return rows if limit is None else rows.orderBy("key", "at").limit(limit)


def refined_count(ledger: DataFrame, key: str = "key") -> DataFrame:
    """``subject, refined``: distinct keys by what stands before their first bar."""
    return ledger.where(F.col(key).contains("|")).groupBy(F.substring_index(key, "|", 1).alias("subject")).agg(F.count_distinct(key).alias("refined"))


def used_model(cache: DataFrame) -> bool:
    """Whether any response was kept."""
    return not cache.isEmpty()


def receipt(chapters: DataFrame, manifest: DataFrame, decisions: DataFrame, edits: DataFrame, subject: str) -> DataFrame:
    """One row for each subject with chapters: what an export ships. Each part is counted by itself and joined on the subject."""
    count = lambda df, name, c="*": df.groupBy(subject).agg((F.count_distinct(c) if c != "*" else F.count("*")).alias(name))
    out = count(chapters, "chapters")
    for part in (count(manifest, "images_shipped", "file"), count(decisions, "review_decisions", "key"), count(edits, "human_edits")):
        out = out.join(part, subject, "left")
    return out.na.fill(0, ["images_shipped", "review_decisions", "human_edits"])


def bundle(split_files: DataFrame, manifest: DataFrame, assets: DataFrame) -> DataFrame:
    """``path, kind``: what an export holds: the split files, and those assets that are both named by a manifest row and there."""
    named = manifest.select("file").distinct().join(assets.select("file"), "file", "left_semi")
    return split_files.select(F.col("path"), F.lit("data").alias("kind")).unionByName(named.select(F.concat(F.lit("images/"), "file").alias("path"), F.lit("asset").alias("kind")))


def is_safe(path: Column) -> Column:
    """Whether a relative path stays under its base: never more steps up than down, and not absolute."""
    steps = F.transform(F.split(path, "/"), lambda s: F.when(s == "..", -1).when((s == "") | (s == "."), 0).otherwise(1))
    depth = F.aggregate(steps, F.struct(F.lit(0).alias("at"), F.lit(0).alias("least")), lambda a, s: F.struct((a["at"] + s).alias("at"), F.least(a["least"], a["at"] + s).alias("least")), lambda a: a["least"])
    return ~path.startswith("/") & (depth >= 0)


def write_zip(files: list[tuple[str, str]], folder: str, dest: str) -> int:
    """Packs (path in the archive, path under ``folder``) into ``dest`` by way of a part file; paths that leave the folder are refused."""
    base, part = Path(folder).resolve(), Path(f"{dest}.part")
    with zipfile.ZipFile(part, "w", zipfile.ZIP_DEFLATED) as z:
        for name, source in files:
            path = (base / source).resolve()
            if not path.is_relative_to(base):
                raise ValueError(f"{source} is not under {folder}")
            z.write(path, name)
    part.replace(dest)
    return len(files)


def regression_counts(records: DataFrame, group: str) -> DataFrame:
    """Questions, answers, solutions, tables and tables over pages; ``tables`` is an array of records."""
    filled = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) != ""
    crossing = F.size(F.filter("tables", lambda t: t["merged_continuation"]))
    return records.groupBy(group).agg(F.count("*").alias("questions"), F.count_if(F.coalesce("correct_option", F.lit("")) != "").alias("answers"), F.count_if(filled("solution_text")).alias("solutions"), F.sum(F.size("tables")).alias("tables"), F.sum(crossing).alias("cross_page_tables"))


def chapter_subset(spec: str) -> set[int]:
    """``1,3-5`` as numbers; blanks between commas are passed over."""
    out: set[int] = set()
    for part in filter(None, (p.strip() for p in spec.split(","))):
        lo, dash, hi = part.partition("-")
        out.update(range(int(lo), int(hi if dash else lo) + 1))
    return out


def of_chapters(rows: DataFrame, chapter: str, spec: str) -> DataFrame:
    return rows.where(F.col(chapter).isin(sorted(chapter_subset(spec))))


def editable(patch: Column) -> Column:
    """Of a map of fields only those that people may edit."""
    return F.map_filter(patch, lambda k, _: k.isin(*EDITABLE))


def last_lines(log: DataFrame, group: str, order: str, n: int = 400) -> DataFrame:
    """The last ``n`` lines of each job's log; ranked, so that a task holds one job's lines."""
    w = W.partitionBy(group).orderBy(F.desc(order))
    return log.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def stamp(ts: Column) -> Column:
    """A time as the rows carry it, in UTC to the second."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def run_totals(chapters: DataFrame, group: str, status: str) -> DataFrame:
    """``group, status, n`` and the chapters whose census failed, in order."""
    return chapters.groupBy(group, status).agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.when(~F.col("census_ok"), F.col("chapter")))).alias("failed"))
