"""The whole verifier: rows of a book against its pages, read a second time, as one table of failures.

Lines and boxes are read here by rules of their own; nothing of the extraction is used but its rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import verify as V

#: A page's own number that stands alone below this share of its height is no content.
FOOT = 0.88
#: Points within which rules touch.
TOUCH = 3.0
COVERED = 0.97
_ORDER = ["page", "base", "x0"]


def own_lines(lines: DataFrame) -> DataFrame:
    """``chapter, page, base, x0, text`` of raw ``lines`` (chapter, page, printed, height, x0, y0, y1, text): trimmed, not blank, without page
    numbers, in the order of their baselines."""
    text = F.regexp_replace("text", r"(?U)^\s+|\s+$", "")
    foot = (text == F.col("printed").cast("string")) & (F.col("y1") > F.col("height") * FOOT)
    return lines.where((text != "") & ~foot).select("chapter", "page", F.rint(F.col("y0") / 3.0).cast("long").alias("base"), "x0", text.alias("text"))


def component_boxes(segments: DataFrame) -> DataFrame:
    """``page, x0, y0, x1, y1``: boxes around rules that touch one another, directly or by others, with three level ones or two of each kind.

    ``segments`` are ``page, x0, y0, x1, y1``; level rules are longer than 60 points, upright ones than 8, both thinner than 2.5. A page's
    rules are one array: components are found by spreading the least number of neighbours.
    """
    wide, high = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    level, upright = (high < 2.5) & (wide > 60), (wide < 2.5) & (high > 8)
    rules = segments.where(level | upright).groupBy("page").agg(F.collect_list(F.struct(*[F.col(c).cast("double").alias(c) for c in ("x0", "y0", "x1", "y1")], level.alias("level"))).alias("r"))
    kind = segments.schema["page"].dataType.simpleString()

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                rows = batch.column("r")[k].as_py()
                a = np.array([[r[c] for c in ("x0", "y0", "x1", "y1")] for r in rows])
                low, up = np.array([r["level"] for r in rows]), np.array([not r["level"] for r in rows])
                touch = ((a[:, None, :2] <= a[None, :, 2:] + TOUCH) & (a[:, None, 2:] >= a[None, :, :2] - TOUCH)).all(axis=2)
                label, before = np.arange(len(a)), None
                while before is None or (label != before).any():
                    before = label
                    label = np.where(touch, label[None, :], len(a)).min(axis=1)
                groups = [g for g in (label == n for n in np.unique(label)) if low[g].sum() >= 3 or (low[g].sum() >= 2 and up[g].sum() >= 2)]
                boxes = np.array([[*a[g][:, :2].min(axis=0), *a[g][:, 2:].max(axis=0)] for g in groups]).reshape(-1, 4)
                page = batch.column("page").slice(k, 1).take(pa.array([0] * len(boxes), pa.int32()))
                yield pa.RecordBatch.from_arrays([page, *(pa.array(boxes[:, c]) for c in range(4))], names=["page", "x0", "y0", "x1", "y1"])

    return rules.mapInArrow(found, f"page {kind}, x0 double, y0 double, x1 double, y1 double")


def printed_keys(zoned: DataFrame) -> DataFrame:
    """``chapter, q_no, letter`` as the key zone prints them: a number and its letter on one line or on two, of several the first."""
    pos = F.struct(*_ORDER)
    w = W.partitionBy("chapter").orderBy(*_ORDER)
    k = zoned.where("zone = 'K'").withColumn("last", F.lag("text").over(w))
    both = F.regexp_extract("text", r"^(\d{1,3})\s+([a-dA-D])$", 1)
    apart = F.col("text").rlike("^[a-dA-D]$") & F.coalesce(F.col("last").rlike(r"^\d+$"), F.lit(False))
    pairs = k.select("chapter", pos.alias("pos"), F.when(both != "", both).when(apart, F.col("last")).try_cast("int").alias("q_no"), F.upper(F.right("text", F.lit(1))).alias("letter"))
    return pairs.where("q_no IS NOT NULL").groupBy("chapter", "q_no").agg(F.min_by("letter", "pos").alias("letter"))


def _failures(df: DataFrame, kind: str, where: str, detail: Column) -> DataFrame:
    return df.select("chapter", F.lit(kind).alias("kind"), F.col(where).cast("string").alias("at"), detail.cast("string").alias("detail"))


def failures(lines: DataFrame, questions: DataFrame, solutions: DataFrame, answers: DataFrame, images: DataFrame, manifest: DataFrame) -> DataFrame:
    """``chapter, kind, at, detail`` of all that is wrong; empty where a book is as it is printed.

    ``lines``: see ``own_lines``. ``questions`` are ``chapter, q_id, question_text, options`` (array of id, text) and ``tables`` (array of
    table_id, rows: cells); ``solutions`` ``chapter, q_id, solution_text, tables``; ``answers`` ``chapter, q_id, q_no, correct_option``; ``images`` ``chapter, placed,
    claimed, table_renders, orphans, skipped, merged``; ``manifest`` ``chapter, table_id`` of shipped pictures, null for figures.

    Kinds: ``text`` (a stem, option or solution that neither zone prints), ``table`` (cells that are no lines of a zone), ``coverage`` (under 97 % of
    the zones' characters), ``answer``, ``images`` (placements that are not accounted for), ``separation`` (a table shipped as a picture, too).
    """
    zoned = V.zones(own_lines(lines), "chapter", _ORDER, "text")
    zones = V.zone_texts(zoned.where("zone <> 'K'"), "chapter", _ORDER, "text").groupBy("chapter").agg(F.concat_ws("\n", F.sort_array(F.collect_list("printed"))).alias("printed"), F.sum(F.length("printed")).alias("total"))
    fields = reduce(DataFrame.unionByName, [
        questions.select("chapter", "q_id", F.lit("question_text").alias("field"), F.col("question_text").alias("text")),
        questions.select("chapter", "q_id", F.explode("options").alias("o")).select("chapter", "q_id", F.concat(F.lit("option "), "o.id").alias("field"), "o.text"),
        solutions.select("chapter", "q_id", F.lit("solution_text").alias("field"), F.col("solution_text").alias("text")),
    ]).withColumn("own", V.plain(F.col("text"))).where("own <> ''")
    met = fields.join(zones, "chapter", "left").withColumn("there", F.coalesce(F.contains("printed", "own"), F.lit(False)))
    lost = _failures(met.where("NOT there"), "text", "q_id", F.col("field"))

    held = questions.select("chapter", "q_id", "tables").unionByName(solutions.select("chapter", "q_id", "tables"))
    tables = held.select("chapter", "q_id", F.explode("tables").alias("t")).select("chapter", F.struct("chapter", "t.table_id").alias("table"), "q_id", F.flatten("t.rows").alias("cells"))
    once = tables.groupBy("chapter", "table").agg(F.min_by("cells", "q_id").alias("cells"), F.min("q_id").alias("q_id"))
    cells = once.select("chapter", "table", "q_id", F.explode("cells").alias("c")).withColumn("cell", V.plain(F.col("c"))).where("cell <> ''")
    listed = zoned.where("zone <> 'K'").withColumn("p", V.plain(F.col("text"))).groupBy("chapter", "zone").agg(F.transform(F.array_sort(F.collect_list(F.struct(*_ORDER, "p"))), lambda x: x["p"]).alias("lines"))
    printed = cells.select("chapter", "cell").distinct().join(listed, "chapter", "left").groupBy("chapter", "cell").agg(F.max(F.coalesce(V.in_lines(F.col("cell"), F.col("lines")), F.lit(False))).alias("there"))
    torn = cells.join(printed, ["chapter", "cell"]).where("NOT there").groupBy("chapter", "table", "q_id").agg(F.min("c").alias("c"))
    torn = _failures(torn.withColumn("id", F.col("table.table_id")), "table", "id", F.col("c"))

    sizes = fields.select("chapter", F.length("own").alias("n")).unionByName(cells.select("chapter", F.length("cell").alias("n"))).groupBy("chapter").agg(F.sum("n").alias("covered"))
    share = zones.join(sizes, "chapter", "left").withColumn("share", F.coalesce("covered", F.lit(0)) / F.greatest(F.lit(1), "total"))
    thin = _failures(share.where(F.col("share") < COVERED), "coverage", "chapter", F.round("share", 3))

    keyed = answers.join(printed_keys(zoned), ["chapter", "q_no"], "left")
    wrong = _failures(keyed.where(~F.nullif("correct_option", F.lit("")).eqNullSafe(F.col("letter"))), "answer", "q_id", F.concat_ws(" for ", F.coalesce("correct_option", F.lit("none")), F.coalesce("letter", F.lit("none"))))

    known = F.col("claimed") - F.col("table_renders") + F.col("orphans") + F.col("skipped") + F.col("merged")
    missing = _failures(images.where(F.col("placed") != known), "images", "chapter", F.concat_ws(" for ", known, "placed"))
    structured = tables.where("size(cells) > 0").select("chapter", "table.table_id").distinct()
    double = _failures(manifest.where("table_id IS NOT NULL").distinct().join(structured, ["chapter", "table_id"], "left_semi"), "separation", "table_id", F.lit("shipped as a picture"))
    return reduce(DataFrame.unionByName, [lost, torn, thin, wrong, missing, double])
