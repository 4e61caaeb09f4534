"""The verifier as one call: a clean book has no failure, each planted fault is found, a second box finder agrees with the first."""

import pytest
from pyspark.sql import functions as F

from pagemill.operators import audit_book, boxes

PAGE = [
    ("Question 1:", 100), ("What holds bone ?", 116), ("a) collagen", 132), ("b) water", 148), ("7", 780), ("Question 2:", 200), ("Which?", 216), ("a) this", 232), ("b) that", 248), ("Answer Key", 300),
    ("1", 320), ("a", 336), ("2 B", 352), ("Solution to Question 1:", 400), ("Collagen", 416), ("does.", 432), ("Solution to Question 2:", 448), ("That", 464), ("cell one", 480), ("goes on", 496), ("cell two", 512),
]
OPTIONS = "array<struct<id: string, text: string>>"
TABLE = "array<struct<table_id: string, rows: array<array<string>>>>"


def rows(spark):
    lines = spark.createDataFrame([("c1", 7, 7, 800.0, 72.0, float(y), y + 9.0, f" {t} ") for t, y in PAGE], "chapter string, page int, printed int, height double, x0 double, y0 double, y1 double, text string")
    grid = [("T1", [["cell one goes on", "cell two"]])]
    questions = spark.createDataFrame([("c1", "q1", "What holds bone?", [("A", "collagen"), ("B", "water")], []), ("c1", "q2", "Which?", [("A", "this"), ("B", "that")], [])], f"chapter string, q_id string, question_text string, options {OPTIONS}, tables {TABLE}")
    solutions = spark.createDataFrame([("c1", "q1", "Collagen does.", []), ("c1", "q2", "That", grid)], f"chapter string, q_id string, solution_text string, tables {TABLE}")
    answers = spark.createDataFrame([("c1", "q1", 1, "A"), ("c1", "q2", 2, "B")], "chapter string, q_id string, q_no int, correct_option string")
    images = spark.createDataFrame([("c1", 7, 5, 1, 1, 1, 1)], "chapter string, placed int, claimed int, table_renders int, orphans int, skipped int, merged int")
    manifest = spark.createDataFrame([("c1", None), ("c1", "T9")], "chapter string, table_id string")
    return {"lines": lines, "questions": questions, "solutions": solutions, "answers": answers, "images": images, "manifest": manifest}


def found(spark, **changed):
    return sorted((r.kind, r["at"], r.detail) for r in audit_book.failures(**(rows(spark) | changed)).collect())


def test_a_clean_book(spark):
    assert found(spark) == []


def planted(spark):
    r = rows(spark)
    when = lambda c, k, v: F.when(F.col("q_id") == k, F.lit(v)).otherwise(F.col(c))
    bad = F.transform("tables", lambda t: t.withField("rows", F.array(F.array(F.lit("cell one"), F.lit("cell two one")))))
    yield {"questions": r["questions"].withColumn("question_text", when("question_text", "q1", "What holds bones?"))}, [("text", "q1", "question_text")]
    yield {"questions": r["questions"].withColumn("options", F.transform("options", lambda o: o.withField("text", F.replace(o["text"], F.lit("water"), F.lit("wine")))))}, [("text", "q1", "option B")]
    yield {"solutions": r["solutions"].withColumn("solution_text", when("solution_text", "q1", "Collagen doesn't."))}, [("text", "q1", "solution_text")]
    yield {"solutions": r["solutions"].withColumn("tables", bad)}, [("table", "T1", "cell two one")]
    yield {"solutions": r["solutions"].withColumn("solution_text", when("solution_text", "q1", ""))}, [("coverage", "c1", "0.866")]
    yield {"answers": r["answers"].withColumn("correct_option", when("correct_option", "q2", "C"))}, [("answer", "q2", "C for B")]
    yield {"answers": r["answers"].withColumn("q_no", when("q_no", "q2", 5))}, [("answer", "q2", "B for none")]
    yield {"images": r["images"].withColumn("placed", F.lit(8))}, [("images", "c1", "7 for 8")]
    yield {"manifest": r["manifest"].withColumn("table_id", F.lit("T1"))}, [("separation", "T1", "shipped as a picture")]


@pytest.mark.parametrize("k", range(9))
def test_each_fault_is_found(spark, k):
    changed, want = list(planted(spark))[k]
    got = [f for f in found(spark, **changed) if f[0] == want[0][0]]
    assert [f[:2] for f in got] == [w[:2] for w in want] and (want[0][0] == "coverage" or got == want)


def test_boxes_as_components(spark):
    grid = lambda x, y: [(x, y + 20.0 * k, x + 100, y + 20.0 * k + 1) for k in range(3)] + [(x + 50.0 * k, y, x + 50 * k + 1, y + 41) for k in range(3)]
    one = [(1, *s) for s in grid(50.0, 100.0) + grid(50.0, 300.0)] + [(1, 400.0, 10.0, 500.0, 11.0), (2, 10.0, 10.0, 12.0, 90.0)]
    df = spark.createDataFrame(one, "page int, x0 double, y0 double, x1 double, y1 double")
    sides = lambda d: sorted(tuple(r[c] for c in ("page", "x0", "y0", "x1", "y1")) for r in d.collect())
    assert sides(audit_book.component_boxes(df)) == sides(boxes.ruled_boxes(df, "page")) and len(sides(audit_book.component_boxes(df))) == 2
    assert audit_book.component_boxes(df.limit(0)).collect() == []
