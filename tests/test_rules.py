"""Rules on single texts and tables, and small tables with hand-made answers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.functions import markdown as M
from pagemill.functions import text as T
from pagemill.operators import audit, boxes, fidelity, layout, pages, review, rows, tables

D, S = T.DEGREE, T.SQUARE


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    ("broken", "whole", "counts"),
    [
        (f"proteins (Ago 1{D} 4)", "proteins (Ago1-4)", {"ago_range_dash": 1}),
        (f"a 5'{D}5' cap", "a 5'-5' cap", {"cap_link_dash": 1}),
        (f"from 3’{D}5’ on", "from 3'→5' on", {"direction_arrow": 1}),
        (f"α (1{D} 6) β({D}4)", "α(1→6) β(1→4)", {"bond_paren_arrow": 2}),
        (f"α1 {D} 4", "α1→4", {"bond_alpha1_arrow": 1}),
        (f"in 1 {D} 6 bonds", "in 1→6 bonds".replace("in 1→6", "in 1→6"), {"bond_bare1_arrow": 1}),
        (f"{S} 9 desaturase", "Δ9 desaturase", {"delta_greek": 1}),
        (f"the {S}turn off{S} gene", 'the "turn off" gene', {"quote_pair": 1}),
        (f"to{S} Benedict's", "to Benedict's", {"stray_drop": 1}),
        (f"E+S{D} ES", "E+S → ES", {"reaction_arrow": 1}),
        ("25° stays", "25° stays", {}),
        (None, None, None),
    ],
)
def test_glyphs(spark, broken, whole, counts):
    got = one(spark, broken, T.glyph_repair)
    assert got.text == whole and (counts is None or got.counts == counts)


@pytest.mark.parametrize(
    ("broken", "whole", "counts"),
    [
        (f"that{S} {S}and{S} 5", f"that {S}andΔ5", {"delta_greek": 1, "stray_drop": 1}),  # no rule explains the second square
        (f"that{S} ", "that ", {"stray_drop": 1}),
        (f"a{S} \u0661", "a \u0661", {"stray_drop": 1}),
        (f"a\x1c{D}\x1cb", "a → b", {"reaction_arrow": 1}),
    ],
)
def test_strict_glyphs(spark, broken, whole, counts):
    got = one(spark, broken, lambda x: T.glyph_repair(x, strict=True))
    assert (got.text, got.counts) == (whole, counts)


def test_what_no_rule_explains_gets_its_glyph_back(spark):
    got = one(spark, f"that{S} {S}and{S} 5", T.glyph_repair)
    assert got.text == "that ■andΔ5" and got.counts["unknown_glyph"] == 1


@pytest.mark.parametrize(
    ("glued", "fixed"),
    [
        ("1strib", "1st rib"), ("the1st", "the 1st"), ("vertebraD4", "vertebra D4"), ("T3nerve", "T3 nerve"), ("nerve(T3)is", "nerve (T3) is"),
        ("following:Anterior", "following: Anterior"), ("membrane.It", "membrane. It"), ("( parasellar )", "(parasellar)"), ("(EAC) .", "(EAC)."), ("a   b", "a b"),
        *((x, x) for x in ("D4", "HbA1c", "C2H5OH", "vitamin B12", "1:1000", "10:30", "http://x", "J.K.Rowling", "v1.2Beta", "(C2,C3)")),
    ],
)
def test_spacing(spark, glued, fixed):
    assert one(spark, glued, T.spacing_fix) == fixed


def test_numbers_and_stems(spark):
    assert one(spark, "1,000 and 5. then 1000, 3.5", T.numbers) == ["1000", "3.5", "5"]
    assert one(spark, "  Héllo,  World ", T.normal_stem) == "h llo world"
    assert one(spark, None, lambda x: T.shingles(T.normal_stem(x))) == []
    assert one(spark, "a b c", lambda x: T.shingles(x)) == ["a b c"]
    assert one(spark, "a b c d e f g h i", lambda x: T.shingles(x)) == ["a b c d e f g h", "b c d e f g h i"]


def test_pipe_tables(spark):
    md = "| a | b |\n|---|---|\n| 1 | 2 |"
    assert one(spark, md, M.parse) == [["a", "b"], ["1", "2"]] and one(spark, md, M.shape) == 2
    assert one(spark, "no table", M.parse) is None and one(spark, None, M.shape) is None
    assert one(spark, "| a | |\n|---|---|\n| 1 | 2 |", M.shape) is None
    assert one(spark, f"Sure:\n```\n{md}\n```", M.salvage) == md and one(spark, f"{md}\n\nor\n\n{md}", M.salvage) is None


def verdict(spark, before, after, evidence=None):
    md = lambda x: f"| h | k |\n|---|---|\n| {x} | z |"
    df = spark.createDataFrame([(1, md(before), after if after.startswith("!") else md(after), evidence)], "k int, b string, a string, e array<string>")
    return fidelity.verdicts(df, "k", "b", "a", "e").first()


@pytest.mark.parametrize(
    ("before", "after", "evidence", "want", "reason"),
    [
        ("colla gen", "collagen", None, "ACCEPT", ""),
        ("a; b", "a<br>b", None, "ACCEPT", ""),
        ("receptor", "recep<br>tor", None, "REVIEW", "mid_word_break:R2C1"),
        ("dome shaped", "dome<br>shaped", None, "ACCEPT", ""),
        ("IgG", "igg", None, "REJECT", "content_substitution:R2C1"),
        ("bone", "bones", None, "REJECT", "hallucinated_addition:R2C1"),
        ("bones", "bone", None, "REJECT", "deletion:R2C1"),
        ("8 mg", "80 mg", None, "REJECT", "changed_number:R2C1"),
        ("8 mg", "80 mg", ["80"], "ACCEPT", ""),
        ("8 mg", "80 mg", ["80", "8"], "REJECT", "changed_number:R2C1"),
        ("one two", "two one", None, "REVIEW", "reorder:R2C1"),
        ("x", "!none", None, "REJECT", "invalid_markdown"),
    ],
)
def test_fidelity(spark, before, after, evidence, want, reason):
    got = verdict(spark, before, after, evidence)
    assert (got.verdict, got.reason) == (want, reason)


def test_evidence_absent_is_not_empty(spark):
    df = spark.createDataFrame([(1, "45 years", [3]), (2, "7", []), (3, None, [3])], "k int, t string, p array<int>")
    assert audit.numeric_drift(df, "k", "t", "p", None).count() == 0
    pages = spark.createDataFrame([(2, "aged 45")], "page int, text string")
    assert [tuple(r) for r in audit.numeric_drift(df, "k", "t", "p", pages).collect()] == [(2, "7")]


def test_review_states(spark):
    items = spark.createDataFrame([(1, "f"), (2, "f"), (3, "g")], "k int, fp string")
    made = spark.createDataFrame([(2, "approve", "f"), (3, "reject", "old")], "k int, action string, decided_fp string")
    assert {r.k: r.state for r in review.review_states(items, made, "k", "fp").collect()} == {1: "pending", 2: "decided:approve", 3: "stale:reject"}


def test_rate_window_looks_over_midnight(spark):
    calls = spark.createDataFrame([(1, "a", "2024-01-01 23:59:30"), (2, "a", "2024-01-02 00:00:10"), (3, "a", "2024-01-02 00:00:30"), (4, "b", "2024-01-02 00:00:30")], "i int, k string, ts string").withColumn("ts", F.to_timestamp_ntz("ts"))
    assert {r.i: r.recent for r in review.rate_window(calls, "k", "ts", "i").collect()} == {1: 1, 2: 2, 3: 2, 4: 1}


def test_boxes(spark):
    grid = [(1, 72.0, y, 372.0, y) for y in (400.0, 440.0, 480.0, 520.0)] + [(1, x, 400.0, x, 520.0) for x in (72.0, 172.0, 272.0, 372.0)] + [(2, 72.0, 100.0, 200.0, 100.0)]
    got = boxes.ruled_boxes(spark.createDataFrame(grid, "page int, x0 double, y0 double, x1 double, y1 double"), "page").collect()
    assert [tuple(r) for r in got] == [(1, 72.0, 400.0, 372.0, 520.0, 4, 4)]
    figures = [(1, k, float(x), 0.0, float(x + 10), 10.0) for k, x in enumerate((0, 12, 100, 24))]
    got = boxes.adjacent_groups(spark.createDataFrame(figures, "page int, k int, x0 double, y0 double, x1 double, y1 double"), "page", "k").collect()
    assert {r.k: r.grp for r in got} == {0: 0, 1: 0, 2: 1, 3: 0}


def test_word_rows_anchor_on_first(spark):
    words = spark.createDataFrame([(1, float(k), float(y), "w") for k, y in enumerate((0, 4, 8, 9))], "page int, x0 double, y0 double, text string")
    assert {r.x0: r.row for r in boxes.word_rows(words, "page").collect()} == {0.0: 0, 1.0: 0, 2.0: 1, 3.0: 1}


def test_options_and_median(spark):
    df = spark.createDataFrame([(["-", "b", "a", "c", "b", "d"], [3.0, 1.0, 2.0, 9.0])], "x array<string>, g array<double>")
    r = df.select(layout.assigned_options(F.col("x")).alias("o"), layout.upper_median(F.col("g")).alias("m")).first()
    assert (r.o, r.m) == ("..accd", 3.0)


def test_continuation_and_chains(spark):
    head, row = ["No", "Name"], ["1", "x"]
    data = [(1, 500.0, 700.0, [0.0, 50.0], [head, row]), (2, 40.0, 200.0, [0.0, 52.0], [head, ["2", "y"]]), (4, 40.0, 90.0, [0.0, 50.0], [head, row])]
    df = spark.createDataFrame([("B", p, a, b, 842.0, c, r) for p, a, b, c, r in data], "subject string, page int, y0 double, y1 double, height double, columns array<double>, rows array<array<string>>")
    got = tables.chains(tables.continuation(df)).orderBy("page").collect()
    assert [r.goes_on for r in got] == ["dedup", None, None] and [r.chain for r in got] == [1, 1, 2]


def test_status(spark):
    df = spark.createDataFrame([("s", {"A": "1", "B": "2", "C": "3", "D": "4"}, "a", "x", []), ("s", {"A": "1"}, None, "x", ["f"])], "q string, o map<string,string>, k string, s string, f array<string>")
    m = rows.missing_fields(F.col("q"), F.col("o"), F.col("k"), F.col("s"))
    got = df.select(m.alias("m"), rows.qa_status(m, F.col("f")).alias("st")).collect()
    assert [(r.m, r.st) for r in got] == [([], "READY"), (["options", "correct_option"], "INCOMPLETE")]


def test_empty_page_input(spark):
    empty = spark.createDataFrame([], "page int, x0 double, y0 double, x1 double, y1 double")
    assert boxes.ruled_boxes(empty, "page").count() == 0 and np.isfinite(1)


@pytest.mark.parametrize("fonts", [("SymbolMT", "AdobePiStd"), ("AdobePiStd", "SymbolMT")])
def test_fonts_of_spans_of_one_number(spark, fonts):
    words = spark.createDataFrame([(1, 1, 2.0, 8.0, 0.0)], "page long, n int, x0 double, x1 double, y0 double")
    spans = spark.createDataFrame([(1, 7, 0.0, 20.0, 0.0, 8.0, f) for f in fonts] + [(1, 8, 0.0, 20.0, 0.0, 8.0, "Times")], "page long, span long, x0 double, x1 double, y0 double, y1 double, font string").coalesce(1)
    assert [r.font for r in pages.word_fonts(words, spans, "page", ["n"], "span").collect()] == ["SymbolMT"]


def test_a_table_is_read_once(spark):
    """Reading a table, and comparing two, costs one split of each text into lines, whatever looks at them."""
    pairs = spark.range(1).select("id", F.lit("| a |\n|---|\n| 1 |").alias("b"), F.concat(F.lit("| a |\n|---|\n| "), F.col("id"), F.lit(" |")).alias("a"))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    lines = "x0b"
    assert plan(fidelity.cell_changes(pairs.withColumn("b", F.concat("b", "id")), "id", "b", "a")).count(lines) <= 2
    for read in (M.parse, M.shape, M.even_shape, M.render_findings, M.suspicions):
        assert plan(pairs.select(read("a").alias("x"))).count(lines) == 1


def test_partitions_of_windows_follow_the_rows(spark, monkeypatch):
    """A window's partition holds about as many rows whatever the input has."""
    monkeypatch.setattr(layout, "DEALT", 10)
    rows = spark.range(1000).selectExpr("id % 100 AS g", "id AS o", "cast(id / 100 AS int) AS n", "id AS p")
    assert layout.dealt(rows, 1000, "g").rdd.getNumPartitions() == 100
    assert layout.dealt(rows, 20, "g") is rows
    runs = layout.longest_run(rows, "g", ["o"], "n", "p")
    assert runs.rdd.getNumPartitions() == 100
    assert {(r.g, r.start, r.length) for r in runs.collect()} == {(g, 0, 10) for g in range(100)}


def test_boxes_of_many_pages_are_those_of_each_page():
    rng = np.random.default_rng(3)
    sizes = np.sort(rng.integers(1, 40, 200))[::-1]
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    at = rng.integers(0, 40, (int(sizes.sum()), 2)) * 5.0
    rules = np.concatenate([at, at + rng.integers(0, 4, at.shape) * 5.0, rng.integers(0, 2, (len(at), 1)) * [[1.0, -1.0]] + [[0.0, 1.0]]], axis=1)
    page, box = boxes._boxes_of_small_pages(rules, first, sizes, 3.0)
    for p, (a, n) in enumerate(zip(first, sizes, strict=True)):
        assert np.array_equal(box[page == p], boxes._boxes_of_a_page(rules[a : a + n], 3.0))
    assert len(boxes._boxes_of_small_pages(rules[:0], first[:0], sizes[:0], 3.0)[1]) == 0
