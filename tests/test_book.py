"""A small book from page rows to question rows, and the rules that its parts follow; sources and sinks as round trips."""

import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from pagemill.operators import book as whole
from pagemill.operators import boxes, layout, pages, proposals, report, review, rows, tables
from pagemill.plans import review_queries
from pagemill.sources import sinks
from pagemill.sources import tables as sources

#: page, top, text: two chapters, the second one's questions run over a page.
BOOK = [
    (2, 60.0, "First Chapter", 20.0), (2, 100.0, "Question 1:", 11.0), (2, 116.0, "What holds bone?", 11.0), (2, 132.0, "a) collagen", 11.0), (2, 148.0, "b) water", 11.0), (2, 164.0, "c) salt", 11.0), (2, 180.0, "d) air", 11.0),
    (2, 300.0, "Question 2 :", 11.0), (2, 316.0, "Which gland?", 11.0), (2, 332.0, "a) one", 11.0), (2, 348.0, "b) two", 11.0), (2, 364.0, "c) three", 11.0), (2, 380.0, "d) four", 11.0), (2, 800.0, "1", 9.0),
    (3, 60.0, "Answer Key", 14.0), (3, 300.0, "Solution to Question 1:", 11.0), (3, 316.0, "Collagen does.", 11.0), (3, 332.0, "Solution to Question 2:", 11.0), (3, 348.0, "The second.", 11.0), (3, 800.0, "2", 9.0),
    (4, 60.0, "Second", 18.0), (4, 80.0, "Chapter", 18.0), (4, 700.0, "Question 1:", 11.0), (5, 100.0, "A stem alone.", 11.0), (5, 200.0, "Answer Key", 11.0), (5, 400.0, "Solution to Question 1:", 11.0),
]


@pytest.fixture(scope="module")
def book(spark):
    lines = spark.createDataFrame([("B", p, i, 72.0, y, y + 11, t, s, 842.0) for i, (p, y, t, s) in enumerate(BOOK)], "subject string, page int, line_no int, x0 double, y0 double, y1 double, text string, size double, height double")
    toc = spark.createDataFrame([("B", 1, "First ...", 1), ("B", 2, "Second ...", 3)], "subject string, chapter_no int, title string, printed_start int")
    return lines, toc


def test_book_chapters(spark, book):
    lines = whole.chapters(*book, 1, 5)
    assert lines.count() == len(BOOK) - 2  # two footers
    scan = {r.chapter_no: r for r in pages.chapter_scans(lines, "chapter_no", ["page", "y0"], "text").collect()}
    assert [(scan[c].question_numbers, scan[c].solution_numbers, scan[c].anomalies) for c in (1, 2)] == [([1, 2], [1, 2], []), ([1], [1], [])]
    titles = pages.chapter_titles(lines, "chapter_no", ["page", "y0"], "text", "size", book[1], "title")
    assert {r.chapter_no: r.title for r in titles.collect()} == {1: "First Chapter", 2: "Second Chapter"}


def test_book_from_lines_to_rows(spark, book):
    printed = [(3, 40.0, ["9", "d"]), (3, 120.0, ["1", "a"]), (3, 136.0, ["2", "B"]), (3, 152.0, ["Question No.", "Correct Option"]), (5, 220.0, ["1  c"]), (5, 240.0, ["stray"])]
    words = spark.createDataFrame([("B", *x) for x in printed], "subject string, page int, y0 double, words array<string>")
    out = whole.rows_of(book[0], words, book[1], 1, 5)
    assert {(r.q_id, r.question_text, r.qa_status, r.q_id_grade) for r in out["question"].collect()} == {
        ("B-001-001", "What holds bone?", "READY", "RESOLVED_ANCHORED"), ("B-001-002", "Which gland?", "READY", "RESOLVED_ANCHORED"), ("B-002-001", "A stem alone.", "INCOMPLETE", "RESOLVED_ANCHORED")}
    assert {(r.q_id, tuple(o.text for o in r.options), tuple(r.source_pages)) for r in out["question"].collect()} == {
        ("B-001-001", ("collagen", "water", "salt", "air"), (2, 3)), ("B-001-002", ("one", "two", "three", "four"), (2, 3)), ("B-002-001", ("", "", "", ""), (4, 5))}
    assert {(r.q_id, r.correct_option) for r in out["answer"].collect()} == {("B-001-001", "A"), ("B-001-002", "B"), ("B-002-001", "C")}
    assert {(r.q_id, r.solution_text, tuple(r.missing_fields)) for r in out["solution"].collect()} == {("B-001-001", "Collagen does.", ()), ("B-001-002", "The second.", ()), ("B-002-001", "", ("solution_text",))}
    assert out["unresolved"].count() == 0
    assert [(r.chapter_no, r.question_records, r.incomplete_solutions) for r in out["completeness"].orderBy("chapter_no").collect()] == [(1, 2, 0), (2, 1, 1)]


def test_grades_reasons_and_unresolved(spark):
    schema = "subject string, chapter_no int, q_no int, question_text string, options map<string,string>, correct_option string, solution_text string, q_header_page int, key_page int, s_header_page int, source_pages array<int>, flags array<string>, glyph_fixes map<string,bigint>"
    four = dict(zip("ABCD", "wxyz", strict=True))
    data = [
        ("B", 1, 1, "s", four, "A", "b", 1, 2, 3, [1, 2, 3], ["unknown_glyph", "other"], {"x": 1, "y": 0}),
        ("B", 1, 2, " ", four, "", "b", 1, None, 3, [1, 3], ["no_key_row"], {}),
        ("B", 1, 3, "", {}, "A", "b", None, 2, 3, [2, 3], ["no_question_header"], {}),
        ("B", 1, 4, "", {}, "", "b", None, None, 3, [3], ["no_question_header", "no_key_row"], {}),
        ("B", 1, 5, "", {}, "A", "", None, 2, None, [2], ["no_question_header", "no_solution_header"], {}),
        ("B", 1, 6, "", {}, "", "", None, None, None, [], ["no_question_header"], {}),
    ]
    got = rows.graded(spark.createDataFrame(data, schema))
    by = {r.q_no: r for r in got.collect()}
    assert (by[1].q_id_grade, by[1].qa_status, by[1].qa_reasons) == ("RESOLVED_ANCHORED", "REVIEW_NEEDED", ["other", "unknown_glyph"])
    assert (by[2].q_id_grade, by[2].qa_status, by[2].qa_reasons) == ("RESOLVED", "INCOMPLETE", ["no_key_row", "missing:question_text", "missing:correct_option"])
    lost = {r.q_no: r.reason for r in rows.fan_out(got)["unresolved"].collect()}
    assert lost == {3: "missing_question_for_solution", 4: "solution_q_no_not_in_printed_header", 5: "answer_q_no_not_in_printed_key", 6: "no_anchor_at_all"}
    assert got.where("q_no = 1").select(rows.anchors().alias("a")).first().a.glyph_fixes == {"x": 1}


@pytest.mark.parametrize(("starts", "fault"), [([1, 1], "not increasing|empty page range"), ([5, 90], "outside"), ([-3, 4], "outside")])
def test_faulty_chapters_are_errors(spark, starts, fault):
    toc = spark.createDataFrame([("B", i + 1, s) for i, s in enumerate(starts)], "subject string, chapter_no int, printed_start int")
    with pytest.raises(Exception, match=fault):
        rows.chapter_ranges(toc, 1, 50).collect()


def test_rows_of_one_id_come_as_they_stand_in_the_table(spark, tmp_path):
    rows = [(k, 7 if k % 3 == 0 else 8, 3) for k in range(900, 0, -1)]
    spark.createDataFrame(rows, "l_orderkey long, l_suppkey long, l_linenumber int").coalesce(1).write.option("parquet.block.size", "1024").parquet(f"{tmp_path}/lineitem.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        got = review_queries.lookup_questions(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [tuple(r) for r in got] == [("BOOK-007-003", k) for k in range(900, 840, -3)]


def test_lookup_forms(spark):
    df = spark.createDataFrame([(f"ENT-{c:03d}-{q:03d}",) for c in (2, 21) for q in range(1, 31)], "q_id string")
    found = lambda term: [r.q_id for r in review.lookup(df, "q_id", term).collect()]
    assert found("  ") == [] and len(found("ent")) == 20
    assert found("21-18") == ["ENT-021-018"] and found("18") == ["ENT-002-018", "ENT-021-018"] and found("ent-002-03") == ["ENT-002-030"]


def test_chunks_lose_their_header_in_one_mode_only(spark):
    data = [(k, i, mode if i else None, [head, [str(i)]]) for k, mode, second in ((1, "dedup", ["No"]), (2, "keep", ["No"]), (3, "dedup", ["no."])) for i, head in enumerate((["No"], second))]
    got = {r.k: (r.rows, r.header_deduplicated) for r in tables.merged_chunks(spark.createDataFrame(data, "k int, i int, mode string, rows array<array<string>>"), "k", "i", "rows").collect()}
    assert got == {1: ([["No"], ["0"], ["1"]], True), 2: ([["No"], ["0"], ["No"], ["1"]], False), 3: ([["No"], ["0"], ["no."], ["1"]], False)}


def test_reflow_strips_before_it_looks_for_list_items(spark):
    df = spark.createDataFrame([(1, 0, 1, 0.0, 8.0, "one"), (1, 1, 1, 10.0, 18.0, "\t(1) two "), (1, 2, 1, 20.0, 28.0, " three")], "g int, o int, page int, y0 double, y1 double, text string")
    assert layout.reflow(df, "g", "o", "page", "y0", "y1", "text").first().text == "one\n(1) two three"


def test_grids(spark):
    edges = [(1, 72.0, y, 372.0, y) for y in (400.0, 440.0, 480.0, 520.0)] + [(1, x, 400.0, x, 520.0) for x in (72.0, 172.0, 272.0, 372.0)] + [(1, 100.0, 600.0, 400.0, 600.0)]
    ruled = boxes.rules(spark.createDataFrame(edges, "page int, x0 double, y0 double, x1 double, y1 double"))
    box = spark.createDataFrame([(1, 1, 72.0, 400.0, 372.0, 520.0), (1, 2, 72.0, 400.0, 420.0, 560.0), (2, 3, 1.0, 1.0, 50.04, 9.0)], "page int, box int, bx0 double, by0 double, bx1 double, by1 double")
    got = {r.box: (r.columns, r.rows) for r in boxes.grids(ruled, box, "page", "box").collect()}
    assert got == {1: ([72.0, 172.0, 272.0, 372.0], [400.0, 440.0, 480.0, 520.0]), 2: ([72.0, 420.0], []), 3: ([1.0, 50.0], [])}


def test_mid_word_breaks(spark):
    data = [("receptor", "recep<br>tor", 1), ("dome shaped", "dome<br>shaped", 0), ("dome<br>shaped", "do<br>me<br/>shaped", 1), ("ab", "a<br>bc", 0), ("ab", "<br>ab<br>", 0)]
    df = spark.createDataFrame(data, "b string, a string, n int")
    assert all(r.n == r.got for r in df.select("n", proposals.mid_word_breaks(F.col("b"), F.col("a")).alias("got")).collect())


def test_subsets_paths_and_archives(spark, tmp_path):
    assert report.chapter_subset("1, 3-5,,") == {1, 3, 4, 5}
    (tmp_path / "a.txt").write_text("x")
    assert report.write_zip([("data/a.txt", "a.txt")], str(tmp_path), str(tmp_path / "out.zip")) == 1
    assert zipfile.ZipFile(tmp_path / "out.zip").namelist() == ["data/a.txt"]
    with pytest.raises(ValueError, match="not under"):
        report.write_zip([("b", "../b")], str(tmp_path), str(tmp_path / "bad.zip"))
    assert not (tmp_path / "bad.zip").exists()


LEDGER = StructType([StructField("key", StringType()), StructField("seq", LongType())])


def test_ledgers_splits_and_purges(spark, tmp_path):
    root = str(tmp_path)
    assert sources.json_lines(spark, f"{root}/none.jsonl", LEDGER).count() == 0 and sources.page_text(spark, f"{root}/none") is None
    one = spark.createDataFrame([("ENT|q1|t1", 1), ("ent|q2|t1", 2)], LEDGER)
    sinks.append_ledger(one, f"{root}/ledger")
    sinks.append_ledger(spark.createDataFrame([("RAD|q1|t1", 3)], LEDGER), f"{root}/ledger")
    (tmp_path / "ledger" / "bad.json").write_text('{"key": "BIO|q|t", "seq": 4}\nnot json\n')
    read = sources.ledger(spark, f"{root}/ledger", LEDGER)
    assert sorted(r.seq for r in read.collect()) == [1, 2, 3, 4]
    assert sorted(r.seq for r in sinks.purged(read, "Ent").collect()) == [3, 4]
    rows_ = spark.createDataFrame([("ENT", "c1", "q1"), ("RAD", "c1", "q2")], "subject string, chapter_id string, q_id string")
    sinks.write_split({"questions": rows_}, rows_.select("subject", "chapter_id").withColumn("ok", F.lit(True)), root)
    back = sources.json_lines(spark, f"{root}/questions", StructType([StructField("q_id", StringType()), StructField("subject", StringType()), StructField("chapter_id", StringType())]))
    assert {(r.subject, r.q_id) for r in back.collect()} == {("ENT", "q1"), ("RAD", "q2")}
    sinks.purge_subject(spark, root, "ENT", ("questions", "completeness"))
    assert {r.subject for r in spark.read.json(f"{root}/questions").collect()} == {"RAD"}
    old, new = (spark.createDataFrame(x, "key string, seq long") for x in ([("a", 1), ("b", 1)], [("b", 2), ("b", 3), ("c", 2)]))
    assert {(r.key, r.seq) for r in sinks.upsert(old, new, "key", "seq").collect()} == {("a", 1), ("b", 3), ("c", 2)}


def test_first_rows_win(spark):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 3, "z")], "k string, o int, v string")
    assert {(r.k, r.v) for r in rows.first_seen(df, "k", ["o"]).collect()} == {("a", "x"), ("b", "z")} == {(r.k, r.v) for r in sources.first_root(df, "k", "o").collect()}
