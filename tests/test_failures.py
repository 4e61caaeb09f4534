"""Streams that are killed and started again; a book's glyph counts and printed grids."""

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from pagemill.functions.text import DEGREE, SQUARE
from pagemill.operators import book as whole
from pagemill.sources import sinks
from pagemill.sources.verified import Store, edit_tables
from pagemill.streaming import ledgers

SCHEMA = "key string, seq long, value string"


@pytest.fixture
def shared(monkeypatch, tmp_path):
    monkeypatch.setattr(ledgers, "shared_folder", lambda spark: str(tmp_path / "shared"))
    return tmp_path


def arrive(spark, folder, rows, n):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return len(rows) + n


@pytest.fixture
def killed(monkeypatch):
    """The write of one batch is carried out, and the job dies before the stream hears of it."""
    left = {"n": 2}
    write = DataFrameWriter.parquet

    def dying(self, path, *args, **kwargs):
        write(self, path, *args, **kwargs)
        if "/table/" in path and "none" not in path:
            left["n"] -= 1
            if left["n"] == 0:
                raise OSError("killed")

    monkeypatch.setattr(DataFrameWriter, "parquet", dying)


def test_appended_batches_survive_a_kill(spark, shared, killed):
    folder = str(shared / "in")
    for k in range(4):
        arrive(spark, folder, [(f"k{k}", k, "x"), ("all", k, "y")], 0)
    stream = lambda: ledgers.read(spark, folder, "*.parquet", spark.read.parquet(folder).schema, files=1)
    with pytest.raises(Exception, match="killed"):
        ledgers.drained(stream(), "append", "rows")
    rows = ledgers.drained(stream(), "append", "rows").collect()
    assert len(rows) == 8 and len(set(rows)) == 8


def test_upserts_survive_a_kill(spark, shared, killed):
    folder = str(shared / "in")
    for k in range(4):
        arrive(spark, folder, [(f"k{k}", k, "x"), ("all", 10 - k, f"v{k}")], 0)
    stream = lambda: ledgers.read(spark, folder, "*.parquet", spark.read.parquet(folder).schema, files=1)
    with pytest.raises(Exception, match="killed"):
        ledgers.upserted(stream(), "key", "seq", "latest")
    want = {("all", 10, "v0"), *((f"k{k}", k, "x") for k in range(4))}
    assert {tuple(r) for r in ledgers.upserted(stream(), "key", "seq", "latest").collect()} == want
    arrive(spark, folder, [("k1", 7, "new"), ("all", 1, "old")], 0)
    again = {tuple(r) for r in ledgers.upserted(stream(), "key", "seq", "latest").collect()}
    assert again == want - {("k1", 1, "x")} | {("k1", 7, "new")}


def test_decisions_meet_the_items_of_their_time(spark, shared):
    folder = str(shared / "in")
    arrive(spark, folder, [("a", 1, "edit"), ("b", 2, "edit"), ("c", 3, "edit")], 0)
    items = lambda fps: spark.createDataFrame(fps, "key string, fp string")

    def run(fps):
        stream = ledgers.read(spark, folder, "*.parquet", spark.read.parquet(folder).schema).withColumn("action", F.col("value")).withColumn("fp", F.lit("f"))
        return {r.key: r.state for r in ledgers.upserted(ledgers.judged(stream, items(fps), "key", "fp"), "key", "seq", "states").collect()}

    assert run([("a", "f"), ("b", "g")]) == {"a": "decided:edit", "b": "stale:edit", "c": "gone"}
    arrive(spark, folder, [("b", 5, "confirm")], 0)
    assert run([("a", "x"), ("b", "f")]) == {"a": "decided:edit", "b": "decided:confirm", "c": "gone"}


GRID = [
    (2, 60.0, "Chapter"), (2, 100.0, "Question 1:"), (2, 116.0, f"A bond α1{DEGREE}4 holds."), (2, 132.0, f"a) {SQUARE}7"), (2, 148.0, "b) x"), (2, 164.0, "c) y"), (2, 180.0, "d) z"), (2, 200.0, "Answer Key"),
    (2, 300.0, "Solution to Question 1:"), (2, 316.0, f"It gives A {DEGREE} B."), (2, 350.0, "cell one"), (2, 350.0, "cell two"), (2, 366.0, "cell three"), (2, 420.0, "After the grid."),
]


def test_glyph_counts_and_grids_of_a_book(spark):
    lines = spark.createDataFrame([("B", p, i, 72.0 + 200 * (t == "cell two"), y, y + 11, t, 11.0, 842.0) for i, (p, y, t) in enumerate(GRID)], "subject string, page int, line_no int, x0 double, y0 double, y1 double, text string, size double, height double")
    toc = spark.createDataFrame([("B", 1, "Chapter", 1)], "subject string, chapter_no int, title string, printed_start int")
    words = spark.createDataFrame([("B", 2, 220.0, ["1", "a"])], "subject string, page int, y0 double, words array<string>")
    boxes = spark.createDataFrame([("B", 2, 1, 345.0, 380.0)], "subject string, page int, box int, by0 double, by1 double")
    of = lambda b: whole.records(whole.chapters(lines, toc, 1, 2), words, b).first()
    r = of(boxes)
    assert (r.question_text, r.options["A"], r.solution_text) == ("A bond α1→4 holds.", "Δ7", "It gives A → B.\nAfter the grid.")
    assert r.glyph_fixes == {"bond_alpha1_arrow": 1, "delta_greek": 1, "reaction_arrow": 1} and r["flags"] == []
    assert [(x.zone, x.page, x.box) for x in r.table_regions] == [("SOL", 2, 1)]
    assert "cell two" in of(None).solution_text


TABLES = "q_id string, tables array<struct<table_id: string, markdown: string>>"
GOOD = "| a | b |\n|---|---|\n| c | d |"


@pytest.fixture
def store(spark, tmp_path):
    s = Store(spark, str(tmp_path / "store"), ["questions", "solutions"])
    rows = [("B-1", [("T1", "old"), ("T2", "other")]), ("B-2", [])]
    first = spark.createDataFrame(rows, TABLES)
    assert s.write({"questions": first, "solutions": first.where("q_id = 'B-1'")}).ok
    return s


def tables_of(store):
    return {n: {r.q_id: [tuple(t) for t in r.tables] for r in df.collect()} for n, df in store.read().items()}


def edits_of(spark, *rows):
    return spark.createDataFrame(rows, "q_id string, table_id string, markdown string")


def test_edits_reach_every_copy_or_none(spark, store, tmp_path):
    ledger = str(tmp_path / "ledger")
    before = tables_of(store)
    for edits, why in (([("B-1", "T1", "| a |")], "uneven"), ([("B-1", "T9", GOOD)], "not found"), ([("B-1", "T1", GOOD), ("B-7", "T1", None)], "not found")):
        out = edit_tables(store, edits_of(spark, *edits), ledger=ledger)
        assert not out.ok and why in out.why and tables_of(store) == before
    out = edit_tables(store, edits_of(spark, (" b-1 ", "T1", GOOD), ("B-1", "T2", None)), ledger=ledger)
    assert (out.ok, out.changed) == (True, 4)
    assert tables_of(store) == {"questions": {"B-1": [("T1", GOOD)], "B-2": []}, "solutions": {"B-1": [("T1", GOOD)]}}
    assert sorted(r.kind for r in spark.read.json(ledger).collect()) == ["table_delete", "table_edit"]
    assert edit_tables(store, edits_of(spark, ("B-1", "T1", GOOD)).limit(0)).ok


def test_an_update_that_fails_half_way_leaves_what_stood(spark, store, monkeypatch):
    before = tables_of(store)
    write = DataFrameWriter.parquet

    def dying(self, path, *args, **kwargs):
        if path.endswith("solutions"):
            raise OSError("killed")
        write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", dying)
    with pytest.raises(OSError, match="killed"):
        edit_tables(store, edits_of(spark, ("B-1", "T1", GOOD)))
    monkeypatch.undo()
    assert tables_of(store) == before
    # the driver is gone before it can clean up: a version without its mark
    spark.createDataFrame([("B-1", [])], TABLES).write.parquet(f"{store.root}/v-000000007/questions")
    assert tables_of(store) == before
    assert edit_tables(store, edits_of(spark, ("B-1", "T1", GOOD))).ok and store.current() == "v-000000008"
    store.drop_old(keep=1)
    assert store._versions() == ["v-000000008"]


def test_what_is_read_back_is_compared(spark, store, monkeypatch):
    before = tables_of(store)
    write = DataFrameWriter.parquet

    def losing(self, path, *args, **kwargs):
        write(self._df.limit(1).write if path.endswith("questions") else self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", losing)
    out = edit_tables(store, edits_of(spark, ("B-1", "T1", GOOD)))
    monkeypatch.undo()
    assert (out.ok, out.why) == (False, "read-back mismatch: questions") and tables_of(store) == before


def test_chapters_count_with_their_marker(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "split")
    rows = lambda v: spark.createDataFrame([("B", "1", v), ("B", "2", v)], "subject string, chapter_id string, v string")
    read = lambda: sorted((r.chapter_id, r.v) for r in sinks.whole_chapters(spark.read.json(f"{root}/questions"), spark.read.schema("n long, subject string, chapter_id string").json(f"{root}/completeness")).collect())
    done = lambda: rows("x").select("subject", "chapter_id", F.lit(1).alias("n"))
    sinks.write_split({"questions": rows("one")}, done(), root)
    assert [v for _, v in read()] == ["one", "one"]
    write = DataFrameWriter.json

    def dying(self, path, *args, **kwargs):
        if path.endswith("completeness"):
            raise OSError("killed")
        write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "json", dying)
    with pytest.raises(OSError, match="killed"):
        sinks.write_split({"questions": rows("two").where("chapter_id = '2'")}, done().where("chapter_id = '2'"), root)
    monkeypatch.undo()
    assert read() == [("1", "one")] or [(str(a), b) for a, b in read()] == [("1", "one")]
    sinks.write_split({"questions": rows("two").where("chapter_id = '2'")}, done().where("chapter_id = '2'"), root)
    assert [(str(a), b) for a, b in read()] == [("1", "one"), ("2", "two")]
