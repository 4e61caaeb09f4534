"""Fill-in-middle, mixing and repaired conversations against plain Python, with nulls, ties, repeats, hot groups and empty tables."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import pytest
from pyspark.sql import functions as F

from pagemill.llm import conversations, infill, mixing, queries

DIR = "/root/testdata/sf0.001"
RNG = random.Random(17)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    cur = con.execute(queries.ORACLES[name])
    cols = [d[0] for d in cur.description]
    df = queries.QUERIES[name](spark, DIR)
    assert sorted(df.columns) == sorted(cols)
    plain = lambda v: round(v, 6) if isinstance(v, float) else v
    got = Counter(tuple(plain(r[c]) for c in cols) for r in df.collect())
    assert got == Counter(tuple(map(plain, r)) for r in cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_without_sql_gives_a_row_for_each_document(spark, name):
    rows = queries.QUERIES[name](spark, DIR).select("doc_id").distinct().count()
    assert rows == spark.read.parquet(f"{DIR}/documents.parquet").count()


# ---- fill-in-middle ---------------------------------------------------------

TEXTS = [None, "", " ", "a", " a", "a ", "a b c", "one two\tthree\r\nfour  ", "x <P> y", "a<b >c <S", "<M>", "<", "é" * 9, "日本 語\n" * 40, "w " * 5000, "\x0b\x0c tail", "<<S P>"] + [" ".join(RNG.choice(["<", "a>", "P", "S>", "<M", "ü"]) for _ in range(k)) for k in range(60)]


def infilled(doc_id, text, seed=42):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return (len(units), "plain", None, None, text)
    low, high = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    if h[3] % 100 < 80:
        return (len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_infill_matches_lists_of_units_and_restores_texts(spark):
    rows = [(i, t, "clash", "clash", "clash") for i, t in enumerate(TEXTS * 6)] + [(None, t, "x", "x", "x") for t in TEXTS] + [(3, "a b c", "x", "x", "x")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string, form string, output string").repartition(3)
    out = infill.infill(docs).withColumn("back", infill.restored(F.col("output"), F.col("form")))
    got = Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in out.collect())
    assert got == Counter((i, *infilled(i, t)) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.back) for r in out.collect()) == Counter((i, t or "") for i, t, *_ in rows)
    assert {r.form for r in out.collect()} == {"plain", "psm", "spm"}
    assert infill.infill(docs.limit(0)).collect() == []


def test_infill_passes_keep_no_units(monkeypatch):
    import tracemalloc

    text = "word and " * 400_000
    tracemalloc.start()
    n = infill.count_units(text)
    ends = infill.unit_ends(text, n // 3, n - 2)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    # the last space is a unit of its own
    assert n == 800_001 and ends[1] == len(text) - 5 and peak < 100_000


def test_infill_takes_other_marks_and_shares(spark):
    rule = infill.Infill("[pre]", "[suf]", "[mid]", plain_percent=0, spm_percent=0, seed=7)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    out = infill.infill(docs, rule).withColumn("back", infill.restored(F.col("output"), F.col("form"), rule)).collect()
    assert {r.form for r in out} == {"plain", "psm"} and {r.doc_id for r in out if r.form == "plain"} == {k for k, t in enumerate(TEXTS) if not t}
    assert all(r.back == (TEXTS[r.doc_id] or "") for r in out)


# ---- mixing -----------------------------------------------------------------


def targets(sizes, budget, weights=(1, 2, 3), repeats=3):
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    limited = set()
    while True:
        free = [s for s in order if s not in limited]
        if not free:
            return {s: Fraction(repeats * sizes[s]) for s in order}
        level = Fraction(budget - sum(repeats * sizes[s] for s in limited), sum(w[s] for s in free))
        more = {s for s in free if w[s] * level > repeats * sizes[s]}
        if not more:
            return {s: Fraction(repeats * sizes[s]) if s in limited else w[s] * level for s in order}
        limited |= more


def corpus():
    rows = [(i, " ".join(["w"] * RNG.randrange(0, 40)), f"s{i % 7}") for i in range(400)]
    rows += [(1000 + i, " ".join(["hot"] * RNG.randrange(1, 9)), "hot") for i in range(900)]
    rows += [(None, "no id", None), (None, None, None), (7, None, "s1"), (7, "", "s1"), (8, "twice here", "s2"), (8, "twice here", "s2"), (9, "x " * 3000, "é"), (10, "y", "z"), (11, "y z", "")]
    return rows


def test_mixture_meets_its_targets(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "a", "b") for r in rows], "doc_id long, text string, source string, size string, taken string").repartition(5)
    mixed = mixing.mix(spark, docs)
    got = mixed.taken().collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r.doc_id, r.size, r.source) for r in got) == Counter((i, size(t), s) for i, t, s in rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, t, s in rows:
        sizes[s] += size(t)
    want = targets(sizes, sum(sizes.values()))
    for r in got:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size and r.source_size == sizes[r.source] and r.target == pytest.approx(float(want[r.source]))
    # served words are the target rounded down, for every source
    assert all(want[s] - 1 <= taken[s] <= want[s] for s in sizes)
    assert want[""] == 6 and want["z"] == 3  # as often as they may be read, the rest goes to the others
    order = sorted(mixed.order.collect(), key=lambda r: r.offset)
    assert [r.finish for r in order] == sorted(r.finish for r in order)
    assert all(a.offset + a.words == b.offset for a, b in itertools.pairwise(order)) and order[0].offset == 0
    again = mixing.mix(spark, docs.repartition(2, "source")).taken().collect()
    assert Counter(tuple(r) for r in again) == Counter(tuple(r) for r in got)


def test_mixture_serves_sources_by_weight_all_along(spark):
    rows = [(i, "w " * RNG.randrange(1, 5), f"s{i % 3}") for i in range(3000)]
    mixed = mixing.mix(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"), share=0.5)
    served = Counter()
    for k, r in enumerate(sorted(mixed.order.collect(), key=lambda r: r.offset)):
        served[r.source] += r.words
        if k > 30:
            assert abs(served["s1"] - 2 * served["s0"]) <= 12 and abs(served["s2"] - 3 * served["s0"]) <= 18


def test_mixture_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(spark, none).taken().collect() == []
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in mixing.mix(spark, blank).taken().collect()) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


def test_a_source_is_split_whatever_its_size(spark):
    rows = [(i, "a b c", "only") for i in range(5000)]
    docs = mixing.mix(spark, spark.createDataFrame(rows, "doc_id long, text string, source string")).documents
    assert docs.groupBy("queue", "slot").count().agg(F.max("count")).first()[0] < 20


# ---- conversations ----------------------------------------------------------


def faults(rows):
    out, seen = [], set()
    for role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]+", "", text)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "fine")
        seen.add((role, text))
    return out


def cheapest(rows):
    """All edits of few turns, one after the other: an insertion is tried before every turn and at the end."""
    kinds, best = faults(rows), None

    def legal(roles):
        return re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r in roles))

    def go(k, cost, audit, left, inserted):
        nonlocal best
        if best and cost > best[0]:
            return
        if k == len(rows):
            if legal([r for r, _ in left]) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, list(left))
        if inserted < 2:
            for r in ("user", "assistant"):
                go(k, cost + 2, audit + "I", [*left, (r, "")], inserted + 1)
        if k == len(rows):
            return
        role, text = rows[k]
        go(k + 1, cost + 3, audit + "D", left, 0)
        if kinds[k] in ("fine", "truncated"):
            more = kinds[k] == "truncated"
            go(k + 1, cost + more, audit + "K", [*left, (role, text)], 0)
            for r in ("user", "assistant"):
                go(k + 1, cost + 2 + more, audit + "R", [*left, (r, text)], 0)

    go(0, 0, "", [], 0)
    return best


def expected(rows):
    """Of rows (turn, role, text) of one conversation."""
    rows = sorted(((t, r or " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
    kinds = Counter(faults([r[1:] for r in rows]))
    turns = [t for t, *_ in rows if t is not None]
    cost, audit, left = cheapest([r[1:] for r in rows])
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, kinds["blank"], kinds["duplicate"], kinds["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest())


def small_conversations(n):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "unknown"]
    texts = ["Yes.", "No!", "so", " ", "", None, "Why?  ", "é…", "a\nb."]
    out = []
    for c in range(n):
        for _ in range(RNG.randrange(0, 6)):
            out.append((c if c else None, RNG.choice([None, 0, 1, 2, 3, 4, 9]), RNG.choice(roles[: 3 + c % 7]), RNG.choice(texts)))
    return out


@pytest.mark.parametrize("per_batch", [10_000, 3])
def test_repair_matches_all_edits(spark, per_batch):
    rows = small_conversations(70)
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, cost string, audit string").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(per_batch))
    try:
        done = conversations.repair(spark, df, keep_texts=True)
        got = {r.conv_id: tuple(r)[1:] for r in done.conversations.collect()}
        lines = defaultdict(dict)
        for r in done.turns.collect():
            lines[r.conv_id][r.position] = f"{r.role}:{r.text}"
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    by = defaultdict(list)
    for c, *r in rows:
        by[c].append(r)
    assert got == {c: expected(r) for c, r in by.items()}
    for c, r in got.items():
        assert hashlib.sha256("\n".join(lines[c][k] for k in range(len(lines[c]))).encode()).hexdigest() == r[-1]


def scanned(rows):
    """From left to right, one least (cost, audit) for each state."""
    step = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
    at = {0: (0, "")}

    def better(new, state, value):
        if state not in new or value < new[state]:
            new[state] = value

    def inserted(at):
        for _ in range(3):
            new = dict(at)
            for s, (c, a) in at.items():
                for r in "ua":
                    if (r, s) in step:
                        better(new, step[r, s], (c + 2, a + "I"))
            at = new
        return at

    for (role, _), kind in zip(rows, faults(rows), strict=True):
        new = {}
        for s, (c, a) in inserted(at).items():
            better(new, s, (c + 3, a + "D"))
            if kind in ("fine", "truncated"):
                c += kind == "truncated"
                if (role[:1], s) in step:
                    better(new, step[role[:1], s], (c, a + "K"))
                for r in "ua":
                    if (r, s) in step:
                        better(new, step[r, s], (c + 2, a + "R"))
        at = new
    at = inserted(at)
    return min(at[s] for s in (0, 3) if s in at)


def test_a_conversation_over_many_batches_and_partitions(spark):
    """One conversation has most rows, some of them hundreds of times."""
    rows = [(5, k, RNG.choice(["user", "assistant", "assistant", "user", "system", "bot"]), RNG.choice([f"t{k}.", f"t{k}", "same.", ""])) for k in range(3000)]
    rows += [(5, 1500, "user", "again and again.")] * 400 + [(c, k, "user" if k % 2 == 0 else "assistant", f"{c} {k}.") for c in range(6, 40) for k in range(4)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        got = {r.conv_id: r for r in conversations.repair(spark, df).conversations.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    own = [(r, x) for _, _, r, x in sorted((r for r in rows if r[0] == 5), key=lambda r: r[1:])]
    assert (got[5].cost, got[5].audit) == scanned(own)
    assert got[5].duplicate == Counter(faults(own))["duplicate"] and got[5].gaps == 0
    assert all(got[c].cost == 0 and got[c].audit == "KKKK" for c in range(6, 40))


def test_matrix_products_may_be_grouped_in_any_way():
    for _ in range(60):
        a, b, c = (bytes(RNG.randrange(16) for _ in range(RNG.randrange(1, 9))) for _ in range(3))
        a, b, c = map(conversations.product, (a, b, c))
        assert conversations.times(conversations.times(a, b), c) == conversations.times(a, conversations.times(b, c))


def test_conversations_without_rows_are_reported(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi.", 0), (1, 1, "assistant", "Hi!", 0), (2, 0, "user", "Hi.", 2), (None, None, None, None, 0)], "conv_id long, turn long, role string, text string, copies int")
    got = {r.conv_id: tuple(r)[1:] for r in conversations.repair(spark, df, copies="copies").conversations.collect()}
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got[1] == empty and got[None] == empty
    # one stays and gets an answer, the other goes
    assert got[2][:7] == (0, 0, 1, 0, 1, 5, "KDI")
    assert conversations.repair(spark, df.limit(0), copies="copies").conversations.collect() == []


def test_damage_follows_the_crc_of_conversation_and_turn(spark):
    rows = [(c, t, "assistant", "One. Two? Three!") for c in range(40) for t in (None, 0, 1, 2)] + [(None, 3, "user", "x.")]
    got = {(r.conv_id, r.turn if r.copies else "gone"): r for r in queries._damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    for c, t, role, text in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if k == 0:
            assert (c, "gone") in got
            continue
        r = got[c, t]
        assert r.copies == (2 if k == 3 else 1) and r.role == ("user" if k == 4 else role)
        assert r.text == ("" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text)
