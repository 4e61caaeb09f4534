"""Small tables with nulls, empty and long texts, ties, repeats and clashing columns, against plain Python."""

import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagemill.llm import decontaminate, language, licenses, minhash, packing, queries, sharding, suffix, token_counts

RNG = np.random.default_rng(11)
SCHEMA = "doc_id long, text string, n_words string, component_id string"
WORDS = [w + s for w in ("alpha", "beta", "gamma", "delta", "Éta", "x1") for s in ("", "s", "ing", ".")]


def fold(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def alnum(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(t))


def sentence(n):
    return " ".join(RNG.choice(WORDS, n))


BASE = [sentence(40) for _ in range(5)]
TEXTS = [*BASE, *BASE[:3], *(b + " tail" for b in BASE), *(b.replace("alpha", "omega") for b in BASE), None, "", "   ", "one", "One", "one two", BASE[0] + "\n" + BASE[1] + BASE[0], sentence(3000), BASE[2].upper(), "日本語 テキスト " * 30]
ROWS = [(i, t, "clash", "clash") for i, t in enumerate(TEXTS)] + [(None, BASE[0], "clash", None), (3, TEXTS[3], "clash", "clash")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_minhash_matches_brute_force(spark, docs, none):
    def sets(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", fold(t))
        return {tuple(w[i : i + 2]) for i in range(len(w) - 1)} if len(w) >= 2 else ({tuple(w)} if w else set())

    own = {i: sets(t) for i, t, *_ in ROWS if i is not None}
    root = {i: i for i in own}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in own:
        for b in own:
            both = len(own[a] & own[b])
            if a < b and own[a] and own[b] and 100 * both >= 80 * len(own[a] | own[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = minhash.near_duplicates(spark, docs, words=2).collect()
    assert len(got) == len(ROWS)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(own[r.doc_id]), find(r.doc_id), find(r.doc_id) == r.doc_id), r
    assert minhash.near_duplicates(spark, none).count() == 0


def test_minhash_chain_across_leaders(spark):
    """A chain of texts, each alike to the next only, is one component, whatever the leaders."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[12 * i : 12 * i + 200])) for i in range(16)]
    got = minhash.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), words=1).collect()
    assert {r.component_id for r in got} == {0}


def brute_suffix(rows, width):
    seen, out = set(), {}
    for k, (i, t, *_) in enumerate(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for j in range(len(b) - width + 1):
            if (s := b[j : j + width]) in seen:
                gone[j : j + width] = True
            seen.add(s)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[k] = (i, len(b), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest())
    return sorted(out.values(), key=str)


@pytest.mark.parametrize("kw", [{}, {"shard_bytes": 1500}, {"shard_bytes": 1500, "hot": 1}])
def test_suffix_matches_brute_force(spark, docs, kw):
    rows = [r for r in ROWS if r != ROWS[-1]]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = suffix.deduplicate(spark, df, **kw)
    assert "component_id" in got.columns
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()), key=str) == brute_suffix(rows, 100)


def test_suffix_keeps_one_of_repeated_rows(spark, none):
    df = spark.createDataFrame([(1, "y" * 50 + BASE[0]), (1, "y" * 50 + BASE[0]), (2, None)], "doc_id long, text string")
    got = suffix.deduplicate(spark, df).collect()
    assert sorted(r.n_removed == 0 for r in got) == [False, True, True]
    assert suffix.deduplicate(spark, none).count() == 0


def test_common_prefixes_agree_with_direct_comparison():
    data = np.frombuffer(b"abracadabra" * 40 + b"xyz" * 50, np.uint8)
    offs = np.array([0, 300, len(data)])
    starts, stops = np.array([0, 300]), np.array([300 - 19, len(data) - 19])
    order = suffix.suffix_order(data, starts, stops, 20)
    strings = [data[p : p + 20].tobytes() for p in order]
    assert strings == sorted(strings)
    lcp = suffix.common_prefixes(data, lambda p: offs[np.searchsorted(offs, p, "right")], order)
    for k in range(1, len(order)):
        a, b = (data[p : offs[np.searchsorted(offs, p, "right")]] for p in order[k - 1 : k + 1])
        n = min(len(a), len(b))
        differ = np.flatnonzero(a[:n] != b[:n])
        assert lcp[k] == (differ[0] if len(differ) else n)


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_contamination_matches_brute_force(spark, docs, none, block_bytes):
    items = [(1, BASE[0]), (2, "alpha beta"), (3, " ".join(BASE[1].split()[5:25])), (4, None), (5, ""), (6, "One"), (10, BASE[0]), (None, BASE[3])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = {}
    for i, t in items:
        w = alnum(t)
        for k in range(max(len(w) - 12, min(len(w), 1))) if i is not None else ():
            windows.setdefault(tuple(w[k : k + 13]), set()).add(i)
    got = decontaminate.contamination(spark, docs, bench, block_bytes=block_bytes).select("doc_id", "text", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    assert len(got) == len(ROWS)
    for r in got:
        w = alnum(r.text)
        hit, found = np.zeros(len(w), bool), set()
        for win, ids in windows.items():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k : k + len(win)]) == win:
                    hit[k : k + len(win)] = True
                    found |= ids
        n = int(hit.sum())
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (len(w), n, len(found), n > 0 and 20 * n >= len(w))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
    assert decontaminate.contamination(spark, none, bench).count() == 0
    assert not decontaminate.contamination(spark, docs, bench.limit(0)).where("n_hit > 0").count()


def test_packing_round_trip(spark, docs, none):
    from tokenizers import Tokenizer

    vocab = queries.vocabulary("word_bpe_49k.json")
    tok = Tokenizer.from_file(vocab)
    odd = ["<|endoftext|> in text", "ǅ Σας İ", "it's 'S'LL", "a b\x1c"]
    df = docs.select("doc_id", "text").union(spark.createDataFrame(list(enumerate(odd, 500)), "doc_id long, text string"))
    texts = {i: t for i, t, *_ in ROWS if i is not None} | dict(enumerate(odd, 500))
    got = packing.packed(spark, df, vocab, capacity=128, group_pieces=40).toPandas()
    for r in got.itertuples():
        if r.doc_id == r.doc_id and r.doc_id is not None:
            ids = np.array([*tok.encode(texts[int(r.doc_id)] or "", add_special_tokens=False).ids, 0], "<u4")[r.start : r.start + r.length]
            assert len(ids) == r.length and zlib.crc32(ids.tobytes()) == r.ids_crc32 and r.start == 128 * r.piece
    for _, seq in got.sort_values("offset").groupby("sequence_id"):
        assert (seq["offset"].to_numpy() == np.cumsum(seq["length"]) - seq["length"]).all() and seq["length"].sum() <= 128
    assert packing.packed(spark, none, vocab).count() == 0


def test_sum_of_squares_is_near_the_bound():
    lengths = RNG.integers(1, 2049, 3000)
    seq, off = packing.pack(lengths)
    assert seq.max() + 1 <= -(-lengths.sum() // 2048) * 1.02
    assert all(np.bincount(seq, lengths) <= 2048)


def test_minimax_cuts_are_least():
    for _ in range(50):
        sizes = RNG.integers(0, 30, RNG.integers(1, 12))
        k = int(RNG.integers(1, 5))
        best = min(
            max(int(sizes[a:b].sum()) for a, b in zip([0, *cut], [*cut, len(sizes)], strict=True))
            for cut in _cuts(len(sizes), k)
        )
        ends, capacity = sharding.minimax_cuts(sizes, k)
        assert capacity == best and len(ends) <= k and ends[-1] == len(sizes)


def _cuts(n, k):
    from itertools import combinations_with_replacement

    return combinations_with_replacement(range(n + 1), k - 1)


def test_sharding(spark, docs, none):
    got = sharding.shard(spark, docs, shards=4).collect()
    assert len(got) == len(ROWS)
    texts = {i: t or "" for i, t, *_ in ROWS}
    where = {}
    for r in got:
        t = texts[r.doc_id] if r.doc_id is not None else BASE[0]
        assert r.size == len(t.encode()) + 1 and r.text_crc32 == zlib.crc32(t.encode()) and r.law == "bytes" and r.grown_shard is None
        assert where.setdefault(t, r.shard) == r.shard
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert sharding.shard(spark, none).count() == 0


def test_token_counts_match_the_library(spark, docs, none):
    from sentencepiece import SentencePieceProcessor

    vocab = queries.vocabulary("piece_bpe_32k.model")
    model = SentencePieceProcessor(model_file=vocab)
    odd = [" ", "  a", "a  b   c ", "x▁y", "<s> a </s>", "\t\n ", "　 a", "\x00 b"]
    df = docs.select("doc_id", "text", "n_words").union(spark.createDataFrame([(900 + i, t, "") for i, t in enumerate(odd)], "doc_id long, text string, n_words string"))
    got = token_counts.token_counts(spark, df, vocab, limit=50).collect()
    assert len(got) == len(ROWS) + len(odd)
    for r in got:
        n = len(model.encode(r.text)) if r.text else 0
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len((r.text or "").encode()), n > 50), r
    assert token_counts.token_counts(spark, none, vocab).count() == 0


def test_minhash_filter_misses_less_than_the_bands():
    n = minhash.BANDS * minhash.ROWS
    a = np.arange(n, dtype=np.uint32)
    rows = [np.where(np.arange(n) < k, a, a + np.uint32(1000)).tobytes() for k in range(n + 1)]
    batch = pa.RecordBatch.from_pydict({"src": list(range(n + 1)), "dst": [0] * (n + 1), "sig_a": [a.tobytes()] * (n + 1), "sig_b": rows})
    least = min(next(minhash._likely([batch], 80)).column("src").to_pylist())
    miss = sum(math.comb(n, k) * 0.8**k * 0.2 ** (n - k) for k in range(least))
    assert miss <= (1 - 0.8**minhash.ROWS) ** minhash.BANDS


def test_licenses_near_each_other():
    scanner = licenses.Scanner((("mpl", "mozilla public license", 2),))
    one, worse = "mozilla public license", "mozila public license"
    for parts in ([one, one], [worse, "x", one], [one, worse, one, worse], [worse, worse, "and", one], [one] * 50, [worse] * 50):
        places, at = [], 1
        for p in parts:
            places += [(at, at + len(p), 0, int(p == worse))] if p in (one, worse) else []
            at += len(p) + 1
        assert scanner.find(f" {' '.join(parts)} ") == places


def test_licenses(spark, none):
    texts = ["All Rights  Reserved. x all rights reserved", "cc by-nc; CC\nBY", "GNU General Public License", "licensd under the Apache-License, version 2.0", "calling all rights reservedly", "ccby", None, "", "all rights all rights reserved"]
    got = {r.doc_id: r for r in licenses.licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("score", licenses_literal())).collect()}
    phrases = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}
    for i, t in enumerate(texts):
        w = alnum(t)
        places = sorted((k, label) for label, p in phrases.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split())
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(places), places[0][0] if places else None, places[-1][0] if places else None)
        assert r.base_labels == ",".join(sorted({x for _, x in places})) and 0 <= r.score <= 1
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
    assert "apache-notice" in got[3].labels and got[3].spans[0].edits == 1
    assert texts[3][got[3].spans[0].start : got[3].spans[0].end].startswith("licensd")
    assert licenses.licenses(none).count() == 0


def licenses_literal():
    from pyspark.sql import functions as F

    return F.lit("clash")


def test_language_held_out(spark, none):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = language.language_id(spark, docs).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == docs.count() and sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    odd = spark.createDataFrame([(1, None, "en"), (2, "", "en"), (3, "123 !?", None), (4, "the one and the other", "en"), (5, "x" * 100_000, "fr")], "doc_id long, text string, lang string")
    known = {r.doc_id: (r.lang_pred, r.score) for r in language.language_id(spark, odd).collect()}
    assert known[1] == known[2] == known[3] == ("und", 0.0) and all(0 <= s <= 1 for _, s in known.values())
    assert language.language_id(spark, none.withColumn("lang", licenses_literal())).count() == 0


def test_language_rare_ones_are_learned(spark):
    rng = np.random.default_rng(3)
    letters = {"common": "abcdefgh", "one": "ijklm", "two": "nopqr", "three": "stuvw"}

    def text(lang):
        return " ".join("".join(rng.choice(list(letters[lang]), 4)) for _ in range(20))

    rows = [(lang, text(lang)) for lang in letters for _ in range(3000 if lang == "common" else 6)] + [("blank", "12 34")] * 3
    docs = spark.createDataFrame(rows, "lang string, text string")
    for more in ({}, {"lang_docs": 2}):
        model = language.train(docs, F.lit(True), train_docs=100, **more)
        assert model.langs == sorted(letters)
        assert all(model.score([text(lang)])[0] == [lang] for lang in letters for _ in range(5))
    assert [language._quota([5, 100, 50], t) for t in (9, 35, 100, 155)] == [3, 15, 47, 100]
