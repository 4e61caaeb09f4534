"""Hashed runs of words against sets of strings: letters beyond ASCII, long words, texts on the edge of chunks."""

import random
import re

from pagemill.operators import shingles


def runs(text, n):
    words = re.findall("[a-z0-9]+", (text or "").lower())
    return {" ".join(words[k : k + n]) for k in range(len(words) - n + 1)} if len(words) >= n else {" ".join(words)} - {""}


def test_hashed_runs_stand_for_runs(spark, monkeypatch):
    rng = random.Random(12)
    vocabulary = ["a", "b", "ab", "B", "a1", "é", "x" * 8, "x" * 9, "y" * 64, "y" * 65, "y" * 64 + "z" + "w" * 30, "İ", "word", "wo-rd", "0", "00"]
    texts = [None, "", " ", "é", "a", *(" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(30))) for _ in range(400))]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string").coalesce(1)
    got = {r.key: r.sh for r in shingles.hashed_shingles(rows, "k", "t", 3).collect()}
    names = {}
    for k, t in enumerate(texts):
        own = runs(t, 3)
        assert len(got[k]) == len(set(got[k])) == len(own), (k, t)
        for hashes, strings in ((frozenset(got[k]), frozenset(own)),):
            assert names.setdefault(hashes, strings) == strings
    # as many different runs as hashes, over all texts
    assert len({h for s in got.values() for h in s}) == len({r for t in texts for r in runs(t, 3)})


def test_chunks_do_not_run_into_one_another(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(shingles, "CHUNK_BYTES", 7)
    texts = ["ab cd", "ef", None, "gh ij kl", "", "mn"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], names=["key", "text"])
    small = [r for b in shingles._hashed([batch.slice(1)], 2) for r in b.column("sh").to_pylist()]
    monkeypatch.setattr(shingles, "CHUNK_BYTES", 1 << 20)
    large = [r for b in shingles._hashed([batch], 2) for r in b.column("sh").to_pylist()]
    assert small == large[1:] and [len(x) for x in large] == [1, 1, 0, 2, 0, 1]


def test_shingles_are_shuffled_once_and_not_kept(spark, monkeypatch):
    from pagemill.operators import audit

    written, write = [], audit.Scratch.write
    monkeypatch.setattr(audit.Scratch, "write", lambda self, df, name: written.append((name, write(self, df, name))) or written[-1][1])
    rows = spark.createDataFrame([(1, "a b c d e f g h i"), (2, "a b c d e f g h i"), (3, "z y x w v u t s r")], "k long, t string")
    got = audit.duplicate_stems(rows, "k", "t").collect()
    assert [(r.key, r.matched, r.shared, r.smaller) for r in got] == [(2, 1, 2, 2)]
    assert [name for name, _ in written] == ["met"] and written[0][1].count() == 4
