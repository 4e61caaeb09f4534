"""Words that polynomials confuse, crowded groups, many languages, edits by brute force, and the pipeline's rules."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pagemill.llm import decontaminate, language, licenses, minhash, staging


def thue_morse(n, flip=False):
    return "".join("ab"[(bin(i).count("1") + flip) % 2] for i in range(n))


ONE, OTHER = thue_morse(1024), thue_morse(1024, True)


def test_words_that_differ_are_told_apart(spark):
    docs = spark.createDataFrame([(1, ONE), (2, OTHER)], "doc_id long, text string")
    assert {r.component_id for r in minhash.near_duplicates(spark, docs, words=2).collect()} == {1, 2}
    bench = spark.createDataFrame([(7, ONE)], "item_id long, text string")
    assert {r.doc_id: r.n_hit for r in decontaminate.contamination(spark, docs, bench).collect()} == {1: 1, 2: 0}


@pytest.fixture
def written(monkeypatch):
    """Row counts of the tables that an operator stages."""
    counts = {}
    write = staging.Staging.write

    def counted(self, df, name):
        out = write(self, df, name)
        counts[name] = out.count()
        return out

    monkeypatch.setattr(staging.Staging, "write", counted)
    return counts


def test_minhash_repeated_rows_stay_linear(spark, written):
    rows = [(1, "one two three four five six")] * 40 + [(2, "one two three four five six"), (3, "one two three four five seven")]
    got = minhash.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), words=1).collect()
    assert len(got) == 42 and {r.component_id for r in got} == {1, 3}
    assert written["texts"] <= 4


def test_minhash_group_below_the_threshold_makes_few_pairs(spark, written):
    """Texts that share three quarters of their words with all others: nearly every pair shares a band, none is linked."""
    rng = random.Random(5)
    common = [f"w{i}" for i in range(90)]
    rows = [(i, " ".join(common + [f"x{rng.randrange(10**9)}" for _ in range(14)])) for i in range(600)]
    rows += [(1000 + i, rows[i][1]) for i in range(0, 600, 100)]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), words=1).collect()}
    assert all(c == (k - 1000 if k >= 1000 else k) for k, c in got.items())
    assert written["likely"] < 600


def test_many_languages_are_all_learned(spark):
    """Three hundred languages of two letters each, with fewer buckets than one language would have."""
    rng = random.Random(3)
    letters = {f"l{k:03d}": chr(0x4E00 + 2 * k) + chr(0x4E01 + 2 * k) for k in range(300)}
    text = lambda k: " ".join("".join(rng.choices(letters[k], k=4)) for _ in range(12))
    docs = spark.createDataFrame([(k, text(k)) for k in letters for _ in range(3)], "lang string, text string")
    model = language.train(docs, F.lit(True), cells=1 << 22)
    assert model.langs == sorted(letters) and model.log_probs.shape[0] * 300 <= 1 << 22
    assert model.score([text(k) for k in sorted(letters)])[0] == sorted(letters)


def test_language_batches_score_like_single_texts(spark):
    texts = ["Der Hund und die Katze", "the dog and the cat", None, "", "123 !", "Le chien et le chat" * 200, "ΣΑΣ"]
    docs = spark.createDataFrame([("de", texts[0]), ("en", texts[1]), ("fr", texts[5])] * 3, "lang string, text string")
    model = language.train(docs, F.lit(True))
    together, alone = model.score(texts), [model.score([t]) for t in texts]
    assert together[0] == [a[0][0] for a in alone] and np.allclose(together[1], [a[1][0] for a in alone])
    assert together[0][2:5] == ["und"] * 3 and together[0][:2] == ["de", "en"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_license_labels_match_brute_force_edits(spark):
    rng = random.Random(9)
    notices = licenses.MORE
    rows = []
    for i in range(120):
        label, phrase, edits = notices[i % len(notices)]
        p = list(phrase)
        for _ in range(rng.randrange(edits + 3)):
            at = rng.randrange(len(p))
            p[at : at + 1] = rng.choice([[], ["é"], [p[at], "z"]])
        rows.append((i, " ".join(["lorem ipsum", "".join(p), "dolor", phrase if i % 5 == 0 else "", "sit amet"])))
    got = {r.doc_id: set(filter(None, r.labels.split(","))) for r in licenses.licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())
        for label, phrase, edits in notices:
            n = len(phrase.split())
            spans = (" ".join(words[a : a + k]) for k in range(max(n - edits, 1), n + edits + 1) for a in range(len(words) - k + 1))
            want = any(abs(len(s) - len(phrase)) <= edits and distance(s, phrase) <= edits for s in spans)
            assert (label in got[i]) == want, (i, t, label)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, lang_pred string, n_bytes string, n_words string"
BASE = [" ".join(f"word{k}x{j}" for j in range(80)) for k in range(6)]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows = [(k, t, "en", "s", len(t), "a", "b", "c", "d") for k, t in enumerate(BASE)]
    rows += [(2, BASE[2], "en", "s", len(BASE[2]), "a", "b", "c", "d"), (10, BASE[1] + " more", "en", "t", 5, "e", "f", "g", "h"), (11, "123 456", "en", "s", 7, "a", "b", "c", "d"), (12, None, None, None, None, None, None, None, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    window = " ".join(BASE[3].split()[30:33])
    spark.createDataFrame([(1, window), (2, " ".join(BASE[4].split()[:40]))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, window


def test_pipeline_stages_keep_columns_and_apply_their_decisions(spark, corpus):
    folder, window = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        seen[name] = {(r.doc_id, r.text): r for r in out.collect()}
        docs = staging.Staging(spark, "test").write(out, name)
    assert {k for k, _ in seen["language"]} == {0, 1, 2, 3, 4, 5, 10}
    assert sorted(k for k, _ in seen["near_duplicates"]) == [0, 1, 2, 3, 4, 5]
    last = {k: r for (k, _), r in seen["decontamination"].items()}
    assert set(last) == {0, 1, 2, 3, 5}
    assert window not in last[3].text and last[3].n_chars == len(last[3].text) and last[0].text == BASE[0]
    assert all((r.score, r.lang_pred, r.n_bytes, r.n_words) == ("a", "b", "c", "d") for r in last.values())
    packed = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in packed.collect()} == set(last)


def test_pipeline_on_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
