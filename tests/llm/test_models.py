"""Vectors, toxicity, components, and the whole pipeline."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.llm import components, embeddings, toxicity
from pagemill.llm.staging import Staging

RNG = np.random.default_rng(5)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (7, 7), (None, 3), (200, 150), (150, 201)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(chain, "src long, dst long"), Staging(spark, "t")).collect()}
    assert all(got[i] == 0 for i in range(1, 41)) and got[102] == got[101] == 100 and got[200] == got[201] == 150
    assert components.components(spark.createDataFrame([], "src long, dst long"), Staging(spark, "t")).count() == 0


@pytest.mark.parametrize("block", [2048, 8])
def test_embeddings_match_brute_force(spark, block):
    base = RNG.standard_normal((12, 16))
    x = np.concatenate([base, base[:6] + 0.08 * RNG.standard_normal((6, 16)), np.repeat(base[:1], 20, axis=0) + 0.05 * RNG.standard_normal((20, 16)), base[:3], 5 * base[3:4]]).astype(np.float32)
    rows = [(i, v.tolist(), int(i % 12 == 3), "c") for i, v in enumerate(x)]
    rows += [(100, None, 0, "c"), (101, [0.0] * 16, 0, "c"), (102, [float("nan")] * 16, 0, "c"), (103, [None] + [1.0] * 15, 0, "c"), (104, x[0].tolist(), None, "c"), (None, x[0].tolist(), 0, "c"), (105, [1.0], 0, "c"), (106, [2.0], 0, "c"), (107, [], 0, "c")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, kept string")
    got = {r.vec_id: r for r in embeddings.near_duplicates(spark, df, block=block).collect()}
    assert len(got) == len(rows)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    label = np.array([r[2] for r in rows[: len(x)]])
    links = (unit @ unit.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(links, False)
    reach = links | np.eye(len(x), dtype=bool)
    for _ in range(6):
        reach = (reach.astype(int) @ reach.astype(int)) > 0
    for i in range(len(x)):
        root = int(np.argmax(reach[i]))
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (links[i].sum(), root, root == i)
    for i in (100, 101, 102, 103, 104, 107, None):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[105].n_links == 1 and got[106].component_id == 105
    assert embeddings.near_duplicates(spark, df.limit(0)).count() == 0


def test_filters_find_pairs_at_the_threshold():
    u = RNG.standard_normal((4000, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w = RNG.standard_normal(u.shape)
    w -= (w * u).sum(axis=1, keepdims=True) * u
    v = 0.98 * u + np.sqrt(1 - 0.98**2) * w / np.linalg.norm(w, axis=1, keepdims=True)
    assert all(np.intersect1d(a, b).size for a, b in zip(embeddings.decode(u), embeddings.decode(v), strict=True))


def test_toxicity(spark):
    words = ["".join(RNG.choice(list("abcdeghilmnorst"), RNG.integers(2, 8))) for _ in range(300)]
    rude = ["idiot", "worthless", "scum"]

    def text(bad):
        w = list(RNG.choice(words, 120))
        for k in range(0, 120, 20):
            if bad:
                w[k] = str(RNG.choice(rude))
        return " ".join(w)

    rows = [(i, text(i % 3 == 0), "clash") for i in range(300)] + [(900, None, ""), (901, "", ""), (None, text(True), "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)] + [(None, 1), (900, None)], "doc_id long, toxic int")
    got = toxicity.toxicity(spark, docs, labels).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 300]
    assert sum(r.predicted == int(r.doc_id % 3 == 0) for r in held) >= 0.9 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert {r.score for r in toxicity.toxicity(spark, docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.toxicity(spark, docs.limit(0), labels).count() == 0


def test_toxicity_learns_from_whole_texts(spark):
    words = ["".join(RNG.choice(list("abcdeghilmnorst"), RNG.integers(2, 8))) for _ in range(300)]

    def text(bad):
        plain = " ".join(RNG.choice(words, 5000))
        assert len(plain) > 20_000
        return plain + " " + " ".join(f"{RNG.choice(words)} you worthless scum" if bad else str(RNG.choice(words)) for _ in range(20))

    docs = spark.createDataFrame([(i, text(i % 2)) for i in range(24)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(24)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, F.lit(True))
    new = spark.createDataFrame([(i, text(i % 2)) for i in range(8)], "doc_id long, text string")
    assert all(r.predicted == r.doc_id % 2 for r in toxicity.score(spark, new, model).collect())


def test_pipeline_languages(spark):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string"
    twins = [(i, "la casa de la playa", ("es", "pt", "gl")[i % 3]) for i in range(60)] + [(100, "la casa", None), (101, "12 !", "es"), (102, None, "es")]
    docs = spark.createDataFrame(twins, schema)
    assert {r.doc_id for r in corpus_pipeline.languages(spark, docs, "").collect()} == {*range(60), 100}
    unknown = spark.createDataFrame([(i, "some text", None) for i in range(9)], schema)
    assert {r.doc_id for r in corpus_pipeline.languages(spark, unknown, "").collect()} == set(range(9))


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    d = "/root/testdata/sf0.001"
    docs, bench = spark.read.parquet(f"{d}/documents.parquet").limit(60), spark.read.parquet(f"{d}/benchmark.parquet")
    item = bench.first().text
    first = docs.orderBy("doc_id").where("lang = 'en' AND n_chars > 500").first()
    more = [(9001, "12 34 !!", "en", "s", 8), (9002, first.text + " tail", "en", "s", 1), (9003, item, "en", "s", 1), (9004, None, None, None, None)]
    docs.unionByName(spark.createDataFrame(more, docs.schema)).write.parquet(str(tmp_path / "documents.parquet"))
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    frame = spark.read.parquet(str(tmp_path / "documents.parquet"))
    gone = {"language": 9001, "near_duplicates": 9002, "decontamination": 9003}
    for name, apply in corpus_pipeline.STAGES:
        out = apply(spark, frame, str(tmp_path))
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / f"out-{name}"))
        ids = {r.doc_id for r in frame.select("doc_id").collect()}
        frame = spark.read.parquet(str(tmp_path / f"out-{name}"))
        if name in gone:
            assert gone[name] in ids and not frame.where(F.col("doc_id") == gone[name]).count()
    assert frame.count() >= 30 and frame.agg(F.max("length")).first()[0] <= 2048
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == frame.count()
