"""Texts longer than a chunk or a shard, sequences against their lower bound, capacities by brute force."""

import random
from collections import defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from pagemill.llm import decontaminate, language, licenses, packing, sharding, suffix, token_counts


def long_text(seed, n):
    rng = np.random.default_rng(seed)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz     ", np.uint8)
    return letters[rng.integers(0, len(letters), n)].tobytes().decode()


def test_texts_longer_than_a_chunk(spark):
    text = long_text(1, 2_500_000)
    window = " ".join(f"item{k}" for k in range(13))
    docs = spark.createDataFrame([(1, f"{text} {window} all rights reserved", "en"), (2, "über größere Häuser " * 250, "de"), (3, text[:5000], "en")], "doc_id long, text string, lang string")
    bench = spark.createDataFrame([(5, window)], "item_id long, text string")
    hit = {r.doc_id: (r.n_hit, r.hit_items) for r in decontaminate.contamination(spark, docs, bench).collect()}
    assert hit == {1: (13, [5]), 2: (0, []), 3: (0, [])}
    found = {r.doc_id: (r.n_base, r.base_labels) for r in licenses.licenses(docs).collect()}
    assert found[1] == (1, "reserved") and found[2] == (0, "")
    model = language.train(docs, F.col("doc_id") > 1)
    assert {r.doc_id: r.lang_pred for r in language.identify(spark, docs, model).collect()} == {1: "en", 2: "de", 3: "en"}
    path = public_tokenizers.path("piece_bpe_32k.model")
    from sentencepiece import SentencePieceProcessor

    whole = SentencePieceProcessor(model_file=path)
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(spark, docs, path).collect()} == {r.doc_id: len(whole.encode(r.text)) for r in docs.collect()}


def test_texts_longer_than_a_shard(spark):
    a, b = long_text(2, 4_500_000), long_text(3, 4_400_000)
    docs = spark.createDataFrame([(1, a), (2, b + a[1_000_000:1_700_000])], "doc_id long, text string").repartition(2)
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in suffix.deduplicate(spark, docs).select("doc_id", "n_removed", "n_spans").collect()}
    assert got == {1: (0, 0), 2: (700_000, 1)}


def test_sequences_stay_near_the_lower_bound(spark):
    rng = random.Random(1)
    docs = spark.createDataFrame([(i, "word " * rng.randrange(1, 1000)) for i in range(600)], "doc_id long, text string")
    rows = packing.packed(spark, docs, public_tokenizers.path("word_bpe_49k.json"), group_pieces=200).collect()
    used = defaultdict(int)
    for r in rows:
        used[r.sequence_id] += r.length
    groups = len({r.sequence_id >> 32 for r in rows})
    assert groups > 1 and max(used.values()) <= 2048
    assert len(used) <= -(-sum(used.values()) // 2048) * 1.02 + groups


def test_capacity_is_the_least_by_brute_force(spark):
    rng = random.Random(2)
    docs = spark.createDataFrame([(i, "x" * rng.randrange(60) + str(i % 90)) for i in range(300)], "doc_id long, text string")
    slots, shards = 24, 5
    sums = np.zeros(slots, int)
    for r in docs.select(F.pmod(F.xxhash64("text"), F.lit(slots)).alias("g"), F.length("text").alias("n")).collect():
        sums[r.g] += r.n + 1
    ends = np.concatenate([[0], np.cumsum(sums)])
    best = [[0] + [10**9] * slots] + [[0] * (slots + 1) for _ in range(shards)]
    for k in range(1, shards + 1):
        for j in range(slots + 1):
            best[k][j] = min(max(best[k - 1][i], ends[j] - ends[i]) for i in range(j + 1))
    sizes = defaultdict(int)
    got = sharding.shard(spark, docs, shards=shards, slots=slots).collect()
    for r in got:
        sizes[r.shard] += r.size
    assert max(sizes.values()) == best[shards][slots]
    assert len({(r.text_crc32, r.shard) for r in got}) == len({r.text_crc32 for r in got})


def test_decontamination_needs_one_worker_a_task(spark, tmp_path):
    text = " ".join(f"w{k}" for k in range(300))
    rows = [(1, f"é, {text}! W7: w8.", "en"), (2, None, "en"), (3, "", "en"), (4, "w7 w8", "en"), (5, f"{text} One", "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "w7, w8"), (2, "one")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, bench = (spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in ("documents", "benchmark"))
    out = corpus_pipeline.clean_of_benchmarks(spark, docs, str(tmp_path))
    less = text.replace(" w7 w8 ", "  ")
    want = {(1, f"é, {less}! ."), (2, None), (3, ""), (5, f"{less} ")}
    assert {(r.doc_id, r.text) for r in out.collect()} == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    blocks = decontaminate.contamination(spark, docs, bench, block_bytes=1, cut=True)
    assert {(r.doc_id, r.text) for r in blocks.collect() if not r.contaminated} == want


def test_frequent_words_outlive_rare_ones(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 50)
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, merged = packing.Encoder(path), []
    merge = encoder._merge
    encoder._merge = lambda letters: merged.append(letters) or merge(letters)
    often = [f"often{'abcdefghij'[k]}, it's" for k in range(10)]
    rare = random.Random(3)
    for _ in range(30):
        texts = [*often, *("".join(rare.choices("xyzéq", k=12)) for _ in range(40))]
        assert encoder.many(texts) == [encoder._whole(t) for t in texts]
    assert merged.count("oftena") == merged.count("it") == 1
    assert max(len(encoder._words), len(encoder._chunks)) < 30 * 40 / 4


def test_a_word_that_stood_alone_is_merged_and_held_once():
    encoder, merged = packing.Encoder(public_tokenizers.path("word_bpe_49k.json")), []
    merge = encoder._merge
    encoder._merge = lambda letters: merged.append(letters) or merge(letters)
    texts = ["Alonex alonex, (alonex) alonex's", "onlyalone onlyalone", "d.e.f .. ?! 'll 7, a7, é, Éé: x\x0by x\xa0y <|endoftext|> a<|b \u2019s"]
    texts += [chr(x) + "a, " + chr(x) for x in range(0x300)]
    assert encoder.many(texts) == [encoder._whole(t) for t in texts]
    assert [encoder._strange(t) for t in texts] == [encoder._odd.search(t) is not None for t in texts]
    assert merged.count("alonex") == 1 and "onlyalone" in encoder._chunks and "onlyalone" not in encoder._words


def test_first_places_of_equal_hashes():
    for x in (np.zeros(0, np.uint64), np.full(5, 2**64 - 1, np.uint64), np.random.default_rng(4).integers(0, 400, 1000).astype(np.uint64)):
        seen = {}
        assert suffix._first_places(x).tolist() == [seen.setdefault(h, k) for k, h in enumerate(x.tolist())]
