"""Vocabulary operators shuffle the places of suspects only."""

import pytest

from pagemill.operators import proposals, vocab

TEXTS = [(k, "the big dog saw the big cat and a layer ed part of it layered layered " * 20) for k in range(40)]


@pytest.mark.parametrize("find", ["pairs", "repairs", "fragments"])
def test_places_of_other_tokens_are_dropped_where_they_are_read(spark, find):
    rows = spark.createDataFrame(TEXTS, "k int, t string")
    words, pairs = vocab.vocab_words(rows, "t"), vocab.vocab_pairs(rows, "t")
    if find == "pairs":
        got = vocab.joined_pair_suspects(rows, "k", "t", words, pairs)
    elif find == "repairs":
        got = vocab.token_repairs(rows, "k", "t", words, pairs)
    else:
        got = vocab.fragment_suspects(rows, "k", "t", words)
    got.collect()
    # suspects are written before places are read: what is left to join are places and suspects, and a fragment's neighbours
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join ") <= (3 if find == "fragments" else 1)


def test_neighbours_are_found_where_a_text_is(spark):
    texts = spark.createDataFrame([(1, ["the", "big", "the", "big"]), (2, ["the"]), (3, [])], "k int, words array<string>")
    vocabulary = spark.createDataFrame([("the", 3), ("big", 2)], "word string, n long")
    pairs = spark.createDataFrame([("the", "big", 2), ("big", "the", 1)], "w1 string, w2 string, n long")
    got = proposals.spacing_scores(texts, vocabulary, pairs, "k")
    assert {r.k: r.score for r in got.collect()} == {1: 5, 2: 0}
