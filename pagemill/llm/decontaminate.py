"""Benchmark decontamination: prefix-filtered containment join over item-sized windows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField

from .arrow import ALNUM, Words, buffers, chain, mix, ragged, same_words, text_chunks, with_columns, word_hashes, word_table
from .staging import Staging

WINDOW = 13
#: Items of one block hold about so many bytes of text (or are one item); blocks are joined one after the other. A full block
#: takes about 300 MB on the driver while its index is made, and 34 MB in each worker (500,000 windows).
BLOCK_BYTES = 4 << 20


@dataclass
class Index:
    """The windows of one block of items, under their rarest shingle each.

    ``token`` is sorted; entry k of it stands for window ``window[k]`` and the place ``at[k]`` of
    that shingle in it. Window w has ``length[w]`` words, from ``begin[w]`` on in ``words``; it
    occurs in the items ``item[item_first[w]:item_first[w+1]]``.
    """

    token: np.ndarray
    window: np.ndarray
    at: np.ndarray
    length: np.ndarray
    begin: np.ndarray
    words: Words
    item_first: np.ndarray
    item: np.ndarray
    sieve: np.ndarray


def _tokens(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """At each word the shingle of it and the next word of the row; at a row's last word that word alone."""
    nxt = np.zeros_like(hashes)
    if len(hashes):
        nxt[:-1] = hashes[1:]
        nxt[first[1:][first[1:] > first[:-1]] - 1] = 0
    return chain([hashes, nxt]) if len(hashes) else hashes


def _sieve(tokens: np.ndarray) -> np.ndarray:
    s = np.zeros(1 << 20, bool)
    s[(tokens & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
    return s


def _found(tokens: np.ndarray, wanted: np.ndarray, sieve: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``tokens`` that are among the sorted ``wanted``, and where there."""
    at = np.flatnonzero(sieve[(tokens & np.uint64((1 << 20) - 1)).astype(np.int64)])
    if not len(wanted) or not len(at):
        return at[:0], at[:0]
    k = np.searchsorted(wanted, tokens[at])
    k[k == len(wanted)] = 0
    hit = wanted[k] == tokens[at]
    return at[hit], k[hit]


def _ranges(first: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of each range one after the other, and which range each is of."""
    owner = np.repeat(np.arange(len(many)), many)
    return first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many), owner


class _Items:
    """Distinct windows of a block of items."""

    def __init__(self, ids: list, texts: list, width: int) -> None:
        w = word_table(*buffers(pa.array(texts, pa.large_string())), ALNUM)
        self.words = Words(w.folded, w.start.astype(np.int32), w.end.astype(np.int32), w.first, w.hash)
        size = np.diff(w.first)
        begin, owner = _ranges(w.first[:-1], np.maximum(size - width + 1, np.minimum(size, 1)))
        length = np.minimum(size, width)[owner]
        # equal windows have equal hashes; a window joins the first of its hash if the words agree, else stands for itself
        h = mix(length.astype(np.uint64))
        for i in range(width):
            more = length > i
            h[more] = mix(h[more] * np.uint64(0x9FB21C651E98DF25) + w.hash[begin[more] + i])
        _, first, which = np.unique(h, return_index=True, return_inverse=True)
        rep = first[which]
        agree = length == length[rep]
        for i in range(width):
            k = np.flatnonzero(agree & (length > i))
            agree[k] = same_words(w, begin[k] + i, w, begin[rep[k]] + i)
        rep = np.where(agree, rep, np.arange(len(rep)))
        kept, number = np.unique(rep, return_inverse=True)
        self.begin, self.length = begin[kept].astype(np.int32), length[kept].astype(np.int32)
        pairs = np.unique(np.stack([number, np.asarray(ids, np.int64)[owner]], axis=1), axis=0) if len(rep) else np.zeros((0, 2), np.int64)
        self.item, self.item_first = pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(kept) + 1))
        # a window's shingles: its pairs of neighbours, or its only word
        self.pairs = chain([w.hash[:-1], w.hash[1:]]) if len(w.hash) > 1 else w.hash[:0]
        alone, many = self.length == 1, self.length > 1
        at, _ = _ranges(self.begin[many].astype(np.int64), self.length[many].astype(np.int64) - 1)
        self.distinct = np.unique(np.concatenate([w.hash[self.begin[alone]], self.pairs[np.unique(at)]]))

    def index(self, counts: np.ndarray) -> Index:
        """``counts``: how often each of ``distinct`` occurs in the documents. All a window's shingles must occur, so one is a necessary prefix: the rarest."""
        n = len(self.begin)
        token, at, best = np.zeros(n, np.uint64), np.zeros(n, np.int32), np.full(n, np.iinfo(np.int64).max)
        alone = self.length == 1
        token[alone] = self.words.hash[self.begin[alone]]
        for i in range(int(self.length.max(initial=1)) - 1):
            k = np.flatnonzero(self.length > i + 1)
            s = self.pairs[self.begin[k] + i]
            seen = counts[np.searchsorted(self.distinct, s)]
            better = (seen < best[k]) | ((seen == best[k]) & (s < token[k]))
            k = k[better]
            token[k], at[k], best[k] = s[better], i, seen[better]
        order = np.argsort(token, kind="stable").astype(np.int32)
        return Index(token[order], order, at[order], self.length, self.begin, self.words, self.item_first, self.item, _sieve(token))


def _pairs_and_words(hashes: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    return [_tokens(hashes, first), hashes]


def _counted(batches: Iterable[pa.RecordBatch], wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
    counts, sieve = np.zeros(len(wanted), np.int64), _sieve(wanted)
    for _, data, offs in text_chunks(batches, "text"):
        for tokens in _pairs_and_words(*word_hashes(data, offs, ALNUM)):
            counts += np.bincount(_found(tokens, wanted, sieve)[1], minlength=len(wanted))
    k = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(counts[k])], names=["k", "n"])


def occurrences(ix: Index, own: Words) -> tuple[np.ndarray, np.ndarray]:
    """First word and window of every occurrence in a chunk of documents; words are compared by hash, then byte by byte."""
    starts, wins = [], []
    for tokens in _pairs_and_words(own.hash, own.first):
        place, k = _found(tokens, ix.token, ix.sieve)
        if not len(place):
            continue
        # a shingle may be the prefix of several windows
        last = np.searchsorted(ix.token, ix.token[k], "right")
        k, which = _ranges(k, last - k)
        place = place[which]
        window = ix.window[k]
        start = place - ix.at[k]
        doc = np.searchsorted(own.first, place, "right") - 1
        inside = (start >= own.first[doc]) & (start + ix.length[window] <= own.first[doc + 1])
        start, window = start[inside], window[inside]
        for exact in (False, True):
            n = ix.length[window]
            for i in range(int(n.max(initial=0))):
                more = np.flatnonzero(n > i)
                mine, theirs = start[more] + i, ix.begin[window[more]] + i
                same = np.ones(len(n), bool)
                same[more] = same_words(own, mine, ix.words, theirs) if exact else own.hash[mine] == ix.words.hash[theirs]
                start, window, n = start[same], window[same], n[same]
        starts.append(start)
        wins.append(window)
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    both = np.unique(np.stack([np.concatenate(starts), np.concatenate(wins)], axis=1), axis=0)
    return both[:, 0], both[:, 1]


_SPANS = [StructField("n_words", LongType()), StructField("hit_spans", ArrayType(LongType())), StructField("hit_items", ArrayType(LongType()))]


def _without(batch: pa.RecordBatch, text: str, data: np.ndarray, offs: np.ndarray, own: Words, spans: list[np.ndarray]) -> pa.Array:
    """The chunk's texts with every range of hit words cut out."""
    if not any(map(len, spans)):
        return batch.column(text)
    texts = batch.column(text).to_pylist()
    for d, s in enumerate(spans):
        if len(s):
            keep = np.ones(offs[d + 1] - offs[d], bool)
            for a, b in s.reshape(-1, 2):
                keep[own.start[own.first[d] + a] - offs[d] : own.end[own.first[d] + b - 1] - offs[d]] = False
            texts[d] = data[offs[d] : offs[d + 1]][keep].tobytes().decode("utf-8")
    return pa.array(texts, batch.column(text).type)


def _with_hits(docs: DataFrame, spark: SparkSession, ix: Index, text: str, more: bool, cut: bool) -> DataFrame:
    """``docs`` with the hit words as flat [first, last + 1, ...] ranges and the items found, added to those of earlier blocks if ``more``, and cut out if ``cut``."""
    sent = spark.sparkContext.broadcast(ix)
    names = ("earlier_spans", "earlier_items")
    if more:
        docs = docs.withColumnsRenamed({"hit_spans": names[0], "hit_items": names[1]})

    def make():  # noqa: ANN202
        index = sent.value

        def call(batch: pa.RecordBatch, data: np.ndarray, offs: np.ndarray) -> list[pa.Array]:
            own_words = word_table(data, offs, ALNUM)
            first = own_words.first
            start, window = occurrences(index, own_words)
            delta = np.zeros(len(own_words.hash) + 1, np.int64)
            np.add.at(delta, start, 1)
            np.add.at(delta, start + index.length[window], -1)
            inside = np.cumsum(delta) > 0
            doc = np.searchsorted(first, start, "right") - 1
            old = [batch.column(c).to_pylist() if more else [[]] * batch.num_rows for c in names]
            spans, items = [], []
            bounds = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            for d in range(batch.num_rows):
                lo, hi = bounds[d], bounds[d + 1]
                s = np.asarray(old[0][d], np.int64)
                found = np.asarray(old[1][d], np.int64)
                if hi > lo:
                    a, b = first[d], first[d + 1]
                    hit = inside[a:b].copy()
                    for x, y in s.reshape(-1, 2):
                        hit[x:y] = True
                    s = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
                    own = [index.item[index.item_first[w] : index.item_first[w + 1]] for w in np.unique(window[lo:hi])]
                    found = np.unique(np.concatenate([found, *own]))
                spans.append(s)
                items.append(found)
            own_texts = [_without(batch, text, data, offs, own_words, spans)] if cut else []
            return [pa.array(np.diff(first)), ragged(spans, pa.int64()), ragged(items, pa.int64()), *own_texts]

        return call

    out = with_columns(docs, text, _SPANS + [StructField(text, StringType())] * cut, make)
    return out.drop(*names) if more else out


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, text: str = "text", item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES, cut: bool = False) -> DataFrame:
    """``docs`` with ``n_words, hit_spans, hit_items, n_hit, n_items, items_sha256, contaminated``.

    Words are runs of ASCII letters (folded) and digits and of everything beyond ASCII. A window
    is ``width`` consecutive words of an item, or the whole of a shorter item; a document's word
    inside any occurrence of a window is hit. ``hit_spans`` holds the ranges of hit words, flat;
    ``contaminated`` is ``n_hit > 0 and 20 * n_hit >= n_words``.

    Null, empty and wordless texts have no words and no hits; such items have no windows. Items
    with a null id are passed over. Repeated rows give repeated results, items that share a window
    are all found. Columns of these names in ``docs`` are replaced, others stay. Empty documents
    give an empty result; an empty benchmark gives no hits.

    Items go in blocks of about ``block_bytes`` (by a hash; a longer item is in one block whole), so
    what the driver holds and broadcasts is bounded by about ten times that;
    for each block the documents are read twice and never shuffled: once to count the block's
    shingles (rarity), once to look up each window's rarest shingle, hold its place against the
    document's ends and compare the words, byte by byte. Further blocks work on a written table.

    With ``cut`` every range of hit words is cut out of the text, from the first byte of its first
    word to the last of its last word; what stands around it stays, and so do texts without hits.
    That is done where the hits are found: a task needs one Python worker for all of it.
    """
    stage = Staging(spark, "decontaminate")
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL")
    sizes = items.select(F.xxhash64("item_id", "text").alias("h"), F.octet_length("text").cast("long").alias("n"))
    blocks = max(1, -(-(sizes.agg(F.sum("n")).first()[0] or 0) // block_bytes))
    out = docs
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).distinct().orderBy("item_id", "text").collect()
        block = _Items([r["item_id"] for r in rows], [r["text"] for r in rows], width)
        counts = np.zeros(len(block.distinct), np.int64)
        if len(counts):
            wanted = spark.sparkContext.broadcast(block.distinct)
            seen = docs.select(F.col(text).alias("text")).mapInArrow(lambda it, w=wanted: _counted(it, w.value), "k long, n long")
            cells = seen.groupBy("k").agg(F.sum("n").alias("n")).toArrow()
            counts[cells["k"].to_numpy()] = cells["n"].to_numpy()
        out = _with_hits(out, spark, block.index(counts), text, k > 0, cut and k + 1 == blocks)
        if k + 1 < blocks:
            out = stage.write(out, f"block{k}")

    signed = F.transform("hit_spans", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))
    ids = F.sort_array(F.transform("hit_items", lambda x: x.cast("string")))
    new = {
        "n_hit": F.aggregate(signed, F.lit(0).cast("long"), lambda a, x: a + x),
        "n_items": F.size("hit_items").cast("long"),
        "items_sha256": F.sha2(F.array_join(ids, ","), 256),
    }
    return out.drop(*new, "contaminated").withColumns(new).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
