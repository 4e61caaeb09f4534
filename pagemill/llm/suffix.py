"""Suffix-array deduplication of long repeated strings.

Texts are dealt, where they are read, to shards of a bounded number of bytes. In each shard a
suffix array over the places that can repeat (Larsson-Sadakane refinement, sorted to the width of
a match) and Kasai's common prefixes find the strings that occur earlier in the shard. What is
left of a shard has each string once; the shards are then merged: strings are sent to the bucket
of their anchor, a short string inside that depends on the string alone, if another shard has that
anchor too, and looked up there by binary search in the sorted table of the bucket's strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .arrow import Hasher, buffers, released, releasing, row_chunks
from .staging import Staging

WIDTH = 100
#: Bytes of an anchor: the string of this length with the least hash inside a match.
ANCHOR = 32
#: Bytes of text in a shard, about; a longer text makes a shard of its own.
SHARD_BYTES = 4 << 20
#: An anchor with more places is not kept together: its strings go to buckets of their own, as 128-bit BLAKE2b digests.
HOT = 4096
#: Bytes of anchors, and of strings (so many for an anchor), that one bucket gathers, about; the number of buckets follows the data.
ANCHOR_BUCKET_BYTES = 8 << 20
STRING_BUCKET_BYTES = 8 << 20
_STRINGS_OF_ANCHOR = 160
_SCAN = 1 << 20
#: Of the compression of texts and strings that are shuffled.
LEVEL = 7

_TEXTS, _LATER, _ANCHORS = 0, 1, 2


def _slide(x: np.ndarray, width: int, op: np.ufunc) -> np.ndarray:
    """``op`` over each ``width`` neighbours."""
    span = 1
    while 2 * span <= width:
        x = op(x[:-span], x[span:])
        span *= 2
    return op(x[: len(x) - width + span], x[width - span :]) if span < width else x


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last-plus-one index of each run of true."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2]


def _running(mask: np.ndarray) -> np.ndarray:
    """How many are true before each place, and in all."""
    out = np.zeros(len(mask) + 1, np.int32)
    np.cumsum(mask, out=out[1:])
    return out


def _covered(n: int, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    delta = np.zeros(n + 1, np.int32)
    np.add.at(delta, starts, 1)
    np.add.at(delta, stops, -1)
    np.cumsum(delta, out=delta)
    return delta[:n] > 0


def segments(data: np.ndarray, offs: np.ndarray, width: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All strings of ``width`` bytes within rows, by runs of one anchor: its hash, first and last-plus-one start."""
    out = []
    for lo, hi in row_chunks(offs, _SCAN):
        base = int(offs[lo])
        part, ends = data[base : offs[hi]], offs[lo : hi + 1] - base
        long = np.diff(ends) >= width
        if not long.any():
            continue
        valid = _covered(len(part) - width + 1, ends[:-1][long], ends[1:][long] - width + 1)
        grams = Hasher(part).windows(k)
        span = width - k + 1
        least = _slide(grams, span, np.minimum)
        pad = np.zeros(span - 1, np.uint64)
        chosen = np.flatnonzero(grams == _slide(np.concatenate([pad, np.where(valid, least, np.uint64(0)), pad]), span, np.maximum))
        start = np.flatnonzero(valid)
        want, at = least[start], np.searchsorted(chosen, start)
        wrong = np.flatnonzero(grams[chosen[at]] != want)
        while len(wrong):
            at[wrong] += 1
            wrong = wrong[grams[chosen[at[wrong]]] != want[wrong]]
        new = np.ones(len(start), bool)
        new[1:] = (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(start)) - 1
        out.append((grams[chosen[at[first]]], start[first] + base, start[last] + base + 1))
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def suffix_order(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, width: int) -> np.ndarray:
    """Places in [start, stop) whose first ``width`` bytes occur twice among them or more, by those bytes, then by place.

    Larsson-Sadakane: order by 8 bytes, then double the length, each time sorting only inside
    groups that are still equal, by the rank of what follows. The last step overlaps, so that
    just ``width`` bytes count.
    """
    n = len(data)
    rank = np.zeros(n, np.int32)
    h = min(8, width)
    pos = np.flatnonzero(_covered(n, starts, stops + width - h)).astype(np.int32)
    key = np.zeros(len(pos), np.uint64)
    for t in range(h):
        key = (key << np.uint64(8)) | data[pos + t]
    old = np.zeros(len(pos), np.int32)
    while True:
        order = np.argsort(key)
        pos, key, old = pos[order], key[order], old[order]
        place = np.arange(len(pos), dtype=np.int32)
        fresh = np.ones(len(pos), bool)
        fresh[1:] = key[1:] != key[:-1]
        group = np.ones(len(pos), bool)
        group[1:] = old[1:] != old[:-1]
        rank[pos] = old + np.maximum.accumulate(np.where(fresh, place, 0)) - np.maximum.accumulate(np.where(group, place, 0))
        single = fresh & np.append(fresh[1:], True)
        pos = pos[~single]
        if h >= width:
            break
        step = min(h, width - h)
        h += step
        pos = pos[_covered(n, starts, stops + width - h)[pos]]
        old = rank[pos]
        key = (old.astype(np.uint64) << np.uint64(32)) | rank[pos + step].astype(np.uint64)
    wanted = pos[_covered(n, starts, stops)[pos]]
    return wanted[np.argsort((rank[wanted].astype(np.uint64) << np.uint64(32)) | wanted.astype(np.uint64))].astype(np.int64)


def common_prefixes(data: np.ndarray, ends: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Kasai: bytes that each of ``order`` shares with the one before it; texts end at ``ends[place]``.

    In text order a place whose predecessor is just one after its left neighbour's shares one byte
    less than the neighbour, while that has a byte; only the others are compared, eight bytes at once.
    """
    if len(order) < 2:
        return np.zeros(len(order), np.int64)
    before = np.full(len(data) + 1, -2, np.int32)
    before[order[1:]] = order[:-1]
    place = np.sort(order[1:])
    q = before[place].astype(np.int64)
    head = np.ones(len(place), bool)
    head[1:] = (place[1:] != place[:-1] + 1) | (q[1:] != q[:-1] + 1)
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    word = np.ndarray((len(data) + 8,), "<u8", padded.data, strides=(1,))

    def compared(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        limit = np.minimum(ends(p) - p, ends(q) - q)
        shared, live = np.zeros(len(p), np.int64), np.arange(len(p))
        while len(live):
            diff = word[p[live] + shared[live]] ^ word[q[live] + shared[live]]
            low = diff & (~diff + np.uint64(1))
            shared[live] += np.where(diff == 0, 8, np.log2(np.maximum(low, 1).astype(np.float64)).astype(np.int64) >> 3)
            live = live[(diff == 0) & (shared[live] < limit[live])]
        return np.minimum(shared, limit)

    run = np.cumsum(head) - 1
    found = compared(place[head], q[head])[run] - (place - place[head][run])
    # the rule says nothing beyond the first byte that differs: those places are compared themselves
    past = found <= 0
    past &= ~head
    found[past] = compared(place[past], q[past])
    common = before
    common[place] = found
    return np.concatenate([[0], common[order[1:]]])


def later_places(data: np.ndarray, offs: np.ndarray, starts: np.ndarray, stops: np.ndarray, width: int) -> np.ndarray:
    """Mask of the places in [start, stop) whose ``width`` bytes also start at an earlier one."""
    later = np.zeros(len(data), bool)
    order = suffix_order(data, starts, stops, width)
    same = common_prefixes(data, lambda p: offs[np.searchsorted(offs, p, "right")], order) >= width
    later[order[same]] = True
    return later


def _packed(table: pa.Table | pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=LEVEL))) as w:
        w.write(table)
    return sink.getvalue().to_pybytes()


def _unpacked(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


def _steps(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=0)


def _squeezed(doc: np.ndarray, row: np.ndarray, pos: np.ndarray, length: np.ndarray, body: bytes) -> bytes:
    """Strings with their documents and places, in one compressed frame: most are too few for a table of their own."""
    cols = (_steps(doc), _steps(row), _steps(pos), length)
    return zstandard.ZstdCompressor(level=LEVEL).compress(b"".join([np.int64(len(doc)).tobytes(), *(c.astype(np.int64).tobytes() for c in cols), body]))


def _opened(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    steps = np.frombuffer(raw, np.int64, 4 * n, 8).reshape(4, n)
    return (*np.cumsum(steps[:3], axis=1), steps[3], raw[8 + 32 * n :])


def _text(table: pa.Table, text: str) -> tuple[np.ndarray, np.ndarray]:
    return buffers(table.column(text).cast(pa.large_string()).combine_chunks())


_ROWS = "shard long, kind int, bucket int, body binary"


def _rows(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)], names=["shard", "kind", "bucket", "body"])


def _local(table: pa.Table, shard: int, doc_id: str, text: str, width: int, anchor: int) -> list[tuple[int, int, int, bytes]]:
    table = table.take(pc.sort_indices(table, sort_keys=[(doc_id, "ascending")], null_placement="at_end")).combine_chunks()
    data, offs = _text(table, text)
    hashes, starts, stops = segments(data, offs, width, anchor)
    _, which, count = np.unique(hashes, return_inverse=True, return_counts=True)
    twice = count[which] > 1
    later = later_places(data, offs, starts[twice], stops[twice], width) if twice.any() else np.zeros(len(data), bool)
    lo, hi = _runs(later)
    out = [(shard, _TEXTS, -1, _packed(table)), (shard, _LATER, -1, np.stack([lo, hi], axis=1).astype(np.int64).tobytes())]
    gone = _running(later)
    left = np.sort(hashes[gone[stops] - gone[starts] < stops - starts])
    return out + [(shard, _ANCHORS, len(left), left.tobytes())] if len(left) else out


def _split(batches: Iterable[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Each shard's anchors, dealt to ``buckets``."""
    for batch in batches:
        for shard, body in zip(_column(batch, "shard"), _column(batch, "body"), strict=True):
            left = np.frombuffer(body, np.uint64)
            where = (left % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(where, kind="stable")
            left, where = left[order], where[order]
            edges = np.flatnonzero(np.append(True, where[1:] != where[:-1])).tolist() + [len(left)]
            yield _rows([(shard, _ANCHORS, int(where[a]), left[a:b].tobytes()) for a, b in zip(edges, edges[1:], strict=False)])


def _sharded(batches: Iterable[pa.RecordBatch], doc_id: str, text: str, width: int, anchor: int, shard_bytes: int) -> Iterator[pa.RecordBatch]:
    shard, held, size = TaskContext.get().partitionId() << 32, [], 0

    def flushed() -> Iterator[pa.RecordBatch]:
        nonlocal shard, held, size
        if held:
            rows = _local(pa.Table.from_batches(held), shard, doc_id, text, width, anchor)
            shard, held, size = shard + 1, [], 0
            yield from (_rows([r]) for r in rows[:2])
            yield _rows(rows[2:])

    for batch in batches:
        _, offs = buffers(batch.column(text))
        for lo, hi in row_chunks(offs, shard_bytes):
            if size + int(offs[hi] - offs[lo]) > shard_bytes:
                yield from flushed()
            held.append(batch.slice(lo, hi - lo))
            size += int(offs[hi] - offs[lo])
    yield from flushed()


def _column(table: pa.Table, name: str) -> list:
    return table.column(name).to_pylist()


def _common_anchors(table: pa.Table, most: int) -> pa.Table:
    """Of one bucket: to each shard its anchors that another shard has too, the hot ones apart."""
    shards = _column(table, "shard")
    own = [np.frombuffer(b, np.uint64) for b in _column(table, "body")]
    every, places = np.unique(np.concatenate(own), return_counts=True)
    owners = np.zeros(len(every), np.int64)
    for x in own:
        owners[np.searchsorted(every, np.unique(x))] += 1
    common = owners > 1
    rows = []
    for shard, x in zip(shards, own, strict=True):
        x = np.unique(x)
        k = np.searchsorted(every, x)
        hot = places[k] > most
        rows += [(shard, _ANCHORS, int(h), y.tobytes()) for h in (False, True) if len(y := x[common[k] & (hot == h)])]
    return pa.Table.from_batches([_rows(rows)])


def _digests(data: np.ndarray, places: np.ndarray, width: int) -> np.ndarray:
    """Two numbers for the ``width`` bytes from each place on."""
    body = data.tobytes()
    return np.frombuffer(b"".join(hashlib.blake2b(body[p : p + width], digest_size=16).digest() for p in places.tolist()), np.uint64).reshape(-1, 2)


def _sent(table: pa.Table, doc_id: str, text: str, width: int, anchor: int, buckets: int) -> pa.Table:
    """Of one shard: the strings left that may occur in other shards, to the buckets of their anchors."""
    kinds = _column(table, "kind")
    body = dict(zip(kinds, _column(table, "body"), strict=True))
    shard = _column(table, "shard")[0]
    wanted = {h: np.concatenate([np.frombuffer(b, np.uint64) for k, b, c in zip(kinds, _column(table, "body"), _column(table, "bucket"), strict=True) if k == _ANCHORS and c == h] or [np.zeros(0, np.uint64)]) for h in (0, 1)}
    if not len(wanted[0]) and not len(wanted[1]):
        return pa.Table.from_batches([_rows([])])
    docs = _unpacked(body[_TEXTS])
    data, offs = _text(docs, text)
    later = np.frombuffer(body[_LATER], np.int64).reshape(-1, 2)
    ids = docs.column(doc_id).cast(pa.int64()).fill_null(np.iinfo(np.int64).max).to_numpy()
    hashes, starts, stops = segments(data, offs, width, anchor)
    gone = _covered(len(data) + 1, later[:, 0], later[:, 1])
    rows = []
    for hot in (0, 1):
        pick = np.isin(hashes, wanted[hot])
        if not pick.any():
            continue
        # runs of strings that stay in the shard, within one anchor's run
        live = _covered(len(data) + 1, starts[pick], stops[pick]) & ~gone
        edge = np.zeros(len(data) + 2, bool)
        edge[starts[pick]] = True
        first = np.flatnonzero(live & (edge[:-1] | ~np.concatenate([[False], live[:-1]])))
        if not len(first):
            continue
        owner = np.searchsorted(starts[pick], first, "right") - 1
        bound = np.minimum(stops[pick][owner], np.append(first[1:], len(data)))
        begun, ended = _runs(live)
        last = np.minimum(bound, ended[np.searchsorted(begun, first, "right") - 1])
        key = hashes[pick][owner]
        if hot:
            first = np.concatenate([np.arange(a, b) for a, b in zip(first, last, strict=True)])
            both = _digests(data, first, width)
            key, span = both[:, 0], 16
            bodies = both.tobytes()
            cuts = np.arange(len(first) + 1) * 16
        else:
            span = width
            length = last - first + width - 1
            cuts = np.concatenate([[0], np.cumsum(length)])
            view = memoryview(data)
            bodies = b"".join(view[a : a + n] for a, n in zip(first.tolist(), length.tolist(), strict=True))
        doc = np.searchsorted(offs, first, "right") - 1
        where = (key % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(where, kind="stable")
        where, view = where[order], memoryview(bodies)
        edges = np.flatnonzero(np.append(True, where[1:] != where[:-1])).tolist() + [len(order)]
        for a, b in zip(edges, edges[1:], strict=False):
            k = order[a:b]
            body = b"".join(view[x:y] for x, y in zip(cuts[k].tolist(), cuts[k + 1].tolist(), strict=True))
            rows.append((shard, span, int(where[a]), _squeezed(ids[doc[k]], doc[k], first[k], cuts[k + 1] - cuts[k], body)))
    return pa.Table.from_batches([_rows(rows)])


def _first_places(x: np.ndarray) -> np.ndarray:
    """Of each entry the place of the first one that equals it: by binary search in the sorted table of those that recur."""
    first = np.arange(len(x))
    order = np.argsort(x)
    ranked = x[order]
    head = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])[: len(x)])
    recurs = np.diff(np.append(head, len(x))) > 1
    if not recurs.any():
        return first
    table, least = ranked[head[recurs]], np.minimum.reduceat(order, head)[recurs]
    del ranked
    for lo in range(0, len(x), _SCAN):
        part = x[lo : lo + _SCAN]
        k = np.minimum(np.searchsorted(table, part), len(table) - 1)
        hit = np.flatnonzero(table[k] == part)
        first[lo + hit] = least[k[hit]]
    return first


def _merged(table: pa.Table) -> pa.Table:
    """Of one bucket: to each shard the runs of its strings that an earlier document of another has."""
    shards, width = np.array(_column(table, "shard")), _column(table, "kind")[0]
    own = [_opened(b) for b in _column(table, "body")]
    shard = np.repeat(shards, [len(x[0]) for x in own])
    doc, row, pos, length = (np.concatenate([x[k] for x in own]) for k in range(4))
    whole = b"".join(x[4] for x in own)
    del own
    begin = np.cumsum(length) - length
    order = np.lexsort((pos, row, shard, doc))
    shard, pos, begin, length = shard[order], pos[order], begin[order], length[order]
    view = memoryview(whole)
    data = np.frombuffer(b"".join(view[a : a + n] for a, n in zip(begin.tolist(), length.tolist(), strict=True)), np.uint8)
    cuts = np.concatenate([[0], np.cumsum(length)])
    del whole, view
    # every string of the bucket, by document and place
    count = np.diff(cuts) - width + 1 if width > 16 else np.ones(len(pos), np.int64)
    run = np.repeat(np.arange(len(pos)), count)
    shift = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
    at = cuts[run] + shift
    hashes = np.empty(len(at), np.uint64)
    for lo, hi in row_chunks(cuts, _SCAN):
        a, b = np.searchsorted(at, (cuts[lo], cuts[hi]))
        hashes[a:b] = Hasher(data[cuts[lo] : cuts[hi]]).windows(width)[at[a:b] - cuts[lo]]
    first = _first_places(hashes)
    repeated = np.flatnonzero(first != np.arange(len(at)))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    word = np.ndarray((len(data),), "<u8", padded.data, strides=(1,))
    differ = np.zeros(len(repeated), bool)
    for t in [*range(0, width - 7, 8), width - 8]:
        differ |= word[at[repeated] + t] != word[at[first[repeated]] + t]
    later = np.zeros(len(at), bool)
    later[repeated] = True
    if differ.any():  # strings of equal hashes: by their bytes
        odd, seen = np.isin(hashes, hashes[repeated[differ]]), set()
        for i in np.flatnonzero(odd):
            s = data[at[i] : at[i] + width].tobytes()
            later[i] = s in seen
            seen.add(s)
    lo, hi = _runs(later)
    if not len(lo):
        return pa.Table.from_batches([_rows([])])
    # runs end where a segment does
    inner = np.unique(np.concatenate([lo, np.flatnonzero((shift == 0) & later)]))
    stop = np.append(inner[1:], len(at))
    stop = np.minimum(stop, hi[np.searchsorted(lo, inner, "right") - 1])
    begin = pos[run[inner]] + shift[inner]
    out, spans = shard[run[inner]], np.stack([begin, begin + stop - inner], axis=1)
    order = np.argsort(out, kind="stable")
    out, spans = out[order], spans[order]
    edges = np.flatnonzero(np.append(True, out[1:] != out[:-1])).tolist() + [len(out)]
    return pa.Table.from_batches([_rows([(int(out[a]), _LATER, -1, spans[a:b].tobytes()) for a, b in zip(edges, edges[1:], strict=False)])])


def _results(table: pa.Table, text: str, names: list[str], width: int) -> pa.Table:
    kinds, bodies = _column(table, "kind"), _column(table, "body")
    docs = _unpacked(bodies[kinds.index(_TEXTS)])
    data, offs = _text(docs, text)
    later = np.concatenate([np.frombuffer(b, np.int64) for k, b in zip(kinds, bodies, strict=True) if k == _LATER]).reshape(-1, 2)
    removed = _covered(len(data), later[:, 0], later[:, 1] + width - 1)
    body, cols = data.tobytes(), ([], [], [], [], [])
    gone = _running(removed)
    for lo, hi in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
        n = int(gone[hi] - gone[lo])
        kept, spans = body[lo:hi], 0
        if n:
            kept = data[lo:hi][~removed[lo:hi]].tobytes()
            spans = len(_runs(removed[lo:hi])[0])
        for col, x in zip(cols, (hi - lo, n, spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")), strict=True):
            col.append(x)
    for c, name, kind in zip(cols, names, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True):
        docs = docs.append_column(name, pa.array(c, kind))
    return docs


_NEW = [StructField("n_bytes", LongType()), StructField("n_removed", LongType()), StructField("n_spans", LongType()), StructField("kept_sha256", StringType()), StructField("kept_text", StringType())]


def deduplicate(spark: SparkSession, docs: DataFrame, width: int = WIDTH, anchor: int = ANCHOR, shard_bytes: int = SHARD_BYTES, hot: int = HOT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes, n_removed, n_spans, kept_sha256, kept_text``.

    Each byte is removed that lies in a string of ``width`` bytes which also starts earlier: in a
    smaller id, or before in the same document. Strings never cross documents and are judged on
    the input. ``kept_text`` leaves out the halves of characters that a cut has split; the digest
    is of all remaining bytes.

    Null, empty and short texts lose nothing. Null ids come after all others; rows with one id
    come after one another in some order, of repeated rows one stays whole. Columns of these
    names are replaced, others stay. An empty table gives an empty result.

    Shuffled are the shards' compressed texts (twice), a hash for each anchor, and the strings
    around anchors that shards share. A shard holds ``shard_bytes`` or one text; the numbers of
    buckets follow from the number of anchors that the shards have written, so a bucket stays of
    one size as the input grows. A string that is in a third of all documents is in a bucket once
    for each shard; an anchor with more than ``hot`` places, in different strings, is spread over
    the buckets of those strings.
    """
    stage = Staging(spark, "suffix")
    new = {f.name.lower() for f in _NEW}
    base = docs.select(*[c for c in docs.columns if c.lower() not in new])
    first = stage.write(base.mapInArrow(lambda it: releasing(_sharded(it, doc_id, text, width, anchor, shard_bytes)), _ROWS), "shards")
    whole, anchors = first.where(F.col("kind") != _ANCHORS), first.where(F.col("kind") == _ANCHORS)
    n = anchors.agg(F.sum(F.col("bucket").cast("long"))).first()[0] or 0
    few, many = (max(1, -(-n * size // most)) for size, most in ((8, ANCHOR_BUCKET_BYTES), (_STRINGS_OF_ANCHOR, STRING_BUCKET_BYTES)))
    common = anchors.mapInArrow(lambda it: _split(it, few), _ROWS).groupBy("bucket").applyInArrow(released(lambda t: _common_anchors(t, hot)), _ROWS)
    sent = whole.unionByName(common).groupBy("shard").applyInArrow(released(lambda t: _sent(t, doc_id, text, width, anchor, many)), _ROWS)
    later = sent.groupBy("bucket", "kind").applyInArrow(released(_merged), _ROWS)
    schema = StructType(list(base.schema.fields) + _NEW)
    return whole.unionByName(later).groupBy("shard").applyInArrow(released(lambda t: _results(t, text, [f.name for f in _NEW], width)), schema)
