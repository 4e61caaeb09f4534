"""Repair of conversations: the cheapest edits that make roles alternate, found by a min-plus scan.

The roles that may follow one another are an automaton of four states (nothing yet, after system,
after user, after assistant). A turn is a 4x4 matrix: at (i, j) the cheapest edits, and their audit, that lead from
state i to state j, turns inserted before it included. Matrices multiply over (sum, concatenation)
with the least (cost, audit) kept. An audit that begins another of the same turns is cheaper than it, so
equal costs are decided by a letter in which two audits differ, whatever follows: the product is associative, and a tree
of products finds what a scan from left to right would.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrow import releasing
from .staging import Staging

START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = "sua"
#: Faults in the low two bits of a turn's code, its role's initial (system, user, assistant, other) above.
FINE, TRUNCATED, DUPLICATE, BLANK = range(4)
DELETE, INSERT, REROLE, LOOSE_END = 3, 2, 2, 1
#: Characters of a text that decide between range partitions; within one, whole texts do.
PREFIX = 256
#: Matrices that are kept, of so many turns at most.
BLOCK = 8
#: Pieces of a conversation that are multiplied at once.
FAN = 64

Element = tuple[int, str] | None
Matrix = tuple[Element, ...]

_STEPS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}


def _least(a: Element, b: Element) -> Element:
    if a is None or b is None:
        return a or b
    return min(a, b)


def times(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus product; audits are joined only where the cost can win."""
    out: list[Element] = []
    for i in (0, 4, 8, 12):
        for j in range(4):
            best: Element = None
            for k in range(4):
                x, y = a[i + k], b[4 * k + j]
                if x is None or y is None:
                    continue
                cost = x[0] + y[0]
                if best is None or cost < best[0]:
                    best = (cost, x[1] + y[1])
                elif cost == best[0]:
                    best = min(best, (cost, x[1] + y[1]))
            out.append(best)
    return tuple(out)


def _matrix(cells: dict[tuple[int, int], Element]) -> Matrix:
    return tuple(cells.get((i, j)) for i in range(4) for j in range(4))


def _insertions() -> Matrix:
    """Empty turns of user or assistant, as many as make sense: from each state the cheapest way to each other."""
    one: dict[tuple[int, int], Element] = {(i, i): (0, "") for i in range(4)}
    one |= {(i, j): (INSERT, "I") for role in "ua" for i, j in _STEPS[role].items()}
    return reduce(times, [_matrix(one)] * 4)


CLOSURE = _insertions()


def _turn(code: int) -> Matrix:
    fault, initial = code & 3, code >> 2
    cells: dict[tuple[int, int], Element] = {(i, i): (DELETE, "D") for i in range(4)}
    if fault in (FINE, TRUNCATED):
        extra = LOOSE_END if fault == TRUNCATED else 0
        for role in "ua":
            for at in _STEPS[role].items():
                cells[at] = (REROLE + extra, "R")
        if initial < 3:
            for at in _STEPS[INITIALS[initial]].items():
                cells[at] = _least(cells.get(at), (extra, "K"))
    return times(CLOSURE, _matrix(cells))


TURNS = tuple(_turn(code) for code in range(16))
NOTHING = _matrix({(i, i): (0, "") for i in range(4)})


@lru_cache(maxsize=1 << 14)
def _block(codes: bytes) -> Matrix:
    if len(codes) == 1:
        return TURNS[codes[0]]
    half = (len(codes) + 1) // 2
    return times(_block(codes[:half]), _block(codes[half:]))


def product(codes: bytes) -> Matrix:
    """The matrix of a run of turns, by a tree of products."""
    if not codes:
        return NOTHING
    level = [_block(codes[k : k + BLOCK]) for k in range(0, len(codes), BLOCK)]
    while len(level) > 1:
        level = [times(*level[k : k + 2]) if k + 1 < len(level) else level[k] for k in range(0, len(level), 2)]
    return level[0]


def answer(m: Matrix) -> tuple[int, str]:
    """Cost and audit from nothing to an end: no turn, or one of the assistant's."""
    closed = times(m, CLOSURE)
    return _least(closed[START], closed[ASSISTANT])  # type: ignore[return-value]


def edited(letters: str, before: int, system: bool, roles: list[str], texts: list[str], copies: Iterable[int]) -> tuple[list[str], list[str]]:
    """Roles and texts that the letters leave of turns; ``before``: turns left before these, ``system``: whether the first of all is the system's.

    Of a turn that stands there several times only the first can stay.
    """
    out_roles, out_texts, at, row, rest = [], [], before, -1, 0
    counts = iter(copies)
    for letter in letters:
        first = False
        if letter != "I":
            if not rest:
                row, rest, first = row + 1, next(counts), True
                while not rest:
                    row, rest = row + 1, next(counts)
            rest -= 1
        if letter == "D":
            continue
        assert letter == "I" or first
        role = "user" if (at - system) % 2 == 0 else "assistant"
        out_roles.append(roles[row] if letter == "K" else role)
        out_texts.append("" if letter == "I" else texts[row])
        at += 1
    return out_roles, out_texts


def _left(letters: str) -> int:
    return len(letters) - letters.count("D")


def _lines(roles: list[str], texts: list[str]) -> bytes:
    return "\n".join([f"{r}:{t}" for r, t in zip(roles, texts, strict=True)]).encode()


#: What is known of a run of turns and can be put together from its parts.
_KNOWN = ("n", "first", "last", "low", "high", "turns", "blank", "duplicate", "truncated", "illegal")
_SUMMARY = ", ".join(f"{c} long" for c in _KNOWN) + ", costs array<long>, audits array<string>"
_SUMMARY_TYPES = [pa.int64()] * len(_KNOWN) + [pa.list_(pa.int64()), pa.list_(pa.string())]
_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_RESULT_NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


@dataclass
class Run:
    """Turns in order: their number, first and last initial, least and largest turn, distinct turns, faults, and the matrix."""

    n: int
    first: int
    last: int
    low: int | None
    high: int | None
    turns: int
    blank: int
    duplicate: int
    truncated: int
    illegal: int
    matrix: Matrix

    def then(self, other: Run) -> Run:
        if not self.n or not other.n:
            return other if not self.n else self
        same = self.turns > 0 and other.turns > 0 and self.high == other.low
        return Run(
            self.n + other.n,
            self.first,
            other.last,
            self.low if self.turns else other.low,
            other.high if other.turns else self.high,
            self.turns + other.turns - same,
            self.blank + other.blank,
            self.duplicate + other.duplicate,
            self.truncated + other.truncated,
            self.illegal + other.illegal + (not _legal(self.last, other.first)),
            times(self.matrix, other.matrix),
        )

    def row(self) -> list:
        return [getattr(self, c) for c in _KNOWN] + [[-1 if e is None else e[0] for e in self.matrix], ["" if e is None else e[1] for e in self.matrix]]

    @staticmethod
    def of(row: dict) -> Run:
        return Run(*[row[c] for c in _KNOWN], tuple(None if c < 0 else (c, a) for c, a in zip(row["costs"], row["audits"], strict=True)))

    def result(self) -> list:
        return [self.high - self.low + 1 - self.turns if self.turns else 0, self.blank, self.duplicate, self.truncated, self.illegal, *answer(self.matrix)]


def _legal(a, b):
    """Whether a turn of initial ``b`` may follow one of ``a``; numbers or arrays."""
    return ((a == 0) & (b == 1)) | ((a == 1) & (b == 2)) | ((a == 2) & (b == 1))


class _Pieces:
    """The conversations of one batch of sorted rows, each as a run."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        conv = batch.column("conv_id")
        null, ids = np.asarray(conv.is_null()), np.asarray(conv.fill_null(0))
        new = np.ones(len(ids), bool)
        new[1:] = (ids[1:] != ids[:-1]) | (null[1:] != null[:-1])
        self.start = np.append(np.flatnonzero(new), len(ids))
        self.conv = [None if null[k] else int(ids[k]) for k in self.start[:-1]]
        self.roles, self.texts = batch.column("role").to_pylist(), batch.column("text").to_pylist()
        self.copies = np.asarray(batch.column("copies"))
        count, segment = len(self.conv), np.cumsum(new) - 1
        alive = np.flatnonzero(self.copies > 0)
        seg, code, copies = segment[alive], np.asarray(batch.column("code"))[alive].astype(np.uint8), self.copies[alive]
        initial, fault = code >> 2, code & 3

        def total(x: np.ndarray, of: np.ndarray = seg) -> np.ndarray:
            out = np.zeros(count, np.int64)
            np.add.at(out, of, x)
            return out

        again = np.where(fault == BLANK, BLANK, DUPLICATE).astype(np.uint8) | (code & 12)
        ends = np.cumsum(copies)
        expanded = np.repeat(again, copies)
        expanded[ends - copies] = code
        self.codes, self.bounds = expanded.tobytes(), np.concatenate([[0], np.cumsum(total(copies))])
        illegal = copies - 1
        if len(alive) > 1:
            illegal[1:] += (seg[1:] == seg[:-1]) & ~_legal(initial[:-1], initial[1:])
        turn = batch.column("turn").take(pa.array(alive))
        known = np.flatnonzero(~np.asarray(turn.is_null()))
        value, of = np.asarray(turn.fill_null(0))[known], seg[known]
        fresh = np.ones(len(known), np.int64)
        fresh[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
        self.n, self.turns = total(copies), total(fresh, of)
        self.blank = total(np.where(fault == BLANK, copies, 0))
        self.duplicate = total(np.where(fault == BLANK, 0, np.where(fault == DUPLICATE, copies, copies - 1)))
        self.truncated, self.illegal = total((fault == TRUNCATED).astype(np.int64)), total(illegal)
        self._initial, self._value = initial, value
        each = np.arange(count)
        self._alive = np.searchsorted(seg, each), np.searchsorted(seg, each, "right")
        self._known = np.searchsorted(of, each), np.searchsorted(of, each, "right")

    def __len__(self) -> int:
        return len(self.conv)

    def turns_of(self, k: int) -> tuple[list[str], list[str], list[int]]:
        rows = slice(self.start[k], self.start[k + 1])
        return self.roles[rows], self.texts[rows], self.copies[rows].tolist()

    def run(self, k: int) -> Run:
        (a, b), (c, d) = ((x[k], y[k]) for x, y in (self._alive, self._known))
        ends = (int(self._initial[a]), int(self._initial[b - 1])) if b > a else (3, 3)
        span = (int(self._value[c]), int(self._value[d - 1])) if d > c else (None, None)
        counts = (int(x[k]) for x in (self.turns, self.blank, self.duplicate, self.truncated, self.illegal))
        return Run(int(self.n[k]), *ends, *span, *counts, product(self.codes[self.bounds[k] : self.bounds[k + 1]]))


_PIECES = f"conv_id long, part int, seq int, closed boolean, {_SUMMARY}, gaps long, cost long, audit string, repaired_sha256 string, roles array<string>, texts array<string>, copies array<long>"
_PIECES_NAMES = [f.strip().split(" ")[0] for f in _PIECES.split(",")]
_PIECES_TYPES = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), *_SUMMARY_TYPES, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.int64())]


def _batch(rows: list[list], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)


def _first_pass(batches: Iterable[pa.RecordBatch], keep_texts: bool) -> Iterator[pa.RecordBatch]:
    """Conversations that lie within a batch are repaired; of one that may go on in another, the run and its turns are handed on."""
    part = TaskContext.get().partitionId()
    for number, batch in enumerate(batches):
        if not batch.num_rows:
            continue
        pieces, out = _Pieces(batch), []
        for k in range(len(pieces)):
            run, (roles, texts, copies) = pieces.run(k), pieces.turns_of(k)
            if k in (0, len(pieces) - 1):
                out.append([pieces.conv[k], part, 2 * number + (k > 0), False, *run.row(), None, None, None, None, roles, texts, copies])
                continue
            gaps, blank, duplicate, truncated, illegal, cost, audit = run.result()
            known = [run.n, None, None, None, None, None, blank, duplicate, truncated, illegal, None, None]
            left = edited(audit, 0, _left(audit) % 2 == 1, roles, texts, copies)
            out.append([pieces.conv[k], part, 2 * number + 1, True, *known, gaps, cost, audit, hashlib.sha256(_lines(*left)).hexdigest(), *(left if keep_texts else (None, None)), None])
        yield _batch(out, _PIECES_TYPES, _PIECES_NAMES)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {c: batch.column(c)[k].as_py() for c in batch.schema.names}


def _multiplied(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring runs of one conversation and one place in the next level of the tree become one run."""
    names, kinds = ["conv_id", "at", *_KNOWN, "costs", "audits"], [pa.int64(), pa.int64(), *_SUMMARY_TYPES]

    def flushed(key: tuple, runs: list[Run]) -> pa.RecordBatch:
        while len(runs) > 1:
            runs = [runs[k].then(runs[k + 1]) if k + 1 < len(runs) else runs[k] for k in range(0, len(runs), 2)]
        return _batch([[*key, *runs[0].row()]], kinds, names)

    key, runs = None, []
    for row in _rows(batches):
        if (now := (row["conv_id"], row["at"] // FAN)) != key:
            if runs:
                yield flushed(key, runs)
            key, runs = now, []
        runs.append(Run.of(row))
    if runs:
        yield flushed(key, runs)


def _answers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), *[pa.int64()] * 6, pa.string()]
    for row in _rows(batches):
        yield _batch([[row["conv_id"], *Run.of(row).result()]], kinds, ["conv_id", *_RESULT_NAMES])


def _letters(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a conversation: its audit, then its pieces in order. Each piece gets the letters of its turns and of what is
    inserted before them, the last one what is inserted at the end too."""
    kinds, names = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.bool_()], ["part", "seq", "letters", "before", "system"]
    audit, at, before, system = "", 0, 0, False
    for row in _rows(batches):
        if row["at"] < 0:
            audit, at, before, system = row["audit"], 0, 0, _left(row["audit"]) % 2 == 1
            continue
        end, turns = at, row["n"]
        if row["final"]:
            end = len(audit)
        else:
            while turns:  # as many characters as turns are missing hold at most so many turns
                step = audit[end : end + turns]
                end, turns = end + len(step), turns - (len(step) - step.count("I"))
        letters, at = audit[at:end], end
        yield _batch([[row["part"], row["seq"], letters, before, system]], kinds, names)
        before += _left(letters)


def _apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds, names = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.binary()], ["conv_id", "at", "before", "roles", "texts", "lines"]
    for row in _rows(batches):
        roles, texts = edited(row["letters"], row["before"], row["system"], row["roles"], row["texts"], row["copies"])
        yield _batch([[row["conv_id"], row["at"], row["before"], roles, texts, _lines(roles, texts) if roles else None]], kinds, names)


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a conversation: its result, then its repaired lines in order, hashed as they come."""
    kinds, names = [pa.int64()] * 7 + [pa.string()] * 2, ["conv_id", *_RESULT_NAMES, "repaired_sha256"]
    result, digest, begun = None, hashlib.sha256(), False
    for row in _rows(batches):
        if row["at"] < 0:
            if result is not None:
                yield _batch([[*result, digest.hexdigest()]], kinds, names)
            result, digest, begun = [row["conv_id"], *[row[c] for c in _RESULT_NAMES]], hashlib.sha256(), False
        elif row["lines"] is not None:
            digest.update(b"\n" + row["lines"] if begun else row["lines"])
            begun = True
    if result is not None:
        yield _batch([[*result, digest.hexdigest()]], kinds, names)


@dataclass
class Repair:
    """``conversations``: faults, cost, audit and digest, one row for each conversation; ``turns``: the repaired turns, if asked for."""

    conversations: DataFrame
    turns: DataFrame | None


def _code(role: Column, text: Column, duplicate: Column) -> Column:
    initial = F.substring(role, 1, 1)
    place = F.when(initial == "s", 0).when(initial == "u", 4).when(initial == "a", 8).otherwise(12)
    fault = F.when(is_blank(text), BLANK).when(duplicate, DUPLICATE).when(~text.rlike("[.!?][\\x20\\x09-\\x0D]*\\z"), TRUNCATED).otherwise(FINE)
    return (place + fault).cast("byte")


def is_blank(text: Column) -> Column:
    return ~text.rlike("[^\\x20\\x09-\\x0D]")


def repair(spark: SparkSession, conversations: DataFrame, copies: str | None = None, keep_texts: bool = False, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repair:
    """Faults of all conversations and the cheapest edits that mend them.

    A conversation's rows stand in the order of turn (nulls first), role and text. Blank rows and rows
    whose role and text stood earlier must go (3 each), any other may be kept, given the role user or assistant (2) or deleted (3); a row that
    stays without an end mark costs 1; empty turns of user or assistant may be inserted (2). What is
    left must be nothing, or an optional system turn and pairs of user and assistant; roles go by their initials. ``audit`` has the
    letters of the cheapest edits, D I K R, of equal ones the least string. ``turns`` (with ``keep_texts``):
    ``conv_id, position, role, text``.

    ``copies`` names a column of how often a row stands in its place; with 0 it does not, but its
    conversation is reported, with zeros and an empty audit where no row is left. Null roles and texts count as one space, a
    null conversation is one like others; a role without an initial is no one's. An empty table gives an empty result; other
    columns are ignored.

    Equal rows are counted before they are moved, so copies are one row. A conversation is not gathered: rows are sorted over the cluster, each batch
    multiplies its turns, and the batches' matrices are multiplied in a tree. Repaired lines are made where the turns
    are; only their digest, which has no parts that could be joined, goes through one task for each
    conversation that spans batches, piece by piece. Rows of one conversation that agree in turn, role and the first
    256 characters are in one task.
    """
    stage = Staging(spark, "conversations")
    count = F.lit(1) if copies is None else F.col(copies)
    space = F.lit(" ")
    rows = conversations.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), space).alias("role"), F.coalesce(F.col(text), space).alias("text"), count.cast("long").alias("copies"))
    # written, as both what follows and the sampling of ranges read it again
    groups = stage.write(rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")), "groups")

    # texts of one role at several turns are few: only they meet their rows
    seen, digest = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn")), F.unhex(F.sha2("text", 256))
    again = groups.where((F.col("copies") > 0) & ~is_blank(F.col("text"))).groupBy("conv_id", "role", digest.alias("digest")).agg(F.min(seen).alias("earliest"), F.count("*").alias("n")).where("n > 1")
    # written, so that a small table is known to be one before texts are shuffled to meet it
    again = stage.write(again.select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), "digest", "earliest"), "again")
    met = groups.join(again, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (digest == F.col("digest")), "left")
    marked = met.select("conv_id", "turn", "role", "text", "copies", _code(F.col("role"), F.col("text"), F.coalesce(seen > F.col("earliest"), F.lit(False))).alias("code"))

    place = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc()]
    ordered = marked.repartitionByRange(*place, F.substring("text", 1, PREFIX).asc()).sortWithinPartitions(*place, F.col("text").asc())
    pieces = stage.write(ordered.mapInArrow(lambda it: releasing(_first_pass(it, keep_texts)), _PIECES), "pieces")

    stage.drop("groups", "again")

    whole, parts = pieces.where("closed"), pieces.where("NOT closed")
    width, last = parts.agg(F.coalesce(F.max("seq"), F.lit(0)), F.coalesce(F.max("part"), F.lit(0))).first()
    width += 1
    parts = parts.withColumn("at", F.col("part").cast("long") * width + F.col("seq"))
    level, span = parts.select("conv_id", "at", *_KNOWN, "costs", "audits"), (last + 1) * width
    while True:
        dealt = level.repartition(F.col("conv_id"), F.floor(F.col("at") / FAN)).sortWithinPartitions("conv_id", "at")
        level, span = dealt.mapInArrow(_multiplied, f"conv_id long, at long, {_SUMMARY}"), -(-span // FAN)
        if span == 1:
            break
    answers = stage.write(level.mapInArrow(_answers, f"conv_id long, {_RESULT}"), "answers")

    light = parts.select("conv_id", "at", "part", "seq", "n")
    final = light.groupBy("conv_id").agg(F.max("at").alias("_last")).withColumnRenamed("conv_id", "_conv")
    light = light.join(final, F.col("conv_id").eqNullSafe(F.col("_conv"))).select("conv_id", "at", "part", "seq", "n", (F.col("at") == F.col("_last")).alias("final"), F.lit(None).cast("string").alias("audit"))
    none = F.lit(None)
    heads = answers.select("conv_id", F.lit(-1).cast("long").alias("at"), none.cast("int").alias("part"), none.cast("int").alias("seq"), none.cast("long").alias("n"), none.cast("boolean").alias("final"), "audit")
    letters = heads.unionByName(light).repartition("conv_id").sortWithinPartitions("conv_id", "at").mapInArrow(_letters, "part int, seq int, letters string, before long, system boolean")
    mended = parts.select("conv_id", "at", "part", "seq", "roles", "texts", "copies").join(letters, ["part", "seq"]).mapInArrow(_apply, "conv_id long, at long, before long, roles array<string>, texts array<string>, lines binary")
    if keep_texts:
        mended = stage.write(mended, "mended")
    lines = mended.select("conv_id", "at", "lines", *[none.cast("string" if c == "audit" else "long").alias(c) for c in _RESULT_NAMES])
    heads = answers.select("conv_id", F.lit(-1).cast("long").alias("at"), none.cast("binary").alias("lines"), *_RESULT_NAMES)
    digests = heads.unionByName(lines).repartition("conv_id").sortWithinPartitions("conv_id", "at").mapInArrow(_digests, f"conv_id long, {_RESULT}, repaired_sha256 string")
    result = whole.select("conv_id", *_RESULT_NAMES, "repaired_sha256").unionByName(digests)
    if not keep_texts:
        return Repair(result, None)
    both = whole.select("conv_id", F.lit(0).cast("long").alias("before"), "roles", "texts").unionByName(mended.select("conv_id", "before", "roles", "texts"))
    turns = both.select("conv_id", "before", F.posexplode(F.arrays_zip("roles", "texts")).alias("k", "turn"))
    return Repair(result, turns.select("conv_id", (F.col("before") + F.col("k")).alias("position"), F.col("turn.roles").alias("role"), F.col("turn.texts").alias("text")))
