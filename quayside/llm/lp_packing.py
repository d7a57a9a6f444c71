"""Packing documents into sequences by a configuration linear program.

A document's ids (with the end id) are one piece; a longer one is cut so that
all pieces but the first fill a sequence. What is packed is then a histogram of
at most ``CAPACITY`` lengths, whatever the number of documents. The linear
program has a variable per *pattern*, a multiset of lengths that fits in a
sequence: as few sequences as give every length its pieces.

It is solved by multiplicative weights: a length's weight falls with the share
of its pieces already served, a knapsack dynamic program prices the patterns
under these weights, and good ones are used as often as a small step of their
scarcest length allows. The fractional uses are rounded down; the pieces left
over make the next, smaller program. When rounding leaves more than half, or few
pieces were left, the rest (at most a few for each pattern) is packed best fit,
longest first. So the driver's work depends on the number of lengths and on the
log of the number of pieces.

The plan gives each length an ordered list of places. A piece's rank among its
length picks its place: tasks number their own pieces, the written counts per
task and length are added up, and no task sees all pieces of a length.

Edge cases: a null text is empty, so it is its end id alone; rows with a null or
repeated doc_id are documents of their own; an empty table gives no rows. Very
long texts are cut into as many pieces as they need. Only the two named columns
are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import map_arrow, python_batches, slices, stored
from quayside.llm.pretokens import TOKENIZER, latin_codec

CAPACITY = 1024
END_ID = 2
ROUNDS = 400              # knapsacks of a linear program
STEP = 0.03               # share of a length that a round serves
SCALE = 0.2               # lead in that share which lowers a length's weight by e
SLACK = 0.01              # how far from the best of a round its patterns may be
FEW, MANY = 3_000, 50_000  # pieces packed best fit: after a program, at most


@dataclass(frozen=True)
class Plan:
    """``lengths[p]`` (falling) repeated ``times[p]``: the sequences in order."""
    lengths: list[tuple[int, ...]]
    times: list[int]

    @property
    def sequences(self) -> int:
        return sum(self.times)


def knapsack(sizes: np.ndarray, weights: np.ndarray, capacity: int) -> tuple[np.ndarray, list[int]]:
    """(most weight that fits in each space, the piece taken there or 0).

    ``sizes`` rise; a size may be taken any number of times.
    """
    value, taken = np.zeros(capacity + 1), [0] * (capacity + 1)
    known = np.searchsorted(sizes, np.arange(capacity + 1), side="right").tolist()
    for space in range(1, capacity + 1):
        value[space] = value[space - 1]
        k = known[space]
        if k:
            gain = weights[:k] + value[space - sizes[:k]]
            best = int(gain.argmax())
            if gain[best] > value[space]:
                value[space], taken[space] = gain[best], int(sizes[best])
    return value, taken


def configuration_lp(counts: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS) -> dict[tuple[int, ...], float]:
    """Patterns (falling lengths) and their uses, not whole, that overdraw no
    length.

    A length's weight is its size, less exponentially in the share of its
    pieces already served. One knapsack a round prices all patterns; for every
    length, those lagging most first, the best pattern that holds it is used if
    it is within ``SLACK`` of the best of all. A round serves at most a ``STEP``
    of each length, so that weights stay close to what was priced.
    """
    wanted = counts.astype(float)
    served = np.zeros(len(counts))
    uses: dict[tuple[int, ...], float] = {}
    for _ in range(rounds):
        open_ = np.flatnonzero(wanted - served > 1e-6)
        if not len(open_):
            break
        share = served[open_] / wanted[open_]
        weights = open_ * np.exp((share.min() - share) / SCALE)
        value, taken = knapsack(open_, weights, capacity)
        least = (1 - SLACK) * value[capacity]
        allow = np.minimum(STEP * wanted, wanted - served).tolist()
        lag = np.argsort(share, kind="stable")
        for size, weight in zip(open_[lag].tolist(), weights[lag].tolist(), strict=True):
            space = capacity - size
            if weight + value[space] < least or allow[size] <= 0:
                continue
            pattern = [size]
            while space:
                if taken[space]:
                    pattern.append(taken[space])
                    space -= taken[space]
                else:
                    space -= 1
            amount = min(allow[one] / pattern.count(one) for one in set(pattern))
            if amount <= 0:
                continue
            for one in pattern:
                allow[one] -= amount
                served[one] += amount
            key = tuple(sorted(pattern, reverse=True))
            uses[key] = uses.get(key, 0.0) + amount
    return uses


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[int, ...]]:
    """Few pieces, longest first, each into the fullest sequence that has room."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins: list[list[int]] = []
    open_rooms = np.zeros(capacity + 1, bool)
    for size in np.flatnonzero(counts)[::-1].tolist():
        for _ in range(int(counts[size])):
            at = size + int(open_rooms[size:].argmax())
            if open_rooms[at]:
                one = room[at].pop()
                open_rooms[at] = bool(room[at])
            else:
                one, at = len(bins), capacity
                bins.append([])
            bins[one].append(size)
            room[at - size].append(one)
            open_rooms[at - size] = True
    return [tuple(b) for b in bins]


def planned(counts: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """Patterns and how often each is used; they use every piece exactly once.

    ``counts[l]``: number of pieces of length l (l from 0 to ``capacity``).
    """
    left = counts.astype(np.int64).copy()
    used: dict[tuple[int, ...], int] = {}

    def add(lengths: tuple[int, ...], times: int) -> None:
        used[lengths] = used.get(lengths, 0) + times

    if left[capacity]:
        add((capacity,), int(left[capacity]))
        left[capacity] = 0
    while left.any():
        before = int(left.sum())
        uses = configuration_lp(left, capacity)
        least = 1 if before > MANY else 0           # so that every program packs some
        for lengths, amount in uses.items():
            # Rounding errors in the sums of uses must not overdraw a length.
            times = min(max(int(amount + 1e-6), least),
                        *(int(left[one]) // lengths.count(one) for one in set(lengths)))
            if times:
                add(lengths, times)
                for one in lengths:
                    left[one] -= times
        after = int(left.sum())
        if before <= FEW or after <= MANY and 2 * after > before:
            break                                   # mostly fractions of patterns are left
    for lengths in best_fit(left, capacity):
        add(lengths, 1)
    return Plan(list(used), list(used.values()))


class Places:
    """Where the r-th piece of a length goes under a plan."""

    def __init__(self, plan: Plan, capacity: int = CAPACITY):
        found: dict[int, list] = {}
        first = 0
        for lengths, times in zip(plan.lengths, plan.times, strict=True):
            offset = 0
            for size in sorted(set(lengths), reverse=True):
                copies = lengths.count(size)
                found.setdefault(size, []).append((copies * times, copies, first, offset))
                offset += copies * size
            first += times
        # Per length: rank of the first piece, copies in a sequence, first
        # sequence and offset of each pattern that has the length.
        self.of = {}
        for size, rows in found.items():
            total, copies, first, offset = np.array(rows, np.int64).T
            self.of[size] = (np.cumsum(total) - total, copies, first, offset)

    def find(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the pieces."""
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for size in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == size)
            begin, copies, first, base = self.of[size]
            k = np.searchsorted(begin, ranks[at], side="right") - 1
            inside = ranks[at] - begin[k]
            sequence[at] = first[k] + inside // copies[k]
            offset[at] = base[k] + inside % copies[k] * size
        return sequence, offset


def pieces(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece, with the task that
    cut it and its number among the task's pieces of that length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for a, b in slices(batch.column(1)):
                texts = batch.column(1).slice(a, b - a).to_pylist()
                flat, count = latin_codec(tokenizer, added=True).encode(texts)
                ids = np.insert(flat, np.cumsum(count), END_ID).astype("<u4")
                size = count + 1
                n = -(-size // capacity)
                doc = np.repeat(np.arange(len(size)), n)
                number = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                head = size - (n - 1) * capacity
                length = np.where(number == 0, head[doc], capacity)
                start = np.where(number == 0, 0, head[doc] + (number - 1) * capacity)
                ends = np.cumsum(length).tolist()
                raw = ids.tobytes()
                crc = [zlib.crc32(raw[4 * (e - k):4 * e])
                       for e, k in zip(ends, length.tolist(), strict=True)]
                order = np.argsort(length, kind="stable")
                sizes, first, times = np.unique(length[order], return_index=True,
                                                return_counts=True)
                rank = np.empty(len(length), np.int64)
                rank[order] = (np.arange(len(length)) - np.repeat(first, times)
                               + np.repeat(seen[sizes], times))
                seen[sizes] += times
                yield pa.record_batch(
                    [batch.column(0).slice(a, b - a).take(pa.array(doc)),
                     pa.array(number.astype(np.int32)), pa.array(start), pa.array(length),
                     pa.array(crc, pa.int64()), pa.array(np.full(len(doc), task, np.int32)),
                     pa.array(rank)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"])

    python_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long")


def packed(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its sequence_id and offset."""
    cut = stored(pieces(docs, tokenizer, capacity), "pieces")
    per_task = stored(cut.groupBy("length", "task").agg(F.count("*").alias("n")), "lengths")
    counts = np.zeros(capacity + 1, np.int64)
    for row in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect():   # <= capacity
        counts[row["length"]] = row["n"]
    places = Places(planned(counts, capacity), capacity)
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1)
    before = per_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0))
                             .alias("before"))
    ranked = cut.join(before, ["length", "task"]).withColumn(
        "rank", F.col("rank") + F.col("before"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sequence, offset = places.find(batch.column("length").to_numpy(),
                                       batch.column("rank").to_numpy())
        return pa.record_batch([*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                               names=[*batch.schema.names[:5], "sequence_id", "offset"])

    out = map_arrow(ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank"), run,
                    "doc_id long, piece int, start long, length long, ids_crc32 long, "
                    "sequence_id long, offset long")
    python_batches(docs.sparkSession, 8192)         # narrow rows
    return out
