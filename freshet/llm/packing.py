"""Packing documents into sequences of fixed length by patterns of lengths.

The plan is made from the histogram of piece lengths alone, at most one count per possible length, so
it does not grow with the data:

1. Lengths are rounded up to classes. Patterns of up to four classes that fill a sequence are
   enumerated, and non-negative least squares finds how often each should be used so that together
   they meet the histogram. Long classes weigh more: what stays over should be short.
2. The numbers are rounded down to what there is, and each pattern's classes are filled with real
   lengths, in runs: "these lengths, so many times over".
3. What is left over goes, longest first, where it fits best: into the room that rounding to classes
   left in the patterns, or into new sequences. Also in runs. This is tried with all patterns, and with
   fewer and fewer of those that leave the most room, whose pieces then count as left over; the plan of
   the fewest sequences stands.

A piece then finds its place by its rank among the pieces of its length: the n pieces of a length are
numbered in about sqrt(n) salted parts, so that one which very many pieces share is spread over tasks,
and the plan's runs say which sequence and offset a rank has.
"""

from __future__ import annotations

import bisect
import math
import zlib
from collections import defaultdict
from collections.abc import Iterator, Mapping
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freshet.llm.frames import materialise, numbered
from freshet.llm.tokens import END, encoder

CAPACITY = 4096
CLASSES = 128
PARTS = 4
BREAKS = 12


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """`_row`, `doc_id`, `piece`, `start`, `length`, `ids_crc32` (and `ids`) of every piece. A document is its
    token ids and the end id, so a null or empty text is one piece of length 1; only documents longer
    than `capacity` are cut."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, step = encoder(path).encode, 4 * capacity
        for batch in batches:
            rows = batch.column("_row").to_pylist()
            out = defaultdict(list)
            index = []
            for i, text in enumerate(batch.column("text")):
                ids = encode(text.as_py() or "") + END.to_bytes(4, "little")
                for at in range(0, len(ids), step):
                    part = ids[at : at + step]
                    index.append(i)
                    out["_row"].append(rows[i])
                    out["piece"].append(at // step)
                    out["start"].append(at // 4)
                    out["length"].append(len(part) // 4)
                    out["ids_crc32"].append(zlib.crc32(part))
                    if with_ids:
                        out["ids"].append(np.frombuffer(part, "<u4").astype(np.int32))
            if not index:
                continue
            kinds = {"_row": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64()}
            arrays = [pa.array(out[c], k) for c, k in kinds.items()]
            arrays.insert(1, batch.column("doc_id").take(pa.array(index)))
            if with_ids:
                arrays.append(pa.array(out["ids"], pa.list_(pa.int32())))
            names = ["_row", "doc_id", *list(kinds)[1:], *["ids"] * with_ids]
            yield pa.RecordBatch.from_arrays(arrays, names)

    rows = numbered(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"_row long, doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return rows.mapInArrow(each, schema)


@cache
def class_patterns(classes: int, parts: int) -> tuple[tuple[int, ...], ...]:
    """Every way to fill `classes` units with at most `parts` classes, the largest first."""

    def fill(room: int, most: int, parts: int) -> Iterator[tuple[int, ...]]:
        if room == 0:
            yield ()
        elif parts:
            for first in range(min(room, most), 0, -1):
                for rest in fill(room - first, first, parts - 1):
                    yield first, *rest

    return tuple(fill(classes, classes, parts))


def _least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """By the normal equations, a few hundred times faster here than by singular values, which remain for
    columns that depend on each other."""
    gram = a.T @ a
    try:
        found = np.linalg.solve(gram, a.T @ b)
    except np.linalg.LinAlgError:
        return np.linalg.lstsq(a, b, rcond=None)[0]
    exact = np.abs(gram @ found - a.T @ b).max(initial=0) <= 1e-6 * max(1.0, np.abs(b).max(initial=0))
    return found if exact else np.linalg.lstsq(a, b, rcond=None)[0]


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 600) -> np.ndarray:
    """The non-negative x with the least |ax - b|, by active sets: a column enters while it would lower
    the error, and leaves when its share would turn negative."""
    x, used = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    for _ in range(rounds):
        # Not a matrix product: over a few megabytes its threads cost more than they give.
        gain = np.where(used, -np.inf, np.einsum("ij,i->j", a, b - a[:, used] @ x[used]))
        enter = int(np.argmax(gain))
        if gain[enter] <= 1e-9 * max(1.0, np.abs(b).max()):
            break
        used[enter] = True
        while True:
            best = np.zeros_like(x)
            best[used] = _least_squares(a[:, used], b)
            low = used & (best <= 1e-12)
            if not low.any():
                x = best
                break
            step = min((x[i] / (x[i] - best[i]) for i in np.flatnonzero(low) if x[i] > best[i]), default=0.0)
            x = x + step * (best - x)
            leave = used & (x <= 1e-12)
            if not leave.any():
                leave[np.flatnonzero(low)[0]] = True
            used &= ~leave
            x[~used] = 0.0
    return x


def pattern_counts(by_class: np.ndarray, parts: int = PARTS) -> list[tuple[tuple[int, ...], int]]:
    """(classes, times) of each pattern in use, within what `by_class` (from class 1 on) has."""
    classes = len(by_class)
    patterns = class_patterns(classes, parts)
    a = np.zeros((classes, len(patterns)))
    for j, pattern in enumerate(patterns):
        for size in pattern:
            a[size - 1, j] += 1
    weights = np.arange(1, classes + 1) / classes  # an unpacked piece costs its length
    x = nnls(a * weights[:, None], by_class * weights)
    left, out = by_class.astype(np.int64).copy(), []
    for j in sorted(np.flatnonzero(x > 0.5), key=lambda j: (-x[j], patterns[j])):
        need = a[:, j].astype(np.int64)
        times = int(min(round(x[j]), (left[need > 0] // need[need > 0]).min()))
        if times > 0:
            left -= need * times
            out.append((patterns[j], times))
    return out


class _Runs:
    """The pieces of a class, as counts by length, longest first."""

    def __init__(self, counts: list[list[int]]):
        self.counts = counts

    def take(self, times: int) -> list[tuple[int, int]]:
        """(length, how many) of the next `times` pieces."""
        out = []
        while times:
            length, n = self.counts[0]
            used = min(n, times)
            out.append((length, used))
            times -= used
            self.counts[0][1] -= used
            if not self.counts[0][1]:
                self.counts.pop(0)
        return out


def plan(histogram: Mapping[int, int], capacity: int = CAPACITY, classes: int = CLASSES) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, times): runs of sequences that hold every piece of the histogram just once."""
    width = -(-capacity // classes)
    runs = [
        _Runs([[n, histogram[n]] for n in range(min(capacity, width * c), width * (c - 1), -1) if histogram.get(n)])
        for c in range(1, classes + 1)
    ]
    by_class = np.array([sum(n for _, n in r.counts) for r in runs], dtype=float)
    made: list[tuple[tuple[int, ...], int]] = []
    for pattern, times in pattern_counts(by_class):
        taken = [runs[size - 1].take(times) for size in pattern]
        while times:  # the stretch in which no part changes its length
            stretch = min(part[0][1] for part in taken)
            made.append((tuple(part[0][0] for part in taken), stretch))
            times -= stretch
            for i, part in enumerate(taken):
                taken[i] = part if part[0][1] > stretch else part[1:]
                if part[0][1] > stretch:
                    taken[i] = [(part[0][0], part[0][1] - stretch), *part[1:]]
    left = defaultdict(int, {length: n for r in runs for length, n in r.counts})
    wastes = sorted({capacity - sum(lengths) for lengths, _ in made}, reverse=True)
    best = None
    # As they are, then without the patterns that leave most room, more and more of them.
    for most in wastes[:: max(1, len(wastes) // BREAKS)] or [0]:
        kept = [(lengths, times) for lengths, times in made if capacity - sum(lengths) <= most]
        rest = left.copy()
        for lengths, times in made:
            if capacity - sum(lengths) > most:
                for length in lengths:
                    rest[length] += times
        packed = _best_fit(kept, rest, capacity)
        if best is None or sum(n for _, n in packed) < sum(n for _, n in best):
            best = packed
    return sorted(best, reverse=True)


def _best_fit(made: list[tuple[tuple[int, ...], int]], rest: Mapping[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """The runs made with the rest put where it fits best, longest first, a whole run at a time."""
    by_room: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for lengths, times in made:
        by_room[capacity - sum(lengths)].append((lengths, times))
    rooms = sorted(by_room)

    def put(room: int, entry: tuple[tuple[int, ...], int]) -> None:
        if not by_room.get(room):
            bisect.insort(rooms, room)
            by_room[room] = []
        by_room[room].append(entry)

    for length, n in sorted(rest.items(), reverse=True):
        while n:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                each = min(n, capacity // length)
                fresh = n // each
                put(capacity - each * length, ((length,) * each, fresh))
                n -= fresh * each
                continue
            room = rooms[at]
            lengths, times = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(at)
            used = min(times, n)
            if times > used:
                put(room, (lengths, times - used))
            put(room - length, ((*lengths, length), used))
            n -= used
    return [entry for entries in by_room.values() for entry in entries]


def slots(made: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, sequence of the first rank, offset) of every part of the plan."""
    ranks: dict[int, int] = defaultdict(int)
    out, sequence = [], 0
    for lengths, times in made:
        offset = 0
        for length in lengths:
            out.append((length, ranks[length], ranks[length] + times, sequence, offset))
            ranks[length] += times
            offset += length
        sequence += times
    return out


def place(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`found` (with `_row`, `piece`, `length`) with `sequence_id` and `offset`.

    Pieces of equal length are interchangeable; which one goes where follows from their order by
    number. No rows in, no rows out. The plan's table has a few thousand rows at any size of
    the input (a run changes only where a length or a pattern is used up) and is broadcast.
    """
    spark = found.sparkSession
    histogram = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = spark.createDataFrame(
        slots(plan(histogram, capacity)), "length long, first long, end long, sequence long, offset long"
    )
    salts = spark.createDataFrame(
        [(length, math.isqrt(n)) for length, n in histogram.items()], "length long, salts long"
    )
    salted = found.join(F.broadcast(salts), "length").withColumn("_salt", F.pmod(F.xxhash64("_row", "piece"), F.col("salts"))).drop("salts")
    counts = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "_salt", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("_row", "piece")) - 1
    ranked = salted.withColumn("_within", within).join(before, ["length", "_salt"]).withColumn("_rank", F.col("_within") + F.col("_before"))
    part = F.broadcast(table.withColumnRenamed("length", "_length"))
    return ranked.join(part, (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("first")) & (F.col("_rank") < F.col("end"))).select(
        *found.columns, (F.col("sequence") + F.col("_rank") - F.col("first")).alias("sequence_id"), "offset"
    )


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per piece with its place. Texts are read and encoded once, whole; ids do not move.

    A null or empty text is a piece of length 1. Repeated rows and null ids are documents of their own; pieces of
    one length are interchangeable, their order by row decides. No rows give none. Other columns are not read,
    whatever their names."""
    found = materialise(pieces(docs, path or tokenizer_path(), capacity, False, text, id_col), "pieces")
    return place(found, capacity)


def sequences(docs: DataFrame, placed: DataFrame, path: str | None = None, capacity: int = CAPACITY, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The packed sequences: `sequence_id`, `ids`, and `doc_ids`, `lengths` of their pieces in order.

    The ids are made again rather than kept, and moved once."""
    found = pieces(docs, path or tokenizer_path(), capacity, True, text, id_col).select("_row", "piece", "ids")
    rows = placed.select("_row", "doc_id", "piece", "length", "sequence_id", "offset").join(found, ["_row", "piece"])
    in_order = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    return rows.groupBy("sequence_id").agg(in_order.alias("p")).select(
        "sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"), F.col("p.length").alias("lengths")
    )
