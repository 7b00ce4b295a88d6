"""Repeated passages by suffix sorting: every byte that a 200-byte string covers which also starts anywhere
else, in the same document or another.

Sorting all suffixes of a corpus would move each of them with its 200 bytes. Three steps leave only those
that can matter, none of them by guessing:

1. Equal texts are one text; its copies are removed whole.
2. Anchors. Each 200-byte window belongs to the smallest-hashed of its 40-grams (the last of equal ones), so
   equal windows belong to equal anchors at equal places. Consecutive windows with the same anchor are a
   run; an anchor that occurs once in the corpus makes none of its windows repeated.
3. Runs of anchors that do occur again are collapsed by their bytes. If an anchor has one kind of run, all
   its windows repeat. Only different runs around the same anchor are left, and their windows are
   sorted by `suffix_sort`.

An anchor with more than `MAX_RUNS` different runs (around the edge of a passage that very many documents
share) is not sorted in one task: its windows are grouped by 128-bit digests, combined before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.frames import materialise, numbered
from freshet.llm.suffix_sort import repeated

WIDTH = 200
GRAM = 40
MAX_RUNS = 4_000
_SLICE = 1 << 20
_PLACE = (1 << 24) - 1
_ODD = 0x9E3779B97F4A7C15


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    up = np.full(n, _ODD, np.uint64)
    down = np.full(n, pow(_ODD, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each `gram` bytes by what they are, not where: sums of bytes times powers, mixed."""
    up, down = _powers(_SLICE + 4 * WIDTH if len(raw) < _SLICE + 4 * WIDTH else len(raw))
    upto = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * down[: len(raw)], dtype=np.uint64)))
    h = (upto[gram:] - upto[:-gram]) * up[: len(raw) - gram + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """The minimum of each `size` values in a row, by minima up to and from the bounds of blocks."""
    blocks = -(-len(values) // size)
    padded = np.full(blocks * size, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    table = padded.reshape(blocks, size)
    upto = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - size + 1
    return np.minimum(back[:n], upto[size - 1 : size - 1 + n])


def runs(raw: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(anchor's hash, anchor's place, first window, last window) of every run of the text's windows."""
    parts = []
    for at in range(0, len(raw) - width + 1, _SLICE):
        piece = raw[at : at + _SLICE + width - 1]
        h = gram_hashes(piece, gram)
        place = np.arange(len(h), dtype=np.uint64)
        ranked = (h & ~np.uint64(_PLACE)) | (np.uint64(_PLACE) - place)
        owner = _PLACE - (sliding_min(ranked, width - gram + 1) & np.uint64(_PLACE)).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(np.diff(owner)) + 1))
        last = np.concatenate((first[1:] - 1, [len(owner) - 1]))
        parts.append((h[owner[first]].view(np.int64), owner[first] + at, first + at, last + at))
    if not parts:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _anchors(rows: DataFrame) -> DataFrame:
    """`_row`, `key` and the anchors of each row: arrays `hash`, `place`."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [runs(np.frombuffer(_bytes(t.as_py()), np.uint8))[:2] for t in batch.column("text")]
            columns = [pa.array([f[i] for f in found], pa.list_(pa.int64())) for i in range(2)]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), batch.column("key"), *columns], ["_row", "key", "hash", "place"])

    return rows.select("_row", "key", "text").mapInArrow(each, "_row long, key binary, hash array<long>, place array<long>")


def _live_runs(texts: DataFrame) -> DataFrame:
    """The runs whose anchors are in `live`: `_row`, `at` (first window), `hash`, `off` (anchor's place in the
    run), `id` (digest of the bytes), `run` (bytes)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["_row", "at", "hash", "off", "id", "run"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        for batch in batches:
            out: list[tuple] = []
            size = 0
            for row, text, live in zip(batch.column("_row").to_pylist(), batch.column("text"), batch.column("live"), strict=True):
                data = _bytes(text.as_py())
                hashes, places, first, last = runs(np.frombuffer(data, np.uint8))
                some = np.isin(places, live.values.to_numpy())
                for h, p, a, b in zip(*(x[some].tolist() for x in (hashes, places, first, last)), strict=True):
                    run = data[a : b + WIDTH]
                    size += len(run)
                    out.append((row, a, h, p - a, hashlib.blake2b(run, digest_size=16).digest(), run))
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return texts.mapInArrow(each, "_row long, at long, hash long, off int, id binary, run binary")


def _ranges(starts: np.ndarray) -> list[dict]:
    """Windows in a row as [first, last]."""
    if not len(starts):
        return []
    cuts = np.flatnonzero(np.diff(starts) != 1)
    firsts, lasts = np.concatenate(([0], cuts + 1)), np.concatenate((cuts, [len(starts) - 1]))
    return [{"first": int(starts[a]), "last": int(starts[b])} for a, b in zip(firsts, lasts, strict=True)]


_FOUND = "hash long, off int, id binary, windows array<struct<first:int,last:int>>"


def _sorted_windows(kinds: DataFrame) -> DataFrame:
    """The repeated windows of each kind of run (`hash`, `off`, `id`, `run`, `n`), all kinds of an anchor together."""

    def batch_of(frame: pd.DataFrame) -> pd.DataFrame:
        data, starts, classes, bounds, at = b"".join(frame["run"]), [], [], [0], 0
        group = frame["hash"].ne(frame["hash"].shift()).cumsum().to_numpy()
        for run, g in zip(frame["run"], group, strict=True):
            windows = len(run) - WIDTH + 1
            starts.append(np.arange(at, at + windows))
            classes.append(np.full(windows, g))
            at += len(run)
            bounds.append(bounds[-1] + windows)
        again = repeated(data, np.concatenate(starts), np.concatenate(classes), WIDTH)
        many = frame["n"].to_numpy() > 1
        windows = [
            [{"first": 0, "last": bounds[i + 1] - bounds[i] - 1}] if many[i] else _ranges(np.flatnonzero(again[bounds[i] : bounds[i + 1]]))
            for i in range(len(frame))
        ]
        return frame[["hash", "off", "id"]].assign(windows=windows)

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
            if not len(frame):
                continue
            last = frame["hash"] == frame["hash"].iloc[-1]
            held = frame[last]
            rest = frame[~last].reset_index(drop=True)
            if len(rest):
                yield batch_of(rest)
        if held is not None and len(held):
            yield batch_of(held.reset_index(drop=True))

    return kinds.select("hash", "off", "id", "run", "n").repartition("hash").sortWithinPartitions("hash").mapInPandas(each, _FOUND)


def _digested_windows(kinds: DataFrame) -> DataFrame:
    """The same by grouping digests of windows, for anchors with more kinds of runs than a task should hold."""

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for h, off, key, run, n in frame[["hash", "off", "id", "run", "n"]].itertuples(index=False):
                w = range(len(run) - WIDTH + 1)
                digests = [hashlib.blake2b(run[i : i + WIDTH], digest_size=16).digest() for i in w]
                yield pd.DataFrame({"hash": h, "off": off, "id": key, "n": n, "window": list(w), "digest": digests})

    windows = materialise(
        kinds.select("hash", "off", "id", "run", "n").mapInPandas(each, "hash long, off int, id binary, n long, window int, digest binary"),
        "windows",
    )
    again = materialise(windows.groupBy("digest").agg(F.sum("n").alias("times")).filter("times > 1").select("digest"), "again")
    one = F.struct(F.col("window").alias("first"), F.col("window").alias("last"))
    return windows.join(again, "digest").groupBy("hash", "off", "id").agg(F.collect_list(one).alias("windows"))


def passages(docs: DataFrame, text: str = "text", id_col: str = "doc_id", max_runs: int = MAX_RUNS) -> DataFrame:
    """One row per row of `docs`: `_row`, `doc_id`, `n_bytes`, `n_removed`, `n_spans`, `kept_sha256`, and `spans`,
    the removed [begin, end) of bytes.

    Null counts as empty. Texts under 200 bytes lose nothing; of equal longer texts, repeated rows
    too, all lose everything. No rows in, no rows out.
    """
    source = numbered(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")))
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    keyed = source.withColumn("key", F.unhex(F.sha2(raw, 256)))
    rows = materialise(keyed.select("_row", "doc_id", "key", F.octet_length(raw).cast("long").alias("n_bytes")), "texts")
    long_enough = keyed.filter(F.octet_length(raw) >= WIDTH)
    one_each = materialise(
        _anchors(long_enough).groupBy("key").agg(
            F.min("_row").alias("_row"), F.count(F.lit(1)).alias("copies"), F.any_value("hash").alias("hash"), F.any_value("place").alias("place")
        ),
        "anchors",
    )
    places = one_each.select("_row", F.inline(F.arrays_zip("hash", "place")))
    live = materialise(places.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("hash"), "live")
    by_text = places.join(live, "hash").groupBy("_row").agg(F.collect_list("place").alias("live"))
    texts = materialise(source.select("_row", "text").join(by_text, "_row"), "sharing")
    all_runs = materialise(_live_runs(texts), "runs")

    kinds = materialise(all_runs.groupBy("hash", "off", "id", "run").agg(F.count(F.lit(1)).alias("n")), "kinds")
    sizes = materialise(kinds.groupBy("hash").agg(F.count(F.lit(1)).alias("kinds")), "sizes")
    alone = kinds.join(sizes.filter("kinds = 1").select("hash"), "hash", "left_semi").filter("n > 1")
    whole = F.array(F.struct(F.lit(0).alias("first"), (F.length("run") - WIDTH).alias("last")))
    few = kinds.join(sizes.filter(F.col("kinds").between(2, max_runs)).select("hash"), "hash", "left_semi")
    found = alone.select("hash", "off", "id", whole.alias("windows")).unionByName(_sorted_windows(few))
    many = sizes.filter(F.col("kinds") > max_runs).select("hash")
    if not many.isEmpty():
        large = kinds.join(many, "hash", "left_semi")
        found = found.unionByName(_digested_windows(large))
        found = found.unionByName(large.filter("n > 1").select("hash", "off", "id", whole.alias("windows")))
    found = materialise(found.filter(F.size("windows") > 0), "repeated")

    here = all_runs.select("_row", "at", "hash", "off", "id").join(found, ["hash", "off", "id"])
    covered = here.select("_row", "at", F.inline("windows")).select(
        "_row", F.struct((F.col("at") + F.col("first")).alias("begin"), (F.col("at") + F.col("last") + WIDTH).alias("end")).alias("span")
    )
    by_row = covered.groupBy("_row").agg(F.sort_array(F.collect_list("span")).alias("covered"))
    cut = _cut(texts.select("_row", "text").join(by_row, "_row"))
    by_key = materialise(one_each.select("_row", "key", "copies").join(cut, "_row", "left").drop("_row"), "cut")
    joined = rows.join(by_key, "key", "left")
    all_gone = F.coalesce(F.col("copies") > 1, F.lit(False))
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return joined.select(
        "_row",
        "doc_id",
        "n_bytes",
        F.when(all_gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(all_gone, 1).otherwise(F.coalesce(F.size("spans"), F.lit(0))).cast("long").alias("n_spans"),
        F.when(all_gone, nothing).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("key")))).alias("kept_sha256"),
        F.when(all_gone, F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("n_bytes").alias("end")))).otherwise(F.col("spans")).alias("spans"),
    )


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans with those that touch or overlap made one."""
    out: list[tuple[int, int]] = []
    for begin, end in spans:
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def cut_text(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    bounds = [0, *(x for span in spans for x in span), len(data)]
    return b"".join(data[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True))


def _cut(texts: DataFrame) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))]
        for batch in batches:
            out = []
            for row, text, covered in zip(batch.column("_row").to_pylist(), batch.column("text"), batch.column("covered").to_pylist(), strict=True):
                data, spans = _bytes(text.as_py()), merged([(c["begin"], c["end"]) for c in covered])
                kept = hashlib.sha256(cut_text(data, spans)).hexdigest()
                out.append((row, sum(b - a for a, b in spans), kept, [{"begin": a, "end": b} for a, b in spans]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["_row", "n_removed", "kept_sha256", "spans"])

    return texts.mapInArrow(each, "_row long, n_removed long, kept_sha256 string, spans array<struct<begin:long,end:long>>")
