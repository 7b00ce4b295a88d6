"""Near duplicates by SimHash, found with pigeonhole blocks.

A 64-bit fingerprint is cut into m blocks. Two fingerprints at most 4 bits apart agree in at least
m - 4 of them, so every choice of m - 4 blocks is a join key and each close pair meets under one at
least; nothing is missed. m grows with the number of fingerprints so that a key stays selective; the
pairs found are the same for every m.

Copies share a fingerprint and are collapsed first. Under one key the fingerprints are linked to a
spanning forest (at most one link for each, never all pairs): starting anywhere, each one found takes
along all unlinked ones near it. A key with more fingerprints than `MAX_BUCKET` is cut into
pieces and each pair of pieces is linked in a task of its own, so memory stays bounded and no link is
lost.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.llm.frames import connected, keep_rows, materialise, numbered, unsigned_hex

DISTANCE = 4
SHINGLE = 4
SEED = 42
MAX_BUCKET = 20_000
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_BITS = np.arange(64, dtype=np.uint64)


def fingerprint(text: str | None) -> int:
    """Bit i is 1 if set in more than half of the hashes of the text's word 4-grams. No words: 0."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    line, size = b" ".join(words), min(SHINGLE, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = (ends - [len(w) for w in words]).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(line[a:b], SEED) for a, b in zip(starts, ends[size - 1 :].tolist(), strict=False)], dtype="<u8"
    )
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):  # a long text's bits a slice at a time
        part = hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(((2 * ones > len(hashes)).astype(np.uint64) << _BITS).sum())


def fingerprints(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """`_row`, `doc_id`, `fp` (the fingerprint as a signed long) of every row."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py()) for t in batch.column("text")], dtype=np.uint64)
            columns = [batch.column("_row"), batch.column("doc_id"), pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["_row", "doc_id", "fp"])

    rows = numbered(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(each, f"_row long, doc_id {kind}, fp long")


def block_count(n: int) -> int:
    """Few enough fingerprints by chance under one key: 21, 27 or 32 bits for up to 2^20, 2^26 or more."""
    return 6 if n <= 2**20 else 7 if n <= 2**26 else 8


def block_keys(fp: Column, blocks: int, distance: int = DISTANCE) -> Column:
    """An array of (choice, key): the bits of every choice of blocks - distance blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [sum(1 << b for b in range(edges[i], edges[i + 1])) for i in range(blocks)]
    signed = lambda m: m - 2**64 if m >= 2**63 else m
    chosen = [sum(masks[i] for i in c) for c in combinations(range(blocks), blocks - distance)]
    return F.array(
        *[
            F.struct(F.lit(i).alias("choice"), fp.bitwiseAND(F.lit(signed(m)).cast("long")).alias("key"))
            for i, m in enumerate(chosen)
        ]
    )


def forest(members: np.ndarray, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """Links that connect just what pairs at most `distance` bits apart connect."""
    links, left = [], members.view(np.uint64)
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(left ^ at) <= distance
            if near.any():
                found = left[near]
                left = left[~near]
                links += [(at, other) for other in found]
                queue += list(found)
    return links


def _link_groups(batches: Iterable[pd.DataFrame], by: list[str]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by `by`; a group may span batches, and is whole before it is linked."""

    def linked(frame: pd.DataFrame) -> pd.DataFrame:
        keys, fps = frame[by].to_numpy(), frame["fp"].to_numpy(np.int64)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        bounds = np.concatenate(([0], cuts, [len(fps)]))
        sizes = np.diff(bounds)
        links = []
        pairs = bounds[:-1][sizes == 2]
        first, second = fps[pairs].view(np.uint64), fps[pairs + 1].view(np.uint64)
        near = np.bitwise_count(first ^ second) <= DISTANCE
        links += list(zip(first[near], second[near], strict=True))
        for i in np.flatnonzero(sizes > 2):
            links += forest(fps[bounds[i] : bounds[i + 1]])
        return pd.DataFrame(np.array(links, dtype=np.uint64).reshape(-1, 2).view(np.int64), columns=["a", "b"])

    held: pd.DataFrame | None = None
    for frame in batches:
        if held is not None:
            frame = pd.concat([held, frame], ignore_index=True)
        last = (frame[by] == frame[by].iloc[-1]).all(axis=1).to_numpy() if len(frame) else np.zeros(0, bool)
        held = frame[last]
        yield linked(frame[~last].reset_index(drop=True))
    if held is not None and len(held):
        yield linked(held.reset_index(drop=True))


def close_links(fps: DataFrame, n: int, blocks: int | None = None, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Links (a, b) that connect just what the pairs of the n distinct `fp` near each other connect."""
    keyed = fps.select("fp", F.inline(block_keys(F.col("fp"), blocks or block_count(n))))
    by = ["choice", "key"]
    sizes = keyed.groupBy(*by).agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > max_bucket)
    large = materialise(sizes.select(*by, F.ceil(F.col("size") / max_bucket).cast("int").alias("pieces")), "buckets")
    linked = lambda rows, by: (
        rows.repartition(*by).sortWithinPartitions(*by).mapInPandas(lambda frames: _link_groups(frames, by), "a long, b long")
    )
    if large.isEmpty():
        return linked(keyed, by)
    # Piece p of a large bucket meets every piece q: the task (least, greatest) has both whole.
    cut = keyed.join(large, by).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int"))
    paired = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).select(
        *by, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp"
    )
    return linked(keyed.join(large, by, "left_anti"), by).union(linked(paired, [*by, "i", "j"]))


def near_duplicates(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per row of `docs`: `_row`, `doc_id`, `fp`, `component_id`, `kept`.

    Fingerprints at most 4 bits apart link; `component_id` is the smallest id reachable (null if all
    of them are null), and its first row is `kept`. Texts without words (null too) have
    fingerprint 0 and link like any other. No rows in, no rows out.
    """
    rows = materialise(fingerprints(docs, text, id_col), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_row")).alias("first")
    fps = materialise(rows.groupBy("fp").agg(first), "distinct")
    names = connected(close_links(fps.select("fp"), fps.count())).toDF("fp", "root")
    rooted = materialise(fps.join(names, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")
    roots = rooted.groupBy("root").agg(F.min("first").alias("best"))
    named = materialise(
        rooted.join(roots, "root").select("fp", F.col("best.doc_id").alias("component_id"), F.col("best._row").alias("_best")),
        "components",
    )
    return rows.join(named, "fp").select(
        "_row", "doc_id", "fp", "component_id", (F.col("_row") == F.col("_best")).alias("kept")
    )


def deduplicate(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One document of each component, with all its columns."""
    return keep_rows(docs, near_duplicates(docs, text, id_col).filter("kept"))


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", unsigned_hex(F.col("fp")).alias("fingerprint"), "component_id")
