"""Quality by nearest-neighbour voting in a latent-semantic space.

A document is a vector over hashed terms: its words, its runs of marks, and shape terms that say what share
of its pieces are repeats, upper-case words or a kind of mark (halves, quarters and so on, each share with all
smaller ones). A truncated singular value decomposition of at most `MAX_TRAIN` labelled documents gives the
latent space. Their vectors there, of length one, are broadcast with the projection; every document is
projected, a block of documents is multiplied with all labelled vectors, and the labels of the `NEIGHBOURS`
most similar ones vote with a power of their cosine.

Bounds: the driver holds the terms of the sampled rows and the model, 2^15 terms by 32 axes and 4,000
vectors (5 MB); a task works on 128 texts at a time. Which rows are sampled depends on a hash of their ids; all
documents are scored, whole, in one pass without a shuffle.

Odd rows: a null text is an empty one, and empty texts have a term of their own, so that labelled ones vote on
them. A text without a known term gets the share of label 1 among the labelled rows; with no labelled rows all
get 0.5. Of equally similar neighbours at the edge any may vote, the same ones for the same model and block.
Null ids and labels are not learned from; rows repeated under an id count once, by their smallest terms, and a
label given both ways counts as 0. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 15
AXES = 32
MAX_TRAIN = 4_000
NEIGHBOURS = 7
POWER = 8
LEVELS = 7
# Texts multiplied with the labelled vectors at a time, and entries of a sparse product held at a time.
BLOCK = 128
ENTRIES = 200_000
SEED = 3
_PIECE = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+|\n+")


def _term(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass"))


class Codes(dict):
    """Piece to its term's hash and, in the lowest 21 bits, its shape: 0 a plain word, 1 one in upper case, else
    the character that a run of marks or digits begins with. Short pieces are remembered, up to a number."""

    def __missing__(self, piece: str) -> int:
        shape = ord(piece[0]) + 2 if not piece[0].isalpha() else int(len(piece) > 1 and piece.isupper())
        code = _term(piece.lower()) << 21 | shape
        if len(piece) <= 32:
            if len(self) >= 200_000:
                self.clear()
            self[piece] = code
        return code


def terms(text: str | None, codes: Codes, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashed terms of a text, in order, and how often each comes."""
    pieces = _PIECE.findall(text or "")
    kinds = Counter(pieces)
    n = np.fromiter(kinds.values(), np.int64, len(kinds))
    codes = np.fromiter(map(codes.__getitem__, kinds), np.int64, len(kinds))
    shapes, back = np.unique(codes & 0x1FFFFF, return_inverse=True)
    found = {str(s): int(k) for s, k in zip(shapes, np.bincount(back, n, len(shapes)), strict=True) if s}
    found["again"] = len(pieces) - len(kinds)
    found["same"] = sum(map(eq, pieces, islice(pieces, 1, None)))
    named = [f" {s} {i}" for s, k in found.items() if k for i in range(1, LEVELS + 1) if k << i >= len(pieces)]
    if not pieces:
        named = [" empty"]
    mask = (1 << bits) - 1
    every = np.concatenate((codes >> 21, np.array([_term(name) for name in named], np.int64))) & mask
    index, back = np.unique(every, return_inverse=True)
    counts = np.bincount(back, np.concatenate((n, np.ones(len(named), np.int64))), len(index))
    return index.astype(np.int32), counts.astype(np.int32)


@dataclass
class Rows:
    """Sparse rows: row i has values[starts[i]:starts[i + 1]] at the places index[...]."""

    index: np.ndarray
    values: np.ndarray
    starts: np.ndarray

    def times(self, dense: np.ndarray) -> np.ndarray:
        """The product with a dense matrix, some entries at a time."""
        out = np.zeros((len(self.starts) - 1, dense.shape[1]), np.float64)
        at = 0
        while at < len(out):
            upto = max(at + 1, int(np.searchsorted(self.starts, self.starts[at] + ENTRIES, "right")) - 1)
            a, b = self.starts[at], self.starts[upto]
            if b > a:
                own = self.starts[at:upto] - a
                full = np.diff(self.starts[at : upto + 1]) > 0
                products = dense[self.index[a:b]] * self.values[a:b, None]
                out[at:upto][full] = np.add.reduceat(products, own[full], axis=0)
            at = upto
        return out

    def turned(self, width: int) -> Rows:
        """The transpose."""
        rows = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        order = np.argsort(self.index, kind="stable")
        starts = np.concatenate(([0], np.cumsum(np.bincount(self.index, minlength=width))))
        return Rows(rows[order], self.values[order], starts)


def _rows(found: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray) -> Rows:
    """Logarithmic counts by the terms' weights; rows of length one. Terms that weigh nothing drop out."""
    kept = [(i[weights[i] > 0], n[weights[i] > 0]) for i, n in found]
    values = [(1 + np.log(n)) * weights[i] for i, n in kept]
    values = [v / np.sqrt((v * v).sum()) if len(v) else v for v in values]
    starts = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int64)
    index = np.concatenate([i for i, _ in kept]) if kept else np.zeros(0, np.int32)
    return Rows(index, np.concatenate(values) if values else np.zeros(0), starts)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


@dataclass
class Jury:
    """Term weights, the projection, and the labelled rows' vectors with their labels."""

    weights: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    bits: int = BITS
    neighbours: int = NEIGHBOURS
    power: int = POWER

    def project(self, found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        return _unit(_rows(found, self.weights).times(self.axes)).astype(np.float32)

    def vote(self, vectors: np.ndarray) -> np.ndarray:
        """The neighbours' labels by similarity; without any like neighbour, the share of label 1."""
        if not len(self.labels):
            return np.full(len(vectors), 0.5)
        cosines = vectors @ self.vectors.T
        most = min(self.neighbours, len(self.labels))
        near = np.argpartition(-cosines, most - 1, axis=1)[:, :most]
        weight = np.maximum(np.take_along_axis(cosines, near, 1), 0).astype(np.float64) ** self.power
        total = weight.sum(axis=1)
        share = (weight * self.labels[near]).sum(axis=1) / np.maximum(total, 1e-30)
        return np.clip(np.where(total > 1e-12, share, self.labels.mean()), 0, 1)

    def score_texts(self, texts: pa.Array, codes: Codes) -> np.ndarray:
        parts = [np.zeros(0)]
        for at in range(0, len(texts), BLOCK):
            parts.append(self.vote(self.project([terms(t.as_py(), codes, self.bits) for t in texts[at : at + BLOCK]])))
        return np.concatenate(parts)


def fit(found: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, bits: int = BITS, axes: int = AXES) -> Jury:
    """Weights by inverse document frequency (none for a term of a single row), axes by subspace iteration
    from a seeded start: products with the rows and their transpose in turn, then a small decomposition."""
    size, n = 1 << bits, len(found)
    seen = np.zeros(size, np.int64)
    for index, _ in found:
        seen[index] += 1
    weights = np.where(seen > 1, np.log((1 + n) / (1 + seen)), 0.0)
    rows = _rows(found, weights)
    columns = rows.turned(size)
    axes = min(axes, n, int((weights > 0).sum()))
    if not axes:
        return Jury(weights, np.zeros((size, 1), np.float32), np.zeros((n, 1), np.float32), labels, bits)
    basis = np.random.default_rng(SEED).normal(size=(n, min(axes + 10, n)))
    for _ in range(2):
        basis, _ = np.linalg.qr(rows.times(np.linalg.qr(columns.times(basis))[0]))
    _, _, right = np.linalg.svd(columns.times(basis).T, full_matrices=False)
    jury = Jury(weights, right[:axes].T.astype(np.float32), np.zeros((0, axes), np.float32), labels, bits)
    jury.vectors = _unit(rows.times(jury.axes)).astype(np.float32)
    return jury


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: crc32 of its id, modulo 3, is 1. A null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, text: str = "text", id_col: str = "doc_id", label: str = "quality") -> Jury:
    """Fit on at most `max_train` labelled documents that are not held out, those with the smallest hash of
    their id."""
    known = (
        labels.select(F.col(id_col).alias("doc_id"), F.col(label).cast("int").alias("label"))
        .filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("label").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_train)
    )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes()
        for batch in batches:
            found = [np.stack(terms(t.as_py(), codes)).T.reshape(-1) for t in batch.column("text")]
            found = pa.array(found, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), found], ["doc_id", "label", "terms"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = (
        docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
        .join(F.broadcast(known), "doc_id")
        .select("doc_id", "label", "text")
        .mapInArrow(each, f"doc_id {kind}, label int, terms array<int>")
        .groupBy("doc_id", "label")
        .agg(F.min("terms").alias("terms"))
        .toArrow()
        .sort_by("doc_id")
    )
    flat = [np.asarray(x.values.to_numpy(zero_copy_only=False), np.int32) for x in rows.column("terms")]
    return fit([(x[::2], x[1::2]) for x in flat], (rows.column("label").to_numpy() > 0).astype(float))


def score(docs: DataFrame, jury: Jury, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """`doc_id`, `held_out`, `score` and `predicted` (1 from 0.5 on) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(jury)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes()
        for batch in batches:
            found = pa.array(shared.value.score_texts(batch.column("text"), codes), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found], ["doc_id", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(each, f"doc_id {kind}, score double").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
