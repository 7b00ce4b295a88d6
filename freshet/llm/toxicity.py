"""Toxicity by a factorization machine over hashed terms.

A document is the set of its lower-case words, hashed to 2^18 terms. The score is logistic in a bias, a
weight per term and, for each pair of terms, the product of two learned vectors, so that a pair
(an insult next to the mention of a group) can count for more, or less, than its terms on their own.

The model is fitted on at most `MAX_TRAIN` labelled rows, those with the smallest hash of their id;
labels of held-out rows are never read. What the driver holds is those rows' terms and the model, both
of bounded size. Scoring is one pass over the whole texts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.frames import crc_fold, numbered

BITS = 18
FACTORS = 4
MAX_TRAIN = 20_000
MIN_ROWS = 8
MAX_TERMS = 1024
POSITIVE_WEIGHT = 2.0
EPOCHS = 12
SEED = 5
_TERM = re.compile(r"[^\W\d_]+")


def terms(text: str | None, bits: int = BITS) -> np.ndarray:
    """The distinct hashed words of a text, in order."""
    mask = (1 << bits) - 1
    words = {w.encode("utf-8", "surrogatepass") for w in _TERM.findall((text or "").lower())}
    return np.unique(np.fromiter((zlib.crc32(w) & mask for w in words), np.int32, len(words)))


@dataclass
class Machine:
    bias: float
    weights: np.ndarray  # a weight per term
    vectors: np.ndarray  # a vector per term
    values: np.ndarray  # what a term counts if it is there: 0 for those too rare or everywhere

    def margins(self, index: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Scores before the logistic function, of rows whose terms are index[starts[i]:starts[i + 1]]."""
        x = self.values[index]
        v = self.vectors[index] * x[:, None]
        sums = _sums(v, starts)
        pairs = 0.5 * (sums**2 - _sums(v * v, starts)).sum(axis=1)
        return self.bias + _sums((self.weights[index] * x)[:, None], starts)[:, 0] + pairs

    def score(self, index: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margins(index, starts), -30, 30)))

    def score_texts(self, texts: pa.Array) -> np.ndarray:
        """A few texts at a time: each term of each text takes a vector while it is summed."""
        parts = [np.zeros(0)]
        for at in range(0, len(texts), 128):
            parts.append(self.score(*_rows([terms(t.as_py()) for t in texts[at : at + 128]])))
        return np.concatenate(parts)


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of consecutive rows; 0 for a row without terms."""
    upto = np.concatenate((np.zeros((1, values.shape[1])), np.cumsum(values, axis=0, dtype=np.float64)))
    return upto[starts[1:]] - upto[starts[:-1]]


def _rows(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    index = np.concatenate(lists) if lists else np.zeros(0, np.int32)
    return index, np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int64)


def fit(lists: list[np.ndarray], labels: np.ndarray, bits: int = BITS, factors: int = FACTORS, epochs: int = EPOCHS) -> Machine:
    """Adagrad on the log loss, in small batches of a seeded order; a light decay keeps rare terms small.

    Terms in fewer than `MIN_ROWS` rows or more than half of them count nothing, nor do any but the
    `MAX_TERMS` most telling ones by chi-square (no more than there are positive rows). Positive
    rows are rare and weigh more. Without rows of both classes the score is the share of positive
    ones (0 without rows).
    """
    size, rng = 1 << bits, np.random.default_rng(SEED)
    share, n = float(labels.mean()) if len(labels) else 0.0, max(len(lists), 1)
    found, positive = np.zeros(size), np.zeros(size)
    for row, label in zip(lists, labels, strict=True):
        found[row] += 1
        positive[row] += label
    useful = (found >= MIN_ROWS) & (found <= 0.5 * n)
    spread = found * share * (1 - share) * (1 - found / n)
    telling = np.where(useful, (positive - found * share) ** 2 / np.maximum(spread, 1e-9), 0.0)
    most = int(min(MAX_TERMS, max(64, labels.sum())))
    if useful.sum() > most:
        useful &= telling >= np.sort(telling[useful])[-most]
    idf = np.log(n / np.maximum(found, 1)) + 1.0
    values = np.where(useful, idf / idf[useful].max() if useful.any() else 0.0, 0.0)
    bias = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    machine = Machine(bias, np.zeros(size), rng.normal(0, 0.01, (size, factors)) * useful[:, None], values)
    if not 0 < share < 1:
        machine.vectors[:] = 0
        return machine
    lists = [row[useful[row]] for row in lists]
    row_weights = np.where(labels > 0, POSITIVE_WEIGHT, 1.0)
    past_w, past_v, past_b = np.full(size, 1e-4), np.full((size, factors), 1e-4), 1e-4
    for _ in range(epochs):
        order = rng.permutation(len(lists))
        for at in range(0, len(order), 64):
            rows = order[at : at + 64]
            index, starts = _rows([lists[i] for i in rows])
            error = (machine.score(index, starts) - labels[rows]) * row_weights[rows]
            each = np.repeat(error / len(rows), np.diff(starts))
            x = values[index]
            v = machine.vectors[index] * x[:, None]
            sums = np.repeat(_sums(v, starts), np.diff(starts), axis=0)
            used, back = np.unique(index, return_inverse=True)
            grad_w = np.bincount(back, each * x, len(used)) + 1e-5 * machine.weights[used]
            parts = (each * x)[:, None] * (sums - v)
            grad_v = np.stack([np.bincount(back, parts[:, f], len(used)) for f in range(factors)], axis=1) + 1e-4 * machine.vectors[used]
            past_w[used] += grad_w**2
            past_v[used] += grad_v**2
            past_b += error.mean() ** 2
            machine.weights[used] -= 0.5 * grad_w / np.sqrt(past_w[used])
            machine.vectors[used] -= 0.05 * grad_v / np.sqrt(past_v[used])
            machine.bias -= 0.1 * error.mean() / np.sqrt(past_b)
    return machine


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, text: str = "text", id_col: str = "doc_id", label: str = "toxic") -> Machine:
    """Fit on labelled documents outside the held-out fold (crc32 of the id, modulo 5, is 0).

    Ids are drawn from the labels alone, at most `max_train`; of rows repeated under one id the first
    by their terms counts, and a label given both ways counts as toxic. Null ids and labels are left out.
    """
    known = (
        labels.select(F.col(id_col).alias("doc_id"), F.col(label).cast("int").alias("toxic"))
        .filter((crc_fold(F.col("doc_id")) != 0) & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_train)
    )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([terms(t.as_py()) for t in batch.column("text")], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), found], ["doc_id", "toxic", "terms"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = (
        docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
        .join(F.broadcast(known), "doc_id")
        .select("doc_id", "toxic", "text")
        .mapInArrow(each, f"doc_id {kind}, toxic int, terms array<int>")
        .groupBy("doc_id", "toxic")
        .agg(F.min("terms").alias("terms"))
        .toArrow()
        .sort_by("doc_id")
    )
    lists = [np.asarray(x.values.to_numpy(zero_copy_only=False), np.int32) for x in rows.column("terms")]
    return fit(lists, (rows.column("toxic").to_numpy() > 0).astype(float))


def score(docs: DataFrame, machine: Machine, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """`_row`, `doc_id`, `held_out`, `score`, `predicted` of every row. A text without words, or null,
    gets the bias alone; a null id is not held out. Texts are scored whole, 128 at a time; repeated rows get the
    same score, a score of just 0.5 counts as toxic, no rows give none. Other columns are not read, whatever
    their names."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(machine)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(shared.value.score_texts(batch.column("text")), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("_row"), batch.column("doc_id"), found], ["_row", "doc_id", "score"])

    rows = numbered(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(each, f"_row long, doc_id {kind}, score double").select(
        "_row",
        "doc_id",
        F.coalesce(crc_fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, machine: Machine, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The documents not predicted toxic, with all their columns; one pass, nothing is joined."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(machine)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value.score_texts(batch.column(text)) < 0.5))

    return docs.mapInArrow(each, docs.schema)
