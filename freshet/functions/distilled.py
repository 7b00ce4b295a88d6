"""Native scorers learned from a model's own answers: once a model has answered some rows, a linear model of its
answers scores the others as a column expression, without a call.

A text is the square roots of its hashed words' shares, 2^BITS of them and a constant. Every number of an answer,
and every allowed value as a number of its own, is fitted by least squares with a small penalty; of the allowed
values the largest wins. The fit takes all answers but for a fifth, by a hash of the text,
that is held out; how far the scorer agrees with the model on those is reported with it. Tasks sum up the products of
their rows, and those sums are of one size whatever the input: no rows are brought together.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions.columns import once
from freshet.functions.models import Field, Model
from freshet.sinks.target import staged

BITS = 10
PENALTY = 0.1
_BLOCK = 1_000


def word_buckets(text: Column, bits: int = BITS) -> Column:
    """The sorted buckets of a text's words, one for each word."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.array_sort(F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(1 << bits).cast("long")).cast("int")))


def bucket_weights(text: Column, bits: int = BITS) -> Column:
    """An array of (bucket, square root of its share of the words)."""

    def runs(buckets: Column) -> Column:
        n = F.size(buckets)

        def shares(starts: Column) -> Column:
            ends = F.concat(F.slice(starts, F.lit(2), F.greatest(F.size(starts) - 1, F.lit(0))), F.array(n))
            return F.zip_with(
                starts,
                ends,
                lambda a, b: F.struct(F.get(buckets, a).alias("bucket"), F.sqrt((b - a) / n).alias("weight")),
            )

        places = F.filter(
            F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(buckets, i) != F.get(buckets, i - 1))
        )
        return F.when(n > 0, once(places, shares)).otherwise(F.array().cast("array<struct<bucket:int,weight:double>>"))

    return once(word_buckets(text, bits), runs)


def _numbers(model: Model) -> Iterable[tuple[str, Field, str | None]]:
    """What is fitted: a number of the answer, or whether a field has an allowed value."""
    for name, _, field in model.flat():
        if field.allowed:
            yield from ((name, field, value) for value in field.allowed)
        elif field.type in (float, int):
            yield name, field, None


@dataclass(frozen=True)
class Distilled:
    """A scorer of a model's answers, for `Native`. `agreement` says how often each allowed value, and how nearly each
    number (mean absolute error), is the model's own on answers that were held out."""

    model: Model
    weights: tuple[tuple[float, ...], ...]
    agreement: dict[str, float]
    bits: int = BITS

    def __call__(self, text: Column) -> Column:
        """The model's answer as a struct. A text field, which no number tells, lists the chosen values."""
        # One constant for all weights, a row for each number; folded before the query runs.
        table = F.from_json(F.lit(json.dumps(self.weights)), "array<array<double>>")

        def numbers(words: Column) -> Column:
            def number(row: Column) -> Column:
                start = F.element_at(row, -1)
                return F.aggregate(words, start, lambda total, w: total + F.get(row, w.getField("bucket")) * w.getField("weight"))

            return F.transform(table, number)

        return once(once(bucket_weights(text, self.bits), numbers), self._answer)

    def _answer(self, numbers: Column) -> Column:
        at = {(name, value): F.get(numbers, F.lit(i)) for i, (name, _, value) in enumerate(_numbers(self.model))}
        chosen: list[Column] = []

        def value(name: str, field: Field) -> Column:
            if field.allowed:
                ranked = [F.struct(at[name, v].alias("n"), F.lit(v).alias("v")) for v in field.allowed]
                chosen.append((F.greatest(*ranked) if len(ranked) > 1 else ranked[0]).getField("v"))
                return chosen[-1]
            if (name, None) in at:
                return F.round(at[name, None], 6).cast(field.spark_type())
            return F.concat_ws("; ", *chosen).cast(field.spark_type())

        parts = []
        for field in self.model.fields:
            if field.fields:
                group = [value(f"{field.name}.{f.name}", f).alias(f.name) for f in field.fields]
                parts.append(F.struct(*group).alias(field.name))
            else:
                parts.append(value(field.name, field).alias(field.name))
        return F.struct(*parts)


def _dense(buckets: Iterable[list[int]], bits: int) -> np.ndarray:
    rows = list(buckets)
    out = np.zeros((len(rows), (1 << bits) + 1))
    out[:, -1] = 1
    for i, row in enumerate(rows):
        if len(row):
            out[i, :-1] = np.sqrt(np.bincount(row, minlength=1 << bits) / len(row))
    return out


def _blocks(batches: Iterator[pa.RecordBatch], bits: int, held: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rows that are held out, or the others, as dense blocks with what is wanted of them."""
    for batch in batches:
        batch = batch.filter(pa.array(batch.column("_held").to_numpy(zero_copy_only=False) == held))
        for at in range(0, batch.num_rows, _BLOCK):
            block = batch.slice(at, _BLOCK)
            goal = [block.column(i).to_numpy(zero_copy_only=False) for i in range(2, block.num_columns)]
            yield _dense(block.column("_buckets").to_pylist(), bits), np.stack(goal, axis=1)


def _products(rows: DataFrame, wanted: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The sums of the products of all rows that are not held out, with each other and with what is wanted: by task,
    then over the tasks, each row of the matrix by itself."""
    size, schema = (1 << bits) + 1, "i int, sums array<double>"

    def by_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + wanted))
        for x, goal in _blocks(batches, bits, False):
            total += x.T @ np.concatenate([x, goal], axis=1)
        if total.any():
            sums = pa.array(total.tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), sums], ["i", "sums"])

    def over_tasks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for frame in frames:
            for i, row in zip(frame["i"], frame["sums"], strict=True):
                sums[i] = sums[i] + row if i in sums else np.array(row)
        if sums:
            yield pd.DataFrame({"i": list(sums), "sums": list(sums.values())})

    added = rows.mapInArrow(by_task, schema).repartition("i").mapInPandas(over_tasks, schema).toArrow()
    total = np.zeros((size, size + wanted))
    for i, row in zip(added.column("i").to_pylist(), added.column("sums").to_pylist(), strict=True):
        total[i] = row
    return total[:, :size], total[:, size:]


def _agreement(rows: DataFrame, weights: np.ndarray, wanted: list[tuple[str, str | None]], bits: int) -> dict[str, float]:
    """On the rows held out, by field: how often the largest allowed value is the model's, or how far a number is off."""
    places: dict[str, list[int]] = {}
    for i, (name, _) in enumerate(wanted):
        places.setdefault(name, []).append(i)

    def by_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0.0] * len(places)
        for x, goal in _blocks(batches, bits, True):
            guess, n = x @ weights, n + len(x)
            for k, at in enumerate(places.values()):
                told, true = guess[:, at], goal[:, at]
                chosen = wanted[at[0]][1] is not None
                sums[k] += float((told.argmax(axis=1) == true.argmax(axis=1)).sum() if chosen else np.abs(told - true).sum())
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([sums], pa.list_(pa.float64()))], ["n", "sums"])

    told = rows.mapInArrow(by_task, "n long, sums array<double>")
    total = told.agg(F.sum("n"), *[F.sum(F.get("sums", F.lit(k))) for k in range(len(places))]).first()
    return {name: total[k + 1] / total[0] if total[0] else float("nan") for k, name in enumerate(places)}


def distil(answers: DataFrame, text: str, model: Model, bits: int = BITS) -> Distilled:
    """Learn from valid answers, all of them: the text each was given for beside the model's flat columns.

    Rows without an answer are left out, null texts count as empty ones. With no answers every number is 0."""
    wanted = [(name, value) for name, _, value in _numbers(model)]
    names = list(dict.fromkeys(name for name, _ in wanted))
    rows = answers.select(F.col(f"`{text}`").alias("_text"), *[F.col(f"`{n}`").alias(str(i)) for i, n in enumerate(names)])
    rows = rows.dropna(subset=[str(i) for i in range(len(names))])
    field = {name: F.col(str(i)) for i, name in enumerate(names)}
    goals = [field[n] if v is None else field[n] == v for n, v in wanted]
    held = F.pmod(F.xxhash64("_text"), F.lit(5)) == 0
    rows = rows.select(
        word_buckets(F.col("_text"), bits).alias("_buckets"), held.alias("_held"),
        *[goal.cast("double").alias(f"_goal_{i}") for i, goal in enumerate(goals)],
    )
    size = (1 << bits) + 1
    # Read twice below, while a model is not to be asked twice.
    with staged(rows) as rows:
        gram, moment = _products(rows, len(wanted), bits)
        gram[np.arange(size - 1), np.arange(size - 1)] += PENALTY
        # Without any answer the constant's equation would be empty.
        gram[-1, -1] += 1e-9
        weights = np.linalg.solve(gram, moment)
        agreement = _agreement(rows, weights, wanted, bits)
    return Distilled(model, tuple(tuple(np.round(w, 9).tolist()) for w in weights.T), agreement, bits)
