"""Mixing sources to target weights by Sainte-Lague apportionment.

The mix takes 150% of all words, dealt to the sources by weight; no source gives more than twice its
words, and what one cannot give goes to the others by weight. The words come in blocks of equal size.
A source gets its number of blocks by highest quotients (target / 1, / 3, / 5, ...), and so does each
shard of it from the source's number. Within a shard the documents lie in a seeded order, a stream of
words; the shard gives whole passes over the stream and, for the rest of its quota, a run of blocks
that starts at a seeded one and wraps around. What whole blocks cannot give is dealt to the word: a source whose
target is all it may give gives all of it, and one with a target below a block gives a part of one.

A shard is a bounded share of one source by hash, so a source with most of the rows is spread over
many tasks. Rows go by their id, those of an id that very many rows have, or that have none, by their place in
the files as well. What reaches the driver is one row per source.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from freshet.llm.frames import WORD, materialise, numbered
from freshet.operators.skew import frequent_keys

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BLOCK = 16
SHARD_WORDS = 2**17
MAX_SHARDS = 2**20
OFTEN = 10_000


@dataclass(frozen=True)
class Recipe:
    """Weights of the sources in code point order (repeating), the share of all words to take, how
    often a word may be taken, words in a block, words in a shard (more where a source would have over
    `max_shards`), how many rows of one id stay together, and the seed of the order."""

    weights: Sequence[int] = WEIGHTS
    share: float = SHARE
    most: int = MOST
    block: int = BLOCK
    shard_words: int = SHARD_WORDS
    max_shards: int = MAX_SHARDS
    often: int = OFTEN
    seed: int = 11


def water_fill(capacities: Sequence[int], weights: Sequence[int], total: float) -> list[float]:
    """Shares of `total` by weight, none above its capacity, the excess shared by weight again.

    In the order of capacity by weight, each one that would get more than it can give is filled;
    from the first that would not, all share what is left by weight."""
    order = sorted(range(len(capacities)), key=lambda i: (capacities[i] / weights[i], i))
    given, room, open_weight = [0.0] * len(capacities), total, sum(weights)
    filled = 0
    for i in order:
        if room * weights[i] / open_weight < capacities[i]:
            break
        given[i] = float(capacities[i])
        room, open_weight, filled = room - capacities[i], open_weight - weights[i], filled + 1
    for i in order[filled:]:
        given[i] = room * weights[i] / open_weight
    return given


def sainte_lague(votes: Sequence[float], seats: int, most: Sequence[int]) -> list[int]:
    """Seats by highest quotients votes / (2 * have + 1), ties to the first, at most `most` each.

    A divisor gives nearly all seats at once, then all at its edge; what is left is dealt, or taken back, one by one.
    """
    votes, most = np.asarray(votes, dtype=float), np.asarray(most, dtype=np.int64)
    seats = min(int(seats), int(most[votes > 0].sum()))
    have = np.zeros(len(votes), dtype=np.int64)
    if seats <= 0:
        return have.tolist()
    low, high = 0.0, 1.0
    at = lambda f: np.minimum(np.floor(votes * f + 0.5).astype(np.int64), most)
    while at(high).sum() < seats:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (low, middle) if at(middle).sum() >= seats else (middle, high)
    have = np.where(votes > 0, at(low), 0)
    # Those at the divisor's edge, nearly or truly tied, by quotient and place: one more seat for as many as needed.
    edge = np.nonzero((votes > 0) & (at(high) > have))[0]
    edge = edge[np.argsort(-(votes[edge] / (2 * have[edge] + 1)), kind="stable")]
    have[edge[: max(0, seats - int(have.sum()))]] += 1
    while have.sum() > seats:
        last = np.where(have > 0, votes / np.maximum(2 * have - 1, 1), np.inf)
        have[len(votes) - 1 - int(np.argmin(last[::-1]))] -= 1
    while have.sum() < seats:
        have[int(np.argmax(np.where((have < most) & (votes > 0), votes / (2 * have + 1), -1.0)))] += 1
    return have.tolist()


def sizes(docs: DataFrame, text: str = "text", id_col: str = "doc_id", source: str = "source") -> DataFrame:
    rows = numbered(docs.select(F.col(id_col).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text")))
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    return rows.select("_row", "doc_id", "source", words.alias("size"))


def targets(totals: Sequence[tuple[str | None, int]], recipe: Recipe) -> list[tuple[str | None, int, float, int, bool, int]]:
    """(source, words, target, blocks, whether it gives all it may, words if below a block) of each source;
    Python orders strings by code point."""
    ranked = sorted(totals, key=lambda r: (r[0] is None, r[0] or ""))
    if not ranked:
        return []
    weights = [recipe.weights[i % len(recipe.weights)] for i in range(len(ranked))]
    most = [recipe.most * words for _, words in ranked]
    total = recipe.share * sum(words for _, words in ranked)
    wanted = water_fill(most, weights, total)
    full = [t >= m for t, m in zip(wanted, most, strict=True)]
    parts = [round(t) if t < recipe.block and not f else 0 for t, f in zip(wanted, full, strict=True)]
    # Blocks are dealt to the others, out of what those leave.
    votes = [0.0 if f or t < recipe.block else t for t, f in zip(wanted, full, strict=True)]
    left = total - sum(m for m, f in zip(most, full, strict=True) if f) - sum(parts)
    blocks = sainte_lague(votes, round(left / recipe.block), [m // recipe.block for m in most])
    return [(s, words, t, b, f, p) for (s, words), t, b, f, p in zip(ranked, wanted, blocks, full, parts, strict=True)]


def _hash(name: Column, seed: int, start: int) -> Column:
    """Eight hex digits of a seeded md5, as a number: any engine can compute it."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(name.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), start, 8), 16, 10).cast("long")


def mix(docs: DataFrame, recipe: Recipe = Recipe(), text: str = "text", id_col: str = "doc_id", source: str = "source") -> DataFrame:
    """One row per row of `docs`: `_row`, `doc_id`, `size`, `source_size`, `target`, `taken`, and where
    the words come from: `passes` over the whole text and the words [`first`, `first` + `length`)
    counted around the shard's stream, as the two pieces `head` and `tail` of [from, to) words.

    Null or empty texts have size 0 and give nothing; a null source is a source, the last. Repeated
    rows lie next to each other in the stream and are taken as what they are, words. A source without
    words has target 0. No rows in, no rows out. The same rows and seed give the same mix.
    """
    spark = docs.sparkSession
    rows = materialise(sizes(docs, text, id_col, source), "sizes")
    totals = [(r["source"], r["size"]) for r in rows.groupBy("source").agg(F.sum("size").alias("size")).collect()]
    kind = rows.schema["source"].dataType
    plan = spark.createDataFrame(
        targets(totals, recipe),
        T.StructType(
            [
                T.StructField("source", kind),
                T.StructField("source_size", T.LongType()),
                T.StructField("target", T.DoubleType()),
                T.StructField("blocks", T.LongType()),
                T.StructField("full", T.BooleanType()),
                T.StructField("part", T.LongType()),
            ]
        ),
    )
    often = [h for h, n in frequent_keys(rows, "doc_id").counts.items() if n > recipe.often]
    by_row = F.xxhash64("doc_id").isin(often) if often else F.lit(False)
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.when(by_row, F.concat(F.lit(":"), F.col("_row"))).otherwise(""))
    shard_words = F.greatest(F.lit(recipe.shard_words), F.ceil(F.col("source_size") / recipe.max_shards))
    shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words))
    placed = (
        rows.withColumnRenamed("source", "_source")
        .join(F.broadcast(plan), F.col("_source").eqNullSafe(F.col("source")))
        .withColumn("shard", (_hash(name, recipe.seed, 1) % shards).cast("long"))
        .withColumn("_order", _hash(name, recipe.seed, 9))
    )
    cells = placed.groupBy("source", "shard", "blocks", "full", "part").agg(F.sum("size").alias("cell"))
    block, most, seed = recipe.block, recipe.most, recipe.seed

    def deal(of_source: pd.DataFrame) -> pd.DataFrame:
        """A source's words over its shards: one row per shard, at most `max_shards`."""
        of_source = of_source.sort_values("shard", ignore_index=True)
        words, first = of_source["cell"].to_numpy(), of_source.iloc[0]
        if first["full"]:
            quota = words * most
        elif first["blocks"]:
            quota = np.array(sainte_lague(words, int(first["blocks"]), words * most // block)) * block
        else:
            quota = np.zeros(len(words), np.int64)
            quota[words.argmax()] = min(int(first["part"]), int(words.max()) * most)
        of_source["quota"] = quota
        return of_source[["source", "shard", "cell", "quota"]]

    quotas = materialise(
        cells.groupBy("source").applyInPandas(
            deal, T.StructType([T.StructField("source", kind), *[T.StructField(c, T.LongType()) for c in ("shard", "cell", "quota")]])
        ),
        "quotas",
    )
    stream = Window.partitionBy("source", "shard").orderBy("_order", "doc_id", "size", "_row")
    ended = placed.withColumn("_end", F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, 0)))
    joined = ended.alias("d").join(
        quotas.alias("q"), F.col("d.source").eqNullSafe(F.col("q.source")) & (F.col("d.shard") == F.col("q.shard"))
    )
    words, cell = F.col("quota"), F.col("cell")
    start = F.pmod(_hash(F.col("q.shard"), seed, 17), F.greatest(F.lit(1), F.floor(cell / block))) * block
    # The seeded run of `rest` words from `start`: [start, start + rest) and, wrapped, [0, ... - cell).
    return (
        joined.select("d._row", "d.doc_id", "d.size", "d.source_size", "d.target", (F.col("_end") - F.col("size")).alias("_begin"), "_end",
                      F.when(cell > 0, F.floor(words / cell)).otherwise(0).cast("long").alias("passes"),
                      F.when(cell > 0, words % cell).otherwise(0).alias("_rest"), start.alias("_start"), cell.alias("_cell"))
        .withColumn("head", _overlap(F.col("_start"), F.least(F.col("_start") + F.col("_rest"), F.col("_cell"))))
        .withColumn("tail", _overlap(F.lit(0), F.greatest(F.lit(0), F.col("_start") + F.col("_rest") - F.col("_cell"))))
        .withColumn("taken", F.col("passes") * F.col("size") + _length("head") + _length("tail"))
        .select("_row", "doc_id", "size", "source_size", "target", "taken", "passes", "head", "tail")
    )


def _overlap(first: Column, last: Column) -> Column:
    """The words of the document within [first, last) of the stream, counted from its own first."""
    begin = F.greatest(first, F.col("_begin")) - F.col("_begin")
    end = F.least(last, F.col("_end")) - F.col("_begin")
    return F.struct(begin.cast("long").alias("begin"), F.greatest(begin, end).cast("long").alias("end"))


def _length(piece: str) -> Column:
    return F.col(f"{piece}.end") - F.col(f"{piece}.begin")


def mixed_documents(docs: DataFrame, recipe: Recipe = Recipe(), text: str = "text", id_col: str = "doc_id", source: str = "source") -> DataFrame:
    """The mix itself: each document as often as it is taken whole, and once more, cut to its words
    taken, for each part. Same columns; a cut text's words are joined by single spaces."""
    taken = mix(docs, recipe, text, id_col, source).select(F.col("_row").alias("_mix_row"), "size", "passes", "head", "tail")
    taken = taken.withColumn(
        "_parts",
        F.concat(
            F.array_repeat(F.struct(F.lit(0).cast("long").alias("begin"), F.col("size").alias("end")), F.col("passes").cast("int")),
            F.filter(F.array("head", "tail"), lambda p: p["end"] > p["begin"]),
        ),
    ).filter((F.size("_parts") > 0) & (F.col("size") > 0))
    words = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(WORD), F.lit(0))
    cut = F.array_join(F.slice(words, F.col("_part.begin").cast("int") + 1, (F.col("_part.end") - F.col("_part.begin")).cast("int")), " ")
    whole = (F.col("_part.begin") == 0) & (F.col("_part.end") == F.col("_size"))
    out = (
        numbered(docs, "_mix_row")
        .join(taken.select("_mix_row", F.col("size").alias("_size"), F.explode("_parts").alias("_part")), "_mix_row")
        .withColumn(text, F.when(whole, F.col(f"`{text}`")).otherwise(cut))
    )
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(F.length(text)).cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])

