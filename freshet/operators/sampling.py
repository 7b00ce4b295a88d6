"""Exact-size uniform samples without replacement."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.operators.sizing import scan_tasks
from freshet.session import ensure_checkpoint_dir

# Up to this size the k smallest rows of every task are merged in one task, if all tasks together
# send it no more than MERGED_ROWS.
DIRECT_ROWS = 10_000
MERGED_ROWS = 1_000_000
_HASH_DIGITS = 15


def sample_hash(id_cols: Sequence[str], seed: int) -> Column:
    parts = [F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")) for name in id_cols]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts).cast("binary"))


def sample_exact(
    df: DataFrame,
    k: int,
    id_cols: Sequence[str],
    seed: int,
    direct_rows: int = DIRECT_ROWS,
    ties: Sequence[str] = (),
) -> DataFrame:
    """min(k, n) rows: those with the smallest seeded hash of `id_cols`, which must tell rows apart;
    where they do not, `ties` decide.

    The same seed gives the same rows however often the plan is run. A large k, or one of very many
    tasks, is cut without passing the sample through one task. Hashes are even, so a count of the rows is
    enough to name a hash below which lie a few more than k of them; those are kept, and only the few that are
    too many are ranked, from the top. Where the ids do not tell rows apart and less than k lie there, the
    hash is raised.
    """
    if k < 0:
        raise ValueError(f"k must not be negative, got {k}")
    if k == 0:
        return df.limit(0)
    hashed = df.withColumn("_hash", sample_hash(id_cols, seed))
    order = ["_hash", *[f"`{name}`" for name in (*id_cols, *ties)]]
    if k <= direct_rows and k * scan_tasks(df) <= MERGED_ROWS:
        return hashed.orderBy(*order).limit(k).drop("_hash")
    n = df.count()
    if n <= k:
        return df
    ensure_checkpoint_dir(df.sparkSession)
    share = (k + 6 * math.sqrt(k) + 20) / n
    while True:
        below = hashed if share >= 1 else hashed.filter(F.col("_hash") < hex_digits(share))
        below = below.checkpoint()
        spare = below.count() - k
        if spare >= 0:
            return _without_last(below, spare, order).drop("_hash")
        share *= 4


def hex_digits(share: float) -> str:
    """The hash below which that share of all hashes lies."""
    return f"{int(share * 16**_HASH_DIGITS):0{_HASH_DIGITS}x}"


def _without_last(rows: DataFrame, spare: int, order: list[str]) -> DataFrame:
    """The rows but for the `spare` last ones. The first of those is found by a top-k of its own; of rows
    that equal it in every ordered column, any will do."""
    if not spare:
        return rows
    place = F.struct(*[F.col(name).alias(str(i)) for i, name in enumerate(order)])
    last = rows.select(place.alias("place")).orderBy(F.desc("place")).limit(spare)
    # One row: the place to cut at, and how many of its copies are among the last.
    cut = F.broadcast(last.groupBy("place").agg(F.count(F.lit(1)).alias("_gone")).orderBy("place").limit(1).checkpoint())
    placed = rows.withColumn("_place", place)
    kept = placed.join(cut, F.col("_place") < F.col("place"), "left_semi")
    # Null-safe: an id may be null.
    equal = placed.join(cut, F.col("_place").eqNullSafe(F.col("place")), "left_semi")
    copies = equal.count() - cut.first()["_gone"]
    kept = kept.drop("_place")
    return kept.unionByName(equal.drop("_place").limit(copies)) if copies > 0 else kept


def random_seed() -> int:
    return random.getrandbits(63)


def sample_random(df: DataFrame, k: int, id_cols: Sequence[str]) -> DataFrame:
    """min(k, n) rows, others on every call. Drawn by a fresh seed, so that within one call a task
    run again after a failure still agrees with the rest."""
    return sample_exact(df, k, id_cols, random_seed())
