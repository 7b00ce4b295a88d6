"""Joins on keys of which a few may hold a large share of the rows.

A hash shuffle sends all rows of one key to one task. Before joining two large frames, the keys
with more than `hot_rows` rows (by default what is 256 MB of the widest side) are found in one look at the key
column: every task sends a small sketch of its most frequent keys on, and no key is shuffled. Only the few keys
that may be hot by their sketches, if any, are then counted exactly. Where there are none, the join is a plain
one. Otherwise their rows are cut into pieces: each side spreads its own rows over its own number of pieces and
repeats them for every piece of the other side, so that each pair of rows still meets exactly once.

The list of hot keys is checkpointed and broadcast. A sketch follows `TRACKED` keys, whatever the data; a key
that escapes one holds less than 1/1,000 of that frame's rows, and its rows are joined whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.operators.sizing import read_bytes
from freshet.session import ensure_checkpoint_dir

# Keys a sketch follows, and tasks that merge the sketches before the last one does.
TRACKED = 4096
MERGERS = 64
# A key is hot by default if its rows take more than this, or are more than HOT_ROWS.
HOT_BYTES = 256 * 2**20
HOT_ROWS = 1_000_000
FEWEST_HOT_ROWS = 1_000


@dataclass(frozen=True)
class Frequent:
    """The rows of a frame, and the hashes of its most frequent keys with no less than their rows. A key that is not
    listed has at most `unlisted`."""

    rows: int
    counts: dict[int, int]
    unlisted: int


def frequent_keys(df: DataFrame, key: str, tracked: int = TRACKED) -> Frequent:
    """In one pass over the key column: sketches of frequent items per task, merged in two steps. Keys go by
    their hash, so any type will do."""
    of = F.call_function
    sketches = (
        df.select(F.xxhash64(f"`{key}`").alias("h"))
        .groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGERS)))
        .agg(F.count(F.lit(1)).alias("n"), of("approx_top_k_accumulate", F.col("h"), F.lit(tracked)).alias("s"))
    )
    found = (
        # Grouped by a constant, no rows give no row instead of an error.
        sketches.groupBy(F.lit("all"))
        .agg(F.sum("n").alias("n"), of("approx_top_k_combine", F.col("s"), F.lit(tracked)).alias("s"))
        .select("n", of("approx_top_k_estimate", F.col("s"), F.lit(tracked)).alias("top"))
        .first()
    )
    if found is None:
        return Frequent(0, {}, 0)
    counts = {item["item"]: item["count"] for item in found["top"]}
    # Counts are exact as long as all keys fit; else they may be too high, by what the smallest ones show.
    return Frequent(found["n"], counts, min(counts.values()) if len(counts) >= tracked // 2 else 0)


def default_hot_rows(frames: Sequence[DataFrame], rows: Sequence[int] | None = None) -> int:
    """How many rows of the widest frame make HOT_BYTES, by the size of its scans and its rows, counted if
    they are not known."""
    if rows is None:
        counted = [df.agg(F.count(F.lit(1)).alias("n"), F.lit(i).alias("i")) for i, df in enumerate(frames)]
        by_frame = {r["i"]: r["n"] for r in reduce(DataFrame.union, counted).collect()}
        rows = [by_frame[i] for i in range(len(frames))]
    widest = max(read_bytes(df) / max(1, n) for df, n in zip(frames, rows))
    return int(min(HOT_ROWS, max(FEWEST_HOT_ROWS, HOT_BYTES / max(widest, 1))))


def candidates(found: Sequence[Frequent], hot_rows: int) -> list[int]:
    """Hashes of listed keys that may have more than `hot_rows` rows in a frame or in the join of the first i."""
    hot = []
    for h in set().union(*[f.counts for f in found]):
        most = [f.counts.get(h, f.unlisted) for f in found]
        joined, largest = 1, 0
        for n in most:
            joined *= max(n, 1)
            largest = max(largest, n, joined)
        if largest > hot_rows:
            hot.append(h)
    return hot


def find_hot_keys(
    frames: Sequence[DataFrame], key: str, hot_rows: int | None = None, tracked: int = TRACKED
) -> tuple[DataFrame | None, int]:
    """Keys with more than `hot_rows` rows in a frame or in the join of the first i frames, None if there are none,
    and what `hot_rows` is. Found right away and checkpointed.

    Columns: `_hot_key`, `_rows_i` (rows of frame i) and `_joined_i` (rows after joining frames 0..i), exact.
    """
    found = [frequent_keys(df, key, tracked) for df in frames]
    if hot_rows is None:
        hot_rows = default_hot_rows(frames, [f.rows for f in found])
    maybe = candidates(found, hot_rows)
    if not maybe:
        return None, hot_rows
    spark = frames[0].sparkSession
    ensure_checkpoint_dir(spark)
    hashes = F.broadcast(spark.createDataFrame([(h,) for h in maybe], "_maybe long"))
    tagged = reduce(
        DataFrame.union,
        [
            df.select(F.col(f"`{key}`").alias("_hot_key"), F.lit(i).alias("_frame")).join(
                hashes, F.xxhash64("_hot_key") == F.col("_maybe"), "left_semi"
            )
            for i, df in enumerate(frames)
        ],
    )
    counts = tagged.groupBy("_hot_key").agg(
        *[F.count_if(F.col("_frame") == i).alias(f"_rows_{i}") for i in range(len(frames))]
    )
    joined = F.lit(1.0)
    sizes = []
    for i in range(len(frames)):
        joined = joined * F.greatest(F.col(f"_rows_{i}"), F.lit(1))
        sizes.append(joined.alias(f"_joined_{i}"))
    counts = counts.select("*", *sizes)
    largest = F.greatest(
        *[F.col(f"{name}_{i}").cast("double") for name in ("_rows", "_joined") for i in range(len(frames))],
        F.lit(0.0),
    )
    hot = counts.filter(largest > hot_rows).checkpoint()
    return (None if hot.isEmpty() else hot), hot_rows


def hot_keys(frames: Sequence[DataFrame], key: str, hot_rows: int) -> DataFrame | None:
    return find_hot_keys(frames, key, hot_rows)[0]


def hashable(dtype: T.DataType) -> bool:
    """Whether a value can be hashed: nothing in it, at any depth, is a map or variant."""
    if isinstance(dtype, (T.MapType, T.VariantType)):
        return False
    if isinstance(dtype, T.ArrayType):
        return hashable(dtype.elementType)
    return not isinstance(dtype, T.StructType) or all(hashable(f.dataType) for f in dtype)


def row_hash(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """A hash of the row's values (or of some columns): unlike a random salt it comes out the same
    when a lost task is run again. Copies of a row stay together unless a column numbers them
    (`Source.number`). Only what is hashed has to be read for it."""
    used = [f for f in df.schema if (columns is None or f.name in columns) and hashable(f.dataType)]
    return F.xxhash64(*[f"`{f.name}`" for f in used]) if used else F.lit(0).cast("long")


def _pieces(rows: Column, hot_rows: int) -> Column:
    return F.coalesce(F.ceil(rows / F.lit(float(hot_rows))), F.lit(1)).cast("long")


def _each(pieces: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1))


def salted_join(
    left: DataFrame, right: DataFrame, key: str, hot: DataFrame, step: int, how: str, hot_rows: int
) -> DataFrame:
    """`left.join(right, key, how)` for how = left or inner, with the hot keys in pieces.

    `left` holds the join of frames 0..step-1 and `right` frame `step` of those `hot` was made
    from.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type: {how!r}")
    pieces = F.broadcast(
        hot.select(
            "_hot_key",
            _pieces(F.col(f"_joined_{step - 1}"), hot_rows).alias("_left_pieces"),
            _pieces(F.greatest(F.col(f"_rows_{step}"), F.lit(1)), hot_rows).alias("_right_pieces"),
        )
    )

    def with_pieces(df: DataFrame) -> DataFrame:
        sized = df.withColumn("_row_hash", row_hash(df)).join(pieces, F.col(f"`{key}`") == F.col("_hot_key"), "left")
        one = F.lit(1).cast("long")
        return sized.withColumns({n: F.coalesce(n, one) for n in ("_left_pieces", "_right_pieces")})

    helpers = ("_hot_key", "_row_hash", "_left_pieces", "_right_pieces")
    # Null keys match nothing; left where they are they would all meet in one task.
    own = F.when(F.col(f"`{key}`").isNull(), F.col("_row_hash")).otherwise(F.pmod("_row_hash", "_left_pieces"))
    lhs = (
        with_pieces(left)
        .withColumn("_left_piece", own)
        .withColumn("_right_piece", _each(F.col("_right_pieces")))
        .withColumn("_split", F.col("_right_pieces") > 1)
        .drop(*helpers)
    )
    rhs = (
        with_pieces(right.filter(F.col(f"`{key}`").isNotNull()))
        .withColumn("_right_piece", F.pmod("_row_hash", "_right_pieces"))
        .withColumn("_left_piece", _each(F.col("_left_pieces")))
        .withColumn("_matched", F.lit(True))
        .drop(*helpers)
    )
    joined = lhs.join(rhs, [key, "_left_piece", "_right_piece"], how)
    if how == "left":
        # A key cut on the right is there on the right, so each of its left rows has a match in
        # some piece; the pieces without one are copies to drop.
        joined = joined.filter(~F.col("_split") | F.col("_matched").isNotNull())
    return joined.drop("_left_piece", "_right_piece", "_split", "_matched")


def salted_anti_join(
    df: DataFrame,
    state: DataFrame,
    key: str,
    state_key: str,
    condition: Column,
    hot: DataFrame,
    hot_rows: int,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of `df` without a state row of the same key (null equals null) under `condition`.

    `hot` holds the hot keys of `df`. `state` has one row per key, so repeating it for the pieces of
    a hot key is cheap. `spread_by` names the columns that tell rows apart, by default all of them.
    """
    pieces = F.broadcast(hot.select("_hot_key", _pieces(F.col("_rows_0"), hot_rows).alias("_pieces")))
    one = F.lit(1).cast("long")
    lhs = (
        df.withColumn("_row_hash", row_hash(df, spread_by))
        .join(pieces, F.col(f"`{key}`").eqNullSafe(F.col("_hot_key")), "left")
        .withColumn("_left_piece", F.pmod("_row_hash", F.coalesce("_pieces", one)))
        .drop("_hot_key", "_row_hash", "_pieces")
    )
    rhs = (
        state.join(pieces, F.col(state_key).eqNullSafe(F.col("_hot_key")), "left")
        .withColumn("_state_piece", _each(F.coalesce("_pieces", one)))
        .drop("_hot_key", "_pieces")
    )
    on = F.col(f"`{key}`").eqNullSafe(F.col(state_key)) & (F.col("_left_piece") == F.col("_state_piece")) & condition
    return lhs.join(rhs, on, "left_anti").drop("_left_piece")
