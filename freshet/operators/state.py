"""What has been processed already, and the rows that are new against it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.operators.sizing import fits_broadcast
from freshet.operators.skew import find_hot_keys, salted_anti_join
from freshet.session import ensure_checkpoint_dir

# Keys with something new are broadcast up to this number and size.
MAX_PENDING = 500_000
MAX_PENDING_BYTES = 64 * 2**20
# Beyond that, up to this number make a Bloom filter: at most 60 MB where it is broadcast.
MAX_FILTER_KEYS = 10_000_000
# Names that no source column has.
_KEY, _TS = "_freshet_state_key", "_freshet_state_ts"


def last_processed(target: DataFrame, key: str, ts: str, which: str = "latest") -> DataFrame:
    """One row per key with its latest (or oldest) write time, as `state_key`, `state_ts`."""
    if which not in ("latest", "oldest"):
        raise ValueError(f"which must be 'latest' or 'oldest', got {which!r}")
    pick = F.max if which == "latest" else F.min
    return target.groupBy(F.col(f"`{key}`").alias("state_key")).agg(pick(f"`{ts}`").alias("state_ts"))


def is_new(time: Column, processed: Column) -> Column:
    """The one rule of the filter: never processed, or updated later. A row without an update time
    is new only if its key was never processed."""
    return processed.isNull() | F.coalesce(time > processed, F.lit(False))


def all_pending(df: DataFrame, state: DataFrame, key: str, ts: str) -> tuple[DataFrame, int, int]:
    """The keys with a new row, and when they were processed last; how many, and their bytes.

    Both sides of the join hold one row per key and no text. Looked up right away and checkpointed.
    """
    ensure_checkpoint_dir(df.sparkSession)
    newest = df.groupBy(F.col(f"`{key}`").alias("_pending_key")).agg(F.max(f"`{ts}`").alias("_newest"))
    pending = (
        newest.join(state, F.col("_pending_key").eqNullSafe(F.col(_KEY)), "left")
        .filter(is_new(F.col("_newest"), F.col(_TS)))
        .select("_pending_key", F.col(_TS).alias("_pending_ts"))
        .checkpoint()
    )
    width = F.octet_length(F.to_json(F.struct("_pending_key"))) + 16
    size = pending.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("width")).first()
    return pending, size["n"], size["width"]


def pending_keys(df: DataFrame, state: DataFrame, key: str, ts: str, most: int) -> DataFrame | None:
    """The keys with a new row; None if more than `most` or too wide to broadcast."""
    if most < 1:
        return None
    pending, n, width = all_pending(df, state, key, ts)
    return pending if n <= most and width <= MAX_PENDING_BYTES else None


def _word_and_mask(key: Column, words: int) -> tuple[Column, Column]:
    """A key's place in a Bloom filter of 64-bit words, and its four bits there. Null is a key like any other."""
    bits = F.xxhash64(key, F.lit(1))
    mask = F.lit(0).cast("long")
    for i in range(4):
        at = F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63).cast("long")).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))
    return F.pmod(F.xxhash64(key), F.lit(words).cast("long")), mask


def bloom_filter(pending: DataFrame, n: int) -> tuple[DataFrame, int]:
    """A Bloom filter of the pending keys as a table of words, 16 bits for each key, and how many words it may
    have. All bits of a key are in one word, so a row is told by one lookup; of others some 2% pass."""
    words = max(1, -(-n * 16 // 64))
    word, mask = _word_and_mask(F.col("_pending_key"), words)
    return pending.select(word.alias("_word"), mask.alias("_mask")).groupBy("_word").agg(F.bit_or("_mask").alias("_bits")), words


def cut_by_filter(df: DataFrame, key: str, pending: DataFrame, n: int) -> DataFrame:
    """The rows of pending keys, and a few others, by a broadcast of less than 6 bytes for each key."""
    table, words = bloom_filter(pending, n)
    word, mask = _word_and_mask(F.col(f"`{key}`"), words)
    found = (word == F.col("_word")) & (F.col("_bits").bitwiseAND(mask) == mask)
    return df.join(F.broadcast(table), found, "left_semi")


def incremental_filter(
    df: DataFrame,
    state: DataFrame,
    key: str,
    ts: str,
    hot_rows: int | None = None,
    large: bool | None = None,
    max_pending: int = MAX_PENDING,
    max_filter: int = MAX_FILTER_KEYS,
    ids: Sequence[str] | None = None,
) -> DataFrame:
    """Rows whose key was never processed or whose update is later than that.

    An update at the very time of processing counts as done; a null key is a key like any other; a
    row without an update time is new only if its key was never processed. That holds whichever way
    is taken below.

    A state small enough to broadcast is. Otherwise (`large` forces the choice) the keys with
    something new are found first, from key and time alone. Few of them, as in a regular run, are
    broadcast and the rows are cut where they are read, without a shuffle. More of them, up to
    `max_filter`, cut the rows there by a Bloom filter, which lets few others pass. What is left, or with
    still more keys, as after a long break, all rows, is joined with the state by key, the hot keys in pieces by
    `ids`, the columns that tell rows apart (by default all of them).
    """
    if large is None:
        large = not fits_broadcast(state)
    state = state.select(F.col("state_key").alias(_KEY), F.col("state_ts").alias(_TS))
    own_key, time = F.col(f"`{key}`"), F.col(f"`{ts}`")
    done = ~is_new(time, F.col(_TS))
    if not large:
        return df.join(state, own_key.eqNullSafe(F.col(_KEY)) & done, "left_anti")

    if max_pending > 0:
        pending, n, width = all_pending(df, state, key, ts)
        if n <= max_pending and width <= MAX_PENDING_BYTES:
            new = own_key.eqNullSafe(F.col("_pending_key")) & is_new(time, F.col("_pending_ts"))
            return df.join(F.broadcast(pending), new, "left_semi")
        if n <= max_filter:
            df = cut_by_filter(df, key, pending, n)

    hot, hot_rows = find_hot_keys([df], key, hot_rows)
    if hot is not None:
        spread_by = None if ids is None else [key, ts, *ids]
        return salted_anti_join(df, state, key, _KEY, done, hot, hot_rows, spread_by)
    # Joined on the bare key, the rows stay partitioned by it for the joins to come. The null key
    # has one time at most.
    null_done = state.filter(F.col(_KEY).isNull()).select(_TS).scalar()
    kept = df.join(state, (own_key == F.col(_KEY)) & done, "left_anti")
    return kept.filter(own_key.isNotNull() | is_new(time, null_done))

