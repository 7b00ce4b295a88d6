"""Joining the sources on their shared key."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.operators.sizing import fits_broadcast
from freshet.operators.skew import find_hot_keys, salted_join
from freshet.sources.scan import scan_window


def with_suffixes(frames: Sequence[DataFrame], key: str) -> list[DataFrame]:
    """Rename same-named columns of later frames: `x`, then `x_2`, `x_3` by frame position."""
    taken: set[str] = set()
    renamed = []
    for position, df in enumerate(frames, start=1):
        mapping = {}
        for name in df.columns:
            if name != key and name in taken:
                fresh = f"{name}_{position}"
                while fresh in taken or fresh in df.columns:
                    fresh += "_"
                mapping[name] = fresh
        df = df.withColumnsRenamed(mapping)
        taken.update(df.columns)
        renamed.append(df)
    return renamed


def join_sources(
    frames: Sequence[DataFrame],
    key: str,
    how: str = "left",
    prefer: str = "left",
    hot_rows: int | None = None,
    large: bool | None = None,
) -> DataFrame:
    """Fold the frames into one by equi joins on `key`; null keys match nothing.

    Cut each frame by window and state before this: filtering the result is another query.
    Same-named columns of later frames get a suffix; `prefer="right"` keeps the last one's value
    under the plain name instead.

    With a right side too large to broadcast (`large` forces the choice), the rows of hot keys are
    split off and joined in pieces; see `freshet.operators.skew`.
    """
    if prefer not in ("left", "right"):
        raise ValueError(f"prefer must be 'left' or 'right', got {prefer!r}")
    frames = list(frames)
    renamed = with_suffixes(frames, key)
    shuffled = [large if large is not None else not fits_broadcast(df) for df in renamed[1:]]
    hot = None
    if any(shuffled):
        hot, hot_rows = find_hot_keys(renamed, key, hot_rows)
    if hot is None:
        joined = reduce(lambda left, right: left.join(right, key, how), renamed)
    else:
        joined = _split_join(renamed, key, how, shuffled, hot, hot_rows)
    if prefer == "right":
        joined = _last_wins(joined, frames, renamed, key)
    return joined


def _split_join(
    frames: list[DataFrame], key: str, how: str, shuffled: list[bool], hot: DataFrame, hot_rows: int
) -> DataFrame:
    """Rows of hot keys, and those without a key, are joined in pieces; all others plainly, with the
    one shuffle by key that serves every step."""
    keys, own = F.broadcast(hot.select("_hot_key")), F.col(f"`{key}`")
    cold = [df.filter(own.isNotNull()).join(keys, own == F.col("_hot_key"), "left_anti") for df in frames]
    joined = reduce(lambda left, right: left.join(right, key, how), cold)
    first, *others = frames
    hot_key = F.col("_hot_key")
    pieces = first.join(keys, own == hot_key, "left").filter(own.isNull() | hot_key.isNotNull()).drop("_hot_key")
    for step, df in enumerate(others, start=1):
        if shuffled[step - 1]:
            pieces = salted_join(pieces, df.join(keys, own == hot_key, "left_semi"), key, hot, step, how, hot_rows)
        else:
            pieces = pieces.join(df, key, how)
    return joined.unionByName(pieces)


def _last_wins(joined: DataFrame, frames: list[DataFrame], renamed: list[DataFrame], key: str) -> DataFrame:
    last = {}
    for original, fresh in zip(frames, renamed):
        last.update(zip(original.columns, fresh.columns))
    return joined.select(
        *[F.col(f"`{fresh}`").alias(name) for name, fresh in last.items()]
    )


def adhoc_inner(
    left: DataFrame, right: DataFrame, key: str, ts: str, cutoff: datetime | None, **options
) -> DataFrame:
    """Inner join of two sources, each cut by the window."""
    return join_sources(
        [scan_window(left, ts, cutoff), scan_window(right, ts, cutoff)], key, how="inner", **options
    )
