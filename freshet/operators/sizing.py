"""Decisions by planned size."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

_UNITS = {"": 1, "b": 1, "k": 2**10, "m": 2**20, "g": 2**30, "t": 2**40}


def planned_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate, the one `explain(mode="cost")` shows."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def read_bytes(df: DataFrame) -> int:
    """The planned size of what the frame is made from: the sum of its scans, after pruning.

    The optimizer takes the product of both sides for the size of a join, so decisions about a joined frame
    go by this."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def bytes_setting(df: DataFrame, name: str, default: str) -> int:
    setting = df.sparkSession.conf.get(name, default).lower()
    number, unit = re.fullmatch(r"(-?\d+)\s*([bkmgt]?)b?", setting).groups()
    return int(number) * _UNITS[unit]


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark itself would broadcast this frame by its planned size.

    Then the other side is not shuffled at all and no key can be hot.
    """
    return planned_bytes(df) <= bytes_setting(df, "spark.sql.autoBroadcastJoinThreshold", "10m")


def fits_task(df: DataFrame) -> bool:
    """Whether the whole frame is no larger than what AQE lets a single task have."""
    setting = "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"
    return planned_bytes(df) <= bytes_setting(df, setting, "256m")


def spread_small(df: DataFrame) -> DataFrame:
    """Spread an input over all cores ahead of costly work per row, if it has less than one full
    file split for each; a larger one comes in enough pieces and is not shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if read_bytes(df) >= cores * bytes_setting(df, "spark.sql.files.maxPartitionBytes", "128m"):
        return df
    return df.repartition(cores)


def scan_tasks(df: DataFrame) -> int:
    """About how many tasks the frame comes in, by what it is made from."""
    return -(-read_bytes(df) // bytes_setting(df, "spark.sql.files.maxPartitionBytes", "128m"))
