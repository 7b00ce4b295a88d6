"""Column choice and row order."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def included(columns: list[str], include: Collection[str]) -> list[str]:
    """Record order, not list order; unknown names are ignored."""
    return [name for name in columns if name in include]


def project_include(df: DataFrame, include: Collection[str]) -> DataFrame:
    return df.select(*[f"`{name}`" for name in included(df.columns, include)])


def project_exclude(df: DataFrame, exclude: Collection[str]) -> DataFrame:
    return df.select(*[f"`{name}`" for name in df.columns if name not in exclude])


def recent_first(df: DataFrame, ts: str, *ties: str) -> DataFrame:
    return df.orderBy(F.col(ts).desc_nulls_last(), *ties)
