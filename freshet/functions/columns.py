"""Helpers for building column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed a single time, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)
