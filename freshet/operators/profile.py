"""Result profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.functions.times import iso_timestamp


def result_profile(df: DataFrame, order_by: list[str]) -> DataFrame:
    """Row count, column count and the first record by `order_by`, in one aggregate without a sort.

    The record's values are joined by commas, nulls left empty.
    """
    texts = []
    for field in df.schema:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            col = iso_timestamp(col, field.dataType)
        texts.append(F.coalesce(col.cast("string"), F.lit("")))
    first = F.min(F.struct(*[f"`{name}`" for name in order_by], F.concat_ws(",", *texts).alias("_record")))
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(df.columns)).cast("long").alias("column_count"),
        first.getField("_record").alias("first_record"),
    )
