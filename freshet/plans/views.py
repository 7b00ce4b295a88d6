"""The test tables in the parts the jobs expect: posts, reactions, a third source, a target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

T0 = "2024-01-01 00:00:00"


def _hours_after_t0(hours: Column) -> Column:
    return F.lit(T0).cast("timestamp_ntz") + F.make_interval(hours=hours.cast("int"))


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "orders")


def as_posts(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").alias("post_key"),
        _hours_after_t0(F.col("doc_id") % 720).alias("last_update_time"),
        F.col("source").alias("post_type"),
        "lang",
        F.col("text").alias("post_message"),
        "n_chars",
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_posts(_read(spark, sf_dir, "documents"))


def reactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many per post, some without a key."""
    return events(spark, sf_dir).select(
        F.when(F.col("event_id") % 97 != 0, F.col("user_id")).alias("post_key"),
        "event_id",
        F.col("ts").alias("last_update_time"),
        "event_type",
        "value",
    )


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("post_key"),
        _hours_after_t0((F.col("doc_id") * 7) % 720).alias("last_update_time"),
        "quality",
        "toxic",
    )


def quality_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`quality` as of a month earlier: nothing in it falls into January."""
    early = F.col("last_update_time") - F.make_interval(hours=F.lit(720))
    return quality(spark, sf_dir).withColumn("last_update_time", early)


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target with two write times per key."""
    labels = _read(spark, sf_dir, "labels")

    def written(factor: int) -> DataFrame:
        return labels.select(
            F.col("doc_id").alias("post_key"), _hours_after_t0((F.col("doc_id") * factor) % 720).alias("written_at")
        )

    return written(13).union(written(31))


def processed_nullkey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`processed` with the keys of one in 50 rows lost, so that the null key is in the state."""
    return processed(spark, sf_dir).withColumn(
        "post_key", F.when(F.col("post_key") % 50 != 0, F.col("post_key"))
    )


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model answer per event, good and bad in turn, and some failed calls."""
    v = F.col("value").cast("string")

    def text(*parts: str | Column) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    kinds = [
        text('{"score":', v, ',"sentiment":"positive","confidence":0.9}'),
        F.lit(""),
        text("not json ", F.col("event_type")),
        F.lit("[]"),
        F.lit("{}"),
        text('{"":', v, "}"),
        text('{"score":"', v, '","sentiment":"positive","confidence":0.9}'),
        text('{"score":', v, "}"),
        F.lit(None).cast("string"),
        v,
        text('{"score":', v),
        text('{"score":', v, ',"sentiment":"', F.col("event_type"), '","confidence":0.9}'),
        text('{"score":', v, ',"sentiment":"neutral","confidence":0.25,"extra":true}'),
        text('{"score":', v, ',"sentiment":"neutral","confidence":0.25} as asked'),
        text('{"score":null,"sentiment":"neutral","confidence":', v, "}"),
        text(' {"confidence":0.5,"sentiment":"negative","score":-', v, "}\n"),
    ]
    content = F.lit(None).cast("string")
    for i, kind in enumerate(kinds):
        content = F.when(F.col("event_id") % len(kinds) == i, kind).otherwise(content)
    error = F.when(F.col("event_id") % 17 == 0, text("refused: ", F.col("event_type")))
    return events(spark, sf_dir).select("event_id", content.alias("content"), error.alias("error"))
