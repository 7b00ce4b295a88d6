"""Runs that survive a lost executor or driver: stages written for good, model calls in waves.

A run has a folder. Each of its stages is written once and marked when whole; a run started again under
the same folder reads what is there and goes on behind it. Calls to a model are made wave by wave: the
answers of one wave are in the folder before the next begins, so that after a failure only the wave under way is
asked again, and of that only what no finished task had answered. Where the model is so fast that waves would be
mostly Spark's own start of a job, several are asked together: no more than a quarter of those answered before,
and no more than take about half a minute.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.operators.scoring import TASK_BYTES, Retry, call_tasks, score_at_once
from freshet.operators.sizing import planned_bytes
from freshet.operators.skew import hashable
from freshet.sinks.target import empty_folder
from freshet.sources.scan import load_table

# Requests of a wave.
WAVE_ROWS = 5_000
# Fast waves are asked together, for about so many seconds.
WAVE_SECONDS = 30
REQUEST = "_request"


class RunFolder:
    """The stages of one run below a folder that all executors share. One that nobody will come back to
    (`lasting` false) does without marks."""

    def __init__(self, spark: SparkSession, path: str, lasting: bool = True):
        self.spark = spark
        self.path = path.rstrip("/")
        self.lasting = lasting

    def place(self, name: str) -> str:
        return f"{self.path}/{name}"

    def _mark(self, name: str) -> str:
        return self.place(f"{name}.whole")

    def has(self, name: str) -> bool:
        return self.lasting and load_table(self.spark, path=self._mark(name)) is not None

    def once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The stage as it was written first. A part of one, left by a failure, is written anew."""
        if self.has(name):
            return self.spark.read.parquet(self.place(name))
        made = make()
        made.write.mode("overwrite").parquet(self.place(name))
        if self.lasting:
            self.spark.range(0, 1, 1, 1).write.mode("overwrite").parquet(self._mark(name))
        return self.spark.read.schema(made.schema).parquet(self.place(name))

    def clear(self, *names: str) -> None:
        """Empty the stages: their marks first, so that none is ever taken for whole."""
        for name in names:
            for path in (self._mark(name), self.place(name)):
                if load_table(self.spark, path=path) is not None:
                    empty_folder(self.spark, path)


def request_id(df: DataFrame, columns: Sequence[str], payload: str | None = None) -> Column:
    """What tells requests apart: the given columns' values and the payload. Rows that agree in all are one
    request."""
    told = [F.col(f"`{f.name}`").alias(str(i)) for i, f in enumerate(df.schema) if f.name in columns and hashable(f.dataType)]
    text = F.to_json(F.struct(*told)) if told else F.lit("{}")
    if payload is not None:
        text = F.concat(text, F.coalesce(f"`{payload}`", F.lit("\0")))
    return F.sha2(text.cast("binary"), 256)


def ask_in_waves(
    requests: DataFrame,
    completer: Callable[[str, str], str | None],
    prompt: str,
    folder: RunFolder,
    workers: int = 1,
    retry: Retry = Retry(),
    payload: str = "payload",
    wave_rows: int = WAVE_ROWS,
) -> DataFrame:
    """`score_with` over stored requests (with a column `_request`), resumable: `content` and `error` added,
    request and payload dropped.

    Answers, failed calls among them, are kept by request in the folder; those there are not asked for again.
    The rest is dealt into waves of about `wave_rows` requests by a hash, each, or several fast ones, a Spark job
    of its own with at most `workers` calls in flight. A request of several rows is asked once.
    """
    spark, place = requests.sparkSession, folder.place("answers")
    schema = f"{REQUEST} string, content string, error string"

    def answers() -> DataFrame | None:
        return None if load_table(spark, path=place) is None else spark.read.schema(schema).parquet(place)

    known = answers()
    left = requests.select(REQUEST, F.col(f"`{payload}`").alias("payload"))
    if known is not None:
        left = left.join(known.select(REQUEST), REQUEST, "left_anti")
    left = left.dropDuplicates([REQUEST])
    waves = max(1, -(-left.count() // wave_rows))
    if waves > 1:
        # Each wave then reads its own files only.
        dealt = left.withColumn("wave", F.pmod(F.xxhash64(REQUEST), F.lit(waves))).repartition("wave")
        dealt.write.mode("overwrite").partitionBy("wave").parquet(folder.place("dealt"))
        dealt = spark.read.schema(dealt.schema).parquet(folder.place("dealt"))
        most = waves * call_tasks(requests, workers) * TASK_BYTES // max(1, planned_bytes(dealt))
    done, together = 0, 1
    while done < waves:
        began = time.monotonic()
        rows = left if waves == 1 else dealt.filter(F.col("wave").between(done, done + together - 1)).drop("wave")
        score_at_once(rows, completer, prompt, "payload", workers, retry).write.mode("append").parquet(place)
        done += together
        if done < waves:
            quick = int(together * WAVE_SECONDS / max(time.monotonic() - began, 0.001))
            together = max(1, min(done // 4, quick, most))
    # A wave that was cut short, then asked again, may have left an answer twice: the one of a call that went well.
    best = (
        answers()
        .groupBy(REQUEST)
        .agg(F.min(F.struct(F.col("error").isNotNull().alias("failed"), "content", "error")).alias("answer"))
    )
    return requests.drop(payload).join(best, REQUEST).select(
        *[f"`{name}`" for name in requests.columns if name not in (payload, REQUEST)], "answer.content", "answer.error"
    )
