"""When each key was processed, kept beside a target, so that a run need not read the whole of it.

One row per key (`base`) and, for each append since, the keys it wrote (`deltas`). A delta is written before its
run is committed and counts with it. Every `COMPACT_EVERY` runs a new base is made of the last one and the deltas;
an append that started before that may still write to the previous epoch, which is read on until the next base.
All of it can be made again from the target (`rebuild`).
"""

from __future__ import annotations

from datetime import datetime
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions.times import ts_literal
from freshet.sources.scan import load_table

if TYPE_CHECKING:
    from freshet.sinks.target import Target

COMPACT_EVERY = 50


class KeptState:
    def __init__(self, target: Target):
        if target.runs is None:
            raise ValueError("a kept state needs a target with a table of runs")
        self.target = target
        self.path = f"{target.runs.rstrip('/')}-state"

    def _place(self, name: str) -> str:
        return f"{self.path}/{name}"

    def epoch(self, spark: SparkSession) -> int:
        """The number of the newest base that is whole; 0 before the first."""
        place = self._place("bases")
        if load_table(spark, path=place) is None:
            return 0
        return spark.read.schema("epoch int").parquet(place).agg(F.max("epoch")).first()[0] or 0

    def add(self, batch: DataFrame, now: datetime, attempt: str) -> None:
        """The keys of an append under way."""
        keys = batch.select(F.col(f"`{self.target.key}`").alias("state_key")).distinct()
        delta = keys.select(
            "state_key", ts_literal(now).alias("at"), F.lit(attempt).alias("attempt"),
            F.lit(self.epoch(batch.sparkSession)).alias("epoch"),
        )
        delta.write.mode("append").partitionBy("epoch").parquet(self._place("deltas"))

    def _deltas(self, spark: SparkSession, epoch: int) -> DataFrame | None:
        """Committed ones that the base of the epoch does not hold."""
        deltas, commits = load_table(spark, path=self._place("deltas")), self.target.commits(spark)
        if deltas is None or commits is None:
            return None
        deltas = deltas.filter(F.col("epoch") >= epoch - 1).join(commits.select("attempt"), "attempt", "left_semi")
        held = load_table(spark, path=self._place(f"held-{epoch}")) if epoch else None
        return deltas if held is None else deltas.join(held, "attempt", "left_anti")

    def _times(self, spark: SparkSession, epoch: int, deltas: DataFrame | None) -> DataFrame | None:
        parts = []
        if epoch:
            parts.append(spark.read.parquet(self._place(f"base-{epoch}")))
        if deltas is not None:
            parts.append(deltas.select("state_key", F.col("at").alias("latest"), F.col("at").alias("oldest")))
        if not parts:
            return None
        every = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return every.groupBy("state_key").agg(F.max("latest").alias("latest"), F.min("oldest").alias("oldest"))

    def load(self, spark: SparkSession, which: str = "latest", cutoff: datetime | None = None) -> DataFrame | None:
        """`last_processed` of the target from the cut-off on, as `state_key` and `state_ts`; None where the
        target has no rows. With a cut-off only the latest times can be told."""
        if which == "oldest" and cutoff is not None:
            raise ValueError("the oldest time behind a cut-off is not kept")
        epoch = self.epoch(spark)
        times = self._times(spark, epoch, self._deltas(spark, epoch))
        if times is None:
            return None
        times = times.select("state_key", F.col(which).alias("state_ts"))
        return times if cutoff is None else times.filter(F.col("state_ts") >= ts_literal(cutoff))

    def compact(self, spark: SparkSession, least: int = COMPACT_EVERY) -> bool:
        """A new base, if `least` runs or more have been committed since the last one."""
        epoch = self.epoch(spark)
        deltas = self._deltas(spark, epoch)
        if deltas is None:
            return False
        if deltas.select("attempt").distinct().count() < least:
            return False
        held = self._hold(spark, epoch + 1, deltas)
        self._write(epoch + 1, self._times(spark, epoch, deltas.join(held, "attempt", "left_semi")))
        return True

    def _hold(self, spark: SparkSession, epoch: int, deltas: DataFrame) -> DataFrame:
        """Fix which runs a base will hold: one committed from now on stays a delta."""
        place = self._place(f"held-{epoch}")
        deltas.select("attempt").distinct().write.mode("overwrite").parquet(place)
        return spark.read.schema("attempt string").parquet(place)

    def rebuild(self, spark: SparkSession) -> None:
        """A new base from the target's rows. Runs committed meanwhile may be in both; their times are the same."""
        epoch = self.epoch(spark)
        rows, deltas = self.target.load(spark), self._deltas(spark, epoch)
        if rows is None:
            return
        time = F.col(f"`{self.target.ts}`")
        times = rows.groupBy(F.col(f"`{self.target.key}`").alias("state_key")).agg(
            F.max(time).alias("latest"), F.min(time).alias("oldest")
        )
        if deltas is not None:
            self._hold(spark, epoch + 1, deltas)
        self._write(epoch + 1, times)

    def _write(self, epoch: int, times: DataFrame) -> None:
        times.write.mode("overwrite").parquet(self._place(f"base-{epoch}"))
        named = times.sparkSession.createDataFrame([(epoch,)], "epoch int")
        named.coalesce(1).write.mode("append").parquet(self._place("bases"))

    def places(self, spark: SparkSession) -> list[str]:
        """The folders in use, the one that names the bases first."""
        epoch = self.epoch(spark)
        return [self._place(n) for n in ("bases", "deltas", f"held-{epoch}", f"base-{epoch}")]
