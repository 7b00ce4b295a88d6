"""The target table: append with a write time, create, partition, drop."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.functions.models import table_type
from freshet.functions.times import partition_number, ts_literal
from freshet.operators.state import last_processed
from freshet.session import scratch_dir
from freshet.sinks.kept_state import KeptState
from freshet.sources.scan import load_table, scan_window


_CLAIM = "claim string, since timestamp_ntz, until timestamp_ntz"


def empty_folder(spark: SparkSession, path: str, fmt: str = "parquet") -> None:
    """Remove the data files below a path. Overwriting by partition with no rows writes no file, so
    the folder reads as missing."""
    (
        spark.createDataFrame([], "part int, value int")
        .write.format(fmt)
        .partitionBy("part")
        .option("partitionOverwriteMode", "static")
        .mode("overwrite")
        .save(path)
    )


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """The frame written once to the shared folder and read back; emptied again at the end.

    Columnar and compressed, so that counting by one column reads that column only.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, "staged")
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        if load_table(spark, path=path) is not None:
            empty_folder(spark, path)


def _stored_value(value: Column, dtype: T.DataType) -> Column:
    """As the table holds it: times with a zone as UTC without one."""
    if isinstance(dtype, T.TimestampType):
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), value.cast(T.TimestampNTZType()))
    return value.cast(table_type(dtype))


@dataclass(frozen=True)
class Target:
    """A catalog table (`table`, optionally stored at `path`) or just a folder (`path`).

    `partition_by` names one or more of year, month, day, counted since 1970 on the write time.
    File tables have no hidden partitions, so each is kept in a column `<ts>_<transform>`, which
    `load` hides again.

    With `runs`, the folder of a table of committed runs, an append is one transaction: its rows carry a number
    of the attempt, in a column `<ts>_attempt` that `load` hides too, and count only once the attempt is
    committed, by the one row written last. A run id that is committed already writes nothing.

    `keep_state` keeps the times of each key beside the runs (`freshet.sinks.kept_state`), for reads that are not
    cut off to go by. `own_types` keeps columns as they come, where the table need not hold common types only.
    """

    key: str
    ts: str
    table: str | None = None
    path: str | None = None
    partition_by: str | tuple[str, ...] | None = None
    fmt: str = "parquet"
    runs: str | None = None
    own_types: bool = False
    keep_state: bool = False

    def __post_init__(self):
        if self.table is None and self.path is None:
            raise ValueError("a target needs a table name or a path")
        if self.keep_state and self.runs is None:
            raise ValueError("a kept state needs a target with a table of runs")
        for transform in self.transforms:
            partition_number(F.lit(None).cast("timestamp_ntz"), transform)

    @property
    def transforms(self) -> tuple[str, ...]:
        if self.partition_by is None:
            return ()
        return (self.partition_by,) if isinstance(self.partition_by, str) else tuple(self.partition_by)

    def partition_columns(self) -> list[str]:
        return [f"{self.ts}_{transform}" for transform in self.transforms]

    @property
    def attempt_column(self) -> str:
        return f"{self.ts}_attempt"

    def commits(self, spark: SparkSession) -> DataFrame | None:
        """One row per committed run: of two attempts at once, the same one for all readers."""
        if load_table(spark, path=self.runs) is None:
            return None
        commits = spark.read.schema("run_id string, attempt string, committed_at timestamp_ntz").parquet(self.runs)
        return commits.groupBy("run_id").agg(
            F.min(F.struct("attempt", "committed_at")).alias("first")
        ).select("run_id", "first.*")

    def committed(self, spark: SparkSession, run_id: str) -> bool:
        """Whether the rows of a run are in the target for good."""
        commits = self.commits(spark) if self.runs else None
        return commits is not None and not commits.filter(F.col("run_id") == run_id).isEmpty()

    def claim(self, spark: SparkSession, now: datetime, lasts: timedelta) -> str | None:
        """Claim the target for one run at a time: a claim to `release` afterwards, or None while another holds.

        A claim is written, then all are read: it holds if there is no other that is neither released nor older than
        it lasts. Of two runs at the very same time at least the later reader sees both claims and steps back,
        so both never hold, though both may step back. A lost run is in the way no longer than its claim lasts."""
        if self.runs is None:
            raise ValueError("a claim needs a target with a table of runs")
        claim = uuid.uuid4().hex
        self._note_claim(spark, claim, now, now + lasts)
        rows = spark.read.schema(_CLAIM).parquet(self._claims)
        held = rows.groupBy("claim").agg(F.min("until").alias("until"))
        others = held.filter((F.col("until") > ts_literal(now)) & (F.col("claim") != claim))
        if others.isEmpty():
            return claim
        self.release(spark, claim, now)
        return None

    def release(self, spark: SparkSession, claim: str, now: datetime) -> None:
        self._note_claim(spark, claim, now, datetime(1970, 1, 1))

    @property
    def _claims(self) -> str:
        return f"{self.runs.rstrip('/')}-claims"

    def _note_claim(self, spark: SparkSession, claim: str, since: datetime, until: datetime) -> None:
        row = spark.createDataFrame([(claim,)], "claim string")
        row = row.withColumns({"since": ts_literal(since), "until": ts_literal(until)})
        row.coalesce(1).write.mode("append").parquet(self._claims)

    def _stored(self, spark: SparkSession) -> DataFrame | None:
        if self.table is not None:
            return load_table(spark, table=self.table)
        return load_table(spark, path=self.path, fmt=self.fmt)

    def load(self, spark: SparkSession, cutoff: datetime | None = None) -> DataFrame | None:
        """The target's rows, from the cut-off on if one is given; None where it does not exist.

        The cut-off bounds the partition columns too, so that older partitions are not read.
        """
        df = self._stored(spark)
        if df is None:
            return None
        if cutoff is not None:
            df = scan_window(df, self.ts, cutoff)
            for transform, column in zip(self.transforms, self.partition_columns()):
                if column in df.columns:
                    df = df.filter(F.col(column) >= partition_number(ts_literal(cutoff), transform))
        if self.runs is not None:
            commits = self.commits(spark)
            if commits is None:
                return df.limit(0).drop(*self.partition_columns(), self.attempt_column)
            if cutoff is not None:
                # A run's rows share its write time.
                commits = commits.filter(F.col("committed_at") >= ts_literal(cutoff))
            df = df.join(commits.select(F.col("attempt").alias(self.attempt_column)), self.attempt_column, "left_semi")
        return df.drop(*self.partition_columns(), self.attempt_column)

    def layout(self, records: DataFrame, now: datetime) -> DataFrame:
        """The stored form of a batch: write time first, the batch's columns, partition columns."""
        columns = [
            (F.col(f"`{f.name}`") if self.own_types else _stored_value(F.col(f"`{f.name}`"), f.dataType)).alias(f.name)
            for f in records.schema
            if f.name != self.ts
        ]
        stamped = records.select(ts_literal(now, T.TimestampNTZType()).alias(self.ts), *columns)
        return stamped.withColumns(
            {f"{self.ts}_{t}": partition_number(F.col(self.ts), t) for t in self.transforms}
        )

    def append(self, records: DataFrame, now: datetime, run_id: str | None = None) -> bool:
        """Append a batch, creating the target on first use. Columns go by name. With `runs`, all of the batch is
        there afterwards or nothing, and False says that the run was committed before.

        `rebalance` lets AQE merge small tasks and split large ones, so that a run leaves files
        of even size instead of one per task.
        """
        spark = records.sparkSession
        if run_id is not None and self.runs is None:
            raise ValueError("a run id needs a target with a table of runs")
        batch = self.layout(records, now)
        attempt = uuid.uuid4().hex
        if self.runs is not None:
            run_id = attempt if run_id is None else run_id
            if self.committed(spark, run_id):
                return False
            batch = batch.withColumn(self.attempt_column, F.lit(attempt))
        self._write(batch.hint("rebalance"))
        if self.keep_state:
            KeptState(self).add(batch, now, attempt)
        if self.runs is not None:
            commit = spark.createDataFrame([(run_id, attempt)], "run_id string, attempt string")
            commit.withColumn("committed_at", ts_literal(now)).coalesce(1).write.mode("append").parquet(self.runs)
        if self.keep_state:
            KeptState(self).compact(spark)
        return True

    def state(self, spark: SparkSession, which: str = "latest", cutoff: datetime | None = None) -> DataFrame | None:
        """When each key was processed last (or first): from the kept state where that can tell, else from the rows
        themselves, from the cut-off on."""
        if self.keep_state and (cutoff is None or which == "latest"):
            return KeptState(self).load(spark, which, cutoff)
        rows = self.load(spark, cutoff)
        return None if rows is None else last_processed(rows, self.key, self.ts, which)

    def _write(self, batch: DataFrame) -> None:
        spark = batch.sparkSession
        stored = self._stored(spark)
        if stored is not None:
            if set(stored.columns) != set(batch.columns):
                raise ValueError(f"columns of batch {batch.columns} and target {stored.columns} differ")
            batch = batch.select(*[f"`{name}`" for name in stored.columns])
        writer = batch.write.format(self.fmt).mode("append")
        if self.transforms:
            writer = writer.partitionBy(*self.partition_columns())
        if self.table is None:
            writer.save(self.path)
        elif self.path is not None:
            writer.option("path", self.path).saveAsTable(self.table)
        else:
            writer.saveAsTable(self.table)

    def drop(self, spark: SparkSession) -> None:
        """Remove the target and its rows; a missing one is fine."""
        stored = self._stored(spark)
        if self.table is not None:
            spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        if self.path is not None and stored is not None:
            # A table with its own location leaves its files behind.
            empty_folder(spark, self.path, self.fmt)
        if self.runs is not None and load_table(spark, path=self.runs) is not None:
            places = [self.runs, *(KeptState(self).places(spark) if self.keep_state else ())]
            for place in places:
                if load_table(spark, path=place) is not None:
                    empty_folder(spark, place)
