"""Rows that wait to be scored: what a stream brings beyond the rows a trigger may score stays here, for good."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions.times import utc_naive, utc_now
from freshet.operators.sampling import random_seed, sample_exact
from freshet.operators.waves import request_id
from freshet.plans.jobs import Completer, Job, Native, Summary, process, run_folder, taken_up
from freshet.sinks.target import Target

ROW = "_backlog_row"
_SAME = "_backlog_same"


class Backlog:
    """Two tables below a folder: rows that came, by batch, and rows that are done, by run. Both are appended to as
    transactions, so a batch that is offered again, or a run taken up again, counts once. What waits is the
    first without the second; both sides of that join are rows told apart by a number of their own."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")
        self.came = self._table("rows", own_types=True)
        self.done = self._table("done")

    def _table(self, name: str, **options) -> Target:
        return Target(
            ROW, "_backlog_time", path=f"{self.path}/{name}", runs=f"{self.path}/{name}-runs", **options
        )

    def add(self, rows: DataFrame, batch_id: str, now: datetime) -> bool:
        """Keep a batch's rows. One that waits already, the same in every column, is not kept again: it came with
        the whole input once more after a stream had lost its state."""
        spark = rows.sparkSession
        rows = rows.withColumn(_SAME, request_id(rows, rows.columns))
        waiting = self.waiting(spark)
        if waiting is not None:
            rows = rows.join(waiting.select(_SAME), _SAME, "left_anti")
        number = F.concat_ws(":", F.lit(batch_id), F.monotonically_increasing_id().cast("string"))
        return self.came.append(rows.withColumn(ROW, number), now, batch_id)

    def waiting(self, spark: SparkSession) -> DataFrame | None:
        """All rows not done yet, with their number; None before the first batch."""
        came, done = self.came.load(spark), self.done.load(spark)
        if came is None:
            return None
        came = came.drop(self.came.ts)
        return came if done is None else came.join(done.select(ROW), ROW, "left_anti")

    def runs_done(self, spark: SparkSession) -> int:
        commits = self.done.commits(spark)
        return 0 if commits is None else commits.count()

    def retire(self, rows: DataFrame, run_id: str, now: datetime) -> None:
        self.done.append(rows.select(ROW), now, run_id)


def work_off(
    spark: SparkSession,
    job: Job,
    scorer: Native | Completer,
    backlog: Backlog,
    max_records: int,
    now: datetime | None = None,
    ids: Sequence[str] | None = None,
) -> Summary:
    """One trigger: score at most `max_records` of the rows that wait, append what is valid, retire it. Rejected
    rows go on waiting.

    Which rows is decided as in a sampled run, by the job's seed. A trigger that failed is taken up again by
    the next one, with the same rows and run id, so each row is written once; the job's target must keep a
    table of runs.
    """
    if job.target.runs is None:
        raise ValueError("a backlog needs a target with a table of runs")
    now = utc_now() if now is None else utc_naive(now)
    run_id = f"{backlog.path}#{backlog.runs_done(spark)}"
    folder = run_folder(spark, run_id)

    def done(results: DataFrame) -> None:
        backlog.retire(results.filter(F.col("reject_reason").isNull()), run_id, now)

    if folder.has("results") or folder.has("requests"):
        results = taken_up(job, scorer, folder, [ROW])
    else:
        rows = backlog.waiting(spark)
        if rows is None or max_records == 0 or rows.isEmpty():
            return Summary()
        told = [job.target.key, *[name for name in rows.columns if name.startswith("_id_")]] if ids is None else ids
        seed = random_seed() if job.seed is None else job.seed
        rows = sample_exact(rows.drop(_SAME), max_records, told, seed, ties=[ROW])

        def results() -> DataFrame:
            return scorer.enrich(rows, job, folder, [ROW])

    return process(results, job, now, folder, run_id, [ROW], done)
