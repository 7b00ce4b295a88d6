"""The enrichment job over a stream of source rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from freshet.functions.times import cutoff_before, utc_naive, utc_now
from freshet.plans.jobs import (
    Completer,
    Job,
    Native,
    enriched,
    join_frames,
    needed_columns,
    new_frames,
    process,
    run_folder,
)
from freshet.sources.scan import ROW_NUMBER, scan_window
from freshet.streaming.backlog import Backlog, work_off


def start_stream(
    stream: DataFrame,
    job: Job,
    scorer: Native | Completer,
    checkpoint: str,
    clock: Callable[[], datetime] = utc_now,
    every: str | None = None,
    max_records: int | None = None,
    backlog: Backlog | None = None,
) -> StreamingQuery:
    """Run the job on each micro-batch of its first source; the other sources are read as they are.

    Without `every` (such as "30 minutes") the query works off what is there and ends. A batch that another
    source holds up, by having no row in the window, fails the query: it is offered again on restart.

    Where the target keeps no table of runs, a batch replayed after a failure finds its rows in the target,
    written later than their update, and skips them. Where it does, a batch is one run, written once.

    With `max_records` a trigger scores no more rows than that. A batch's new rows, joined, are first kept in
    the `backlog`; the trigger takes its share from there, and `freshet.streaming.backlog.work_off` is a further
    trigger without a new batch. Everything kept is scored and written once, also after a failure at any place.
    """
    if (max_records is None) != (backlog is None):
        raise ValueError("max_records and backlog go together")

    def enrich(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        now = utc_naive(clock())
        cutoff = cutoff_before(now, job.hours)
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint
        batch_id = f"{query}#{number}"
        needed = {job.sources[0].key, job.sources[0].ts, *job.sources[0].ids(), *job.include}
        # Looked at several times below: read from its source once.
        batch = batch.select(*[f"`{name}`" for name in batch.columns if name in needed]).persist()
        try:
            first = replace(job.sources[0], frame=batch, table=None, path=None)
            this = replace(job, sources=(first, *job.sources[1:]))
            done = (backlog.came if backlog else job.target).committed(spark, batch_id)
            frames = [] if done else new_frames(spark, this, cutoff)
            if frames and backlog is not None:
                rows = join_frames(needed_columns(frames, this)[0], this)
                backlog.add(rows.drop(*[n for n in rows.columns if n.endswith(ROW_NUMBER)]), batch_id, now)
            elif frames:
                run_id = batch_id if job.target.runs else None
                folder = run_folder(spark, run_id)
                process(lambda: enriched(frames, this, scorer, None, folder), this, now, folder, run_id)
            elif not done and not scan_window(batch, first.ts, cutoff).isEmpty():
                raise RuntimeError("another source has no rows in the window; the batch is kept back")
            if backlog is not None:
                work_off(spark, job, scorer, backlog, max_records, now)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(enrich).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()
