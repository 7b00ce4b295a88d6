"""Scoring rows with a user-supplied model call."""

from __future__ import annotations

import heapq
import threading
import time
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.operators.sizing import read_bytes
from freshet.session import scratch_dir
from freshet.sinks.target import empty_folder

MAX_WORKERS = 50
# Arrow batches a task works on at once, so that a slow row does not hold up the rows behind it.
OPEN_BATCHES = 4
# What a task of a round may read, and the rows of a file that rounds are made of.
TASK_BYTES = 128 * 2**20
FILE_ROWS = 50_000


class RateLimited(Exception):
    """Raised by a completer to have the call tried again later."""


@dataclass(frozen=True)
class Retry:
    """Waits of 2, 2, 4, 8 seconds between five attempts: doubling, kept within the bounds."""

    attempts: int = 5
    shortest: float = 2
    longest: float = 30
    sleep: Callable[[float], None] = time.sleep

    def wait(self, attempt: int) -> float:
        """How long to wait after an attempt, counted from 1."""
        return min(max(2 ** (attempt - 1), self.shortest), self.longest)

    def call(self, fn: Callable[..., str], *args: str) -> str:
        for attempt in range(1, self.attempts + 1):
            try:
                return fn(*args)
            except RateLimited:
                if attempt == self.attempts:
                    raise
                self.sleep(self.wait(attempt))


@dataclass
class _Batch:
    """An Arrow batch some rows of which are still to be answered."""

    data: pa.RecordBatch
    payloads: list[str]
    content: list[str | None] = field(default_factory=list)
    errors: list[str | None] = field(default_factory=list)
    left: int = 0

    def __post_init__(self):
        self.left = len(self.payloads)
        self.content = [None] * self.left
        self.errors = [None] * self.left


class _Rows:
    """The rows of the open batches: fresh ones in order, and those to be called again, by when they are due."""

    def __init__(self, batches: Iterator[pa.RecordBatch], payload: str, retry: Retry):
        self.batches, self.payload, self.retry = batches, payload, retry
        self.open: deque[_Batch] = deque()
        self.fresh: Iterator[tuple[_Batch, int, int]] = iter(())
        self.n_fresh = 0
        self.waiting: list[tuple[float, int, _Batch, int, int]] = []  # due, tie-break, batch, row, attempt
        self.order, self.ended = 0, False

    def may_read(self) -> bool:
        return not (self.n_fresh or self.ended or len(self.open) >= OPEN_BATCHES)

    def add(self, data: pa.RecordBatch | None) -> None:
        if data is None:
            self.ended = True
            return
        batch = _Batch(data, data.column(self.payload).to_pylist())
        self.open.append(batch)
        self.n_fresh = batch.left
        self.fresh = ((batch, i, 1) for i in range(len(batch.payloads)))

    def take(self) -> tuple[_Batch, int, int] | None:
        if self.waiting and self.waiting[0][0] <= time.monotonic():
            return heapq.heappop(self.waiting)[2:]
        if not self.n_fresh:
            return None
        self.n_fresh -= 1
        return next(self.fresh)

    def settle(self, row: tuple[_Batch, int, int], content: str | None, error: BaseException | None) -> None:
        batch, i, attempt = row
        if error is None:
            batch.content[i] = content
        elif isinstance(error, RateLimited) and attempt < self.retry.attempts:
            self.order += 1
            heapq.heappush(self.waiting, (time.monotonic() + self.retry.wait(attempt), self.order, batch, i, attempt + 1))
            return
        else:
            batch.errors[i] = f"{type(error).__name__}: {error}"
        batch.left -= 1

    def whole(self) -> bool:
        """Whether the first batch has all its answers."""
        return bool(self.open) and not self.open[0].left

    def sleep(self, due: float) -> None:
        self.retry.sleep(max(0.0, due - time.monotonic()))


def _attempt(call: Callable[[str], str | None], row: tuple[_Batch, int, int]) -> tuple[str | None, BaseException | None]:
    try:
        return call(row[0].payloads[row[1]]), None
    except KeyboardInterrupt:
        raise
    except BaseException as error:  # noqa: BLE001
        return None, error


def _one_at_a_time(rows: _Rows, call: Callable[[str], str | None]) -> Iterator[_Batch]:
    """A single worker needs no thread of its own."""
    while True:
        row = rows.take()
        if row is not None:
            rows.settle(row, *_attempt(call, row))
        while rows.whole():
            yield rows.open.popleft()
        if row is not None:
            continue
        if rows.may_read():
            rows.add(next(rows.batches, None))
        elif rows.waiting:
            # Nothing else to do: after this the earliest is due, whatever the clock says.
            due, *rest = heapq.heappop(rows.waiting)
            rows.sleep(due)
            heapq.heappush(rows.waiting, (0.0, *rest))
        elif rows.ended and not rows.open:
            return


def _by_threads(rows: _Rows, call: Callable[[str], str | None], workers: int) -> Iterator[_Batch]:
    """Threads take rows by themselves; this one reads batches, wakes them and hands out what is whole."""
    lock = threading.Lock()
    ready, moved = threading.Condition(lock), threading.Condition(lock)
    running, stopped = 0, False

    def work() -> None:
        nonlocal running
        with lock:
            while True:
                while (row := None if stopped else rows.take()) is None:
                    if stopped:
                        return
                    ready.wait()
                running += 1
                if not rows.n_fresh:
                    moved.notify()
                lock.release()
                try:
                    result = _attempt(call, row)
                finally:
                    lock.acquire()
                running -= 1
                rows.settle(row, *result)
                if not row[0].left or not rows.n_fresh or rows.waiting:
                    moved.notify()

    threads = [threading.Thread(target=work, daemon=True) for _ in range(workers)]
    for thread in threads:
        thread.start()
    try:
        while True:
            read, batch, wake = False, None, None
            with lock:
                if rows.whole():
                    batch = rows.open.popleft()
                elif rows.may_read():
                    read = True
                elif rows.ended and not rows.open:
                    return
                elif rows.waiting and not rows.n_fresh and not running:
                    wake = heapq.heappop(rows.waiting)
                else:
                    pause = max(0.0, rows.waiting[0][0] - time.monotonic()) if rows.waiting and running < workers else None
                    if pause != 0.0:
                        moved.wait(pause)
                    else:
                        # Due, and a thread is free to take it.
                        ready.notify()
                        moved.wait()
                    continue
            if batch is not None:
                yield batch
            elif read:
                data = next(rows.batches, None)
                with lock:
                    rows.add(data)
                    ready.notify_all()
            else:
                # Nothing else to do: after this it is due, whatever the clock says.
                rows.sleep(wake[0])
                with lock:
                    heapq.heappush(rows.waiting, (0.0, *wake[1:]))
                    ready.notify()
                    moved.wait()
    finally:
        with lock:
            stopped = True
            ready.notify_all()
        for thread in threads:
            thread.join()


def answered(
    batches: Iterator[pa.RecordBatch], payload: str, call: Callable[[str], str | None], workers: int, retry: Retry
) -> Iterator[_Batch]:
    """The batches in order, each once all of its rows have an answer or an error.

    Up to `workers` calls run at a time. A row that is to be called again later waits without a
    worker; the next rows go on, those of the following batches too.
    """
    rows = _Rows(batches, payload, retry)
    yield from _one_at_a_time(rows, call) if workers == 1 else _by_threads(rows, call, workers)


def call_tasks(df: DataFrame, workers: int) -> int:
    """The tasks that share out the workers: as many as there are cores for them."""
    return min(workers, df.sparkSession.sparkContext.defaultParallelism)


def score_with(
    df: DataFrame,
    completer: Callable[[str, str], str | None],
    prompt: str,
    payload: str = "payload",
    workers: int = 1,
    retry: Retry = Retry(),
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Call `completer(prompt, payload)` once per row and add `content` and `error`.

    At most `workers` calls are in flight at any time in the whole run, whatever the size of the
    cluster: they are shared out over as many tasks as there are cores for them, so that answers come back spread
    and a lost task repeats its part alone. A call that raises fills `error` and
    leaves the other rows alone. Other columns pass through as Arrow data, so a key comes back with
    its own type on its own row. The payload is dropped.

    Rows of a larger, or unknown, planned size than `task_bytes` for each of those tasks are written to the shared
    folder and scored right away, in rounds of that size one after the other, and the answers are read from there.
    Otherwise every evaluation of the result calls the model again: `freshet.operators.waves` keeps answers for good.
    """
    kept = [name for name in df.columns if name != payload]
    rows = df.select(*[f"`{name}`" for name in kept], F.col(f"`{payload}`").alias(payload))
    tasks = call_tasks(df, workers)
    if not 1 <= workers <= MAX_WORKERS or read_bytes(rows) <= tasks * task_bytes:
        return score_at_once(rows, completer, prompt, payload, workers, retry)
    spark, place = df.sparkSession, scratch_dir(df.sparkSession, "scored")
    asked, answers = f"{place}/rows", f"{place}/answers"
    rows.write.option("maxRecordsPerFile", FILE_ROWS).parquet(asked)
    for part in rounds(spark.read.schema(rows.schema).parquet(asked), asked, tasks * task_bytes):
        scored = score_at_once(part, completer, prompt, payload, workers, retry)
        scored.write.mode("append").parquet(answers)
    empty_folder(spark, asked)
    return spark.read.schema(scored.schema).parquet(answers)


def rounds(stored: DataFrame, path: str, most: int) -> Iterator[DataFrame]:
    """A stored frame in parts of whole files, about `most` bytes each; one part at least."""
    sizes = stored.select("_metadata.file_name", "_metadata.file_size").distinct().orderBy("file_name").collect()
    parts, size = [[]], 0
    for name, n in sizes:
        if parts[-1] and size + n > most:
            parts.append([])
            size = 0
        parts[-1].append(f"{path}/{name}")
        size += n
    for files in parts:
        yield stored.sparkSession.read.schema(stored.schema).parquet(*files) if files else stored


def score_at_once(
    df: DataFrame, completer: Callable[[str, str], str | None], prompt: str, payload: str, workers: int, retry: Retry
) -> DataFrame:
    """`score_with` of rows that are few enough for its tasks, whatever their planned size."""
    if not 1 <= workers <= MAX_WORKERS:
        raise ValueError(f"workers must be between 1 and {MAX_WORKERS}, got {workers}")
    tasks = call_tasks(df, workers)
    kept = [name for name in df.columns if name != payload]
    schema = T.StructType(
        [df.schema[name] for name in kept]
        + [T.StructField("content", T.StringType()), T.StructField("error", T.StringType())]
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share = workers // tasks + (TaskContext.get().partitionId() < workers % tasks)
        for batch in answered(batches, payload, lambda text: completer(prompt, text), share, retry):
            added = [pa.array(batch.content, pa.string()), pa.array(batch.errors, pa.string())]
            yield pa.RecordBatch.from_arrays(
                [batch.data.column(name) for name in kept] + added, [*kept, "content", "error"]
            )

    return df.repartition(tasks).mapInArrow(score, schema)
