"""The enrichment job: read what is new, score it, append the valid results."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions.models import Model, model_named
from freshet.functions.payload import payload_json
from freshet.functions.times import cutoff_before, utc_naive, utc_now
from freshet.operators.joins import join_sources
from freshet.operators.projection import included
from freshet.operators.responses import flatten, parse_responses, valid_rows
from freshet.operators.sampling import random_seed, sample_exact
from freshet.operators.scoring import Retry
from freshet.operators.sizing import fits_task, spread_small
from freshet.operators.state import incremental_filter
from freshet.operators.waves import REQUEST, WAVE_ROWS, RunFolder, ask_in_waves, request_id
from freshet.session import ensure_checkpoint_dir, scratch_dir, shared_dir
from freshet.sinks.target import Target
from freshet.sources.scan import ROW_NUMBER, Source, check_same_key, read_sources

# Sampled ids are broadcast up to this number.
BROADCAST_ROWS = 100_000
ROWS_PER_TASK = 500
# Keys of a job definition that say how a model service is reached; the completer's business.
SERVICE_KEYS = ("provider", "version", "deployment", "engine", "api_key", "api_base")


def _only(section: dict, *known: str) -> None:
    """Refuse a misspelt key: a bound that is not read is no bound at all."""
    unknown = sorted(set(section) - set(known))
    if unknown:
        raise ValueError(f"unknown keys {unknown}; known are {sorted(known)}")


@dataclass(frozen=True)
class Job:
    """What to read, what to ask for and where to write.

    `seed` fixes the sample; without one every run draws a fresh one. `state` is the write time that
    counts for a key written several times: its latest or its oldest. Of same-named columns the last
    source's is sent, unless `prefer` says left. `large` and `hot_rows` are those of the joins.
    """

    sources: tuple[Source, ...]
    target: Target
    model: Model
    include: tuple[str, ...] = ()
    hours: int | None = None
    workers: int = 1
    seed: int | None = None
    state: str = "latest"
    prefer: str = "right"
    hot_rows: int | None = None
    large: bool | None = None

    def __post_init__(self):
        check_same_key(self.sources)

    @classmethod
    def from_config(cls, config: dict, **options) -> Job:
        """From a nested job definition: connector.source, connector.target and inference."""
        _only(config, "connector", "inference")
        connector, inference = config["connector"], config["inference"]
        _only(connector, "source", "target")
        _only(connector["source"], "tables", "time_filter_hours")
        _only(inference, "workers", "include_fields", "response_format", *SERVICE_KEYS)
        entry_keys = ("database", "table", "index_field", "datetime_field")
        for entry in connector["source"]["tables"]:
            _only(entry, *entry_keys, "location", "partition_by")
        _only(connector["target"], *entry_keys, "location", "partition_by")

        def place(entry: dict) -> dict:
            return {
                "key": entry["index_field"],
                "ts": entry["datetime_field"],
                "table": f"{entry['database']}.{entry['table']}",
            }

        target = connector["target"]
        partition_by = target.get("partition_by")
        return cls(
            sources=tuple(Source(**place(entry)) for entry in connector["source"]["tables"]),
            target=Target(
                **place(target),
                path=target.get("location"),
                partition_by=tuple(partition_by) if isinstance(partition_by, list) else partition_by,
            ),
            model=model_named(inference["response_format"]),
            include=tuple(inference.get("include_fields", ())),
            hours=connector["source"].get("time_filter_hours"),
            workers=inference.get("workers", 1),
            **options,
        )


@dataclass(frozen=True)
class Summary:
    """Row counts of one run; `available` only where it was asked for."""

    scored: int = 0
    written: int = 0
    rejected: dict[str, int] = field(default_factory=dict)
    available: int | None = None


@dataclass(frozen=True)
class Native:
    """Scores by a column expression over the included columns' text."""

    answer: Callable[[Column], Column]

    def of(self, df: DataFrame, include: Sequence[str]) -> Column:
        return self.answer(F.concat_ws(" ", *[F.col(f"`{n}`").cast("string") for n in included(df.columns, include)]))

    def of_nothing(self) -> Column:
        return self.answer(F.lit(""))

    def enrich(self, rows: DataFrame, job: Job, folder: RunFolder, carry: Sequence[str] = ()) -> DataFrame:
        key = job.target.key
        scored = rows.select(*carry, key, self.of(rows, job.include).alias("_answer"))
        return flatten(scored, "_answer", job.model).withColumn("reject_reason", F.lit(None).cast("string"))


@dataclass(frozen=True)
class Completer:
    """Scores by calling `complete(prompt, payload)` for every row, in waves of `wave_rows`.

    What is asked, and each wave's answers, are kept in the run's folder. Rows that agree in key, ids and
    payload are one request.
    """

    complete: Callable[[str, str], str | None]
    retry: Retry = Retry()
    wave_rows: int = WAVE_ROWS

    def enrich(self, rows: DataFrame, job: Job, folder: RunFolder, carry: Sequence[str] = ()) -> DataFrame:
        key = job.target.key

        def requests() -> DataFrame:
            asked = rows.withColumn("_payload", payload_json(rows, job.include))
            told = [key, *[name for name in rows.columns if name.startswith("_id_")]]
            asked = asked.withColumn(REQUEST, request_id(asked, told, "_payload"))
            return asked.select(REQUEST, *carry, key, F.col("_payload").alias("payload"))

        return self.answer(folder.once("requests", requests), job, folder, carry)

    def answer(self, requests: DataFrame, job: Job, folder: RunFolder, carry: Sequence[str] = ()) -> DataFrame:
        key = job.target.key
        answered = ask_in_waves(
            requests, self.complete, job.model.prompt, folder, job.workers, self.retry, wave_rows=self.wave_rows
        )
        parsed = parse_responses(answered, job.model, error="error")
        last = (*carry, key, "reject_reason")
        return parsed.select(*[f"`{n}`" for n in parsed.columns if n not in last], *last)


def new_frames(
    spark: SparkSession, job: Job, cutoff: datetime | None, whole: bool = False
) -> list[tuple[Source, DataFrame]]:
    """Each source cut by the window and by what the target holds already, before any join, its rows
    numbered where they can be. Only the columns the job needs, unless `whole` rows are asked for."""
    state = job.target.state(spark, job.state, cutoff)
    warm = state is not None and not state.isEmpty()
    alive = [(source, source.number(df)) for source, df in read_sources(spark, job.sources, cutoff, warm)]
    if not whole:
        alive = [(source, _narrow(source, df, job)) for source, df in alive]
    if not warm:
        return alive
    return [
        (
            source,
            incremental_filter(
                df, state, source.key, source.ts, job.hot_rows, job.large, ids=(*source.ids(), ROW_NUMBER)
            ),
        )
        for source, df in alive
    ]


def _narrow(source: Source, df: DataFrame, job: Job) -> DataFrame:
    needed = {source.key, source.ts, ROW_NUMBER, *source.ids(), *job.include}
    return df.select(*[f"`{name}`" for name in df.columns if name in needed])


def select_rows(spark: SparkSession, job: Job, cutoff: datetime | None = None) -> DataFrame | None:
    """The rows to enrich: new rows of each source, joined. None if a source rule leaves nothing."""
    frames = [df for _, df in new_frames(spark, job, cutoff, whole=True)]
    if not frames:
        return None
    rows = join_frames(frames, job)
    return rows.drop(*[name for name in rows.columns if name.startswith(ROW_NUMBER)])


def join_frames(frames: list[DataFrame], job: Job) -> DataFrame:
    return join_sources(
        frames, job.target.key, prefer=job.prefer, hot_rows=job.hot_rows, large=job.large
    )


def needed_columns(frames: list[tuple[Source, DataFrame]], job: Job) -> tuple[list[DataFrame], list[str]]:
    """The frames with only the columns the job needs, and the names that tell joined rows apart.

    Row ids are copied to names of their own, which a same-named column of another source cannot
    replace in the join. They also keep rows distinct that would otherwise become copies.
    """
    needed, ids = [], [job.target.key]
    for i, (source, df) in enumerate(frames):
        own = {f"_id_{i}_{name}": name for name in source.ids()}
        wanted = [name for name in df.columns if name in (job.target.key, *job.include)]
        numbers = {f"_id_{i}{ROW_NUMBER}": ROW_NUMBER} if ROW_NUMBER in df.columns else {}
        copies = [F.col(f"`{name}`").alias(copy) for copy, name in {**own, **numbers}.items()]
        needed.append(df.select(*[f"`{name}`" for name in wanted], *copies))
        ids += own
    return needed, ids


def _owner(frames: list[DataFrame], include: Sequence[str]) -> int | None:
    """The one frame that holds all included columns."""
    having = [i for i, df in enumerate(frames) if included(df.columns, include)]
    if len(having) == 1 and set(include) <= set(frames[having[0]].columns):
        return having[0]
    return None


def _score_then_join(frames: list[DataFrame], owner: int, job: Job, scorer: Native) -> DataFrame:
    """A native score depends on its own source's text only: score each text once and send the
    scores through the join, not the texts."""
    texts = spread_small(frames[owner])
    answered = texts.select(
        *[f"`{name}`" for name in texts.columns if name not in job.include or name == job.target.key],
        scorer.of(texts, job.include).alias("_answer"),
    )
    joined = join_frames([*frames[:owner], answered, *frames[owner + 1 :]], job)
    # A row without a match has no text either.
    answer = F.coalesce("_answer", scorer.of_nothing()) if owner > 0 else F.col("_answer")
    return flatten(joined.select(answer.alias("_answer"), job.target.key), "_answer", job.model).withColumn(
        "reject_reason", F.lit(None).cast("string")
    )


def _sampled(
    frames: list[DataFrame], ids: list[str], job: Job, k: int, carry: Sequence[str] = ()
) -> DataFrame:
    """At most k joined rows.

    With large sources, texts would be shuffled only to drop nearly all of them. So the ids alone
    are joined and sampled first; then each frame is cut to the ids in that sample, broadcast up to
    BROADCAST_ROWS of them, what is left is joined with its texts, and of that join the sampled rows
    are kept. Rows read from files are numbered and so told apart; others may be copies of each
    other, of which only as many are taken as asked for.
    """
    seed = random_seed() if job.seed is None else job.seed
    numbers = [name for df in frames for name in df.columns if name.startswith("_id_") and name.endswith(ROW_NUMBER)]
    large = job.large
    if large is None:
        large = not all(fits_task(df) for df in frames)
    if not large or k == 0:
        return sample_exact(join_frames(frames, job), k, ids, seed, ties=numbers).drop(*set(numbers).difference(carry))
    ensure_checkpoint_dir(frames[0].sparkSession)
    told = [*ids, *numbers]
    narrow = [df.select(*[f"`{name}`" for name in df.columns if name in told]) for df in frames]
    picked = sample_exact(join_frames(narrow, job), k, ids, seed, ties=numbers).select(*[f"`{n}`" for n in told]).checkpoint()
    few = k <= BROADCAST_ROWS
    picked = F.broadcast(picked) if few else picked
    cut = [_semi(df, picked, [name for name in df.columns if name in told]) for df in frames]
    joined = join_frames(cut, replace(job, large=False) if few else job)
    rows = _semi(joined, picked, told)
    if len(numbers) < len(frames):
        rows = sample_exact(rows, k, ids, seed, direct_rows=BROADCAST_ROWS, ties=numbers)
    return rows.drop(*set(numbers).difference(carry))


def _semi(df: DataFrame, picked: DataFrame, columns: list[str]) -> DataFrame:
    wanted = picked.select(*[F.col(f"`{name}`").alias(f"_picked_{name}") for name in columns])
    on = [F.col(f"`{name}`").eqNullSafe(F.col(f"`_picked_{name}`")) for name in columns]
    return df.join(wanted, on, "left_semi")


def enriched(
    frames: list[tuple[Source, DataFrame]],
    job: Job,
    scorer: Native | Completer,
    max_records: int | None,
    folder: RunFolder,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Join, sample and score: the model's columns, the columns to carry along, the key and `reject_reason`."""
    needed, ids = needed_columns(frames, job)
    if max_records is None:
        owner = _owner(needed, job.include) if isinstance(scorer, Native) and not carry else None
        if owner is not None:
            return _score_then_join(needed, owner, job, scorer)
        rows = join_frames(needed, job)
        return scorer.enrich(spread_small(rows) if isinstance(scorer, Native) else rows, job, folder, carry)
    rows = _sampled(needed, ids, job, max_records, carry)
    if isinstance(scorer, Native):
        # A small sample ends up in one task; spread it out again, a few hundred rows to each.
        tasks = min(rows.sparkSession.sparkContext.defaultParallelism, -(-max_records // ROWS_PER_TASK))
        rows = rows.repartition(max(1, tasks))
    return scorer.enrich(rows, job, folder, carry)


def run_folder(spark: SparkSession, run_id: str | None = None) -> RunFolder:
    """The folder of a run: the same one for the same id, a fresh one without."""
    if run_id is None:
        return RunFolder(spark, scratch_dir(spark, "run"), lasting=False)
    return RunFolder(spark, f"{shared_dir(spark).rstrip('/')}/run-{hashlib.sha256(run_id.encode()).hexdigest()[:32]}")


STAGES = ("requests", "answers", "dealt", "results")


def process(
    results: Callable[[], DataFrame],
    job: Job,
    now: datetime,
    folder: RunFolder,
    run_id: str | None = None,
    carry: Sequence[str] = (),
    done: Callable[[DataFrame], None] | None = None,
) -> Summary:
    """Append the valid ones of the results, as `enriched` gives them.

    The results are a stage of the run's folder first: the model is asked once per row, the counts agree
    with what is written, the state is read in full before the target changes, and a run without any valid
    result leaves the target as it was. `done` is given the results, with the columns to carry, once they are
    in the target. The folder of a run that nobody will take up again is emptied even if it fails.
    """
    try:
        scored = folder.once("results", results)
        counts = {row["reject_reason"]: row["count"] for row in scored.groupBy("reject_reason").count().collect()}
        written = counts.pop(None, 0)
        if written:
            job.target.append(valid_rows(scored).drop(*carry), now, run_id)
        if done is not None:
            done(scored)
    except BaseException:
        if not folder.lasting:
            folder.clear(*STAGES)
        raise
    folder.clear(*STAGES)
    return Summary(written + sum(counts.values()), written, counts)


def taken_up(job: Job, scorer: Native | Completer, folder: RunFolder, carry: Sequence[str] = ()) -> Callable[[], DataFrame]:
    """The results of a run whose requests are in its folder, from where it stopped."""

    def lost() -> DataFrame:
        raise RuntimeError(f"the requests in {folder.path} are gone")

    return lambda: scorer.answer(folder.once("requests", lost), job, folder, carry)


def run_job(
    spark: SparkSession,
    job: Job,
    scorer: Native | Completer,
    max_records: int | None = 100,
    drop: bool = False,
    now: datetime | None = None,
    count_available: bool = False,
    run_id: str | None = None,
    alone: timedelta | None = None,
) -> Summary:
    """One run. `now` (default: the start of the run, UTC) fixes the window and is the write time,
    so that a source update during the run is later than it and picked up next time.

    `max_records=None` takes every new row. `drop` starts the target afresh. With a `run_id`, for which the
    target must keep a table of runs, a run that failed is taken up where it stopped when it is started again:
    the same rows, no answered request asked twice, and nothing at all if it was committed.

    `alone` is for schedules whose runs may overlap: the run claims the target for no longer than that, and does
    nothing while another one's claim holds, so that no row is scored by both.
    """
    if alone is not None:
        at = utc_now()
        claim = job.target.claim(spark, at, alone)
        if claim is None:
            return Summary()
        try:
            return run_job(spark, job, scorer, max_records, drop, now, count_available, run_id)
        finally:
            job.target.release(spark, claim, at)
    now = utc_now() if now is None else utc_naive(now)
    if run_id is not None:
        if job.target.runs is None:
            raise ValueError("a run id needs a target with a table of runs")
        if job.target.committed(spark, run_id):
            return Summary()
    folder = run_folder(spark, run_id)
    if run_id is not None and (folder.has("results") or folder.has("requests")):
        return process(taken_up(job, scorer, folder), job, now, folder, run_id)
    if drop:
        job.target.drop(spark)
    frames = new_frames(spark, job, cutoff_before(now, job.hours))
    if not frames or max_records == 0:
        return Summary()
    available = None
    if count_available:
        available = join_frames(needed_columns(frames, job)[0], job).count()

    def results() -> DataFrame:
        return enriched(frames, job, scorer, max_records, folder)

    return replace(process(results, job, now, folder, run_id), available=available)
