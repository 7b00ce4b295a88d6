"""Runs that fail at some place and are started again: nothing is lost, asked twice or written twice."""

import json
import os
from collections import Counter
from dataclasses import replace
from datetime import timedelta

import pytest
from helpers import at, collected
from test_jobs import GOOD, TEXTS, WORDS, facts, job_on, posts

from freshet import Summary, Target, run_job
from freshet.operators import waves
from freshet.operators.scoring import Retry
from freshet.plans.jobs import Completer
from freshet.streaming.backlog import Backlog, work_off
from freshet.streaming.stream import start_stream
from pyspark.sql import functions as F


@pytest.fixture
def target(tmp_path):
    return Target("k", "written_at", path=str(tmp_path / "target"), partition_by="month", runs=str(tmp_path / "runs"))


def batch(spark, *rows):
    return spark.createDataFrame(rows, "score double, k long")


def test_an_append_counts_once_committed(spark, target, monkeypatch):
    assert target.append(batch(spark, (0.5, 1)), at(8), "one")
    assert not target.append(batch(spark, (0.6, 1)), at(9), "one")
    write = Target._write
    monkeypatch.setattr(Target, "_write", lambda self, rows: (write(self, rows), 1 / 0))
    with pytest.raises(ZeroDivisionError):
        target.append(batch(spark, (0.7, 2)), at(9), "two")
    monkeypatch.undo()
    # The rows are in the files, but the run is not committed.
    assert spark.read.parquet(target.path).count() == 2
    assert collected(target.load(spark)) == [(at(8), 0.5, 1)] and not target.committed(spark, "two")
    assert target.append(batch(spark, (0.7, 2)), at(10), "two")
    assert collected(target.load(spark)) == [(at(10), 0.7, 2), (at(8), 0.5, 1)]
    assert collected(target.load(spark, at(9))) == [(at(10), 0.7, 2)]
    assert target.load(spark).columns == ["written_at", "score", "k"]
    target.drop(spark)
    assert target.load(spark) is None and not target.committed(spark, "one")
    with pytest.raises(ValueError):
        replace(target, runs=None).append(batch(spark, (0.5, 1)), at(8), "one")


def test_a_first_append_that_fails_leaves_no_rows(spark, target, monkeypatch):
    write = Target._write
    monkeypatch.setattr(Target, "_write", lambda self, rows: (write(self, rows), 1 / 0))
    with pytest.raises(ZeroDivisionError):
        target.append(batch(spark, (0.7, 2)), at(9), "two")
    assert target.load(spark).count() == 0 and target.load(spark, at(1)).count() == 0


def test_two_attempts_at_once_give_one(spark, target):
    """Both write before either commits: readers agree on one."""
    target.append(batch(spark, (0.5, 1)), at(8), "one")
    hidden = replace(target, runs=target.runs + "-other")
    hidden.append(batch(spark, (0.6, 1)), at(8), "one")
    spark.read.parquet(hidden.runs).write.mode("append").parquet(target.runs)
    assert target.load(spark).count() == 1


def counting(log, fail_at=None):
    """A model that notes each call in a file, and takes its worker process down from some call on."""

    def complete(prompt, payload):
        with open(log, "a") as out:
            out.write(payload + "\n")
        if fail_at is not None and sum(1 for _ in open(log)) >= fail_at:
            os._exit(1)
        return GOOD

    return complete


def calls(log):
    return Counter(line.strip() for line in open(log))


def requests(spark, n):
    rows = spark.range(n).selectExpr("id", "concat('{\"n\": ', id, '}') as payload")
    return rows.withColumn(waves.REQUEST, waves.request_id(rows, ["id"], "payload"))


def test_waves_are_kept(spark, tmp_path):
    """The run is lost in its third wave; started again it asks for what is missing alone."""
    log, folder = str(tmp_path / "calls"), waves.RunFolder(spark, str(tmp_path / "run"))
    asked = folder.once("requests", lambda: requests(spark, 60))
    with pytest.raises(Exception):
        waves.ask_in_waves(asked, counting(log, 35), "p", folder, workers=1, wave_rows=15)
    before = calls(log).total()
    kept = spark.read.parquet(folder.place("answers")).count()
    assert 15 <= kept < 60
    again = waves.ask_in_waves(folder.once("requests", None), counting(log), "p", folder, workers=4, wave_rows=15)
    assert collected(again.select("id", "content", "error")) == sorted([(i, GOOD, None) for i in range(60)], key=repr)
    assert calls(log).total() == before + 60 - kept
    # All answers there: nobody is asked.
    assert waves.ask_in_waves(asked, None, "p", folder, workers=4).count() == 60


def test_equal_requests_are_asked_once(spark, tmp_path):
    log, folder = str(tmp_path / "calls"), waves.RunFolder(spark, str(tmp_path / "run"))
    rows = requests(spark, 5).unionAll(requests(spark, 5))
    assert waves.ask_in_waves(rows, counting(log), "p", folder, workers=3).count() == 10
    assert set(calls(log).values()) == {1} and len(calls(log)) == 5


def test_calls_that_fail_are_answers_too(spark, tmp_path):
    folder = waves.RunFolder(spark, str(tmp_path / "run"))

    def complete(prompt, payload):
        n = json.loads(payload)["n"]
        if n % 2:
            raise ValueError(n)
        return str(n)

    out = waves.ask_in_waves(requests(spark, 6), complete, "p", folder, retry=Retry(sleep=None), wave_rows=2)
    assert collected(out) == sorted([(n, None, f"ValueError: {n}") if n % 2 else (n, str(n), None) for n in range(6)], key=repr)


def test_requests_without_payload_or_rows(spark, tmp_path):
    rows = spark.createDataFrame([(1, None), (None, "")], "id long, payload string")
    rows = rows.withColumn(waves.REQUEST, waves.request_id(rows, ["id"], "payload"))
    folder = waves.RunFolder(spark, str(tmp_path / "run"))
    assert waves.ask_in_waves(rows, lambda p, x: "yes", "p", folder).count() == 2
    empty = waves.RunFolder(spark, str(tmp_path / "empty"))
    assert waves.ask_in_waves(rows.limit(0), lambda p, x: "yes", "p", empty).count() == 0


def test_a_stage_is_written_once(spark, tmp_path):
    folder = waves.RunFolder(spark, str(tmp_path / "run"))
    assert folder.once("a", lambda: spark.range(3)).count() == 3
    assert folder.once("a", lambda: spark.range(9)).count() == 3
    spark.range(5).write.parquet(folder.place("b"))  # without its mark: a part
    assert folder.once("b", lambda: spark.range(9)).count() == 9
    folder.clear("a", "b", "never")
    assert not folder.has("a") and folder.once("a", lambda: spark.range(4)).count() == 4


def test_a_run_is_taken_up(spark, tmp_path, target):
    """Lost while it asks, then between results and commit, then repeated once committed."""
    log = str(tmp_path / "calls")
    job = job_on(target, posts(spark, [(i, at(8), f"text {i}") for i in range(40)]), workers=2, seed=None)
    with pytest.raises(Exception):
        run_job(spark, job, Completer(counting(log, 18), wave_rows=8), 30, now=at(12), run_id="noon")
    assert target.load(spark) is None
    first = set(calls(log))

    def broken(self, rows):
        raise OSError("disk")

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(Target, "_write", broken)
        with pytest.raises(OSError):
            run_job(spark, job, Completer(counting(log), wave_rows=8), 30, now=at(13), run_id="noon")
    asked = calls(log)
    # The same 30 rows, drawn once, although the sample has no seed.
    assert first <= set(asked) and len(asked) == 30
    summary = run_job(spark, job, Completer(counting(log)), 30, now=at(14), run_id="noon")
    assert summary == Summary(30, 30, {}) and calls(log) == asked
    assert run_job(spark, job, Completer(counting(log)), 30, now=at(15), run_id="noon") == Summary()
    assert target.load(spark).count() == 30 and calls(log) == asked
    with pytest.raises(ValueError):
        run_job(spark, replace(job, target=replace(target, runs=None)), WORDS, run_id="noon")


class Feed:
    """A folder of post files, a job, a backlog and a stream over them."""

    def __init__(self, spark, tmp_path, target, *others, **options):
        self.spark, self.folder, self.state = spark, str(tmp_path / "in"), str(tmp_path / "stream")
        self.backlog = Backlog(str(tmp_path / "backlog"))
        posts(spark, []).write.parquet(self.folder)
        self.job = job_on(target, posts(spark, []), *others, **options)

    def add(self, *rows):
        posts(self.spark, rows).coalesce(1).write.mode("append").parquet(self.folder)

    def run(self, hour, k=4, scorer=WORDS, state=None):
        stream = self.spark.readStream.schema(posts(self.spark, []).schema).parquet(self.folder)
        query = start_stream(stream, self.job, scorer, state or self.state, lambda: at(hour), max_records=k, backlog=self.backlog)
        query.awaitTermination()

    def waiting(self):
        return self.backlog.waiting(self.spark).count()


MANY = [(i, at(8), "good" if i % 2 else "bad") for i in range(10)]


def test_a_large_batch_in_capped_triggers(spark, tmp_path, target):
    feed = Feed(spark, tmp_path, target)
    feed.add(*MANY)
    feed.run(12)
    assert (target.load(spark).count(), feed.waiting()) == (4, 6)
    assert work_off(spark, feed.job, WORDS, feed.backlog, 4, at(13)) == Summary(4, 4, {})
    feed.add((99, at(9), "plain"))
    feed.run(14)
    assert feed.waiting() == 0
    assert work_off(spark, feed.job, WORDS, feed.backlog, 4, at(15)) == Summary()
    stored = collected(target.load(spark).select("k", "written_at"))
    assert sorted(k for k, _ in stored) == [*range(10), 99]
    assert Counter(t for _, t in stored) == {at(12): 4, at(13): 4, at(14): 3}

    # The whole input once more, as after losing the stream's own state: all of it is processed.
    feed.run(16, state=str(tmp_path / "fresh"))
    assert feed.waiting() == 0 and target.load(spark).count() == 11


@pytest.mark.parametrize("place", ["write", "retire"])
def test_a_trigger_that_fails_is_taken_up(spark, tmp_path, target, place):
    """Between backlog and append, and between append and retiring, with the stream's batch offered again."""
    feed = Feed(spark, tmp_path, target)
    feed.add(*MANY)

    def broken(self, *args):
        raise OSError("disk")

    write = Target._write

    def broken_write(self, rows):
        return broken(self) if self is target or self.path == target.path else write(self, rows)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(*((Target, "_write", broken_write) if place == "write" else (Backlog, "retire", broken)))
        with pytest.raises(Exception, match="disk"):
            feed.run(12)
    assert feed.waiting() == 10
    feed.run(13)
    # The batch came back and was not kept twice; the failed trigger's rows are the first written.
    assert (target.load(spark).count(), feed.waiting()) == (4, 6)
    for hour in (14, 15):
        work_off(spark, feed.job, WORDS, feed.backlog, 4, at(hour))
    assert sorted(r["k"] for r in target.load(spark).collect()) == list(range(10)) and feed.waiting() == 0


def test_waiting_rows_that_come_again_are_kept_once(spark, tmp_path, target):
    feed = Feed(spark, tmp_path, target)
    feed.add(*MANY)
    feed.run(12)
    feed.run(13, state=str(tmp_path / "fresh"))
    assert (target.load(spark).count(), feed.waiting()) == (8, 2)


def test_every_row_of_a_key_is_scored(spark, tmp_path, target):
    """Rows of a key written by an earlier trigger keep their text of the other source."""
    feed = Feed(spark, tmp_path, target)
    feed.job = job_on(target, facts(spark, []), posts(spark, [(1, at(8), "good"), (2, at(8), "bad")]), seed=3)
    stream_rows = facts(spark, [(1 + i % 2, at(9), i) for i in range(9)])
    folder = str(tmp_path / "facts")
    stream_rows.coalesce(1).write.parquet(folder)
    stream = spark.readStream.schema(stream_rows.schema).parquet(folder)
    start_stream(stream, feed.job, WORDS, feed.state, lambda: at(12), max_records=4, backlog=feed.backlog).awaitTermination()
    for hour in (13, 14):
        work_off(spark, feed.job, WORDS, feed.backlog, 4, at(hour))
    scores = Counter((r["k"], r["score"]) for r in target.load(spark).collect())
    assert scores == {(1, 1.0): 5, (2, -1.0): 4} and feed.waiting() == 0


def test_rejected_rows_go_on_waiting(spark, tmp_path, target):
    feed = Feed(spark, tmp_path, target, workers=2)
    feed.add(*MANY)

    def picky(prompt, payload):
        return GOOD if "good" in payload else "no"

    feed.run(12, k=10, scorer=Completer(picky))
    assert (target.load(spark).count(), feed.waiting()) == (5, 5)
    assert work_off(spark, feed.job, Completer(lambda p, x: GOOD), feed.backlog, 10, at(13)) == Summary(5, 5, {})
    with pytest.raises(ValueError):
        work_off(spark, replace(feed.job, target=replace(target, runs=None)), WORDS, feed.backlog, 1)


def test_a_stream_without_cap_writes_a_batch_once(spark, tmp_path, target):
    feed = Feed(spark, tmp_path, target)
    feed.add(*MANY)

    def run(hour, state):
        stream = spark.readStream.schema(posts(spark, []).schema).parquet(feed.folder)
        start_stream(stream, feed.job, WORDS, state, lambda: at(hour)).awaitTermination()

    with pytest.MonkeyPatch.context() as patch:
        write = Target._write
        patch.setattr(Target, "_write", lambda self, rows: (write(self, rows), 1 / 0))
        with pytest.raises(Exception):
            run(12, feed.state)
    run(13, feed.state)
    stored = target.load(spark)
    assert stored.count() == 10 and stored.filter(F.col("written_at") == at(13)).count() == 10


def test_claims(spark, target):
    """One holds at a time, until it is released or too old; of two at the very same time not both."""
    hour = timedelta(hours=1)
    first = target.claim(spark, at(8), hour)
    assert first and target.claim(spark, at(8, 30), hour) is None
    target.release(spark, first, at(8, 40))
    second = target.claim(spark, at(8, 45), hour)
    assert second and target.claim(spark, at(9, 30), hour) is None
    assert target.claim(spark, at(9, 50), hour)  # the second was lost
    other = replace(target, runs=target.runs + "-b")
    for name in ("b", "a"):
        other._note_claim(spark, name, at(8), at(9))
    assert other.claim(spark, at(8), hour) is None
    other.release(spark, "a", at(8))
    assert other.claim(spark, at(8), hour) is None  # b still holds, whatever its name
    other.release(spark, "b", at(8))
    assert other.claim(spark, at(8), hour)
    with pytest.raises(ValueError):
        replace(target, runs=None).claim(spark, at(8), hour)


def test_runs_that_overlap(spark, target):
    """A run that starts while another asks does nothing; afterwards the next one finds what is left."""
    job = job_on(target, posts(spark, MANY))
    inner = []

    class Nested(type(WORDS)):
        def enrich(self, rows, job, folder, carry=()):
            inner.append(run_job(spark, job, WORDS, now=at(12), alone=timedelta(hours=1)))
            return super().enrich(rows, job, folder, carry)

    outer = run_job(spark, job, Nested(WORDS.answer), 4, now=at(12), alone=timedelta(hours=1))
    assert inner == [Summary()] and outer.written == 4
    with pytest.raises(ZeroDivisionError):
        run_job(spark, job, Completer(lambda p, x: GOOD, wave_rows=0), now=at(13), alone=timedelta(hours=1))
    assert run_job(spark, job, WORDS, None, now=at(14), alone=timedelta(hours=1)).written == 6
    assert target.load(spark).count() == 10


def test_many_quick_waves_are_asked_together(spark, tmp_path, monkeypatch):
    """In far fewer jobs than waves, none of more than a quarter of what was answered before."""
    sizes, at_once = [], waves.score_at_once
    monkeypatch.setattr(waves, "score_at_once", lambda rows, *rest: (sizes.append(rows.count()), at_once(rows, *rest))[1])
    log, folder = str(tmp_path / "calls"), waves.RunFolder(spark, str(tmp_path / "run"))
    assert waves.ask_in_waves(requests(spark, 800), counting(log), "p", folder, workers=2, wave_rows=20).count() == 800
    assert len(sizes) <= 20 and sum(sizes) == 800 and max(sizes) > 60
    assert max(Counter(calls(log)).values()) == 1
