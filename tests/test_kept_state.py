"""The kept times of keys against the target's own rows."""

import random
from dataclasses import replace

import pytest
from helpers import at, collected
from test_jobs import TEXTS, WORDS, job_on, posts

from freshet import Summary, Target, run_job
from freshet.operators.state import last_processed
from freshet.sinks import kept_state
from freshet.sinks.kept_state import KeptState


@pytest.fixture
def target(tmp_path):
    return Target("k", "written_at", path=str(tmp_path / "target"), runs=str(tmp_path / "runs"), keep_state=True)


def batch(spark, keys):
    return spark.createDataFrame([(0.5, k) for k in keys], "score double, k long")


def agree(spark, target):
    for which in ("latest", "oldest"):
        assert collected(target.state(spark, which)) == collected(last_processed(target.load(spark), "k", "written_at", which))


def test_random_appends_losses_and_compactions(spark, target, monkeypatch):
    monkeypatch.setattr(kept_state.KeptState.compact, "__defaults__", (3,))
    rng = random.Random(5)
    assert target.state(spark) is None
    for hour in range(9):
        keys = [rng.choice([None, *range(12)]) for _ in range(8)]
        if hour % 4 == 2:
            # Rows and delta written, never committed.
            replace(target, runs=target.runs + "-lost", keep_state=False).append(batch(spark, keys), at(hour), f"lost {hour}")
            KeptState(target).add(batch(spark, keys), at(23), "lost")
        target.append(batch(spark, keys), at(hour), str(hour))
        if hour % 3 == 1:
            agree(spark, target)
    agree(spark, target)
    assert KeptState(target).epoch(spark) == 3
    latest = last_processed(target.load(spark, at(6)), "k", "written_at")
    assert collected(target.state(spark, "latest", at(6))) == collected(latest)
    assert collected(target.state(spark, "oldest", at(6))) == collected(last_processed(target.load(spark, at(6)), "k", "written_at", "oldest"))

    KeptState(target).rebuild(spark)
    assert KeptState(target).epoch(spark) == 4
    agree(spark, target)
    target.append(batch(spark, [1, 99]), at(20))
    agree(spark, target)

    target.drop(spark)
    assert target.state(spark) is None
    target.append(batch(spark, [7]), at(21))
    assert collected(target.state(spark)) == [(7, at(21))]


def test_an_append_during_a_compaction_is_not_lost(spark, target, monkeypatch):
    target.append(batch(spark, [1]), at(8))
    write = KeptState._write

    def racing(self, epoch, times):
        monkeypatch.setattr(KeptState, "_write", write)
        target.append(batch(spark, [2]), at(9))  # still of the epoch before
        write(self, epoch, times)

    monkeypatch.setattr(KeptState, "_write", racing)
    assert KeptState(target).compact(spark, 1)
    agree(spark, target)
    assert {r["state_key"] for r in target.state(spark).collect()} == {1, 2}
    assert KeptState(target).compact(spark, 1)
    agree(spark, target)


def test_a_job_reads_the_state_not_the_target(spark, target):
    job = job_on(target, posts(spark, TEXTS), hours=None)
    assert run_job(spark, job, WORDS, now=at(12)).written == 3
    plan = target.state(spark)._jdf.queryExecution().toString()
    assert target.path + "/" not in plan and "score" not in plan
    assert run_job(spark, job, WORDS, now=at(13)) == Summary()
    updated = job_on(target, posts(spark, [*TEXTS[:2], (3, at(13), "good good")]), hours=None)
    assert run_job(spark, updated, WORDS, now=at(14)).written == 1
    assert run_job(spark, updated, WORDS, now=at(15), drop=True).written == 3
    assert collected(target.state(spark)) == [(1, at(15)), (2, at(15)), (3, at(15))]


def test_it_needs_runs(spark, target):
    with pytest.raises(ValueError):
        replace(target, runs=None)
    with pytest.raises(ValueError):
        KeptState(target).load(spark, "oldest", at(1))
