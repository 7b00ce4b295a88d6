import json
from datetime import datetime

import pytest
from helpers import at, collected

from freshet import Job, Source, Summary, Target, run_job
from freshet.functions.lexicon import SentimentLexicon
from freshet.functions.models import SENTIMENT
from freshet.plans.jobs import Completer, Native, select_rows
from freshet.streaming.stream import start_stream

WORDS = Native(SentimentLexicon(("good",), ("bad",)))
GOOD = '{"score": 0.5, "sentiment": "positive", "confidence": 1}'


def posts(spark, rows):
    return spark.createDataFrame(rows, "k long, ts timestamp_ntz, post_message string")


def facts(spark, rows):
    return spark.createDataFrame(rows, "k long, ts timestamp_ntz, id long")


@pytest.fixture
def target(tmp_path):
    return Target("k", "written_at", path=str(tmp_path / "target"), partition_by="month")


def job_on(target, *frames, **options):
    sources = tuple(Source("k", "ts", frame=df, row_id=("id",) if "id" in df.columns else ()) for df in frames)
    return Job(sources, target, SENTIMENT, ("post_message",), **{"hours": 24, "seed": 7, **options})


TEXTS = [(1, at(8), "good"), (2, at(9), "bad day"), (3, at(10), "plain")]


def test_nothing_to_read(spark, target):
    assert run_job(spark, job_on(target, posts(spark, [])), WORDS, now=at(12)) == Summary()
    assert run_job(spark, job_on(target, posts(spark, TEXTS)), WORDS, max_records=0, now=at(12)) == Summary()
    assert target.load(spark) is None


def test_no_valid_answer_leaves_no_target(spark, target):
    summary = run_job(spark, job_on(target, posts(spark, TEXTS)), Completer(lambda p, x: "no"), now=at(12))
    assert summary == Summary(3, 0, {"invalid_json": 3})
    assert target.load(spark) is None


def test_native_run_and_second_run(spark, target):
    job = job_on(target, posts(spark, TEXTS))
    assert run_job(spark, job, WORDS, now=at(12), count_available=True) == Summary(3, 3, {}, 3)
    stored = target.load(spark)
    assert stored.columns == ["written_at", "score", "sentiment", "confidence", "k"]
    assert collected(stored) == [
        (at(12), -1.0, "negative", 0.5, 2),
        (at(12), 0.0, "neutral", 0.0, 3),
        (at(12), 1.0, "positive", 1.0, 1),
    ]
    assert run_job(spark, job, WORDS, now=at(13)) == Summary()

    updated = job_on(target, posts(spark, [*TEXTS[:2], (3, at(13), "good good")]))
    assert run_job(spark, updated, WORDS, now=at(14)).written == 1
    assert target.load(spark).count() == 4
    assert run_job(spark, updated, WORDS, now=at(15), drop=True).written == 3
    assert target.load(spark).count() == 3


def test_rows_outside_the_window(spark, target):
    rows = [(1, datetime(2024, 1, 9, 11, 59), "good"), (2, datetime(2024, 1, 9, 12), "bad")]
    assert run_job(spark, job_on(target, posts(spark, rows)), WORDS, now=at(12)).written == 1
    assert run_job(spark, job_on(target, posts(spark, rows), hours=None), WORDS, now=at(12)).written == 1


def test_rejected_rows_come_again(spark, target):
    def picky(prompt, payload):
        assert prompt == SENTIMENT.prompt
        message = json.loads(payload)["post_message"]
        if message == "plain":
            raise ConnectionError
        return GOOD if message == "good" else ""

    job = job_on(target, posts(spark, TEXTS), workers=3)
    assert run_job(spark, job, Completer(picky), now=at(12)) == Summary(3, 1, {"empty_content": 1, "call_error": 1})
    assert run_job(spark, job, Completer(lambda p, x: GOOD), now=at(13)) == Summary(2, 2, {})


def test_the_model_is_asked_once_per_row(spark, target):
    calls = spark.sparkContext.accumulator(0)

    def counting(prompt, payload):
        calls.add(1)
        return GOOD

    job = job_on(target, posts(spark, [(i, at(8), "x") for i in range(30)]))
    assert run_job(spark, job, Completer(counting), max_records=20, now=at(12)).written == 20
    assert calls.value == 20


def test_left_join_after_the_cut(spark, target):
    """An update on the left alone loses the right columns; one on the right alone gives nothing."""
    first = job_on(target, facts(spark, [(1, at(8), 1), (2, at(8), 2)]), posts(spark, [(1, at(8), "good"), (2, at(8), "bad")]))
    assert run_job(spark, first, WORDS, max_records=None, now=at(12)).written == 2
    later = job_on(
        target,
        facts(spark, [(1, at(13), 1), (2, at(8), 2)]),
        posts(spark, [(1, at(8), "good"), (2, at(13), "bad")]),
    )
    assert collected(select_rows(spark, later, at(1)).select("k", "post_message")) == [(1, None)]
    assert run_job(spark, later, WORDS, max_records=None, now=at(14)).written == 1
    assert collected(target.load(spark, at(14)).select("k", "score", "sentiment")) == [(1, 0.0, "neutral")]


def test_a_source_emptied_by_the_state_still_joins(spark, target):
    target.append(spark.createDataFrame([(2, "x")], "k long, note string"), at(12))
    job = job_on(target, facts(spark, [(1, at(8), 1)]), posts(spark, [(2, at(8), "bad")]))
    assert collected(select_rows(spark, job, at(1)).select("k", "post_message")) == [(1, None)]


@pytest.mark.parametrize("max_records", [None, 1, 7, 50])
@pytest.mark.parametrize("message_on_the_left", [False, True])
def test_large_tables_give_the_same_result(spark, tmp_path, max_records, message_on_the_left):
    """Salted joins and late texts against broadcast joins; keys 0 and null are hot."""
    keys = [0 if i % 3 == 0 else None if i % 5 == 0 else i % 9 for i in range(40)]
    many = facts(spark, [(k, at(8), i) for i, k in enumerate(keys)])
    texts = posts(spark, [(k, at(8), ("good " * (k % 3) + "bad " * (k % 2) + str(k))) for k in range(0, 12, 2)] * 2)
    frames = [texts, many] if message_on_the_left else [many, texts]
    stored = []
    for large in (False, True):
        place = Target("k", "written_at", path=str(tmp_path / str(large)))
        job = job_on(place, *frames, large=large, hot_rows=3)
        run_job(spark, job, WORDS, max_records, now=at(12))
        stored.append(collected(place.load(spark)))
    assert stored[0] == stored[1]
    assert max_records is None or len(stored[0]) == max_records


def test_unseeded_runs_draw_different_rows(spark, tmp_path):
    drawn = []
    for name in "ab":
        place = Target("k", "written_at", path=str(tmp_path / name))
        job = job_on(place, posts(spark, [(i, at(8), "x") for i in range(500)]), seed=None)
        assert run_job(spark, job, WORDS, now=at(12)).written == 100
        drawn.append(collected(place.load(spark).select("k")))
    assert drawn[0] != drawn[1]


def test_job_definition():
    config = {
        "connector": {
            "source": {
                "tables": [
                    {"database": "gold", "table": "facts", "datetime_field": "ts", "index_field": "k"},
                    {"database": "gold", "table": "posts", "datetime_field": "ts", "index_field": "k"},
                ],
                "time_filter_hours": 10,
            },
            "target": {
                "database": "dev", "table": "sentiment", "datetime_field": "written_at", "index_field": "k",
                "location": "/data/sentiment", "partition_by": "month",
            },
        },
        "inference": {"workers": 20, "response_format": "sentiment", "include_fields": ["post_message"]},
    }
    job = Job.from_config(config, seed=1)
    assert [s.table for s in job.sources] == ["gold.facts", "gold.posts"]
    assert (job.target.table, job.target.path, job.target.partition_by) == ("dev.sentiment", "/data/sentiment", "month")
    assert (job.model, job.include, job.hours, job.workers) == (SENTIMENT, ("post_message",), 10, 20)
    config["connector"]["source"]["time_filter_hour"] = 10
    with pytest.raises(ValueError, match="time_filter_hour"):
        Job.from_config(config)
    del config["connector"]["source"]["time_filter_hour"]
    config["connector"]["source"]["tables"][1]["index_field"] = "id"
    with pytest.raises(ValueError):
        Job.from_config(config)


def test_catalog_tables(spark, tmp_path):
    posts(spark, TEXTS).write.saveAsTable("some_posts")
    try:
        job = Job(
            (Source("k", "ts", table="some_posts"), Source("k", "ts", table="not_there")),
            Target("k", "written_at", table="some_scores", partition_by="month"),
            SENTIMENT,
            ("post_message",),
        )
        assert run_job(spark, job, WORDS, now=at(12)).written == 3
        assert spark.table("some_scores").columns[-1] == "written_at_month"
        assert run_job(spark, job, WORDS, now=at(13)) == Summary()
    finally:
        spark.sql("DROP TABLE IF EXISTS some_posts")
        spark.sql("DROP TABLE IF EXISTS some_scores")


class Stream:
    """A folder of post files and a job that follows it."""

    def __init__(self, spark, tmp_path, target, *others):
        self.spark, self.folder, self.state = spark, str(tmp_path / "in"), str(tmp_path / "stream")
        posts(spark, []).write.parquet(self.folder)
        self.job = job_on(target, posts(spark, []), *others)

    def add(self, *rows):
        posts(self.spark, rows).coalesce(1).write.mode("append").parquet(self.folder)

    def run(self, hour, state=None):
        stream = self.spark.readStream.schema(posts(self.spark, []).schema).parquet(self.folder)
        query = start_stream(stream, self.job, WORDS, state or self.state, clock=lambda: at(hour))
        query.awaitTermination()


def test_stream(spark, tmp_path, target):
    stream = Stream(spark, tmp_path, target)
    stream.add(*TEXTS[:2])
    stream.run(12)
    assert target.load(spark).count() == 2
    stream.run(13)
    assert target.load(spark).count() == 2
    stream.add(TEXTS[2], (1, at(13), "bad"))
    stream.run(14)
    stored = collected(target.load(spark).select("k", "sentiment", "written_at"))
    assert stored == [(1, "negative", at(14)), (1, "positive", at(12)), (2, "negative", at(12)), (3, "neutral", at(14))]

    # The whole input once more, as after losing the stream's own state: nothing is written twice.
    stream.run(15, state=str(tmp_path / "fresh"))
    assert collected(target.load(spark).select("k", "sentiment", "written_at")) == stored


def test_a_batch_held_up_is_not_lost(spark, tmp_path, target):
    quality = Source("k", "ts", path=str(tmp_path / "quality"))
    target.append(spark.createDataFrame([(0.5, "positive", 1.0, 99)], "score double, sentiment string, confidence double, k long"), at(1))
    stream = Stream(spark, tmp_path, target)
    stream.job = Job((*stream.job.sources, quality), target, SENTIMENT, ("post_message",), hours=24)
    stream.add(*TEXTS)
    with pytest.raises(Exception, match="kept back"):
        stream.run(12)
    facts(spark, [(1, at(8), 5)]).write.parquet(quality.path)
    stream.run(13)
    assert collected(target.load(spark, at(12)).select("k")) == [(1,), (2,), (3,)]
