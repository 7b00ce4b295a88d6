import json
import threading
import time

import pytest
from helpers import collected

from freshet.functions.lexicon import SentimentLexicon
from freshet.operators import scoring
from freshet.operators.scoring import RateLimited, Retry, score_with
from pyspark.sql import functions as F
import pyarrow as pa


def waits_until(success_at):
    waits, calls = [], []

    def fn(x):
        calls.append(x)
        if len(calls) < success_at:
            raise RateLimited("slow down")
        return x

    return waits, calls, fn


def test_retry_waits():
    waits, calls, fn = waits_until(5)
    assert Retry(sleep=waits.append).call(fn, "x") == "x"
    assert waits == [2, 2, 4, 8]


def test_retry_gives_up_after_five_attempts():
    waits, calls, fn = waits_until(99)
    with pytest.raises(RateLimited):
        Retry(sleep=waits.append).call(fn, "x")
    assert len(calls) == 5


def test_long_waits_are_bounded():
    waits, _, fn = waits_until(99)
    with pytest.raises(RateLimited):
        Retry(attempts=8, sleep=waits.append).call(fn, "x")
    assert waits == [2, 2, 4, 8, 16, 30, 30]


def test_other_errors_are_not_retried():
    calls = []

    def fn(x):
        calls.append(x)
        raise ValueError(x)

    with pytest.raises(ValueError):
        Retry(sleep=None).call(fn, "x")
    assert calls == ["x"]


def answer(prompt, payload):
    n = json.loads(payload)["n"]
    if n % 3 == 0:
        raise RuntimeError(f"refused {n}")
    if n % 5 == 0:
        raise RateLimited("always")
    return f"{prompt}:{n}"


@pytest.mark.parametrize("workers", [1, 7])
def test_rows_keep_their_keys(spark, workers):
    big = 2**60 + 1
    rows = [(None if i % 4 == 0 else big + i, bytes([i]), f'{{"n": {i}}}') for i in range(40)]
    df = spark.createDataFrame(rows, "k long, b binary, payload string").repartition(3)
    scored = score_with(df, answer, "p", workers=workers, retry=Retry(sleep=lambda _: None))
    assert scored.columns == ["k", "b", "content", "error"]
    for row in scored.collect():
        n = row["b"][0]
        assert row["k"] == (None if n % 4 == 0 else big + n)
        if n % 3 == 0:
            assert (row["content"], row["error"]) == (None, f"RuntimeError: refused {n}")
        elif n % 5 == 0:
            assert row["content"] is None and row["error"].startswith("RateLimited")
        else:
            assert (row["content"], row["error"]) == (f"p:{n}", None)


def test_no_rows(spark):
    df = spark.createDataFrame([], "k long, payload string")
    assert score_with(df, answer, "p").count() == 0


@pytest.mark.parametrize("workers", [0, 51])
def test_worker_range(spark, workers):
    with pytest.raises(ValueError):
        score_with(spark.createDataFrame([], "k long, payload string"), answer, "p", workers=workers)


def test_lexicon_edges(spark):
    texts = [None, "", "   ", "Good", "good, bad. GOOD! ugly", "…good…", "bad bad good 1good1", "goodness"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    scores = df.select("i", SentimentLexicon(("good",), ("bad",))(F.col("t")).alias("a")).select("i", "a.*")
    assert collected(scores) == [
        (0, 0.0, "neutral", 0.0),
        (1, 0.0, "neutral", 0.0),
        (2, 0.0, "neutral", 0.0),
        (3, 1.0, "positive", 1.0),
        (4, 0.333333, "positive", 0.75),
        (5, 1.0, "positive", 1.0),
        (6, 0.0, "neutral", 1.0),
        (7, 0.0, "neutral", 0.0),
    ]


@pytest.mark.parametrize("workers", [3, 13, 20])
def test_calls_in_flight_are_bounded_over_all_tasks(spark, tmp_path, workers):
    log = str(tmp_path / "calls")

    def slow(prompt, payload):
        for sign in "+-":
            with open(log, "a") as out:
                out.write(f"{time.time():.6f} {sign}\n")
            if sign == "+":
                time.sleep(0.05)
        return payload

    df = spark.range(90).selectExpr("id", "cast(id as string) as payload").repartition(6)
    assert score_with(df, slow, "p", workers=workers).filter("content = cast(id as string)").count() == 90
    at, most = 0, 0
    for line in sorted(open(log)):
        at += 1 if line.split()[1] == "+" else -1
        most = max(most, at)
    assert workers // 2 < most <= workers


def batches(*sizes):
    at = 0
    for size in sizes:
        yield pa.RecordBatch.from_pydict({"payload": [str(i) for i in range(at, at + size)]})
        at += size


def test_a_waiting_row_frees_its_worker():
    calls, lock = [], threading.Lock()

    def call(text):
        with lock:
            calls.append(text)
            if text == "0" and calls.count("0") < 3:
                raise RateLimited("later")
        return text

    waits = []
    out = list(scoring.answered(batches(3, 3, 3), "payload", call, 1, Retry(sleep=waits.append)))
    assert [b.content for b in out] == [["0", "1", "2"], ["3", "4", "5"], ["6", "7", "8"]]
    # With a single worker, all other rows were called before the first one's second attempt.
    assert calls.index("8") < [i for i, c in enumerate(calls) if c == "0"][1] and len(waits) == 2


def test_open_batches_are_bounded():
    taken = []

    def source():
        for batch in batches(*[1] * 20):
            taken.append(batch)
            yield batch

    def call(text):
        if text == "0":
            raise RateLimited("always")
        return text

    out = scoring.answered(source(), "payload", call, 2, Retry(sleep=lambda _: None))
    assert next(out).errors == ["RateLimited: always"] and len(taken) <= scoring.OPEN_BATCHES + 1
    assert sum(1 for _ in out) == 19


def test_threads_answer_each_row_once():
    """Errors, rows to be called again and several batches at once, by several threads."""
    tries, lock = {}, threading.Lock()

    def call(text):
        n = int(text)
        with lock:
            tries[n] = tries.get(n, 0) + 1
        if n % 7 == 0:
            raise ValueError(text)
        if tries[n] <= n % 3:
            raise RateLimited(text)
        return text

    retry = Retry(shortest=0, longest=0.001, sleep=lambda _: None)
    out = list(scoring.answered(batches(*[50] * 30), "payload", call, 5, retry))
    rows = [(c, e) for b in out for c, e in zip(b.content, b.errors, strict=True)]
    assert rows == [(None, f"ValueError: {n}") if n % 7 == 0 else (str(n), None) for n in range(1500)]
    assert all(tries[n] == (1 if n % 7 == 0 else n % 3 + 1) for n in range(1500))


@pytest.mark.parametrize("workers", [1, 3])
def test_a_quick_model_is_not_held_up(workers):
    """The share of a row in the time is small: a hand-over between threads for each takes several times as long."""
    began = time.perf_counter()
    assert sum(len(b.content) for b in scoring.answered(batches(*[10_000] * 10), "payload", str, workers, Retry())) == 100_000
    assert time.perf_counter() - began < 3.5


def test_large_frames_are_scored_in_rounds(spark, tmp_path, monkeypatch):
    """No task reads more than its share of a round, and each row is called once, however often the result is read."""
    log, parts = str(tmp_path / "calls"), []

    def noting(prompt, payload):
        with open(log, "a") as out:
            out.write(payload + "\n")
        return payload

    at_once = scoring.score_at_once
    monkeypatch.setattr(scoring, "FILE_ROWS", 100)
    monkeypatch.setattr(scoring, "score_at_once", lambda df, *rest: (parts.append(df.count()), at_once(df, *rest))[1])
    df = spark.range(0, 1000, 1, 4).selectExpr("id", "cast(id as string) as payload")
    scored = score_with(df, noting, "p", workers=2, task_bytes=1)
    assert max(parts) <= 100 and sum(parts) == 1000
    for _ in range(2):
        assert collected(scored.select("id", "content", "error")) == sorted([(i, str(i), None) for i in range(1000)], key=repr)
    assert sum(1 for _ in open(log)) == 1000
