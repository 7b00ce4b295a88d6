import math

import numpy as np
import pytest
from comparison import DATA
from helpers import at
from test_jobs import job_on, posts

from freshet import Target, run_job
from freshet.functions import distilled
from freshet.functions.models import SENTIMENT, USER_NEEDS
from freshet.operators.responses import flatten
from freshet.plans import views
from freshet.plans.catalogue import NEEDS_WORDS, SENTIMENT_WORDS
from freshet.plans.jobs import Native
from pyspark.sql import functions as F


def answers(spark, sf, words, model):
    """The answers of a deterministic stand-in for a model, beside their texts."""
    rows = views.posts(spark, f"{DATA}/{sf}").select("post_message", words(F.col("post_message")).alias("a"))
    return flatten(rows, "a", model)


def test_agreement_on_held_out_answers(spark):
    scorer = distilled.distil(answers(spark, "sf0.1", SENTIMENT_WORDS, SENTIMENT), "post_message", SENTIMENT)
    assert scorer.agreement["sentiment"] >= 0.9
    assert scorer.agreement["score"] < 0.12 and scorer.agreement["confidence"] < 0.05


def test_the_expression_is_the_fitted_model(spark):
    """Column expression against numpy, on texts of all kinds."""
    given = answers(spark, "sf0.001", NEEDS_WORDS, USER_NEEDS)
    scorer = distilled.distil(given, "post_message", USER_NEEDS)
    texts = [None, "", " ,. ", "the", "the The THE of", "Öl und Straße 42", *[r[0] for r in given.select("post_message").limit(20).collect()]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", distilled.word_buckets(F.col("t")).alias("b"), scorer(F.col("t")).alias("a")).orderBy("i").collect()
    numbers = distilled._dense([r["b"] for r in rows], scorer.bits) @ np.array(scorer.weights).T
    wanted = list(distilled._numbers(USER_NEEDS))
    assert [len(r["b"]) for r in rows[:6]] == [0, 0, 0, 1, 4, 4]
    for row, expected in zip(rows, numbers, strict=True):
        best = {}
        for (name, _, value), n in zip(wanted, expected, strict=True):
            group, part = name.split(".")
            if value is None:
                assert math.isclose(row["a"][group][part], n, abs_tol=2e-6)
            elif group not in best or n > best[group][0]:
                best[group] = (n, value)
        assert {g: row["a"][g]["type"] for g in best} == {g: v for g, (_, v) in best.items()}
        assert row["a"]["summary"] == "; ".join(v for _, v in best.values())


def test_a_job_goes_on_by_the_answers_it_has(spark, tmp_path):
    scorer = distilled.distil(answers(spark, "sf0.001", SENTIMENT_WORDS, SENTIMENT), "post_message", SENTIMENT)
    target = Target("k", "written_at", path=str(tmp_path / "t"))
    job = job_on(target, posts(spark, [(i, at(8), "that with the" if i % 2 else None) for i in range(6)]))
    assert run_job(spark, job, Native(scorer), now=at(12)).written == 6
    stored = target.load(spark)
    assert stored.columns == ["written_at", "score", "sentiment", "confidence", "k"]
    assert stored.filter("sentiment is null or score is null").count() == 0


@pytest.mark.parametrize("rows", [[], [("a b", None, None, None)], [("a b", 1.0, "positive", 0.5)], [(None, 1.0, "neutral", 0.5)] * 30])
def test_few_answers(spark, rows):
    given = spark.createDataFrame(rows, "t string, score double, sentiment string, confidence double")
    scorer = distilled.distil(given, "t", SENTIMENT)
    out = spark.createDataFrame([("x",), (None,)], "t string").select(scorer(F.col("t")).alias("a")).collect()
    assert all(r["a"]["sentiment"] in ("positive", "negative", "neutral") for r in out)
    assert all(math.isfinite(r["a"]["score"]) for r in out)


def test_all_answers_are_learned_from(spark):
    """The sums over tasks are those of all rows, also past 20,000 answers."""
    texts = ["the cat", "a dog and the cat", "no", None, "the the the", "dog dog"]
    rows = spark.range(0, 24_000, 1, 5).select(
        F.get(F.array(*[F.lit(t) for t in texts]), (F.col("id") % 6).cast("int")).alias("t"),
        (F.col("id") % 7 / 7).alias("score"),
        F.when(F.col("id") % 2 == 0, "positive").otherwise("negative").alias("sentiment"),
        F.lit(0.5).alias("confidence"),
    )
    learned = rows.filter(F.pmod(F.xxhash64("t"), F.lit(5)) != 0).select(distilled.word_buckets(F.col("t")).alias("b"), "score", "sentiment").collect()
    assert len(learned) > 20_000
    x = distilled._dense([r["b"] for r in learned], distilled.BITS)
    goal = np.array([[r["score"], r["sentiment"] == "positive"] for r in learned], float)
    gram = x.T @ x + distilled.PENALTY * np.diag([1.0] * (x.shape[1] - 1) + [0.0])
    gram[-1, -1] += 1e-9
    expected = np.linalg.solve(gram, x.T @ goal).T
    scorer = distilled.distil(rows, "t", SENTIMENT)
    wanted = [(n, v) for n, _, v in distilled._numbers(SENTIMENT)]
    got = np.array([scorer.weights[wanted.index(("score", None))], scorer.weights[wanted.index(("sentiment", "positive"))]])
    assert np.allclose(got, expected, atol=1e-6)
