import zlib

import numpy as np
import pyarrow as pa
from comparison import DATA
from corpus import SF, awkward
from pyspark.sql import functions as F

from freshet.llm import quality_votes
from freshet.llm.frames import read
from freshet.llm.queries import op12_neighbour_votes


def test_sparse_products_are_those_of_dense_rows(monkeypatch):
    monkeypatch.setattr(quality_votes, "ENTRIES", 7)
    rng = np.random.default_rng(2)
    dense = rng.random((9, 12)) * (rng.random((9, 12)) < 0.4)
    dense[[3, 8]] = 0
    at = np.concatenate(([0], np.cumsum((dense > 0).sum(axis=1))))
    rows = quality_votes.Rows(np.nonzero(dense)[1], dense[dense > 0], at)
    one, two = rng.random((12, 3)), rng.random((9, 3))
    assert np.allclose(rows.times(one), dense @ one)
    assert np.allclose(rows.turned(12).times(two), dense.T @ two)


def test_votes_are_those_of_the_nearest_rows():
    rng = np.random.default_rng(3)
    vectors = quality_votes._unit(rng.normal(size=(200, 6))).astype(np.float32)
    asked = quality_votes._unit(rng.normal(size=(30, 6))).astype(np.float32)
    labels = (rng.random(200) < 0.5).astype(float)
    jury = quality_votes.Jury(np.zeros(2), np.zeros((2, 6)), vectors, labels)
    for vector, got in zip(asked, jury.vote(asked), strict=True):
        near = sorted(((float(vector @ v), y) for v, y in zip(vectors, labels, strict=True)), reverse=True)[: jury.neighbours]
        weights = [max(c, 0) ** jury.power for c, _ in near]
        assert abs(got - sum(w * y for w, (_, y) in zip(weights, near, strict=True)) / sum(weights)) < 1e-4


def test_axes_are_the_leading_ones():
    rng = np.random.default_rng(5)
    found = [quality_votes.terms(" ".join(rng.choice([f"w{chr(97 + i)}" for i in range(26)], 12)), quality_votes.Codes(), 9) for _ in range(60)]
    jury = quality_votes.fit(found, np.zeros(60), 9, axes=8)
    rows = quality_votes._rows(found, jury.weights)
    dense = rows.times(np.eye(512))
    best = np.linalg.svd(dense)[2][:8].T
    kept, most = np.linalg.norm(dense @ jury.axes), np.linalg.norm(dense @ best)
    assert kept > 0.97 * most


def test_held_out_documents(spark):
    docs, labels = read(spark, f"{DATA}/sf0.1", "documents"), read(spark, f"{DATA}/sf0.1", "labels")
    rows = quality_votes.score(docs, quality_votes.train(docs, labels)).filter("held_out").join(labels, "doc_id").collect()
    low = [r["predicted"] for r in rows if not r["quality"]]
    high = [r["predicted"] for r in rows if r["quality"]]
    assert len(low) > 100 and sum(low) < 0.04 * len(low)
    assert sum(high) > 0.99 * len(high)


def test_labels_of_held_out_rows_are_never_read(spark):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    flipped = labels.withColumn("quality", F.when(fold, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = quality_votes.train(docs, labels), quality_votes.train(docs, flipped)
    assert (one.vectors == two.vectors).all() and (one.labels == two.labels).all()


def test_query_gives_the_fold(spark):
    rows = op12_neighbour_votes(spark, SF).collect()
    assert len(rows) == 200
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)


def test_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(4, 1, 1), (4, 0, 0), (6, 0, 0), (None, 1, 1), (9, None, None), (7, 1, 0)], "doc_id long, quality int, score int")
    for given in (labels, labels.limit(0), labels.filter("quality = 1")):
        jury = quality_votes.train(docs, given)
        rows = quality_votes.score(docs, jury).collect()
        assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert quality_votes.score(docs.limit(0), jury).count() == 0
    empty = quality_votes.train(docs, labels.limit(0))
    assert empty.score_texts(pa.array(["", None, "a"]), quality_votes.Codes()).tolist() == [0.5] * 3
