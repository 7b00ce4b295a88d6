import zlib

import numpy as np
from comparison import DATA
from corpus import SF, awkward, documents
from pyspark.sql import functions as F

from freshet.llm import toxicity
from freshet.llm.frames import read
from freshet.llm.queries import op2_toxicity_machine


def test_margins_are_those_of_all_pairs():
    rng = np.random.default_rng(1)
    m = toxicity.Machine(0.3, rng.normal(size=16), rng.normal(size=(16, 3)), rng.random(16))
    lists = [np.array([1, 4, 9], np.int32), np.zeros(0, np.int32), np.array([2], np.int32)]
    index, starts = toxicity._rows(lists)
    for row, got in zip(lists, m.margins(index, starts), strict=True):
        x = {i: m.values[i] for i in row}
        expected = m.bias + sum(m.weights[i] * x[i] for i in row)
        expected += sum(m.vectors[i] @ m.vectors[j] * x[i] * x[j] for i in row for j in row if i < j)
        assert abs(got - expected) < 1e-9


def test_pairs_are_learned_where_single_terms_say_nothing():
    """Both terms or none is one class, either alone the other: no weights of single terms can tell."""
    rng = np.random.default_rng(7)
    lists, labels = [], []
    for _ in range(3000):
        insult, mention = rng.random(2) < 0.4
        noise = rng.choice(np.arange(10, 200), 6, replace=False)
        lists.append(np.unique(np.concatenate((noise, [1] * int(insult), [2] * int(mention)))).astype(np.int32))
        labels.append(float(insult == mention))
    labels = np.array(labels)
    machine = toxicity.fit(lists[:2400], labels[:2400], bits=8, epochs=60)
    scores = machine.score(*toxicity._rows(lists[2400:]))
    assert ((scores >= 0.5) == (labels[2400:] > 0)).mean() > 0.9


def test_held_out_documents(spark):
    docs = read(spark, f"{DATA}/sf0.1", "documents")
    labels = read(spark, f"{DATA}/sf0.1", "labels")
    machine = toxicity.train(docs, labels)
    rows = toxicity.score(docs, machine).filter("held_out").join(labels, "doc_id").collect()
    toxic = [r["score"] for r in rows if r["toxic"]]
    clean = [r["score"] for r in rows if not r["toxic"]]
    assert len(toxic) > 15 and sum(s >= 0.5 for s in toxic) > 0.7 * len(toxic)
    assert sum(s >= 0.5 for s in clean) < 0.02 * len(clean)


def test_labels_of_held_out_rows_are_never_read(spark):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = toxicity.train(docs, labels), toxicity.train(docs, flipped)
    assert (one.weights == two.weights).all() and one.bias == two.bias


def test_query_gives_the_fold(spark):
    for r in op2_toxicity_machine(spark, SF).collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)


def test_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(4, 1, 1), (4, 0, 0), (6, 0, 0), (None, 1, 1), (9, None, None), (7, 0, 0)], "doc_id long, toxic int, score int")
    for given in (labels, labels.limit(0)):
        machine = toxicity.train(docs, given)
        rows = toxicity.score(docs, machine).collect()
        assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert toxicity.drop_toxic(docs, machine).columns == docs.columns
    assert toxicity.score(docs.limit(0), machine).count() == 0
