"""Each stage of the pipeline against brute force on what the one before it left."""

import re

import corpus_pipeline
import pytest
from corpus import SF, awkward, texts
from helpers import collected
from test_simhash import components, plain
from tokenizers import Tokenizer

from freshet.llm import mixing, packing, toxicity
from freshet.llm.frames import materialise, read


@pytest.fixture(scope="module")
def stages(spark):
    kept = [read(spark, SF, "documents")]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(materialise(stage(spark, kept[-1], SF), "stage"))
    return kept


def bare(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text)


def test_five_stages_on_documents(stages):
    assert [name.split("_")[0] for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact", "simhash", "mixing", "packing"]
    assert [k.columns for k in stages[1:5]] == [stages[0].columns] * 4
    assert corpus_pipeline.ORACLE_SQL is None


def test_what_is_predicted_toxic_goes(spark, stages):
    docs, clean = stages[:2]
    machine = toxicity.train(docs, read(spark, SF, "labels"))
    expected = toxicity.score(docs, machine).filter("predicted = 0").select("doc_id")
    assert collected(clean.select("doc_id")) == collected(expected)


def test_one_of_each_exact_group_stays(stages):
    groups = {}
    for r in stages[1].collect():
        groups.setdefault(bare(r["text"]), []).append((-len(r["text"]), r["doc_id"]))
    assert sorted(r["doc_id"] for r in stages[2].collect()) == sorted(min(g)[1] for g in groups.values())


def test_one_of_each_near_group_stays(stages):
    rows = sorted((r["doc_id"], r["text"]) for r in stages[2].collect())
    roots = set(components([plain(t) for _, t in rows]))
    assert sorted(r["doc_id"] for r in stages[3].collect()) == [rows[i][0] for i in sorted(roots)]


def test_the_mix_has_the_words_of_its_targets(stages):
    near, mixed = stages[3], stages[4]
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(near).collect() if r["taken"]}
    found = {}
    for r in mixed.collect():
        found[r["doc_id"]] = found.get(r["doc_id"], 0) + len(r["text"].encode().split())
    assert found == taken
    total = sum(len(r["text"].encode().split()) for r in near.collect())
    assert abs(sum(found.values()) - 1.5 * total) < 0.02 * total


def test_the_mix_is_packed_whole(stages):
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    rows = [r.asDict() for r in stages[5].collect()]
    lengths = sorted(
        min(packing.CAPACITY, n - at)
        for n in (len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1 for r in stages[4].collect())
        for at in range(0, n, packing.CAPACITY)
    )
    assert sorted(r["length"] for r in rows) == lengths
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in places.values():
        ends = [0, *(a + n for a, n in sorted(parts))]
        assert [a for a, _ in sorted(parts)] == ends[:-1] and ends[-1] <= packing.CAPACITY
    assert len(places) <= 1.03 * sum(lengths) / packing.CAPACITY + 2


def test_run_gives_the_last_stage(spark, stages):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == stages[5].columns and rows.count() == stages[5].count() > len(texts()) // 2


def test_stages_take_awkward_rows(spark):
    docs = awkward(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = materialise(stage(spark, docs, SF), "stage")
        assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= docs.count()
