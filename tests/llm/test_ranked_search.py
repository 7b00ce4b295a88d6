import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from comparison import DATA
from corpus import SF, awkward, documents

from freshet.llm import ranked_search as rs
from freshet.llm.frames import read

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_force(docs, items, k=50):
    bags = [(doc_id, Counter(plain_terms(text))) for doc_id, text in docs]
    bags = [(doc_id, bag) for doc_id, bag in bags if bag]
    n_docs, n_terms = len(bags), sum(bag.total() for _, bag in bags)
    df = Counter(t for _, bag in bags for t in bag)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, bag in bags:
            m = 50 + (50 * bag.total() * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 20 * m))
                for t in set(plain_terms(text))
                if t in bag
            )
            if score > 0:
                scores.append((-score, math.inf if doc_id is None else doc_id))
        out += [(item_id, i, None if d == math.inf else d, -s) for i, (s, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, **options):
    rows = rs.search(docs, items, **options).select("item_id", "rank", "doc_id", "score").collect()
    return sorted(map(tuple, rows), key=repr)


def test_terms():
    text = "A-b_ C9\x00d É ŉ\U0001f600x\x7f{~Z}"
    assert [t.decode() for t in rs.terms(text)] == plain_terms(text) and rs.terms(None) == []


def random_docs(seed, n):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    chances = [1 / (i + 1) for i in range(60)]
    texts = [" ".join(draw.choices(words, chances, k=draw.choice((1, 3, 20, 90)))) for _ in range(n)]
    # A third are copies of one text, some with other words behind.
    return [(i, texts[0] + " other" * (i % 2) if i % 3 == 0 else texts[i]) for i in range(n)]


@pytest.mark.parametrize("leaf", (1, 3, 32))
def test_trees_bound_and_prune(leaf):
    """Bounds hold for every document below a node; the best are found without scoring all."""
    docs = random_docs(3, 600)
    bags = [(i, Counter(plain_terms(t))) for i, t in docs]
    df = Counter(t for _, bag in bags for t in bag)
    order = {t: i for i, (t, _) in enumerate(sorted(df.items(), key=lambda x: (-x[1], x[0])))}
    corpus = rs.Corpus(len(bags), sum(b.total() for _, b in bags), np.zeros(0), np.zeros(0))
    vectors = [(np.array(sorted(order[t] for t in bag)), np.array([c for _, c in sorted((order[t], c) for t, c in bag.items())]), bag.total(), [i]) for i, bag in bags]
    tree = rs.Tree(vectors, corpus, leaf)
    for node, ((low, high), (first, last)) in enumerate(zip(tree.spans, tree.children, strict=True)):
        assert first == last or [tree.spans[first][0], tree.spans[last - 1][1]] == [low, high]
        for term in range(len(order)):
            weights = np.zeros(len(order), np.int64)
            weights[term] = 1
            bound = rs._sums(weights, tree.node_terms, tree.node_gains, tree.node_at, node, node + 1)[0]
            assert bound >= rs._sums(weights, tree.terms, tree.gains, tree.at, low, high).max()
    weights = np.zeros(len(order), np.int64)
    weights[[0, 1, 20, 25, 31]] = [3, 20, 4000, 4500, 5000]
    best = rs.Best(5)
    scored = tree.search(weights, best)
    scores = rs._sums(weights, tree.terms, tree.gains, tree.at, 0, len(docs))
    want = sorted(((int(s), -tree.ids[i][0]) for i, s in enumerate(scores)), reverse=True)[:5]
    assert sorted(best.heap, reverse=True) == want
    assert scored < len(docs)


@pytest.mark.parametrize("options", ({}, {"tree_entries": 40, "ahead": 3}, {"block_terms": 5, "ahead": 2}))
def test_same_as_brute_force(spark, options):
    docs = [*random_docs(5, 400), (None, "w1 w2 w40"), (7, "w1 w2 w40"), (7, "w1 w2 w40"), (900, None), (901, "--")]
    items = [(1, "w1 W2 w40 w40"), (2, "w0"), (3, ""), (4, None), (5, "absent w59, w58"), (5, "w3 w4"), (None, "w7")]
    given = spark.createDataFrame(items, "item_id long, text string")
    # Repeated and null item ids are items of their own; only their rows can be compared.
    assert found(spark, documents(spark, docs).repartition(3), given, **options) == brute_force(docs, items)


def test_small_k_and_ties(spark):
    docs = [(i, "same words here") for i in range(200)] + [(500, "same"), (501, "words same")]
    items = [(0, "same words"), (1, "here")]
    given = spark.createDataFrame(items, "item_id int, text string")
    for k in (1, 3, 250):
        assert found(spark, documents(spark, docs).repartition(4), given, k=k, ahead=2) == brute_force(docs, items, k)


def test_awkward_rows(spark):
    docs = awkward(spark)
    items = spark.createDataFrame([(1, "twice the row", 3), (2, "ß ENGINE", 4)], "item_id long, text string, score int")
    given = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(spark, docs, items) == brute_force(given, [(1, "twice the row"), (2, "ß ENGINE")])
    assert found(spark, docs.limit(0), items) == [] and found(spark, docs, items.limit(0)) == []
    assert found(spark, documents(spark, [(1, None), (2, "--")]), items) == []


def test_each_task_sends_few_rows(spark):
    """With the bound of a share searched ahead, tasks send on a fraction of k rows each."""
    docs = read(spark, f"{DATA}/sf0.01", "documents")
    items = [(r["item_id"], set(rs.terms(r["text"]))) for r in read(spark, SF, "benchmark").collect()]
    (block,) = rs.item_blocks(items)
    rows = rs.materialise(rs.vectors(docs, block.vocabulary, "text", "doc_id"), "test-vectors").repartition(12, "doc_id")
    corpus = rs.statistics(rows, len(block.vocabulary))
    k = 5
    ahead = rs._top(rs._searched(rows.filter("doc_id % 4 = 0"), block, corpus, k, {}, 10**6), k).filter(f"rank = {k}").collect()
    floors = {r["item"]: (r["score"], -r["doc_id"]) for r in ahead}
    sent = rs._searched(rows, block, corpus, k, floors, 10**6).count()
    without = rs._searched(rows, block, corpus, k, {}, 10**6).count()
    assert sent < 0.6 * without
