import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from corpus import PROSE, awkward, documents, texts
from hypothesis import given, settings
from hypothesis import strategies as st

from freshet.llm import suffix_dedup
from freshet.llm.suffix_sort import BlindTrie, repeated

WIDTH = 200


def plain(rows):
    raw = [(i, (t or "").encode()) for i, t in rows]
    times = Counter(b[at : at + WIDTH] for _, b in raw for at in range(len(b) - WIDTH + 1))
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for at in range(len(b) - WIDTH + 1):
            if times[b[at : at + WIDTH]] > 1:
                gone[at : at + WIDTH] = b"\1" * WIDTH
        spans = sum(1 for at in range(len(b)) if gone[at] and (at == 0 or not gone[at - 1]))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows, **options):
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted((tuple(r) for r in suffix_dedup.passages(documents(spark, rows), **options).select(*columns).collect()), key=repr)


def test_against_brute_force(spark):
    rows = list(texts().items())
    expected = plain(rows)
    assert any(0 < r[2] < r[1] for r in expected)
    assert found(spark, rows) == expected


@pytest.mark.parametrize("max_runs", [4000, 1])
def test_edges_overlaps_and_repeats(spark, max_runs):
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("abcdeé ") for _ in range(rnd.randrange(1, 9)))
    noise = lambda n: " ".join(word() for _ in range(n))[:n]
    passages = [noise(n) for n in (199, 200, 201, 260, 900)]
    rows = []
    for i in range(60):
        parts = [noise(rnd.randrange(0, 150))]
        for _ in range(rnd.randrange(0, 4)):
            p = rnd.choice(passages)
            a = rnd.randrange(0, 30) if rnd.random() < 0.5 else 0
            parts += [p[a : len(p) - rnd.choice([0, 0, 1, 7])], noise(rnd.randrange(0, 60))]
        rows.append((i, "".join(parts)))
    rows += [(100, "ab" * 300), (101, "c" * 450), (102, "c" * 200), (103, PROSE * 9), (104, rows[7][1])]
    assert found(spark, rows, max_runs=max_runs) == plain(rows)


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] != 8]
    got = found(spark, rows)
    by_id = {r[0]: r for r in got}
    assert by_id[6][2] == by_id[6][1] == by_id[7][2] and by_id[1][1:4] == (0, 0, 0)
    assert len(got) == len(rows)
    one = found(spark, [(8, "x" * 300_000)])
    assert one[0][1:4] == (300_000, 300_000, 1)
    assert found(spark, []) == []


@settings(deadline=None, max_examples=60)
@given(st.text("ab", min_size=12, max_size=300), st.sampled_from([8, 12]), st.sampled_from([0, 8]))
def test_sorting_small_alphabets(text, width, shallow):
    raw = text.encode()
    starts = np.arange(max(0, len(raw) - width + 1))
    times = Counter(raw[i : i + width] for i in starts)
    expected = [times[raw[i : i + width]] > 1 for i in starts]
    assert repeated(raw, starts, np.zeros(len(starts), int), width, shallow).tolist() == expected
    trie = BlindTrie(raw, width)
    for i in starts.tolist():
        trie.insert(i)
    assert [raw[leaf[0] : leaf[0] + width] for leaf in trie.leaves()] == sorted(times)


def test_long_texts_in_slices(monkeypatch):
    raw = np.random.default_rng(1).integers(97, 100, 5000).astype(np.uint8)
    whole = suffix_dedup.runs(raw)
    monkeypatch.setattr(suffix_dedup, "_SLICE", 700)
    parts = suffix_dedup.runs(raw)
    at = lambda found: {w: (h, p) for h, p, a, b in zip(*(x.tolist() for x in found), strict=True) for w in range(a, b + 1)}
    assert at(whole) == at(parts)
