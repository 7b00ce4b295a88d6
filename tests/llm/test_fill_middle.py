import hashlib
import random

import numpy as np
import pytest
from corpus import awkward, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from freshet.llm import fill_middle

LETTERS = "aé€\U0001f600\x00\u07ff <P>"


def laid_out(texts):
    raw = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
    return np.frombuffer(b"".join(raw), np.uint8), offsets


def expected(text, h, plan=fill_middle.Plan()):
    n = len(text)
    if not n or any(m in text for m in (plan.prefix, plan.suffix, plan.middle)) or h[2] % 100 >= plan.cut:
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:low], text[low:high], text[high:]
    if h[3] % 100 < plan.suffix_first:
        return n, "spm", low, high - low, f"{plan.suffix}{s}{plan.prefix}{p}{plan.middle}{m}"
    return n, "psm", low, high - low, f"{plan.prefix}{p}{plan.suffix}{s}{plan.middle}{m}"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(LETTERS), max_size=40), min_size=1, max_size=6), st.randoms(use_true_random=False))
def test_cuts_are_those_of_code_points(texts, draw):
    h = [[draw.getrandbits(32) for _ in range(4)] for _ in texts]
    got = fill_middle._cut(*laid_out(texts), np.array(h, np.int64), fill_middle.Plan())
    assert [tuple(r.values()) for r in got.to_pylist()] == [expected(t, d) for t, d in zip(texts, h, strict=True)]


def test_every_place_is_found():
    text = "".join(random.Random(1).choices(LETTERS, k=500))
    data, _ = laid_out([text])
    ends, upto = fill_middle.unit_ends(data)
    units = np.arange(len(text) + 1)
    places = fill_middle.byte_after(ends, upto, units)
    assert places.tolist() == [len(text[:i].encode()) for i in units]
    assert fill_middle.units_before(ends, upto, places).tolist() == units.tolist()


def hashes(doc_id):
    hex_digits = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(hex_digits[i : i + 8], 16) for i in range(0, 32, 8)]


@pytest.mark.parametrize("size", (64, 4 * 2**20))
def test_awkward_rows(spark, monkeypatch, size):
    monkeypatch.setattr(fill_middle, "SLICE_BYTES", size)
    rows = [(i, t) for i, t in enumerate(["<P", "a<S>b", "<<P>", "<", "<M", "P>S>M>", "x", "<P><S><M>"] * 30)]
    docs = awkward(spark).unionByName(documents(spark, rows))
    out = fill_middle.transform(docs).collect()
    given = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
    want = [(i, *expected(t, hashes(i))) for i, t in given]
    assert sorted(map(tuple, out), key=repr) == sorted(want, key=repr)
    again = fill_middle.digest(fill_middle.transform(docs)).select("restored_sha256").collect()
    assert sorted(r[0] for r in again) == sorted(hashlib.sha256(t.encode()).hexdigest() for _, t in given)
    assert fill_middle.transform(docs.limit(0)).count() == 0


def test_other_markers(spark):
    plan = fill_middle.Plan("[prefix]", "[suffix]", "[middle]", cut=100, suffix_first=50)
    docs = documents(spark, [(i, f"text {i} " * 9) for i in range(40)])
    out = fill_middle.transform(docs, plan)
    back = out.select("doc_id", fill_middle.restored(out["output"], out["form"], plan).alias("t")).collect()
    assert {r["doc_id"]: r["t"] for r in back} == {i: f"text {i} " * 9 for i in range(40)}
    assert {r["form"] for r in out.collect()} == {"psm", "spm"}
    for bad in (("<a", "a<", "b"), ("aa", "b", "c"), ("", "b", "c"), ("ab", "xaby", "c")):
        with pytest.raises(ValueError):
            fill_middle.Plan(*bad)
