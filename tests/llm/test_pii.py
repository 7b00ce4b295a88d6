import hashlib
import random
import re

import pytest
from corpus import awkward, documents, texts
from helpers import collected
from pyspark.sql import functions as F

from freshet.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def passes(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return 10 <= len(digits) <= 15 if kind == "phone" else True


def plain(text):
    out = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        out += [(m.start(), order, m.end(), kind) for m in re.finditer(pattern, text or "") if passes(kind, m[0])]
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(out)]


def expected_row(doc_id, text):
    spans = plain(text)
    counts = [sum(s.startswith(f"{k}:") for s in spans) for k in PATTERNS]
    return (doc_id, *counts, hashlib.sha256(",".join(spans).encode()).hexdigest())


BASE_COLUMNS = ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")


def found_rows(spark, rows):
    return collected(pii.digest(*pii.find(documents(spark, rows))).select(*BASE_COLUMNS))


def test_base_spans_of_texts(spark):
    rows = list(texts().items())
    assert any(plain(t) for _, t in rows)
    assert found_rows(spark, rows) == sorted((expected_row(i, t) for i, t in rows), key=repr)


def test_base_spans_of_odd_texts(spark):
    rnd = random.Random(3)
    bits = [
        "a@b.co", "x.y+z@sub.dom-ain.org_u@v.w", "@", ".", "..", "a@b", "a@b.", "1.2.3.4", "1.2.3.4.5.6.7.8", "255.256.1.1", "000255.0.0.01",
        "4111 1111 1111 1111", "4111-1111-1111-1112", "4041894974608795", "+1 (988) 555-2485", "+12", "+1-2-3-4-5-6-7-8-9-0", "+", "-", " ", "\n",
        "é", "\U0001f600", "0", "7" * 25, "12 34", "(", ")",
    ]
    rows = [(i, "".join(rnd.choice(bits) for _ in range(rnd.randrange(1, 14)))) for i in range(400)]
    assert found_rows(spark, rows) == sorted((expected_row(i, t) for i, t in rows), key=repr)


@pytest.fixture(scope="module")
def many(spark):
    """Confirmed addresses and numbers, as many plain tokens with digits, and some near misses."""
    rnd = random.Random(8)
    rows = []
    for i in range(900):
        what = i % 4
        if what == 0:
            rows.append((i, f"please call +1 ({rnd.randrange(200, 999)}) 555-{rnd.randrange(1000, 9999)} or write m{i}@mail.example.com today"))
        elif what == 1:
            rows.append((i, f"the token is {rnd.getrandbits(80):020x}a and id AK{rnd.getrandbits(60):X}Z there"))
        elif what == 2:
            rows.append((i, f"chapter {rnd.randrange(9)} of volume{rnd.randrange(99)} has nothing private in it"))
        else:
            rows.append((i, f"please call 1 ({rnd.randrange(200, 999)}) 555-{rnd.randrange(1000, 9999)} today"))
    return rows


def test_trees_add_near_misses_and_leave_plain_tokens(spark, many):
    rows, found = pii.find(documents(spark, many))
    spans = found.join(rows, "_row").select("doc_id", "base", "kind").collect()
    added = [r for r in spans if not r["base"]]
    assert {r["doc_id"] for r in spans if r["base"]} == {i for i in range(900) if i % 4 == 0}
    assert not any(r["doc_id"] % 4 in (1, 2) for r in added)


def test_redaction(spark):
    docs = documents(spark, [(1, "I am a.b@c.org or +1 (988) 555-2485."), (2, "none"), (3, None)])
    assert collected(pii.redact(docs).select("doc_id", "text")) == [(1, "I am [email] or [phone]."), (2, "none"), (3, None)]


def test_awkward_rows(spark):
    docs = awkward(spark)
    found = pii.digest(*pii.find(docs))
    assert found.count() == docs.count()
    assert found.filter(F.col("spans") != "").count() == 0
    empty = pii.digest(*pii.find(docs.limit(0)))
    assert empty.count() == 0
    long = documents(spark, [(1, "a@b.co " * 3000), (2, "a." * 50_000 + "@b" + ".c" * 50_000)])
    assert collected(pii.digest(*pii.find(long)).select("doc_id", "n_email")) == [(1, 3000), (2, 1)]


def test_threshold_stops_at_the_first_doubtful_scores():
    sure = [(0.9, True)] * 40 + [(0.8, True)] * 39 + [(0.8, False)]
    assert pii.calibrated(sure) == 0.8
    # Doubtful scores do not hide behind the sure ones above them.
    assert pii.calibrated(sure + [(0.5, True)] * 9 + [(0.5, False)] * 11 + [(0.1, True)] * 900) == 0.8
    assert pii.calibrated([(0.9, False)] * 30) is None and pii.calibrated([(0.9, True)] * 5) is None


def test_candidates_of_one_score_come_with_their_number():
    assert pii.calibrated([(0.9, True, 40), (0.8, True, 39), (0.8, False, 1)]) == 0.8
    assert pii.calibrated([(0.9, True, 40), (0.8, False, 3), (0.8, True, 17)]) == 0.9


def test_all_candidates_count(spark, many, monkeypatch):
    """None is left out of the fit and the threshold, however many there are."""
    _, found = pii.spans(documents(spark, [(i, text) for i in range(30) for _, text in many]))
    n = found.filter("not base").count()
    assert n > 30_000
    assert pii.counted(found).groupBy().sum("n").first()[0] == n
    told = []
    calibrated = pii.calibrated
    monkeypatch.setattr(pii, "calibrated", lambda scored: (told.extend(scored), calibrated(scored))[1])
    assert pii.train(found).thresholds
    held = found.filter("not base").filter(F.pmod(F.xxhash64("_row", "start", "end", "by"), F.lit(3)) == 0)
    assert sum(times for _, _, times in told) == held.count()
