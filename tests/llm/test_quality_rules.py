from corpus import awkward, documents, texts
from helpers import collected

from freshet.llm import quality_rules
from freshet.llm.quality_rules import BASE, CORPUS, RULES, Policy


def test_measures():
    assert quality_rules.measure("a b\n\na b\n  \nc#") == (5, 6, 1, 3, 1, 0)
    assert quality_rules.measure("a b c a b c a")[5] == 7
    assert quality_rules.measure("x a b c y a b c z")[5] == 6
    assert quality_rules.measure("é" * 10 + "\t\U0001f600")[:2] == (2, 11)
    assert quality_rules.measure(None) == quality_rules.measure("") == (0, 0, 0, 0, 0, 0)


def test_policies_and_ablations_follow_from_the_bits(spark):
    rows = quality_rules.ledger(documents(spark, texts().items())).cache()
    bits = [r["failed"] for r in rows.collect()]
    for policy in (BASE, CORPUS, Policy("lenient", 2, tuple(RULES), may_fail=1)):
        kept = [(b & policy.mask).bit_count() <= policy.may_fail for b in bits]
        assert quality_rules.apply_policy(rows, policy).filter("kept").count() == sum(kept)
        for r in quality_rules.ablations(rows, policy).collect():
            bit = 1 << list(RULES).index(r["rule"])
            mine = [b & policy.mask for b in bits]
            assert r["n_failed"] == sum(bool(b & bit) for b in mine)
            assert r["n_failed_alone"] == sum(b == bit for b in mine)
            assert r["n_kept"] == sum(kept)
            assert r["n_kept_without"] == sum((b & ~bit).bit_count() <= policy.may_fail for b in mine)


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = quality_rules.apply_policy(quality_rules.ledger(docs), CORPUS)
    assert rows.count() == docs.count()
    found = {r["doc_id"]: r for r in rows.collect()}
    assert not found[1]["kept"] and found[1]["n_words"] == 0 and found[8]["word_chars"] == 300_000
    assert quality_rules.ledger(docs.limit(0)).count() == 0
    assert collected(quality_rules.ablations(quality_rules.ledger(docs.limit(0)), BASE)) == []
