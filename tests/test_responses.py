import json
import random
from datetime import date, datetime

import pytest

from freshet.functions.models import SENTIMENT, USER_NEEDS, Field, Model
from freshet.operators.responses import REASONS, parse_responses, valid_rows

GOOD = '{"score":0.9,"sentiment":"positive","confidence":0.9}'

CASES = [
    (GOOD, None),
    ("", "empty_content"),
    (None, "empty_content"),
    ("  ", "invalid_json"),
    ("not json", "invalid_json"),
    ("[]", "invalid_json"),
    ("3", "invalid_json"),
    ("null", "invalid_json"),
    ('"text"', "invalid_json"),
    ('{"score":0.1', "invalid_json"),
    (GOOD + " trailing", "invalid_json"),
    (GOOD + GOOD, "invalid_json"),
    (GOOD + "," + GOOD, "invalid_json"),
    (GOOD + "] x", "invalid_json"),
    (GOOD + "} x", "invalid_json"),
    ("[" + GOOD + "]", "invalid_json"),
    ("{'score':0.9}", "invalid_json"),
    ('{"score":0.9,}', "invalid_json"),
    ('{"score":NaN,"sentiment":"positive","confidence":0.9}', "invalid_json"),
    ("{}", "empty_object"),
    (" { } ", "empty_object"),
    ('{"":1}', "empty_key"),
    ('{"score":0.9,"sentiment":"positive","confidence":0.9,"":0}', "empty_key"),
    ('{"score":"0.9"}', "type_mismatch"),
    ('{"score":"NaN","sentiment":"positive","confidence":0.9}', "type_mismatch"),
    ('{"score":true,"sentiment":"positive","confidence":0.9}', "type_mismatch"),
    ('{"score":0.9,"sentiment":3,"confidence":0.9}', "type_mismatch"),
    ('{"score":0.9,"sentiment":["positive"],"confidence":0.9}', "type_mismatch"),
    ('{"score":0.9,"sentiment":"angry","confidence":0.9}', "domain"),
    ('{"score":0.9,"sentiment":"Positive","confidence":0.9}', "domain"),
    ('{"score":1}', "missing_field"),
    ('{"score":null,"sentiment":"neutral","confidence":0.9}', "missing_field"),
    ('{"score":0.9,"sentiment":null,"confidence":0.9}', "missing_field"),
    ('{"score":1,"sentiment":"neutral","confidence":0}', None),
    (' \n{"confidence":0.9,"score":-0.5,"sentiment":"negative"}\n', None),
    ('{"score":0.9,"sentiment":"neutral","confidence":0.9,"extra":{"":[1]}}', None),
]


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [(i, content) for i, (content, _) in enumerate(CASES)]
    df = parse_responses(spark.createDataFrame(rows, "id int, content string"), SENTIMENT)
    return {row["id"]: row for row in df.collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_reason(parsed, i):
    content, reason = CASES[i]
    row = parsed[i]
    assert row["reject_reason"] == reason
    result = (row["score"], row["sentiment"], row["confidence"])
    if reason is None:
        answer = json.loads(content)
        assert result == tuple(answer[name] for name in ("score", "sentiment", "confidence"))
    else:
        assert reason in REASONS
        assert result == (None, None, None)


def test_failed_call_goes_first(spark):
    df = spark.createDataFrame([(1, GOOD, "refused"), (2, GOOD, None)], "id int, content string, error string")
    out = parse_responses(df, SENTIMENT, error="error")
    assert out.columns == ["id", "score", "sentiment", "confidence", "reject_reason"]
    assert {row["id"]: row["reject_reason"] for row in out.collect()} == {1: "call_error", 2: None}
    assert valid_rows(out).columns == ["id", "score", "sentiment", "confidence"]
    assert [row["id"] for row in valid_rows(out).collect()] == [2]


def needs(**changes):
    answer = {
        "wissen": {"type": "update me", "score": 0.5, "confidence": 1},
        "verstehen": {"type": "educate me", "score": 0.5, "confidence": 1},
        "fuehlen": {"type": "help me", "score": 0.5, "confidence": 1},
        "machen": {"type": "divert me", "score": 0.5, "confidence": 1},
        "summary": "Grüße",
    }
    return json.dumps({**answer, **changes})


def test_nested_answers(spark):
    cases = [
        (needs(), None),
        (needs(wissen={"type": "educate me", "score": 0.5, "confidence": 1}), "domain"),
        (needs(wissen={"type": "update me", "score": "0.5", "confidence": 1}), "type_mismatch"),
        (needs(wissen={"type": 1, "score": 0.5, "confidence": 1}), "type_mismatch"),
        (needs(wissen={"type": "update me", "score": 0.5}), "missing_field"),
        (needs(machen=None), "missing_field"),
        (needs(machen=[]), "type_mismatch"),
        (needs(summary=5), "type_mismatch"),
    ]
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "id int, content string")
    rows = sorted(parse_responses(df, USER_NEEDS).collect(), key=lambda row: row["id"])
    assert [row["reject_reason"] for row in rows] == [reason for _, reason in cases]
    assert rows[0]["wissen.type"] == "update me"
    assert rows[0]["machen.confidence"] == 1.0
    assert rows[0]["summary"] == "Grüße"


def test_flat_columns_survive_parquet(spark, tmp_path):
    df = spark.createDataFrame([(1, needs())], "id int, content string")
    parse_responses(df, USER_NEEDS).write.parquet(str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).select("`fuehlen.type`").first()[0] == "help me"


def test_a_model_of_one_s_own(spark):
    model = Model("own", "?", (Field("n", int), Field("ok", bool), Field("deep", fields=(Field("x", fields=(Field("y", str),)),))))
    assert model.result_schema().simpleString() == "struct<n:bigint,ok:boolean,deep.x:struct<y:string>>"


def judged(content):
    """The rules once more, in plain Python."""
    if not content:
        return "empty_content"
    try:
        answer = json.loads(content, parse_constant=lambda _: 1 / 0)
    except (ValueError, ZeroDivisionError):
        return "invalid_json"
    if not isinstance(answer, dict):
        return "invalid_json"
    if not answer:
        return "empty_object"
    if "" in answer:
        return "empty_key"
    numbers = [answer.get("score"), answer.get("confidence")]
    if any(isinstance(n, bool) or not isinstance(n, (int, float, type(None))) for n in numbers):
        return "type_mismatch"
    label = answer.get("sentiment")
    if not isinstance(label, (str, type(None))):
        return "type_mismatch"
    if label is not None and label not in ("positive", "negative", "neutral"):
        return "domain"
    return "missing_field" if None in numbers or label is None else None


def test_damaged_answers(spark):
    rng = random.Random(5)
    whole = [
        GOOD,
        '{"score": -1, "sentiment": "neutral", "confidence": null, "x": [1, {"": 2}]}',
        '{"score": "1", "sentiment": "neutral", "confidence": 1}',
        '{"score": 1, "sentiment": ["neutral"], "confidence": true}',
        '{"": 1, "score": 1}',
        "{ }",
    ]
    contents = []
    for _ in range(1500):
        text = list(rng.choice(whole))
        for _ in range(rng.randrange(1, 4)):
            at = rng.randrange(len(text))
            kind = rng.randrange(3)
            if kind == 0:
                del text[at : at + rng.choice([1, 1, 2, 12])]
            elif kind == 1:
                text.insert(at, rng.choice('{}[]",:019.-eE \n\\tnul'))
            else:
                text.append(rng.choice('{}[]", \nx'))
            if not text:
                break
        contents.append("".join(text))
    df = spark.createDataFrame([(i, c) for i, c in enumerate(contents)], "id int, content string")
    got = {row["id"]: row["reject_reason"] for row in parse_responses(df, SENTIMENT).collect()}
    wrong = [(c, got[i], judged(c)) for i, c in enumerate(contents) if got[i] != judged(c)]
    assert wrong == []
    assert set(got.values()) >= {None, *REASONS} - {"call_error", "empty_content"}


def test_one_parse_an_answer(spark):
    df = spark.createDataFrame([(1, needs())], "id int, content string")
    for model in (SENTIMENT, USER_NEEDS):
        plan = parse_responses(df, model)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 1
        assert not any(name in plan for name in ("json_object_keys", "json_array_length", "parse_json", "parseJson"))


def test_keys_that_come_twice(spark):
    cases = [
        ('{"score":"x","sentiment":"neutral","confidence":1,"score":0.5}', None),
        ('{"score":0.5,"sentiment":"neutral","confidence":1,"score":"x"}', "type_mismatch"),
        ('{"score":0.5,"sentiment":"neutral","confidence":1,"x":{"a":1,"a":2}}', "invalid_json"),
    ]
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "id int, content string")
    rows = sorted(parse_responses(df, SENTIMENT).collect(), key=lambda row: row["id"])
    assert [row["reject_reason"] for row in rows] == [reason for _, reason in cases] and rows[0]["score"] == 0.5


def test_fields_of_all_types(spark):
    model = Model("all", "?", (
        Field("n", int), Field("b", bool), Field("t", datetime), Field("d", date), Field("raw", bytes), Field("x", float),
        Field("deep", fields=(Field("a", fields=(Field("y", str), Field("z", int))),)),
    ))
    good = {"n": 2**62, "b": False, "t": "2024-01-02T03:04:05", "d": "2024-01-02", "raw": "YWI=", "x": 12345678901234567890.5, "deep": {"a": {"y": "q", "z": 1}}}
    changes = [{}, {"n": 1.5}, {"n": 2**70}, {"b": "false"}, {"t": "soon"}, {"d": 3}, {"raw": "?"}, {"x": "1"}, {"deep": {"a": []}}, {"deep": {"a": {"y": "q"}}}, {"d": None}]
    reasons = [None, *["type_mismatch"] * 8, *["missing_field"] * 2]
    df = spark.createDataFrame([(i, json.dumps({**good, **c})) for i, c in enumerate(changes)], "id int, content string")
    out = parse_responses(df, model)
    assert [f.dataType.simpleString() for f in out.schema][1:-1] == ["bigint", "boolean", "timestamp_ntz", "date", "binary", "double", "struct<y:string,z:bigint>"]
    rows = sorted(out.collect(), key=lambda row: row["id"])
    assert [row["reject_reason"] for row in rows] == reasons
    first = tuple(rows[0])[1:-1]
    assert first == (2**62, False, datetime(2024, 1, 2, 3, 4, 5), date(2024, 1, 2), bytearray(b"ab"), 12345678901234567890.5, ("q", 1))


def test_a_filter_of_the_reason_parses_once(spark):
    """Valid rows alone are found from the parse that is there, not from one for each rule below a shuffle."""
    rows = spark.range(8).selectExpr("id", """concat('{"score":', id, ',"sentiment":"positive","confidence":1}') as content""")
    valid = valid_rows(parse_responses(rows.repartition(2), SENTIMENT))
    plan = valid._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    assert valid.count() == 8
