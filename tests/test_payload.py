import json
import math
import random
import struct
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from freshet.functions.models import MODELS, PYTHON_TYPES, SENTIMENT, USER_NEEDS, model_named, table_type
from freshet.functions.payload import float_text, payload_json, prompt_messages
from freshet.functions.times import partition_number
from pyspark.sql import types as T


def payloads(df, include=None):
    return [row[0] for row in df.select(payload_json(df, include)).collect()]


TEXTS = [
    "plain",
    "",
    'quote " slash / backslash \\ newline \n tab \t return \r feed \f back \b',
    "control \x00 \x01 \x1f \x7f",
    "umlaut äöüß é Ω 日本   ÿ ￿",
    "emoji 😀 👩‍👩‍👧",
    "a literal \\u00F6 and \\\\u00F6 and \\",
    "ABCDEF \\uABCD é \\",
]


@pytest.mark.parametrize("text", TEXTS)
def test_text(spark, text):
    df = spark.createDataFrame([(text,)], "post_message string")
    assert payloads(df) == [json.dumps({"post_message": text}, ensure_ascii=True)]


NUMBERS = [
    0.0, -0.0, 1.0, -1.5, 0.1, 100.0, 1e6, 1e7, 12345678.9, -123456789.125, 1e15, 1e16, 1.5e16, -1e20, 1.25e100,
    0.001, 0.0001, -0.00012345, 1e-5, 1.5e-7, 2.0 ** 53, 3.141592653589793, 9999999.0, 1e22,
]


def test_numbers(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(NUMBERS)], "i int, x double").orderBy("i")
    assert payloads(df, ["x"]) == [json.dumps({"x": x}) for x in NUMBERS]


def test_not_a_number(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),)], "x double").coalesce(1)
    assert payloads(df) == ['{"x": NaN}', '{"x": Infinity}', '{"x": -Infinity}']


def test_single_precision_shows_its_double(spark):
    df = spark.createDataFrame([(0.1,)], "x float")
    assert payloads(df) == ['{"x": 0.10000000149011612}']


def test_all_types(spark):
    df = spark.createDataFrame(
        [(1, 2, True, None, datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 60), b"ascii", b"\xc3\xa9",
          date(2024, 1, 2), Decimal("1.50"), [1, None], {"a": 1}, (1, "x"))],
        "i int, l long, b boolean, n string, t timestamp_ntz, u timestamp_ntz, a binary, x binary, "
        "d date, p decimal(5,2), y array<int>, m map<string,int>, s struct<q:int,r:string>",
    )
    assert payloads(df) == [
        '{"i": 1, "l": 2, "b": true, "n": null, "t": "2024-01-02T03:04:05", "u": "2024-01-02T03:04:05.000060", '
        '"a": "ascii", "x": "c3a9", "d": "2024-01-02", "p": "1.50", "y": [1, null], "m": [["a", 1]], '
        '"s": {"q": 1, "r": "x"}}'
    ]
    empty = df.select([F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema])
    assert json.loads(payloads(empty)[0]) == {name: None for name in df.columns}


def test_zoned_timestamp(spark):
    df = spark.sql("select timestamp'2024-01-02 03:04:05.5+01:00' as t")
    assert payloads(df) == ['{"t": "2024-01-02T02:04:05.500000+00:00"}']


def test_included_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "c int, a int, b int")
    assert payloads(df, ["a", "c", "unknown"]) == ['{"c": 1, "a": 2}']
    assert payloads(df, []) == ["{}"]


def test_messages(spark):
    df = spark.createDataFrame([("x",)], "m string")
    messages = df.select(prompt_messages("judge", payload_json(df)).alias("m")).first()["m"]
    assert [tuple(m) for m in messages] == [("system", "judge"), ("user", '{"m": "x"}')]


def test_models():
    assert set(MODELS) == {"sentiment", "user_needs"}
    assert model_named("Sentiment") is SENTIMENT
    with pytest.raises(ValueError):
        model_named("mood")
    assert SENTIMENT.result_schema().simpleString() == "struct<score:double,sentiment:string,confidence:double>"
    needs = USER_NEEDS.result_schema()
    assert needs.names == [
        f"{need}.{part}" for need in ("wissen", "verstehen", "fuehlen", "machen") for part in ("type", "score", "confidence")
    ] + ["summary"]
    assert [f.dataType.simpleString() for f in needs] == ["string", "double", "double"] * 4 + ["string"]


def test_types():
    assert [PYTHON_TYPES[t].simpleString() for t in (int, float, bool, str, bytes, datetime, date)] == [
        "bigint", "double", "boolean", "string", "binary", "timestamp_ntz", "date"
    ]
    assert table_type(T.IntegerType()) == T.IntegerType()
    for other in (T.ShortType(), T.DecimalType(10, 2), T.ArrayType(T.LongType()), T.StructType([])):
        assert table_type(other) == T.StringType()


def test_partition_numbers(spark):
    df = spark.sql("select explode(array(timestamp_ntz'1970-01-01', timestamp_ntz'2024-03-05 23:59:59', timestamp_ntz'1969-12-31')) as t")
    got = df.select(*[partition_number(F.col("t"), p) for p in ("year", "month", "day")]).collect()
    assert [tuple(row) for row in got] == [(0, 0, 0), (54, 650, 19787), (-1, -1, -1)]
    with pytest.raises(ValueError):
        partition_number(F.col("t"), "hour")


def test_any_text(spark):
    rng = random.Random(3)
    pools = [range(128), range(0x80, 0x250), range(0x3000, 0x3100), range(0x1F300, 0x1F700), [0x5C, 0x22, 0x75, 0x2F]]
    texts = ["".join(chr(rng.choice(rng.choice(pools))) for _ in range(rng.randrange(40))) for _ in range(500)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    assert payloads(df, ["t"]) == [json.dumps({"t": t}) for t in texts]


def test_any_number(spark):
    """The same value always; the same text but for a rare digit too many on older JDKs."""
    rng = random.Random(4)
    values = [rng.choice([-1, 1]) * round(rng.random() * 10, rng.randrange(1, 16)) * 10.0 ** rng.randrange(-30, 30) for _ in range(500)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, x double").orderBy("i")
    texts = payloads(df, ["x"])
    assert [json.loads(text)["x"] for text in texts] == values
    same = sum(text == json.dumps({"x": x}) for text, x in zip(texts, values))
    assert same > 0.9 * len(values)


def test_doubles_of_all_sizes(spark):
    rng = random.Random(17)
    bits = [rng.getrandbits(64) for _ in range(12_000)]
    values = [struct.unpack("<d", struct.pack("<Q", b))[0] for b in bits]
    values += [float(rng.randrange(2**53, 2**61)) for _ in range(1500)] + [rng.randrange(-(10**9), 10**9) / 10**rng.randrange(12) for _ in range(1500)]
    values += [2e23, 5e-324, 2.2250738585072014e-308, 1e22, 1e16, 9007199254740993.0, -0.0, 0.0, 1e-5, 123456789012345680.0, 2.0**60]
    values = [v for v in values if math.isfinite(v)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    shown = dict(df.select("i", float_text(F.col("v"))).collect())
    assert [(v, shown[i]) for i, v in enumerate(values) if shown[i] != json.dumps(v)] == []


def test_large_doubles(spark):
    """Twenty thousand values beyond 2^61, where two texts of a length may both give the value, and powers of two."""
    rng = random.Random(23)
    values = [rng.choice((-1, 1)) * rng.uniform(1, 10) * 10.0 ** rng.randrange(18, 308) for _ in range(18_000)]
    values += [math.nextafter(2.0**e, to) for e in range(60, 1024) for to in (0, 2.0**e, math.inf)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    shown = dict(df.select("i", float_text(F.col("v"))).collect())
    assert [(v, shown[i]) for i, v in enumerate(values) if shown[i] != json.dumps(v)] == []


def test_common_doubles_take_no_lambda(spark):
    """What most payloads hold is Java's own text; the long way stands behind a condition."""
    values = [0.0, -0.0, 1.5, -12345.678, 0.001, 9999999.5, 123456.789012345, 1e7, 0.00099, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double").coalesce(1)
    assert payloads(df) == [json.dumps({"v": v}) for v in values]
