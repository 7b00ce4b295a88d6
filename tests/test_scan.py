from datetime import datetime, timedelta, timezone

import pytest
from helpers import at, collected
from pyspark.sql import types as T

from freshet.functions.times import cutoff_before
from freshet.sources.scan import Source, check_same_key, load_table, read_json_rows, read_sources, relative_cutoff, scan_window

SCHEMA = "k long, ts timestamp_ntz"


def test_window_keeps_the_cutoff_itself_and_drops_missing_times(spark):
    df = spark.createDataFrame([(1, at(9)), (2, at(10)), (3, at(11)), (4, None)], SCHEMA)
    assert collected(scan_window(df, "ts", at(10)).select("k")) == [(2,), (3,)]
    assert collected(scan_window(df, "ts", None).select("k")) == [(1,), (2,), (3,)]


def test_window_on_zoned_times_is_in_utc(spark):
    df = spark.sql("select timestamp'2024-01-10 10:00:00+02:00' as ts")
    assert scan_window(df, "ts", at(8)).count() == 1
    assert scan_window(df, "ts", at(8, 1)).count() == 0
    east = timezone(timedelta(hours=2))
    assert scan_window(df, "ts", datetime(2024, 1, 10, 10, tzinfo=east)).count() == 1


def test_window_reaches_the_parquet_scan(spark, tmp_path):
    spark.createDataFrame([(1, at(9))], SCHEMA).write.parquet(str(tmp_path / "t"))
    plan = scan_window(spark.read.parquet(str(tmp_path / "t")), "ts", at(9))._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(ts,2024-01-10T09:00)" in plan


def test_cutoff():
    assert cutoff_before(at(10), 3) == at(7)
    assert cutoff_before(at(10), None) is None
    with pytest.raises(ValueError):
        cutoff_before(at(10), 0)


def test_relative_cutoff(spark):
    df = spark.createDataFrame([(1, at(9)), (2, at(12)), (3, None)], SCHEMA)
    assert relative_cutoff(df, "ts", 2) == at(10)
    assert relative_cutoff(df.limit(0), "ts", 2) is None


def test_missing_tables_read_as_none(spark, tmp_path):
    assert load_table(spark, table="default.nowhere") is None
    assert load_table(spark, path=str(tmp_path / "nowhere")) is None
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="footer"):
        load_table(spark, path=str(tmp_path / "broken"))


def source(spark, *hours):
    return Source("k", "ts", frame=spark.createDataFrame([(h, at(h)) for h in hours], SCHEMA))


def test_empty_sources(spark, tmp_path):
    full, old, missing = source(spark, 11, 12), source(spark, 1), Source("k", "ts", path=str(tmp_path / "nowhere"))
    sources = [old, full, missing]
    assert [s for s, _ in read_sources(spark, sources, at(10), warm=False)] == [full]
    assert read_sources(spark, sources, at(10), warm=True) == []
    assert read_sources(spark, [full, missing], at(10), warm=True) == []
    assert [s for s, _ in read_sources(spark, [full, old], at(1), warm=True)] == [full, old]


def test_sources_must_share_the_key(spark):
    with pytest.raises(ValueError):
        check_same_key([Source("k", "ts", table="a"), Source("other", "ts", table="b")])


def test_json_rows(spark, tmp_path):
    path = tmp_path / "rows.json"
    path.write_text(
        '[{"post_key": "a", "post_message": "Grüße 😀", "likes": "4"},\n {"post_key": "b", "post_message": null}]',
        encoding="utf-8",
    )
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("post_key", "post_message", "likes")])
    assert collected(read_json_rows(spark, str(path), schema)) == [("a", "Grüße 😀", "4"), ("b", None, None)]
