from decimal import Decimal

import pytest
from helpers import at, collected

from freshet.sinks.target import Target


@pytest.fixture(params=["path", "table", "table with a location"])
def target(request, spark, tmp_path):
    place = {
        "path": {"path": str(tmp_path / "t")},
        "table": {"table": "made"},
        "table with a location": {"table": "made", "path": str(tmp_path / "t")},
    }[request.param]
    made = Target("k", "written_at", partition_by="month", **place)
    yield made
    spark.sql("DROP TABLE IF EXISTS made")


def batch(spark, *rows):
    return spark.createDataFrame(rows, "score double, k long")


def test_life_of_a_target(spark, target):
    assert target.load(spark) is None
    target.drop(spark)
    target.append(batch(spark, (0.5, 1)), at(8))
    target.append(batch(spark, (0.7, 2), (0.9, None)).select("k", "score"), at(9))
    assert target.load(spark).columns == ["written_at", "score", "k"]
    assert collected(target.load(spark)) == [(at(8), 0.5, 1), (at(9), 0.7, 2), (at(9), 0.9, None)]
    assert collected(target.load(spark, at(9)).select("k")) == [(2,), (None,)]

    target.drop(spark)
    assert target.load(spark) is None
    other = spark.createDataFrame([("x", 3)], "label string, k long")
    target.append(other, at(10))
    assert collected(target.load(spark)) == [(at(10), "x", 3)]


def test_old_partitions_are_not_read(spark, tmp_path):
    target = Target("k", "written_at", path=str(tmp_path / "t"), partition_by=("year", "day"))
    target.append(batch(spark, (0.5, 1)), at(8))
    plan = target.load(spark, at(9))._jdf.queryExecution().toString()
    assert "written_at_day" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "written_at_year" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_unknown_partition():
    with pytest.raises(ValueError):
        Target("k", "written_at", path="x", partition_by="hour")
    with pytest.raises(ValueError):
        Target("k", "written_at")


def test_other_columns_are_refused(spark, tmp_path):
    target = Target("k", "written_at", path=str(tmp_path / "t"))
    target.append(batch(spark, (0.5, 1)), at(8))
    with pytest.raises(ValueError):
        target.append(batch(spark, (0.5, 1)).withColumnRenamed("score", "mark"), at(9))


def test_types_a_table_does_not_hold_become_text(spark, tmp_path):
    target = Target("k", "written_at", path=str(tmp_path / "t"))
    df = spark.createDataFrame([(Decimal("1.50"), 1, 2)], "d decimal(5,2), s short, k int")
    target.append(df, at(8))
    stored = target.load(spark)
    assert [f.dataType.simpleString() for f in stored.schema] == ["timestamp_ntz", "string", "string", "int"]
    assert collected(stored) == [(at(8), "1.50", "1", 2)]


def test_zoned_times_are_stored_as_utc_without_zone(spark, tmp_path):
    target = Target("k", "written_at", path=str(tmp_path / "t"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        target.append(spark.sql("select 1L as k, timestamp '2024-01-10 12:00:00+00:00' as seen"), at(13))
        stored = spark.read.parquet(target.path)
        assert dict(stored.dtypes)["seen"] == "timestamp_ntz"
        assert stored.first()["seen"] == at(12)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
