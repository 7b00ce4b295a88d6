import random

import pytest
from helpers import collected

from freshet.operators import sizing, skew
from freshet.operators.joins import join_sources
from freshet.sources.scan import Source
from pyspark.sql import functions as F


def frame(spark, name, rows):
    return spark.createDataFrame(rows, f"k long, {name} string")


def brute(frames, how):
    """Left fold over (key, value) lists; null keys match nothing."""
    joined = [(key, value) for key, value in frames[0]]
    for i, right in enumerate(frames[1:], start=1):
        folded = []
        for row in joined:
            matches = [value for key, value in right if key is not None and key == row[0]]
            if not matches and how == "left":
                matches = [None]
            folded += [(*row, value) for value in matches]
        joined = folded
    return sorted(joined, key=repr)


LEFT = [(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e"), (None, "f")]
RIGHT = [(1, "x"), (1, "y"), (2, "z"), (4, "w"), (None, "n")]


@pytest.mark.parametrize("large", [False, True])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_two_frames(spark, how, large):
    joined = join_sources([frame(spark, "l", LEFT), frame(spark, "r", RIGHT)], "k", how, hot_rows=1, large=large)
    assert collected(joined) == brute([LEFT, RIGHT], how)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hot_rows", [1, 5, 40, 100_000])
def test_salted_fold_with_hot_keys(spark, how, hot_rows):
    rng = random.Random(hot_rows)

    def rows(n, share):
        """Key 7 and null each hold `share` of the rows, and many rows are copies."""
        keys = [7 if rng.random() < share else None if rng.random() < share else rng.randrange(30) for _ in range(n)]
        return [(key, f"v{rng.randrange(n // 4)}") for key in keys]

    data = [rows(60, 0.3), rows(50, 0.3), rows(20, 0.2)]
    frames = [frame(spark, name, d) for name, d in zip("abc", data)]
    joined = join_sources(frames, "k", how, hot_rows=hot_rows, large=True)
    assert collected(joined) == brute(data, how)


def test_a_key_hot_only_on_the_right_or_missing_there(spark):
    left = [(1, "a"), (2, "b"), (3, "c")]
    right = [(1, f"x{i}") for i in range(50)] + [(5, f"y{i}") for i in range(50)]
    joined = join_sources([frame(spark, "l", left), frame(spark, "r", right)], "k", hot_rows=3, large=True)
    assert collected(joined) == brute([left, right], "left")


def test_no_hot_keys_gives_a_plain_join(spark):
    frames = [frame(spark, "l", LEFT), frame(spark, "r", RIGHT)]
    assert skew.hot_keys(frames, "k", 100) is None
    joined = join_sources(frames, "k", large=True)
    assert "xxhash64" not in joined._jdf.queryExecution().toString()


def test_hot_keys_are_spread(spark):
    rows = [(7, str(i)) for i in range(1000)] + [(i, "x") for i in range(8, 40)]
    hot = skew.hot_keys([frame(spark, "v", rows)], "k", 100)
    assert collected(hot) == [(7, 1000, 1000.0)]


def test_large_sides_are_not_broadcast(spark):
    small = spark.sql("select * from values (1L, 'a'), (2L, 'b') as t(k, v)")
    assert sizing.fits_broadcast(small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not sizing.fits_broadcast(small)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_copies_of_a_row_are_spread_by_their_number(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1,)] * 600, "k long").write.parquet(path)
    source = Source("k", "ts", path=path)
    numbered = source.number(source.load(spark))
    assert numbered.select(skew.row_hash(numbered).alias("h")).distinct().count() == 600
    plain = frame(spark, "v", [(1, "x")])
    assert Source("k", "ts", frame=plain).number(plain).columns == ["k", "v"]
    plain.createOrReplaceTempView("a_view")
    assert Source("k", "ts", table="a_view").number(plain).columns == ["k", "v"]


def test_small_inputs_are_spread(spark):
    small = spark.range(100).coalesce(1)
    cores = spark.sparkContext.defaultParallelism
    assert sizing.spread_small(small).rdd.getNumPartitions() == cores
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1b")
    try:
        assert sizing.spread_small(small).rdd.getNumPartitions() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_unsupported_join(spark):
    with pytest.raises(ValueError):
        join_sources([frame(spark, "l", LEFT), frame(spark, "r", RIGHT)], "k", "full", hot_rows=1, large=True)


def test_same_named_columns(spark):
    frames = [frame(spark, "v", [(1, "first"), (2, "left")]), frame(spark, "v", [(1, "second")]), frame(spark, "v", [(1, "third")])]
    joined = join_sources(frames, "k")
    assert joined.columns == ["k", "v", "v_2", "v_3"]
    assert collected(joined) == [(1, "first", "second", "third"), (2, "left", None, None)]
    last = join_sources(frames, "k", prefer="right")
    assert last.columns == ["k", "v"]
    assert collected(last) == [(1, "third"), (2, None)]


def test_suffix_does_not_hit_an_existing_name(spark):
    left = spark.createDataFrame([(1, "a", "b")], "k long, v string, v_2 string")
    joined = join_sources([left, frame(spark, "v", [(1, "c")])], "k")
    assert joined.columns == ["k", "v", "v_2", "v_2_"]
    assert collected(joined) == [(1, "a", "b", "c")]


def test_cold_rows_are_shuffled_once(spark):
    """Three sources, one hot key: the steps for all other keys share one shuffle of each side."""
    left = spark.range(400).selectExpr("if(id < 200, 7, id) as k", "id as a")
    others = [spark.range(300).selectExpr("id as k", f"id as {name}") for name in ("b", "c")]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_sources([left, *others], "k", hot_rows=50, large=True)
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert joined.count() == 400
    cold = plan.split("Union")[1]
    assert len([l for l in cold.splitlines() if "Exchange hashpartitioning(" in l and "_piece" not in l]) == 3


def test_wide_rows_make_a_key_hot_sooner(spark, tmp_path):
    narrow = spark.range(20_000).selectExpr("id as k")
    narrow.write.parquet(str(tmp_path / "narrow"))
    spark.range(2_000).selectExpr("id as k", "sha2(cast(id as string), 512) as a").selectExpr("k", "repeat(a, 400) as text").write.option(
        "compression", "none"
    ).parquet(str(tmp_path / "wide"))
    sizes = [skew.default_hot_rows([spark.read.parquet(str(tmp_path / n))]) for n in ("narrow", "wide")]
    assert sizes[0] == skew.HOT_ROWS and skew.FEWEST_HOT_ROWS <= sizes[1] < 50_000
    assert skew.default_hot_rows([narrow.limit(0)]) >= skew.FEWEST_HOT_ROWS


def test_sketches_find_what_is_spread_thin(spark, tmp_path):
    """A key with a few rows in each of many files, among far more keys than a sketch follows."""
    rows = spark.range(0, 60_000, 1, 24).selectExpr("if(id % 10 = 0, -7, id) as k", "id as v")
    rows.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    found = skew.frequent_keys(stored, "k", tracked=256)
    hot_hash = spark.range(1).select(F.xxhash64(F.lit(-7).cast("long")).alias("h")).first()["h"]
    assert found.rows == 60_000 and max(found.counts, key=found.counts.get) == hot_hash
    assert found.counts[hot_hash] >= 6_000 and len(found.counts) <= 256
    hot, hot_rows = skew.find_hot_keys([stored], "k", 3_000, tracked=256)
    assert hot_rows == 3_000 and collected(hot) == [(-7, 6_000, 6_000.0)]
    other = spark.createDataFrame([(-7, "hot"), (11, "cold"), (None, "n")], "k long, w string")
    joined = join_sources([stored, other], "k", hot_rows=3_000, large=True)
    assert joined.count() == 60_000 and joined.filter("w = 'hot'").count() == 6_000
    assert [r["w"] for r in joined.filter("k = 11").collect()] == ["cold"]


def test_no_key_is_shuffled_to_find_hot_ones(spark):
    """One pass of sketches; without a candidate nothing else runs, and no exchange goes by key."""
    frames = [spark.range(500).selectExpr("id % 100 as k", "id as a"), spark.range(100).selectExpr("id as k", "id as b")]
    tracker, group = spark.sparkContext.statusTracker(), "hot-keys"
    spark.sparkContext.setJobGroup(group, group)
    try:
        assert skew.find_hot_keys(frames, "k", 50)[0] is None
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    assert 0 < len(stages) <= 12
    found = [skew.frequent_keys(df, "k") for df in frames]
    assert [f.rows for f in found] == [500, 100] and {*found[0].counts.values()} == {5}
    # 5 rows by 1 is no more than 5; of three frames the join is what counts.
    assert skew.candidates(found, 5) == [] and len(skew.candidates(found, 4)) == 100
    assert skew.frequent_keys(frames[0].limit(0), "k") == skew.Frequent(0, {}, 0)


@pytest.mark.parametrize("kind", ["binary", "string", "decimal(20,3)", "date"])
def test_keys_of_any_type(spark, kind):
    df = spark.range(300).select((F.when(F.col("id") < 200, 3).otherwise(F.col("id"))).alias("n"))
    value = F.date_add(F.lit("2024-01-01").cast("date"), F.col("n").cast("int")) if kind == "date" else F.col("n").cast("string").cast(kind)
    hot = skew.hot_keys([df.select(value.alias("k"))], "k", 100)
    assert [(r["_rows_0"], r["_joined_0"]) for r in hot.collect()] == [(200, 200.0)]
