import random

import pytest
from helpers import at, collected

from freshet.operators.state import all_pending, bloom_filter, cut_by_filter, incremental_filter, last_processed, pending_keys

ROWS = [(1, None), (3, None), (None, None), (1, at(10)), (1, at(12)), (2, at(10)), (3, at(10)), (None, at(10)), (None, at(13)), (4, at(10))]
STATE = [(1, at(10)), (1, at(11)), (2, at(10)), (4, at(9)), (4, at(11)), (9, at(20))]


def frames(spark, rows, state):
    return (
        spark.createDataFrame(rows, "k long, ts timestamp_ntz"),
        spark.createDataFrame(state, "k long, written timestamp_ntz"),
    )


def expected(rows, state, pick):
    times = {}
    for key, ts in state:
        times.setdefault(key, []).append(ts)
    return sorted([(k, ts) for k, ts in rows if k not in times or (ts is not None and ts > pick(times[k]))], key=repr)


WAYS = {
    "broadcast": {"large": False},
    "pending": {"large": True},
    "shuffled": {"large": True, "max_pending": 1, "max_filter": 0},
    "filtered": {"large": True, "max_pending": 1},
    "filtered and salted": {"large": True, "max_pending": 1, "hot_rows": 1},
    "salted": {"large": True, "max_pending": 0, "hot_rows": 1},
}


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("which, pick", [("latest", max), ("oldest", min)])
@pytest.mark.parametrize("null_in_state", [False, True])
def test_filter(spark, way, which, pick, null_in_state):
    state = STATE + [(None, at(12))] * null_in_state
    df, done = frames(spark, ROWS, state)
    kept = incremental_filter(df, last_processed(done, "k", "written", which), "k", "ts", **WAYS[way])
    assert collected(kept) == expected(ROWS, state, pick)


def test_update_at_processing_time_is_done(spark):
    df, done = frames(spark, [(1, at(10))], [(1, at(10))])
    assert incremental_filter(df, last_processed(done, "k", "written"), "k", "ts").isEmpty()


def test_null_key_in_state_only(spark):
    df, done = frames(spark, [(1, at(10))], [(None, at(12))])
    assert incremental_filter(df, last_processed(done, "k", "written"), "k", "ts").count() == 1


def test_unknown_pick(spark):
    with pytest.raises(ValueError):
        last_processed(frames(spark, [], [])[1], "k", "written", "newest")


@pytest.mark.parametrize("hot_rows", [1, 7, 10_000])
def test_salted_filter_with_a_hot_key(spark, hot_rows):
    rng = random.Random(hot_rows)
    rows = [(rng.choice([1, 1, 1, None, rng.randrange(50)]), rng.choice([None, at(rng.randrange(24)), at(rng.randrange(24))])) for _ in range(400)]
    state = [(rng.choice([1, None, rng.randrange(50)]), at(rng.randrange(24))) for _ in range(60)]
    df, done = frames(spark, rows, state)
    kept = incremental_filter(df, last_processed(done, "k", "written"), "k", "ts", hot_rows, True, max_pending=0)
    assert collected(kept) == expected(rows, state, max)


def test_pending_keys(spark):
    df, done = frames(spark, ROWS, STATE)
    state = last_processed(done, "k", "written").toDF("_freshet_state_key", "_freshet_state_ts")
    assert collected(pending_keys(df, state, "k", "ts", 3)) == [(1, at(11)), (3, None), (None, None)]
    assert pending_keys(df, state, "k", "ts", 2) is None
    assert pending_keys(df, state, "k", "ts", 0) is None


@pytest.mark.parametrize("way", WAYS)
def test_names_that_need_care(spark, way):
    """Dotted names, and columns called like the state's."""
    rows = [(1, at(10), "x"), (2, at(12), "y"), (None, None, "z")]
    df = spark.createDataFrame(rows, "`a.k` long, `state.ts` timestamp_ntz, state_key string")
    done = spark.createDataFrame([(2, at(13))], "`a.k` long, `w.t` timestamp_ntz")
    kept = incremental_filter(df, last_processed(done, "a.k", "w.t"), "a.k", "state.ts", **WAYS[way])
    assert collected(kept) == sorted([rows[0], rows[2]], key=repr)


def test_nested_maps_spread(spark):
    rows = [(1, at(h), ({"a": h},), [{"b": h}]) for h in range(20)]
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz, s struct<m: map<string, int>>, l array<map<string, int>>")
    done = spark.createDataFrame([(1, at(9))], "k long, written timestamp_ntz")
    kept = incremental_filter(df, last_processed(done, "k", "written"), "k", "ts", **WAYS["salted"])
    assert kept.count() == 10


@pytest.mark.parametrize("way", WAYS)
def test_only_what_is_needed_is_read(spark, tmp_path, way):
    spark.range(50).selectExpr("id % 3 as k", "timestamp_ntz '2024-01-10 12:00:00' as ts", "repeat('x', 100) as text").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    done = spark.createDataFrame([(1, at(9))], "k long, written timestamp_ntz")
    kept = incremental_filter(df, last_processed(done, "k", "written"), "k", "ts", ids=(), **WAYS[way])
    plan = kept.select("k")._jdf.queryExecution().executedPlan().toString()
    assert "text:string" not in plan and "k:bigint" in plan


def test_the_filter_lets_few_others_pass(spark, tmp_path):
    """All rows of pending keys, null among them, and some two in a hundred of the others."""
    df = spark.range(40_000).selectExpr("if(id % 1000 = 0, null, id % 20000) as k", "timestamp_ntz '2024-01-10 12:00:00' as ts")
    done = spark.range(20_000).filter("id % 10 > 0").selectExpr("id as k", "timestamp_ntz '2024-01-10 13:00:00' as written")
    state = last_processed(done, "k", "written").toDF("_freshet_state_key", "_freshet_state_ts")
    pending, n, _ = all_pending(df, state, "k", "ts")
    assert n == 1_981  # tens but for the thousands, and null
    cut = cut_by_filter(df, "k", pending, n)
    kept = {r["k"]: r["count"] for r in cut.groupBy("k").count().collect()}
    wanted = [r["_pending_key"] for r in pending.collect()]
    rows = sum(kept[k] for k in wanted)
    assert all(k in kept for k in wanted) and rows == 4_000
    assert cut.count() - rows < 0.05 * (40_000 - rows)
    table, words = bloom_filter(pending, n)
    assert table.count() <= words <= n // 4 + 1


def test_the_filter_comes_before_the_shuffle(spark, tmp_path):
    spark.range(3000).selectExpr("id as k", "timestamp_ntz '2024-01-10 12:00:00' as ts", "repeat('x', 50) as text").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    done = spark.range(3000).filter("id % 30 > 0").selectExpr("id as k", "timestamp_ntz '2024-01-10 13:00:00' as written")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = incremental_filter(df, last_processed(done, "k", "written"), "k", "ts", large=True, max_pending=1)
        assert kept.count() == 100
        plan = kept._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Of the two joins, the one by word is the lower one.
    assert plan.index("SortMergeJoin") < plan.index("BroadcastHashJoin") < plan.index("text#")


def test_random_filters(spark):
    rng = random.Random(9)
    keys = [None, *range(300)]
    rows = [(rng.choice(keys), rng.choice([None, at(rng.randrange(24))])) for _ in range(900)]
    state = [(rng.choice(keys), at(rng.randrange(24))) for _ in range(500)]
    df, done = frames(spark, rows, state)
    kept = incremental_filter(df, last_processed(done, "k", "written"), "k", "ts", large=True, max_pending=1)
    assert collected(kept) == expected(rows, state, max)
