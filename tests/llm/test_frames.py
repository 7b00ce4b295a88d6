from freshet.llm import frames
from freshet.sources.scan import load_table


def test_scratch_tables_are_emptied(spark, monkeypatch):
    monkeypatch.setattr(frames, "_WRITTEN", [])
    made = [frames.materialise(spark.range(n), "clean") for n in (3, 0)]
    assert [df.count() for df in made] == [3, 0]
    paths = list(frames._WRITTEN)
    assert frames.clean(spark) == 2 and frames.clean(spark) == 0
    assert all(load_table(spark, path=path) is None for path in paths)
