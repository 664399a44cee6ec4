import pytest

from featurewright.streaming.features import upsert_into_path


def test_upsert_moves_keys_replays_and_rejects_duplicates(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert = upsert_into_path(path, ["k"], "p")

    def rows(r):
        return spark.createDataFrame(r, "k int, v string, p string")

    upsert(rows([(1, "a", "x"), (2, "b", "y")]), 0)
    upsert(rows([(2, "c", "y"), (3, "d", "y")]), 1)
    for _ in range(2):  # a replayed batch changes nothing
        upsert(rows([(1, "m", "y")]), 2)  # key 1 leaves its partition, which is empty then
    got = sorted(map(tuple, spark.read.parquet(path).select("k", "v", "p").collect()))
    assert got == [(1, "m", "y"), (2, "c", "y"), (3, "d", "y")]
    with pytest.raises(ValueError):
        upsert(rows([(5, "a", "x"), (5, "b", "x")]), 3)
