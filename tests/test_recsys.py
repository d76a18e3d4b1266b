import pytest
from pyspark.sql import functions as F

from quarry.operators import recsys as RS

SMALL = [("User1", "ItemA", 5.0), ("User1", "ItemB", 3.0), ("User1", "ItemC", 4.0),
         ("User2", "ItemA", 3.0), ("User2", "ItemB", 4.0), ("User2", "ItemD", 5.0),
         ("User3", "ItemA", 4.0), ("User3", "ItemC", 5.0), ("User3", "ItemD", 2.0)]


@pytest.fixture()
def small(spark):
    return spark.createDataFrame(SMALL, "user_id string, item_id string, score double")


def test_cosines(small):
    us = {(r.user_id_a, r.user_id_b): r.sim for r in RS.cosine_similarity(small, "user_id", "item_id").collect()}
    assert us[("User1", "User2")] == pytest.approx(.926092, abs=1e-6)
    assert us[("User1", "User3")] == pytest.approx(.975610, abs=1e-6)
    it = {(r.item_id_a, r.item_id_b): r.sim for r in RS.cosine_similarity(small, "item_id", "user_id").collect()}
    assert it[("ItemA", "ItemD")] == pytest.approx(.854199, abs=1e-6)
    assert it[("ItemB", "ItemD")] == pytest.approx(1.0) and it[("ItemC", "ItemD")] == pytest.approx(1.0)


def test_user_item_hybrid(small):
    ub = {(r.user_id, r.item_id): r.pred for r in RS.user_based(small).collect()}
    ib = {(r.user_id, r.item_id): r.pred for r in RS.item_based(small).collect()}
    assert ub[("User1", "ItemD")] == pytest.approx(3.460942, abs=1e-6)
    assert ib[("User1", "ItemD")] == pytest.approx(3.948917, abs=1e-6)
    hy = RS.hybrid(RS.user_based(small), RS.item_based(small), alpha=0.3).where(F.col("user_id") == "User1").collect()
    assert [(r.item_id, round(r.pred, 6)) for r in hy] == [("ItemD", 3.802524)]


def test_splits_are_partitions(spark):
    rows = [(u, i, float((u * 7 + i) % 5 + 1)) for u in range(20) for i in range(u % 7 + 1)]
    r = spark.createDataFrame(rows, "user_id long, item_id long, score double")
    for f in (RS.split_random, RS.split_stratified, RS.split_by_user):
        s = f(r)
        assert s.count() == r.count()
    st = RS.split_stratified(r).groupBy("user_id").agg(F.sum(F.col("is_train").cast("int")).alias("t"))
    assert st.where("t < 1").count() == 0


def test_fallback_tiers(spark):
    train = spark.createDataFrame([(1, 10, 4.0), (1, 11, 2.0), (2, 10, 5.0)], "user_id long, item_id long, score double")
    pairs = spark.createDataFrame([(1, 10), (1, 99), (9, 11), (9, 99)], "user_id long, item_id long")
    mu, bi, bu = RS.bias_model(train)
    tiers = {(r.user_id, r.item_id): r.tier for r in RS.fallback_scores(pairs, mu, bi, bu).collect()}
    assert tiers == {(1, 10): "both", (1, 99): "user", (9, 11): "item", (9, 99): "none"}


def test_dense_ids(spark):
    ids = spark.createDataFrame([(i * 3,) for i in range(50)], "u long").repartition(5)
    got = sorted((r.u, r.idx) for r in RS.dense_ids(ids, "u").collect())
    assert got == [(i * 3, i) for i in range(50)]


def test_quantiles_by_position(spark):
    import numpy as np
    values = [float(v) for v in np.random.default_rng(4).integers(0, 30, 400)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "score double").repartition(5)
    got = RS.quantiles(df, "score", {"a": 0.0, "b": 0.1, "c": 0.333, "d": 0.5, "e": 1.0}).first()
    assert list(got) == pytest.approx(list(np.quantile(values, [0.0, 0.1, 0.333, 0.5, 1.0])))
    assert list(RS.quantiles(df.where("score < 0"), "score", {"a": 0.5}).first()) == [None]


def test_indices_map_back_to_their_ids(spark):
    names = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "name string")
    ids = RS.dense_ids(names, "name")
    rows = spark.createDataFrame([(0, 1.0), (2, 2.0), (2, 2.0), (7, 3.0), (None, 4.0)], "i int, score double")
    got = RS.raw_ids(rows, ids, "name", "i")
    assert got.columns == ["score", "name"]
    assert sorted((r.score, r.name) for r in got.select("score", F.col("name")).toPandas().itertuples(index=False)) == [
        (1.0, "a"), (2.0, "c"), (2.0, "c"), (3.0, None), (4.0, None)]
    assert RS.raw_ids(rows.limit(0), ids, "name", "i").count() == 0
