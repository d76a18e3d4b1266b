from pyspark.sql import functions as F

from quarry.operators import patterns as P

BASKETS = [(0, "milk"), (0, "beer"), (0, "diaper"), (1, "milk"), (1, "diaper"), (1, "coke"),
           (2, "beer"), (2, "diaper"), (2, "coke")]


def test_apriori_levels(spark):
    bi = spark.createDataFrame(BASKETS, "tid long, item string")
    got = {(",".join(r["items"]), r["freq"]) for r in P.apriori(bi, 0.5).collect()}
    assert got == {("diaper", 3), ("beer", 2), ("coke", 2), ("milk", 2),
                   ("beer,diaper", 2), ("coke,diaper", 2), ("diaper,milk", 2)}


def test_support_is_anti_monotone(spark):
    bi = spark.createDataFrame(BASKETS, "tid long, item string")
    rows = P.apriori(bi, 0.3).collect()
    sup = {tuple(r["items"]): r["support"] for r in rows}
    for items, s in sup.items():
        for i in range(len(items)):
            sub = items[:i] + items[i + 1:]
            if sub:
                assert sup[sub] >= s


def test_fp_tree(spark):
    bi = spark.createDataFrame(BASKETS, "tid long, item string")
    got = {(r.path, r["count"]) for r in P.fp_tree(bi, 0.5).collect()}
    assert got == {("diaper", 3), ("diaper/beer", 2), ("diaper/beer/milk", 1), ("diaper/beer/coke", 1),
                   ("diaper/coke", 1), ("diaper/coke/milk", 1)}


def test_duplicate_counting_quirk(spark):
    raw = spark.createDataFrame([(0, "a"), (0, "a"), (1, "b")], "tid long, item string")
    bi = P.baskets_from_rows(raw, "tid", "item")
    f = {r["items"][0]: r["freq"] for r in P.frequent_items(bi, 0.0, count_duplicates=True, raw_rows=raw).collect()}
    assert f == {"a": 2, "b": 1}
    assert F is not None
