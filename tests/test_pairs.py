import pytest
from pyspark.sql import functions as F

from quarry.operators.factors import neighbours
from quarry.operators.pairs import group_pairs, partner_rows
from quarry.operators.recsys import cosine_similarity


def test_group_pairs_equals_naive_self_join_with_hot_group(spark):
    # one hot group holding most rows, split into many blocks by a tiny block size
    rows = [(0, i, float(i)) for i in range(60)] + [(g, 100 + g * 10 + i, 1.0) for g in range(1, 6) for i in range(3)]
    df = spark.createDataFrame(rows, "g int, id long, s double")
    got = group_pairs(df, ["g"], "id", ["s"], block_rows=7)
    naive = (df.alias("a").join(df.alias("b"), "g").where(F.col("a.id") < F.col("b.id"))
             .select("g", F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b"),
                     F.col("a.s").alias("s_a"), F.col("b.s").alias("s_b")))
    assert sorted(got.collect()) == sorted(naive.collect())
    assert got.count() == 60 * 59 // 2 + 5 * 3


@pytest.mark.parametrize("both", [False, True])
def test_partner_rows_equal_naive_self_join_with_hot_group(spark, both):
    rows = [(0, i, float(i)) for i in range(60)] + [(g, 100 + g * 10 + i, 1.0) for g in range(1, 6) for i in range(3)]
    rows += [(9, 10 + i, None) for i in range(5)] + [(None, 1, 1.0), (9, None, 1.0)]
    df = spark.createDataFrame(rows, "g int, id long, s double")
    got = partner_rows(df, "g", "id", ["s"], both, block_rows=7)
    one = F.col("a.id") != F.col("b.id") if both else F.col("a.id") < F.col("b.id")
    naive = (df.alias("a").join(df.alias("b"), "g").where(one)
             .select(F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b"),
                     F.col("a.s").alias("s_a"), F.col("b.s").alias("s_b")))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got.collect(), key=key) == sorted(naive.collect(), key=key)
    assert got.count() == (2 if both else 1) * (60 * 59 // 2 + 5 * 3 + 5 * 4 // 2)


def test_similarities_shuffle_no_row_per_pair(spark):
    r = spark.createDataFrame([(u, i, float(u % 5 + i % 3 + 1)) for u in range(30) for i in range(u % 7)], "user_id long, item_id long, score double")
    for df in (cosine_similarity(r, "user_id", "item_id"), neighbours(r, 5)):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "user_id_a" not in "".join(line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
        assert "hashpartitioning(x" not in plan
