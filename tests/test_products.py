import random

import pytest
from pyspark.sql import functions as F

from quarry.operators.products import grid, weighted_means
from quarry.operators.recsys import user_based


def test_grid_sends_the_smaller_side_more_often():
    assert grid(1e9, 1e6, 16) == (16, 1)
    assert grid(1e6, 1e9, 16, most=10**8) == (1, 16)
    down, across = grid(1e6, 1e9, 16, most=10**7)
    assert across >= 100 and down == 1


@pytest.mark.parametrize("by_row", [True, False])
def test_weighted_means_over_many_cells_equal_all_products(spark, by_row):
    rng = random.Random(4)
    rows = [(f"u{u}", k, rng.choice([1.0, 0.5, 0.25])) for u in range(20) for k in rng.sample(range(15), 6)]
    table = [(k, i, rng.choice([1.0, 3.0, 5.0])) for k in range(12) for i in rng.sample(range(40), 9)]
    own = [(f"u{u}", i) for u in range(0, 20, 2) for i in range(5)]
    sums = {}
    for u, k, w in rows:
        for kk, i, t in table:
            if k == kk and (u, i) not in own:
                a, b = sums.get((u, i), (0.0, 0.0))
                sums[u, i] = (a + w * t, b + (w if by_row else t))
    want = {}
    for u in {u for u, _, _ in rows}:
        mine = sorted((-round(a / b, 6), i) for (v, i), (a, b) in sums.items() if v == u)
        want[u] = [i for _, i in mine[:3]]
    got = weighted_means(spark.createDataFrame(rows, "u string, k long, w double"), spark.createDataFrame(table, "k long, i long, t double"),
                         spark.createDataFrame(own, "u string, i long"), 3, by_row, (120, 108), 6, tasks=6, most=40)
    found = {}
    for r in got.withColumn("mean", F.round("mean", 6)).collect():
        found.setdefault(r.u, []).append((-r.mean, r.i))
    assert {u: [i for _, i in sorted(v)[:3]] for u, v in found.items()} == want


def test_recommendations_shuffle_no_row_per_user_and_item(spark):
    r = spark.createDataFrame([(u, i, float(u % 5 + i % 3 + 1)) for u in range(30) for i in range(u % 7)], "user_id long, item_id long, score double")
    plan = user_based(r, 2)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning(user_id" in line and "item_id" in line.split(",")[1]]
