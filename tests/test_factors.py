import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions.scalar import softmax
from quarry.operators import factors as FA
from quarry.operators import recsys as RS

SCHEMA = "user_id long, item_id long, score double"


def _dense_knn(train, pairs, k):
    """The same by dense matrices: all users ranked by cosine of the scores less the user's mean."""
    users, items = sorted({u for u, _, _ in train}), sorted({i for _, i, _ in train})
    at = np.full((len(users), len(items)), np.nan)
    for u, i, s in train:
        at[users.index(u), items.index(i)] = s
    mean = np.nanmean(at, axis=1)
    dev = np.nan_to_num(at - mean[:, None])
    norm = np.linalg.norm(dev, axis=1)
    scale = np.outer(norm, norm)
    sim = np.round(np.divide(dev @ dev.T, scale, out=np.zeros_like(scale), where=scale > 0), 9) + 0.0
    out = {}
    for u, i in pairs:
        if u not in users:
            out[u, i] = mean.mean()
            continue
        x = users.index(u)
        out[u, i] = mean[x]
        if i in items:
            near = sorted((v for v in range(len(users)) if v != x), key=lambda v: (-sim[x, v], users[v]))[:k]
            near = [v for v in near if not np.isnan(at[v, items.index(i)])]
            weight = sum(abs(sim[x, v]) for v in near)
            if weight > 0:
                out[u, i] += sum(sim[x, v] * dev[v, items.index(i)] for v in near) / weight
    return out


@pytest.mark.parametrize("k", [1, 4, 9, 30])
def test_knn_matches_dense(spark, k):
    rng = np.random.default_rng(5)
    train = [(u, i, float(rng.integers(1, 6))) for u in range(12) for i in range(10) if rng.random() < 0.4]
    train += [(20, 3, 4.0)]                                # one rating: no direction, so no neighbours
    pairs = [(u, i) for u in range(12) for i in range(10)] + [(20, 1), (99, 1), (3, 99), (99, 99)]
    got = FA.knn_scores(spark.createDataFrame(train, SCHEMA), spark.createDataFrame(pairs, "user_id long, item_id long"), (2, k))
    got = {(r.user_id, r.item_id): r[f"pred_{k}"] for r in got.collect()}
    want = _dense_knn(train, pairs, k)
    assert got.keys() == want.keys()
    assert all(got[p] == pytest.approx(want[p], abs=1e-8) for p in want)


@pytest.fixture(scope="module")
def low_rank(spark):
    rng = np.random.default_rng(2)
    p, q = rng.normal(size=(60, 2)), rng.normal(size=(40, 2))
    rows = [(u, i, float(3 + p[u] @ q[i] + rng.normal() * 0.05)) for u in range(60) for i in range(40)]
    keep = rng.random(len(rows)) < 0.6
    train = spark.createDataFrame([r for r, k in zip(rows, keep) if k], SCHEMA).cache()
    test = spark.createDataFrame([r for r, k in zip(rows, keep) if not k], SCHEMA).cache()
    return train, test


def test_trained_factors_beat_biases(low_rank):
    train, test = low_rank
    error = lambda pred: RS.rmse(pred, test).first()["rmse"]
    base = error(RS.fallback_scores(test, *RS.bias_model(train, 5.0, 5.0)))
    assert error(FA.mf_scores(train, test, rank=4)) < 0.5 * base
    assert error(FA.zscore_mf_scores(train, test, rank=4)) < 0.5 * base
    assert error(FA.pmf_scores(train, test, rank=4)) < 0.7 * base


def test_unknown_keys(spark, low_rank):
    train, _ = low_rank
    pairs = spark.createDataFrame([(1, 1), (1, 999), (999, 1), (999, 999)], "user_id long, item_id long")
    tiers = {(r.user_id, r.item_id): r.tier for r in FA.mf_scores(train, pairs, rank=2).collect()}
    assert tiers == {(1, 1): "both", (1, 999): "user", (999, 1): "item", (999, 999): "none"}
    mu = train.agg(F.avg("score")).first()[0]
    for scored in (FA.zscore_mf_scores(train, pairs, rank=2), FA.pmf_scores(train, pairs, rank=2)):
        got = {(r.user_id, r.item_id): r.pred for r in scored.collect()}
        assert len(got) == 4 and all(got[p] == pytest.approx(mu) for p in got if 999 in p)


def test_implicit_sums(spark):
    rows = spark.createDataFrame([(1, 10, 1.0), (1, 11, 2.0), (2, 10, 3.0)], SCHEMA)
    y = spark.createDataFrame([(10, [1.0, 2.0]), (11, [3.0, -2.0])], "item_id long, val array<double>")
    got = {r.user_id: r.implicit for r in FA.implicit_sums(rows, y, 2).collect()}
    assert got[1] == pytest.approx([4 / 2 ** 0.5, 0.0]) and got[2] == pytest.approx([1.0, 2.0])


def test_softmax_and_attention(spark):
    a = spark.range(1).select(softmax(F.array(F.lit(1000.0), F.lit(1000.0), F.lit(-1000.0))).alias("a")).first().a
    assert a == pytest.approx([0.5, 0.5, 0.0])
    rows = spark.createDataFrame([("x", [1.0, 3.0], [5.0, 2.0])], "node string, l0 array<double>, l1 array<double>")
    w = [[1.0, 0.0, 0.0, 0.0], [0.0, 0.0, 0.0, 1.0]]
    a = np.exp([1.0, 2.0]) / np.exp([1.0, 2.0]).sum()
    assert FA.attention_merge(rows, w).first().val == pytest.approx([a[0] + 5 * a[1], 3 * a[0] + 2 * a[1]])


def _dense_filled(train, most):
    """Cosine of all users with unrated cells at 0 before the user's mean is taken off."""
    users, items = sorted({u for u, _, s in train if s > 0}), sorted({i for _, i, s in train if s > 0})
    at = np.zeros((len(users), len(items)))
    for u, i, s in train:
        if s > 0:
            at[users.index(u), items.index(i)] = s
    mean = at.sum(axis=1) / (at > 0).sum(axis=1)
    dev = at - mean[:, None]
    norm = np.linalg.norm(dev, axis=1)
    out = {}
    for x, u in enumerate(users):
        if norm[x] > 1e-12:
            sim = {v: round(float(dev[x] @ dev[y] / (norm[x] * norm[y])), 9) for y, v in enumerate(users) if y != x and norm[y] > 1e-12}
            out[u] = sorted(sim.items(), key=lambda e: (-e[1], e[0]))[:most]
    return out


@pytest.mark.parametrize("most", [1, 3, 50])
def test_filled_neighbours_match_dense(spark, most):
    rng = np.random.default_rng(9)
    train = [(u, i, float(rng.integers(1, 6))) for u in range(40) for i in range(30) if rng.random() < 0.15 + 0.01 * (u % 7)]
    train += [(50 + k, 3, 4.0) for k in range(4)] + [(60, 29, 0.0), (61, 2, 0.0), (61, 4, 3.0)]      # ties, and zeros: unrated
    got = {}
    for r in FA.neighbours_filled(spark.createDataFrame(train, SCHEMA), most).collect():
        got.setdefault(r.x, []).append((r["rank"], r.y, r.sim))
    want = _dense_filled(train, most)
    assert got.keys() == want.keys()
    for u in want:
        assert [(y, pytest.approx(s, abs=2e-9)) for y, s in want[u]] == [(y, s) for _, y, s in sorted(got[u])]
    assert FA.neighbours_filled(spark.createDataFrame([], SCHEMA), most).count() == 0
