"""LightGCN on a grid of cells against the same steps in dense numpy, whatever the number of blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import implicit as M

SCHEMA = "user_id long, item_id long, score double"


def plain_training(rows, held, start, layers, weighted, rounds, lr, decay):
    """Validation errors by round, and the embeddings of the last."""
    nodes, n = sorted(start), len(rows)
    at = {k: x for x, k in enumerate(nodes)}
    a = np.zeros((len(nodes),) * 2)
    for u, i, r in rows:
        x, y = at[f"u:{u}"], at[f"i:{i}"]
        a[x, y] += r if weighted else 1
        a[y, x] += r if weighted else 1
    d = a.sum(axis=1)
    a = a / np.sqrt(np.outer(d, d))
    mix = sum(np.linalg.matrix_power(a, k) for k in range(layers + 1)) / (layers + 1)
    e, mean = np.array([start[k] for k in nodes]), np.mean([r for _, _, r in rows])
    m, v, out = np.zeros_like(e), np.zeros_like(e), []
    for t in range(1, rounds + 1):
        final, g = mix @ e, np.zeros_like(e)
        for u, i, r in rows:
            x, y = at[f"u:{u}"], at[f"i:{i}"]
            off = 2 * (final[x] @ final[y] - r)
            g[x] += off * final[y]
            g[y] += off * final[x]
        g = mix @ g / n + decay * e
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        e = e - lr * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        final = mix @ e
        pred = [final[at[f"u:{u}"]] @ final[at[f"i:{i}"]] if f"u:{u}" in at and f"i:{i}" in at else mean for u, i, _ in held]
        out.append(np.sqrt(np.mean((np.array(pred) - [r for _, _, r in held]) ** 2)))
    return out, dict(zip(nodes, e))


@pytest.mark.parametrize("weighted, sides", [(False, 1), (True, 3)])
def test_training_on_a_grid(spark, weighted, sides):
    rng = np.random.default_rng(6)
    rows = [(u, i, float(rng.integers(1, 6))) for u in range(9) for i in range(8) if rng.random() < 0.5 or i == u]
    rows.append(rows[0])
    held = [(0, 1, 3.0), (4, 5, 2.0), (99, 1, 4.0), (2, 99, 1.0)]
    train, valid = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(held, SCHEMA)
    kw = {"dim": 3, "layers": 2, "weighted": weighted, "seed": 1}
    start = {r.key: np.array(r.val) for r in M.lightgcn_fit(train, rounds=0, **kw).first.collect()}
    model = M.lightgcn_fit(train, rounds=3, lr=0.1, valid=valid, patience=3, sides=sides, **kw)
    history, _ = plain_training(rows, held, start, 2, weighted, 3, 0.1, 1e-5)
    assert model.history == pytest.approx(history, rel=1e-8) and model.rounds == int(np.argmin(history)) + 1
    _, want = plain_training(rows, held, start, 2, weighted, model.rounds, 0.1, 1e-5)
    assert {r.key: list(r.val) for r in model.first.collect()} == {k: pytest.approx(v, rel=1e-7) for k, v in want.items()}
    error = F.sqrt(F.avg(F.pow(F.col("pred") - F.col("score"), 2)))
    scored = M.lightgcn_scores(valid, model).join(valid, ["user_id", "item_id"]).agg(error).first()[0]
    assert scored == pytest.approx(min(history), rel=1e-8)


@pytest.mark.parametrize("weighted, layers", [(False, 3), (True, 2)])
def test_propagation_in_cells_is_that_of_the_edges(spark, monkeypatch, weighted, layers):
    """The same embeddings and scores as by joins of edges, and the ratings meet no vectors in a shuffle."""
    from quarry.operators import bipartite as B
    from quarry.operators import gcn
    monkeypatch.setattr(B, "FEW", 8)
    rng = np.random.default_rng(8)
    rows = [(u, i, float(rng.integers(1, 6))) for u in range(12) for i in range(9) if rng.random() < 0.4 or i == u] + [(None, 1, 2.0), (3, None, 1.0)]
    train, plans, write = spark.createDataFrame(rows, SCHEMA), [], B.write_table
    monkeypatch.setattr(B, "write_table", lambda df, name: plans.append((name, df._jdf.queryExecution().executedPlan().toString())) or write(df, name))
    users, items = B.propagated(train, 3, layers, weighted)
    assert "Bucketed: true" in dict(plans[:-2])["gcn-final"]
    edges = gcn.normalized_edges(gcn.bipartite_edges(train.dropna(), "score" if weighted else None))
    emb = gcn.propagate(edges, gcn.seeded_embeddings(edges.select(F.col("src").alias("node")).distinct(), 3), layers)
    want = {(r.node, r.f): r.val for r in emb.collect()}
    assert {(r.node, r.f): r.val for r in B.tagged(users, items).collect()} == pytest.approx(want, abs=1e-12)
    pairs = spark.createDataFrame([(0, 0), (1, 5), (99, 1), (2, 99)], "user_id long, item_id long")
    scores = {(r.user_id, r.item_id): r.score for r in gcn.score_pairs(emb, pairs).collect()}
    assert {(r.user_id, r.item_id): r.score for r in B.products(pairs, users, items).collect()} == pytest.approx(scores, abs=1e-12)
