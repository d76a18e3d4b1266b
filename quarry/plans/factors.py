"""Registered neighbour and factor model queries (H4-H7, H9-H11, H13 scoring, H18).

Models are fitted on the train split and scored on the test split.  Queries on
given factors and neighbour predictions have SQL twins; those fitted by ALS
have none, but for their keys and tiers.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.scalar import scale_score
from quarry.functions.text import md5_bucket
from quarry.operators import factors as FA
from quarry.operators import gcn
from quarry.operators import grid
from quarry.operators import implicit
from quarry.operators import neural
from quarry.operators import recsys as RS
from quarry.plans.derived import ratings, test_ratings, train_ratings, with_ctes
from quarry.plans.recs import BIAS_SQL, GCN_DIM, REG, _bias, _gcn_sql
from quarry.plans.registry import register
from quarry.plans.unroll import dbl
from quarry.session import write_table

DIG = 9
KS = (5, 10, 20, 40, 80)
K = 20
ATTENTION = [[10.0 * (-1.0) ** (k + j) / (k + j + 1) for j in range(3 * GCN_DIM)] for k in range(3)]  # given weights


def _knn_sql(ks: tuple[int, ...]) -> dict[str, str]:
    """All pairs of users here, unlike the operator."""
    sums = ", ".join(f"sum(sim * d) FILTER (WHERE rank <= {k}) AS num{k}, sum(abs(sim)) FILTER (WHERE rank <= {k}) AS den{k}"
                     for k in ks)
    preds = ", ".join(f"coalesce(cm.m + CASE WHEN den{k} > 0 THEN num{k} / den{k} ELSE {dbl(0.0)} END, mm) AS pred_{k}"
                      for k in ks)
    return {
        "cm": "SELECT user_id, avg(score) AS m FROM train GROUP BY user_id",
        "c": "SELECT user_id, item_id, score - m AS d FROM train JOIN cm USING (user_id)",
        "cn": "SELECT user_id, sqrt(sum(d * d)) AS n FROM c GROUP BY user_id",
        "cd": """SELECT a.user_id AS x, b.user_id AS y, round(sum(a.d * b.d) / any_value(na.n * nb.n), 9) AS sim
                 FROM c a JOIN c b ON a.item_id = b.item_id AND a.user_id <> b.user_id
                 JOIN cn na ON na.user_id = a.user_id JOIN cn nb ON nb.user_id = b.user_id
                 WHERE na.n > 0 AND nb.n > 0 GROUP BY 1, 2""",
        "cr": """SELECT u.user_id AS x, v.user_id AS y, coalesce(sim, 0) AS sim,
                        row_number() OVER (PARTITION BY u.user_id ORDER BY coalesce(sim, 0) DESC, v.user_id) AS rank
                 FROM cm u JOIN cm v ON u.user_id <> v.user_id LEFT JOIN cd ON cd.x = u.user_id AND cd.y = v.user_id""",
        "ch": f"""SELECT t.user_id, t.item_id, {sums} FROM test t JOIN cr ON cr.x = t.user_id AND rank <= {max(ks)}
                  JOIN c ON c.user_id = cr.y AND c.item_id = t.item_id GROUP BY t.user_id, t.item_id""",
        "knn": f"""SELECT t.user_id, t.item_id, t.score, {preds} FROM test t LEFT JOIN cm USING (user_id)
                   LEFT JOIN ch ON ch.user_id = t.user_id AND ch.item_id = t.item_id
                   CROSS JOIN (SELECT avg(m) AS mm FROM cm)""",
    }


@register("knn_predict", sql=lambda: with_ctes(f"SELECT user_id, item_id, round(pred_{K}, {DIG}) AS pred FROM knn",
                                               "train", "test", extra=_knn_sql((K,))))
def q_knn_predict(spark, sf_dir):
    """H5: predictions from the 20 nearest users by centred cosine."""
    out = FA.knn_scores(_train(spark, sf_dir), test_ratings(spark, sf_dir), (K,))
    return out.select("user_id", "item_id", F.round(f"pred_{K}", DIG).alias("pred"))


def _train(spark, sf_dir):
    """The train split, written once: the models use it several times."""
    return write_table(train_ratings(spark, sf_dir), "train")


def _best_sql() -> str:
    rows = " UNION ALL ".join(f"SELECT {k} AS k, count(*) AS n, round(sqrt(avg(pow(score - pred_{k}, 2))), {DIG}) AS rmse FROM knn"
                              for k in KS)
    return with_ctes(f"SELECT k, n, rmse, rmse = min(rmse) OVER () AS best FROM ({rows})", "train", "test", extra=_knn_sql(KS))


@register("knn_best_k", sql=_best_sql)
def q_knn_best_k(spark, sf_dir):
    """H6: error of every k, and which is best."""
    from pyspark.sql import Window as W
    out = FA.knn_errors(_train(spark, sf_dir), test_ratings(spark, sf_dir), KS).withColumn("rmse", F.round("rmse", DIG))
    # a row per k: the global window is over the settings, not the data
    return out.withColumn("best", F.col("rmse") == F.min("rmse").over(W.partitionBy()))


@register("mf_als")
def q_mf_als(spark, sf_dir):
    """H7: biases and factors, trained."""
    return FA.mf_scores(_train(spark, sf_dir), test_ratings(spark, sf_dir), bias_reg=REG)


@register("mf_als_tiers", sql=with_ctes("SELECT tier, count(*) AS n FROM fb GROUP BY tier", "train", "test", extra=BIAS_SQL))
def q_mf_tiers(spark, sf_dir):
    """H7 over H8: how many predictions of the trained model fall into each tier."""
    return q_mf_als(spark, sf_dir).where("pred IS NOT NULL").groupBy("tier").agg(F.count(F.lit(1)).alias("n"))


@register("mf_zscore")
def q_mf_zscore(spark, sf_dir):
    """H9: factors on z-scores, trained."""
    return FA.zscore_mf_scores(_train(spark, sf_dir), test_ratings(spark, sf_dir))


@register("pmf_als")
def q_pmf_als(spark, sf_dir):
    """Factors alone, trained."""
    return FA.pmf_scores(_train(spark, sf_dir), test_ratings(spark, sf_dir))


# ---------------------------------------------------------------- given factors

def _given_sql(source: str, tag: str, key: str, seed: int) -> str:
    return f"""SELECT {key}, CAST(f AS INTEGER) AS f,
        ((('0x' || substr(md5('{seed}|{tag}:' || CAST({key} AS VARCHAR) || '|' || CAST(f AS VARCHAR)), 1, 8))::BIGINT
          / {dbl(4294967296.0)} - {dbl(0.5)}) * {dbl(0.2)}) AS val
        FROM (SELECT DISTINCT {key} FROM {source}) CROSS JOIN range(0, {GCN_DIM}) t(f)"""


def _given(df, tag: str, key: str, seed: int):
    nodes = df.select(key).distinct().withColumn("node", F.concat(F.lit(f"{tag}:"), F.col(key).cast("string")))
    arrays = FA.seeded_arrays(nodes, GCN_DIM, seed=seed)
    return arrays.select(F.substring("node", len(tag) + 2, 40).cast("long").alias(key), "val")


IMPLICIT_SQL = {
    "y": _given_sql("ratings", "i", "item_id", 43),
    "im": "SELECT r.user_id, y.f, sum(y.val) / sqrt(count(*)) AS val FROM ratings r JOIN y USING (item_id) GROUP BY 1, 2",
}


@register("svdpp_implicit_sum", sql=lambda: with_ctes(f"SELECT user_id, f, round(val, {DIG}) AS val FROM im", "ratings",
                                                      extra=IMPLICIT_SQL))
def q_implicit(spark, sf_dir):
    """Implicit part of every user on given item factors."""
    r = ratings(spark, sf_dir)
    out = FA.implicit_sums(r, _given(r, "i", "item_id", 43), GCN_DIM)
    return out.select("user_id", F.posexplode("implicit").alias("f", "val")).withColumn("val", F.round("val", DIG))


def _svdpp_sql() -> str:
    extra = {**IMPLICIT_SQL, "p": _given_sql("ratings", "u", "user_id", 42), "q": _given_sql("ratings", "i", "item_id", 42), **BIAS_SQL,
             "pq": """SELECT t.user_id, t.item_id, sum(q.val * (p.val + im.val)) AS dot FROM test t
                      JOIN p ON p.user_id = t.user_id JOIN q ON q.item_id = t.item_id AND q.f = p.f
                      JOIN im ON im.user_id = t.user_id AND im.f = p.f GROUP BY 1, 2"""}
    return with_ctes(f"""SELECT user_id, item_id, tier,
        round(pred + CASE WHEN tier = 'both' THEN dot ELSE {dbl(0.0)} END, {DIG}) AS pred FROM fb JOIN pq USING (user_id, item_id)""",
                     "train", "test", extra=extra)


@register("svdpp_scores", sql=_svdpp_sql)
def q_svdpp_scores(spark, sf_dir):
    """Biases and q (p + implicit) on given factors; unknown keys by the tiers of H8."""
    r, test = ratings(spark, sf_dir), test_ratings(spark, sf_dir)
    mu, bi, bu = _bias(spark, sf_dir)
    left = _given(r, "u", "user_id", 42).join(FA.implicit_sums(r, _given(r, "i", "item_id", 43), GCN_DIM), "user_id").select(
        "user_id", F.zip_with("val", "implicit", lambda a, b: a + b).alias("_p"))
    right = _given(r, "i", "item_id", 42).withColumnRenamed("val", "_q")
    dots = test.join(left, "user_id").join(right, "item_id").select(
        "user_id", "item_id", FA.dot(F.col("_p"), F.col("_q")).alias("dot"))
    return RS.fallback_scores(test, mu, bi, bu, dots).withColumn("pred", F.round("pred", DIG))


@register("gcn_scores_biased", sql=lambda: _gcn_sql(True, 0.0, 2, "," + ",\n".join(f"{n} AS ({q})" for n, q in BIAS_SQL.items()) + f""",
pq AS (SELECT t.user_id, t.item_id, sum(u.val * i.val) AS dot FROM test t
       JOIN fin u ON u.node = 'u:' || CAST(t.user_id AS VARCHAR)
       JOIN fin i ON i.node = 'i:' || CAST(t.item_id AS VARCHAR) AND i.f = u.f GROUP BY t.user_id, t.item_id)
SELECT user_id, item_id, tier, round(pred + coalesce(dot, {dbl(0.0)}), {DIG}) AS pred FROM fb LEFT JOIN pq USING (user_id, item_id)"""))
def q_gcn_biased(spark, sf_dir):
    """Products of propagated embeddings (rating weights, two layers) with mean and biases."""
    train, test = _train(spark, sf_dir), test_ratings(spark, sf_dir)
    edges = gcn.normalized_edges(gcn.bipartite_edges(train, "score"))
    emb = gcn.propagate(edges, gcn.seeded_embeddings(edges.select(F.col("src").alias("node")).distinct(), GCN_DIM), 2)
    dots = gcn.score_pairs(emb, test).withColumnRenamed("score", "dot")
    mu, bi, bu = RS.bias_model(train, REG, REG)
    return RS.fallback_scores(test, mu, bi, bu, dots).withColumn("pred", F.round("pred", DIG))


def _attention_sql() -> str:
    cells = ", ".join(f"({k}, {j}, {dbl(w)})" for k, row in enumerate(ATTENTION) for j, w in enumerate(row))
    flat = " UNION ALL ".join(f"SELECT node, {k} AS k, f, {k * GCN_DIM} + f AS j, val FROM l{k}" for k in range(3))
    return _gcn_sql(True, 1e-10, 2, f""",
wt AS (SELECT * FROM (VALUES {cells}) t(k, j, w)), la AS ({flat}),
lg AS (SELECT node, wt.k, sum(w * val) AS z FROM la JOIN wt ON wt.j = la.j GROUP BY node, wt.k),
ex AS (SELECT node, k, exp(z) / sum(exp(z)) OVER (PARTITION BY node) AS a FROM lg),
mg AS (SELECT node, f, sum(a * val) AS val FROM la JOIN ex USING (node, k) GROUP BY node, f)
SELECT user_id, item_id, round(s, {DIG}) AS score,
       round(least(greatest({dbl(40.0)} + {dbl(30.0)} * s, {dbl(20.0)}), {dbl(100.0)}), {DIG}) AS scaled
FROM (SELECT t.user_id, t.item_id, sum(u.val * i.val) AS s FROM test t
      JOIN mg u ON u.node = 'u:' || CAST(t.user_id AS VARCHAR)
      JOIN mg i ON i.node = 'i:' || CAST(t.item_id AS VARCHAR) AND i.f = u.f GROUP BY t.user_id, t.item_id)""")


@register("layer_attention_scores", sql=_attention_sql)
def q_attention(spark, sf_dir):
    """Layers merged by attention with given weights, products for the test pairs, scaled."""
    edges = gcn.normalized_edges(gcn.bipartite_edges(train_ratings(spark, sf_dir), "score"), 1e-10)
    edges = write_table(edges, "gcn-edges")
    first = FA.seeded_arrays(edges.select(F.col("src").alias("node")).distinct(), GCN_DIM)
    merged = write_table(FA.attention_merge(gcn.layers_of(edges, first, GCN_DIM, 2), ATTENTION), "gcn-merged")
    tag = lambda c, t: F.concat(F.lit(t), F.col(c).cast("string"))
    s = (test_ratings(spark, sf_dir).withColumns({"_u": tag("user_id", "u:"), "_i": tag("item_id", "i:")})
         .join(merged.select(F.col("node").alias("_u"), F.col("val").alias("_p")), "_u")
         .join(merged.select(F.col("node").alias("_i"), F.col("val").alias("_q")), "_i")
         .select("user_id", "item_id", FA.dot(F.col("_p"), F.col("_q")).alias("score")))
    return s.select("user_id", "item_id", F.round("score", DIG).alias("score"),
                    F.round(scale_score(F.col("score")), DIG).alias("scaled"))


NEURAL_ROUNDS = 15
PATIENCE = 3


def _valid(spark, sf_dir):
    """(train rows to learn from, rows held back to stop by): a tenth of the pairs by md5."""
    rows = write_table(train_ratings(spark, sf_dir).withColumn("_b", md5_bucket("item_id", "user_id", modulus=10)), "train-parts")
    return rows.where("_b <> 0").drop("_b"), rows.where("_b = 0").drop("_b")


def _reached(df, history):
    """``df`` with the rounds used and the validation error reached."""
    return df.withColumn("rounds", F.lit(len(history))).withColumn("valid_rmse", F.lit(float(min(history))))


@register("neural_cf")
def q_neural_cf(spark, sf_dir):
    """A three-layer network on trained embeddings, stopped by validation; test split."""
    learn, stop = _valid(spark, sf_dir)
    model = neural.fit(learn, rounds=NEURAL_ROUNDS, valid=stop, patience=PATIENCE)
    return _reached(neural.scores(test_ratings(spark, sf_dir), model), model.history)


@register("embedding_mlp")
def q_embedding_mlp(spark, sf_dir):
    """One hidden layer on trained embeddings, stopped by validation; test split."""
    learn, stop = _valid(spark, sf_dir)
    model = neural.fit(learn, dim=16, hidden=(128,), rounds=NEURAL_ROUNDS, valid=stop, patience=PATIENCE)
    return _reached(neural.scores(test_ratings(spark, sf_dir), model), model.history)


GRID = {"dims": (4, 8), "hidden": ((16,), (16, 8)), "dropouts": (0.1, 0.2), "rates": (0.05, 0.02)}


@register("grid_neural")
def q_grid_neural(spark, sf_dir):
    """Sixteen settings on four axes trained in one job a round, each stopped by its validation error."""
    learn, stop = _valid(spark, sf_dir)
    return grid.results(spark, grid.search(learn, stop, grid.settings(**GRID), rounds=10, patience=PATIENCE))


@register("svdpp_train")
def q_svdpp_train(spark, sf_dir):
    """SVD++ of 32 factors trained for up to 20 epochs of mini-batches with patience, test split; epochs used and validation error reached."""
    learn, stop = _valid(spark, sf_dir)
    model = implicit.svdpp_fit(learn, dim=32, rounds=20, lr=0.005, valid=stop, patience=PATIENCE, batch=1024)
    return _reached(implicit.svdpp_scores(test_ratings(spark, sf_dir), model), model.history)


@register("lightgcn_train")
def q_lightgcn_train(spark, sf_dir):
    """LightGCN trained with patience, edges of weight 1 and weighted by scores; test split."""
    learn, stop = _valid(spark, sf_dir)
    out = None
    for weighted, layers in ((False, 3), (True, 2)):
        model = implicit.lightgcn_fit(learn, dim=8, layers=layers, weighted=weighted, rounds=10, lr=0.3, valid=stop, patience=PATIENCE)
        rows = _reached(implicit.lightgcn_scores(test_ratings(spark, sf_dir), model), model.history).withColumn("weighted", F.lit(weighted))
        out = rows if out is None else out.unionByName(rows)
    return out


# ---------------------------------------------------------------- unrated cells at minus the mean (H4-H6)

def _filled_sql(ks: tuple[int, ...]) -> dict[str, str]:
    """As ``_knn_sql``, but for the similarity."""
    out = _knn_sql(ks)
    out["cn"] = """SELECT user_id, count(*) AS n, any_value(m) AS m, sum(score * score) AS q,
        sqrt(sum(score * score) + any_value(m) * any_value(m) * (any_value(k) - 2 * count(*))) AS norm
        FROM train JOIN cm USING (user_id) CROSS JOIN (SELECT count(DISTINCT item_id) AS k FROM train) GROUP BY user_id"""
    out["cd"] = """SELECT a.user_id AS x, b.user_id AS y, sum(a.score * b.score) AS dot
                   FROM train a JOIN train b ON a.item_id = b.item_id AND a.user_id <> b.user_id GROUP BY 1, 2"""
    out["cr"] = f"""SELECT x, y, sim, row_number() OVER (PARTITION BY x ORDER BY sim DESC, y) AS rank FROM (
        SELECT u.user_id AS x, v.user_id AS y,
               round((coalesce(dot, {dbl(0.0)}) + u.m * v.m * (k - u.n - v.n)) / (u.norm * v.norm), 9) AS sim
        FROM cn u JOIN cn v ON u.user_id <> v.user_id LEFT JOIN cd ON cd.x = u.user_id AND cd.y = v.user_id
        CROSS JOIN (SELECT count(DISTINCT item_id) AS k FROM train))"""
    return out


@register("user_cosine_centred", sql=lambda: with_ctes(f"SELECT x, y, sim, CAST(rank AS INTEGER) AS rank FROM cr WHERE rank <= {max(KS)}",
                                                       "train", "test", extra=_filled_sql(KS)))
def q_user_cosine_centred(spark, sf_dir):
    """H4: the 80 nearest users of each by centred cosine, unrated cells at 0 before centring."""
    return FA.neighbours_filled(_train(spark, sf_dir), max(KS))


@register("knn_predict_filled", sql=lambda: with_ctes(f"SELECT user_id, item_id, round(pred_{K}, {DIG}) AS pred FROM knn",
                                                      "train", "test", extra=_filled_sql((K,))))
def q_knn_predict_filled(spark, sf_dir):
    """H5 on these neighbours."""
    train = _train(spark, sf_dir)
    out = FA.knn_scores(train, test_ratings(spark, sf_dir), (K,), FA.neighbours_filled(train, K))
    return out.select("user_id", "item_id", F.round(f"pred_{K}", DIG).alias("pred"))


def _best_filled_sql() -> str:
    rows = " UNION ALL ".join(f"SELECT {k} AS k, count(*) AS n, round(sqrt(avg(pow(score - pred_{k}, 2))), {DIG}) AS rmse FROM knn"
                              for k in KS)
    return with_ctes(f"SELECT k, n, rmse, rmse = min(rmse) OVER () AS best FROM ({rows})", "train", "test", extra=_filled_sql(KS))


@register("knn_best_k_filled", sql=_best_filled_sql)
def q_knn_best_k_filled(spark, sf_dir):
    """H6 on these neighbours."""
    from pyspark.sql import Window as W
    train = _train(spark, sf_dir)
    out = FA.knn_errors(train, test_ratings(spark, sf_dir), KS, write_table(FA.neighbours_filled(train, max(KS)), "neighbours"))
    return out.withColumn("rmse", F.round("rmse", DIG)).withColumn("best", F.round("rmse", DIG) == F.min(F.round("rmse", DIG)).over(W.partitionBy()))
