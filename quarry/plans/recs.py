"""Registered recommender queries on the derived ratings.

ratings = (o_custkey, l_partkey, avg l_quantity); the md5 split puts 80 % of
(user, item) pairs in train.  Similarities and recommendations use all
ratings (the reference's in-memory CF holds every added rating); profile,
baselines and RMSE use the split.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import recsys as RS
from quarry.operators.pairs import partner_rows
from quarry.plans.derived import ratings, test_ratings, train_ratings, with_ctes
from quarry.plans.registry import register
from quarry.plans.unroll import dbl

DIG = 9
TOP_N = 5
ALPHA = 0.3
REG = 5.0


def _r(df, *cols, d=DIG):
    for c in cols:
        df = df.withColumn(c, F.round(c, d))
    return df


@register("rating_profile", sql=with_ctes("""
SELECT count(*) AS n_ratings, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items,
       round(count(*) / count(DISTINCT user_id), 9) AS ratings_per_user,
       round(count(*) / count(DISTINCT item_id), 9) AS ratings_per_item,
       (SELECT round(avg(m), 9) FROM (SELECT avg(score) FILTER (WHERE score <> 0) AS m FROM ratings GROUP BY user_id))
         AS mean_of_user_means
FROM ratings""", "ratings"))
def q_rating_profile(spark, sf_dir):
    return _r(RS.rating_profile(ratings(spark, sf_dir)), "ratings_per_user", "ratings_per_item", "mean_of_user_means")


@register("coverage_profile", sql=with_ctes("""
SELECT kind, n_test, n_unseen, n_sparse, round(n_unseen / n_test * 100, 9) AS pct_unseen,
       round(n_sparse / n_test * 100, 9) AS pct_sparse
FROM (
  SELECT 'user' AS kind, count(*) AS n_test,
         count(*) FILTER (WHERE c.n IS NULL) AS n_unseen, count(*) FILTER (WHERE c.n < 5) AS n_sparse
  FROM (SELECT DISTINCT user_id FROM test) t LEFT JOIN (SELECT user_id, count(*) AS n FROM train GROUP BY 1) c USING (user_id)
  UNION ALL
  SELECT 'item', count(*), count(*) FILTER (WHERE c.n IS NULL), count(*) FILTER (WHERE c.n < 5)
  FROM (SELECT DISTINCT item_id FROM test) t LEFT JOIN (SELECT item_id, count(*) AS n FROM train GROUP BY 1) c USING (item_id))
""", "train", "test"))
def q_coverage_profile(spark, sf_dir):
    return _r(RS.coverage_profile(train_ratings(spark, sf_dir), test_ratings(spark, sf_dir)), "pct_unseen", "pct_sparse")


@register("cold_start_keys", sql=with_ctes("""
SELECT 'user' AS kind, user_id AS id FROM (SELECT DISTINCT user_id FROM test) WHERE user_id NOT IN (SELECT user_id FROM train)
UNION ALL
SELECT 'item', item_id FROM (SELECT DISTINCT item_id FROM test) WHERE item_id NOT IN (SELECT item_id FROM train)""",
                                            "train", "test"))
def q_cold_start(spark, sf_dir):
    return RS.cold_start_keys(train_ratings(spark, sf_dir), test_ratings(spark, sf_dir))


@register("rating_describe", sql=with_ctes("""
SELECT count(score) AS count, round(avg(score), 9) AS mean, round(stddev_samp(score), 9) AS std,
       min(score) AS min, round(quantile_cont(score, 0.25), 9) AS q25, round(quantile_cont(score, 0.5), 9) AS q50,
       round(quantile_cont(score, 0.75), 9) AS q75, max(score) AS max FROM ratings""", "ratings"))
def q_describe(spark, sf_dir):
    return _r(RS.describe(ratings(spark, sf_dir)), "mean", "std", "q25", "q50", "q75")


@register("user_means", sql=with_ctes("""
SELECT user_id, count(*) FILTER (WHERE score <> 0) AS n, round(avg(score) FILTER (WHERE score <> 0), 9) AS mean
FROM ratings GROUP BY user_id""", "ratings"))
def q_user_means(spark, sf_dir):
    return _r(RS.user_means(ratings(spark, sf_dir)), "mean")


@register("item_counts", sql=with_ctes("SELECT item_id, count(*) AS n FROM ratings GROUP BY item_id", "ratings"))
def q_item_counts(spark, sf_dir):
    return RS.counts_by(ratings(spark, sf_dir), "item_id")


@register("topk_per_user", sql=with_ctes("""
SELECT user_id, item_id, score, rank FROM (
  SELECT user_id, item_id, score,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS INTEGER) AS rank
  FROM ratings) WHERE rank <= 5""", "ratings"))
def q_topk_per_user(spark, sf_dir):
    return RS.topk_per_key(ratings(spark, sf_dir), "user_id", "score", "item_id", TOP_N)


SIM_SQL = {
    "user_sim": """
SELECT a.user_id AS user_id_a, b.user_id AS user_id_b, count(*) AS n_common,
       CASE WHEN sqrt(sum(a.score * a.score)) * sqrt(sum(b.score * b.score)) <> 0
            THEN sum(a.score * b.score) / (sqrt(sum(a.score * a.score)) * sqrt(sum(b.score * b.score)))
            ELSE 0 END AS sim
FROM ratings a JOIN ratings b ON a.item_id = b.item_id AND a.user_id < b.user_id GROUP BY 1, 2""",
    "item_sim": """
SELECT a.item_id AS item_id_a, b.item_id AS item_id_b, count(*) AS n_common,
       CASE WHEN sqrt(sum(a.score * a.score)) * sqrt(sum(b.score * b.score)) <> 0
            THEN sum(a.score * b.score) / (sqrt(sum(a.score * a.score)) * sqrt(sum(b.score * b.score)))
            ELSE 0 END AS sim
FROM ratings a JOIN ratings b ON a.user_id = b.user_id AND a.item_id < b.item_id GROUP BY 1, 2""",
}


@register("co_rated_pairs", sql=with_ctes("""
SELECT a.user_id AS user_id_a, b.user_id AS user_id_b, count(*) AS n_common
FROM ratings a JOIN ratings b ON a.item_id = b.item_id AND a.user_id < b.user_id GROUP BY 1, 2""", "ratings"))
def q_co_rated(spark, sf_dir):
    p = partner_rows(ratings(spark, sf_dir), "item_id", "user_id")
    return p.groupBy("user_id_a", "user_id_b").agg(F.count(F.lit(1)).alias("n_common"))


@register("user_cosine", sql=with_ctes(
    "SELECT user_id_a, user_id_b, n_common, round(sim, 9) AS sim FROM user_sim", "ratings",
    extra={"user_sim": SIM_SQL["user_sim"]}))
def q_user_cosine(spark, sf_dir):
    return _r(RS.cosine_similarity(ratings(spark, sf_dir), "user_id", "item_id"), "sim")


@register("item_cosine", sql=with_ctes(
    "SELECT item_id_a, item_id_b, n_common, round(sim, 9) AS sim FROM item_sim", "ratings",
    extra={"item_sim": SIM_SQL["item_sim"]}))
def q_item_cosine(spark, sf_dir):
    return _r(RS.cosine_similarity(ratings(spark, sf_dir), "item_id", "user_id"), "sim")


def _rec_sql(side: str) -> dict[str, str]:
    if side == "user":
        agg = """SELECT n.x AS user_id, r.item_id, sum(n.sim * r.score) AS num, sum(n.sim) AS den
                 FROM (SELECT user_id_a AS x, user_id_b AS y, sim FROM user_sim
                       UNION ALL SELECT user_id_b, user_id_a, sim FROM user_sim) n
                 JOIN ratings r ON r.user_id = n.y WHERE n.sim > 0 GROUP BY 1, 2"""
    else:
        agg = """SELECT r.user_id, n.y AS item_id, sum(n.sim * r.score) AS num, sum(n.sim) AS den
                 FROM ratings r JOIN (SELECT item_id_a AS x, item_id_b AS y, sim FROM item_sim
                       UNION ALL SELECT item_id_b, item_id_a, sim FROM item_sim) n ON n.x = r.item_id
                 WHERE n.sim > 0 GROUP BY 1, 2"""
    return {
        f"{side}_sim": SIM_SQL[f"{side}_sim"],
        f"{side}_agg": agg,
        f"{side}_rec": f"""
SELECT user_id, item_id, pred, rank FROM (
  SELECT user_id, item_id, pred,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY pred DESC, item_id) AS INTEGER) AS rank
  FROM (SELECT s.user_id, s.item_id, round(s.num / s.den, {DIG}) AS pred FROM {side}_agg s
        ANTI JOIN ratings r ON r.user_id = s.user_id AND r.item_id = s.item_id WHERE s.den > 0))
WHERE rank <= {TOP_N}"""}


@register("rec_user_based", sql=lambda: with_ctes("SELECT * FROM user_rec", "ratings", extra=_rec_sql("user")))
def q_rec_user(spark, sf_dir):
    return RS.user_based(ratings(spark, sf_dir), TOP_N, digits=DIG)


@register("rec_item_based", sql=lambda: with_ctes("SELECT * FROM item_rec", "ratings", extra=_rec_sql("item")))
def q_rec_item(spark, sf_dir):
    return RS.item_based(ratings(spark, sf_dir), TOP_N, digits=DIG)


def _hybrid_sql():
    extra = {**_rec_sql("user"), **_rec_sql("item")}
    return with_ctes(f"""
SELECT user_id, item_id, pred, rank FROM (
  SELECT user_id, item_id, pred,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY pred DESC, item_id) AS INTEGER) AS rank
  FROM (SELECT coalesce(u.user_id, i.user_id) AS user_id, coalesce(u.item_id, i.item_id) AS item_id,
               {dbl(ALPHA)} * coalesce(u.pred, {dbl(0.0)}) + {dbl(1 - ALPHA)} * coalesce(i.pred, {dbl(0.0)}) AS pred
        FROM user_rec u FULL OUTER JOIN item_rec i ON u.user_id = i.user_id AND u.item_id = i.item_id))
WHERE rank <= {TOP_N}""", "ratings", extra=extra)


@register("rec_hybrid", sql=_hybrid_sql)
def q_rec_hybrid(spark, sf_dir):
    r = ratings(spark, sf_dir)
    # inputs are rounded; the blend of two rounded values is the same double in both engines
    return RS.hybrid(RS.user_based(r, TOP_N, digits=DIG), RS.item_based(r, TOP_N, digits=DIG), ALPHA, TOP_N)


BIAS_SQL = {
    "mu": "SELECT avg(score) AS mu FROM train",
    "bi": f"SELECT item_id, sum(score - mu) / ({dbl(REG)} + count(*)) AS b_i FROM train CROSS JOIN mu GROUP BY item_id",
    "bu": f"""SELECT user_id, sum(score - mu - b_i) / ({dbl(REG)} + count(*)) AS b_u
              FROM train JOIN bi USING (item_id) CROSS JOIN mu GROUP BY user_id""",
    "fb": """SELECT t.user_id, t.item_id,
                    CASE WHEN bu.b_u IS NOT NULL AND bi.b_i IS NOT NULL THEN 'both' WHEN bu.b_u IS NOT NULL THEN 'user'
                         WHEN bi.b_i IS NOT NULL THEN 'item' ELSE 'none' END AS tier,
                    CASE WHEN bu.b_u IS NOT NULL AND bi.b_i IS NOT NULL THEN mu + bu.b_u + bi.b_i
                         WHEN bu.b_u IS NOT NULL THEN mu + bu.b_u WHEN bi.b_i IS NOT NULL THEN mu + bi.b_i
                         ELSE mu END AS pred
             FROM test t LEFT JOIN bu ON bu.user_id = t.user_id LEFT JOIN bi ON bi.item_id = t.item_id CROSS JOIN mu""",
}


def _bias(spark, sf_dir):
    return RS.bias_model(train_ratings(spark, sf_dir), REG, REG)


@register("mf_baseline", sql=with_ctes("""
SELECT 'mu' AS kind, CAST(-1 AS BIGINT) AS id, round(mu, 9) AS bias FROM mu
UNION ALL SELECT 'item', item_id, round(b_i, 9) FROM bi
UNION ALL SELECT 'user', user_id, round(b_u, 9) FROM bu""", "train", extra=BIAS_SQL))
def q_mf_baseline(spark, sf_dir):
    mu, bi, bu = _bias(spark, sf_dir)
    out = (mu.select(F.lit("mu").alias("kind"), F.lit(-1).cast("bigint").alias("id"), F.col("mu").alias("bias"))
           .unionByName(bi.select(F.lit("item").alias("kind"), F.col("item_id").alias("id"), F.col("b_i").alias("bias")))
           .unionByName(bu.select(F.lit("user").alias("kind"), F.col("user_id").alias("id"), F.col("b_u").alias("bias"))))
    return _r(out, "bias")


@register("fallback_scores", sql=with_ctes(f"SELECT user_id, item_id, tier, round(pred, {DIG}) AS pred FROM fb",
                                            "train", "test", extra=BIAS_SQL))
def q_fallback(spark, sf_dir):
    mu, bi, bu = _bias(spark, sf_dir)
    return _r(RS.fallback_scores(test_ratings(spark, sf_dir), mu, bi, bu), "pred")


@register("ratings_zscore", sql=with_ctes("""
SELECT user_id, item_id, score, round((score - m) / s, 9) AS z
FROM ratings CROSS JOIN (SELECT avg(score) AS m, stddev_samp(score) AS s FROM ratings)""", "ratings"))
def q_zscore(spark, sf_dir):
    return _r(RS.zscore_ratings(ratings(spark, sf_dir)), "z")


@register("rmse_by_model", sql=with_ctes(f"""
SELECT model, n, round(rmse, {DIG}) AS rmse FROM (
  SELECT 'global_mean' AS model, count(*) AS n, sqrt(avg(pow(t.score - mu, 2))) AS rmse FROM test t CROSS JOIN mu
  UNION ALL
  SELECT 'user_mean', count(*), sqrt(avg(pow(t.score - coalesce(um.m, mu), 2)))
  FROM test t LEFT JOIN (SELECT user_id, avg(score) AS m FROM train GROUP BY 1) um USING (user_id) CROSS JOIN mu
  UNION ALL
  SELECT 'item_mean', count(*), sqrt(avg(pow(t.score - coalesce(im.m, mu), 2)))
  FROM test t LEFT JOIN (SELECT item_id, avg(score) AS m FROM train GROUP BY 1) im USING (item_id) CROSS JOIN mu
  UNION ALL
  SELECT 'bias', count(*), sqrt(avg(pow(t.score - fb.pred, 2)))
  FROM test t JOIN fb USING (user_id, item_id))""", "train", "test", extra=BIAS_SQL))
def q_rmse(spark, sf_dir):
    tr, te = train_ratings(spark, sf_dir), test_ratings(spark, sf_dir)
    mu, bi, bu = RS.bias_model(tr, REG, REG)
    um = tr.groupBy("user_id").agg(F.avg("score").alias("m"))
    im = tr.groupBy("item_id").agg(F.avg("score").alias("m"))
    base = te.select("user_id", "item_id").crossJoin(F.broadcast(mu))
    preds = {
        "global_mean": base.select("user_id", "item_id", F.col("mu").alias("pred")),
        "user_mean": base.join(um, "user_id", "left").select("user_id", "item_id", F.coalesce("m", "mu").alias("pred")),
        "item_mean": base.join(im, "item_id", "left").select("user_id", "item_id", F.coalesce("m", "mu").alias("pred")),
        "bias": RS.fallback_scores(te, mu, bi, bu),
    }
    out = None
    for name, p in preds.items():
        row = RS.rmse(p, te).select(F.lit(name).alias("model"), "n", F.round("rmse", DIG).alias("rmse"))
        out = row if out is None else out.unionByName(row)
    return out


# ---------------------------------------------------------------- graph propagation

GCN_DIM = 4


def _gcn_sql(weighted: bool, eps: float, layers: int | None, body: str) -> str:
    a = "score" if weighted else dbl(1.0)
    ctes = {
        "e": f"""SELECT 'u:' || CAST(user_id AS VARCHAR) AS src, 'i:' || CAST(item_id AS VARCHAR) AS dst, {a} AS a FROM train
                 UNION ALL SELECT 'i:' || CAST(item_id AS VARCHAR), 'u:' || CAST(user_id AS VARCHAR), {a} FROM train""",
        "deg": "SELECT src, sum(a) AS d FROM e GROUP BY src",
        "ne": f"""SELECT e.src, e.dst, e.a / sqrt((ds.d + {dbl(eps)}) * (dd.d + {dbl(eps)})) AS w
                  FROM e JOIN deg ds ON ds.src = e.src JOIN deg dd ON dd.src = e.dst""",
    }
    if layers:
        ctes["nodes"] = "SELECT DISTINCT src AS node FROM e"
        ctes["l0"] = f"""SELECT node, CAST(f AS INTEGER) AS f,
            ((('0x' || substr(md5('42|' || node || '|' || CAST(f AS VARCHAR)), 1, 8))::BIGINT / {dbl(4294967296.0)}
              - {dbl(0.5)}) * {dbl(0.2)}) AS val FROM nodes CROSS JOIN range(0, {GCN_DIM}) t(f)"""
        for k in range(1, layers + 1):
            ctes[f"l{k}"] = (f"SELECT ne.dst AS node, x.f, sum(ne.w * x.val) AS val FROM ne JOIN l{k - 1} x "
                             f"ON x.node = ne.src GROUP BY ne.dst, x.f")
        tot = "l0.val" + "".join(f" + coalesce(l{k}.val, {dbl(0.0)})" for k in range(1, layers + 1))
        joins = "".join(f" LEFT JOIN l{k} ON l{k}.node = l0.node AND l{k}.f = l0.f" for k in range(1, layers + 1))
        ctes["fin"] = f"SELECT l0.node, l0.f, ({tot}) / {dbl(layers + 1)} AS val FROM l0{joins}"
    return with_ctes(body, "train", "test", extra=ctes)


def _gcn(spark, sf_dir, weighted, eps):
    from quarry.operators import gcn
    return gcn.normalized_edges(gcn.bipartite_edges(train_ratings(spark, sf_dir), "score" if weighted else None), eps)


def _propagated(spark, sf_dir, weighted, layers):
    """(id, val) of users and of items."""
    from quarry.operators import bipartite
    return bipartite.propagated(train_ratings(spark, sf_dir), GCN_DIM, layers, weighted)


@register("gcn_norm_edges", sql=lambda: _gcn_sql(False, 0.0, None, "SELECT src, dst, round(w, 9) AS w FROM ne"))
def q_gcn_norm(spark, sf_dir):
    """D^-1/2 A D^-1/2 of the train bipartite graph (edge weight 1)."""
    return _r(_gcn(spark, sf_dir, False, 0.0), "w")


@register("gcn_norm_edges_weighted", sql=lambda: _gcn_sql(True, 1e-10, None, "SELECT src, dst, round(w, 9) AS w FROM ne"))
def q_gcn_norm_w(spark, sf_dir):
    """Ratings as edge weights, degree + 1e-10."""
    return _r(_gcn(spark, sf_dir, True, 1e-10), "w")


@register("gcn_propagate", sql=lambda: _gcn_sql(False, 0.0, 3, "SELECT node, f, round(val, 9) AS val FROM fin"))
def q_gcn_prop(spark, sf_dir):
    """Mean of layers 0..3 of A_hat propagation from seeded embeddings."""
    from quarry.operators import bipartite
    return _r(bipartite.tagged(*_propagated(spark, sf_dir, False, 3)), "val")


@register("gcn_propagate_weighted", sql=lambda: _gcn_sql(True, 0.0, 2, "SELECT node, f, round(val, 9) AS val FROM fin"))
def q_gcn_prop_w(spark, sf_dir):
    """Rating-weighted adjacency, two layers."""
    from quarry.operators import bipartite
    return _r(bipartite.tagged(*_propagated(spark, sf_dir, True, 2)), "val")


@register("gcn_scores", sql=lambda: _gcn_sql(False, 0.0, 3, """
SELECT t.user_id, t.item_id, round(sum(u.val * i.val), 9) AS score FROM test t
JOIN fin u ON u.node = 'u:' || CAST(t.user_id AS VARCHAR)
JOIN fin i ON i.node = 'i:' || CAST(t.item_id AS VARCHAR) AND i.f = u.f GROUP BY t.user_id, t.item_id"""))
def q_gcn_scores(spark, sf_dir):
    """H12 scoring: dot product of propagated user and item embeddings for the test pairs."""
    from quarry.operators import bipartite
    return _r(bipartite.products(test_ratings(spark, sf_dir), *_propagated(spark, sf_dir, False, 3)), "score")


GRID = (0.0, 2.0, 5.0, 10.0, 25.0)


def _grid_sql() -> str:
    parts, extra = [], {}
    for g, reg in enumerate(GRID):
        extra[f"mu{g}"] = "SELECT avg(score) AS mu FROM train"
        extra[f"bi{g}"] = (f"SELECT item_id, sum(score - mu) / ({dbl(reg)} + count(*)) AS b_i "
                           f"FROM train CROSS JOIN mu{g} GROUP BY item_id")
        extra[f"bu{g}"] = (f"SELECT user_id, sum(score - mu - b_i) / ({dbl(reg)} + count(*)) AS b_u "
                           f"FROM train JOIN bi{g} USING (item_id) CROSS JOIN mu{g} GROUP BY user_id")
        pred = ("CASE WHEN bu.b_u IS NOT NULL AND bi.b_i IS NOT NULL THEN mu + bu.b_u + bi.b_i "
                "WHEN bu.b_u IS NOT NULL THEN mu + bu.b_u WHEN bi.b_i IS NOT NULL THEN mu + bi.b_i ELSE mu END")
        parts.append(f"""SELECT {dbl(reg)} AS reg, count(*) AS n, round(sqrt(avg(pow(t.score - ({pred}), 2))), {DIG}) AS rmse
            FROM test t LEFT JOIN bu{g} bu ON bu.user_id = t.user_id LEFT JOIN bi{g} bi ON bi.item_id = t.item_id
            CROSS JOIN mu{g}""")
    body = " UNION ALL ".join(parts)
    return with_ctes(f"SELECT reg, n, rmse, CAST(rank() OVER (ORDER BY rmse, reg) AS INTEGER) AS rank FROM ({body})",
                     "train", "test", extra=extra)


@register("grid_results", sql=_grid_sql)
def q_grid(spark, sf_dir):
    """Grid over the bias model's regularisation; validation RMSE per setting and its rank."""
    from pyspark.sql import Window as W
    tr, te = train_ratings(spark, sf_dir), test_ratings(spark, sf_dir)
    out = None
    for reg in GRID:
        mu, bi, bu = RS.bias_model(tr, reg, reg)
        row = RS.rmse(RS.fallback_scores(te, mu, bi, bu), te).select(
            F.lit(reg).alias("reg"), "n", F.round("rmse", DIG).alias("rmse"))
        out = row if out is None else out.unionByName(row)
    # a five-row table: the global window is over the grid, not the data
    return out.withColumn("rank", F.rank().over(W.orderBy("rmse", "reg")))


@register("scaled_scores", sql=with_ctes(f"""
SELECT user_id, item_id, round(z, {DIG}) AS z, round(scaled, {DIG}) AS scaled,
       CAST(least(greatest(round_even(scaled, 0), {dbl(20.0)}), {dbl(100.0)}) AS INTEGER) AS rating
FROM (SELECT user_id, item_id, z, least(greatest({dbl(40.0)} + {dbl(30.0)} * z, {dbl(20.0)}), {dbl(100.0)}) AS scaled
      FROM (SELECT user_id, item_id, (score - m) / s AS z FROM ratings
            CROSS JOIN (SELECT avg(score) AS m, stddev_samp(score) AS s FROM ratings)))""", "ratings"))
def q_scaled_scores(spark, sf_dir):
    """Z-score, linear scale 40 + 30 z clamped to [20, 100], half-even integer rating."""
    from quarry.functions.scalar import round_clamp_int, scale_score
    z = RS.zscore_ratings(ratings(spark, sf_dir)).withColumn("scaled", scale_score(F.col("z")))
    out = z.select("user_id", "item_id", "z", "scaled", round_clamp_int(F.col("scaled")).alias("rating"))
    return _r(out, "z", "scaled")
