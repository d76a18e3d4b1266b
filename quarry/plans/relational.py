"""Registered relational operators on the derived ratings."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import recsys as RS
from quarry.plans.derived import rating_events, ratings, table, test_ratings, train_ratings, with_ctes
from quarry.plans.registry import register
from quarry.session import write_table


@register("set_ops", sql=with_ctes("""
SELECT 'union' AS op, user_id FROM (SELECT user_id FROM train UNION SELECT user_id FROM test)
UNION ALL SELECT 'intersect', user_id FROM (SELECT user_id FROM train INTERSECT SELECT user_id FROM test)
UNION ALL SELECT 'train_minus_test', user_id FROM (SELECT user_id FROM train EXCEPT SELECT user_id FROM test)""",
                                    "train", "test"))
def q_set_ops(spark, sf_dir):
    """Union / intersection / difference of the user sets of train and test."""
    a = train_ratings(spark, sf_dir).select("user_id")
    b = test_ratings(spark, sf_dir).select("user_id")
    return (a.union(b).distinct().select(F.lit("union").alias("op"), "user_id")
            .unionByName(a.intersect(b).select(F.lit("intersect").alias("op"), "user_id"))
            .unionByName(a.subtract(b).select(F.lit("train_minus_test").alias("op"), "user_id")))


@register("user_item_lists", sql=with_ctes("""
SELECT user_id, CAST(count(*) AS INTEGER) AS n_items,
       array_to_string(list_sort(list(CAST(item_id AS VARCHAR))), ',') AS items
FROM ratings GROUP BY user_id""", "ratings"))
def q_user_item_lists(spark, sf_dir):
    """The items of every user as a sorted list (the N(u) sets of SVD++)."""
    r = ratings(spark, sf_dir)
    lists = r.groupBy("user_id").agg(F.sort_array(F.collect_list(F.col("item_id").cast("string"))).alias("_l"))
    return lists.select("user_id", F.size("_l").alias("n_items"), F.concat_ws(",", "_l").alias("items"))


@register("rating_pivot", sql=with_ctes("""
SELECT u.user_id, t.p_type, round(coalesce(m.score, 0), 9) AS score
FROM (SELECT DISTINCT user_id FROM ratings) u CROSS JOIN (SELECT DISTINCT p_type FROM ratings JOIN part ON item_id = p_partkey) t
LEFT JOIN (SELECT user_id, p_type, avg(score) AS score FROM ratings JOIN part ON item_id = p_partkey GROUP BY ALL) m
       ON m.user_id = u.user_id AND m.p_type = t.p_type""", "ratings"))
def q_rating_pivot(spark, sf_dir):
    """The wide table of users and part types (mean score, 0 = none) as its cells; the types come from the data."""
    r = ratings(spark, sf_dir).join(table(spark, sf_dir, "part").select("p_partkey", "p_type"),
                                    F.col("item_id") == F.col("p_partkey"))
    wide = RS.pivot_mean(r, "user_id", "p_type", "score")
    return wide.unpivot(["user_id"], [c for c in wide.columns if c != "user_id"], "p_type", "score")


@register("dense_ids", sql=with_ctes("""
SELECT user_id, CAST(dense_rank() OVER (ORDER BY user_id) - 1 AS BIGINT) AS idx
FROM (SELECT DISTINCT user_id FROM ratings)""", "ratings"))
def q_dense_ids(spark, sf_dir):
    """Dense 0-based user index in id order."""
    return RS.dense_ids(ratings(spark, sf_dir), "user_id")


@register("best_rated_by_index", sql=with_ctes("""
SELECT u.user_id, i.item_id, r.idx AS user_idx, r.score FROM (
  SELECT user_id, item_id, score, dense_rank() OVER (ORDER BY user_id) - 1 AS idx,
         row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rn FROM ratings) r
JOIN (SELECT DISTINCT user_id FROM ratings) u USING (user_id)
JOIN (SELECT DISTINCT item_id FROM ratings) i USING (item_id) WHERE rn = 1""", "ratings"))
def q_best_by_index(spark, sf_dir):
    """Every user's best item, found on dense indices and mapped back to the ids."""
    r = ratings(spark, sf_dir)
    users, items = (write_table(RS.dense_ids(r, c), f"{c}-map") for c in ("user_id", "item_id"))
    rows = (r.join(users.withColumnRenamed("idx", "u"), "user_id").join(items.withColumnRenamed("idx", "i"), "item_id")
            .groupBy("u").agg(F.max_by(F.struct("i", "score"), F.struct("score", -F.col("i"))).alias("b"))
            .select("u", F.col("u").alias("user_idx"), "b.i", "b.score"))
    return RS.raw_ids(RS.raw_ids(rows, users, "user_id", "u"), items, "item_id", "i").select("user_id", "item_id", "user_idx", "score")


@register("ratings_latest", sql="""
SELECT user_id, item_id, score FROM (
  SELECT o_custkey AS user_id, l_partkey AS item_id, l_quantity AS score,
         row_number() OVER (PARTITION BY o_custkey, l_partkey ORDER BY l_orderkey DESC, l_linenumber DESC, l_quantity DESC) AS rn
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey) WHERE rn = 1""")
def q_ratings_latest(spark, sf_dir):
    """Last write wins per (user, item) in load order (orderkey, linenumber, quantity)."""
    return RS.latest_ratings(rating_events(spark, sf_dir))


SPLIT_KEY = "('0x' || substr(md5(CAST(user_id AS VARCHAR) || '|' || CAST(item_id AS VARCHAR)), 1, 8))::BIGINT"


@register("split_random", sql=with_ctes(f"SELECT user_id, item_id, ({SPLIT_KEY} % 10) < 8 AS is_train FROM ratings",
                                         "ratings"))
def q_split_random(spark, sf_dir):
    """Stable 80/20 split."""
    return RS.split_random(ratings(spark, sf_dir)).select("user_id", "item_id", "is_train")


@register("split_stratified", sql=with_ctes("""
SELECT user_id, item_id, rn <= greatest(1, floor(n * 0.8)) AS is_train FROM (
  SELECT user_id, item_id,
         row_number() OVER (PARTITION BY user_id ORDER BY md5(CAST(user_id AS VARCHAR) || '|' || CAST(item_id AS VARCHAR)), item_id) AS rn,
         count(*) OVER (PARTITION BY user_id) AS n
  FROM ratings)""", "ratings"))
def q_split_stratified(spark, sf_dir):
    """80 % of every user's rows in train (at least one)."""
    return RS.split_stratified(ratings(spark, sf_dir)).select("user_id", "item_id", "is_train")


@register("split_by_user", sql=with_ctes("""
SELECT user_id, item_id, (('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8))::BIGINT % 10) < 8 AS is_train
FROM ratings""", "ratings"))
def q_split_by_user(spark, sf_dir):
    """Whole users in train or test."""
    return RS.split_by_user(ratings(spark, sf_dir)).select("user_id", "item_id", "is_train")


@register("ratings_shuffled", sql=with_ctes("""
SELECT user_id, item_id,
       CAST(row_number() OVER (ORDER BY md5('42|' || CAST(user_id AS VARCHAR) || '|' || CAST(item_id AS VARCHAR))) - 1 AS BIGINT) AS pos
FROM ratings""", "ratings"))
def q_ratings_shuffled(spark, sf_dir):
    """A stable global shuffle (md5 order) with each row's position, without a single-task window."""
    r = ratings(spark, sf_dir).withColumn(
        "_k", F.md5(F.concat_ws("|", F.lit("42"), F.col("user_id").cast("string"), F.col("item_id").cast("string"))))
    pos = RS.dense_ids(r, "_k", "pos")
    return r.join(pos, "_k").select("user_id", "item_id", "pos")
