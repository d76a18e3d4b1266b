"""Registered source/sink round trips.

The round trips write derived data in the reference's text formats into the
shared checkpoint folder and read it back with the readers, so the reader is
exercised over whole tables that grow with the data.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.plans.derived import (SQL, edges, rating_events, ratings, table, test_ratings, train_ratings,
                                  with_ctes)
from quarry.plans.registry import register
from quarry.session import scratch_path
from quarry.sources import edges_text, ratings_text


@register("rating_blocks", sql=with_ctes("SELECT user_id, item_id, score FROM train", "train"))
def q_rating_blocks(spark, sf_dir):
    """A10 raw-score sink -> A1 strict reader: must give back the train ratings exactly."""
    path = scratch_path(spark, "rating-blocks")
    ratings_text.write_blocks(train_ratings(spark, sf_dir), path, mode="raw")
    return ratings_text.read_blocks(spark, path, with_scores=True, strict=True)


@register("rating_pairs", sql=with_ctes("SELECT user_id, item_id FROM test", "test"))
def q_rating_pairs(spark, sf_dir):
    """A10 pair sink -> A3 reader on the test split."""
    path = scratch_path(spark, "rating-pairs")
    ratings_text.write_blocks(test_ratings(spark, sf_dir), path, with_scores=False)
    return ratings_text.read_pairs(spark, path)


@register("block_count_check", sql=with_ctes("""
SELECT user_id, declared, read FROM (
  SELECT o_custkey AS user_id, count(*) AS declared FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)
JOIN (SELECT user_id, count(*) AS read FROM ratings GROUP BY user_id) USING (user_id) WHERE declared <> read""", "ratings"))
def q_block_count_check(spark, sf_dir):
    """A4 on a block file whose headers count a user's purchases: users who bought a part twice have fewer lines."""
    path = scratch_path(spark, "rating-blocks")
    bought = rating_events(spark, sf_dir).groupBy("user_id").agg(F.count(F.lit(1)).alias("declared"))
    ratings_text.write_blocks(ratings(spark, sf_dir), path, mode="round", declared=bought)
    return ratings_text.block_count_check(spark, path)


@register("rating_block_lines", sql=with_ctes("""
SELECT user_id, 0 AS line_no, CAST(user_id AS VARCHAR) || '|' || CAST(count(*) AS VARCHAR) AS line FROM test GROUP BY user_id
UNION ALL
SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY item_id) AS INTEGER),
       CAST(item_id AS VARCHAR) || '  ' || CAST(CAST(round_even(score, 0) AS BIGINT) AS VARCHAR) FROM test""", "test"))
def q_block_lines(spark, sf_dir):
    """A10 'round' mode (half-even, as Python's round) on the test split."""
    return ratings_text.block_lines(test_ratings(spark, sf_dir), mode="round")


@register("edge_list", sql=with_ctes("SELECT src, dst FROM edges", extra={"edges": SQL["edges"]}))
def q_edge_list(spark, sf_dir):
    """A5: the derived edges written as 'src dst' lines and read back."""
    path = scratch_path(spark, "edges")
    edges_text.write_edge_list(edges(spark, sf_dir), path)
    return edges_text.read_edge_list(spark, path)


@register("matrix_coo", sql="""
SELECT vec_id AS i, CAST(j - 1 AS INTEGER) AS j, v FROM (
  SELECT vec_id, unnest(generate_series(1, len(embedding))) AS j, unnest(CAST(embedding AS DOUBLE[])) AS v
  FROM embeddings) WHERE v <> 0""")
def q_matrix_coo(spark, sf_dir):
    """Dense rows (the embedding matrix) to COO cells, zeros dropped."""
    e = table(spark, sf_dir, "embeddings")
    return (e.select(F.col("vec_id").alias("i"), F.posexplode(F.col("embedding").cast("array<double>")).alias("j", "v"))
            .where(F.col("v") != 0))
