"""Registered sampling and streaming queries (K1-K3).

Streaming runs read a derived table written as several parquet parts into the
shared scratch folder, hash-partitioned by their key into BATCHES micro-batches of
as many files as the rows call for, and run to completion with an availableNow
trigger.  Their results must equal the batch answers, so they share the batch oracles.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.plans.clusters import CHUNKS, THRESHOLD, bfr_sql
from quarry.plans.clusters import K as CLUSTERS
from quarry.plans.derived import points, rating_events, table
from quarry.plans.registry import register
from quarry.session import scratch_path
from quarry.streaming import operators as S

K = 100
SEED = 42
BATCHES = 5
EVENT_COLS = ["event_id", "user_id", "event_type", "value"]
RESERVOIR_SQL = f"""
SELECT event_id, user_id, event_type, value FROM events
ORDER BY md5('{SEED}|' || CAST(event_id AS VARCHAR)), event_id LIMIT {K}"""


def _in_batches(spark, df, name, key):
    """A file stream of ``df`` in about BATCHES micro-batches."""
    files = 1 + df.count() // (BATCHES * S.ROWS_PER_FILE)
    src = S.split_into_files(df, BATCHES * files, spark, name, key)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(src)


@register("reservoir", sql=RESERVOIR_SQL)
def q_reservoir(spark, sf_dir):
    """K1 batch: a uniform sample of 100 events (bottom-k of an md5 key)."""
    return S.reservoir_sample(table(spark, sf_dir, "events").select(*EVENT_COLS), K, ["event_id"], SEED)


@register("reservoir_stream", sql=RESERVOIR_SQL)
def q_reservoir_stream(spark, sf_dir):
    """K1 streaming: the same sample from micro-batches of the events table."""
    events = table(spark, sf_dir, "events").select(*EVENT_COLS)
    stream = _in_batches(spark, events, "events-stream", ("event_id",))
    state = scratch_path(spark, "reservoir-state")
    q = S.reservoir_stream(stream, K, ["event_id"], state, scratch_path(spark, "reservoir-ckpt"), SEED)
    q.awaitTermination()
    return S.latest_version(spark, state)


@register("ratings_upsert_stream", sql="""
SELECT user_id, item_id, score FROM (
  SELECT o_custkey AS user_id, l_partkey AS item_id, l_quantity AS score,
         row_number() OVER (PARTITION BY o_custkey, l_partkey ORDER BY l_orderkey DESC, l_linenumber DESC, l_quantity DESC) AS rn
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey) WHERE rn = 1""")
def q_upserts(spark, sf_dir):
    """K3: rating events streamed in micro-batches, last write wins per (user, item)."""
    ev = rating_events(spark, sf_dir)
    stream = _in_batches(spark, ev, "rating-events", ("seq",))
    state = scratch_path(spark, "upsert-state")
    q = S.upsert_stream(stream, ["user_id", "item_id"], "score", "seq", state, scratch_path(spark, "upsert-ckpt"))
    q.awaitTermination()
    return S.upserted(spark, state).select("user_id", "item_id", "score")


@register("bfr_stream", sql=bfr_sql)
def q_bfr_stream(spark, sf_dir):
    """K2: BFR with one chunk per micro-batch over the embedding points; equals ``bfr_assign``."""
    src, files = S.split_into_chunks(points(spark, sf_dir).select("id", "x"), CHUNKS, spark, "points-stream", seed=SEED)
    stream = spark.readStream.schema("id long, x array<double>").option("maxFilesPerTrigger", files).parquet(src)
    out = scratch_path(spark, "bfr-out")
    q = S.bfr_stream(stream, CLUSTERS, scratch_path(spark, "bfr-state"), out, scratch_path(spark, "bfr-ckpt"),
                     threshold=THRESHOLD, seed=SEED)
    q.awaitTermination()
    return spark.read.parquet(out).select("id", "cluster", F.col("batch").alias("chunk"))
