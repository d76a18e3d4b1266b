"""Connected components of an edge table, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import drop_written, written


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, for every id in ``edges`` (long columns a, b).

    Each round maps every node to the first of itself and its neighbours, then
    contracts the edges to the images.  Even rounds take the smallest id (stars
    around small ids collapse at once), odd rounds an order by hash, which makes
    long chains shrink by a constant share.  Hubs are safe: the aggregation is
    combined before its shuffle, and the joins are plain ones that may be split.
    """
    e = edges.where("a <> b").select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    e = written(e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    at = written(e.select(F.col("a").alias("id")).distinct().withColumn("at", F.col("id")), "nodes")
    turn = 0
    while not e.isEmpty():
        mark = lambda c: F.transform(F.array(c), lambda _n: F.struct(
            (F.lit(0).cast("long") if turn % 2 == 0 else F.xxhash64(_n, F.lit(turn))).alias("o"), _n.alias("n")))[0]
        step = e.groupBy("a").agg(F.min(mark(F.col("b"))).alias("m")).select(
            "a", F.least(F.col("m"), mark(F.col("a")))["n"].alias("to"))
        step = written(step, "step")
        left = step.withColumnsRenamed({"a": "x", "to": "p"})
        right = step.withColumnsRenamed({"a": "y", "to": "q"})
        e2 = written(e.join(left, F.col("a") == F.col("x")).join(right, F.col("b") == F.col("y"))
                     .select(F.col("p").alias("a"), F.col("q").alias("b")).where("a <> b").distinct(), "edges")
        at2 = written(at.join(left, F.col("at") == F.col("x"), "left").select(
            "id", F.coalesce("p", "at").alias("at")), "nodes")
        for old in (e, at, step):
            drop_written(old)
        e, at, turn = e2, at2, turn + 1
    least = at.groupBy("at").agg(F.min("id").alias("component"))
    out = written(at.join(least, "at").select("id", "component"), "components")
    drop_written(at)
    return out
