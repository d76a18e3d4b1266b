"""Graph propagation for recommenders.

The user-item bipartite graph is an edge table in both directions with node
ids tagged ``u:<id>`` / ``i:<id>``; the normalised adjacency
A_hat = D^-1/2 A D^-1/2 is a weight column computed once; one layer is ``E' = A_hat E``:
a join on the edge source plus a grouped sum of arrays by destination.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import md5_32
from quarry.session import write_table


def bipartite_edges(ratings: DataFrame, weight: str | None = None) -> DataFrame:
    """(src, dst, a): user->item and item->user edges; a = 1 or the rating."""
    a = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    u = F.concat(F.lit("u:"), F.col("user_id").cast("string"))
    i = F.concat(F.lit("i:"), F.col("item_id").cast("string"))
    e = ratings.select(u.alias("src"), i.alias("dst"), a.alias("a"))
    return e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "a"))


def normalized_edges(edges: DataFrame, eps: float = 0.0) -> DataFrame:
    """(src, dst, w) with w = a / sqrt((deg(src)+eps) (deg(dst)+eps)), deg = sum of weights."""
    deg = edges.groupBy("src").agg(F.sum("a").alias("_d"))
    ds = deg.select(F.col("src"), F.col("_d").alias("_ds"))
    dd = deg.select(F.col("src").alias("dst"), F.col("_d").alias("_dd"))
    j = edges.join(ds, "src").join(dd, "dst")
    w = F.col("a") / F.sqrt((F.col("_ds") + F.lit(eps)) * (F.col("_dd") + F.lit(eps)))
    return j.select("src", "dst", w.alias("w"))


def seeded_embeddings(nodes: DataFrame, dim: int, scale: float = 0.2, seed: int = 42) -> DataFrame:
    """Deterministic initial embeddings (node, f, val) in [-scale/2, scale/2) from md5('seed|node|f')."""
    f = F.explode(F.sequence(F.lit(0), F.lit(dim - 1))).alias("f")
    x = nodes.select("node", f)
    key = F.concat_ws("|", F.lit(str(seed)), F.col("node"), F.col("f").cast("string"))
    return x.select("node", "f", ((md5_32(key) / F.lit(4294967296.0) - F.lit(0.5)) * F.lit(scale)).alias("val"))


def propagate(norm_edges: DataFrame, emb0: DataFrame, layers: int = 3) -> DataFrame:
    """Mean of E^0..E^L with E^(l+1) = A_hat E^l; takes and returns (node, f, val).

    Inside, a node's factors are one array, so an edge is shuffled once a layer and not once a factor.
    """
    norm_edges = write_table(norm_edges, "gcn-edges")
    held = emb0.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("f", "val"))).alias("e"))
    held = write_table(held.select("node", F.col("e.f").alias("f"), F.col("e.val").alias("val")), "gcn-first")
    dim = held.agg(F.coalesce(F.max(F.size("val")), F.lit(0))).first()[0]
    if not dim:
        return emb0.select("node", "f", "val")
    every = layers_of(norm_edges, held, dim, layers)
    total = F.array(*[sum((F.col(f"l{k}")[f] for k in range(1, layers + 1)), F.col("l0")[f]) / float(layers + 1) for f in range(dim)])
    return (every.join(held.select("node", "f"), "node").select("node", F.explode(F.arrays_zip("f", total.alias("val"))).alias("e"))
            .select("node", "e.f", "e.val"))


def layers_of(norm_edges: DataFrame, first: DataFrame, dim: int, layers: int) -> DataFrame:
    """(node, l0, l1, ...): the layers of E^(l+1) = A_hat E^l as arrays, from ``first`` (node, val).

    An edge is shuffled once a layer with the whole array.  ``norm_edges`` should be a written table.
    """
    out = write_table(first.select("node", F.col("val").alias("l0")), "gcn-layer")
    cur = out.select("node", F.col("l0").alias("val"))
    none = F.array(*[F.lit(0.0)] * dim)
    for k in range(1, layers + 1):
        sums = F.array(*[F.sum(F.col("w") * F.col("val")[f]) for f in range(dim)])
        cur = write_table(norm_edges.join(cur.select(F.col("node").alias("src"), "val"), "src")
                          .groupBy(F.col("dst").alias("node")).agg(sums.alias("val")), "gcn-layer")
        out = out.join(cur.select("node", F.col("val").alias(f"l{k}")), "node", "left").withColumn(
            f"l{k}", F.coalesce(f"l{k}", none))
    return out


def score_pairs(emb: DataFrame, pairs: DataFrame) -> DataFrame:
    """Dot product of the final user and item embeddings for (user_id, item_id) pairs."""
    u = emb.select(F.col("node").alias("_u"), "f", F.col("val").alias("_eu"))
    i = emb.select(F.col("node").alias("_i"), "f", F.col("val").alias("_ei"))
    p = pairs.select("user_id", "item_id", F.concat(F.lit("u:"), F.col("user_id").cast("string")).alias("_u"),
                     F.concat(F.lit("i:"), F.col("item_id").cast("string")).alias("_i"))
    return (p.join(u, "_u").join(i, ["_i", "f"]).groupBy("user_id", "item_id")
            .agg(F.sum(F.col("_eu") * F.col("_ei")).alias("score")))
