"""Frequent patterns: frequent items, Apriori levels, FP-tree table.

Baskets are long form ``(tid, item)``.  Itemsets are ``(items ARRAY<STRING>
sorted, k, freq, support)``.  Support = freq / #baskets, kept when >= min_support.

Level k (Apriori):
  candidates = self-join of L(k-1) on its first k-2 items, last items a < b
    (the reference unions any two (k-1)-sets of size k, without the subset
    prune; the surviving frequent sets are the same, since every frequent
    k-set has all its (k-1)-subsets frequent);
  support = containment join: (tid, prefix set) rows of level k-1 joined with
    the basket's own later frequent items on tid, semi-joined with the
    candidates (for level 2 every such pair is one), counted per set.
Only frequent items take part; whether their table is broadcast is left to the
planner (at most mean basket length / min_support items can be frequent).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.iterate import materialize
from quarry.session import write_table


def baskets_from_rows(rows: DataFrame, tid_col: str, item_col: str) -> DataFrame:
    """Distinct (tid, item) long form from any (transaction, item) rows."""
    return rows.select(F.col(tid_col).alias("tid"), F.col(item_col).cast("string").alias("item")).distinct()


def basket_arrays(basket_items: DataFrame) -> DataFrame:
    """(tid, items ARRAY<STRING> sorted distinct) -- the list-of-lists view."""
    return basket_items.groupBy("tid").agg(F.sort_array(F.collect_set("item")).alias("items"))


def n_baskets(basket_items: DataFrame) -> DataFrame:
    return basket_items.agg(F.countDistinct("tid").alias("n_baskets"))


def frequent_items(basket_items: DataFrame, min_support: float, count_duplicates: bool = False,
                   raw_rows: DataFrame | None = None) -> DataFrame:
    """(items=[item], k=1, freq, support) for items with support >= min_support.

    Counts baskets containing the item.  ``count_duplicates=True`` with
    ``raw_rows`` (tid, item with repeats) counts every occurrence, as the
    reference's level 1 does.
    """
    n = n_baskets(basket_items)
    src = raw_rows if (count_duplicates and raw_rows is not None) else basket_items
    c = src.groupBy("item").agg(F.count(F.lit(1)).alias("freq"))
    c = c.crossJoin(F.broadcast(n))  # one-row scalar
    return (c.withColumn("support", F.col("freq") / F.col("n_baskets"))
            .where(F.col("support") >= F.lit(min_support))
            .select(F.array("item").alias("items"), F.lit(1).alias("k"), "freq", "support"))


def _cid(items):
    return F.concat_ws("\u0001", items)


def candidates(prev: DataFrame, k: int) -> DataFrame:
    """C(k), k >= 3, from L(k-1) by an equi-join on the first k-2 items: (pid, item = added last item)."""
    a = prev.select(F.col("items").alias("a"), F.slice("items", 1, k - 2).alias("_head"))
    b = prev.select(F.col("items").alias("b"), F.slice("items", 1, k - 2).alias("_head"))
    return a.join(b, "_head").where(F.col("a")[k - 2] < F.col("b")[k - 2]).select(
        _cid(F.col("a")).alias("pid"), F.col("b")[k - 2].alias("item"))


def containment_1(basket_items: DataFrame, frequent_1: DataFrame) -> DataFrame:
    """(tid, pid, last) for every frequent item of every basket (level-1 containment)."""
    f1 = frequent_1.select(F.col("items")[0].alias("item"))
    return basket_items.join(f1, "item", "left_semi").select(
        "tid", _cid(F.array("item")).alias("pid"), F.col("item").alias("last"))


def apriori_level(prev: DataFrame, contain_prev: DataFrame, contain_1: DataFrame, basket_items: DataFrame, k: int,
                  min_support: float) -> tuple[DataFrame, DataFrame]:
    """Frequent k-itemsets and their containment (tid, pid, last) from the (k-1) level.

    A basket's (k-1)-sets meet the basket's own later frequent items first, so
    rows are those of the baskets, not of prefixes times candidates.
    """
    later = contain_1.select("tid", F.col("last").alias("item"))
    hit = contain_prev.join(later, "tid").where(F.col("item") > F.col("last"))
    if k > 2:
        hit = hit.join(candidates(prev, k), ["pid", "item"], "left_semi")
    hit = hit.select("tid", F.concat_ws("\u0001", "pid", "item").alias("pid"), F.col("item").alias("last"))
    freq = (hit.groupBy("pid").agg(F.count(F.lit(1)).alias("freq")).crossJoin(F.broadcast(n_baskets(basket_items)))  # one row
            .withColumn("support", F.col("freq") / F.col("n_baskets")).where(F.col("support") >= F.lit(min_support)))
    sets = freq.select(F.split("pid", "\u0001").alias("items"), F.lit(k).alias("k"), "freq", "support")
    return sets, hit.join(freq.select("pid"), "pid", "left_semi")


def apriori_levels(basket_items: DataFrame, min_support: float, max_k: int):
    """Frequent itemsets of levels 1..max_k, one DataFrame per level (lazy)."""
    basket_items = materialize(basket_items)  # read by every level
    f1 = frequent_items(basket_items, min_support)
    one = containment_1(basket_items, f1)
    level, contain = f1, one
    out = [f1]
    for k in range(2, max_k + 1):
        level, contain = apriori_level(level, contain, one, basket_items, k, min_support)
        out.append(level)
    return out


def apriori(basket_items: DataFrame, min_support: float, max_k: int | None = None) -> DataFrame:
    """D3: all frequent itemsets, levels concatenated; stops at the first empty level.

    The driver loop holds only the level number; each level's sets and
    containment are checkpointed (reliable; nested cached plans re-plan slowly);
    emptiness is a ``limit(1)`` probe.
    """
    basket_items = materialize(basket_items)  # read by every level
    level = write_table(frequent_items(basket_items, min_support), "itemsets")
    one = contain = write_table(containment_1(basket_items, level), "containment")
    out = level
    k = 2
    while (max_k is None or k <= max_k) and level.limit(1).count() > 0:
        level, contain = apriori_level(level, contain, one, basket_items, k, min_support)
        contain = write_table(contain, "containment")
        level = write_table(level, "itemsets")
        if level.limit(1).count() == 0:
            break
        out = out.unionByName(level)
        k += 1
    return out


def fp_tree(basket_items: DataFrame, min_support: float) -> DataFrame:
    """FP-tree as a table of nodes (path, item, depth, count, listing).

    Items below min_support are dropped; each basket is ordered by global count
    descending (ties by item, which makes the tree canonical); every prefix of
    an ordered basket is a node, and a node's count is the number of baskets
    sharing that prefix.  ``path`` joins the prefix with '/'.
    """
    f1 = frequent_items(basket_items, min_support).select(F.col("items")[0].alias("item"), "freq")
    rows = basket_items.join(f1, "item")
    ordered = (rows.groupBy("tid")
               .agg(F.sort_array(F.collect_list(F.struct((-F.col("freq")).alias("nf"), "item"))).alias("s"))
               .select(F.transform("s", lambda x: x["item"]).alias("items")))
    nodes = (ordered.select("items", F.explode(F.sequence(F.lit(1), F.size("items"))).alias("depth"))
             .select(F.slice("items", 1, F.col("depth")).alias("prefix"), "depth")
             .groupBy("prefix", "depth").agg(F.count(F.lit(1)).alias("count")))
    item = F.element_at("prefix", -1)
    return nodes.select(
        F.concat_ws("/", "prefix").alias("path"), item.alias("item"), "depth", "count",
        F.concat(F.repeat(F.lit("  "), F.col("depth") - 1), item, F.lit(": "), F.col("count").cast("string"))
        .alias("listing"))


def fp_listing(tree: DataFrame) -> DataFrame:
    """Depth-first listing order of the tree (sort by path components)."""
    return tree.orderBy(F.split("path", "/"))


__all__ = ["baskets_from_rows", "basket_arrays", "frequent_items", "candidates", "containment_1",
           "apriori_level", "apriori_levels", "apriori", "fp_tree", "fp_listing"]
