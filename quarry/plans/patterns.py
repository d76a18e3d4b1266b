"""Registered frequent-pattern queries on order baskets of part brands."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import patterns as P
from quarry.plans.derived import basket_items, with_ctes
from quarry.plans.registry import register
from quarry.plans.unroll import dbl

S_ITEMS = 0.12
S_PAIRS = 0.02
S_TRIPLES = 0.004
S_ALL = 0.004
S_TREE = 0.12


def _fmt(df):
    return df.select(F.concat_ws(",", "items").alias("items"), "k", "freq", F.round("support", 6).alias("support"))


N = "n AS (SELECT count(DISTINCT tid) AS n FROM basket_items)"


def _level_sql(k: int, s: float) -> str:
    alias = [chr(ord("a") + i) for i in range(k)]
    frm = " JOIN ".join(
        f"basket_items {a}" + ("" if i == 0 else f" ON {a}.tid = a.tid AND {alias[i - 1]}.item < {a}.item")
        for i, a in enumerate(alias))
    items = " || ',' || ".join(f"{a}.item" for a in alias)
    return (f"SELECT {items} AS items, {k} AS k, count(*) AS freq, round(count(*) / n.n, 6) AS support "
            f"FROM {frm} CROSS JOIN n GROUP BY {items}, n.n HAVING count(*) / n.n >= {dbl(s)}")


def _sql(body, *levels):
    return with_ctes(body, "basket_items", extra={"n": "SELECT count(DISTINCT tid) AS n FROM basket_items"})


@register("baskets", sql=with_ctes("""
SELECT tid, array_to_string(list_sort(list(item)), ',') AS items, CAST(count(*) AS INTEGER) AS n_items
FROM basket_items GROUP BY tid""", "basket_items"))
def q_baskets(spark, sf_dir):
    b = P.basket_arrays(basket_items(spark, sf_dir))
    return b.select("tid", F.concat_ws(",", "items").alias("items"), F.size("items").alias("n_items"))


@register("frequent_items", sql=lambda: _sql(_level_sql(1, S_ITEMS)))
def q_frequent_items(spark, sf_dir):
    return _fmt(P.frequent_items(basket_items(spark, sf_dir), S_ITEMS))


@register("apriori_pairs", sql=lambda: _sql(_level_sql(2, S_PAIRS)))
def q_apriori_pairs(spark, sf_dir):
    return _fmt(P.apriori_levels(basket_items(spark, sf_dir), S_PAIRS, 2)[-1])


@register("apriori_triples", sql=lambda: _sql(_level_sql(3, S_TRIPLES)))
def q_apriori_triples(spark, sf_dir):
    return _fmt(P.apriori_levels(basket_items(spark, sf_dir), S_TRIPLES, 3)[-1])


@register("frequent_itemsets", sql=lambda: _sql(" UNION ALL ".join(_level_sql(k, S_ALL) for k in (1, 2, 3, 4))),
          bench=True)
def q_frequent_itemsets(spark, sf_dir):
    return _fmt(P.apriori(basket_items(spark, sf_dir), S_ALL))


@register("fp_tree_nodes", sql=lambda: with_ctes(f"""
SELECT array_to_string(prefix, '/') AS path, prefix[-1] AS item, depth, count(*) AS count,
       repeat('  ', depth - 1) || prefix[-1] || ': ' || CAST(count(*) AS VARCHAR) AS listing
FROM (SELECT items[1:d] AS prefix, CAST(d AS INTEGER) AS depth
      FROM (SELECT items, unnest(generate_series(1, len(items))) AS d FROM ord))
GROUP BY prefix, depth""", "basket_items", extra={
    "n": "SELECT count(DISTINCT tid) AS n FROM basket_items",
    "f": f"SELECT item, count(*) AS freq FROM basket_items, n GROUP BY item, n.n HAVING count(*) / n.n >= {dbl(S_TREE)}",
    "ord": "SELECT tid, list(item ORDER BY freq DESC, item) AS items FROM basket_items JOIN f USING (item) GROUP BY tid",
}))
def q_fp_tree(spark, sf_dir):
    return P.fp_tree(basket_items(spark, sf_dir), S_TREE)
