"""Loading the driver tables and the derived inputs every registered query uses.

The reference's operators work on five kinds of table (baskets, documents,
points, link graphs, ratings).  They are derived from the driver's TPC-H-like
tables so that every query's work grows with the data:

- ratings:  o_custkey -> user_id, l_partkey -> item_id, avg(l_quantity) -> score
- baskets:  per l_orderkey the distinct p_brand values (lineitem x part)
- graph:    vertices = parts (id 3 * key), customers (3 * key + 1) and suppliers
            (3 * key + 2); a customer links to every part of the customer's orders,
            a part to every customer who returned it and to its suppliers.
            Suppliers, customers without orders and parts never ordered are
            dangling.  All lineitems take part.
- points:   embeddings.embedding (as doubles), labelled y = label >= 5
- splits:   md5 of 'user|item' -> first 8 hex digits mod 10 < 8 means train, but for
            users and items with md5 mod 25 = 0: they are held out, so that test has unknown keys

Each derivation has a DuckDB twin in ``SQL`` used by the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import md5_bucket

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


HELD_OUT = 25   # one of so many users and items is in test only


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
            .agg(F.avg("l_quantity").alias("score")))


def rating_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating stream in load order: one row per lineitem, seq = (orderkey, linenumber, quantity).

    (orderkey, linenumber) is not unique in the generated data; the quantity
    breaks the remaining ties so that "last" is well defined.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").alias("score"),
        F.struct(F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_quantity")).alias("seq"))


def with_split(r: DataFrame, train_buckets: int = 8) -> DataFrame:
    known = (md5_bucket("user_id", modulus=HELD_OUT) != 0) & (md5_bucket("item_id", modulus=HELD_OUT) != 0)
    return r.withColumn("is_train", (md5_bucket("user_id", "item_id", modulus=10) < train_buckets) & known)


def train_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_split(ratings(spark, sf_dir)).where("is_train").drop("is_train")


def test_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_split(ratings(spark, sf_dir)).where("not is_train").drop("is_train")


def basket_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long form (tid, item): distinct brands per order."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return (li.join(p, li.l_partkey == p.p_partkey)
            .select(F.col("l_orderkey").alias("tid"), F.col("p_brand").alias("item")).distinct())


def vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select((F.col("p_partkey") * 3).alias("id"))
    return parts.union(table(spark, sf_dir, "customer").select((F.col("c_custkey") * 3 + 1).alias("id"))).union(
        table(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 3 + 2).alias("id")))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    part, customer = F.col("l_partkey") * 3, F.col("o_custkey") * 3 + 1
    both = li.join(o, li.l_orderkey == o.o_orderkey).select(part.alias("part"), customer.alias("customer"), "l_returnflag")
    bought = both.select(F.col("customer").alias("src"), F.col("part").alias("dst"))
    returned = both.where("l_returnflag = 'R'").select(F.col("part").alias("src"), F.col("customer").alias("dst"))
    supplied = li.select(part.alias("src"), (F.col("l_suppkey") * 3 + 2).alias("dst"))
    return bought.union(returned).union(supplied).distinct()


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("x"),
                    F.col("label"))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points(spark, sf_dir).select("id", "x", F.when(F.col("label") >= 5, 1.0).otherwise(0.0).alias("y"))


# DuckDB twins of the derivations above (inlined as CTEs by the oracles).
SQL = {
    "ratings": """
        SELECT o_custkey AS user_id, l_partkey AS item_id, avg(l_quantity) AS score
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        GROUP BY o_custkey, l_partkey""",
    "ratings_split": f"""
        SELECT user_id, item_id, score,
               (('0x' || substr(md5(CAST(user_id AS VARCHAR) || '|' || CAST(item_id AS VARCHAR)), 1, 8))::BIGINT % 10) < 8
               AND ('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8))::BIGINT % {HELD_OUT} <> 0
               AND ('0x' || substr(md5(CAST(item_id AS VARCHAR)), 1, 8))::BIGINT % {HELD_OUT} <> 0 AS is_train
        FROM ratings""",
    "train": "SELECT user_id, item_id, score FROM ratings_split WHERE is_train",
    "test": "SELECT user_id, item_id, score FROM ratings_split WHERE NOT is_train",
    "basket_items": """
        SELECT DISTINCT l_orderkey AS tid, p_brand AS item
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "vertices": "SELECT p_partkey * 3 AS id FROM part UNION ALL SELECT c_custkey * 3 + 1 FROM customer "
                "UNION ALL SELECT s_suppkey * 3 + 2 FROM supplier",
    "edges": """
        SELECT o_custkey * 3 + 1 AS src, l_partkey * 3 AS dst FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        UNION SELECT l_partkey * 3, l_suppkey * 3 + 2 FROM lineitem
        UNION SELECT l_partkey * 3, o_custkey * 3 + 1 FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE l_returnflag = 'R'""",
    "points": "SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x, label FROM embeddings",
}


def with_ctes(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the derived-input CTEs it needs (dependencies first)."""
    deps = {"ratings_split": ["ratings"], "train": ["ratings", "ratings_split"],
            "test": ["ratings", "ratings_split"]}
    order: list[str] = []
    for n in names:
        for d in deps.get(n, []) + [n]:
            if d not in order:
                order.append(d)
    parts = [f"{n} AS ({SQL[n]})" for n in order]
    for n, q in (extra or {}).items():
        parts.append(f"{n} AS ({q})")
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body
