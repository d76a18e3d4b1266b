"""Registered link-analysis queries on the derived customer-part graph.

Graph: see ``quarry.plans.derived``; it takes all lineitems.  Loops run a fixed
number of rounds (tol=None) so the unrolled DuckDB chains compute the same vector.
Topic set: customers of nations in region ASIA.  Trusted set: customers with
c_acctbal > 9000.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import graph as G
from quarry.plans.derived import SQL, edges, table, vertices
from quarry.plans.registry import register
from quarry.plans.unroll import dbl, hits_ctes, pagerank_ctes, with_clause
from quarry.session import write_table

ROUNDS = 20
D = 0.85
SWEEP = (0.75, 0.85, 0.95)
TOPK = 100
DIGITS = 9


def _g(spark, sf_dir):
    return vertices(spark, sf_dir), edges(spark, sf_dir).cache()


def _topic_ids(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").where(F.col("r_name") == "ASIA").select("r_regionkey")
    return (c.join(n, c.c_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
            .select((F.col("c_custkey") * 3 + 1).alias("id")))


def _trusted_ids(spark, sf_dir):
    return table(spark, sf_dir, "customer").where(F.col("c_acctbal") > 9000).select((F.col("c_custkey") * 3 + 1).alias("id"))


BASE = [f"vertices AS ({SQL['vertices']})", f"edges AS ({SQL['edges']})"]
TOPIC_SQL = [
    """topic_ids AS (SELECT c_custkey * 3 + 1 AS id FROM customer JOIN nation ON c_nationkey = n_nationkey
                     JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA')""",
    f"""topic_raw AS (SELECT v.id, CASE WHEN t.id IS NOT NULL THEN {dbl(0.4)} ELSE {dbl(0.05)} END AS w
                     FROM vertices v LEFT JOIN topic_ids t ON t.id = v.id)""",
    "topic_v AS (SELECT id, w / (SELECT sum(w) FROM topic_raw) AS v FROM topic_raw)",
]
TRUST_SQL = [
    "trusted_ids AS (SELECT c_custkey * 3 + 1 AS id FROM customer WHERE c_acctbal > 9000)",
    f"""trust_v AS (SELECT v.id, CASE WHEN t.id IS NOT NULL THEN {dbl(0.9)} / (SELECT count(*) FROM trusted_ids)
                    WHEN (SELECT count(*) FROM vertices) - (SELECT count(*) FROM trusted_ids) > 0
                    THEN {dbl(1 - 0.9)} / ((SELECT count(*) FROM vertices) - (SELECT count(*) FROM trusted_ids))
                    ELSE {dbl(0.0)} END AS v FROM vertices v LEFT JOIN trusted_ids t ON t.id = v.id)""",
]


def _pr_sql(teleport=None, dangling="uniform", d=D, prefix="p_"):
    extra = TOPIC_SQL if teleport == "topic_v" else TRUST_SQL if teleport == "trust_v" else []
    ctes, last = pagerank_ctes(prefix, "vertices", "edges", ROUNDS, d, teleport, dangling)
    return BASE + extra, ctes, last


def _simple_pr_sql(teleport=None, dangling="uniform"):
    base, ctes, last = _pr_sql(teleport, dangling)
    return with_clause(base + ctes) + f"SELECT id, round(pr, {DIGITS}) AS pr FROM {last}"


def _round(df, *cols):
    for c in cols:
        df = df.withColumn(c, F.round(c, DIGITS))
    return df


@register("pagerank", sql=lambda: _simple_pr_sql(), bench=True)
def q_pagerank(spark, sf_dir):
    v, e = _g(spark, sf_dir)
    return _round(G.pagerank(v, e, D, ROUNDS, tol=None), "pr")


@register("pagerank_leaky", sql=lambda: _simple_pr_sql(dangling="leak"))
def q_pagerank_leaky(spark, sf_dir):
    v, e = _g(spark, sf_dir)
    return _round(G.pagerank(v, e, D, ROUNDS, tol=None, dangling="leak"), "pr")


@register("pagerank_topic", sql=lambda: _simple_pr_sql(teleport="topic_v"))
def q_pagerank_topic(spark, sf_dir):
    v, e = _g(spark, sf_dir)
    tv = G.topic_vector(v, _topic_ids(spark, sf_dir))
    return _round(G.pagerank(v, e, D, ROUNDS, tol=None, teleport=tv), "pr")


@register("topic_vector", sql=lambda: with_clause(BASE + TOPIC_SQL) + f"SELECT id, round(v, {DIGITS}) AS v FROM topic_v")
def q_topic_vector(spark, sf_dir):
    v, _ = _g(spark, sf_dir)
    return _round(G.topic_vector(v, _topic_ids(spark, sf_dir)), "v")


@register("trustrank", sql=lambda: _simple_pr_sql(teleport="trust_v"))
def q_trustrank(spark, sf_dir):
    v, e = _g(spark, sf_dir)
    return _round(G.trustrank(v, e, _trusted_ids(spark, sf_dir), D, ROUNDS, tol=None), "pr")


def _spam_sql():
    base, c1, l1 = _pr_sql(prefix="p_")
    _, c2, l2 = _pr_sql(teleport="trust_v", prefix="t_")
    return with_clause(base + TRUST_SQL + c1 + c2) + f"""
SELECT a.id, round(a.pr, {DIGITS}) AS pr, round(b.pr, {DIGITS}) AS tr,
       round(CASE WHEN a.pr <> 0 THEN (a.pr - b.pr) / a.pr END, 6) AS spam_mass
FROM {l1} a JOIN {l2} b ON a.id = b.id"""


@register("spam_mass", sql=_spam_sql)
def q_spam_mass(spark, sf_dir):
    v, e = _g(spark, sf_dir)
    both = G.pageranks(v, e, {"pr": (D, None), "tr": (D, G.trust_vector(v, _trusted_ids(spark, sf_dir)))}, ROUNDS, tol=None)
    out = G.spam_mass(both.select("id", "pr"), both.select("id", F.col("tr").alias("pr")))
    return _round(out, "pr", "tr").withColumn("spam_mass", F.round("spam_mass", 6))


def _sweep_sql():
    parts, ctes, lasts = [], [], []
    for k, d in enumerate(SWEEP):
        _, c, last = _pr_sql(d=d, prefix=f"s{k}_")
        ctes += c
        parts.append(f"SELECT {dbl(d)} AS d, id, round(pr, {DIGITS}) AS pr FROM {last}")
    return with_clause(BASE + ctes) + "\nUNION ALL\n".join(parts)


@register("pagerank_sweep", sql=_sweep_sql)
def q_pagerank_sweep(spark, sf_dir):
    v, e = _g(spark, sf_dir)
    every = G.pageranks(v, e, {f"d{k}": (d, None) for k, d in enumerate(SWEEP)}, ROUNDS, tol=None)
    rows = F.array(*[F.struct(F.lit(d).alias("d"), F.col(f"d{k}").alias("pr")) for k, d in enumerate(SWEEP)])
    return _round(every.select("id", F.explode(rows).alias("r")).select("r.d", "id", "r.pr"), "pr")


def _idrange_sql():
    base = [f"edges AS ({SQL['edges']})",
            "vertices AS (SELECT range AS id FROM range((SELECT greatest(max(src), max(dst)) + 1 FROM edges)))"]
    ctes, last = pagerank_ctes("p_", "vertices", "edges", ROUNDS, D)
    return with_clause(base + ctes) + f"""
SELECT id, round(pr, {DIGITS}) AS pr FROM {last} ORDER BY round(pr, {DIGITS}) DESC, id LIMIT {TOPK}"""


@register("pagerank_idrange_top100", sql=_idrange_sql)
def q_pagerank_idrange(spark, sf_dir):
    e = edges(spark, sf_dir).cache()
    top = e.agg(F.greatest(F.max("src"), F.max("dst"))).first()[0]
    v = spark.range(0, (-1 if top is None else top) + 1)   # dealt over tasks
    pr = _round(G.pagerank(v, e, D, ROUNDS, tol=None), "pr")
    return G.top_k(pr, "pr", TOPK)


def _hits_sql():
    ctes, last = hits_ctes("h_", "vertices", "edges", ROUNDS)
    return with_clause(BASE + ctes) + (f"SELECT id, round(authority, {DIGITS}) AS authority, "
                                       f"round(hub, {DIGITS}) AS hub FROM {last}")


@register("hits", sql=_hits_sql)
def q_hits(spark, sf_dir):
    v, e = _g(spark, sf_dir)
    return _round(G.hits(v, e, ROUNDS, tol=None), "authority", "hub")


@register("dead_ends", sql=with_clause(BASE) + "SELECT id FROM vertices WHERE id NOT IN (SELECT src FROM edges)")
def q_dead_ends(spark, sf_dir):
    v, e = _g(spark, sf_dir)
    return G.dead_ends(v, e)


@register("out_degree", sql=with_clause(BASE) + "SELECT src, count(*) AS outdeg FROM edges GROUP BY src")
def q_out_degree(spark, sf_dir):
    return G.out_degree(edges(spark, sf_dir))


@register("graph_stats", sql=with_clause(BASE) + """
SELECT (SELECT count(*) FROM vertices) AS n_nodes, (SELECT count(*) FROM edges) AS n_edges,
       (SELECT max(id) FROM vertices) AS max_id,
       CAST((SELECT count(*) FROM edges) AS DOUBLE) / (SELECT count(*) FROM vertices) AS mean_out_degree,
       (SELECT count(*) FROM vertices WHERE id NOT IN (SELECT src FROM edges)) AS n_dead_ends,
       (SELECT count(*) FROM edges WHERE src = dst) AS n_self_loops""")
def q_graph_stats(spark, sf_dir):
    v, e = _g(spark, sf_dir)
    return G.graph_stats(v, e)


def _report_sql():
    base, c1, l1 = _pr_sql(prefix="p_")
    _, c2, l2 = _pr_sql(teleport="topic_v", prefix="tp_")
    _, c3, l3 = _pr_sql(teleport="trust_v", prefix="tr_")
    hc, lh = hits_ctes("h_", "vertices", "edges", ROUNDS)
    body = " UNION ALL ".join([
        f"SELECT 'pagerank' AS algo, id, pr AS score FROM {l1}",
        f"SELECT 'topic_pagerank' AS algo, id, pr AS score FROM {l2}",
        f"SELECT 'trustrank' AS algo, id, pr AS score FROM {l3}",
        f"SELECT 'authority' AS algo, id, authority AS score FROM {lh}",
        f"SELECT 'hub' AS algo, id, hub AS score FROM {lh}",
    ])
    return with_clause(base + TOPIC_SQL + TRUST_SQL + c1 + c2 + c3 + hc) + f"""
SELECT algo, id, score, CAST(row_number() OVER (PARTITION BY algo ORDER BY score DESC, id) AS INTEGER) AS rank
FROM (SELECT algo, id, round(score, {DIGITS}) AS score FROM ({body}))"""


def ranked(scores):
    """Ranks per algorithm: ranges of (algo, score, id) are ranked apart, then shifted by the rows before them."""
    from pyspark.sql import Window as W
    order = [F.col("algo"), F.col("score").desc(), F.col("id")]
    dealt = write_table(scores.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()), "report")
    local = W.partitionBy("_p", "algo").orderBy(*order[1:])
    size = dealt.groupBy("_p", "algo").agg(F.count(F.lit(1)).alias("_n"))       # one row per partition and algorithm
    before = size.withColumn("_before", F.coalesce(F.sum("_n").over(
        W.partitionBy("algo").orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return dealt.withColumn("_r", F.row_number().over(local)).join(before, ["_p", "algo"]).select(
        "algo", "id", "score", (F.col("_r") + F.col("_before")).cast("int").alias("rank"))


@register("link_report", sql=_report_sql)
def q_link_report(spark, sf_dir):
    """One long table (algo, id, score, rank) of the five link scores."""
    v, e = _g(spark, sf_dir)
    pr = G.pageranks(v, e, {"pagerank": (D, None), "topic_pagerank": (D, G.topic_vector(v, _topic_ids(spark, sf_dir))),
                            "trustrank": (D, G.trust_vector(v, _trusted_ids(spark, sf_dir)))}, ROUNDS, tol=None)

    def long(df, *names):
        each = F.array(*[F.struct(F.lit(n).alias("algo"), F.col(n).alias("score")) for n in names])
        return df.select("id", F.explode(each).alias("r")).select("r.algo", "id", F.round("r.score", DIGITS).alias("score"))

    links = long(pr, "pagerank", "topic_pagerank", "trustrank")
    return ranked(links.unionByName(long(G.hits(v, e, ROUNDS, tol=None), "authority", "hub")))


def _convergence_sql():
    base, ctes, _ = _pr_sql()
    parts = [f"SELECT CAST({t} AS INTEGER) AS round, round(sum(abs(a.pr - b.pr)), {DIGITS}) AS l1_change "
             f"FROM p_r{t} a JOIN p_r{t - 1} b ON a.id = b.id" for t in range(1, ROUNDS + 1)]
    return with_clause(base + ctes) + "\nUNION ALL\n".join(parts)


@register("pagerank_convergence", sql=_convergence_sql)
def q_pagerank_convergence(spark, sf_dir):
    """The loop's convergence log (round, L1 change) with the stop test every round."""
    v, e = _g(spark, sf_dir)
    _, log = G.pagerank(v, e, D, ROUNDS, tol=1e-15, check_every=1, return_log=True)
    rows = [(int(r), float(d)) for r, d in log.history]
    return spark.createDataFrame(rows, "round int, l1_change double").withColumn("l1_change", F.round("l1_change", DIGITS))


TO_THE_END = 1e-6


@register("pagerank_converged")
def q_pagerank_converged(spark, sf_dir):
    """G1 run to its stop (L1 change below 1e-6): (id, pr, rounds, l1_change)."""
    v, e = _g(spark, sf_dir)
    pr, log = G.pagerank(v, e, D, 200, tol=TO_THE_END, return_log=True)
    return _round(pr, "pr").withColumn("rounds", F.lit(log.rounds)).withColumn("l1_change", F.lit(log.history[-1][1]))


@register("hits_converged")
def q_hits_converged(spark, sf_dir):
    """G10, both L2 changes below 1e-6: (id, authority, hub, rounds, l2_change)."""
    v, e = _g(spark, sf_dir)
    out, log = G.hits(v, e, 200, tol=TO_THE_END, norm_stop="l2", return_log=True)
    return _round(out, "authority", "hub").withColumn("rounds", F.lit(log.rounds)).withColumn("l2_change", F.lit(log.history[-1][1]))


@register("adjacency_edges", sql=with_clause(BASE) + "SELECT src, dst FROM edges")
def q_adjacency_edges(spark, sf_dir):
    """The graph as one row per vertex with its out-links, read back as edges."""
    v, e = _g(spark, sf_dir)
    lists = v.distinct().join(e.groupBy(F.col("src").alias("id")).agg(F.collect_list("dst").alias("links")), "id", "left")
    return G.adjacency_to_tables(lists)[1]
