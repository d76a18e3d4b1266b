"""Recommenders over a long ratings table ``(user_id, item_id, score)``.

No user x item matrix is ever built: similarities come from the sparse
co-rating self-join (skew-safe, see ``pairs.group_pairs``), predictions from
joins of similarity rows with rating rows, and dense-matrix quirks of the
reference (e.g. the "-mean" fill of unrated cells) are rewritten as closed
forms over per-user sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.functions.text import md5_bucket
from quarry.session import write_table
from quarry.functions.vectors import cosine
from quarry.operators.pairs import group_pairs, partner_rows
from quarry.operators.products import weighted_means

U, I, R = "user_id", "item_id", "score"


# ---------------------------------------------------------------- profile

def counts_by(ratings: DataFrame, key: str) -> DataFrame:
    """(key, n) value counts."""
    return ratings.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def quantiles(df: DataFrame, col: str, shares: dict[str, float]) -> DataFrame:
    """One row of quantiles with linear interpolation, by the positions of the sorted values; null without values.

    Values are counted, range-partitioned and numbered by running counts per
    partition, so no task holds all distinct values.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    dealt = write_table(counts.repartitionByRange("_v").withColumn("_p", F.spark_partition_id()), "value-counts")
    before = dealt.groupBy("_p").agg(F.sum("_c").alias("_s")).select("_p", F.coalesce(F.sum("_s").over(
        W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))  # one row per partition
    upto = F.sum("_c").over(W.partitionBy("_p").orderBy("_v").rowsBetween(W.unboundedPreceding, 0))
    total = dealt.agg(F.sum("_c").alias("_n"))
    placed = (dealt.withColumn("_upto", upto).join(F.broadcast(before), "_p").crossJoin(F.broadcast(total))  # one row
              .withColumn("_upto", F.col("_upto") + F.col("_before")))
    out, aggs = [], []
    for name, share in shares.items():
        place = (F.col("_n") - 1) * F.lit(share)
        aggs += [F.min(F.when(F.col("_upto") > F.floor(place), F.col("_v"))).alias(f"_lo_{name}"),
                 F.min(F.when(F.col("_upto") > F.ceil(place), F.col("_v"))).alias(f"_hi_{name}"),
                 F.max(place - F.floor(place)).alias(f"_at_{name}")]
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        out.append((low + (high - low) * F.col(f"_at_{name}")).cast("double").alias(name))
    return placed.agg(*aggs).select(*out)


def describe(ratings: DataFrame, col: str = R) -> DataFrame:
    """Count, mean, sample std, min, quartiles (linear interpolation), max."""
    c = F.col(col)
    base = ratings.agg(F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
                       F.min(c).alias("min"), F.max(c).alias("max"))
    return base.crossJoin(quantiles(ratings, col, {"q25": 0.25, "q50": 0.5, "q75": 0.75})).select(  # one row each
        "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def user_means(ratings: DataFrame) -> DataFrame:
    """Per-user mean of the non-zero scores (0 means "not rated")."""
    return ratings.groupBy(U).agg(
        F.count(F.when(F.col(R) != 0, F.lit(1))).alias("n"),
        F.avg(F.when(F.col(R) != 0, F.col(R))).alias("mean"))


def rating_profile(ratings: DataFrame) -> DataFrame:
    """H1: one row -- ratings, users, items, ratings per user and per item, mean of user means."""
    base = ratings.agg(F.count(F.lit(1)).alias("n_ratings"), F.countDistinct(U).alias("n_users"),
                       F.countDistinct(I).alias("n_items"))
    mm = user_means(ratings).agg(F.avg("mean").alias("mean_of_user_means"))
    return base.crossJoin(mm).select(
        "n_ratings", "n_users", "n_items",
        (F.col("n_ratings") / F.col("n_users")).alias("ratings_per_user"),
        (F.col("n_ratings") / F.col("n_items")).alias("ratings_per_item"), "mean_of_user_means")


def coverage_profile(train: DataFrame, test: DataFrame, sparse_threshold: int = 5) -> DataFrame:
    """H1: test users/items unseen in train, or seen fewer than ``sparse_threshold`` times."""
    out = None
    for key, kind in ((U, "user"), (I, "item")):
        tr = counts_by(train, key)
        te = test.select(key).distinct()
        unseen = te.join(tr, key, "left_anti").agg(F.count(F.lit(1)).alias("n_unseen"))           # B6
        sparse = (te.join(tr.where(F.col("n") < sparse_threshold), key, "left_semi")              # B7
                  .agg(F.count(F.lit(1)).alias("n_sparse")))
        tot = te.agg(F.count(F.lit(1)).alias("n_test"))
        row = (tot.crossJoin(unseen).crossJoin(sparse)
               .select(F.lit(kind).alias("kind"), "n_test", "n_unseen", "n_sparse",
                       (F.col("n_unseen") / F.col("n_test") * 100).alias("pct_unseen"),               # B20
                       (F.col("n_sparse") / F.col("n_test") * 100).alias("pct_sparse")))
        out = row if out is None else out.unionByName(row)
    return out


def cold_start_keys(train: DataFrame, test: DataFrame) -> DataFrame:
    """(kind, id) for test users / items that never occur in train."""
    u = test.select(U).distinct().join(train.select(U), U, "left_anti").select(F.lit("user").alias("kind"), F.col(U).alias("id"))
    i = test.select(I).distinct().join(train.select(I), I, "left_anti").select(F.lit("item").alias("kind"), F.col(I).alias("id"))
    return u.unionByName(i)


# ---------------------------------------------------------------- splits

def split_random(ratings: DataFrame, train_buckets: int = 8, seed: str = "") -> DataFrame:
    """Stable 80/20 split by md5 of 'user|item' (same bucket in DuckDB)."""
    return ratings.withColumn("is_train", md5_bucket(U, I, modulus=10, seed=seed) < train_buckets)


def split_stratified(ratings: DataFrame, train_frac: float = 0.8) -> DataFrame:
    """Per user, the first floor(frac*n) rows in md5 order are train (at least one)."""
    w = W.partitionBy(U).orderBy(F.md5(F.concat_ws("|", F.col(U), F.col(I))), I)
    n = F.count(F.lit(1)).over(W.partitionBy(U))
    return (ratings.withColumn("_rn", F.row_number().over(w)).withColumn("_n", n)
            .withColumn("is_train", F.col("_rn") <= F.greatest(F.lit(1), F.floor(F.col("_n") * train_frac)))
            .drop("_rn", "_n"))


def split_by_user(ratings: DataFrame, train_buckets: int = 8) -> DataFrame:
    """Whole users go to train or test by md5 of the user id."""
    return ratings.withColumn("is_train", md5_bucket(U, modulus=10) < train_buckets)


def shuffled(df: DataFrame, key: str, seed: str = "42") -> DataFrame:
    """A global shuffle as a stable md5 order (range-partitioned sort, no single task)."""
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string"))), key)


def latest_ratings(events: DataFrame, seq_col: str = "seq") -> DataFrame:
    """Last write wins per (user, item) by load sequence."""
    return events.groupBy(U, I).agg(F.max_by(R, seq_col).alias(R))


def pivot_mean(df: DataFrame, key: str, column: str, value: str, digits: int = 9) -> DataFrame:
    """One column per value of ``column`` found in the data (Spark refuses more than 10,000), means, 0 = none."""
    wide = df.groupBy(key).pivot(column).agg(F.avg(value))
    names = [c for c in wide.columns if c != key]
    return wide.select(key, *[F.round(F.coalesce(F.col(f"`{c}`"), F.lit(0.0)), digits).alias(c) for c in names])


def dense_ids(ids: DataFrame, col: str, out_col: str = "idx") -> DataFrame:
    """Dense 0-based index in id order without a single-partition window.

    Range-partition and sort the distinct ids, number rows inside each
    partition, and add the partition's offset (a cumulative count over a table
    with one row per partition, which is small by construction).
    """
    d = ids.select(col).distinct().repartitionByRange(col).sortWithinPartitions(col)
    d = write_table(d.withColumn("_p", F.spark_partition_id()), "dense-ids")  # partition numbers are fixed once
    d = d.withColumn("_local", F.row_number().over(W.partitionBy("_p").orderBy(col)))
    sizes = d.groupBy("_p").agg(F.count(F.lit(1)).alias("_c"))
    offs = sizes.withColumn("_off", F.sum("_c").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)))
    offs = offs.select("_p", F.coalesce("_off", F.lit(0)).alias("_off"))
    return (d.join(F.broadcast(offs), "_p")   # one row per partition
            .select(col, (F.col("_off") + F.col("_local") - 1).alias(out_col)))


def raw_ids(rows: DataFrame, ids: DataFrame, col: str, idx_col: str) -> DataFrame:
    """``rows`` with the id ``col`` in place of its index ``idx_col``, by a map of :func:`dense_ids`.

    Rows with an unknown or null index keep a null id; no row is lost or repeated.
    """
    named = ids.select(F.col(col).alias("_raw"), F.col("idx").alias("_idx"))
    found = rows.join(named, F.col(idx_col) == F.col("_idx"), "left").withColumn(col, F.col("_raw"))
    return found.drop("_raw", "_idx", idx_col)


def topk_per_key(df: DataFrame, key: str, score: str, tie: str, k: int) -> DataFrame:
    """Top-k rows per key by (score desc, tie asc)."""
    w = W.partitionBy(key).orderBy(F.col(score).desc(), F.col(tie).asc())
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


# ---------------------------------------------------------------- similarity

def co_rated(ratings: DataFrame, by: str = I, who: str = U, block_rows: int = 4096) -> DataFrame:
    """For every pair (a < b) of ``who`` sharing a ``by`` value: the pair's scores on it."""
    return group_pairs(ratings.select(by, who, R), [by], who, [R], block_rows=block_rows)


def cosine_similarity(ratings: DataFrame, who: str = U, by: str = I, both: bool = False) -> DataFrame:
    """H2: co-rated cosine (norms over the common keys only), for pairs with >= 1 common key.

    Returns (a, b, n_common, sim) with a < b; pairs sharing nothing have similarity 0.
    ``both``: each pair in either order, with all rows of an a in one task.
    """
    p = partner_rows(ratings, by, who, [R], both)
    agg = p.groupBy(f"{who}_a", f"{who}_b").agg(
        F.count(F.lit(1)).alias("n_common"),
        F.sum(F.col(f"{R}_a") * F.col(f"{R}_b")).alias("_dot"),
        F.sum(F.col(f"{R}_a") * F.col(f"{R}_a")).alias("_qa"),
        F.sum(F.col(f"{R}_b") * F.col(f"{R}_b")).alias("_qb"))
    return agg.select(f"{who}_a", f"{who}_b", "n_common",
                      cosine(F.col("_dot"), F.sqrt("_qa"), F.sqrt("_qb")).alias("sim"))


def both_directions(sim: DataFrame, who: str) -> DataFrame:
    a, b = f"{who}_a", f"{who}_b"
    return (sim.select(F.col(a).alias("x"), F.col(b).alias("y"), "sim")
            .unionByName(sim.select(F.col(b).alias("x"), F.col(a).alias("y"), "sim")))


# ---------------------------------------------------------------- CF recommendations (H3)

def _links(ratings: DataFrame, sim: DataFrame | None, who: str, by: str) -> tuple[DataFrame, float]:
    """(x, y, sim) of neighbours with sim > 0, in either order, and about how many they are (co-ratings, if not given)."""
    if sim is not None:
        return both_directions(sim, who).where(F.col("sim") > 0), 2.0 * sim.count()
    n = F.count(F.lit(1)).cast("double")
    met = ratings.groupBy(by).agg((n * (n - 1)).alias("_c")).agg(F.sum("_c")).first()[0] or 0.0
    near = cosine_similarity(ratings, who, by, both=True).where(F.col("sim") > 0)
    return near.select(F.col(f"{who}_a").alias("x"), F.col(f"{who}_b").alias("y"), "sim"), met


def _best(ratings: DataFrame, rows: DataFrame, table: DataFrame, by_row: bool, sizes: tuple[float, float], n: int,
          digits: int | None) -> DataFrame:
    found = weighted_means(rows, table, ratings.select(F.col(U).alias("u"), F.col(I).alias("i")), n, by_row, sizes, digits)
    pred = F.round("mean", digits) if digits is not None else F.col("mean")
    return topk_per_key(found.select(F.col("u").alias(U), F.col("i").alias(I), pred.alias("pred")), U, "pred", I, n)


def user_based(ratings: DataFrame, n: int = 5, user_sim: DataFrame | None = None,
               digits: int | None = None) -> DataFrame:
    """H3: for every user, top-n unrated items by sum(sim*r)/sum(sim) over users with sim > 0."""
    ratings = write_table(ratings.select(U, I, R), "ratings")
    near, size = _links(ratings, user_sim, U, I)
    rows = near.select(F.col("x").alias("u"), F.col("y").alias("k"), F.col("sim").alias("w"))
    table = ratings.select(F.col(U).alias("k"), F.col(I).alias("i"), F.col(R).alias("t"))
    return _best(ratings, rows, table, True, (size, ratings.count()), n, digits)


def item_based(ratings: DataFrame, n: int = 5, item_sim: DataFrame | None = None,
               digits: int | None = None) -> DataFrame:
    """H3: for every user, top-n unrated items by sum(sim*r_uj)/sum(sim) over rated j with sim > 0."""
    ratings = write_table(ratings.select(U, I, R), "ratings")
    near, size = _links(ratings, item_sim, I, U)
    rows = ratings.select(F.col(U).alias("u"), F.col(I).alias("k"), F.col(R).alias("w"))
    table = near.select(F.col("x").alias("k"), F.col("y").alias("i"), F.col("sim").alias("t"))
    return _best(ratings, rows, table, False, (ratings.count(), size), n, digits)


def hybrid(user_recs: DataFrame, item_recs: DataFrame, alpha: float = 0.5, n: int = 5,
           digits: int | None = None) -> DataFrame:
    """H3: each side's top-n first; alpha*user + (1-alpha)*item with a missing side = 0; top-n."""
    a = user_recs.select(U, I, F.col("pred").alias("_pu"))
    b = item_recs.select(U, I, F.col("pred").alias("_pi"))
    j = a.join(b, [U, I], "full_outer")
    p = F.lit(alpha) * F.coalesce("_pu", F.lit(0.0)) + F.lit(1 - alpha) * F.coalesce("_pi", F.lit(0.0))
    s = j.select(U, I, (F.round(p, digits) if digits is not None else p).alias("pred"))
    return topk_per_key(s, U, "pred", I, n)


# ---------------------------------------------------------------- baselines

def bias_model(train: DataFrame, reg_item: float = 0.0, reg_user: float = 0.0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """H7 baseline: mu, b_i = sum(r-mu)/(reg_i+n_i), b_u = sum(r-mu-b_i)/(reg_u+n_u).

    Returns (mu one-row table, item biases, user biases).
    """
    mu = train.agg(F.avg(R).alias("mu"))
    t = train.crossJoin(F.broadcast(mu))  # one-row scalar
    bi = t.groupBy(I).agg((F.sum(F.col(R) - F.col("mu")) / (F.lit(reg_item) + F.count(F.lit(1)))).alias("b_i"))
    bu = (t.join(bi, I).groupBy(U)
          .agg((F.sum(F.col(R) - F.col("mu") - F.col("b_i")) / (F.lit(reg_user) + F.count(F.lit(1)))).alias("b_u")))
    return mu, bi, bu


def fallback_scores(pairs: DataFrame, mu: DataFrame, item_bias: DataFrame, user_bias: DataFrame,
                    interaction: DataFrame | None = None) -> DataFrame:
    """Both known -> mu+b_u+b_i(+p.q); user only -> mu+b_u; item only -> mu+b_i; none -> mu."""
    j = (pairs.select(U, I).join(user_bias, U, "left").join(item_bias, I, "left")
         .crossJoin(F.broadcast(mu)))
    if interaction is not None:
        j = j.join(interaction.select(U, I, F.col("dot").alias("_pq")), [U, I], "left")
        pq = F.coalesce("_pq", F.lit(0.0))
    else:
        pq = F.lit(0.0)
    bu, bi = F.col("b_u"), F.col("b_i")
    tier = (F.when(bu.isNotNull() & bi.isNotNull(), F.lit("both")).when(bu.isNotNull(), F.lit("user"))
            .when(bi.isNotNull(), F.lit("item")).otherwise(F.lit("none")))
    pred = (F.when(bu.isNotNull() & bi.isNotNull(), F.col("mu") + bu + bi + pq)
            .when(bu.isNotNull(), F.col("mu") + bu).when(bi.isNotNull(), F.col("mu") + bi)
            .otherwise(F.col("mu")))
    return j.select(U, I, tier.alias("tier"), pred.alias("pred"))


def zscore_ratings(ratings: DataFrame) -> DataFrame:
    """H9: z = (r - mean)/sample std over all rows; (user_id, item_id, score, z)."""
    st = ratings.agg(F.avg(R).alias("_m"), F.stddev_samp(R).alias("_s"))
    return ratings.crossJoin(F.broadcast(st)).select(U, I, R, ((F.col(R) - F.col("_m")) / F.col("_s")).alias("z"))


# ---------------------------------------------------------------- evaluation

def rmse(pred: DataFrame, truth: DataFrame, pred_col: str = "pred") -> DataFrame:
    """(n, mse, rmse) of predictions against truth on (user, item)."""
    j = pred.select(U, I, pred_col).join(truth.select(U, I, R), [U, I])
    e = F.pow(F.col(R) - F.col(pred_col), 2)
    return j.agg(F.count(F.lit(1)).alias("n"), F.avg(e).alias("mse"), F.sqrt(F.avg(e)).alias("rmse"))
