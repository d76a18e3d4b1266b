"""Neighbour and factor models over ratings ``(user_id, item_id, score)``.

Neighbours come from the sparse co-rated pairs only.  Users who share nothing have similarity 0
and add nothing to a prediction, so they take part as a count that shifts the rank of
negative neighbours.  Factors are fitted by MLlib's ALS on dense ids, which has at most 2^31 users or items.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.functions.scalar import softmax
from quarry.functions.text import md5_32
from quarry.operators.pairs import partner_rows
from quarry.operators.recsys import I, R, U, bias_model, dense_ids, fallback_scores
from quarry.session import write_table


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def seeded_arrays(nodes: DataFrame, dim: int, scale: float = 0.2, seed: int = 42) -> DataFrame:
    """(node, val): given factors as arrays, the same numbers as ``gcn.seeded_embeddings``."""
    def one(f: int) -> Column:
        key = F.concat_ws("|", F.lit(str(seed)), F.col("node"), F.lit(str(f)))
        return (md5_32(key) / F.lit(4294967296.0) - F.lit(0.5)) * F.lit(scale)
    return nodes.select("node", F.array(*[one(f) for f in range(dim)]).alias("val"))


# ---------------------------------------------------------------- neighbours (H4-H6)

def centred(train: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Scores less the user's mean, and the means (user_id, mean)."""
    means = train.groupBy(U).agg(F.avg(R).alias("mean"))
    return train.join(means, U).select(U, I, (F.col(R) - F.col("mean")).alias(R)), means


def neighbours(train: DataFrame, most: int, digits: int = 9) -> DataFrame:
    """H4: (x, y, sim, rank) with rank <= ``most`` among *all* users by (sim desc, id); similarities of 0 are left out.

    The cosine is that of the scores less the user's mean, with unrated cells at the mean.
    """
    rows, means = centred(train)
    norms = rows.groupBy(U).agg(F.sqrt(F.sum(F.col(R) * F.col(R))).alias("_n")).where("_n > 0")
    unit = rows.join(norms, U).select(U, I, (F.col(R) / F.col("_n")).alias(R))
    sim = (partner_rows(unit, I, U, [R], both=True).groupBy(F.col(f"{U}_a").alias("x"), F.col(f"{U}_b").alias("y"))
           .agg(F.round(F.sum(F.col(f"{R}_a") * F.col(f"{R}_b")), digits).alias("sim")).where("sim <> 0"))
    of_x = W.partitionBy("x")
    users = means.agg(F.count(F.lit(1)).alias("_users"))
    place = F.row_number().over(of_x.orderBy(F.col("sim").desc(), "y"))
    zeros = F.col("_users") - 1 - F.col("_linked")
    return (sim.withColumn("_place", place).withColumn("_linked", F.count(F.lit(1)).over(of_x))
            .where(F.col("_place") <= most).crossJoin(F.broadcast(users))  # one row
            .select("x", "y", "sim", (F.col("_place") + F.when(F.col("sim") < 0, zeros).otherwise(0)).cast("int").alias("rank"))
            .where(F.col("rank") <= most))


def _first_by_base(stats: DataFrame, most: int, slack: float) -> DataFrame:
    """(n, y): for each number n of ratings that a user has, the users with the largest base for such a user.

    The base of x and y is a_x times (g_y - n_x a_y), so its order depends on n_x alone.
    Tasks keep the first ``most`` and those within ``slack`` of them, for each n; these are merged.
    """
    counts = np.array([r[0] for r in stats.select("n").distinct().orderBy("n").collect()], np.float64)    # at most as many as items

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, a, g = batch.column(0), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for n in counts if len(a) else ():
                f = g - n * a
                least = np.partition(f, len(f) - most)[len(f) - most] - slack if len(f) > most else -np.inf
                at = np.flatnonzero(f >= least)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), int(n))), y.take(pa.array(at)), pa.array(f[at])],
                                                 names=["n", "y", "f"])

    kind = stats.schema[U].dataType.simpleString()
    found = stats.select(U, "a", "g").mapInArrow(run, f"n long, y {kind}, f double")
    ranked = found.withColumn("_r", F.row_number().over(W.partitionBy("n").orderBy(F.desc("f"), "y")))
    last = ranked.where(F.col("_r") == most).select("n", F.col("f").alias("_least"))
    return ranked.join(last, "n", "left").where((F.col("_r") <= most) | (F.col("f") >= F.col("_least") - slack)).select("n", "y")


def neighbours_filled(train: DataFrame, most: int, digits: int = 9) -> DataFrame:
    """H4 with unrated cells at 0 before centring: (x, y, sim, rank) with rank <= ``most``, ties by id.

    An unrated cell is then minus the user's mean, so every pair of users has a similarity: a base from
    terms of each user alone, and the co-rated products, which only add to it (scores are positive; 0 is unrated).
    So the first ``most`` are among the co-rated users and the first ``most`` by base alone, and co-rated
    users below the last of these by base are dropped before they are ranked.
    """
    rated = train.where(F.col(R) > 0)
    size = rated.agg(F.count_distinct(I).alias("_items"))
    stats = (rated.groupBy(U).agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum(R).alias("t"), F.sum(F.col(R) * F.col(R)).alias("q"))
             .withColumn("m", F.col("t") / F.col("n")).crossJoin(F.broadcast(size)))  # one row

    def norm_of(q: Column, m: Column, n: Column, items: Column) -> Column:
        return F.sqrt(q + m * m * (items - 2 * n))

    stats = write_table(stats.withColumn("norm", norm_of(*map(F.col, ("q", "m", "n", "_items")))).where("norm > 0").withColumn("a", F.col("m") / F.col("norm"))
                        .withColumn("g", F.col("a") * (F.col("_items") - F.col("n"))), "user-stats")
    least = stats.agg(F.min("a")).first()[0]
    if least is None:
        kind = train.schema[U].dataType.simpleString()
        return train.sparkSession.createDataFrame([], f"x {kind}, y {kind}, sim double, rank int")
    slack = 10.0 ** (1 - digits) / least           # what rounds to the same similarity counts as a tie
    left = stats.select(F.col(U).alias("x"), *[F.col(c).alias(f"{c}x") for c in ("n", "m", "norm", "_items")])
    right = stats.select(F.col(U).alias("y"), F.col("n").alias("ny"), F.col("m").alias("my"), F.col("norm").alias("normy"))

    base = F.col("mx") * F.col("my") * (F.col("_itemsx") - F.col("nx") - F.col("ny"))
    sim = F.round((F.col("dot") + base) / (F.col("normx") * F.col("normy")), digits)

    lists = _first_by_base(stats, most + 1, slack)
    own = stats.select(F.col(U).alias("x"), F.col("n").cast("long").alias("n"))
    free = (own.join(lists, "n").where("x <> y").select("x", "y", F.lit(0.0).alias("dot"))
            .join(left, "x").join(right, "y").select("x", "y", sim.alias("sim")))
    place = F.row_number().over(W.partitionBy("x").orderBy(F.col("sim").desc(), "y"))
    floor = write_table(free, "base-neighbours")
    last = floor.withColumn("_r", place).where(F.col("_r") == most).select("x", F.col("sim").alias("_least"))
    # A user's terms and the last place's similarity travel with its scores: a pair is rated, and dropped, where its products are added up.
    held = rated.join(stats.select(U, "n", "t", "q", "_items"), U).join(
        last.select(F.col("x").alias(U), "_least"), U, "left").withColumn("_least", F.coalesce("_least", F.lit(float("-inf"))))
    items = int(stats.agg(F.max("_items")).first()[0])
    terms = ["n", "t", "q", "_least"]
    dots = (partner_rows(held, I, U, [R, *terms]).groupBy(F.col(f"{U}_a").alias("x"), F.col(f"{U}_b").alias("y"))
            .agg(F.sum(F.col(f"{R}_a") * F.col(f"{R}_b")).alias("dot"), *[F.first(f"{c}_{s}").alias(f"{c}{t}") for c in terms for s, t in ("ax", "by")])
            .withColumn("_itemsx", F.lit(items)))
    for s in "xy":
        dots = dots.withColumn(f"m{s}", F.col(f"t{s}") / F.col(f"n{s}"))
        dots = dots.withColumn(f"norm{s}", norm_of(*[F.col(f"{c}{s}") for c in "qmn"], F.lit(items)))
    met = dots.select("x", "y", sim.alias("sim"), "_leastx", "_leasty")
    ways = [F.when(F.col("sim") >= F.col(f"_least{s}"), F.struct(F.col(s).alias("x"), F.col(t).alias("y"), "sim")) for s, t in ("xy", "yx")]
    met = met.select(F.explode(F.array_compact(F.array(*ways))).alias("r")).select("r.*")
    both = floor.unionByName(met).groupBy("x", "y").agg(F.max("sim").alias("sim"))
    return both.withColumn("rank", place.cast("int")).where(F.col("rank") <= most)


def knn_scores(train: DataFrame, pairs: DataFrame, ks: tuple[int, ...], near: DataFrame | None = None) -> DataFrame:
    """H5: (user_id, item_id, pred_<k> ...), for every k of ``ks`` in one pass over the neighbours.

    ``near`` are the neighbours to use, by default those of :func:`neighbours`.

    The k nearest users are taken first and of these the ones that rated the
    item.  No such user, or an unseen item: the user's mean; an unseen user: the mean of the users' means.
    """
    rows, means = centred(train)
    near = neighbours(train, max(ks)) if near is None else near
    theirs = rows.select(F.col(U).alias("y"), I, F.col(R).alias("_dev"))
    hit = pairs.select(U, I).distinct().join(near.withColumnRenamed("x", U), U).join(theirs, ["y", I])
    sums = []
    for k in ks:
        within = F.col("rank") <= k
        sums += [F.sum(F.when(within, F.col("sim") * F.col("_dev"))).alias(f"_num{k}"),
                 F.sum(F.when(within, F.abs("sim"))).alias(f"_den{k}")]
    base = (pairs.select(U, I).join(means, U, "left").join(hit.groupBy(U, I).agg(*sums), [U, I], "left")
            .crossJoin(F.broadcast(means.agg(F.avg("mean").alias("_all")))))  # one row
    moved = {k: F.when(F.col(f"_den{k}") > 0, F.col(f"_num{k}") / F.col(f"_den{k}")).otherwise(0.0) for k in ks}
    return base.select(U, I, *[F.coalesce(F.col("mean") + moved[k], "_all").alias(f"pred_{k}") for k in ks])


def knn_errors(train: DataFrame, valid: DataFrame, ks: tuple[int, ...], near: DataFrame | None = None) -> DataFrame:
    """H6: (k, n, rmse), one row per k."""
    scored = knn_scores(train, valid, ks, near).join(valid.select(U, I, R), [U, I])
    wide = scored.agg(F.count(F.lit(1)).alias("n"), *[
        F.sqrt(F.avg(F.pow(F.col(R) - F.col(f"pred_{k}"), 2))).alias(f"e{k}") for k in ks])
    each = F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"e{k}").alias("rmse")) for k in ks])
    return wide.select("n", F.explode(each).alias("e")).select("e.k", "n", "e.rmse")


# ---------------------------------------------------------------- factors by ALS

def als_dots(train: DataFrame, pairs: DataFrame, value: str, rank: int, reg: float, rounds: int = 10,
             seed: int = 42) -> DataFrame:
    """(user_id, item_id, dot) for the pairs whose user and item are known; factors fitted to ``value``."""
    users, items = dense_ids(train, U, "_u"), dense_ids(train, I, "_i")
    known = train.join(users, U).join(items, I).select(
        F.col("_u").cast("int").alias("_u"), F.col("_i").cast("int").alias("_i"), F.col(value).cast("float").alias("_v"))
    model = ALS(userCol="_u", itemCol="_i", ratingCol="_v", rank=rank, regParam=reg, maxIter=rounds, seed=seed).fit(
        write_table(known, "als-ratings"))
    left = users.join(model.userFactors.select(F.col("id").alias("_u"), F.col("features").alias("_p")), "_u")
    right = items.join(model.itemFactors.select(F.col("id").alias("_i"), F.col("features").alias("_q")), "_i")
    return (pairs.select(U, I).distinct().join(left.select(U, "_p"), U).join(right.select(I, "_q"), I)
            .select(U, I, dot(F.col("_p"), F.col("_q")).alias("dot")))


def mf_scores(train: DataFrame, pairs: DataFrame, rank: int = 20, reg: float = 0.02, bias_reg: float = 5.0) -> DataFrame:
    """H7: mean and biases, plus factors fitted to what they leave; unknown keys by the tiers of H8."""
    mu, bi, bu = bias_model(train, bias_reg, bias_reg)
    rest = (train.join(bi, I).join(bu, U).crossJoin(F.broadcast(mu))  # one row
            .select(U, I, (F.col(R) - F.col("mu") - F.col("b_u") - F.col("b_i")).alias("rest")))
    return fallback_scores(pairs, mu, bi, bu, als_dots(rest, pairs, "rest", rank, reg))


def zscore_mf_scores(train: DataFrame, pairs: DataFrame, rank: int = 20, reg: float = 0.02) -> DataFrame:
    """H9: factors fitted to z-scores, scaled back; unknown keys get the mean."""
    stat = train.agg(F.avg(R).alias("_m"), F.stddev_samp(R).alias("_s"))
    z = train.crossJoin(F.broadcast(stat)).select(U, I, ((F.col(R) - F.col("_m")) / F.col("_s")).alias("z"))  # one row
    known = als_dots(z, pairs, "z", rank, reg)
    return (pairs.select(U, I).join(known, [U, I], "left").crossJoin(F.broadcast(stat))
            .select(U, I, (F.col("_m") + F.coalesce("dot", F.lit(0.0)) * F.col("_s")).alias("pred")))


def pmf_scores(train: DataFrame, pairs: DataFrame, rank: int = 32, reg: float = 0.05) -> DataFrame:
    """Factors alone; unknown keys get the mean."""
    mu = train.agg(F.avg(R).alias("mu"))
    known = als_dots(train, pairs, R, rank, reg)
    return (pairs.select(U, I).join(known, [U, I], "left").crossJoin(F.broadcast(mu))  # one row
            .select(U, I, F.coalesce("dot", "mu").alias("pred")))


# ---------------------------------------------------------------- given factors

def implicit_sums(ratings: DataFrame, factors: DataFrame, dim: int) -> DataFrame:
    """(user_id, implicit): sum of the factors (item_id, val) of the user's items over the root of their number."""
    sums = F.array(*[F.sum(F.col("val")[f]) / F.sqrt(F.count(F.lit(1))) for f in range(dim)])
    return ratings.select(U, I).join(factors, I).groupBy(U).agg(sums.alias("implicit"))


def attention_merge(layers: DataFrame, weights: list[list[float]]) -> DataFrame:
    """(node, val): layers l0, l1, ... of a node weighted by the softmax of ``weights`` times all layers in a row."""
    names = [f"l{k}" for k in range(len(weights))]
    row = F.concat(*names)
    logits = F.array(*[dot(row, F.array(*[F.lit(float(x)) for x in w])) for w in weights])
    held = layers.withColumn("_a", softmax(logits))
    merged = None
    for k, name in enumerate(names):
        share = F.col("_a")[k]
        part = F.transform(name, lambda x: x * share)  # noqa: B023 (called at once)
        merged = part if merged is None else F.zip_with(merged, part, lambda x, y: x + y)
    return held.select("node", merged.alias("val"))
