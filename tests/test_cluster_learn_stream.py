import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import cluster as C
from quarry.operators import learn as L
from quarry.session import delete_path, drop_table, path_exists, scratch_path, write_bucketed
from quarry.streaming import operators as S


def blobs(spark, n=60, seed=3):
    rs = np.random.RandomState(seed)
    centers = np.array([[0, 0], [10, 10], [0, 10]])
    rows = [(i, (centers[i % 3] + rs.randn(2) * .5).tolist(), float(i % 3 == 1)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, x array<double>, y double")


def test_kmeans_matches_numpy_lloyd_and_cost_never_rises(spark):
    pts = blobs(spark)
    init = C.init_centers(pts, 3)
    labels, cents, _ = C.kmeans(pts.select("id", "x"), 3, 10, tol=None)
    X = np.array([r.x for r in pts.orderBy("id").collect()])
    c = np.array(init)
    for _ in range(10):
        lab = ((X[:, None, :] - c[None]) ** 2).sum(-1).argmin(1)
        c = np.array([X[lab == j].mean(0) if (lab == j).any() else c[j] for j in range(3)])
    lab = ((X[:, None, :] - c[None]) ** 2).sum(-1).argmin(1)
    got = [r.cluster for r in labels.orderBy("id").collect()]
    assert got == lab.tolist()
    assert np.allclose(np.array(cents), c)
    costs = []
    cur = init
    for _ in range(4):
        costs.append(C.assign_np(pts, cur).agg(F.sum(F.col("dist") ** 2)).first()[0])
        cur = C._update(pts.select("id", "x"), cur, "x", "keep")
    assert all(b <= a + 1e-9 for a, b in zip(costs, costs[1:]))


def test_bfr_and_cure(spark):
    pts = blobs(spark, 90)
    out, summ = C.bfr(pts.select("id", "x"), 3, threshold=3.0, chunks=3)
    assert out.count() == 90
    assert sum(v[0] for v in summ.values()) == out.where("cluster >= 0").count()
    labels, reps = C.cure(pts.select("id", "x"), 3, r=3, alpha=.2, sample_size=45)
    assert labels.count() == 90 and all(1 <= len(v) <= 3 for v in reps.values())


def test_perceptron_and_mlp(spark):
    df = blobs(spark, 90).withColumn("y", (F.col("id") % 3 == 1).cast("double"))
    w = L.perceptron_fit(df.coalesce(1), epochs=10)
    acc = L.accuracy(L.perceptron_predict(df, w)).first()[0]
    assert acc >= .95
    p = L.mlp_init(2, 5, 42)
    got = [r.p for r in df.orderBy("id").select(L.mlp_forward_expr("x", p).alias("p")).collect()]
    X = np.array([r.x for r in df.orderBy("id").collect()])
    a1 = 1 / (1 + np.exp(-(X @ p["W1"] + p["b1"])))
    want = (1 / (1 + np.exp(-(a1 @ p["W2"] + p["b2"])))).ravel()
    assert got == pytest.approx(want.tolist(), abs=1e-12)


def test_reservoir_stream_equals_batch(spark):
    df = spark.range(1, 101).withColumnRenamed("id", "v")
    batch = sorted(r.v for r in S.reservoir_sample(df, 5, ["v"]).collect())
    assert len(batch) == 5 and len(set(batch)) == 5
    assert S.reservoir_sample(df.limit(3), 5, ["v"]).count() == 3
    src = S.split_into_files(df, 4, spark, "res-src")
    stream = spark.readStream.schema("v long").option("maxFilesPerTrigger", 1).parquet(src)
    from quarry.session import scratch_path
    state = scratch_path(spark, "res-state")
    S.reservoir_stream(stream, 5, ["v"], state, scratch_path(spark, "res-ckpt")).awaitTermination()
    assert sorted(r.v for r in S.latest_version(spark, state).collect()) == batch


def test_mlp_early_stopping_keeps_best(spark):
    df = blobs(spark, 60).withColumn("y", (F.col("id") % 3 == 1).cast("double"))
    log = []
    p = L.mlp_fit(df, 3, lr=0.5, epochs=6, valid=df, patience=2, log=log)
    assert set(p) == {"W1", "b1", "W2", "b2"} and 1 <= len(log) <= 6
    best = min(v for _, v in log)
    got = L.bce(df.select("y", L.mlp_forward_expr("x", p).alias("p"))).first()[0]
    assert got == pytest.approx(best, abs=1e-12)


def test_streams_keep_their_state_over_empty_batches(spark):
    """Batches of 40, 0 and 40 rows: the third finds the first one's summaries and sample."""
    from quarry.session import scratch_path
    pts = blobs(spark, 80).select("id", "x")
    parts = [pts.where("id < 40"), pts.where("id < 0"), pts.where("id >= 40")]

    class Stream:
        schema = pts.schema

        @property
        def writeStream(self):
            return self

        def foreachBatch(self, f):
            for k, part in enumerate(parts):
                f(part, k)
            return self

        def option(self, *a):
            return self

        def trigger(self, **k):
            return self

        def start(self):
            return self

    state = scratch_path(spark, "bfr-state")
    S.bfr_stream(Stream(), 3, state, scratch_path(spark, "bfr-out"), "", threshold=100.0)
    assert S.latest_version(spark, state).agg(F.sum("n")).first()[0] == 80
    sample = scratch_path(spark, "res-state")
    S.reservoir_stream(Stream(), 10, ["id"], sample, "")
    want = sorted(r.id for r in S.reservoir_sample(pts, 10, ["id"]).collect())
    assert sorted(r.id for r in S.latest_version(spark, sample).collect()) == want


def test_a_failing_state_read_fails_the_batch(spark):
    with pytest.raises(Exception):
        S._read_version(spark, "/tmp/no-such-state", 3, None)
    assert S._read_version(spark, "/tmp/no-such-state", -1, None) is None


def bfr_by_hand(rows, k, threshold, chunks, seed):
    """The chunk rule of ``cluster.bfr`` on lists: {id: (cluster, chunk)}."""
    key = lambda i: hashlib.md5(f"{seed}|{i}".encode()).hexdigest()
    parts = {}
    for i, x in rows:
        parts.setdefault(int(key(i)[:8], 16) % chunks, []).append((i, np.array(x)))
    out, summ = {}, None
    for c in sorted(parts):
        X = np.array([x for _, x in parts[c]])
        if summ is None:
            cents = np.array([x for _, x in sorted(parts[c], key=lambda r: (key(r[0]), r[0]))[:k]])
            for _ in range(10):
                lab = ((X[:, None] - cents[None]) ** 2).sum(-1).argmin(1)
                cents = np.array([X[lab == j].mean(0) if (lab == j).any() else cents[j] for j in range(len(cents))])
            lab = ((X[:, None] - cents[None]) ** 2).sum(-1).argmin(1)
            summ = {j: [0, 0.0, 0.0] for j in set(lab.tolist())}
        else:
            lab = []
            for x in X:
                d = []
                for j, (n, s, q) in sorted(summ.items()):
                    var = q / n - (s / n) ** 2
                    d.append((float(np.sqrt(((x - s / n) ** 2 / np.where(var <= 0, 1e-6, var)).sum())), j))
                lab.append(min(d)[1] if min(d)[0] < threshold else -1)
        for (i, x), j in zip(parts[c], lab):
            out[i] = (int(j), c)
            if j >= 0:
                summ[j] = [summ[j][0] + 1, summ[j][1] + x, summ[j][2] + x * x]
    return out


def test_bfr_equals_the_rule_by_hand_whatever_the_layout(spark):
    pts = blobs(spark, 120).select("id", "x")
    rows = [(r.id, list(r.x)) for r in pts.collect()]
    want = bfr_by_hand(rows, 3, 3.0, 4, 42)
    for layout in (pts, pts.orderBy(F.desc("id")).repartition(3), pts.coalesce(1)):
        out, summ = C.bfr(layout, 3, threshold=3.0, chunks=4)
        assert {r.id: (r.cluster, r.chunk) for r in out.collect()} == want
    assert sum(v[0] for v in summ.values()) == sum(c >= 0 for c, _ in want.values())
    for layout in (pts, pts.orderBy(F.desc("id")).repartition(3)):
        src, files = S.split_into_chunks(layout, 4, spark, "bfr-src")
        stream = spark.readStream.schema(pts.schema).option("maxFilesPerTrigger", files).parquet(src)
        state, dest = scratch_path(spark, "bfr-state"), scratch_path(spark, "bfr-out")
        S.bfr_stream(stream, 3, state, dest, scratch_path(spark, "bfr-ckpt"), threshold=3.0).awaitTermination()
        assert {r.id: (r.cluster, r.batch) for r in spark.read.parquet(dest).collect()} == want
        assert spark.read.parquet(state).select(S.VERSION_COL).distinct().count() == 2    # older versions are gone


def test_bfr_edge_cases(spark):
    kinds = "id long, x array<double>"
    out, summ = C.bfr(spark.createDataFrame([], kinds), 3)
    assert out.count() == 0 and summ == {} and out.columns == ["id", "cluster", "chunk"]
    same = spark.createDataFrame([(1, [1.0, 2.0])] * 4 + [(2, None), (3, [1.0, 2.0])], kinds)
    out, summ = C.bfr(same, 2, chunks=2)
    assert sorted(r.id for r in out.collect()) == [1, 1, 1, 1, 3] and sum(v[0] for v in summ.values()) == 5


class Upserts:
    """The stream interface that ``upsert_stream`` uses; batches are handed to ``merge`` by the test."""

    def __init__(self, df):
        self.df = df

    def select(self, *cols):
        return self.df.select(*cols)

    @property
    def writeStream(self):
        return self

    def foreachBatch(self, f):
        self.merge = f
        return self

    def option(self, *a):
        return self

    def trigger(self, **k):
        return self

    def start(self):
        return self


def test_upserts_touch_only_their_buckets_and_replay(spark):
    kinds = "u long, i long, score double, seq long"
    first = spark.createDataFrame([(u, 1, float(u), u) for u in range(200)] + [(None, 1, 5.0, 3)], kinds)
    second = spark.createDataFrame([(7, 1, 70.0, 500), (7, 1, 71.0, 500), (8, 1, 80.0, 2), (9, 1, 90.0, None)], kinds)
    state = scratch_path(spark, "upserts")
    stream = S.upsert_stream(Upserts(first), ["u", "i"], "score", "seq", state, "", buckets=16)

    def files():
        return set(spark.read.parquet(f"{state}/table").inputFiles())

    def table():
        return {r.u: (r.score, r.seq) for r in S.upserted(spark, state).collect()}

    stream.merge(first, 0)
    want = {u: (float(u), u) for u in range(200)} | {None: (5.0, 3)}
    assert table() == want and S.upserted(spark, state).count() == 201
    old = files()
    stream.merge(second, 1)
    want[7] = (71.0, 500)                           # of equal sequences the larger value; older ones and null lose
    assert table() == want
    kept = {f.split("key_bucket=")[1].split("/")[0] for f in files() - old}
    assert 1 <= len(kept) <= 3                       # three keys: the files of all other buckets are the same
    assert len(files() & old) >= len(old) - 3
    stream.merge(second, 1)                          # a replay from the copy beside the table
    assert table() == want
    delete_path(spark, f"{state}/merged/batch=1/_SUCCESS")
    stream.merge(second, 1)                          # a replay of a copy that wasn't finished
    assert table() == want
    stream.merge(second.limit(0), 2)
    assert table() == want and not path_exists(spark, f"{state}/merged/batch=1")


def test_dropped_bucketed_tables_leave_the_catalog(spark):
    kept = write_bucketed(spark.range(10), "gone", "id")
    folder = kept.inputFiles()[0].rsplit("/", 1)[0]
    name = folder.rsplit("/", 1)[1]
    assert spark.catalog.tableExists(name)
    drop_table(kept)
    assert not spark.catalog.tableExists(name) and not path_exists(spark, folder)


def test_cure_equals_the_rule_by_hand(spark):
    pts = blobs(spark, 60).select("id", "x")
    labels, reps = C.cure(pts, 3, r=3, alpha=.2)
    rows = [(r.id, np.array(r.x)) for r in pts.orderBy("id").collect()]
    X = np.array([x for _, x in rows])
    cents = np.array(C.init_centers(pts, 3))
    for _ in range(10):
        lab = ((X[:, None] - cents[None]) ** 2).sum(-1).argmin(1)
        cents = np.array([X[lab == j].mean(0) if (lab == j).any() else cents[j] for j in range(3)])
    lab = ((X[:, None] - cents[None]) ** 2).sum(-1).argmin(1)
    flat, owner = [], []
    for c in range(3):
        mine, mean = X[lab == c], X[lab == c].mean(0)
        picked = [mine[((mine - mean) ** 2).sum(1).argmax()]]
        while len(picked) < 3:
            picked.append(mine[np.min([((mine - p) ** 2).sum(1) for p in picked], axis=0).argmax()])
        moved = [p + .2 * (mean - p) for p in picked]
        assert np.allclose(moved, reps[c])
        flat += moved
        owner += [c] * 3
    want = [owner[int(((np.array(flat) - x) ** 2).sum(1).argmin())] for x in X]
    assert [r.cluster for r in labels.orderBy("id").collect()] == want
