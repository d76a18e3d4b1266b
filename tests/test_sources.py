import pytest

from quarry.session import scratch_path
from quarry.sources import edges_text, ratings_text


def _write(path, text):
    import os
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part.txt"), "w") as f:
        f.write(text)


def test_block_reader_across_splits(spark):
    lines = []
    want = []
    for u in range(40):
        lines.append(f"{u}|{u % 5 + 1}")
        for i in range(u % 5 + 1):
            lines.append(f"{1000 + i}  {50 + i}")
            want.append((u, 1000 + i, float(50 + i)))
    path = scratch_path(spark, "blocks").replace("file:", "")
    _write(path, "\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")  # many splits: headers sit in earlier splits
    try:
        got = sorted(tuple(r) for r in ratings_text.read_blocks(spark, path).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == sorted(want)


def test_blank_lines_strict_and_permissive(spark):
    path = scratch_path(spark, "blocks-blank").replace("file:", "")
    _write(path, "0|2\n550452  95\n\n7 x\n1|1\n5 60   \n")
    got = sorted(tuple(r) for r in ratings_text.read_blocks(spark, path, strict=False).collect())
    assert got == [(0, 550452, 95.0), (1, 5, 60.0)]
    with pytest.raises(Exception):
        ratings_text.read_blocks(spark, path, strict=True).collect()


@pytest.mark.parametrize("text", ["5 60\n0|1\n7 50\n", "0|1\n5 60 9\n", "0|1\n5\n"])
def test_strict_reader_raises_whatever_is_selected(spark, text):
    path = scratch_path(spark, "blocks-wrong").replace("file:", "")
    _write(path, text)
    for columns in (["user_id"], ["item_id"], ["score"]):
        with pytest.raises(Exception, match="malformed rating line"):
            ratings_text.read_blocks(spark, path, strict=True).select(*columns).collect()


def test_block_sink_round_trip_and_count_check(spark):
    r = spark.createDataFrame([(2, 7, 20.5), (2, 3, 21.5), (1, 9, 99.0)], "user_id long, item_id long, score double")
    lines = [(x.user_id, x.line_no, x.line) for x in ratings_text.block_lines(r, "round").collect()]
    assert sorted(lines) == [(1, 0, "1|1"), (1, 1, "9  99"), (2, 0, "2|2"), (2, 1, "3  22"), (2, 2, "7  20")]
    path = scratch_path(spark, "sink")
    ratings_text.write_blocks(r, path, mode="raw")
    assert sorted(tuple(x) for x in ratings_text.read_blocks(spark, path).collect()) == sorted(tuple(x) for x in r.collect())
    assert ratings_text.block_count_check(spark, path).count() == 0
    bad = scratch_path(spark, "bad").replace("file:", "")
    _write(bad, "4|3\n1 2\n")
    assert [(x.user_id, x.declared, x.read) for x in ratings_text.block_count_check(spark, bad).collect()] == [(4, 3, 1)]


def test_edge_list_and_top_k_sink(spark):
    path = scratch_path(spark, "edges").replace("file:", "")
    _write(path, "0 1\n1  2\n\n2\t0\n5 0\n")
    e = edges_text.read_edge_list(spark, path)
    assert sorted(tuple(x) for x in e.collect()) == [(0, 1), (1, 2), (2, 0), (5, 0)]
    assert edges_text.id_range_vertices(e).count() == 6
    from quarry.operators import graph as G
    pr = G.pagerank(edges_text.id_range_vertices(e), e, check_every=1)
    assert sum(x.pr for x in pr.collect()) == pytest.approx(1.0, abs=1e-9)
    out = scratch_path(spark, "top")
    edges_text.write_top_k_tsv(pr, out, k=3)
    assert spark.read.csv(out, sep="\t").count() == 3


def test_params_and_csv_round_trip(spark):
    import numpy as np
    from quarry.sources import models
    p = {"W1": np.arange(6.0).reshape(2, 3), "b": np.array([1.5])}
    path = scratch_path(spark, "params")
    models.save_params(spark, p, path)
    q = models.load_params(spark, path)
    assert np.array_equal(q["W1"], p["W1"]) and np.array_equal(q["b"], p["b"])
    df = spark.createDataFrame([(1, 2.5)], "user_id long, pred double")
    out = scratch_path(spark, "csv")
    models.write_csv(df, out)
    assert spark.read.option("header", True).csv(out).count() == 1
