"""The pipeline's stages on a planted table: what has to go goes, clean documents stay."""

import random

import corpus_pipeline as P
from quarry.llm import queries as Q


def test_stages_follow_each_other(spark, tmp_path_factory):
    rnd = random.Random(12)
    vocabulary = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(3, 8))) for _ in range(2000)]

    def text(n=60):
        return " ".join(rnd.choice(vocabulary) for _ in range(n))

    clean = {k: text() for k in range(60)}
    passage = text(14)
    block = "\n".join(text(8) for _ in range(4))
    near = clean[3].split()
    near[30] = "changed"
    rows = {**clean, 100: " ".join(near), 101: clean[5], 102: text(30) + " " + passage + " " + text(20),
            103: block + "\n" + text(), 104: text() + "\n" + block, 105: block, 106: None, 107: ""}
    docs = [(k, t, "en", "s", 0 if t is None else len(t)) for k, t in rows.items()] + [(None, text(), "en", "s", 5)]
    toxic = [(2000 + k, text(20) + " scum idiot " + text(20), "en", "s", 300) for k in range(200)]
    extra = [(3000 + k, text(30), "en", "s", 300) for k in range(200)]
    where = str(tmp_path_factory.mktemp("pipe"))
    spark.createDataFrame(docs + toxic + extra, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{where}/documents.parquet")
    spark.createDataFrame([(7, passage)], "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    marks = [(d[0], 1, 1) for d in toxic] + [(d[0], 1, 0) for d in extra] + [(k, 1, 0) for k in clean]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")

    at = spark.read.parquet(f"{where}/documents.parquet")
    left = []
    for name, stage in P.STAGES:
        out = stage(spark, at, where)
        if name != "byte_bpe":
            assert out.columns == at.columns
        path = f"{where}/{name}"
        out.write.parquet(path)
        at = spark.read.parquet(path)
        left.append({r.doc_id for r in at.select("doc_id").collect()})
    kept = set(clean) - left[0]
    assert len(kept) <= 2 and sum(d[0] in left[0] for d in toxic) <= 10          # toxicity
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{where}/line_dedup").collect()}
    assert 105 not in texts and texts[103].startswith(block) and block not in texts[104]   # later occurrences go
    assert {106, 107, None} <= left[1]
    assert {100, 101} & left[2] == set() and {3, 5} <= left[2] | kept
    assert 102 in left[2] and 102 not in left[3]
    assert left[4] == left[3] and set(clean) - kept <= left[4]


def test_every_query_is_registered():
    import re
    names = {int(re.match(r"op(\d+)_", n)[1]) for n in Q.queries()}
    assert names == set(range(1, 14))
    assert set(Q.oracle_sql()) <= set(Q.queries())
    assert [s[0] for s in P.STAGES] == ["toxicity", "line_dedup", "minhash", "decontamination", "byte_bpe"]


def test_stages_that_end_in_python_are_written_in_small_batches(spark, tmp_path_factory):
    import numpy as np
    import pyarrow as pa
    from pyspark.sql import functions as F

    from quarry.llm import toxicity
    from quarry.llm.common import BATCH_BYTES, small_batches
    where = str(tmp_path_factory.mktemp("small"))
    rows = [(k, ("idiot " if k % 2 else "fine ") * 400, "en", "s", 9) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    spark.createDataFrame([(k, 1, k % 2) for k in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    for name, stage in P.STAGES:
        if name in ("toxicity", "byte_bpe"):
            plan = stage(spark, docs, where)._jdf.queryExecution().executedPlan().toString()
            assert "MapInArrow" not in plan and name in P.WRITTEN, name       # else the caller's batches would hold: 10,000 texts

    model = toxicity.fresh(0.5)
    whole = toxicity.score(docs, model, also=tuple(docs.columns), to="_t")
    given = whole._jdf.queryExecution().optimizedPlan().toString()
    assert "_scored" not in given                                              # the text goes to the worker once
    alone = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert {r.doc_id: r._t for r in whole.collect()} == alone and whole.columns == [*docs.columns, "_t"]

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])
    long = spark.range(0, 300, 1, 1).select(F.repeat(F.lit("x"), 40_000).alias("text"))
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None)
    with small_batches(spark):
        seen = np.array([r.n for r in long.mapInArrow(sizes, "n long").collect()])
    assert len(seen) > 5 and seen.max() < 2 * BATCH_BYTES
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) == before
