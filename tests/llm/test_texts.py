"""Line dedup, tokens, decontamination, sharding and near-duplicates against brute force on small tables."""

import hashlib
import os
import random
import subprocess
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import bpe, line_dedup, minhash, shards, winnow

public = pytest.importorskip("public_tokenizers")
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_line_dedup_against_brute_force(docs_of):
    rnd = random.Random(4)
    lines = ["a", "b", "c", "d", ""]
    rows = [(k, "\n".join(rnd.choice(lines) for _ in range(rnd.randint(0, 12)))) for k in range(40)]
    rows += [(100, None), (101, ""), (102, "a\nb"), (None, "q\nr\ns"), (103, "q\nr\ns\nt"), (104, "x\ny\nz"), (104, "x\ny\nz")]
    got = {(r.doc_id, k): (r.text, r._n, r._gone) for k, r in enumerate(
        line_dedup.dedup_lines(docs_of(rows), added=("_n", "_gone")).orderBy("doc_id").collect())}
    seen, want = set(), []
    for i, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        parts = [] if t is None else t.split("\n")
        gone = set()
        for p in range(len(parts) - 2):
            window = tuple(parts[p:p + 3])
            if any(window):
                if window in seen:
                    gone |= {p, p + 1, p + 2}
                seen.add(window)
        text = None if t is None else "\n".join(x for p, x in enumerate(parts) if p not in gone)
        want += [(i, (text, len(parts), len(gone)))] * rows.count((i, t))
    assert sorted(((k[0], v) for k, v in got.items()), key=repr) == sorted(want, key=repr)


def test_extra_columns_stay(docs_of):
    out = line_dedup.dedup_lines(docs_of([(1, "a\nb\nc"), (2, "a\nb\nc")]), added=("_n", "_gone"))
    assert out.columns[:7] == ["doc_id", "text", "lang", "source", "n_chars", "n_lines", "component_id"]
    assert {r.n_lines for r in out.collect()} == {7}


def test_bpe_as_the_library_does(spark, docs_of):
    import tiktoken
    path = public.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        tokens = bpe.read_ranks(f.read())
    library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)},
                                special_tokens={})
    rnd = random.Random(2)
    letters = list("aabst'' \n\t  rvlmde.,!?019' éß　\xa0漢\U0001F600́\x1c\x85")
    rows = [(k, "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40)))) for k in range(400)]
    rows += [(900, None), (901, ""), (902, "a" * 2000 + " " + "ab" * 1500), (903, "it's 're don't 'll'ves"), (903, "it's")]
    vocabulary = bpe.load_vocabulary(spark, path)
    both = bpe.decode(bpe.encode(docs_of(rows), vocabulary), vocabulary).collect()
    got = sorted((r.doc_id, list(r.ids), bytes(r.decoded)) for r in both)
    assert got == sorted((i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows)
    digest = {r.doc_id: r for r in bpe.token_digests(docs_of(rows[:3]), vocabulary).collect()}
    ids = library.encode_ordinary(rows[0][1])
    assert digest[0].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert bpe.token_digests(docs_of([]), vocabulary).count() == 0
    long = [(1, " ".join(rnd.choice(["one", "two's", "l'été", "\n", "x1", "　"]) for _ in range(300_000))), (2, "end"), (3, None)]
    digest = {r.doc_id: r for r in bpe.token_digests(docs_of(long), vocabulary).collect()}
    ids = {i: library.encode_ordinary(t or "") for i, t in long}
    assert {i: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for i, r in digest.items()} == {
        i: (len(ids[i]), hashlib.sha256(" ".join(map(str, ids[i])).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
        for i, t in long}
    assert {r.doc_id: list(r.ids) for r in bpe.encode(docs_of(long), vocabulary).collect()} == ids


def words(text):
    import re
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def test_decontamination_against_brute_force(spark, docs_of):
    rnd = random.Random(8)
    bag = ["uno", "dos", "Éa", "x1", "y"]
    items = [(k, " ".join(rnd.choice(bag) for _ in range(n))) for k, n in enumerate([3, 9, 10, 14, 25, 1])]
    items += [(6, None), (7, ""), (3, items[3][1]), (None, "zz " * 12)]
    rows = [(k, " ".join(rnd.choice(bag) for _ in range(rnd.randint(0, 30)))) for k in range(30)]
    rows += [(50, "w " * 20 + items[4][1].upper().replace("ÉA", "Éa") + " w"), (51, None), (52, ""), (53, "zz-" * 15),
             (54, "w " + items[3][1]), (54, "w " + items[3][1]), (54, "other"), (None, items[3][1])]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, n_words int")
    got = sorted((repr(r[0]), r.n_words, r.n_hit, r.items, r.contaminated) for r in winnow.contaminated_words(
        docs_of(rows), bench).collect())
    want = []
    for i, t in rows:
        w, hit, names = words(t), set(), set()
        for item, text in items:
            x = words(text)
            n = min(10, len(x))
            windows = {tuple(x[p:p + n]) for p in range(len(x) - n + 1)} if n else set()
            for p in range(len(w) - n + 1 if n else 0):
                if tuple(w[p:p + n]) in windows:
                    hit |= set(range(p, p + n))
                    names |= {str(item)} if item is not None else set()
        want.append((repr(i), len(w), len(hit), sorted(names), bool(hit)))
    assert got == sorted(want)
    clean = winnow.decontaminate(docs_of(rows), bench)
    assert clean.columns == docs_of(rows).columns
    assert clean.count() == sum(not w[4] for w in want)
    assert winnow.contaminated_words(docs_of([]), bench).count() == 0
    assert winnow.contaminated_words(docs_of(rows), bench.limit(0)).where("contaminated").count() == 0


def test_benchmark_of_many_short_items_is_not_broadcast(spark, docs_of, monkeypatch):
    many = spark.range(300_000).select("id", F.concat_ws(" ", F.lit("x"), F.col("id"), F.lit("y")).alias("text")).withColumnRenamed("id", "item_id")
    assert winnow.benchmark_index(many)[-1] is False
    repeated = spark.range(1000).select(F.col("id").alias("item_id"), F.lit("one two three").alias("text"))
    places, names, small = winnow.benchmark_index(repeated)
    assert small and places.count() == 1 and names.count() == 1000
    long = spark.range(3).select(F.col("id").alias("item_id"), F.repeat(F.lit("w "), 400_000).alias("text"))
    assert winnow.benchmark_index(long.withColumn("text", F.concat("text", "item_id")))[-1] in (True, False)
    rows = [(k, "a b c d e f g h i j k l m " * (k % 3) + "tail") for k in range(20)] + [(30, "say one two three now")]
    bench = spark.createDataFrame([(k, "b c d e f g h i j k l") for k in range(50)] + [(60, "two three"), (61, "e f g h i")], "item_id long, text string")

    def found():
        return sorted((r.doc_id, r.n_hit, r.items) for r in winnow.contaminated_words(docs_of(rows), bench).collect())

    narrow = found()
    monkeypatch.setattr(winnow, "BROADCAST_ROWS", 0)
    plans = []
    monkeypatch.setattr(winnow, "written", lambda df, name, real=winnow.written: plans.append(
        df._jdf.queryExecution().analyzed().toString()) or real(df, name))
    assert found() == narrow and sum(r[1] for r in narrow) > 100
    assert not any("strategy=broadcast" in p for p in plans)


def test_shards_have_near_equal_bytes_and_gapless_slots(docs_of):
    rnd = random.Random(5)
    rows = [(k, "copy") for k in range(300)] + [(1000 + k, "t" * rnd.randint(0, 90)) for k in range(600)]
    rows += [(5000, None), (None, "n"), (7, "again"), (7, "again")]
    out = shards.shard(docs_of(rows), rows_per_range=50).collect()
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in out) == sorted(
        (i or -1, len(t or "") + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    total, most = sum(r.size for r in out), max(r.size for r in out)
    for s in range(8):
        own = [r for r in out if r.shard == s]
        assert abs(sum(r.size for r in own) - total / 8) <= most
        assert sorted(r.slot for r in own) == list(range(len(own)))
    # the sample and the ranges only deal the work: other ranges, the same shards
    other = shards.shard(docs_of(rows), rows_per_range=10 ** 6).collect()
    assert sorted((r.size, r.shard) for r in out) == sorted((r.size, r.shard) for r in other)
    assert shards.shard(docs_of([])).count() == 0


def _grown(code, text_mb=50):
    """Peak MB that ``code`` adds in a fresh process over one text of ``text_mb`` MB, a column ``column``."""
    head = f"""
import random, resource, sys
sys.path.insert(0, {ROOT!r})
import numpy as np, pyarrow as pa
rnd = random.Random(1)
bag = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9))) for _ in range(5000)]
part = " ".join(rnd.choice(bag) for _ in range(100_000)) + ". "
column = pa.array([part * ({text_mb} * 1_000_000 // len(part))])
small = pa.array([part[:1000]])
"""
    tail = """
def peak():
    return resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024
go(small)
before = peak()
go(column)
print(peak() - before)
"""
    done = subprocess.run([sys.executable, "-c", head + code + tail], capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    return float(done.stdout.split()[-1])


@pytest.mark.parametrize("code, most", [
    ("""
from quarry.llm import bpe
import public_tokenizers as P
codec = bpe.Codec(bpe.read_ranks(open(P.path("byte_bpe_50k.tiktoken"), "rb").read()))
def go(column):
    for _, ids, n in bpe._encoded(codec, column):
        codec.decode(ids)
""", 150),
    ("""
from quarry.llm import toxicity as t, textnum as tn
rng = np.random.default_rng(1)
model = t.Model(rng.normal(size=(t.SLOTS + 1, t.SIZE)).astype(np.float32), [rng.normal(size=(w, t.SIZE, t.FILTERS)).astype(np.float32)
                for w in t.WIDTHS], np.zeros(24, np.float32), np.ones(24, np.float32), 0.0)
def go(column):
    list(t._scores(model, column))
""", 700),
    ("""
from quarry.llm import minhash, textnum as tn
def go(column):
    minhash.shingle_sets(*tn.text_buffers(column), 5)
""", 900),
    ("""
from quarry.llm import resampling, textnum as tn
def go(column):
    resampling.ngrams(*tn.text_buffers(column))
""", 900)])
def test_one_text_of_50_megabytes(code, most):
    assert _grown(code) < most


def test_minhash_against_brute_force(docs_of):
    rnd = random.Random(6)
    base = [f"w{rnd.randint(0, 400)}" for _ in range(120)]

    def near(changes):
        t = list(base)
        for _ in range(changes):
            t[rnd.randrange(len(t))] = f"z{rnd.randint(0, 10 ** 6)}"
        return " ".join(t)

    rows = [(k, near(k % 9)) for k in range(10, 90)]
    rows += [(200 + k, " ".join(f"u{rnd.randint(0, 10 ** 6)}" for _ in range(40))) for k in range(20)]
    rows += [(5, rows[3][1].upper()), (300, None), (301, ""), (302, " \t "), (303, "one two"), (304, "ONE  two"),
             (305, near(0)), (305, "some other text of its own here"), (None, near(0)), (306, "x" * 5000)]
    got = sorted((repr(r.doc_id), r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(
        docs_of(rows), words=4).collect())

    def shingles(text):
        w = (text or "").lower().split()
        return {tuple(w[p:p + 4]) for p in range(max(1, len(w) - 3))} if w else set()

    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, x in sets:
        for b, y in sets:
            if a is not None and b is not None and a < b and x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = sorted((find(a), find(b)))
                parent[q] = p
    want = [(repr(i), len(s), None if i is None else find(i), True if i is None else find(i) == i) for i, s in sets]
    assert got == sorted(want, key=lambda r: tuple(map(repr, r))) or sorted(got, key=repr) == sorted(want, key=repr)
    assert minhash.near_duplicates(docs_of([])).count() == 0


def test_blocks_of_a_large_bucket_lose_no_link(docs_of, monkeypatch):
    """Texts of two near groups that share most buckets, compared in blocks of four rows."""
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 4)
    base = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(base[:k] + [f"v{k}"] + base[k + 1:])) for k in range(0, 60, 2)]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs_of(rows), words=2).collect()}
    sets = {i: {tuple(t.split()[p:p + 2]) for p in range(59)} for i, t in rows}
    linked = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    for a, b in linked:
        assert got[a] == got[b]


def test_links_of_long_texts_are_decided_in_integers():
    n, common = 200_024, 179_027        # 100 * common is just below 81 * union; in float32 both are the same
    assert 100 * common == 81 * (2 * n - common) - 1

    def edges(both):
        sets = [np.arange(n), np.arange(n - both, 2 * n - both)]
        rows = pa.RecordBatch.from_pydict({
            "rep": [1, 2], "part": [1, 2], "blk": [0, 0], "i": [0, 0], "j": [0, 0], "gid": [5, 5],
            "shingles": pa.array([s.tolist() for s in sets], pa.list_(pa.int64()))})
        return [r for b in minhash._links_in_blocks(81)(iter([rows])) for r in b.to_pylist()]

    assert edges(common) == [] and edges(common + 1) == [{"a": 2, "b": 1}]
