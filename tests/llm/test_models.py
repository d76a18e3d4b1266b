"""Classifiers, resampling, embeddings, chat templates and the secret scan."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import chat, components, resampling, secrets, toxicity, vector_dedup
from quarry.llm import textnum as tn


def test_components_of_chains_stars_and_cycles(spark):
    rnd = random.Random(3)
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 100 + k) for k in range(1, 30)] + [(200, 201), (201, 202), (202, 200)]
    edges += [(300, 300)]
    rnd.shuffle(edges)
    got = {r.id: r.component for r in components.connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{100 + k: 100 for k in range(30)}, **{200 + k: 200 for k in range(3)}}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(6, 16))
    rows = []
    for k in range(120):
        v = base[k % 6] + rng.normal(size=16) * (0.02 if k % 3 else 0.3)
        rows.append((k, [float(x) for x in v], k % 2))
    rows += [(200 + k, rows[0][1], 0) for k in range(30)]
    rows += [(300, None, 0), (301, [0.0] * 16, 0), (302, [float("nan")] * 16, 0), (303, [1.0, None] * 8, 0),
             (304, rows[0][1], None), (305, [1.0, 2.0], 0), (306, [2.0, 4.0], 0), (307, [], 0), (308, rows[1][1], 1), (308, rows[1][1], 1)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, n_links int")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in vector_dedup.near_vectors(df, block_rows=8).collect())

    def usable(r):
        return r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])

    good = list({r[0]: r for r in rows if usable(r)}.values())
    links = {r[0]: set() for r in rows}
    for a in good:
        for b in good:
            if a[0] < b[0] and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1]), np.array(b[1])
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
                    links[a[0]].add(b[0])
                    links[b[0]].add(a[0])

    def least(i):
        seen, todo = {i}, [i]
        while todo:
            for n in links[todo.pop()] - seen:
                seen.add(n)
                todo.append(n)
        return min(seen)

    assert got == sorted((r[0], len(links[r[0]]), least(r[0]), least(r[0]) == r[0]) for r in rows)
    assert vector_dedup.near_vectors(df.limit(0)).count() == 0


def test_vector_buckets_find_pairs_at_the_limit():
    """Recall of the buckets for pairs at a cosine of 0.93."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    z = rng.normal(size=(400, 64))
    z -= (z * x).sum(axis=1)[:, None] * x
    z /= np.linalg.norm(z, axis=1)[:, None]
    y = 0.93 * x + np.sqrt(1 - 0.93 ** 2) * z
    met = (vector_dedup.bucket_keys(x) == vector_dedup.bucket_keys(y)).any(axis=1)
    assert met.mean() >= 0.99


def test_vectors_of_extreme_sizes(spark):
    rows = [(1, [1e200, 1e200]), (2, [2e200, 2e200]), (3, [1e-200, 1e-200]), (4, [3e-310, 3e-310]), (5, [1e200, -1e200]), (6, [1.0, 1.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in vector_dedup.near_vectors(
        spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {1: (4, 1), 2: (4, 1), 3: (4, 1), 4: (4, 1), 5: (0, 5), 6: (4, 1)}


def test_sessions_keep_their_settings(spark, docs_of):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    docs = docs_of([(1, "a fine text"), (2, "another")])
    toxicity.score(docs, toxicity.fit(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int"))[0]).collect()
    resampling.resample(docs, docs, 0.5).collect()
    assert spark.conf.get(key) == before


def test_forward_and_gradient_against_loops():
    """One training step's parts against plain loops: maxima, score, and the gradient by finite differences."""
    rng = np.random.default_rng(4)
    texts = pa.array(["one two three four", "two", "", "five one five six seven eight nine ten"])
    buf, off = tn.text_buffers(texts)
    slots, row = toxicity.features(buf, off)
    words = np.zeros((toxicity.SLOTS + 1, toxicity.SIZE), np.float32)
    words[:-1] = rng.normal(0, 0.5, (toxicity.SLOTS, toxicity.SIZE))
    model = toxicity.Model(words, [rng.normal(size=(w, toxicity.SIZE, toxicity.FILTERS)).astype(np.float32) for w in toxicity.WIDTHS],
                           rng.normal(size=24).astype(np.float32), rng.normal(size=24).astype(np.float32), 0.3)
    want = np.zeros((4, 24))
    for r in range(4):
        own = [[s for s in x if s >= 0] for x, of in zip(slots.tolist(), row.tolist()) if of == r]
        e = [np.mean([words[s].astype(float) for s in x], axis=0) for x in own]
        for w, f in enumerate(model.filters):
            for c in range(8):
                z = [sum(float(e[p + o] @ f[o, :, c]) for o in range(len(f)) if p + o < len(e)) + model.filter_bias[w * 8 + c]
                     for p in range(len(e))]
                want[r, w * 8 + c] = max([0.0, *z])
    found, where = model.pooled(slots, row, 4)
    assert np.allclose(found, want, atol=1e-4) and np.allclose(model.maxima(slots, row, 4), want, atol=1e-4)
    assert np.allclose(model.score(buf, off), 1 / (1 + np.exp(-(want @ model.weight + 0.3))), atol=1e-4)
    assert ((where >= 0) == (want > 0)).all()


def test_maxima_over_parts_of_a_long_text(monkeypatch):
    rng = np.random.default_rng(5)
    texts = pa.array([" ".join(f"w{k}" for k in rng.integers(0, 90, n)) for n in (300, 0, 5, 170)])
    buf, off = tn.text_buffers(texts)
    slots, row = toxicity.features(buf, off)
    model = toxicity.Model(rng.normal(size=(toxicity.SLOTS + 1, 16)).astype(np.float32), [rng.normal(size=(w, 16, 8)).astype(np.float32)
                           for w in toxicity.WIDTHS], rng.normal(size=24).astype(np.float32), np.ones(24, np.float32), 0.0)
    whole = model.maxima(slots, row, 4)
    for n in (1, 2, 7, 64):
        monkeypatch.setattr(toxicity, "WORDS_AT_ONCE", n)
        assert np.allclose(model.maxima(slots, row, 4), whole, atol=1e-4)


def test_unlabelled_texts_are_not_shuffled(spark, monkeypatch):
    """The labels meet the texts where these are, and just the labelled texts go to the shards; beyond MARKS_BYTES the same rows."""
    docs = spark.createDataFrame([*[(k, f"text {k}", "en") for k in range(900)], (5, "again", "de"), (None, "no id", "en"), (901, None, "fr")],
                                 "doc_id long, text string, lang string")
    labels = spark.createDataFrame([*[(k, k % 2) for k in range(0, 700, 3)], (5, 0), (5, 1), (901, 1), (9999, 1), (None, 1), (8, None)],
                                   "doc_id int, toxic int")
    plans, rows = [], []
    write = toxicity.write_table

    def held(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        out = write(df, name)
        rows.append(sorted(map(str, out.select("_id", "text", "lang", "y").collect())))
        return out

    monkeypatch.setattr(toxicity, "write_table", held)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        toxicity.fit(docs, labels)
        monkeypatch.setattr(toxicity, "MARKS_BYTES", 0)
        toxicity.fit(docs, labels)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plans[0] and "SortMergeJoin" in plans[1]
    marks = {k: k % 2 for k in range(0, 700, 3)} | {5: 1, 901: 1}
    want = [(r.doc_id, r.text or "", r.lang, marks[r.doc_id]) for r in docs.collect()
            if r.doc_id in marks and zlib.crc32(str(r.doc_id).encode()) % 5]
    assert rows[0] == rows[1] == sorted(f"Row(_id={i}, text={t!r}, lang={g!r}, y={y})" for i, t, g, y in want)


def test_templates():
    with pytest.raises(chat.TemplateError):
        chat.compile_template("{{ x | nofilter }}")
    with pytest.raises(chat.TemplateError):
        chat.compile_template("{{ x() }}")
    with pytest.raises(chat.TemplateError):
        chat.compile_template("{% for x in y %}")
    with pytest.raises(chat.TemplateError):
        chat.compile_template('{{ "b" + 1 }}')
    render = chat.compile_template('{% if 1 == 2 %}no{% elif true %}a{{ "b" ~ 1 }}{% endif %}{# c #}'
                                   '{% for m in messages %}{{ m["role"] | upper }}{% if not loop.last %},{% endif %}{% endfor %}')
    assert render([{"role": "x"}, {"role": "y"}])[0] == "ab1X,Y"
    folded = chat.fold(chat.parse('{{ "x" ~ "y" }}z{% if false %}{{ q }}{% endif %}'), {})
    assert folded == [("text", "xyz")]
    assert chat.compile_template("{{ messages.__class__ }}")([])[0] == ""      # keys only, no Python attributes
    text, spans = chat.compile_template("a{% generation %}{{ messages | length }}{% endgeneration %}b")([1, 2])
    assert (text, spans) == ("a2b", [(1, 2)])


def test_chats_read_back(spark):
    rnd = random.Random(9)
    bits = ["</s>", "<s>", "[INST]", "[/INST]", "\\", " ", "é", "\U0001F600", "\n", "a"]

    def noise():
        return "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 12)))

    rows = [(c, t, rnd.choice(["user", "assistant", "system", noise()]), noise()) for c in range(20) for t in range(4)]
    rows += [(50, 0, "assistant", None), (51, None, None, "x"), (None, 0, "user", "hi"), (52, 0, "user", "z" * 100_000),
             (53, 0, "user", "b"), (53, 0, "user", "a"), (53, 0, "user", "a")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    for r in chat.read_chats(chat.format_chats(df)).collect():
        own = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == r.conv_id))
        assert [(t.role, t.text) for t in r.turns] == [(x[2], x[3]) for x in own]
        assert r.loss_text == "".join(x[3] for x in own if x[2] == "assistant")
    assert chat.read_chats(chat.format_chats(df.limit(0))).count() == 0


def test_toxicity_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").withColumn("score", F.lit(1))
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model, limits = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model, also=("doc_id",)).join(labels, "doc_id").collect()
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    hit = [(r.score >= 0.5) == (r.toxic == 1) for r in held]
    assert len(held) > 500 and sum(hit) / len(hit) >= 0.95
    recall = [r.score >= 0.5 for r in held if r.toxic == 1]
    assert sum(recall) / len(recall) >= 0.75
    assert limits[""] > 0 and all(0 < t < 1 for t in limits.values())


def test_toxicity_edge_cases(spark, docs_of):
    docs = docs_of([(k, ["idiot words", "fine words", "", None][k % 4]) for k in range(40)])
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(40)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model, _ = toxicity.fit(docs, labels)
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert len(scores) == 40 and all(0 <= s <= 1 for s in scores.values())
    assert scores[2] == scores[3] and scores[0] > scores[1]
    none, _ = toxicity.fit(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_toxicity_learns_from_every_labelled_row(spark, docs_of, monkeypatch):
    """A word that only few of many rows hold is learnt wherever these rows are; so are thresholds."""
    ids = [k for k in range(1, 20000) if zlib.crc32(str(k).encode()) % 5 != 0][:9000]
    rare = set(ids[::300])
    docs = docs_of([(k, "rotten words" if k in rare else "plain words" if k % 9 else "idiot words") for k in ids])
    labels = spark.createDataFrame([(k, int(k in rare or k % 9 == 0)) for k in ids], "doc_id long, toxic int")
    taught, judged = spark.sparkContext.accumulator(0), []
    cut, limit = toxicity._cut, toxicity.thresholds

    def counted(batches, most):
        for shard, texts, y in cut(batches, most):
            taught.add(len(y))
            yield shard, texts, y

    monkeypatch.setattr(toxicity, "_cut", counted)
    monkeypatch.setattr(toxicity, "EPOCHS", 6)
    monkeypatch.setattr(toxicity, "thresholds", lambda s, y, w, lang: judged.append(w.sum()) or limit(s, y, w, lang))
    model, _ = toxicity.fit(docs, labels)
    assert judged[0] > 1500 and taught.value + judged[0] * toxicity.EPOCHS == 9000 * toxicity.EPOCHS
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert all((scores[k] >= 0.5) == (k in rare or k % 9 == 0) for k in ids)


def test_resampling_takes_the_largest_keys(spark, docs_of):
    rnd = random.Random(2)
    good = [(k, " ".join(rnd.choice(["the", "fine", "text"]) for _ in range(30))) for k in range(60)]
    bad = [(100 + k, " ".join(rnd.choice(["!!", "JUNK", "%%"]) for _ in range(30))) for k in range(40)]
    docs = docs_of(good + bad + [(900, None), (901, "")])
    out = resampling.resample(docs, docs.where("doc_id < 30"), 0.6).collect()
    assert sum(r.selected for r in out) == round(0.6 * len(out))
    cut = min(r.gumbel_key for r in out if r.selected)
    assert all(r.selected == (r.gumbel_key >= cut) for r in out)
    assert sum(r.selected for r in out if r.doc_id < 100) >= 57 and not any(r.selected for r in out if 100 <= r.doc_id < 900)
    assert {r.log_weight for r in out if r.doc_id >= 900} == {0.0}
    assert resampling.resample(docs.limit(0), docs.limit(0), 0.5).count() == 0


def test_resampling_weights_against_counts(docs_of):
    import collections
    import re
    rows = [(1, "a b, a"), (2, "b b"), (3, "a;; c")]
    docs = docs_of(rows)
    counts = resampling.count_ngrams(docs, docs.where("doc_id = 1"))

    def grams(text):
        one = re.findall(r"\w+|[^\w\s]+", text)
        return one + list(zip(one, one[1:]))

    raw, target = (collections.Counter(g for i, t in rows if i in ids for g in grams(t)) for ids in ({1, 2, 3}, {1}))
    assert sorted(counts[0][counts[0] > 0]) == sorted(raw.values())
    assert sorted(counts[1][counts[1] > 0]) == sorted(target.values())


def test_kth_largest_by_refined_bins(spark, monkeypatch):
    monkeypatch.setattr(resampling, "FEW", 5)
    monkeypatch.setattr(resampling, "BINS", 4)
    values = [float(x) for x in np.random.default_rng(3).normal(size=300)] + [2.0] * 50
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 7, 40, 51, 200, 350):
        assert resampling.kth_largest(df, "v", k) == sorted(values, reverse=True)[k - 1]
    assert resampling.kth_largest(df, "v", 0) is None


def test_secret_scan(spark, docs_of):
    rnd = random.Random(1)

    def hexes(n):
        return "".join(rnd.choice("0123456789abcdef") for _ in range(n))

    rows = [(k, f"some plain words password=a1{hexes(16)} more words") for k in range(40)]
    rows += [(100 + k, f"plain text {'wordsandwords' * 2} and {rnd.randint(10 ** 15, 10 ** 16 - 1)} text") for k in range(40)]
    rows += [(900, None), (901, ""), (902, "x" * 20_000), (903, "plain token = \"9" + hexes(39) + "\" text")]
    out = secrets.scan(docs_of(rows)).collect()
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    assert all(r.is_secret for k in range(40) for r in by[k]) and all(len(by[k]) == 1 for k in range(40))
    assert not any(r.is_secret for k in range(100, 140) for r in by[k])
    assert by[903][0].is_secret and by[903][0].word_no == 3 and 900 not in by and 901 not in by
    assert len(by[902]) == 1
    assert secrets.scan(docs_of(rows).limit(0)).count() == 0


def test_secret_candidates_inside_words(spark, docs_of):
    ghp, hexed = "ghp_" + "aB3dE6" * 6, "a1b2c3d4e5f60718"
    long = ["k9" * 9, "m7" * 9]
    cases = {1: (f"see https://h.example/cb?token={ghp}&u=1 now", [ghp]), 2: (f'{{"token":"{ghp}","id":5}}', [ghp]),
             3: (f"https://bob:{ghp}@github.com", [ghp]), 4: (f"password={hexed};host=db1", [hexed]),
             5: (f"a={long[0]},b={long[1]}", long), 6: (".".join([*long, hexed]), [*long, hexed]),
             7: ("password=Hunter2!xyz9", ["Hunter2!xyz9"]), 8: ('the "password": "Hun&ter2" here', ["Hun&ter2"]),
             9: ("https://bob:s3cr!t@db.example/x", ["s3cr!t"]), 10: ("the word token itself, password tokens and key=value", []),
             11: (f"api_key={hexed},next={long[0]}", [hexed, long[0]]), 12: ("aws_secret_access_key=x7", ["aws_secret_access_key", "x7"])}
    got = secrets.candidates(docs_of([(k, t) for k, (t, _) in cases.items()])).orderBy("id", "word_no", "run_no").collect()
    assert {k: [r.value for r in got if r.id == k] for k in cases} == {k: v for k, (_, v) in cases.items()}
    assert len({(r.id, r.word_no, r.run_no) for r in got}) == len(got)
    label = {(r.id, r.value): r.label for r in secrets.known_findings(spark.createDataFrame(got)).collect()}
    assert all(label[k, ghp] == 1 for k in (1, 2, 3)) and label[11, hexed] == 1 and label[11, long[0]] is None
    assert label[7, "Hunter2!xyz9"] == 1 and label[12, "aws_secret_access_key"] == 0


def test_dictionary_covers_long_words(spark, docs_of):
    docs = docs_of([(k, "the configuration parameters of internationalizations") for k in range(3)])
    words = secrets.dictionary(docs)
    assert {r.entry for r in words.collect()} == {"the", "configuration", "parameters"}
    values = ["configuration/parameters", "Configuration9theta/the-config", "x9y8z7x9y8z7x9y8", "theparameters/theparameters"]
    got = {r.value: r.covered for r in secrets.coverage(spark.createDataFrame([(v,) for v in values * 2], "value string"),
                                                        words).collect()}
    assert got == {values[0]: 23, values[1]: 19, values[3]: 26}
