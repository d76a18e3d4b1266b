"""Filter audit, hard-negative mining and packing against brute force."""

import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import filter_audit, hard_negatives, packing
from quarry.llm import textnum as tn

# -- filter audit ----------------------------------------------------------------------------------------------------


def _plain_audit(rows, good, toxic):
    """Rows (id, text, lang) filtered order by order, as the definition says."""
    smallest = {}
    for i, text, _ in rows:
        if i is not None:
            smallest[text or ""] = min(smallest.get(text or "", i), i)
    parts = defaultdict(list)
    for i, text, lang in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
                 "E": i is not None and smallest[t] < i}
        parts[lang or ""].append((fails, good.get(i, 0), toxic.get(i, 0)))
    out, shapley = [], defaultdict(int)
    for part, docs in parts.items():
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[0][f]]
                left = [d for d in left if not d[0][f]]
                shapley[part, f] += len(gone)
                out.append((part, "".join(order), step, len(left), len(gone), sum(d[0][f] for d in docs) - len(gone),
                            sum(d[0][f] and sum(d[0].values()) == 1 for d in docs), sum(d[1] for d in gone),
                            sum(d[2] for d in gone), f))
    return sorted((*r[:9], shapley[r[0], r[9]]) for r in out)


def test_audit_against_filters_applied_in_turn(spark):
    rnd = random.Random(4)
    long = " ".join(f"w{k}" for k in range(250))
    kinds = [long, long + " #", "a " * 300, "LOUD " * 250, "short", "", None, "É ß ẞ Ärger", "X", long.upper(), "tab\tand\x0bline $"]
    rows = [(k, rnd.choice(kinds), rnd.choice(["en", "de", "", None])) for k in range(120)]
    rows += [(None, long, "en"), (None, long, "en"), (3, rows[3][1], rows[3][2]), (7, rows[7][1], "fr"), (900, "only", "it")]
    good, toxic = {k: 1 for k in range(0, 120, 3)}, {k: 1 for k in range(0, 120, 7)}
    marks = [(k, good.get(k), toxic.get(k, 0)) for k in range(100)] + [(3, 0, 0), (3, 1, None), (None, 1, 1), (5000, 1, 1)]
    good, toxic = ({k: 1 for k in range(100) if g.get(k)} for g in (good, toxic))
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, lang string, kept int, part string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = sorted(tuple(r) for r in filter_audit.audit_documents(docs, labels).collect())
    assert got == _plain_audit(rows, good, toxic)
    assert filter_audit.audit_documents(docs.limit(0), labels).count() == 0
    assert filter_audit.audit_documents(docs, labels.limit(0)).where("good_lost + toxic_lost > 0").count() == 0


def test_diagrams_share_nodes_and_visit_every_order():
    orders, seen = list(range(5)), set()
    for level in filter_audit.all_orders(5):
        if level is not None:
            orders[level], orders[level + 1] = orders[level + 1], orders[level]
        seen.add(tuple(orders))
    assert len(seen) == 120 == sum(1 for _ in filter_audit.all_orders(5))
    flat = filter_audit.Diagram(np.ones((32, 3), np.int64))
    assert len(flat.child) == 6 and flat.weight[flat.root].tolist() == [32, 32, 32]
    counts = np.random.default_rng(2).integers(0, 9, (16, 3))
    turned = filter_audit.Diagram(counts)
    turned.swap(1)
    turned.swap(1)
    assert [(f, p.tolist(), q.tolist()) for f, p, q in turned.path()] == [
        (f, p.tolist(), q.tolist()) for f, p, q in filter_audit.Diagram(counts).path()]


@pytest.mark.parametrize("names", ["A", "AB", "ABCD"])
def test_audit_with_other_numbers_of_filters(names):
    n = len(names)
    counts = np.random.default_rng(n).integers(0, 5, (1 << n, 3))
    rows = filter_audit.audit_of(counts, names)
    assert len(rows) == n * len(set(r[0] for r in rows))
    for order, step, kept, removed, *_ in rows:
        before = [names.index(f) for f in order[:step - 1]]
        f = names.index(order[step - 1])
        reach = [m for m in range(1 << n) if not any(m >> b & 1 for b in before)]
        assert kept == sum(counts[m, 0] for m in reach if not m >> f & 1)
        assert removed == sum(counts[m, 0] for m in reach if m >> f & 1)


# -- hard negatives --------------------------------------------------------------------------------------------------


def _plain_mining(rows, is_anchor, n=5, least=80):
    good = {}
    for i, v, label in rows:
        if i is not None and v is not None and label is not None and all(x is not None and np.isfinite(x) for x in v):
            good[i, label, tuple(v)] = [int(np.floor(256 * x)) for x in v]
    out = []
    for (i, label, raw), a in good.items():
        if is_anchor(i):
            score = [(-sum(x * y for x, y in zip(a, b)), j, other) for (j, other, w), b in good.items()
                     if j != i and len(w) == len(raw)]
            score.sort()
            for p, j, _ in [s for s in score if s[2] == label][:n]:
                near = [s for s in score if s[2] != label and 80 * -p <= 100 * -s[0] <= 100 * -p] if least == 80 else []
                out += [(i, j, k + 1, s[1], -p, -s[0]) for k, s in enumerate(near[:n])]
    return sorted(out)


def _vectors(seed, n):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(5, 12))
    rows = [(k, [float(x) for x in np.float32(base[k % 5] + rng.normal(size=12) * (0.1 if k % 4 else 0.8))], int(rng.integers(0, 3)))
            for k in range(n)]
    rows += [(1000 + k, rows[0][1], k % 3) for k in range(40)]                # one vector many times: ties by id
    rows += [(2000, None, 1), (2010, [float("nan")] * 12, 1), (2020, [None] * 12, 1), (2030, rows[1][1], None),
             (None, rows[1][1], 1), (2040, [0.0] * 12, 1), (2050, [], 0), (2060, [], 0), (2061, [], 1), (2070, [1.0, 2.0], 0),
             (2071, [1.0, 2.0], 0), (2072, [1.0, 1.9], 2), (20, rows[3][1], 0), (20, rows[20][1], rows[20][2])]
    rows += rows[5:9]
    return rows


def test_mining_against_all_pairs(spark):
    rows = _vectors(3, 200)
    df = spark.createDataFrame([(*r, 5) for r in rows], "vec_id long, embedding array<double>, label int, rank int").repartition(5)
    for wave in (1000, 7):
        got = hard_negatives.mine(df, F.col("vec_id") % 10 == 0, wave=wave)
        assert sorted(tuple(r) for r in got.collect()) == _plain_mining(rows, lambda i: i % 10 == 0)
    assert hard_negatives.mine(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert hard_negatives.mine(df, F.lit(False)).count() == 0
    some = hard_negatives.mine(df, F.col("vec_id") % 50 == 0, label=F.lit(1)).count()
    assert some == 0                                                          # one label: no negatives


def test_bounds_spare_scores_and_lose_none():
    rng = np.random.default_rng(6)
    centre = rng.normal(size=(4, 16)) * 40
    vec = np.floor(centre[np.arange(600) % 4] + rng.normal(size=(600, 16)))
    label = np.arange(600) % 4
    anchors = hard_negatives.Anchors.of(np.arange(60), np.arange(60), label[:60], vec[:60])
    search = hard_negatives.Search(anchors, 5, 80)
    for lo in range(0, 600, 100):
        search.chunk(np.arange(lo, lo + 100), label[lo:lo + 100], np.arange(lo, lo + 100), vec[lo:lo + 100])
    number, _, ids, _, score = search.found()
    for k in range(60):
        s = [(-float(vec[k] @ vec[j]), j) for j in range(600) if j != k and label[j] == label[k]]
        assert sorted(s)[:5] == sorted(zip(-score[number == k], ids[number == k]))
    anchors.positives = np.array([sorted(score[number == k])[::-1] for k in range(60)])
    far = hard_negatives.Search(anchors, 5, 80)
    far.chunk(np.arange(600), label, np.arange(600), vec)
    assert far.scored < far.pairs / 2                                         # clusters: most pairs are only bounded


def test_spanning_tree_is_minimal():
    a = np.random.default_rng(8).normal(size=(9, 3))
    order, parent, length = hard_negatives.spanning_tree(a)
    gap = np.sqrt(((a[:, None] - a[None]) ** 2).sum(-1))
    group, total = list(range(9)), 0.0
    for d, i, j in sorted((gap[i, j], i, j) for i in range(9) for j in range(i)):
        if group[i] != group[j]:
            total += d
            group = [group[j] if g == group[i] else g for g in group]
    assert np.isclose(length.sum(), total) and sorted(order) == list(range(9))
    place = {int(k): at for at, k in enumerate(order)}
    assert all(place[int(parent[k])] < place[k] for k in range(9) if k != order[0])


# -- packing ---------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer(spark):
    import public_tokenizers
    return packing.load_tokenizer(spark, public_tokenizers.path("byte_bpe_50k.json"))


def _checked(pieces, docs, limits):
    """Pieces cover every document once and sequences hold the limits; the number of ids of every sequence."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for i, copies in docs.items():
        want = sorted((k, x) for ids in copies for k, x in enumerate(ids))
        assert sorted((p.start + k, x) for p in by_doc.pop(i, []) for k, x in enumerate(p.ids)) == want
    assert not by_doc
    out = []
    for held in by_sequence.values():
        held.sort(key=lambda p: p.offset)
        ends = list(itertools.accumulate(p.length for p in held))
        assert [p.offset for p in held] == [0, *ends[:-1]]
        assert ends[-1] <= limits.tokens and len(held) <= limits.segments and sum(p.loss_tokens for p in held) <= limits.loss
        out.append(ends[-1])
    for p in pieces:
        assert p.length == len(p.ids) and p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
    return out


def test_packed_texts(spark, docs_of, tokenizer):
    from tokenizers import Tokenizer
    own = Tokenizer.from_str(tokenizer.value)
    rnd = random.Random(5)
    words = ["alpha", "beta,", "l'été", "don't", "42", "  ", "\n", "x_1", "ünï", "中文", "🙂", "'re", " ", "\x1c", "A1-b2"]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.choice([1, 5, 60, 400, 3000]))) for _ in range(60)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(100, None), (101, ""), (102, texts[0]), (102, texts[0]), (103, "word" * 3000)]
    docs = docs_of(rows)
    pieces = packing.pack_texts(docs.repartition(3), tokenizer).collect()
    held = defaultdict(list)
    for i, t in rows:
        held[i].append([*own.encode(t or "", add_special_tokens=False).ids, 1])
    sizes = _checked(pieces, held, packing.Limits())
    assert all(n & (n - 1) == 0 for n in sizes) and sizes.count(2048) > len(sizes) - 40     # nothing to pad
    assert all(p.doc_tokens == len(held[p.doc_id][0]) for p in pieces)
    again = packing.pack_texts(docs.repartition(3), tokenizer, with_ids=False)
    assert "ids" not in again.columns and again.count() == len(pieces)
    assert packing.pack_texts(docs.limit(0), tokenizer).count() == 0
    whole = packing.sequences(packing.pack_texts(docs.repartition(3), tokenizer))
    assert whole.agg(F.sum("padding")).first()[0] == 0 and whole.where("size(ids) <> aggregate(lengths, 0, (a, x) -> a + x)").count() == 0


def test_long_texts_go_through_in_sections(tokenizer):
    rnd = random.Random(2)
    text = "".join(rnd.choice(["a", "Z", "é", " ", "\n", "'", "s", "7", "½", "　", "!", "中", "  ", "\x85", "ll"]) for _ in range(900_000))
    units = packing.Units(tokenizer.value)
    got = list(packing.text_ids(pa.array(["x", text, None]), units))
    assert got[1].tolist() == [*units.tokenizer.encode(text, add_special_tokens=False).ids, 1] and got[2].tolist() == [1]
    buf, off = tn.text_buffers(pa.array([text]))
    cuts = list(tn.sections(buf, 0, int(off[1])))
    assert len(cuts) > 3 and cuts[0][0] == 0 and cuts[-1][1] == off[1] and all(a[1] == b[0] for a, b in zip(cuts, cuts[1:]))
    assert list(tn.sections(np.zeros(10**6, np.uint8) + 97, 0, 10**6)) == [(0, 10**6)]


def test_units_with_one_hash_are_told_apart(tokenizer, monkeypatch):
    class Weak(tn.Hasher):
        def __call__(self, start, end):
            return super().__call__(start, end) % np.uint64(7)

    texts = pa.array(["the cat, the dog 12 and more words", "other words again; cats", None, "x"])
    want = [x.tolist() for x in packing.text_ids(texts, packing.Units(tokenizer.value))]
    monkeypatch.setattr(tn, "Hasher", Weak)
    units = packing.Units(tokenizer.value)
    assert [x.tolist() for x in packing.text_ids(texts, units)] == want
    monkeypatch.setattr(packing, "UNITS", 3)
    monkeypatch.setattr(packing.Units, "LATEST", 2)
    for _ in range(2):
        assert [x.tolist() for x in packing.text_ids(texts, units)] == want


def _plain_packing(examples, limits):
    """Whole examples by the dot-product rule with plain loops."""
    left, out = list(examples), []
    while left:
        room, held = [limits.tokens, limits.segments, limits.loss], []
        while True:
            best = None
            for e in left:
                need = (e[1], 1, e[2])
                if all(a <= b for a, b in zip(need, room)):
                    worth = sum(a * b / c**2 for a, b, c in zip(need, room, (limits.tokens, limits.segments, limits.loss)))
                    if best is None or worth > best[0] + 1e-12:
                        best = (worth, e)
            if best is None:
                break
            held.append(best[1])
            left.remove(best[1])
            room = [a - b for a, b in zip(room, (best[1][1], 1, best[1][2]))]
        if not held:
            held.append(left.pop(0))
        out.append([e[0] for e in held])
    return out


def test_whole_examples_by_the_dot_product_rule(spark):
    rnd = random.Random(9)
    limits = packing.Limits(tokens=100, segments=4, loss=40)
    examples = []
    for k in range(80):
        n = rnd.randint(1, 60)
        examples.append((k, list(range(n)), [int(rnd.random() < 0.4) for _ in range(n)]))
    examples += [(80, list(range(300)), [0] * 300), (81, [5] * 50, None)]
    schema = "doc_id long, ids array<int>, loss array<int>, length string"
    df = spark.createDataFrame([(*e, "x") for e in examples] + [(82, [], [], "x"), (83, None, None, "x")], schema).coalesce(1)
    pieces = packing.pack_examples(df, loss_col="loss", limits=limits, cut=False).collect()
    got = defaultdict(list)
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        got[p.sequence_id].append(p.doc_id)
    want = _plain_packing([(i, len(x), len(x) if m is None else sum(m)) for i, x, m in examples], limits)
    assert [got[k] for k in sorted(got)] == want and all(p.start == 0 and p.length == p.doc_tokens for p in pieces)
    cut = packing.pack_examples(df, loss_col="loss", limits=limits).collect()
    sizes = _checked(cut, {i: [x] for i, x, _ in examples}, limits)
    assert all(n == 100 or n & (n - 1) == 0 for n in sizes)
    with pytest.raises(ValueError):
        packing.Packer(packing.Limits(tokens=0), True)
