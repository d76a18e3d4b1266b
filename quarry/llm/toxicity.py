"""Operator 4: toxicity by a convolutional text classifier trained in numpy.

A word is the mean of hashed embeddings of the word and its prefixes; filters of
several widths run over the words of the whole text, the maximum of each filter
over the text goes into a logistic unit.  Training is Adam on all labelled rows outside
fold 0: in an epoch each shard of the rows steps from the same parameters, and the
changes are averaged, each over the shards that made one.  Only the places of the maxima
get a gradient, so a step costs little more than the forward pass.

Scores use the text alone.  Decisions may use a threshold per language, chosen
on a held-back fifth of the labelled rows; languages with few labels use the common one.

Defined cases: null or empty texts (or without words) get the score that the
classifier gives to no words; labels that are null aren't used; with one class or no labels
every score is the share of class 1 (0 without labels); repeated rows are scored
each; other columns are ignored, whatever their names; an empty table gives an
empty table.
"""

from __future__ import annotations

import dataclasses
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import textnum as tn
from quarry.llm.common import small_batches
from quarry.session import drop_table, write_table

SLOTS = 1 << 15
SIZE = 16
FILTERS = 8
WIDTHS = (1, 2, 3)
PREFIXES = (3, 4, 5, 6)
SHARD_ROWS = 4000     # labelled rows of a shard, until there are MOST_SHARDS
MOST_SHARDS = 64
CHUNKS = 16           # pieces of the parameters that are averaged apart
MARKS_BYTES = 96 << 20       # ids of labelled rows that are sent to all tasks, at most; more are joined by a shuffle
MARKS_ROW = 256       # ids of a row of them, about
EPOCHS = 6
STEPS = np.linspace(0.2, 0.9, 15)     # thresholds to choose from
BATCH_BYTES = 1 << 16
WORDS_AT_ONCE = 1 << 16
LEAST_STEPS = 64       # batches of an epoch at least, so small samples are learnt as well
_WORD_BYTES = tn.byte_table(lambda b: b >= 128 or chr(b).isalnum())


def _lower(buf: np.ndarray) -> np.ndarray:
    """ASCII letters and Latin-1 letters in lower case."""
    low = tn.LOWER[buf]
    wide = np.zeros(len(low), bool)
    wide[1:] = (low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] <= 0x9E) & (low[1:] != 0x97)
    low[wide] += 32
    return low


def features(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of every word (the word and its prefixes; -1 where the word is shorter) and its row."""
    low, parts, rows = _lower(buf), [np.zeros((0, 1 + len(PREFIXES)), np.int32)], [np.zeros(0, np.int64)]
    for lo, hi in tn.runs(low, _WORD_BYTES):
        start, end, row = tn.word_spans(low[lo:hi], np.clip(off, lo, hi) - lo, _WORD_BYTES)
        if not len(start):
            continue
        h = tn.Hasher(low[lo:hi])
        out = np.empty((len(start), 1 + len(PREFIXES)), np.int32)
        out[:, 0] = h(start, end) % np.uint64(SLOTS)
        for k, n in enumerate(PREFIXES):
            cut = np.minimum(start + n, end)
            out[:, 1 + k] = np.where(end - start > n, (h(start, cut) ^ np.uint64(n)) % np.uint64(SLOTS), -1)
        parts.append(out)
        rows.append(row)
    return np.concatenate(parts), np.concatenate(rows)


@dataclasses.dataclass
class Model:
    words: np.ndarray                # SLOTS + 1 rows; the last one stays zero
    filters: list[np.ndarray]        # for each width: (width, SIZE, FILTERS)
    filter_bias: np.ndarray          # all filters
    weight: np.ndarray
    bias: float
    constant: float | None = None    # the score, if there was nothing to learn

    def pooled(self, slots: np.ndarray, row: np.ndarray, rows: int):
        """Maxima of all filters by text, and the word where each was found (-1: none above zero)."""
        found = np.zeros((rows, len(self.weight)), np.float32)
        where = np.full((rows, len(self.weight)), -1)
        if not len(row):
            return found, where
        share = 1.0 / (slots >= 0).sum(axis=1, dtype=np.float32)
        e = self.words[slots[:, 0]].copy()
        for k in range(1, slots.shape[1]):
            e += self.words[slots[:, k]]
        e *= share[:, None]
        at = tn.segment_starts(row)
        has = row[at]
        length = np.diff(np.append(at, len(row)))
        for w, f in enumerate(self.filters):
            z = e @ f[0]
            for o in range(1, len(f)):
                if len(row) > o:
                    z[:-o] += (e[o:] @ f[o]) * (row[o:] == row[:-o])[:, None]
            z += self.filter_bias[w * FILTERS:(w + 1) * FILTERS]
            top = np.maximum.reduceat(z, at, axis=0)
            cols = slice(w * FILTERS, (w + 1) * FILTERS)
            found[has, cols] = np.maximum(top, 0)
            hit = z == np.repeat(top, length, axis=0)
            for c in range(FILTERS):
                place = np.flatnonzero(hit[:, c])
                first = place[np.searchsorted(place, at)]
                where[has, w * FILTERS + c] = np.where(top[:, c] > 0, first, -1)
        return found, where

    def score(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        rows = len(off) - 1
        if self.constant is not None:
            return np.full(rows, self.constant)
        slots, row = features(buf, off)
        z = self.maxima(slots, row, rows) @ self.weight + self.bias
        return 1.0 / (1.0 + np.exp(-z.astype(np.float64)))

    def maxima(self, slots: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        """As ``pooled`` without the places; running maxima over parts of WORDS_AT_ONCE words, whatever the texts' lengths."""
        found = np.zeros((rows, len(self.weight)), np.float32)
        for lo in range(0, len(row), WORDS_AT_ONCE):
            n = min(WORDS_AT_ONCE, len(row) - lo)
            own, of = slots[lo:lo + n + len(self.filters[-1]) - 1], row[lo:lo + n + len(self.filters[-1]) - 1]
            share = 1.0 / (own >= 0).sum(axis=1, dtype=np.float32)
            e = self.words[own[:, 0]].copy()
            for k in range(1, own.shape[1]):
                e += self.words[own[:, k]]
            e *= share[:, None]
            at = tn.segment_starts(of[:n])
            for w, f in enumerate(self.filters):
                z = e @ f[0]
                for o in range(1, len(f)):
                    if len(of) > o:
                        z[:-o] += (e[o:] @ f[o]) * (of[o:] == of[:-o])[:, None]
                cols = slice(w * FILTERS, (w + 1) * FILTERS)
                top = np.maximum.reduceat(z[:n], at, axis=0) + self.filter_bias[cols]
                found[of[at], cols] = np.maximum(found[of[at], cols], top)
        return found


class _Adam:
    """Adam; ``rows`` restricts a step to some rows of the parameter."""

    def __init__(self, p: np.ndarray, rate: float):
        self.p, self.rate, self.t = p, rate, 0
        self.m, self.v = np.zeros_like(p), np.zeros_like(p)

    def step(self, g: np.ndarray, rows=slice(None)) -> None:
        self.t += 1
        m = self.m[rows] = 0.9 * self.m[rows] + 0.1 * g
        v = self.v[rows] = 0.99 * self.v[rows] + 0.01 * g * g
        self.p[rows] -= self.rate * m / (np.sqrt(v) + 1e-6)


def fresh(share: float, seed: int = 5) -> Model:
    """The classifier before training, for a share of class 1."""
    rng = np.random.default_rng(seed)
    n_filters = FILTERS * len(WIDTHS)
    words = np.zeros((SLOTS + 1, SIZE), np.float32)
    words[:-1] = rng.normal(0, 0.1, (SLOTS, SIZE))
    model = Model(words, [rng.normal(0, 0.4 / np.sqrt(w), (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS],
                  np.zeros(n_filters, np.float32), rng.normal(0, 0.3, n_filters).astype(np.float32), 0.0)
    if share in (0.0, 1.0):
        model.constant = share
    else:
        model.bias = float(np.log(share / (1 - share)))
    return model


def _flat(model: Model) -> np.ndarray:
    return np.concatenate([model.words.ravel(), *[f.ravel() for f in model.filters], model.filter_bias, model.weight, [model.bias]]).astype(np.float32)


def _shaped(flat: np.ndarray) -> Model:
    shapes = [(SLOTS + 1, SIZE), *[(w, SIZE, FILTERS) for w in WIDTHS], (FILTERS * len(WIDTHS),), (FILTERS * len(WIDTHS),)]
    cuts = np.cumsum([int(np.prod(shape)) for shape in shapes])
    parts = [part.reshape(shape).copy() for part, shape in zip(np.split(flat, cuts)[:-1], shapes)]
    return Model(parts[0], parts[1:-2], parts[-2], parts[-1], float(flat[-1]))


def step_through(model: Model, batches: Iterator[tuple[pa.Array, np.ndarray]]) -> Model:
    """``model`` after an Adam step on each of ``batches`` (texts, labels)."""
    words, bias = model.words, np.array([model.bias], np.float32)
    adam_words, adam_weight, adam_bias = _Adam(words, 0.01), _Adam(model.weight, 0.01), _Adam(bias, 0.01)
    adam_filters = [_Adam(f, 0.005) for f in model.filters]
    adam_fb = _Adam(model.filter_bias, 0.005)
    for texts, y in batches:
        slots, row = features(*tn.text_buffers(texts))
        found, where = model.pooled(slots, row, len(y))
        z = found @ model.weight + bias[0]
        gz = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        gp = gz[:, None] * model.weight[None, :] * (where >= 0)
        adam_weight.step(found.T @ gz + 1e-5 * model.weight)
        adam_bias.step(np.array([gz.sum()], np.float32))
        adam_fb.step(gp.sum(axis=0))
        touched, change = [], []
        share_of = 1.0 / np.maximum(1, (slots >= 0).sum(axis=1)).astype(np.float32)
        for w, f in enumerate(model.filters):
            gf = np.zeros_like(f)
            cols = np.arange(w * FILTERS, (w + 1) * FILTERS)
            r, c = np.nonzero(where[:, cols] >= 0)
            place, g = where[r, cols[c]], gp[r, cols[c]]
            for o in range(len(f)):
                p = place + o
                ok = (p < len(row)) & (row[np.minimum(p, len(row) - 1)] == r)
                p, cc, gg = p[ok], c[ok], g[ok]
                s = slots[p]
                e = words[s].sum(axis=1) * share_of[p][:, None]
                np.add.at(gf[o].T, cc, e * gg[:, None])
                ge = f[o][:, cc].T * (gg * share_of[p])[:, None]
                for k in range(s.shape[1]):
                    has = s[:, k] >= 0
                    touched.append(s[has, k])
                    change.append(ge[has])
            adam_filters[w].step(gf)
        if touched:
            slot, inverse = np.unique(np.concatenate(touched), return_inverse=True)
            g = np.zeros((len(slot), SIZE), np.float32)
            np.add.at(g, inverse, np.concatenate(change))
            adam_words.step(g, slot)
    model.bias = float(bias[0])
    return model


def _cut(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(shard, texts, labels) of about ``most`` bytes from rows (shard, text, y) that are sorted by shard."""
    held, size, shard = [], 0, None
    for batch in batches:
        length = np.diff(tn.text_buffers(batch.column(1))[1])
        shards = batch.column(0).to_numpy()
        for k in range(batch.num_rows):
            if held and (shards[k] != shard or size >= most):
                yield shard, *_joined(held)
                held, size = [], 0
            shard = int(shards[k])
            size += int(length[k])
            held.append((batch, k))
    if held:
        yield shard, *_joined(held)


def _joined(rows: list[tuple[pa.RecordBatch, int]]) -> tuple[pa.Array, np.ndarray]:
    parts = [batch.slice(k, 1) for batch, k in rows]
    return pa.concat_arrays([p.column(1) for p in parts]), np.concatenate([p.column(2).to_numpy() for p in parts]).astype(np.float32)


def train(rows: DataFrame, model: Model, most: int, epochs: int = EPOCHS) -> Model:
    """Fit the classifier to ``rows`` (shard, text, y), each file sorted by shard, in batches of about ``most`` bytes."""
    context = rows.sparkSession.sparkContext
    for _ in range(epochs):
        begin = _flat(model)
        shared = context.broadcast(begin)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, own in itertools.groupby(_cut(batches, most), key=lambda b: b[0]):
                change = _flat(step_through(_shaped(shared.value), (b[1:] for b in own))) - shared.value
                for k, part in enumerate(np.array_split(change, CHUNKS)):
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["k", "v"])

        def mean(table: pa.Table) -> pa.Table:
            total, count = 0.0, 0
            for v in table.column("v"):
                part = np.frombuffer(v.as_buffer(), np.float32)
                total, count = total + part.astype(np.float64), count + (part != 0)
            out = (total / np.maximum(count, 1)).astype(np.float32)
            return pa.table({"k": table.column("k").slice(0, 1).combine_chunks(), "v": pa.array([out.tobytes()], pa.binary())})

        made = rows.select("shard", "text", "y").mapInArrow(run, "k int, v binary").groupBy("k").applyInArrow(mean, "k int, v binary")
        found = {r["k"]: np.frombuffer(r["v"], np.float32) for r in made.collect()}       # one model
        shared.destroy()
        model = _shaped(begin + np.concatenate([found[k] for k in range(CHUNKS)]))
    return model


def _in_fold(id_col: str) -> Column:
    """0 to 4 by crc32 of the id as text; 0 is never learnt from."""
    return F.pmod(F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))), F.lit(5))


def labelled(docs: DataFrame, marks: DataFrame) -> tuple[DataFrame, int]:
    """(rows of ``docs`` (_id, ...) whose id has a row in ``marks`` (_id, y), with that y; the number of marks).

    The marks go to the texts as lists of ids by a hash, so that texts without a label aren't shuffled.
    """
    word = F.col("_id").cast("string")
    n, size = marks.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(word) + F.lit(8)), F.lit(0))).first()
    if size > MARKS_BYTES:
        return docs.join(marks, "_id"), n
    group = F.pmod(F.xxhash64(word), F.lit(max(1, n // MARKS_ROW))).cast("int").alias("_g")
    lists = marks.groupBy(group).agg(*[F.collect_list(F.when(F.col("y") == y, F.col("_id"))).alias(f"_y{y}") for y in (0, 1)])
    found = F.when(F.array_contains("_y0", F.col("_id")), 0).when(F.array_contains("_y1", F.col("_id")), 1)
    given = docs.where("_id IS NOT NULL").select("*", group).join(F.broadcast(lists), "_g").withColumn("y", found)
    return given.where("y IS NOT NULL").drop("_g", "_y0", "_y1"), n


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        lang_col: str | None = "lang") -> tuple[Model, dict[str, float]]:
    """(classifier, thresholds by language) from all labelled rows outside fold 0, whole texts.

    A fifth of them, by a hash of the id, is held back from training to choose the thresholds.
    """
    lang = F.col(f"`{lang_col}`") if lang_col and lang_col in docs.columns else F.lit(None).cast("string")
    marks = labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label_col}`").cast("int").alias("y")).where(
        F.col("y").isin(0, 1) & F.col("_id").isNotNull() & (F.pmod(F.crc32(F.col("_id").cast("string")), F.lit(5)) != 0))
    marks = marks.groupBy("_id").agg(F.max("y").alias("y"))
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"), lang.alias("lang"))
    rows, n = labelled(rows, marks)
    rows = rows.withColumn("_o", F.xxhash64("_id", F.lit("fit"))).withColumn("back", F.pmod(F.xxhash64("_id", F.lit("back")), F.lit(5)) == 4)
    shards = max(1, min(MOST_SHARDS, n // SHARD_ROWS))
    rows = write_table(rows.withColumn("shard", F.pmod(F.col("_o"), F.lit(shards)).cast("int")).repartition(shards, "shard")
                       .sortWithinPartitions("shard", "_o", "_id"), "labelled")
    seen = {(r["back"], r["y"]): r for r in rows.groupBy("back", "y").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("size")).collect()}
    both = {y for _, y in seen}
    if {y for back, y in seen if not back} == both:
        learn, of = rows.where("not back"), [r for (back, _), r in seen.items() if not back]
    else:                                          # too few to hold any back
        learn, of = rows, list(seen.values())
    total = sum(r["n"] for r in of)
    model = fresh(sum(r["n"] for r in of if r["y"] == 1) / total if total else 0.0)
    limits = F.array(*[F.lit(float(t)) for t in STEPS])
    passed = F.size(F.filter(limits, lambda t: F.col("score") >= t))          # how many thresholds a row reaches
    with small_batches(docs.sparkSession):
        if model.constant is None:
            model = train(learn, model, max(1, min(BATCH_BYTES, sum(r["size"] for r in of) // shards // LEAST_STEPS)))
        judged = score(rows.where("back"), model, also=("y", "lang")).groupBy(F.coalesce("lang", F.lit("")).alias("lang"), "y", passed.alias("k")).agg(
            F.count(F.lit(1)).alias("n")).collect()
    drop_table(rows)
    reached = np.concatenate([[-1.0], STEPS])
    return model, thresholds(reached[[r["k"] for r in judged]] if judged else np.zeros(0), np.array([r["y"] for r in judged]),
                             np.array([float(r["n"]) for r in judged]), np.array([r["lang"] for r in judged], dtype=object))


def _scores(model: Model, texts: pa.Array) -> Iterator[np.ndarray]:
    buf, off = tn.text_buffers(texts)
    for lo, hi in tn.pieces(off):
        yield model.score(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])


def thresholds(score: np.ndarray, label: np.ndarray, weight: np.ndarray, lang: np.ndarray, least: int = 10) -> dict[str, float]:
    """For each language the threshold with the best F1 (ties: nearest 0.5); '' holds the common one.  ``weight`` counts rows."""
    def best(s: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
        choice = (-1.0, 0.0, 0.5)
        for t in STEPS:
            hit = s >= t
            tp, wrong = (w * (hit & (y == 1))).sum(), (w * (hit != (y == 1))).sum()
            f1 = 2 * tp / (2 * tp + wrong) if tp else 0.0
            choice = max(choice, (f1, -abs(t - 0.5), float(t)))
        return choice[2]
    out = {"": best(score, label, weight) if len(label) else 0.5}
    for g in sorted(set(lang)):
        m = lang == g
        if g and all(weight[m & (label == y)].sum() >= least for y in (0, 1)):
            out[g] = best(score[m], label[m], weight[m])
    return out


def score(docs: DataFrame, model: Model, text_col: str = "text", also: tuple[str, ...] = ("doc_id",),
          to: str = "score") -> DataFrame:
    """The columns ``also`` of ``docs`` and, in ``to``, the score of every whole text, which goes to the workers once."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rest = [c for c in also if c != to]
    at = rest.index(text_col) if text_col in rest else len(rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tn.slices(batches, at):
            s = np.concatenate([np.zeros(0), *_scores(shared.value, batch.column(at))])
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(rest)], pa.array(s)], names=[*rest, to])

    given = docs.select(*[F.col(f"`{c}`") for c in rest], *[F.col(f"`{text_col}`").alias("_scored")][:at == len(rest)])
    return given.mapInArrow(run, T.StructType([*given.schema.fields[:len(rest)], T.StructField(to, T.DoubleType())]))


def threshold_of(lang: Column, limits: dict[str, float]) -> Column:
    """The threshold of a row's language."""
    out = F.lit(limits[""])
    for g, t in limits.items():
        if g:
            out = F.when(lang == g, F.lit(t)).otherwise(out)
    return out
