"""Operator 9: benchmark decontamination by winnowing (DataFrame functions only).

Words are hashed, every run of K words (k-gram) gets a hash, and of each window
of WINDOW consecutive k-grams the smallest hash is kept with its place.  Two
texts that share a span of K + WINDOW - 1 words, the length of a benchmark
window here, keep the same k-gram of it, so a join of the kept hashes misses no
shared window.  Hits are extended by comparing the words themselves around the
k-gram: of each document the few words around the places that were hit, once for each
place, however many items hit it.  Items of fewer words are one window; the lengths that
occur (at most nine) are looked up by the hash of so many words.

A benchmark is broadcast only within BROADCAST_ROWS texts, names and kept
k-grams and BROADCAST_WORDS words, all counted; beyond that its joins shuffle.

Defined cases: null or empty texts have no words; rows of documents equal in id
and text get the same result; rows equal in id alone are told apart by their
text's hash; items sharing an id count once; items without an id mark words but
aren't listed; other columns are ignored, whatever their names; with an empty
benchmark nothing is hit; empty documents give an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import small_enough, written

SPAN = 10          # words of a benchmark window
K = 5              # words of a hashed k-gram
WINDOW = SPAN - K + 1
PLACE_BITS = 30    # of a kept value for the place; a text of 2 GB has fewer words
BEFORE = SPAN - K  # words of a window that may stand ahead of its k-gram
BROADCAST_ROWS = 200_000
BROADCAST_WORDS = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def _fingerprints(df: DataFrame) -> DataFrame:
    """``df`` (with an array ``words``) and ``prints``: kept values, hash above and place (from 0) below."""
    n = F.size("words")
    df = df.withColumn("_h", F.transform("words", lambda w: F.xxhash64(w)))
    df = df.withColumn("_g", F.when(n >= SPAN, F.transform(
        F.sequence(F.lit(0), F.size("_h") - K),
        lambda i: F.shiftleft(F.xxhash64(*[F.get(F.col("_h"), i + j) for j in range(K)]), PLACE_BITS) + i)))
    least = F.transform(F.sequence(F.lit(0), F.size("_g") - WINDOW),
                        lambda i: F.least(*[F.get(F.col("_g"), i + j) for j in range(WINDOW)]))
    return df.withColumn("prints", F.when(n >= SPAN, F.array_distinct(least))).drop("_h", "_g")


def _around(words: Column, at: Column) -> Column:
    """The words that windows over the k-gram at place ``at`` can hold: from BEFORE words ahead of it on."""
    return F.slice(words, F.greatest(at - BEFORE, F.lit(0)) + 1, F.lit(SPAN) + F.least(at, F.lit(BEFORE)))


def _split_print(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*keep, F.explode("prints").alias("_v")).select(
        *keep, F.shiftright("_v", PLACE_BITS).alias("print"), F.col("_v").bitwiseAND((1 << PLACE_BITS) - 1).cast("int").alias("at"))


def benchmark_index(items: DataFrame, item_col: str = "item_id", item_text_col: str = "text") -> tuple[DataFrame, DataFrame, bool]:
    """(places, names, small) of a benchmark: equal texts stand for all their items.

    ``places`` (item_no, item_at, print, length, item_around): the kept k-grams of long texts,
    and texts of under SPAN words whole; ``names`` (item_no, item).  ``small``: both are within
    BROADCAST_ROWS rows, and the words that they hold within BROADCAST_WORDS.
    """
    given = items.select(F.col(f"`{item_col}`").cast("string").alias("item"),
                         words_of(F.col(f"`{item_text_col}`")).alias("words")).where(F.size("words") > 0)
    given = written(given.select("item", "words", F.xxhash64("words").alias("h1"), F.xxhash64(F.lit(5), "words").alias("h2")), "winnow-given")
    texts = given.drop("item").dropDuplicates(["h1", "h2"]).withColumn("item_no", F.monotonically_increasing_id())
    texts = written(_fingerprints(texts), "winnow-items")
    names = written(given.select("item", "h1", "h2").join(texts.select("h1", "h2", "item_no"), ["h1", "h2"])
                    .select("item_no", "item").distinct(), "winnow-names")
    long = (_split_print(texts, "item_no", "words").withColumn("length", F.lit(K))
            .select("item_no", F.col("at").alias("item_at"), "print", "length", _around(F.col("words"), F.col("at")).alias("item_around")))
    short = texts.where(F.size("words") < SPAN).select(
        "item_no", F.lit(0).alias("item_at"), F.xxhash64("words").alias("print"), F.size("words").alias("length"),
        F.col("words").alias("item_around"))
    places = written(long.unionByName(short), "winnow-places")
    n_names = names.count()
    n_places, n_words = places.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("item_around")), F.lit(0))).first()
    return places, names, max(n_names, n_places) <= BROADCAST_ROWS and n_words <= BROADCAST_WORDS


def contaminated_words(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document row: id, n_words, n_hit, n_items, items (sorted strings), contaminated."""
    key = ["_id", "_hash"]
    given = docs.select(F.col(f"`{id_col}`").alias("_id"), F.xxhash64(F.col(f"`{text_col}`")).alias("_hash"),
                        F.col(f"`{text_col}`").alias("_text"))
    tokens = _fingerprints(given.select(*key, words_of(F.col("_text")).alias("words")))
    index = written(tokens.select(*key, F.size("words").cast("long").alias("n_words"), "prints"), "winnow-docs")
    places, names, small = benchmark_index(items, item_col, item_text_col)

    def bounded(df: DataFrame) -> DataFrame:       # a shuffle join for larger benchmarks
        return F.broadcast(df) if small else df

    is_short = F.size("item_around") < SPAN        # around a place of a long text there are at least SPAN words
    long = places.where(~is_short).select("print", "item_no", "item_at")
    hits = (_split_print(index, *key).join(bounded(long), "print")
            .select(*key, "at", "item_no", "item_at", F.lit(K).alias("length")))
    lengths = [r[0] for r in places.where(is_short).select("length").distinct().collect()]
    if lengths:                                    # at most SPAN - 1 of them
        short = places.where(is_short).select("item_no", "length", "print")
        grams = given.select(*key, words_of(F.col("_text")).alias("words")).select(
            *key, "words", F.explode(F.array(*map(F.lit, lengths))).alias("length")).where(F.size("words") >= F.col("length"))
        runs = F.transform(F.sequence(F.lit(0), F.size("words") - F.col("length")), lambda i: F.struct(
            i.alias("at"), F.xxhash64(F.slice(F.col("words"), i + 1, F.col("length"))).alias("print")))
        found = grams.select(*key, "length", F.explode(runs).alias("_r")).select(*key, "length", "_r.at", "_r.print")
        hits = hits.unionByName(found.join(bounded(short), ["length", "print"])
                                .select(*key, "at", "item_no", F.lit(0).alias("item_at"), "length"))
    hits = written(hits.distinct(), "winnow-hits")

    # Words leave a document once: the few around each place that was hit.
    at_of = written(hits.groupBy(*key).agg(F.collect_set("at").alias("ats")).withColumnsRenamed({"_id": "_i", "_hash": "_h"}), "winnow-at")
    slices = F.transform("ats", lambda p: F.struct(p.alias("at"), _around(F.col("words"), p).alias("around")))
    around = (given.join(small_enough(at_of, BROADCAST_ROWS, F.size("ats")),
                         F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_hash") == F.col("_h")))
              .select("_i", "_h", "ats", words_of(F.col("_text")).alias("words"))
              .select("_i", "_h", F.explode(slices).alias("_s")).select("_i", "_h", F.col("_s.at").alias("_at"), "_s.around"))
    around = written(around.dropDuplicates(["_i", "_h", "_at"]), "winnow-around")
    pairs = (hits.join(around, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_hash") == F.col("_h")) & (F.col("at") == F.col("_at")))
             .join(bounded(places.drop("print")), ["item_no", "item_at", "length"]))
    here, there = F.least(F.col("at"), F.lit(BEFORE)), F.least(F.col("item_at"), F.lit(BEFORE))
    span = F.when(is_short, F.col("length")).otherwise(F.lit(SPAN))
    first = F.greatest(-here, -there, F.col("length") - F.col("_span"))
    last = F.least(F.lit(0), F.size("around") - F.col("_span") - here, F.size("item_around") - F.col("_span") - there)
    starts = F.when(first <= last, F.filter(F.sequence(first, last), lambda d: F.slice(
        F.col("around"), here + d + 1, F.col("_span")) == F.slice(F.col("item_around"), there + d + 1, F.col("_span"))))
    ext = (pairs.withColumn("_span", span).select(*key, "item_no", "_span", "at", F.explode(starts).alias("_d"))
           .select(*key, "item_no", (F.col("at") + F.col("_d")).alias("start"), "_span").distinct())
    ext = written(ext, "winnow-windows")
    covered = F.sequence(F.col("start"), F.col("start") + F.col("_span") - 1)
    n_hit = (ext.select(*key, "start", "_span").distinct().select(*key, F.explode(covered).alias("word")).groupBy(*key).agg(
        F.count_distinct("word").alias("n_hit")))
    listed = (ext.select(*key, "item_no").distinct().join(bounded(names), "item_no").groupBy(*key).agg(
        F.collect_set("item").alias("items")).withColumnsRenamed({"_id": "_i", "_hash": "_h"}))
    same = F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_hash") == F.col("_h"))
    found = n_hit.join(listed, same, "left").select(F.col("_id").alias("_i"), F.col("_hash").alias("_h"), "n_hit", "items")
    out = index.join(found, same, "left")
    sorted_names = F.sort_array(F.coalesce("items", F.array().cast("array<string>")))
    n = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select(F.col("_id").alias(id_col), F.col("_hash").alias("text_hash"), "n_words", n.alias("n_hit"),
                      F.size(sorted_names).cast("long").alias("n_items"), sorted_names.alias("items"), (n > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no window of any item, with all their columns."""
    bad = written(contaminated_words(docs, items, id_col, text_col).where("contaminated").select(
        F.col(id_col).alias("_bad_id"), F.col("text_hash").alias("_bad_hash")).distinct(), "winnow-bad")
    same = F.col(f"`{id_col}`").eqNullSafe(F.col("_bad_id")) & (F.xxhash64(F.col(f"`{text_col}`")) == F.col("_bad_hash"))
    return docs.join(small_enough(bad, BROADCAST_ROWS), same, "left_anti")
