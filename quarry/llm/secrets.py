"""Operator 7: secret scan with a random forest against false positives (DataFrame functions and Spark ML only).

Candidates are all runs of at least LEAST secret characters, wherever they stand in
a word and however many it holds (query strings, JSON, URL credentials), and values
of any length and punctuation that a keyword is assigned to (``password=...``,
``"token": "..."``) or that stand as the password of a URL.  A candidate is named by
its word and its number in the word.  Features: length of the value, shares and
transitions of character classes, coverage by dictionary words (words frequent in
the documents), the field name before it, its surroundings, and the words beside it.
A random forest trained on labelled findings gives each candidate its probability.

Where no labelled findings are given, ``known_findings`` labels the plain cases:
fixed formats and assigned mixed values are secrets; plain words, numbers, addresses and
links are not.  What it leaves open is decided by the forest alone.

Defined cases: null or empty texts have no candidates; rows equal in id and text are
scanned each; rows without an id are scanned, too; without labelled findings of
both classes the probability is the share of secrets among them (0 without any);
other columns are ignored, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import written

LEAST = 16
MOST = 20_000         # labelled findings per class at most
TREES, DEPTH = 20, 6
NEAR = 200            # characters of a word kept on either side of a candidate
KEYWORD = r"(?i)(pass(word|wd|phrase)?|pwd|secret|token|api_?key|access_?key|credential|auth|bearer)"
DICTIONARY_SHARE = 0.002
SHORTEST, LONGEST = 3, 16     # letters of a dictionary word
RUN = rf"[A-Za-z0-9+/_\-]{{{LEAST},}}"
_KEY = KEYWORD + r"[A-Za-z0-9_.\-\]\"'\\]{0,40}"      # a keyword and what may follow it in a name
_OPEN = r"[\"'(\[\\]{0,3}"
_VALUE = r"""[^\s"'\\&,;=:<>(){}\[\]](?:[^\s"'\\&,;]*[^\s"'\\&,;.?:<>(){}\[\]])?"""
_QUOTED = r"""(?:(?<=")[^\s"\\]+(?=\\?")|(?<=')[^\s'\\]+(?=\\?'))"""
_IN_URL = r"(?<=://[^/@:\s]{0,100}:)[^/@:\s]+(?=@)"
ASSIGNED = rf"(?<={_KEY}[=:]{{1,2}}{_OPEN})(?:{_QUOTED}|{_VALUE})"
ASSIGNED_BEFORE = rf"{_KEY}\s?[=:]{{1,2}}$"
FIELD, PART = "[^&,;?#{}|@]*", "[^,;{}|]*"   # what one name and value, and one link or address, can consist of


def _class(of: Column, pattern: str) -> Column:
    return F.regexp_count(of, F.lit(pattern)).cast("double")


def _marked(word: Column, pattern: str) -> Column:
    """``word`` in pieces: those at odd places match ``pattern``, the others stand between (a word holds no newline)."""
    return F.split(F.regexp_replace(word, F.lit(pattern), F.lit("\n$0\n")), "\n", -1)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, word_no, run_no, word, value, path, before, after) for every candidate.

    ``word`` and ``path`` are the surroundings in the word and the part of them before the value.
    """
    words = F.split(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), r"\s+")
    given = docs.select(F.col(f"`{id_col}`").alias("id"), words.alias("words"))

    def beside(no: Column) -> Column:
        return F.concat_ws(" ", F.slice(F.col("words"), F.greatest(no - 1, F.lit(1)), F.least(no, F.lit(2))))

    def asked(no: Column) -> Column:
        last = F.coalesce(F.get(F.col("words"), no - 1), F.lit(""))
        return (last.endswith("=") | last.endswith(":")) & beside(no).rlike(ASSIGNED_BEFORE)

    told = F.transform("words", lambda w, i: F.struct(i.alias("no"), w.alias("w"), asked(i).alias("asked")))
    holding = F.filter(told, lambda x: x["asked"] | x["w"].rlike(RUN) | x["w"].rlike(f"{ASSIGNED}|{_IN_URL}"))
    near = F.transform(holding, lambda x: F.struct(
        x["no"], x["w"], x["asked"], beside(x["no"]).alias("before"),
        F.coalesce(F.get(F.col("words"), x["no"] + 1), F.lit("")).alias("after")))
    at = given.select("id", F.explode(near).alias("c"))
    named = f"{ASSIGNED}|{_IN_URL}|{RUN}"
    pieces = at.select("id", "c", F.when(F.col("c.asked"), _marked(F.col("c.w"), rf"(?<=^{_OPEN})(?:{_QUOTED}|{_VALUE})|{named}")).otherwise(
        _marked(F.col("c.w"), named)).alias("p"))
    runs = F.transform(F.filter(F.sequence(F.lit(0), F.size("p") - 1), lambda k: k % 2 == 1), lambda k: F.struct(
        F.floor(k / 2).cast("int").alias("run_no"), F.get(F.col("p"), k).alias("value"),
        F.substring(F.concat_ws("", F.get(F.col("p"), k - 3), F.get(F.col("p"), k - 2), F.get(F.col("p"), k - 1)),
                    -NEAR, NEAR).alias("path"),
        F.substring(F.concat_ws("", F.get(F.col("p"), k + 1), F.get(F.col("p"), k + 2), F.get(F.col("p"), k + 3)),
                    1, NEAR).alias("rest")))
    return pieces.select("id", "c", F.explode(runs).alias("r")).select(
        "id", F.col("c.no").alias("word_no"), "r.run_no", F.concat("r.path", "r.value", "r.rest").alias("word"), "r.value",
        "r.path", "c.before", "c.after")


def dictionary(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(entry): words of SHORTEST to LONGEST letters found in at least DICTIONARY_SHARE of the documents."""
    n = docs.count()
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))),
                                                  F.lit(rf"(?<![a-z])[a-z]{{{SHORTEST},{LONGEST}}}(?![a-z])"), F.lit(0)))
    return (docs.select(F.explode(words).alias("entry")).groupBy("entry").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= max(2, DICTIONARY_SHARE * n)).select("entry"))


FEATURES = ["f_length", "f_digits", "f_upper", "f_lower", "f_hex", "f_marks", "f_turns", "f_vowels", "f_distinct", "f_cover",
            "f_assigned", "f_path_word", "f_slashes", "f_dots", "f_at", "f_in_url", "f_before_word", "f_before_sign", "f_after_lower"]


def _field() -> Column:
    """What stands before a value in its field: its name, mostly."""
    return F.regexp_extract("path", f"{FIELD}$", 0)


def _rest() -> Column:
    return F.expr("substring(word, length(path) + length(value) + 1)")


def _part() -> Column:
    """The link, address or assignment that a value stands in."""
    return F.concat(F.regexp_extract("path", f"{PART}$", 0), F.col("value"), F.regexp_extract(_rest(), f"^{PART}", 0))


def _in_url() -> Column:
    return F.col("path").rlike("://[^/@:]*:$") & _rest().startswith("@")


def coverage(found: DataFrame, words: DataFrame) -> DataFrame:
    """(value, covered): letters of a value that dictionary words cover, for values that have any.

    Words lie within runs of letters, so each distinct run is looked up once: its pieces
    of up to LONGEST letters, one for each place, and their beginnings.
    """
    parts = found.select("value").distinct().select("value", F.explode(
        F.regexp_extract_all(F.lower("value"), F.lit(f"[a-z]{{{SHORTEST},}}"), F.lit(0))).alias("part"))
    at = parts.select("part").distinct().select("part", F.explode(
        F.sequence(F.lit(1), F.length("part") - (SHORTEST - 1))).alias("i"))
    pieces = at.select(F.sha1("part").alias("key"), "i",
                       F.substring(F.col("part"), F.col("i"), F.lit(LONGEST)).alias("piece"))
    sizes = F.sequence(F.lit(SHORTEST), F.length("piece"))
    hits = pieces.select("key", "i", F.explode(F.transform(sizes, lambda n: F.struct(
        n.alias("size"), F.substring(F.col("piece"), F.lit(1), n).alias("entry")))).alias("p")).select(
        "key", "i", "p.size", "p.entry").join(words, "entry", "left_semi")
    letters = (hits.select("key", F.explode(F.sequence(F.col("i"), F.col("i") + F.col("size") - 1)).alias("place"))
               .distinct().groupBy("key").agg(F.count(F.lit(1)).alias("n")))
    return (parts.select("value", F.sha1("part").alias("key")).join(letters, "key")
            .groupBy("value").agg(F.sum("n").alias("covered")))


def featured(found: DataFrame, words: DataFrame) -> DataFrame:
    """Candidates with the columns FEATURES."""
    v, n = F.col("value"), F.length("value").cast("double")
    key = F.sha2("value", 256)
    cover = coverage(found, words)
    out = found.join(cover, "value", "left")
    turns = sum((_class(v, p) for p in (r"[0-9](?=[A-Za-z])", r"[A-Za-z](?=[0-9])", r"[a-z](?=[A-Z])", r"[A-Z](?=[a-z])")), F.lit(0.0))
    return out.withColumns({
        "f_length": F.least(n, F.lit(200.0)), "f_digits": _class(v, "[0-9]") / n, "f_upper": _class(v, "[A-Z]") / n,
        "f_lower": _class(v, "[a-z]") / n, "f_hex": _class(v, "[0-9a-f]") / n, "f_marks": _class(v, "[^A-Za-z0-9]") / n,
        "f_turns": turns / n, "f_vowels": _class(v, "(?i)[aeiou]") / n,
        "f_distinct": F.size(F.array_distinct(F.split(v, ""))) / n, "f_cover": F.coalesce("covered", F.lit(0)) / n,
        "f_assigned": _field().rlike("[=:]").cast("double"), "f_path_word": _field().rlike(KEYWORD).cast("double"),
        "f_slashes": F.least(F.lit(9.0), _class(_part(), "/")), "f_dots": F.least(F.lit(9.0), _class(_part(), "[.]")),
        "f_at": _part().contains("@").cast("double"), "f_in_url": _in_url().cast("double"), "f_before_word": F.col("before").rlike(KEYWORD).cast("double"),
        "f_before_sign": F.col("before").rlike("[=:]$").cast("double"),
        "f_after_lower": F.col("after").rlike("^[a-z]+[.,]?$").cast("double")}).drop("covered").withColumn("value_sha256", key)


def known_findings(found: DataFrame) -> DataFrame:
    """Candidates with ``label``: 1 for plain secrets, 0 for plain false positives, null for what is open."""
    mixed = F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]")
    named = _field().rlike(KEYWORD) | (F.col("before").rlike(KEYWORD) & F.col("before").rlike("[=:]$"))
    asked = named | _in_url()
    marked = F.col("value").rlike(r"[^A-Za-z0-9+/_.\-]")    # assigned values alone can hold such
    yes = F.col("value").rlike(r"^(AKIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abp]-[A-Za-z0-9\-]+)$") | (
        asked & mixed & (F.length("value") >= 8))
    no = ~asked & (_part().contains("@") | _part().contains("://")) | (~mixed & ~(asked & marked))
    return found.withColumn("label", F.when(yes, 1.0).when(no, 0.0))


def scan(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
         most: int = MOST) -> DataFrame:
    """(id, word_no, run_no, value, value_sha256, label, probability, is_secret) for every candidate.

    ``labelled`` has the columns of :func:`candidates` and ``label``; without it
    the documents' own plain cases are used, but those of ids with crc32 mod 5 = 0, at most ``most`` of each class.
    """
    words = written(dictionary(docs, text_col), "secret-words")
    at = written(candidates(docs, id_col, text_col), "secret-places")      # read three times for the features
    found = written(known_findings(featured(at, words)), "secret-candidates")
    if labelled is None:
        known = found.where(F.col("label").isNotNull()
                            & (F.pmod(F.crc32(F.coalesce(F.col("id").cast("string"), F.lit(""))), F.lit(5)) != 0))
    else:
        known = featured(labelled, words)
    order = [F.xxhash64("value", "before", "after"), F.col("id"), F.col("word_no"), F.col("run_no")]
    sample = written(known.where("label = 1").orderBy(*order).limit(most).unionByName(
        known.where("label = 0").orderBy(*order).limit(most)).select(*FEATURES, "label"), "secret-labels")
    n, yes = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if 0 < yes < n:
        gather = VectorAssembler(inputCols=FEATURES, outputCol="features")
        forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=7)
        model = forest.fit(gather.transform(sample.coalesce(1).sortWithinPartitions(*FEATURES, "label")))
        judged = model.transform(gather.transform(found)).withColumn("p", vector_to_array("probability")[1])
    else:
        judged = found.withColumn("p", F.lit(float(yes / n) if n else 0.0))
    return judged.select(F.col("id").alias(id_col), F.col("word_no").cast("long").alias("word_no"),
                         F.col("run_no").cast("long").alias("run_no"), "value", "value_sha256",
                         F.col("label").cast("int").alias("label"), F.round("p", 9).alias("probability"),
                         (F.col("p") >= 0.5).alias("is_secret"))
