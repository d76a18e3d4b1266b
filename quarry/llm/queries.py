"""Registered queries of the corpus operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (bpe, chat, filter_audit, hard_negatives, line_dedup, minhash, packing, resampling, secrets, shards, toxicity,
                        vector_dedup, winnow)
from quarry.llm.common import table


def vocabulary(spark: SparkSession, name: str = "byte_bpe_50k.tiktoken"):
    import public_tokenizers
    return bpe.load_vocabulary(spark, public_tokenizers.path(name))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents rid of repeated three-line windows, as digests."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS a FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(a) - 1)) AS i, a FROM l WHERE len(a) >= 3),
v AS (SELECT doc_id, i, a[i:i+2] AS t FROM w WHERE a[i] || a[i+1] || a[i+2] <> ''),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY t ORDER BY doc_id, i) AS rn FROM v),
c AS (SELECT DISTINCT doc_id, i + o AS p FROM r, (VALUES (0), (1), (2)) x(o) WHERE rn > 1),
e AS (SELECT doc_id, unnest(range(1, len(a) + 1)) AS p, unnest(a) AS line FROM l),
k AS (SELECT e.doc_id, count(*) AS n_lines, count(c.p) AS n_removed,
             string_agg(CASE WHEN c.p IS NULL THEN line END, chr(10) ORDER BY e.p) AS kept
      FROM e LEFT JOIN c ON e.doc_id = c.doc_id AND e.p = c.p GROUP BY e.doc_id)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id
"""


def op2_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings of one label with a cosine of at least 0.93."""
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


OP2_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id
        AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.93),
r(id, node) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.id, l.b FROM r JOIN l ON r.node = l.a),
c AS (SELECT id, min(node) AS component_id FROM r GROUP BY id),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON c.id = vec_id LEFT JOIN n ON n.a = vec_id
"""


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that says control strings, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame([(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")],
                                   rows.schema)
    read = chat.read_chats(chat.format_chats(rows.unionByName(tricky)))
    turns = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


OP3_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
       sum(22 + length(role) + length(text)
           + len(regexp_extract_all(role, '\\|<s>|</s>|\[INST\]|\[/INST\]'))
           + len(regexp_extract_all(text, '\\|<s>|</s>|\[INST\]|\[/INST\]')))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document."""
    docs = table(spark, sf_dir, "documents")
    model, limits = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    out = toxicity.score(docs, model, also=("doc_id", "lang"))
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(5)) == 0
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                      (F.col("score") >= toxicity.threshold_of(F.col("lang"), limits)).alias("rejected"))


def op5_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents resampled towards those labelled good; as large a share as labels find good."""
    labels = table(spark, sf_dir, "labels").where("quality IN (0, 1)")
    share = labels.agg(F.avg("quality")).first()[0]
    return resampling.resample(table(spark, sf_dir, "documents"), labels.where("quality = 1"),
                               0.5 if share is None else share)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of the secret scan in all documents."""
    return secrets.scan(table(spark, sf_dir, "documents")).drop("value")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE of every text, encoded and decoded again, as digests."""
    return bpe.token_digests(table(spark, sf_dir, "documents"), vocabulary(spark))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in eight shards of near equal bytes."""
    return shards.shard(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in documents."""
    found = winnow.contaminated_words(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
OP9_SQL = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, w, least(len(w), 10) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i+n-1], ' ') AS t
       FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
ns AS (SELECT DISTINCT n FROM b),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i+n-1], ' ') AS t
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n)),
h AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.t = bw.t AND dw.n = bw.n),
p AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS word FROM h) GROUP BY doc_id),
q AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p ON d.doc_id = p.doc_id LEFT JOIN q ON d.doc_id = q.doc_id
"""


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate documents on four-word shingles at a similarity of 0.8."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4)


OP10_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+3], ' ') AS t
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.t = y.t AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(id, node) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.id, e.b FROM r JOIN e ON r.node = e.a),
c AS (SELECT id, min(node) AS component_id FROM r GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN c ON c.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in each of their 120 orders, by language."""
    return filter_audit.audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP11_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
e AS (SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
g AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
             || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t) THEN 'C' ELSE '' END
             || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN e.doc_id > least THEN 'E' ELSE '' END AS failed
      FROM e LEFT JOIN g ON e.doc_id = g.doc_id),
c AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, failed),
p(o) AS (SELECT '' UNION ALL SELECT o || f FROM p, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) x(f) WHERE NOT contains(o, f)),
s AS (SELECT o AS filter_order, k AS step, o[k] AS f, o[1:k - 1] AS before FROM p, range(1, 6) r(k) WHERE length(o) = 5),
x AS (SELECT part, filter_order, step, f,
             sum(CASE WHEN reached AND NOT hit THEN n ELSE 0 END) AS kept, sum(CASE WHEN reached AND hit THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN hit AND NOT reached THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN failed = f THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN reached AND hit THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN reached AND hit THEN toxic ELSE 0 END) AS toxic_lost
      FROM (SELECT *, contains(failed, f) AS hit, translate(failed, before, '') = failed AS reached FROM c, s)
      GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM x
"""


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


OP12_SQL = """
WITH v AS (SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.id AS anchor_id, x.id AS id, a.label = x.label AS same, list_inner_product(a.e, x.e)::BIGINT AS score
      FROM v a JOIN v x ON a.id % 100 = 0 AND a.id <> x.id AND len(a.e) = len(x.e)),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT p.anchor_id, positive_id, positive_score, s.id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS rank
      FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
       AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2,048 tokens, as digests of their pieces."""
    import public_tokenizers
    pieces = packing.pack_texts(table(spark, sf_dir, "documents"), packing.load_tokenizer(spark, public_tokenizers.path("byte_bpe_50k.json")),
                                with_ids=False)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_line_dedup": op1_line_dedup, "op2_vector_dedup": op2_vector_dedup,
            "op3_chat_format": op3_chat_format, "op4_toxicity": op4_toxicity, "op5_quality_resampling": op5_quality_resampling,
            "op7_secret_scan": op7_secret_scan, "op6_byte_bpe": op6_byte_bpe, "op8_sharding": op8_sharding,
            "op9_decontamination": op9_decontamination, "op10_minhash": op10_minhash, "op11_filter_audit": op11_filter_audit,
            "op12_hard_negatives": op12_hard_negatives, "op13_packing": op13_packing}


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": OP1_SQL, "op2_vector_dedup": OP2_SQL, "op3_chat_format": OP3_SQL, "op9_decontamination": OP9_SQL, "op10_minhash": OP10_SQL,
            "op11_filter_audit": OP11_SQL, "op12_hard_negatives": OP12_SQL}
