"""The queries of the numbered operators over the given tables: each applies its operator to whole tables and derives the contract's columns."""

from __future__ import annotations

import importlib.util
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtables.llm import bpe, bursttrie, dac, decontamination, jaccard, kdtree, langid, quality, repeats, search, toxicity, urlrules, whitening
from gridtables.llm.common import held_out, staged
from gridtables.llm.registry import query, table
from gridtables.llm.samples import labelled_sample



def tokenizer() -> str:
    """The vocabulary file of the installed package of public tokenizers."""
    return os.path.join(os.path.dirname(importlib.util.find_spec("public_tokenizers").origin), "byte_bpe_50k.json")


@query("op3_bpe")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_digests(table(spark, folder, "documents"), tokenizer())


@query("op10_token_files")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return dac.stored(table(spark, folder, "documents"), tokenizer())


OP8 = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS k, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
m AS (SELECT doc_id, item_id, i, k FROM dw JOIN bw USING (k, win)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM m)) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS xs FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM m) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(xs, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""


@query("op8_decontamination", OP8)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.hits(decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query("op9_kd_shards")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    found = kdtree.shards(table(spark, folder, "documents"), ["n_chars", "source", "lang"], n_shards=16)
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


URL_RULES = [
    ("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"),
]


@query("op4_url_rules")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = urlrules.judge(table(spark, folder, "pages"), URL_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict", "confidence", "mined_rule")


OP7 = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 4], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_n FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * both_n >= 80 * (x.n + y.n - both_n)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, reached) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.reached)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id) c USING (doc_id)
"""


@query("op7_jaccard_join", OP7)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


def quality_rules(docs: DataFrame, labels: DataFrame) -> quality.Rules:
    """Rules fitted on labelled rows that are not held out."""
    sample = labelled_sample(labels, "doc_id", "quality", ~held_out("doc_id", 5, 0)).withColumnRenamed("id", "sample_id")
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("sample_id"))
    return quality.fit(staged(quality.with_statistics(chosen).select("stats", "label", "weight")))


@query("op1_quality_rules")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    score = quality_rules(docs, table(spark, folder, "labels")).score()
    found = quality.statistics(docs).select(F.col("id").alias("doc_id"), held_out("id", 5, 0).alias("held_out"), score.alias("score"))
    return found.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query("op2_toxicity")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    sample = labelled_sample(table(spark, folder, "labels"), "doc_id", "toxic", ~held_out("doc_id", 4, 2))
    rows = docs.join(F.broadcast(sample), docs["doc_id"] == sample["id"]).select("id", "text", "label", "weight")
    model = toxicity.learn(rows)
    found = toxicity.evidence(docs, model)
    return found.select(
        F.col("id").alias("doc_id"), held_out("id", 4, 2).alias("held_out"), model.score().alias("score"),
        F.size("matches").alias("n_matches")).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query("op5_repeats")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.digests(table(spark, folder, "documents"))


OP6 = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
s AS (SELECT count(*) AS n, greatest(avg(len(w)), 1e-9) AS mean FROM d),
tf AS (SELECT doc_id, term, count(*) AS c FROM (SELECT doc_id, unnest(w) AS term FROM d) GROUP BY doc_id, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
p AS (
  SELECT tf.doc_id, tf.term, ln(1 + (n - df + 0.5) / (df + 0.5)) * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * len(w) / mean)) AS impact
  FROM tf JOIN df USING (term) JOIN d USING (doc_id), s),
r AS (
  SELECT q.doc_id AS query_id, p.doc_id, round(sum(impact), 6) AS score
  FROM tf q JOIN p USING (term) WHERE q.doc_id % 20 = 0 GROUP BY q.doc_id, p.doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0)
SELECT query_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 10
"""


@query("op6_bm25_search", OP6)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(table(spark, folder, "documents"), F.col("doc_id") % 20 == 0)


@query("op11_language_id")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = langid.learn(docs, ~held_out("doc_id", 5, 0))
    found = langid.predict(docs, model)
    return found.select(F.col("id").alias("doc_id"), held_out("id", 5, 0).alias("held_out"), "lang_pred", "score")


@query("op12_whitening")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings")).withColumn("deviation", whitening.as_long("deviation"))


OP13 = """
WITH RECURSIVE t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS pos, k, b
  FROM (SELECT conv_id, turn, md5(md5(coalesce(role, '')) || md5(coalesce(text, ''))) AS k, strlen(coalesce(text, '')) AS b
        FROM conversations WHERE conv_id IS NOT NULL)),
crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, x: xor(a >> 1, 3988292384 * (a & 1)))) AS tab),
cv AS (
  SELECT c, c - c % 5 AS base, xor(list_reduce([4294967295] || list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
    lambda a, x: xor(a >> 8, tab[1 + (xor(a, x) & 255)])), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT c FROM t), crc),
r AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY pos) AS d, k, b
  FROM (SELECT cv.c, pos, k, b FROM cv JOIN t ON t.c = cv.base AND pos <= h UNION ALL SELECT cv.c, pos, k, b FROM cv JOIN t ON t.c = cv.c AND pos > h)),
p AS (SELECT c, d, b, md5(string_agg(k, '') OVER (PARTITION BY c ORDER BY d)) AS key FROM r),
n AS (SELECT min(c) AS conv_id, d, key, count(*) AS n_convs, min(b) AS b FROM p GROUP BY d, key
  UNION ALL SELECT min(c), 0, '', count(*), 0 FROM cv HAVING count(*) > 0),
lab AS (SELECT c, p.d, conv_id FROM p JOIN n ON n.d = p.d AND n.key = p.key UNION ALL SELECT c, 0, (SELECT min(c) FROM cv) FROM cv),
par AS (SELECT n.conv_id, n.d, n.n_convs, n.b, lab.conv_id AS parent FROM n LEFT JOIN lab ON lab.c = n.conv_id AND lab.d = n.d - 1),
kids AS (SELECT parent AS conv_id, d - 1 AS d, count(*) AS n_children FROM par WHERE parent IS NOT NULL GROUP BY ALL),
one AS (SELECT par.*, coalesce(n_children, 0) AS n_children FROM par LEFT JOIN kids USING (conv_id, d)),
sub AS (
  SELECT lab.conv_id, lab.d, sum((n_children = 0)::BIGINT) AS n_leaves, sum((n_convs - 1) * b) AS saved
  FROM one JOIN lab ON lab.c = one.conv_id AND lab.d <= one.d GROUP BY ALL),
last AS (SELECT cv.c, coalesce(max(d), 0) AS d FROM cv LEFT JOIN p USING (c) GROUP BY cv.c),
fin AS (SELECT lab.conv_id, lab.d, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM last JOIN lab USING (c, d) GROUP BY ALL)
SELECT conv_id, d::BIGINT AS depth, parent AS parent_conv_id, n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children,
  n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM one JOIN sub USING (conv_id, d) LEFT JOIN fin USING (conv_id, d)
"""


@query("op13_conversation_trie", OP13)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return bursttrie.prefix_trie(table(spark, folder, "conversations"))
