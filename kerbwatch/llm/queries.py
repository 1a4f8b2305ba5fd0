"""The queries of this subpackage, by name, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbwatch.llm import (chat, decontam, exactdup, langid, longdup, negatives, pieces, pii, prints, simhash, toxicity,
                            urls, variants)
from kerbwatch.llm.common import documents, held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op3_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(documents(spark, sf_dir), width=4, budget=4)
    return found.select("doc_id", simhash.hexed("fp").alias("fingerprint"), "component_id")


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


SQL["op6_decontamination"] = r"""
WITH i AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(10, len(ws)) AS m, array_to_string(list_slice(ws, p, p + least(10, len(ws)) - 1), ' ') AS win
       FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS p FROM i WHERE len(ws) > 0)),
d AS MATERIALIZED (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM documents),
dw AS (SELECT doc_id, p, m, array_to_string(list_slice(ws, p, p + m - 1), ' ') AS win
       FROM (SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS p FROM d, (SELECT DISTINCT m FROM iw) WHERE len(ws) >= m)),
hit AS MATERIALIZED (SELECT doc_id, p, dw.m AS m, item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.m = iw.m),
cover AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + m)) AS q FROM hit) GROUP BY doc_id),
which AS (SELECT doc_id, count(*) AS n_items, string_agg(t, ',' ORDER BY t) AS list
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS t FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover ON d.doc_id = cover.doc_id LEFT JOIN which ON d.doc_id = which.doc_id
"""


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(~held_out("doc_id", 5, 0)))
    return toxicity.score(docs, model).select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid.fit(docs.where(~held_out("doc_id", 4, 2)))
    return langid.predict(docs, model).withColumn("held_out", held_out("doc_id", 4, 2))


@query
def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


@query
def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(documents(spark, sf_dir), digest=True).withColumnRenamed("ids", "ids_sha256")


@query
def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chat(chat.as_tool_chat(table(spark, sf_dir, "conversations")), chat.ASK)


@query
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prints.report(documents(spark, sf_dir))


@query
def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(documents(spark, sf_dir))


@query
def op7_long_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longdup.report(documents(spark, sf_dir))


@query
def op13_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.report(documents(spark, sf_dir))


SQL["op13_exact_duplicates"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.report(documents(spark, sf_dir))


# the checksum is spelled out: its table follows from the polynomial, and a string's bytes are folded over it
SQL["op11_spelling_variants"] = r"""
WITH RECURSIVE steps AS (SELECT i, 0 AS k, CAST(i AS BIGINT) AS c FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8),
runs AS MATERIALIZED (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents) GROUP BY ALL),
sums AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
    string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''), lambda ch: CASE WHEN unicode(ch) < 128 THEN [CAST(unicode(ch) AS BIGINT)]
      ELSE [CAST(192 | (unicode(ch) >> 6) AS BIGINT), CAST(128 | (unicode(ch) & 63) AS BIGINT)] END))),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS h FROM runs, crc),
words AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT n, CASE WHEN h % 97 = 0
    THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word FROM sums)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
keys AS MATERIALIZED (SELECT word, n, i, CASE WHEN i = 0 THEN word ELSE substring(word, 1, i - 1) || substring(word, i + 1) END AS key
  FROM (SELECT word, n, unnest(range(0, length(word) + 1)) AS i FROM words)),
pairs AS MATERIALIZED (SELECT DISTINCT a.word AS word, a.n AS n, b.word AS near, b.n AS near_n FROM keys a JOIN keys b ON a.key = b.key
  AND a.word <> b.word WHERE a.i = b.i OR a.i = 0 OR b.i = 0),
best AS (SELECT word, count(*) AS n_near, min({'less': -near_n, 'near': near}) AS b FROM pairs GROUP BY word),
forms AS MATERIALIZED (SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.less >= 2 * n THEN b.near END AS form,
  CASE WHEN -b.less >= 2 * n THEN -b.less END AS form_n FROM words w LEFT JOIN best ON w.word = best.word),
path(word, here, form) AS (SELECT word, word, form FROM forms
  UNION ALL SELECT p.word, f.word, f.form FROM path p JOIN forms f ON f.word = p.form)
SELECT f.word, f.form, p.here AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM forms f JOIN path p ON p.word = f.word AND p.form IS NULL
"""


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    whole = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = rows.where(whole).select(F.col("vec_id").alias("id"), label.alias("label"),
                                       F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("v"))
    return negatives.mine(vectors, F.col("id") % 100 == 0)


SQL["op12_hard_negatives"] = """
WITH v AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 10
"""
