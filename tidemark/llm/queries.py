"""Registered queries over the corpus tables, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import best_fit, bpe_codec, decontamination, exact_dedup, language_spans, quality_votes
from tidemark.llm import near_dedup, prefix_trie, repeated_bytes, repeated_passages
from tidemark.llm import secret_spans, source_divergence, token_counts
from tidemark.llm.shipping import ship

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder(modulus: int) -> Column:
    """The held-out folds of the contract."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


@query
def op1_quality_votes(spark, folder):
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scores = quality_votes.quality_scores(documents, labels, remainder(5) != 0)
    held_out = F.coalesce(remainder(5) == 0, F.lit(False))
    return scores.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op2_language_spans(spark, folder):
    documents = table(spark, folder, "documents")
    model = language_spans.fit(documents, remainder(3) != 1)
    held_out = F.coalesce(remainder(3) == 1, F.lit(False))
    return language_spans.languages(documents, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


@query
def op3_exact_dedup(spark, folder):
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


_SQL["op3_exact_dedup"] = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents),
k AS (SELECT *, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size
      FROM d WINDOW w AS (PARTITION BY text_sha256))
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM k
"""


@query
def op4_token_counts(spark, folder):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.token_counts(table(spark, folder, "documents"), path)


def encoded_digests(rows: DataFrame) -> DataFrame:
    """What the contract asks of encoded documents."""
    return rows.select(
        "doc_id", "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op5_bpe_codec(spark, folder):
    path = public_tokenizers.path("word_bpe_49k.json")
    return encoded_digests(bpe_codec.encode_documents(table(spark, folder, "documents"), path))


@query
def op6_secret_spans(spark, folder):
    rows = secret_spans.secrets(table(spark, folder, "documents"))
    return rows.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans"
    )


@query
def op9_decontaminate(spark, folder):
    rows = decontamination.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


_SQL["op9_decontaminate"] = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
s AS (
  SELECT item, unnest([w[i:i + 9] FOR i IN range(1, greatest(len(w) - 9, 1) + 1)]) AS v
  FROM b WHERE len(w) > 0),
n AS (SELECT DISTINCT len(v) AS n FROM s),
p AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, n WHERE len(w) >= n),
h AS (SELECT r, k, n, item FROM p JOIN s ON w[k:k + n - 1] = v AND len(v) = n),
c AS (SELECT r, count(DISTINCT x) AS n_hit
      FROM (SELECT r, unnest(range(k, k + n)) AS x FROM h) GROUP BY r),
i AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS l
      FROM h GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(l, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN i USING (r)
"""


@query
def op8_near_duplicates(spark, folder):
    return near_dedup.near_duplicates(table(spark, folder, "documents"), percent=85)


@query
def op7_repeated_bytes(spark, folder):
    return repeated_bytes.removed_bytes(table(spark, folder, "documents"))


@query
def op10_repeated_passages(spark, folder):
    rows = repeated_passages.removed_passages(table(spark, folder, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_source_divergence(spark, folder):
    return source_divergence.source_divergence(table(spark, folder, "documents"))


_SQL["op11_source_divergence"] = """
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 30),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
x AS (SELECT lang, source, g.source AS own, term, coalesce(n, 0) AS n
      FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) //
             (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS p FROM x JOIN v USING (lang)),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 5)) //
             (sum(sum(n)) OVER (PARTITION BY lang) + 5 * any_value(v)) AS q
      FROM x JOIN v USING (lang) GROUP BY lang, term),
s AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
  UNION ALL
  SELECT a.lang, a.source, 'pair', b.source, 0 FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  WHERE a.lang NOT IN (SELECT lang FROM k)
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
z AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM s)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM z WHERE part = 'pair' OR rank <= 50
"""


@query
def op12_prefix_trie(spark, folder):
    return prefix_trie.prefix_trie(table(spark, folder, "conversations"))


_SQL["op12_prefix_trie"] = """
WITH a AS (
  SELECT conv_id, turn, left(sha256(strlen(role) || ':' || role || text), 32) AS i,
         len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS w
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT conv_id, list({'i': i, 'w': w} ORDER BY turn NULLS FIRST, i) AS t FROM a GROUP BY conv_id),
b AS (SELECT *, [ascii(x) FOR x IN string_split(CAST(conv_id AS VARCHAR), '')] AS s FROM c),
h AS (SELECT conv_id, t, list_reduce(
        [(s[j // 8 + 1] >> (j % 8)) & 1 FOR j IN range(len(s) * 8)],
        lambda x, y: CASE WHEN (xor(x, y) & 1) = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END,
        4294967295) AS crc FROM b),
g AS (SELECT conv_id, t, CAST(xor(crc, 4294967295) % 4 AS BIGINT) AS h FROM h),
r AS (SELECT g.conv_id, list_concat(coalesce(f.t[1:h], []), g.t[h + 1:]) AS t
      FROM g LEFT JOIN c f ON f.conv_id = g.conv_id - g.conv_id % 20),
p AS (SELECT conv_id, t, unnest(range(len(t) + 1)) AS d FROM r),
n AS (SELECT [x.i FOR x IN t[1:d]] AS path, d, min(conv_id) AS conv_id, count(*) AS n_convs,
             any_value(CASE WHEN d > 0 THEN t[d].w ELSE 0 END) AS w,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
                    FILTER (len(t) = d), '')) AS ends_sha256
      FROM p GROUP BY ALL),
k AS (SELECT path[1:d - 1] AS parent, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON path = parent),
u AS (SELECT path[1:j] AS top, count(*) FILTER (n_children = 0) AS n_leaves,
             sum((n_convs - 1) * w) AS saved
      FROM (SELECT *, unnest(range(d + 1)) AS j FROM f) GROUP BY 1)
SELECT f.conv_id, f.d AS depth, o.conv_id AS parent_conv_id, f.n_convs, f.n_children, u.n_leaves,
       CAST(u.saved AS BIGINT) AS saved_tokens, f.ends_sha256
FROM f JOIN u ON f.path = u.top LEFT JOIN n o ON f.d > 0 AND o.path = f.path[1:f.d - 1]
"""


@query
def op13_best_fit(spark, folder):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return best_fit.packed(table(spark, folder, "documents"), path)
