"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from .common import table
from .decontaminate import benchmark_overlap
from .language_id import identify_language
from .lexical import rank_documents
from .line_dedup import dedup_lines
from .mixing import mix
from .quality import score_quality
from .simhash import simhash_groups
from .substring_dedup import dedup_word_windows
from .suffix_dedup import dedup_byte_windows
from .topk import top_k
from .toxicity import score_toxicity
from .trie import rebuilt_trie
from .url_filter import filter_urls

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def put(fn: QueryFn) -> QueryFn:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return put


@query("op9_substring_dedup", """
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws
  FROM documents),
starts AS (
  SELECT doc_id, s, md5(array_to_string(ws[s:s + 49], ' ')) AS h
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS s FROM words)),
firsts AS (SELECT h, min(doc_id) AS first_doc FROM starts GROUP BY h),
hits AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS i
  FROM starts JOIN firsts USING (h) WHERE first_doc < doc_id),
gone AS (SELECT doc_id, list(i) AS gone FROM hits GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(coalesce(array_to_string(CASE WHEN gone IS NULL THEN ws
    ELSE list_transform(list_filter(list_zip(ws, range(1, len(ws) + 1)), lambda z: NOT list_contains(gone, z[2])), lambda z: z[1])
    END, ' '), '')) AS kept_sha256
FROM words LEFT JOIN gone USING (doc_id)
""")
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_word_windows(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op10_suffix_dedup", """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS (SELECT doc_id, h, length(h) // 2 AS n FROM docs),
chunks AS (                          -- short strings, as substr reads its whole argument
  SELECT doc_id, c, n, substr(h, 2 * c + 1, 398) AS h FROM (SELECT *, unnest(range(0, n - 99, 100)) AS c FROM sized)),
starts AS (
  SELECT doc_id, c + i AS s, md5(substr(h, 2 * i + 1, 200)) AS w
  FROM (SELECT *, unnest(range(0, least(100, n - 99 - c))) AS i FROM chunks)),
firsts AS (SELECT w, min((doc_id, s)) AS first FROM starts GROUP BY w HAVING count(*) > 1),
hits AS (SELECT doc_id, s FROM starts JOIN firsts USING (w) WHERE (doc_id, s) <> first),
edges AS (
  SELECT doc_id, s, coalesce(s > lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100, true) AS opens FROM hits),
runs AS (SELECT doc_id, s, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM edges),
spans AS (SELECT doc_id, run, min(s) AS a, max(s) + 100 AS b FROM runs GROUP BY doc_id, run),
kept AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed,
    string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept
  FROM (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans JOIN sized USING (doc_id))
  GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM sized LEFT JOIN kept USING (doc_id)
""")
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_byte_windows(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


@query("op2_simhash")
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents", "doc_id", "text"))


_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op3_decontaminate", f"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all({_FOLD}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all({_FOLD}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
items AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(ws[s:s + 9], ' ') AS w
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 8, 2))) AS s FROM iw WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM items),
found AS (
  SELECT doc_id, s, n, item_id FROM (
    SELECT doc_id, s, n, array_to_string(ws[s:s + n - 1], ' ') AS w
    FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS s FROM dw, sizes)) JOIN items USING (n, w)),
hits AS (
  SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS i FROM found) GROUP BY 1),
ids AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM found) GROUP BY 1)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hits USING (doc_id) LEFT JOIN ids USING (doc_id)
""")
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = benchmark_overlap(table(spark, sf_dir, "documents", "doc_id", "text"),
                            table(spark, sf_dir, "benchmark", "item_id", "text"))
    return out.select("document.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


@query("op5_line_dedup", """
WITH lines AS (
  SELECT doc_id, i AS line_no, trim(parts[i + 1], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line
  FROM (SELECT doc_id, parts, unnest(range(0, len(parts))) AS i
        FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))),
firsts AS (
  SELECT line, min((doc_id, line_no)) AS first, length(line) AS n
  FROM lines WHERE line <> '' GROUP BY line),
halves AS (
  SELECT line, first, n, c, side,
    CASE side WHEN 0 THEN line[1:c // 2] ELSE line[n - (c - c // 2) + 1:n] END AS half
  FROM firsts, (VALUES (0), (1)) AS s(side), (VALUES (0), (1)) AS o(less), LATERAL (SELECT n - less AS c) WHERE n >= 20),
near AS (
  SELECT DISTINCT a.line FROM halves a JOIN halves b
    ON a.c = b.c AND a.side = b.side AND a.half = b.half AND b.first < a.first AND a.line <> b.line
  WHERE levenshtein(a.line, b.line) <= 1),
gone AS (
  SELECT doc_id, list(line_no) AS gone FROM lines JOIN firsts USING (line)
  WHERE (doc_id, line_no) <> first OR line IN (SELECT line FROM near) GROUP BY doc_id)
SELECT doc_id, len(parts)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN parts
    ELSE [parts[i + 1] FOR i IN range(0, len(parts)) IF NOT list_contains(gone, i)] END, chr(10))) AS kept_sha256
FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents) LEFT JOIN gone USING (doc_id)
""")
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"), min_exact=1)
    return out.select("document.doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = score_toxicity(table(spark, sf_dir, "documents", "doc_id", "text"),
                         table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return out.select("document.doc_id", "held_out", "score", "predicted")


@query("op11_lexical", f"""
WITH docs AS (
  SELECT rid, doc_id, ws, len(ws)::BIGINT AS n FROM (
    SELECT row_number() OVER () AS rid, doc_id,
      regexp_extract_all({_FOLD}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ws FROM documents)
  WHERE len(ws) > 0),
totals AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM docs),
asked AS (
  SELECT item, item_id, w, count(*)::BIGINT AS q FROM (
    SELECT row_number() OVER () AS item, item_id,
      unnest(regexp_extract_all({_FOLD}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS w
    FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE item_id IS NOT NULL)) GROUP BY ALL),
counted AS (
  SELECT rid, w, count(*)::BIGINT AS tf FROM (SELECT rid, unnest(ws) AS w FROM docs)
  WHERE w IN (SELECT w FROM asked) GROUP BY ALL),
weights AS (
  SELECT w, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS weight
  FROM (SELECT w, count(*) AS df FROM counted GROUP BY w), totals),
scores AS (
  SELECT item, item_id, rid, doc_id,
    sum(q * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN weights USING (w) JOIN counted USING (w) JOIN docs USING (rid), totals
  WHERE doc_id IS NOT NULL GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id))::INT AS rank FROM scores WHERE score > 0)
WHERE rank <= 20
""")
def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents", "doc_id", "text"),
                          table(spark, sf_dir, "benchmark", "item_id", "text"))


@query("op12_prefix_trie", """
WITH turns AS (
  SELECT conv_id, turn, md5(md5(coalesce(role, '')) || md5(coalesce(text, ''))) AS k,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) AS words
  FROM conversations WHERE conv_id IS NOT NULL),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS n FROM turns),
-- CRC-32 of the id's decimal text: each character is mixed in, then eight shifts
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
    xor(list_reduce(list_prepend(4294967295::BIGINT, flatten([[ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]
        FOR c IN string_split(conv_id::VARCHAR, '')])),
      lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END),
      4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT c.conv_id, 0 AS own, n, k, words FROM convs c JOIN numbered b ON b.conv_id = c.base AND n <= h
  UNION ALL SELECT conv_id, 1, n, k, words FROM convs JOIN numbered USING (conv_id) WHERE n > h),
paths AS (
  SELECT conv_id, list(k ORDER BY own, n) AS ks, list(words ORDER BY own, n) AS ws FROM rebuilt GROUP BY conv_id),
members AS (
  SELECT conv_id, coalesce(ks, []) AS ks, coalesce(ws, []) AS ws FROM convs LEFT JOIN paths USING (conv_id)),
seen AS (
  SELECT conv_id, d, array_to_string(ks[1:d], '/') AS node, array_to_string(ks[1:d - 1], '/') AS parent,
    CASE WHEN d > 0 THEN ws[d] ELSE 0 END AS words, d = len(ks) AS ended
  FROM (SELECT *, unnest(range(0, len(ks) + 1)) AS d FROM members)),
nodes AS (
  SELECT node, d, CASE WHEN d > 0 THEN any_value(parent) END AS parent, any_value(words) AS words,
    count(*) AS n_convs, min(conv_id) AS conv_id FROM seen GROUP BY node, d),
ends AS (SELECT node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ends FROM seen WHERE ended GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY parent),
counted AS (SELECT *, coalesce(n_children, 0) AS children FROM nodes LEFT JOIN kids USING (node)),
totals AS (
  SELECT array_to_string(ks[1:a], '/') AS node, sum((children = 0)::INT) AS n_leaves, sum((n_convs - 1) * words) AS saved
  FROM (SELECT c.*, ks, unnest(range(0, d + 1)) AS a FROM counted c JOIN members USING (conv_id)) GROUP BY 1)
SELECT c.conv_id, c.d::BIGINT AS depth, p.conv_id AS parent_conv_id, c.n_convs::BIGINT AS n_convs,
  c.children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens,
  sha256(coalesce(ends, '')) AS ends_sha256
FROM counted c JOIN totals USING (node) LEFT JOIN ends USING (node) LEFT JOIN nodes p ON c.parent = p.node
""")
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rebuilt_trie(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      "ends_sha256")


@query("op13_quality")
def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = score_quality(table(spark, sf_dir, "documents", "doc_id", "text"),
                        table(spark, sf_dir, "labels", "doc_id", "quality"))
    return out.select("document.doc_id", "held_out", "score", "predicted")


@query("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = identify_language(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))
    return out.select("document.doc_id", "held_out", "lang_pred", "score")


@query("op1_topk", """
WITH ints AS (
  SELECT vec_id, embedding, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
asked AS (SELECT vec_id, arg_min(v, embedding) AS v FROM ints WHERE vec_id % 50 = 0 GROUP BY vec_id),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM asked q, ints c WHERE q.vec_id <> c.vec_id),
ranked AS (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
  FROM scores)
SELECT * FROM ranked WHERE rank <= 5
""")
def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 50 == 0)


@query("op6_url_filter", """
WITH rests AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
rules(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fits AS (
  SELECT page_id, h || p AS rule, v, row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC, h || p) AS n
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN regexp_matches('.' || host || path,
  'spam|casino|porn|viagra|/ads/|\\.exe$') THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE n = 1) USING (page_id)
""")
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = filter_urls(table(spark, sf_dir, "pages", "page_id", "url"))
    return out.select("document.page_id", "host", "path", "rule", "verdict")


#: integer weights of the mixing query; sources not named weigh 1
MIX_WEIGHTS = {"domain": {"web": 60, "books": 25, "forums": 15},
               "lang": {"en": 40, "fr": 20, "de": 20, "es": 20},
               "source": {"src0": 2}}


def source_domain():
    """The tables name no domain: a source's number decides it."""
    number = F.try_to_number(F.regexp_extract("source", "([0-9]+)$", 1), F.lit("999999")) % 3
    return F.when(number == 0, "web").when(number == 1, "books").when(number == 2, "forums")


@query("op8_mixing", """
WITH rows AS (
  SELECT doc_id, coalesce(CASE try_cast(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) % 3
      WHEN 0 THEN 'web' WHEN 1 THEN 'books' WHEN 2 THEN 'forums' END, 'unknown') AS domain,
    coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> ''))::BIGINT AS n_tokens
  FROM documents),
kept AS (SELECT * FROM rows WHERE n_tokens > 0 AND doc_id IS NOT NULL),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, sum(n_tokens)::BIGINT * 3 AS supply FROM kept GROUP BY ALL),
d0 AS (
  SELECT domain, sum(supply)::BIGINT AS supply,
    CASE domain WHEN 'web' THEN 60 WHEN 'books' THEN 25 WHEN 'forums' THEN 15 ELSE 1 END AS weight,
    (SELECT floor(sum(tokens) * 0.5::DOUBLE)::BIGINT FROM leaves) AS budget FROM leaves GROUP BY domain),
d1 AS (
  SELECT *, (budget - coalesce(sum(supply) OVER before, 0))::DOUBLE
    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM d0 WINDOW before AS (ORDER BY supply::DOUBLE / weight, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
d2 AS (SELECT domain, least(supply, floor(weight * max(level) OVER ()))::BIGINT AS budget FROM d1),
l0 AS (
  SELECT domain, lang, supply, weight, budget FROM (
    SELECT domain, lang, sum(supply)::BIGINT AS supply,
      CASE lang WHEN 'en' THEN 40 WHEN 'fr' THEN 20 WHEN 'de' THEN 20 WHEN 'es' THEN 20 ELSE 1 END AS weight
    FROM leaves GROUP BY domain, lang) JOIN d2 USING (domain)),
l1 AS (
  SELECT *, (budget - coalesce(sum(supply) OVER before, 0))::DOUBLE
    / (sum(weight) OVER (PARTITION BY domain) - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM l0 WINDOW before AS (PARTITION BY domain ORDER BY supply::DOUBLE / weight, lang
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l2 AS (SELECT domain, lang, least(supply, floor(weight * max(level) OVER (PARTITION BY domain)))::BIGINT AS budget FROM l1),
s0 AS (
  SELECT domain, lang, source, tokens, supply, CASE source WHEN 'src0' THEN 2 ELSE 1 END AS weight, budget
  FROM leaves JOIN l2 USING (domain, lang)),
s1 AS (
  SELECT *, (budget - coalesce(sum(supply) OVER before, 0))::DOUBLE
    / (sum(weight) OVER (PARTITION BY domain, lang) - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM s0 WINDOW before AS (PARTITION BY domain, lang ORDER BY supply::DOUBLE / weight, source
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s2 AS (
  SELECT domain, lang, source, tokens,
    least(supply, floor(weight * max(level) OVER (PARTITION BY domain, lang)))::BIGINT AS budget FROM s1),
s3 AS (SELECT *, budget // tokens AS full_epochs, budget % tokens AS rest FROM s2),
running AS (
  SELECT doc_id, domain, lang, source, n_tokens, full_epochs, rest, sum(n_tokens) OVER (PARTITION BY domain, lang, source
    ORDER BY md5('42:' || (full_epochs + 1) || ':' || doc_id), n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM kept JOIN s3 USING (domain, lang, source))
SELECT doc_id, domain, lang, source, n_tokens, (full_epochs + 1)::INT AS epoch FROM running WHERE upto <= rest
UNION ALL
SELECT doc_id, domain, lang, source, n_tokens, unnest(range(1, full_epochs + 1))::INT AS epoch FROM running
""")
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"), source_domain(), MIX_WEIGHTS)


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline      # it imports this module
    return corpus_pipeline.run(spark, sf_dir)
