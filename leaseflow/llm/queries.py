"""Registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import public_tokenizers

from leaseflow.llm import (
    collocations,
    exact_dedup,
    lexical_search,
    mixing,
    ngram_join,
    packing,
    secret_scan,
    substring_dedup,
    token_counts,
    toxicity,
    url_filters,
    vector_neighbours,
    warc,
)
from leaseflow.llm.shipping import ship

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register(name: str, sql: str | None = None):
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = sql
        return query
    return add


@register("op9_exact_dedup", r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
  FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY body)""")
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents")).drop("row_key")


#: Components of a CTE ``links`` (u, v, both ways), as ``roots`` (id, root).
_ROOTS = """
reach AS (
  SELECT DISTINCT u AS id, u AS root FROM links
  UNION SELECT r.id, l.v FROM reach r JOIN links l ON l.u = r.root),
roots AS (SELECT id, min(root) AS root FROM reach GROUP BY id)"""


@register("op10_ngram_jaccard_join", r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x09-\x0D\x20-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+') AS words FROM documents),
runs AS (
  SELECT DISTINCT doc_id, list_aggregate(words[i:i + 4], 'string_agg', ' ') AS run
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i
        FROM texts WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM runs GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n
  FROM runs a JOIN runs b ON a.run = b.run AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT u, v FROM shared s JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v
  WHERE 5 * s.n >= 4 * (a.n + b.n - s.n)),""" + _ROOTS + """
SELECT d.doc_id, coalesce(r.root, d.doc_id) AS class_id, coalesce(n.n, 0) AS n_links,
       coalesce(r.root, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN roots r ON r.id = d.doc_id
LEFT JOIN (SELECT u, count(*) AS n FROM links GROUP BY u) n ON n.u = d.doc_id""")
def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents")).drop("row_key")


@register("op8_mixing")
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    quality = mixing.quality_weights(table(spark, sf_dir, "labels"))
    return mixing.mix(table(spark, sf_dir, "documents"), quality).drop("row_key")


@register("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"),
                        public_tokenizers.path("word_bpe_49k.json"))


@register("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "rejected")


@register("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("byte_bpe_50k.json"))


URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
             ("allow", "com/fr/"), ("block", "com/de/")]


@register("op7_url_filters", r"""
WITH parts AS (
  SELECT page_id, url, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages), ruled AS (
  SELECT page_id, host, path, CASE
    WHEN '.' || host LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN '.' || host LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN '.' || host LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN '.' || host LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN '.' || host LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM parts)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches(host || path,
      '(/wp-login\.php|/user/login|/cart/checkout|\.tar\.gz|\.iso)([^0-9A-Za-z]|$)|/cgi-bin/')
    THEN 'block' ELSE 'allow' END AS verdict
FROM ruled""")
def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [url_filters.host_rule(verdict, rule) for verdict, rule in URL_RULES]
    return url_filters.judge(table(spark, sf_dir, "pages"), [*rules, *url_filters.PATTERNS])


@register("op3_warc", r"""
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS html, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last
  FROM pages), bits AS (
  SELECT page_id, last, octet_length(encode(html)) AS payload_bytes,
         unhex(sha1(html))::BIT::VARCHAR AS digest_bits
  FROM payloads)
SELECT page_id, payload_bytes,
       list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + substr(digest_bits, 1 + 5 * k, 5)::BIT::INTEGER, 1) FOR k IN range(32)],
         'string_agg', '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM bits""")
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), warc.archive_folder(spark))
    return warc.read_archives(spark, manifest).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op5_vector_neighbours", """
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
norms AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS norm FROM vectors),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM norms a JOIN norms b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) >= 0.9 * a.norm * b.norm),""" + _ROOTS + """
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, coalesce(r.root, e.vec_id) AS component_id,
       coalesce(r.root, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN roots r ON r.id = e.vec_id
LEFT JOIN (SELECT u, count(*) AS n FROM links GROUP BY u) n ON n.u = e.vec_id""")
def op5_vector_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_neighbours.near_vectors(table(spark, sf_dir, "embeddings"))


@register("op2_substring_dedup", r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, i, list_aggregate(words[i:i + 12], 'string_agg', ' ') AS body
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM texts)),
earlier AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY body) AS least FROM windows)
  WHERE least < doc_id),
covered AS (SELECT DISTINCT doc_id, i + k AS i FROM earlier, range(13) t(k)),
marked AS (
  SELECT w.doc_id, w.i, w.word, c.i IS NULL AS stays
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM texts) w
  LEFT JOIN covered c ON c.doc_id = w.doc_id AND c.i = w.i)
SELECT d.doc_id, count(m.i) AS n_words, count(*) FILTER (WHERE NOT m.stays) AS n_removed,
       sha256(coalesce(string_agg(m.word, ' ' ORDER BY m.i) FILTER (WHERE m.stays), '')) AS kept_sha256
FROM documents d LEFT JOIN marked m ON m.doc_id = d.doc_id GROUP BY d.doc_id""")
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


@register("op12_collocations", r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
parts AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM parts GROUP BY lang),
runs AS (
  SELECT lang, m, w, unnest(range(1, len(w) - m + 2)) AS i
  FROM parts, (SELECT unnest(range(1, 5)) AS m) WHERE len(w) >= m),
f AS (
  SELECT lang, m, list_aggregate(w[i:i + m - 1], 'string_agg', ' ') AS phrase, count(*) AS a
  FROM runs GROUP BY ALL HAVING count(*) >= 30),
longer AS (SELECT lang, m AS long_m, string_split(phrase, ' ') AS w, a FROM f WHERE m > 2),
inside AS (
  SELECT lang, list_aggregate(w[i:i + s - 1], 'string_agg', ' ') AS phrase, max(a) AS a
  FROM (SELECT lang, w, a, s, unnest(range(1, long_m - s + 2)) AS i
        FROM longer, (SELECT unnest(range(2, 4)) AS s) WHERE s < long_m) GROUP BY ALL),
kept AS (
  SELECT c.lang, c.m, c.phrase, c.a, string_split(c.phrase, ' ') AS w
  FROM f c LEFT JOIN inside i ON i.lang = c.lang AND i.phrase = c.phrase
  WHERE c.m > 1 AND (i.a IS NULL OR 100::HUGEINT * i.a < 80::HUGEINT * c.a)),
cuts AS (
  SELECT lang, phrase, a, k, list_aggregate(w[1:k], 'string_agg', ' ') AS head,
         list_aggregate(w[k + 1:], 'string_agg', ' ') AS rest
  FROM (SELECT *, unnest(range(1, m)) AS k FROM kept)),
scored AS (
  SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r,
         ((2000000::HUGEINT * c.a) // (x.a + y.a)::HUGEINT)::BIGINT AS score,
         row_number() OVER (PARTITION BY c.lang, c.phrase
           ORDER BY (2000000::HUGEINT * c.a) // (x.a + y.a)::HUGEINT, k) AS place
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.head
  JOIN f y ON y.lang = c.lang AND y.phrase = c.rest),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
         phrase, a, l, r, score
  FROM scored WHERE place = 1)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000""")
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@register("op11_lexical_search", r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
sized AS (SELECT doc_id, terms, len(terms)::BIGINT AS n FROM docs WHERE len(terms) > 0),
whole AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS words FROM sized),
counts AS (
  SELECT doc_id, n, term, count(*)::BIGINT AS tf
  FROM (SELECT doc_id, n, unnest(terms) AS term FROM sized) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counts, whole GROUP BY term, n_docs),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scored AS (
  SELECT a.item_id, c.doc_id, sum(w.w * ((1000000000 * c.tf)
    // (1000 * c.tf + 8 * (10 + (90 * c.n * n_docs) // words))))::BIGINT AS score
  FROM asked a JOIN weights w ON w.term = a.term JOIN counts c ON c.term = a.term, whole
  GROUP BY a.item_id, c.doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place
  FROM scored WHERE score > 0)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM ranked WHERE place <= 10""")
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op13_secret_scan")
def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.find_secrets(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken")))
