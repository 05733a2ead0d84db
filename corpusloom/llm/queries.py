"""The registered query of each operator, with SQL where SQL can express it. Each runs over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.llm.approx_search import nearest
from corpusloom.llm.common import documents, table
from corpusloom.llm.exact_dedup import exact_duplicates
from corpusloom.llm.exact_search import top_products
from corpusloom.llm.importance import resample
from corpusloom.llm.language_id import identify
from corpusloom.llm.line_dedup import drop_recurring
from corpusloom.llm.merkle import merkle_manifest
from corpusloom.llm.mixing import mix
from corpusloom.llm.near_dedup import near_duplicates
from corpusloom.llm.packing import pack_documents
from corpusloom.llm.substring_dedup import repeated_units
from corpusloom.llm.token_counts import count_tokens
from corpusloom.llm.url_rules import ALLOW, BLOCK, judge_urls

TOKENIZER, CAPACITY = "word_bpe_49k.json", 2048

# Fixed values of the URL query.
URL_RULES = {
    "com/": ALLOW,
    "example.com/en/": BLOCK,
    "www.example.com/en/": ALLOW,
    "net/es/": BLOCK,
    "net/fr/": BLOCK,
}


def tokenizer_path() -> str:
    return public_tokenizers.path(TOKENIZER)


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(documents(spark, folder, "doc_id", "text"), tokenizer_path(), CAPACITY)


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return drop_recurring(table(spark, folder, "documents"))


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(documents(spark, folder, "doc_id", "text"), tokenizer_path(), CAPACITY)


def op4_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(table(spark, folder, "pages"), URL_RULES)


def op5_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_products(table(spark, folder, "embeddings"))


def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    left = repeated_units(documents(spark, folder, "doc_id", "text"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return left.withColumn("spans", spans)


def op7_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(documents(spark, folder, "doc_id", "text", "source"), table(spark, folder, "labels"))


def op8_adaptive_scan(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"))


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder, "doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    judged = identify(docs, ~held_out)
    return judged.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(documents(spark, folder, "doc_id", "text"), shingle=2)


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder, "doc_id", "source", "lang", "n_chars", "text")
    # Tampering: where the checksum of the id is even, the line breaks are gone.
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    shown = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle_manifest(docs, presented={"text": shown}).drop("path")


def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resample(documents(spark, folder, "doc_id", "text"), table(spark, folder, "benchmark")).drop("n_words")


def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(documents(spark, folder, "doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_best_fit_packing, op2_line_dedup, op3_token_counts, op4_url_filters, op5_exact_top_k, op6_substring_dedup,
        op7_source_mixing, op8_adaptive_scan, op9_language_id, op10_minhash_near_dedup,
        op11_merkle_manifest, op12_importance_resampling, op13_exact_dedup,
    )
}

SQL: dict[str, str] = {
    "op5_exact_top_k": """
WITH usable AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
whole AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * x::DOUBLE) AS BIGINT)) AS v FROM usable),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, 1 + greatest(len(q.v), len(c.v))),
                                      lambda i: coalesce(q.v[i], 0) * coalesce(c.v[i], 0))) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 10
""",
    "op6_substring_dedup": r"""
WITH sentences AS (
  SELECT doc_id, text, list_filter(regexp_extract_all(text, '(?s)(.*?(?:[.!?…]+["'')\]]*[ \t\r\n\f]+|\n[ \t\r\n\f]*\n)|.+$)', 1), lambda x: x <> '') AS parts
  FROM documents WHERE text IS NOT NULL),
sentence AS (SELECT doc_id, generate_subscripts(parts, 1) AS s, unnest(parts) AS part FROM sentences),
placed AS (SELECT *, CAST(sum(length(part)) OVER (PARTITION BY doc_id ORDER BY s) - length(part) AS BIGINT) AS at_char FROM sentence),
tokens AS (
  SELECT doc_id, s, at_char, regexp_extract_all(part, '[^\p{L}\p{N}]*[\p{L}\p{N}]+') AS t FROM placed),
token AS (
  SELECT doc_id, s, at_char, len(t) AS n, generate_subscripts(t, 1) AS k, unnest(t) AS token FROM tokens),
word AS (
  SELECT *, lower(regexp_extract(token, '[\p{L}\p{N}]+$')) AS w,
         CAST(at_char + sum(length(token)) OVER (PARTITION BY doc_id, s ORDER BY k) - length(regexp_extract(token, '[\p{L}\p{N}]+$')) AS BIGINT) AS word_char
  FROM token),
cuts AS (
  SELECT w, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
             list_transform(range(1, 2 * strlen(w), 2), lambda p: CAST('0x' || substr(hex(encode(w)), p, 2) AS BIGINT))),
             lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 8 = 0 AS cut
  FROM (SELECT DISTINCT w FROM word WHERE n > 12)),
numbered AS (
  SELECT doc_id, word.w, row_number() OVER (PARTITION BY doc_id ORDER BY s, k) - 1 AS number, k = 1 OR (n > 12 AND cut) AS opens,
         CASE WHEN k = 1 THEN at_char ELSE word_char END AS opens_at
  FROM word LEFT JOIN cuts ON word.w = cuts.w),
wordlists AS (SELECT doc_id, list(w ORDER BY number) AS ws FROM numbered GROUP BY doc_id),
unit AS (
  SELECT doc_id, number AS a, lead(number, 1, len(ws)) OVER u AS b, CASE WHEN row_number() OVER u = 1 THEN 0 ELSE opens_at END AS start,
         lead(opens_at, 1, length(text)) OVER u AS stop
  FROM numbered JOIN wordlists USING (doc_id) JOIN documents USING (doc_id) WHERE opens WINDOW u AS (PARTITION BY doc_id ORDER BY number)),
run AS (
  SELECT x.doc_id, x.a, y.b, x.start, y.stop, array_to_string(ws[x.a + 1 : y.b], ' ') AS words
  FROM unit x ASOF JOIN unit y ON x.doc_id = y.doc_id AND x.a + 30 <= y.b JOIN wordlists l ON l.doc_id = x.doc_id),
ranked AS (SELECT *, first_value(doc_id) OVER r AS first_doc, first_value(b) OVER r AS first_b FROM run WINDOW r AS (PARTITION BY words ORDER BY doc_id, a)),
losing AS (SELECT * FROM ranked WHERE doc_id <> first_doc OR a >= first_b),
gone AS (SELECT DISTINCT u.doc_id, u.start, u.stop FROM unit u JOIN losing l ON u.doc_id = l.doc_id AND u.a >= l.a AND u.b <= l.b),
marked AS (
  SELECT u.doc_id, u.start, u.stop, g.start IS NOT NULL AS gone,
         coalesce(lag(g.start IS NOT NULL) OVER (PARTITION BY u.doc_id ORDER BY u.start), FALSE) AS before
  FROM unit u LEFT JOIN gone g ON u.doc_id = g.doc_id AND u.start = g.start),
islands AS (SELECT *, sum((gone <> before)::INT) OVER (PARTITION BY doc_id ORDER BY start) AS island FROM marked),
stretches AS (SELECT doc_id, island, gone, min(start) AS a, max(stop) AS b FROM islands GROUP BY ALL),
whole AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, CAST(coalesce(sum(b - a) FILTER (gone), 0) AS BIGINT) AS removed_chars,
         coalesce(string_agg(substr(text, a + 1, b - a), '' ORDER BY a) FILTER (NOT gone), '') AS text,
         coalesce(string_agg(a || '-' || b, ',' ORDER BY a) FILTER (NOT gone), '') AS spans
  FROM stretches JOIN documents USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN w.doc_id IS NULL THEN d.text ELSE w.text END AS text, coalesce(n_removed, 0) AS n_removed,
       coalesce(removed_chars, 0) AS removed_chars, coalesce(spans, CASE WHEN length(d.text) > 0 THEN '0-' || length(d.text) ELSE '' END) AS spans
FROM documents d LEFT JOIN whole w USING (doc_id)
""",
    "op7_source_mixing": r"""
WITH RECURSIVE sized AS (
  SELECT d.doc_id, d.source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CASE WHEN q.quality > 0 THEN 2.0 WHEN q.quality <= 0 THEN 0.5 ELSE 1.0 END AS w
  FROM documents d LEFT JOIN (SELECT doc_id, min(quality) AS quality FROM labels GROUP BY doc_id) q USING (doc_id)),
sources AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS total,
         CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS w
  FROM sized GROUP BY source),
capped AS (
  SELECT 0 AS round, source, total, w, FALSE AS closed FROM sources
  UNION ALL
  SELECT round + 1, source, total, w, closed OR w * (sum(total) OVER () - coalesce(sum(3 * total) FILTER (closed) OVER (), 0))
         / sum(w) FILTER (NOT closed) OVER () > 3 * total
  FROM capped WHERE round < 30),
targets AS (
  SELECT source, total, CASE WHEN closed THEN 3 * total
         ELSE (sum(total) OVER () - coalesce(sum(3 * total) FILTER (closed) OVER (), 0)) * w / sum(w) FILTER (NOT closed) OVER () END AS target
  FROM capped WHERE round = 30),
keyed AS (
  SELECT s.*, t.total, t.target,
         -ln((CAST('0x' || substr(md5('17|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) + 0.5) / 281474976710656.0) / s.w AS k
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
running AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto FROM keyed),
shares AS (
  SELECT *, CASE WHEN total > 0 THEN floor(target / total) ELSE 0 END AS epochs,
         target - CASE WHEN total > 0 THEN floor(target / total) ELSE 0 END * total AS rest FROM running),
taken AS (
  SELECT *, least(3, epochs + CASE WHEN rest > 0 AND (upto <= rest OR (upto - rest < rest - (upto - size) AND upto - size < rest))
                             THEN 1 ELSE 0 END) AS copies FROM shares)
SELECT doc_id, size, CAST(total AS BIGINT) AS source_size, target, CAST(copies AS INTEGER) AS copies,
       CAST(copies * size AS BIGINT) AS taken
FROM taken
""",
    "op10_minhash_near_dedup": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) = 1 THEN w
         ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS s FROM words),
classes AS (SELECT s, min(doc_id) AS rep FROM sets WHERE len(s) > 0 GROUP BY s),
shingles AS (SELECT rep, len(s) AS n, unnest(s) AS x FROM classes),
links AS (
  SELECT a.rep AS a, b.rep AS b FROM shingles a JOIN shingles b
    ON a.x = b.x AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT rep AS node, rep AS other FROM classes
  UNION
  SELECT r.node, e.b FROM reach r JOIN edges e ON r.other = e.a),
component AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(k.component_id, d.doc_id) AS component_id,
       d.doc_id = coalesce(k.component_id, d.doc_id) AS kept
FROM sets d LEFT JOIN classes c ON c.s = d.s LEFT JOIN component k ON k.node = c.rep
""",
    "op11_merkle_manifest": r"""
WITH RECURSIVE enc AS (
  SELECT doc_id, source,
         concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS front,
         text, replace(text, chr(10), '') AS flat,
         xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
             lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) AS crc
  FROM documents),
leaves AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS pos, count(*) OVER (PARTITION BY source) AS size,
         sha256(front || coalesce(strlen(text) || ':' || text, '-')) AS hash,
         CASE WHEN crc % 2 = 0 THEN sha256(front || coalesce(strlen(flat) || ':' || flat, '-'))
              ELSE sha256(front || coalesce(strlen(text) || ':' || text, '-')) END AS shown
  FROM enc),
nodes AS (
  SELECT 0 AS height, tree, pos, size, hash FROM leaves
  UNION ALL
  SELECT height + 1, tree, pos // 3, (size + 2) // 3, sha256(string_agg(hash, '' ORDER BY pos))
  FROM nodes WHERE size > 1 GROUP BY height, tree, pos // 3, size),
subroots AS (SELECT tree, hash, height FROM nodes WHERE size = 1),
top AS (
  SELECT 0 AS height, tree AS pos, (SELECT count(*) FROM subroots) AS size, hash FROM subroots
  UNION ALL
  SELECT height + 1, pos // 3, (size + 2) // 3, sha256(string_agg(hash, '' ORDER BY pos)) FROM top WHERE size > 1 GROUP BY height, pos // 3, size),
beside AS (
  SELECT n.tree, n.height, n.pos, coalesce(string_agg(s.hash, '' ORDER BY s.pos) FILTER (s.pos < n.pos), '') AS l,
         coalesce(string_agg(s.hash, '' ORDER BY s.pos) FILTER (s.pos > n.pos), '') AS r
  FROM nodes n JOIN nodes s ON n.tree = s.tree AND n.height = s.height AND n.pos // 3 = s.pos // 3 WHERE n.size > 1 GROUP BY ALL),
top_beside AS (
  SELECT n.height, n.pos, coalesce(string_agg(s.hash, '' ORDER BY s.pos) FILTER (s.pos < n.pos), '') AS l,
         coalesce(string_agg(s.hash, '' ORDER BY s.pos) FILTER (s.pos > n.pos), '') AS r
  FROM top n JOIN top s ON n.height = s.height AND n.pos // 3 = s.pos // 3 WHERE n.size > 1 GROUP BY ALL),
steps AS (
  SELECT v.doc_id, v.tree, v.shown, b.height AS step, b.l, b.r FROM leaves v JOIN beside b
    ON v.tree = b.tree AND b.pos = CAST(floor(v.pos / pow(3, b.height)) AS BIGINT)
  UNION ALL
  SELECT v.doc_id, v.tree, v.shown, s.height + t.height, t.l, t.r FROM leaves v JOIN subroots s ON v.tree = s.tree
    JOIN top_beside t ON t.pos = CAST(floor(v.tree / pow(3, t.height)) AS BIGINT)),
proofs AS (
  SELECT doc_id, sha256(string_agg(l || r, '' ORDER BY step)) AS proof, list(struct_pack(l := l, r := r) ORDER BY step) AS path
  FROM steps GROUP BY doc_id),
fold AS (
  SELECT v.doc_id, 1 AS step, v.shown AS h, p.path FROM leaves v LEFT JOIN proofs p USING (doc_id)
  UNION ALL
  SELECT doc_id, step + 1, sha256(path[step].l || h || path[step].r), path FROM fold WHERE step <= len(path)),
ends AS (SELECT doc_id, arg_max(h, step) AS folded_root FROM fold GROUP BY doc_id),
root AS (SELECT hash AS root FROM top WHERE size = 1)
SELECT v.doc_id, v.hash AS leaf, s.hash AS subroot, root, coalesce(p.proof, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves v JOIN subroots s USING (tree) LEFT JOIN proofs p USING (doc_id) JOIN ends USING (doc_id) CROSS JOIN root
""",
    "op12_importance_resampling": r"""
WITH low AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
goal AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
words AS (SELECT doc_id, unnest(w) AS word FROM low),
bucketed AS (
  SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
             list_transform(range(1, 2 * strlen(word), 2), lambda p: CAST('0x' || substr(hex(encode(word)), p, 2) AS BIGINT))),
             lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 10000 AS bucket
  FROM (SELECT word FROM words UNION SELECT word FROM goal)),
source AS (SELECT bucket, count(*) AS s FROM words JOIN bucketed USING (word) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM goal JOIN bucketed USING (word) GROUP BY bucket),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1) * ((SELECT count(*) FROM words) + 10000)::DOUBLE
         / ((coalesce(s, 0) + 1) * ((SELECT count(*) FROM goal) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM source FULL JOIN target USING (bucket)),
weighed AS (
  SELECT doc_id, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight
  FROM words JOIN bucketed USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5)::DOUBLE / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM low LEFT JOIN weighed USING (doc_id)),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
""",
    "op13_exact_dedup": r"""
WITH low AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM low WINDOW same AS (PARTITION BY t)
""",
}
