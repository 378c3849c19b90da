"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm import bpe, chat_format, exact_dedup, hard_negatives, licenses, line_dedup, ngram_join, packing, prefix_trie, quality_model, quality_rules, toxicity, url_filter
from cohortkit.llm.common import read_docs


def tokenizer_file(name: str) -> str:
    """Where the public vocabulary files lie; other places can be given to the operators."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_docs(spark, sf_dir)).drop("places").withColumn("score", F.round("score", 6))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read_docs(spark, sf_dir)).drop("n_chunks")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(read_docs(spark, sf_dir, "pages")).drop("by")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_of(read_docs(spark, sf_dir), read_docs(spark, sf_dir, "labels"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                "conv_id bigint, turn bigint, role string, text string")
    turns = read_docs(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat_format.conversation_digests(chat_format.format_windows(turns))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_classes(read_docs(spark, sf_dir)).drop("first")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_docs(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_quality(read_docs(spark, sf_dir))


def op9_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality_of(read_docs(spark, sf_dir), read_docs(spark, sf_dir, "labels"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_docs(spark, sf_dir).select("doc_id", "text")
    coded = bpe.recode_documents(docs, tokenizer_file("word_bpe_49k.json"))
    return coded.select(
        "doc_id", F.size("coded.ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("coded.ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("coded.decoded", 256).alias("decoded_sha256"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_docs(spark, sf_dir, "conversations")
    ids = prefix_trie.ids_of(conversations)
    return prefix_trie.prefix_trie(prefix_trie.branched(prefix_trie.digested_turns(conversations), ids), ids)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = read_docs(spark, sf_dir, "embeddings").withColumn("label", relabelled)
    return hard_negatives.mine_negatives(vectors, F.col("vec_id") % 50 == 0)


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(read_docs(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_url_filter": op3_url_filter,
    "op4_toxicity": op4_toxicity,
    "op5_chat_format": op5_chat_format,
    "op6_ngram_join": op6_ngram_join,
    "op7_packing": op7_packing,
    "op8_quality_rules": op8_quality_rules,
    "op9_quality_model": op9_quality_model,
    "op10_bpe": op10_bpe,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_line_dedup": op13_line_dedup,
}

def _license_sql() -> str:
    """Every posting at every place: the key phrase must stand, the IDF found decides."""
    postings, targets = licenses.build_index(licenses.BASE_PHRASES, licenses.TEMPLATES + licenses.WHOLE_TEXTS)
    values = ", ".join(f"('{p.word}', {p.target}, {p.rel}, {int(p.key)})" for p in postings)
    named = ", ".join(f"({t['target']}, '{t['label']}', {t['base']})" for t in targets)
    return rf"""
WITH post(word, target, rel, key) AS (VALUES {values}), named(target, label, base) AS (VALUES {named}),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS pos FROM d),
idf AS (SELECT v.word, coalesce(ln(1 + (SELECT count(*) FROM d) / nullif(count(DISTINCT doc_id), 0)), 1.0) AS idf
        FROM (SELECT DISTINCT word FROM post) v LEFT JOIN w ON w.word = v.word GROUP BY v.word),
whole AS (SELECT target, sum(idf) AS whole, sum(key) AS n_key FROM post JOIN idf ON post.word = idf.word GROUP BY target),
hit AS (SELECT doc_id, target, pos - rel AS start, sum(key) AS n, sum(idf) AS found
        FROM w JOIN post ON w.word = post.word JOIN idf ON idf.word = w.word GROUP BY doc_id, target, pos - rel),
place AS (SELECT doc_id, label, base, start, least(1.0, found / whole) AS share
          FROM hit JOIN whole ON hit.target = whole.target AND n = n_key JOIN named ON named.target = hit.target
          WHERE start >= 0 AND (base OR found / whole >= 0.7))
SELECT d.doc_id, CAST(any_value(len(ws)) AS BIGINT) AS n_words, count(*) FILTER (WHERE base) AS n_base, min(start) FILTER (WHERE base) AS first_word,
       max(start) FILTER (WHERE base) AS last_word, coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels,
       round(coalesce(max(CASE WHEN base THEN 1.0 ELSE share END), 0.0), 6) AS score
FROM d LEFT JOIN place ON d.doc_id = place.doc_id GROUP BY d.doc_id"""


# Oracles where SQL can express the whole result.
SQL: dict[str, str] = {
    "op1_license_scan": _license_sql(),
    "op2_exact_dedup": r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n""",
    "op3_url_filter": r"""
WITH r AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
rules(v, rh, rp) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                            ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
best AS (SELECT page_id, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(v, length(rh || rp)) AS v
         FROM h JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id)
SELECT h.page_id, host, path, rule,
       coalesce(v, CASE WHEN list_has_any(string_split(replace(host, '-', '.'), '.'),
                                          ['casino', 'pills', 'porn', 'spam', 'viagra', 'xxx']) THEN 'block' ELSE 'allow' END) AS verdict
FROM h LEFT JOIN best ON h.page_id = best.page_id""",
    # spans by sums inside blocks of 128 turn numbers; what each window shows counts into formatted_chars
    "op5_chat_format": r"""
WITH raw AS (SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
             UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
cost AS (SELECT *, coalesce(floor(turn / 128), -4611686018427387904) AS blk,
                len(regexp_extract_all(x, '\p{L}{1,6}|\p{N}{1,3}|[^\x20\x09-\x0D\p{L}\p{N}]')) + 6 AS cost,
                14 + length(replace(replace(replace(x, '\', '\b'), '</turn>', '\e'), '### ', '\h'))
                   + length(replace(replace(replace(replace(r, '\', '\b'), '</turn>', '\e'), '### ', '\h'), chr(10), '\n')) AS chars FROM raw),
p AS (SELECT *, sum(cost) OVER (PARTITION BY c, blk ORDER BY turn NULLS FIRST, r, x ROWS UNBOUNDED PRECEDING) AS e,
             sum(cost) OVER (PARTITION BY c, blk) AS total, dense_rank() OVER (PARTITION BY c ORDER BY blk) AS nth,
             row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, r, x) AS k FROM cost),
t AS (SELECT *, e - cost AS s, nth = 1 AND e = cost AND r = 'system' AS head FROM p),
w AS (SELECT c, nth, min(s) AS w, sum(chars) AS chars FROM t GROUP BY c, nth, floor((e - 1) / 512), cost >= 512),
shown AS (SELECT c, chars FROM w
          UNION ALL SELECT w.c, t.chars FROM w JOIN t ON w.c = t.c AND w.nth = t.nth AND t.s < w.w AND w.w - t.s <= 256 AND NOT t.head
          UNION ALL SELECT w.c, t.chars FROM w JOIN t ON w.c = t.c AND w.nth = t.nth + 1 AND w.w + t.total - t.s <= 256
          UNION ALL SELECT w.c, t.chars FROM w JOIN t ON w.c = t.c AND t.head AND NOT (w.nth = 1 AND w.w = 0)),
f AS (SELECT c, CAST(sum(chars) AS BIGINT) AS formatted_chars FROM shown GROUP BY c)
SELECT t.c AS conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY k)) AS turns_sha256,
       CAST(coalesce(sum(length(x)) FILTER (WHERE r = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(x, '' ORDER BY k) FILTER (WHERE r = 'assistant'), '')) AS loss_sha256, any_value(formatted_chars) AS formatted_chars
FROM t JOIN f ON t.c = f.c GROUP BY t.c""",
    # all pairs that share a shingle, then everything that links reach
    "op6_ngram_join": r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM d),
g AS (SELECT doc_id, n, i, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o) AS s
      FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
sh AS (SELECT DISTINCT doc_id, s FROM g WHERE i <= greatest(n - 3, 1)),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * o >= 85 * (x.n + y.n - o)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(v, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT v, b FROM reach JOIN edge ON r = a)
SELECT documents.doc_id, coalesce(size.n, 0) AS n_shingles, c.component_id
FROM documents LEFT JOIN size ON size.doc_id = documents.doc_id
JOIN (SELECT v, min(r) AS component_id FROM reach GROUP BY v) c ON c.v = documents.doc_id""",
    # crc32 bit by bit, then every node with each of its ancestors
    "op11_prefix_trie": r"""
WITH RECURSIVE crc(c, k, v) AS (
  SELECT DISTINCT conv_id, 0, CAST(4294967295 AS BIGINT) FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL
  SELECT c, k + 1, CASE WHEN w & 1 = 1 THEN xor(w >> 1, CAST(3988292384 AS BIGINT)) ELSE w >> 1 END
  FROM (SELECT c, k, CASE WHEN k % 8 = 0 THEN xor(v, CAST(ascii(substr(CAST(c AS VARCHAR), k // 8 + 1, 1)) AS BIGINT)) ELSE v END AS w
        FROM crc WHERE k < 8 * length(CAST(c AS VARCHAR))) s),
conv AS (SELECT c, c - c % 5 AS b, xor(v, CAST(4294967295 AS BIGINT)) % 9 AS h FROM crc WHERE k = 8 * length(CAST(c AS VARCHAR))),
t AS (SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos FROM conversations),
re AS (SELECT c, 0 AS seg, pos, r, x FROM conv JOIN t ON t.conv_id = b AND pos <= h
       UNION ALL SELECT c, 1, pos, r, x FROM conv JOIN t ON t.conv_id = c AND pos > h),
o AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY seg, pos) AS depth, count(*) OVER (PARTITION BY c) AS n FROM re),
m AS (SELECT c, depth, list({'r': r, 'x': x}) OVER (PARTITION BY c ORDER BY depth) AS path, strlen(x) AS bytes, depth = n AS last FROM o
      UNION ALL SELECT c, 0, [], 0, c NOT IN (SELECT c FROM re) FROM conv),
node AS (SELECT path, depth, min(c) AS conv_id, count(*) AS n, min(bytes) AS bytes,
                sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE last), '')) AS ends
         FROM m GROUP BY path, depth),
kid AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1),
full_node AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kid ON node.path = kid.path),
up AS (SELECT path[1:d] AS path, n, bytes, n_children FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM full_node) s),
below AS (SELECT path, CAST(count(*) FILTER (WHERE n_children = 0) AS BIGINT) AS n_leaves,
                 CAST(sum((n - 1) * bytes) AS BIGINT) AS saved_tokens FROM up GROUP BY path)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n AS n_convs, f.n_children, n_leaves, saved_tokens, f.ends AS ends_sha256
FROM full_node f JOIN below ON f.path = below.path LEFT JOIN node p ON f.depth > 0 AND p.path = f.path[1:f.depth - 1]""",
    "op12_hard_negatives": r"""
WITH x AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL),
v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list(floor(256 * CAST(x AS DOUBLE)) ORDER BY i) AS q
      FROM x GROUP BY vec_id, label HAVING bool_and(x IS NOT NULL AND isfinite(x))),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
             CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
     AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3""",
    "op13_line_dedup": r"""
WITH n AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM n),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE key IN (SELECT key FROM f)) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE key NOT IN (SELECT key FROM f)), '')) AS kept_sha256
FROM k GROUP BY doc_id""",
}
