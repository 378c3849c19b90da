"""Note and embedding keys: tokens, token windows, entities, mean vectors, similarity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.operators import tagger
from cohortkit.operators import text as T
from cohortkit.operators import vectors as V
from cohortkit.operators import wordspace as W
from cohortkit.plans.standins import StandIns
from cohortkit.sources.io import materialize

SQL: dict[str, str] = {}

WINDOW = 128
VOCAB = 30000
NOTE_SOURCE_PREFIX = "src1"
WORD_DIMS = 8
WORD_STEPS = 127          # vectors hold whole multiples of 1 / WORD_STEPS
UNKNOWN_ONE_IN = 10
QUERY_VEC = 0
TOP_SIMILAR = 10

_TOKENS_SQL = "list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda t: t <> '')"


def _docs(spark: SparkSession, base: str, *cols: str) -> DataFrame:
    return StandIns(spark, base).t("documents", *(cols or ("doc_id", "text")))


def token_counts(spark: SparkSession, base: str) -> DataFrame:
    return T.token_counts(_docs(spark, base, "text"), "text")


SQL["token_counts"] = f"SELECT tok AS token, count(*) AS n FROM (SELECT unnest({_TOKENS_SQL}) AS tok FROM documents) GROUP BY tok"


def tokenize_pad(spark: SparkSession, base: str) -> DataFrame:
    """Whole texts as consecutive 128-token windows of ids, zero-padded, with masks."""
    return T.token_windows(_docs(spark, base), "doc_id", "text", WINDOW, VOCAB)


SQL["tokenize_pad"] = f"""
WITH d AS (SELECT doc_id, {_TOKENS_SQL} AS toks FROM documents),
     t AS (SELECT doc_id, unnest(toks) AS tok, unnest(range(0, len(toks))) AS pos FROM d),
     w AS (SELECT doc_id, CAST(floor(pos / {WINDOW}) AS BIGINT) AS chunk,
                  list((('0x' || substr(md5(tok), 1, 8))::BIGINT % {VOCAB}) + 1 ORDER BY pos) AS ids
           FROM t GROUP BY doc_id, chunk)
SELECT doc_id, chunk, list_transform(range(1, {WINDOW + 1}), lambda i: coalesce(ids[i], 0)) AS ids,
       list_transform(range(1, {WINDOW + 1}), lambda i: CASE WHEN i <= len(ids) THEN 1 ELSE 0 END) AS mask,
       CAST(len(ids) AS INTEGER) AS n_tokens
FROM w
"""


def notes_cohort(spark: SparkSession, base: str) -> DataFrame:
    """Labelled notes of one source family (source prefix), with their text."""
    st = StandIns(spark, base)
    d = st.t("documents", "doc_id", "source", "text").where(F.col("source").startswith(NOTE_SOURCE_PREFIX))
    return d.join(st.t("labels", "doc_id", "quality", "toxic"), "doc_id") \
        .na.drop(subset=["quality"])


SQL["notes_cohort"] = f"""SELECT d.doc_id, d.source, d.text, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id
WHERE d.source LIKE '{NOTE_SOURCE_PREFIX}%' AND l.quality IS NOT NULL"""


def entity_label_counts(spark: SparkSession, base: str) -> DataFrame:
    return T.entity_label_counts(_docs(spark, base, "text"), "text")


SQL["entity_label_counts"] = " UNION ALL ".join(
    f"SELECT '{lab}' AS label, CAST(sum(len(regexp_extract_all(text, '{pat}'))) AS BIGINT) AS n FROM documents"
    for lab, pat in T.ENTITY_PATTERNS)


def entities_of_document(spark: SparkSession, base: str) -> DataFrame:
    return T.entities(_docs(spark, base), "doc_id", "text")


SQL["entities_of_document"] = " UNION ALL ".join(
    f"""SELECT doc_id, '{lab}' AS label, CAST(i - 1 AS INTEGER) AS idx, m[i] AS entity
        FROM (SELECT doc_id, regexp_extract_all(text, '{pat}') AS m FROM documents),
             LATERAL (SELECT unnest(range(1, len(m) + 1)) AS i)"""
    for lab, pat in T.ENTITY_PATTERNS)


def entity_corpus(spark: SparkSession, base: str) -> DataFrame:
    return T.entity_corpus(_docs(spark, base), "doc_id", "text")


SQL["entity_corpus"] = ("SELECT doc_id, regexp_extract_all(text, '" + "|".join(p for _, p in T.ENTITY_PATTERNS)
                        + "') AS entities FROM documents")


# Labels of the five tag sets (general, drugs and diseases, ontologies, concepts, clinical).
TAG_SETS = {
    "general": ("PERSON", "NORP", "FAC", "ORG", "GPE", "LOC", "PRODUCT", "EVENT", "WORK_OF_ART", "LAW", "LANGUAGE",
                "DATE", "TIME", "PERCENT", "MONEY", "QUANTITY", "ORDINAL", "CARDINAL"),
    "drug_disease": ("CHEMICAL", "DISEASE"),
    "ontology": ("GGP", "SO", "TAXON", "CHEBI", "GO", "CL"),
    "concept": ("ENTITY",),
    "clinical": ("LABEL_0", "LABEL_1"),
}
LONGEST_PHRASE = 3
PHRASES_OF_ONE_IN = 40      # the share of benchmark phrases that each tag set lists


def tag_dictionary(spark: SparkSession, base: str) -> DataFrame:
    """(tag_set, phrase, label): phrases of one to three words of the benchmark texts, dealt to sets and labels by md5."""
    words = T.tokens("text")
    n = F.size("w")

    def windows(k: int):
        return F.when(n >= k, F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.array_join(F.slice("w", i, k), " ")))

    phrases = (StandIns(spark, base).t("benchmark", "text").select(words.alias("w"))
               .select(F.explode(F.flatten(F.array_compact(F.array(*[windows(k) for k in range(1, LONGEST_PHRASE + 1)])))).alias("phrase")).distinct())
    part = lambda at: F.conv(F.substring(F.md5("phrase"), at, 4), 16, 10).cast("int")
    names = F.array(*map(F.lit, TAG_SETS))
    labels = F.array(*[F.array(*map(F.lit, v)) for v in TAG_SETS.values()])
    dealt = phrases.withColumn("s", part(1) % PHRASES_OF_ONE_IN).where(F.col("s") < len(TAG_SETS))
    own = F.get(labels, F.col("s"))
    return dealt.select(F.get(names, F.col("s")).alias("tag_set"), "phrase", F.get(own, part(5) % F.size(own)).alias("label"))


_HITS_SQL = f"""RECURSIVE toks AS (SELECT {_TOKENS_SQL} AS w FROM benchmark),
  ph AS (SELECT DISTINCT array_to_string(w[i:i + k - 1], ' ') AS phrase FROM
         (SELECT w, k, unnest(range(1, len(w) - k + 2)) AS i FROM toks, (SELECT unnest(range(1, {LONGEST_PHRASE + 1})) AS k) ks)),
  sets(s, tag_set, labels) AS (VALUES {", ".join(f"({i}, '{name}', {list(v)})" for i, (name, v) in enumerate(TAG_SETS.items()))}),
  dict AS (SELECT tag_set, phrase, labels[('0x' || substr(md5(phrase), 5, 4))::INTEGER % len(labels) + 1] AS label
           FROM ph JOIN sets ON ('0x' || substr(md5(phrase), 1, 4))::INTEGER % {PHRASES_OF_ONE_IN} = s),
  tok AS (SELECT doc_id, unnest(t) AS w, unnest(range(0, len(t))) AS start FROM (SELECT doc_id, {_TOKENS_SQL} AS t FROM documents)),
  win AS (SELECT doc_id, start, 1 AS n, w AS phrase FROM tok
          {" ".join(f"UNION ALL SELECT doc_id, start, {k}, " + " || ' ' || ".join(["w", *[f"lead(w, {j}) OVER (PARTITION BY doc_id ORDER BY start)" for j in range(1, k)]]) + " FROM tok" for k in range(2, LONGEST_PHRASE + 1))}),
  cand AS (SELECT doc_id, tag_set, start, max(n) AS n, arg_max(win.phrase, n) AS entity, arg_max(label, n) AS label
           FROM win JOIN dict ON win.phrase = dict.phrase GROUP BY doc_id, tag_set, start),
  nxt AS (SELECT doc_id, tag_set, start, CASE {" ".join(f"WHEN f{k} >= start + n THEN f{k}" for k in range(1, LONGEST_PHRASE + 1))} END AS following
          FROM (SELECT *, {", ".join(f"lead(start, {k}) OVER (PARTITION BY doc_id, tag_set ORDER BY start) AS f{k}" for k in range(1, LONGEST_PHRASE + 1))}
                FROM cand) s),
  ch(doc_id, tag_set, idx, start) AS (
    SELECT doc_id, tag_set, 0, min(start) FROM cand GROUP BY doc_id, tag_set
    UNION ALL SELECT ch.doc_id, ch.tag_set, idx + 1, following FROM ch JOIN nxt
      ON ch.doc_id = nxt.doc_id AND ch.tag_set = nxt.tag_set AND ch.start = nxt.start AND following IS NOT NULL),
  hits AS (SELECT ch.doc_id, ch.tag_set, CAST(idx AS INTEGER) AS idx, label, CAST(ch.start AS INTEGER) AS start, CAST(n AS INTEGER) AS n_words, entity
           FROM ch JOIN cand ON ch.doc_id = cand.doc_id AND ch.tag_set = cand.tag_set AND ch.start = cand.start)"""


def _tag_counts(tag_set: str):
    def counts(spark: SparkSession, base: str) -> DataFrame:
        own = tag_dictionary(spark, base).where(F.col("tag_set") == tag_set)
        return tagger.label_counts(_docs(spark, base, "text"), "text", own).select("label", "n")

    counts.__doc__ = f"Matches per label of the tag set {tag_set!r} over all texts."
    return counts


TAG_COUNTS = {f"tag_counts_{name}": _tag_counts(name) for name in TAG_SETS}
SQL.update({f"tag_counts_{name}": f"WITH {_HITS_SQL} SELECT label, count(*) AS n FROM hits WHERE tag_set = '{name}' GROUP BY label"
            for name in TAG_SETS})


def tagged_entities(spark: SparkSession, base: str) -> DataFrame:
    """Every match of the five tag sets in each note, in one pass."""
    return tagger.tag_phrases(_docs(spark, base), "doc_id", "text", tag_dictionary(spark, base))


SQL["tagged_entities"] = f"WITH {_HITS_SQL} SELECT doc_id, tag_set, idx, label, start, n_words, entity FROM hits"


def tagged_corpus(spark: SparkSession, base: str) -> DataFrame:
    """The matched phrases of the general tag set of each note, in order (a corpus of entity lists)."""
    return tagger.phrase_lists(_docs(spark, base), "doc_id", "text", tag_dictionary(spark, base), "general")


SQL["tagged_corpus"] = f"""WITH {_HITS_SQL}
SELECT d.doc_id, coalesce(list(entity ORDER BY idx) FILTER (WHERE entity IS NOT NULL), []) AS entities
FROM documents d LEFT JOIN hits ON d.doc_id = hits.doc_id AND tag_set = 'general' GROUP BY d.doc_id"""


def mean_word_vectors(spark: SparkSession, base: str) -> DataFrame:
    """Mean word vector per note; words outside the table and empty notes contribute zeros.

    Every word of the corpus has a vector but for a tenth (by hash) that
    stands for words a pre-trained table does not know.
    """
    counts = materialize(T.word_counts(_docs(spark, base), "doc_id", "text"), name="note-words")
    table = _known_vectors(counts.where(F.col("word").isNotNull()).select("word").distinct())
    return T.mean_of_counts(counts, "doc_id", table, WORD_DIMS, steps=WORD_STEPS)


SQL["mean_word_vectors"] = f"""
WITH t AS (SELECT doc_id, unnest(CASE WHEN len({_TOKENS_SQL}) = 0 THEN [NULL] ELSE {_TOKENS_SQL} END) AS word FROM documents),
     c AS (SELECT DISTINCT word FROM t WHERE word IS NOT NULL),
     v AS (SELECT word, list_transform(range(0, {WORD_DIMS}),
                  lambda i: ('0x' || substr(md5(word), i * 2 + 1, 2))::INTEGER - 128) AS vector FROM c
           WHERE ('0x' || substr(md5('oov' || word), 1, 4))::INTEGER % {UNKNOWN_ONE_IN} <> 0),
     j AS (SELECT t.doc_id, v.vector AS vec FROM t LEFT JOIN v ON t.word = v.word)
SELECT doc_id, [{", ".join(f"round(CAST(coalesce(sum(vec[{i + 1}]), 0) AS DOUBLE) / CAST({WORD_STEPS} * count(*) AS DOUBLE), 6)" for i in range(WORD_DIMS))}] AS mean_vector
FROM j GROUP BY doc_id
"""


FREQUENT, NEAREST = 20, 10
ABSENT = ("notaword0", "notaword1")
FIRST_WORDS = 100


def _known_vectors(words: DataFrame) -> DataFrame:
    """(word, vector) of the distinct words that have a vector."""
    known = F.conv(F.substring(F.md5(F.concat(F.lit("oov"), "word")), 1, 4), 16, 10).cast("long") % UNKNOWN_ONE_IN != 0
    return words.where(known).select("word", T.word_steps("word", WORD_DIMS).alias("vector"))


def _word_table(spark: SparkSession, base: str):
    """((word, n) of every token, (word, vector) of those that have one), written once."""
    counts = materialize(T.token_counts(_docs(spark, base, "text"), "text", "word"), name="word-counts")
    return counts, materialize(_known_vectors(counts.select("word")), name="word-vectors")


def _asked(counts: DataFrame) -> DataFrame:
    top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).select("word")
    return top.unionByName(top.limit(1).select(F.explode(F.array(*map(F.lit, ABSENT))).alias("word")))


_WORDS_SQL = f"""c AS (SELECT word, count(*) AS n FROM (SELECT unnest({_TOKENS_SQL}) AS word FROM documents) GROUP BY word),
     v AS (SELECT word, list_transform(range(0, {WORD_DIMS}),
                  lambda i: CAST(('0x' || substr(md5(word), i * 2 + 1, 2))::INTEGER - 128 AS BIGINT)) AS vector FROM c
           WHERE ('0x' || substr(md5('oov' || word), 1, 4))::INTEGER % {UNKNOWN_ONE_IN} <> 0),
     q AS (SELECT word FROM (SELECT word FROM c ORDER BY n DESC, word LIMIT {FREQUENT}) t
           UNION ALL SELECT unnest({list(ABSENT)}))"""


def word_lookup(spark: SparkSession, base: str) -> DataFrame:
    """The vectors of the most frequent words and of two that no text has; a word without a vector is marked not found."""
    counts, table = _word_table(spark, base)
    return W.lookup(table, _asked(counts))


SQL["word_lookup"] = f"WITH {_WORDS_SQL} SELECT q.word, v.word IS NOT NULL AS found, v.vector FROM q LEFT JOIN v ON q.word = v.word"


def word_neighbours(spark: SparkSession, base: str) -> DataFrame:
    """The ten nearest words to each of the most frequent words, over the whole vocabulary."""
    counts, table = _word_table(spark, base)
    return W.neighbours(table, _asked(counts), NEAREST)


_DOT = lambda a, b: " + ".join(f"{a}[{i + 1}] * {b}[{i + 1}]" for i in range(WORD_DIMS))
SQL["word_neighbours"] = f"""
WITH {_WORDS_SQL},
     a AS (SELECT q.word AS query, vector AS x FROM q JOIN v ON q.word = v.word),
     s AS (SELECT query, v.word, round(CAST({_DOT("x", "vector")} AS DOUBLE) / (sqrt(CAST({_DOT("x", "x")} AS DOUBLE)) * sqrt(CAST({_DOT("vector", "vector")} AS DOUBLE))), 6) AS similarity
           FROM a, v WHERE v.word <> query),
     r AS (SELECT query, CAST(row_number() OVER (PARTITION BY query ORDER BY similarity DESC, word) AS INTEGER) AS rank, word, similarity FROM s)
SELECT * FROM r WHERE rank <= {NEAREST}
UNION ALL SELECT q.word, NULL, NULL, NULL FROM q WHERE q.word NOT IN (SELECT word FROM v)"""


def first_words_projection(spark: SparkSession, base: str) -> DataFrame:
    """The 100 most frequent words that have a vector, in two dimensions."""
    counts, table = _word_table(spark, base)
    first = counts.join(table, "word").orderBy(F.desc("n"), "word").limit(FIRST_WORDS)
    return W.landmark_projection(first, "word", "vector", 2, landmarks=FIRST_WORDS).select("word", "n", "x1", "x2")


def words_projection(spark: SparkSession, base: str) -> DataFrame:
    """Every word that has a vector, in three dimensions by its distances to 200 landmarks."""
    return W.landmark_projection(_word_table(spark, base)[1], "word", "vector", 3).drop("vector")


def embeddings_projection(spark: SparkSession, base: str) -> DataFrame:
    """Every embedding with its label, in two dimensions by its distances to 200 landmarks."""
    e = StandIns(spark, base).t("embeddings", "vec_id", "label", "embedding")
    return W.landmark_projection(e, "vec_id", "embedding", 2).drop("embedding")


def similar_vectors(spark: SparkSession, base: str) -> DataFrame:
    e = StandIns(spark, base).t("embeddings", "vec_id", "embedding")
    return V.nearest(e, "vec_id", "embedding", QUERY_VEC, TOP_SIMILAR)


SQL["similar_vectors"] = f"""
WITH q AS (SELECT CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id = {QUERY_VEC} LIMIT 1)
SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), q.v), 6) AS similarity
FROM embeddings, q WHERE vec_id <> {QUERY_VEC} ORDER BY similarity DESC, vec_id LIMIT {TOP_SIMILAR}
"""


def label_cohesion(spark: SparkSession, base: str) -> DataFrame:
    e = StandIns(spark, base).t("embeddings", "label", "embedding")
    return V.label_cohesion(e, "label", "embedding")


SQL["label_cohesion"] = """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
     m AS (SELECT label, count(*) AS n FROM e GROUP BY label),
     p AS (SELECT a.label, sum(CASE WHEN a.vec_id = b.vec_id THEN 0.0
                                ELSE pow(1 - list_cosine_similarity(a.v, b.v), 2) END) AS s
           FROM e a JOIN e b ON a.label = b.label GROUP BY a.label)
SELECT m.label, m.n, round(p.s / (m.n * m.n), 6) AS cohesion FROM m JOIN p ON m.label = p.label
"""


def adjacent_label_agreement(spark: SparkSession, base: str) -> DataFrame:
    """Consecutive embeddings (by id): label agreement and the mean margin loss."""
    e = StandIns(spark, base).t("embeddings", "vec_id", "label", "embedding")
    pairs = V.adjacent_pairs(e, "vec_id", "label", "embedding")
    return pairs.agg(F.count(F.lit(1)).alias("n_pairs"), F.sum("same").cast("bigint").alias("same_pairs"),
                     F.round(F.avg("same"), 6).alias("agreement_rate"),
                     F.round(F.avg("loss"), 6).alias("margin_loss"))


SQL["adjacent_label_agreement"] = """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v,
                  lead(label) OVER (ORDER BY vec_id) AS label_b, lead(CAST(embedding AS DOUBLE[])) OVER (ORDER BY vec_id) AS vb
           FROM embeddings),
     p AS (SELECT CAST(label = label_b AS INTEGER) AS same, sqrt(list_sum(list_transform(list_zip(v, vb), lambda z: pow(z[1] - z[2], 2)))) AS d
           FROM e WHERE vb IS NOT NULL),
     l AS (SELECT same, round(same * d * d + (1 - same) * pow(greatest(1.0 - d, 0.0), 2), 6) AS loss FROM p)
SELECT count(*) AS n_pairs, CAST(sum(same) AS BIGINT) AS same_pairs, round(avg(same), 6) AS agreement_rate,
       round(avg(loss), 6) AS margin_loss FROM l
"""

QUERIES = {
    "token_counts": token_counts,
    "tokenize_pad": tokenize_pad,
    "notes_cohort": notes_cohort,
    "entity_label_counts": entity_label_counts,
    "entities_of_document": entities_of_document,
    "entity_corpus": entity_corpus,
    **TAG_COUNTS,
    "tagged_entities": tagged_entities,
    "tagged_corpus": tagged_corpus,
    "mean_word_vectors": mean_word_vectors,
    "word_lookup": word_lookup,
    "word_neighbours": word_neighbours,
    "first_words_projection": first_words_projection,
    "words_projection": words_projection,
    "embeddings_projection": embeddings_projection,
    "similar_vectors": similar_vectors,
    "label_cohesion": label_cohesion,
    "adjacent_label_agreement": adjacent_label_agreement,
}
