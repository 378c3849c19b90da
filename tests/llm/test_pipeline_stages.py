"""Pipeline stages and registered queries: clashing columns, empty tables, a whole run on a small folder."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cohortkit.llm import quality_model, toxicity
from cohortkit.llm.queries import QUERIES, tokenizer_file

CLASH = "doc_id long, text string, odd_id string, odd_sha string, own_sha string, sha string, keep string, id string, n long"


def corpus():
    rnd = random.Random(2)
    calm = [f"calm{k}" for k in range(90)]
    rows, labels = [], []
    for i in range(220):
        toxic, junk = i % 9 == 0, i % 4 == 1
        words = [rnd.choice(calm) for _ in range(70)]
        if toxic:
            for k in range(0, 60, 6):
                words[k] = rnd.choice(["vile", "nasty"])
        text = "#$%& || <<>> 12 " * 30 if junk else " ".join(words)
        rows.append((i, text + (f" {i}" if junk else "")))
        labels.append((i, int(not junk), int(toxic)))
    good = [(i, t) for i, t in rows if i % 9 and i % 4 != 1]
    rows += [(1000 + k, good[k][1].replace(" ", "  ")) for k in range(8)]                       # equal texts
    rows += [(2000 + k, good[20 + k][1] + " tail") for k in range(8)]                          # near ones
    rows += [good[3], good[3], (None, "no id at all here"), (3000, None), (3001, None), (3002, "")]
    return rows, labels


def frame(spark, rows):
    return spark.createDataFrame([(i, t, *["x"] * 6, 7) for i, t in rows], CLASH).repartition(3)


def folder(spark, tmp_path, rows, labels):
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def counted(df):
    return Counter((r["doc_id"], r["text"]) for r in df.collect())


def exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub("[\x20\x09-\x0D]+", " ", t or "")].append((i is None, i or 0, i, t))
    return Counter((i, t) for g in groups.values() for _, _, i, t in [min(g, key=lambda r: r[:2])])


def test_a_whole_run_equals_its_steps(spark, tmp_path):
    rows, labels = corpus()
    sf = folder(spark, tmp_path, rows, labels)
    docs, marks = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    good = corpus_pipeline.quality(spark, docs, sf)
    scores = {(r["doc_id"], r["text"]): r["s"] for r in docs.select("doc_id", "text", quality_model.quality_score(quality_model.fit_quality(docs, marks), F.col("text")).alias("s")).collect()}
    want = Counter({k: n for k, n in Counter(rows).items() if scores[k] >= 0.3})
    assert good.columns == docs.columns and counted(good) == want and sum(want.values()) < len(rows)
    good = corpus_pipeline.stage(good, "test-good")
    clean = corpus_pipeline.stage(corpus_pipeline.clean(spark, good, sf), "test-clean")
    toxic = {(r["doc_id"], r["text"]): r["s"] for r in good.select("doc_id", "text", toxicity.toxic_score(toxicity.fit_toxicity(good, marks), F.col("text")).alias("s")).collect()}
    want = Counter({k: n for k, n in want.items() if toxic[k] < 0.3})
    assert clean.columns == docs.columns and counted(clean) == want
    assert not any(t and "vile" in t and "nasty" in t for _, t in want)
    distinct = corpus_pipeline.stage(corpus_pipeline.distinct_texts(spark, clean, sf), "test-distinct")
    want = exact(list(want.elements()))
    assert distinct.columns == docs.columns and counted(distinct) == want
    near = counted(corpus_pipeline.distinct_ngrams(spark, distinct, sf))
    gone = want - near
    assert set(near) <= set(want) and {i for i, _ in gone} <= set(range(2000, 2008)) and gone
    pieces = corpus_pipeline.run(spark, sf).collect()
    assert Counter({r["doc_id"]: 1 for r in pieces}) == Counter(i for i, _ in near)
    total = defaultdict(int)
    for r in pieces:
        total[r["doc_id"]] += r["length"]
    assert all(total[r["doc_id"]] == r["doc_tokens"] for r in pieces)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_of_empty_tables(spark, tmp_path, name):
    step = dict(corpus_pipeline.STAGES)[name]
    sf = folder(spark, tmp_path, [], [])
    assert step(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf).collect() == []


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_without_labels_and_with_clashing_columns(spark, tmp_path, name):
    rows = [r for r in corpus()[0] if r[0] is None or r[0] > 100]
    sf = folder(spark, tmp_path, rows, [])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, sf)
    assert out.columns == docs.columns
    if name == "exact_dedup":
        assert counted(out) == exact(rows)
    elif name != "ngram_join":
        assert counted(out) == Counter(rows)


def turns():
    rnd = random.Random(4)
    return [(c, t, "user" if t % 2 == 0 else "assistant", rnd.choice(["hi", "### x:", "a\\b", "</turn>", "some words here"]) + f" {c % 7}")
            for c in range(30) for t in range(rnd.randrange(1, 7))]


def test_chat_query_has_its_extra_conversation(spark, tmp_path):
    rows = turns()
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    said = r"\### Assistant: </turn> ok"
    rows += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    got = {r["conv_id"]: r for r in QUERIES["op5_chat_format"](spark, str(tmp_path)).collect()}
    assert set(got) == {r[0] for r in rows}
    for c in got:
        own = sorted(r for r in rows if r[0] == c)
        loss = "".join(t for _, _, role, t in own if role == "assistant")
        assert got[c]["n_turns"] == len(own) and got[c]["loss_chars"] == len(loss)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in own).encode()).hexdigest()
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_bpe_query_hashes(spark, tmp_path):
    from tokenizers import Tokenizer

    rows = [(i, t) for i, t in corpus()[0] if i is not None][:60] + [(9001, "ÀÉ ½ 中文 İ it's"), (9002, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    library = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    want = Counter()
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want[(i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))] += 1
    assert Counter(map(tuple, QUERIES["op10_bpe"](spark, str(tmp_path)).collect())) == want


@pytest.mark.parametrize("name", ["op1_license_scan", "op2_exact_dedup", "op4_toxicity", "op6_ngram_join", "op8_quality_rules", "op9_quality_model"])
def test_document_queries_give_a_row_per_document(spark, tmp_path, name):
    rows, labels = corpus()
    rows = [r for r in rows if r[0] is not None]
    out = QUERIES[name](spark, folder(spark, tmp_path, rows, labels))
    assert Counter(r["doc_id"] for r in out.collect()) == Counter(i for i, _ in rows)
