"""Cases in which the operators of cohortkit.llm once did less than the whole job."""

import time

import numpy as np
import pytest

from cohortkit.llm import packing, toxicity
from cohortkit.llm.labelled import labelled_sample
from cohortkit.llm.queries import tokenizer_file


def test_toxic_passage_scores_alike_wherever_it_stands():
    bad = ["vile", "nasty", "awful", "rotten"]
    model = toxicity.ToxicModel(scores=dict.fromkeys(bad, 4.0), lam=1.0, k=0.01)
    calm, passage = ["calm"] * 400, " ".join(bad)
    alone = model.passages(" ".join([*calm, passage, *calm]))
    assert len(alone) == 1
    twice = model.passages(" ".join([*calm, passage, *calm, passage, *calm]))
    assert [p[2] for p in twice] == pytest.approx([alone[0][2]] * 2)
    scattered = " ".join(" ".join([w, *calm[:100]]) for w in bad * 5)
    late = model.passages(f"{scattered} {passage} {' '.join(calm)}")
    assert late and late[-1][2] == pytest.approx(alone[0][2]) and late[-1][0] == len(scattered) + 1


def padding(spark, texts):
    out = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1),
                       tokenizer_file("byte_bpe_50k.json")).collect()
    sizes = {}
    for r in out:
        sizes[r["sequence_id"]] = sizes.get(r["sequence_id"], 0) + r["length"]
    held = sum(sizes.values())
    return 1 - held / sum(n if n in (256, 512) else 1024 for n in sizes.values())


@pytest.mark.parametrize("words", [1100, 700])
def test_packing_cuts_unpunctuated_texts_anywhere(spark, words):
    assert padding(spark, [" word" * words] * 60) < 0.05


def test_packing_knows_marks_of_other_scripts():
    with open(tokenizer_file("byte_bpe_50k.json"), encoding="utf-8") as f:
        tokens = packing.ByteTokens(f.read())
    for text, penalty in (("中文字。", packing.SENTENCE), ("中文字，", packing.CLAUSE), ("हिन्दी।", packing.SENTENCE),
                          ("سلام؟", packing.SENTENCE), ("سلام،", packing.CLAUSE), ("plain.", packing.SENTENCE)):
        ids = tokens.ids_of([text])[0]
        got = tokens.penalties(ids)
        assert got[-1] == penalty and not np.isfinite(got[:-1]).any(), text
        assert tokens.penalties(np.append(ids, tokens.ids_of(["中"])[0]))[len(ids) - 1] == penalty


def test_toxic_scan_is_linear_in_hits():
    hits = 1000
    started = time.process_time()
    found = toxicity.maximal_segments(list(range(0, 100 * hits, 100)), [4.0] * hits, 0.1)
    took = time.process_time() - started
    assert len(found) == hits
    started = time.process_time()
    toxicity.maximal_segments(list(range(0, 800 * hits, 100)), [4.0] * 8 * hits, 0.1)
    assert time.process_time() - started < 30 * max(took, 0.002)


def test_toxic_prior_counts_all_documents(spark):
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    rows = [(i, "calm words rumour" if i % 8 == 0 else "calm words") for i in range(400)]
    rest = [(i, "calm words rumour") for i in range(1000, 5000)]
    texts = [(i, f"{t} " + " ".join("abcdefghij"[int(d)] for d in str(i))) for i, t in rows + rest]
    fit = lambda r: toxicity.fit_toxicity(spark.createDataFrame(r, "doc_id long, text string"), labels)
    assert fit(texts[:400]).scores["rumour"] > fit(texts).scores["rumour"] + 0.5


def test_labelled_sample_has_one_text_an_id_and_one_row_a_text(spark):
    rows = [(1, f"text {k}") for k in range(300)] + [(i, "copy") for i in range(2, 40)] + [(50, None), (51, "own"), (51, "own")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, int(i == 9)) for i in range(60)], "doc_id long, toxic int")
    got = labelled_sample(docs, labels, "toxic", 4, -1, 100).collect()
    assert sorted((r["id"], r["y"]) for r in got) == [(1, 0), (2, 1), (50, 0), (51, 0)]
    assert {r["text"] for r in got} >= {"copy", "", "own"}
