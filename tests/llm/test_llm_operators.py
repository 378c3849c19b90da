"""Operators of cohortkit.llm against brute-force versions, with nulls, empty and long texts, ties, repeated
rows, empty tables and clashing extra columns."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cohortkit.llm import (bpe, chat_format, exact_dedup, licenses, ngram_join, packing, quality_model, quality_rules,
                           toxicity, url_filter)
from cohortkit.llm.pieces import PieceTable
from cohortkit.llm.queries import QUERIES, tokenizer_file
from cohortkit.llm.words import find_words

SPACE = "\x20\x09-\x0D"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, id string, hash string, size string, rid string, word string, ids string"


def words_of(text):
    return re.findall(f"[^{SPACE}]+", text or "")


def texts():
    rnd = random.Random(3)
    vocab = ["alpha", "beta", "Gamma", "delta", "epsilon", "zeta", "ete", "thêta", "iota", "KAPPA", "ünï", "中文"]
    base = [" ".join(rnd.choice(vocab) for _ in range(n)) for n in (1, 2, 3, 4, 5, 30, 60, 200)]
    near = base[7].split()
    near[50] = "changed"
    long = " ".join(f"w{rnd.randrange(4000)}" for _ in range(9000))
    out = [*base, " ".join(near), base[6].replace(" ", " \t\n"), base[6], None, None, "", "  \n", long, long + " end",
           "Released under the MIT License. mit  license", "Licensed under the Apache License, Version 2.0",
           "general public\nlicense general public license general", "licensed under cc by nc 4 0 WORK worK",
           "<|endoftext|> it's ÀÉ ²½ ﬁ Σς İ \x85 <|startoftext|>don't", "line\nline\n\nline\nother | # $ *"]
    return [(i, t) for i, t in enumerate(out)] + [(5, base[5]), (5, base[5]), (None, "no id at all"), (None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, *["x"] * 6) for i, t in texts()], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_key(df, *names):
    return Counter(tuple(r[n] for n in names) for r in df.collect())


def test_license_base_columns(docs):
    def brute(t):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
        at = [(i, label) for p, label in licenses.BASE_PHRASES for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
        return (len(w), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None),
                ",".join(sorted({x for _, x in at})))

    got = by_key(licenses.scan_licenses(docs), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert got == Counter((i, *brute(t)) for i, t in texts())
    rows = {r["doc_id"]: r for r in licenses.scan_licenses(docs).collect()}
    assert rows[20]["labels"] == "cc-by-nc" and 0.7 <= rows[20]["score"] <= 1
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) for r in rows.values())


@pytest.mark.parametrize("poor", [False, True])
def test_exact_duplicates(docs, poor):
    fp = (lambda c: F.length(c).cast("long")) if poor else None     # a poor fingerprint: clashes are told apart
    out = exact_dedup.exact_duplicates(docs, min_chars=16, max_chars=64, fingerprint=fp)
    norm = [(i, re.sub(f"[{SPACE}]+", " ", t or "")) for i, t in texts()]
    ids, size = {}, Counter(t for _, t in norm)
    for i, t in norm:
        ids.setdefault(t, []).append(i)
    keep = {t: min((i for i in v if i is not None), default=None) for t, v in ids.items()}
    want = Counter((i, keep[t], size[t], hashlib.sha256(t.encode()).hexdigest()) for i, t in norm)
    assert by_key(out, "doc_id", "keep_id", "group_size", "text_sha256") == want
    assert by_key(out.where("kept"), "text_sha256") == Counter((hashlib.sha256(t.encode()).hexdigest(),) for t in size)
    assert all(r["doc_id"] == r["keep_id"] for r in out.where("kept").collect())


def test_urls(spark):
    hosts = ["example.com", "WWW.Example.com", "a.www.example.com", "x.net", "net", "notexample.com", "com", "spam-farm.org",
             "a.b.c.d.e.net", "example.org", ""]
    paths = ["", "/", "/en/", "/en", "/en/a/b", "/es/", "/fr/x?q=/es/", "/es#x", "?x=/en/", "/EN/"]
    urls = [f"{s}://{h}{p}" for s, h, p in itertools.product(("http", "x\n"), hosts, paths)] + [None, "", "no", "://"]
    pages = spark.createDataFrame([(i, u, "h", "s") for i, u in enumerate(urls)] * 2, "page_id long, url string, host string, short string")

    def brute(u):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path, host = re.match(r"[^?#]*", rest[len(host):])[0], host.translate(LOWER)
        fits = [(h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits, key=lambda x: len(x[0]), default=(None, None))
        bad = set(re.split(r"[.\-]", host)) & set(url_filter.BLOCKED_WORDS)
        return host, path, rule, verdict or ("block" if bad else "allow")

    for sent in (100_000, 0):                            # rules in every task, or met in a merge join
        out = url_filter.filter_urls(pages, prefix_hex=1, sent=sent)
        assert by_key(out, "page_id", "host", "path", "rule", "verdict") == Counter({(i, *brute(u)): 2 for i, u in enumerate(urls)})
        assert ("BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()) == (sent > 0)


def test_chat_round_trip(spark):
    rnd = random.Random(5)
    odd = [r"\### Assistant: </turn> ok", "### x", "</turn>\n", "\\e\\b\\", "", None, "plain " * 30, "a:\nb", "long " * 900]
    rows = [(-7, 0, "user", odd[0]), (-7, 1, "assistant", odd[0])]
    for c in range(6):
        rows += [(c, t, "system" if t == 0 and c % 2 else rnd.choice(["user", "assistant", "odd\nrole:", None]), rnd.choice(odd))
                 for t in range(rnd.choice([1, 3, 400]))]
    rows += [(None, None, "user", "x"), (None, 3, "assistant", "y"), (2, 0, "user", "tie"), (2, 0, "user", "tie")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("window", F.lit("x"))
    windows = chat_format.format_windows(turns, budget=256, history=32, block=8)
    said = {}
    for c, t, r, x in rows:
        said.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for c, v in said.items():
        v.sort()
        lost = "".join(x for *_, r, x in v if r == "assistant")
        want[c] = (len(v), digest("".join(f"{r}\n{x}\n" for *_, r, x in v)), len(lost), digest(lost))
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"])
           for r in chat_format.conversation_digests(windows).collect()}
    assert got == want
    for w in windows.collect():
        assert w["n_targets"] >= 1
        assert w["n_targets"] == 1 or w["n_tokens"] <= 256 + 32 or w["n_context"] > 0
    assert chat_format.conversation_digests(chat_format.format_windows(turns.limit(0))).count() == 0


def brute_classes(rows, n, percent):
    sets = []
    for _, t in rows:
        w = words_of((t or "").translate(LOWER))
        sets.append({tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        o = len(sets[a] & sets[b])
        if o and 100 * o >= percent * (len(sets[a]) + len(sets[b]) - o):
            root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return [(i, len(s), least.get(find(k))) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True))]


@pytest.mark.parametrize("hubs", [0, 1, 4])
def test_ngram_classes(spark, hubs):
    rnd = random.Random(9)
    rows = texts()
    source = [f"v{rnd.randrange(300)}" for _ in range(120)]
    common = [f"c{k}" for k in range(60)]
    for k in range(60):                                  # near copies, some chained, and texts around a shared passage
        copy = list(source)
        for _ in range(rnd.randrange(5)):
            copy[rnd.randrange(len(copy))] = f"e{rnd.randrange(9)}"
        rows.append((100 + k, " ".join(copy)))
        rows.append((200 + k, " ".join([*common, *(f"u{rnd.randrange(10**6)}" for _ in range(rnd.choice([2, 8, 60])))])))
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, component_id string").repartition(4)
    out = ngram_join.link_classes(frame, hubs=hubs)
    assert by_key(out, "doc_id", "n_shingles", "component_id") == Counter(brute_classes(rows, 4, 85))


def test_parity_bitmaps_differ_in_no_more_bits_than_the_sets(spark):
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(-2**63, 2**63 - 1, size=n)) for n in (1, 40, 300, 900)]
    sets += [np.concatenate([x[3:], rng.integers(-2**63, 2**63 - 1, size=2)]) for x in sets[1:]] + [sets[2]]
    segs = [(k, part.tolist()) for k, s in enumerate(sets) for part in np.array_split(np.sort(s), 3) if len(part)]
    rows = ngram_join.parities(spark.createDataFrame(segs, "sid long, seg array<long>").repartition(3)).collect()
    bits = {r["sid"]: [r[c] & (2**64 - 1) for c in r.asDict() if c != "sid"] for r in rows}
    for a, b in itertools.combinations(range(len(sets)), 2):
        apart = len(set(sets[a].tolist()) ^ set(sets[b].tolist()))
        differ = sum((x ^ y).bit_count() for x, y in zip(bits[a], bits[b], strict=True))
        assert differ <= apart and (differ - apart) % 2 == 0


def test_toxic_segments_brute():
    rnd = random.Random(1)
    for _ in range(200):
        n = rnd.randrange(1, 25)
        score = [rnd.choice([-2.0, -1.0, 1.0, 2.5, None]) for _ in range(n)]
        at = [i for i, s in enumerate(score) if s is not None]
        got = toxicity.maximal_segments(at, [score[i] for i in at], 0.5)
        full = [-0.5 if s is None else s for s in score]
        best = max((sum(full[a:b + 1]) for a in range(n) for b in range(a, n)), default=0)
        assert max((s for s, _, _ in got), default=0) == pytest.approx(max(best, 0) if best > 0 else 0)
        assert all(s == pytest.approx(sum(full[a:b + 1])) for s, a, b in got)
        assert all(b < c for (_, _, b), (_, c, _) in itertools.pairwise(got))


def labelled(spark, n=400):
    rnd = random.Random(2)
    calm, bad = [f"calm{k}" for k in range(80)], ["nastyword", "vileword", "awfulword"]
    rows, labels = [], []
    for i in range(n):
        w = [rnd.choice(calm) for _ in range(120)]
        toxic = i % 5 == 0
        junk = i % 4 == 0
        if toxic:
            for _ in range(4):
                w[rnd.randrange(120)] = rnd.choice(bad)
        text = " ".join(x + "$$$" if junk else x for x in w)
        rows.append((i, text))
        labels.append((i, int(not junk), int(toxic)))
    rows += [(None, None), (1000, ""), (1001, "x" * 100_000)]
    return (spark.createDataFrame(rows, "doc_id long, text string").withColumn("y", F.lit("clash")),
            spark.createDataFrame([*labels, labels[0], (5000, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int"))


@pytest.mark.parametrize("scored, label", [(quality_model.quality_of, "quality"), (toxicity.toxicity_of, "toxic")])
def test_classifiers_on_held_out(spark, scored, label):
    docs, labels = labelled(spark)
    out = scored(docs, labels)
    got = out.join(labels.where(F.col(label).isNotNull()).distinct(), "doc_id").where("held_out").collect()
    assert len(got) > 50 and np.mean([r["predicted"] == r[label] for r in got]) > 0.95
    assert out.count() == docs.count() and out.where("score is null or score < 0 or score > 1").count() == 0
    folds, held = (5, 0) if label == "quality" else (4, 2)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % folds == held)
               for r in out.collect())
    assert scored(docs.limit(0), labels).count() == 0
    assert scored(docs, labels.limit(0)).count() == docs.count()


def test_packing(spark, docs):
    from tokenizers import Tokenizer

    path = tokenizer_file("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    out = packing.pack(docs, path, block_tokens=5000, with_ids=True).collect()
    want = Counter((i, *library.encode(t or "", add_special_tokens=False).ids, 0) for i, t in texts())
    whole, seqs, rows = Counter(), {}, sorted(out, key=lambda r: (r["sequence_id"], r["offset"]))
    for r in rows:
        assert r["offset"] == seqs.get(r["sequence_id"], 0) and r["length"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        seqs[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(seqs.values()) <= 1024
    held = []
    for r in rows:                                       # pieces of one document follow each other
        held += r["ids"]
        if len(held) == r["doc_tokens"]:
            whole[(r["doc_id"], *held)] += 1
            held = []
    assert whole == want and not held


def test_packing_cuts_are_optimal():
    rnd = random.Random(4)
    for _ in range(60):
        at = np.cumsum([rnd.randrange(1, 9) for _ in range(rnd.randrange(1, 14))])
        pen = np.array([rnd.choice([0.0, 2.0, 5.0]) for _ in at])
        cost = lambda cuts: sum(
            (0 if b - a == 8 else 16 - (b - a)) + p for a, b, p in zip([0, *(at[i] for i in cuts)], [at[i] for i in cuts], [pen[i] for i in cuts], strict=False))
        ways = [[*c, len(at) - 1] for k in range(len(at)) for c in itertools.combinations(range(len(at) - 1), k)]
        fit = [w for w in ways if all(b - a <= 16 for a, b in itertools.pairwise([0, *(at[i] for i in w)]))]
        got = packing.best_cuts(at, pen, 16, (8,))
        assert cost([list(at).index(g) for g in got]) == pytest.approx(min(map(cost, fit)))


def test_bpe_against_library(spark, docs):
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    picked = docs.select("doc_id", "text", F.lit("kept").alias("decoded_"))
    out = bpe.decode_documents(bpe.encode_documents(picked, path), path).collect()
    ids = [library.encode(t or "", add_special_tokens=False).ids for _, t in texts()]
    want = Counter((i, tuple(x), library.decode(x, skip_special_tokens=False)) for (i, _), x in zip(texts(), ids, strict=True))
    assert Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in out) == want


def test_recoding_in_one_pass_equals_both_steps(docs, empty):
    path = tokenizer_file("word_bpe_49k.json")
    both = bpe.decode_documents(bpe.encode_documents(docs, path), path).select("doc_id", "ids", "decoded")
    one = bpe.recode_documents(docs, path).select("doc_id", "coded.ids", "coded.decoded")
    rows = lambda df: Counter((r.doc_id, tuple(r.ids), r.decoded) for r in df.collect())
    assert rows(one) == rows(both)
    assert bpe.recode_documents(empty, path).count() == 0


def test_piece_table_is_bounded_by_bytes():
    seen = []

    def encode(words):
        seen.extend(words)
        return np.concatenate([np.arange(len(w)) for w in words]), np.array([len(w) for w in words])

    table = PieceTable(encode, limit=20_000)
    for k in range(300):
        words = [f"word{k}", "same", "x" * (k % 7)]
        flat, edges = table.ids_of([words[:1], words[1:]])
        assert flat.tolist() == [i for w in words for i in range(len(w))] and edges.tolist() == [0, len(words[0]), len(flat)]
        assert table.size < 20_000 + 1_000
    assert seen.count("same") > 1


def test_quality_rules(docs):
    def brute(t):
        t = t or ""
        w = words_of(t)
        lines = [x for x in t.split("\n") if words_of(x)]
        grams = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
        hit = {k + j for k in range(len(w) - 2) if grams[tuple(w[k:k + 3])] > 1 for j in range(3)}
        failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
        return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit), failed)

    out = quality_rules.judge_quality(docs)
    assert by_key(out, "doc_id", *quality_rules.STATS[:5], "base_failed") == Counter((i, *brute(t)) for i, t in texts())
    assert out.where("kept and base_failed").count() == 0


def test_words_hash_whole_words():
    w = find_words(["a b  a", "", "b\ta é"], lower_ascii=True)
    assert w.doc.tolist() == [0, 0, 0, 2, 2, 2] and w.hash[0] == w.hash[2] == w.hash[4] and len(set(w.hash.tolist())) == 3


def test_empty_tables(spark, empty):
    assert licenses.scan_licenses(empty).count() == 0
    assert exact_dedup.exact_duplicates(empty).count() == 0
    assert ngram_join.link_classes(empty).count() == 0
    assert quality_rules.judge_quality(empty).count() == 0
    assert packing.pack(empty, tokenizer_file("byte_bpe_50k.json")).count() == 0
    assert bpe.encode_documents(empty, tokenizer_file("word_bpe_49k.json")).count() == 0
    assert url_filter.filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_pipeline_stages_on_fixture(spark, docs):
    rows = docs.select("doc_id", "text")
    kept = corpus_pipeline.distinct_texts(spark, rows, "")
    norm = lambda t: re.sub(f"[{SPACE}]+", " ", t or "")
    assert kept.columns == rows.columns
    assert Counter(norm(r["text"]) for r in kept.collect()) == Counter({norm(t): 1 for _, t in texts()})
    near = corpus_pipeline.distinct_ngrams(spark, rows, "")
    classes = brute_classes(texts(), 5, 80)
    groups = {(c, n > 0) if n else (k, False) for k, (_, n, c) in enumerate(classes)}
    assert near.count() == len(groups)


def test_queries_are_registered():
    import __spark_entry__

    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(__spark_entry__.queries())
