"""Quality rules combined by weak supervision.

Each rule votes good (1), bad (-1) or abstains (0) on a text. Expectation
maximisation over the counts of vote patterns estimates every rule's accuracy
and the share of good texts without labels; a text's posterior probability of
being good replaces the demand that all rules pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import stage, text_chunks
from cohortkit.llm.words import SPACE, find_words, mix, shingle_hashes

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_lower", "n_upper",
         "n_marks", "n_distinct", "n_letters", "n_bare")
MARKS = np.zeros(256, dtype=bool)
MARKS[[ord(c) for c in "!?"]] = True
LETTER = np.zeros(256, dtype=bool)
LETTER[0x80:] = True                        # every character outside ASCII counts as a letter
LETTER[ord("A"):ord("Z") + 1] = LETTER[ord("a"):ord("z") + 1] = True


def text_stats(texts: list[str]) -> np.ndarray:
    """One row per text with the columns of STATS."""
    w = find_words(texts)
    n = len(texts)
    out = np.zeros((n, len(STATS)), dtype=np.int64)

    def per_text(mask: np.ndarray) -> np.ndarray:
        upto = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return upto[w.text_end] - upto[w.text_start]

    out[:, 0] = np.diff(w.first)
    lead = (w.buf & 0xC0) != 0x80
    out[:, 1] = per_text(lead & ~SPACE[w.buf])
    out[:, 2] = per_text(SYMBOLS[w.buf])
    for i, t in enumerate(texts):
        lines = [x for x in t.split("\n") if x.strip(" \t\r\x0b\x0c")]
        out[i, 3] = len(lines) - len(set(lines))
        out[i, 5] = len(lines)
    # words inside a three-word window that its text holds at least twice
    doc, h = shingle_hashes(w, 3)
    if len(h):
        at = np.flatnonzero(w.doc[:-2] == w.doc[2:])
        _, inverse, count = np.unique(mix(h + mix(doc.astype(np.uint64))), return_inverse=True, return_counts=True)
        twice = at[count[inverse] > 1]
        covered = np.zeros(len(w.hash), dtype=bool)
        for k in range(3):
            covered[twice + k] = True
        out[:, 4] = np.bincount(w.doc[covered], minlength=n)
    out[:, 6] = per_text((w.buf >= ord("a")) & (w.buf <= ord("z")))
    out[:, 7] = per_text((w.buf >= ord("A")) & (w.buf <= ord("Z")))
    out[:, 8] = per_text(MARKS[w.buf])
    letter = LETTER[w.buf]
    out[:, 10] = per_text(letter & lead)
    upto = np.concatenate(([0], np.cumsum(letter, dtype=np.int64)))
    out[:, 11] = np.bincount(w.doc[upto[w.end] == upto[w.start]], minlength=n)
    if len(w.hash):
        distinct = np.unique(mix(w.hash + mix(w.doc.astype(np.uint64))), return_index=True)[1]
        out[:, 9] = np.bincount(w.doc[distinct], minlength=n)
    return out


def stats_frame(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per input row: id and the counts of STATS."""
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, texts in text_chunks(b, 1):
                s = text_stats(texts)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), *(pa.array(s[:, k]) for k in range(len(STATS)))], ["id", *STATS])

    return picked.mapInArrow(run, f"id {picked.schema['id'].dataType.simpleString()}, " + ", ".join(f"{c} bigint" for c in STATS))


def vote(bad, good):
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict:
    """Rule name → vote column over the counts of STATS."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    letters = F.greatest(F.col("n_lower") + F.col("n_upper"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    share = lambda c, of: F.col(c) / of
    return {
        "length": vote(F.col("n_words") < 20, F.col("n_words") >= 100),
        "word_length": vote((share("word_chars", words) < 2.5) | (share("word_chars", words) > 14),
                            share("word_chars", words).between(3, 11)),
        "symbols": vote(share("n_symbols", words) > 0.1, share("n_symbols", words) < 0.02),
        "letters": vote(share("n_letters", chars) < 0.88, share("n_letters", chars) > 0.92),
        "bare_words": vote(share("n_bare", words) > 0.1, share("n_bare", words) < 0.03),
        "symbol_characters": vote(share("n_symbols", chars) > 0.05, share("n_symbols", chars) < 0.005),
        "duplicate_lines": vote(share("n_dup_lines", lines) > 0.3, (F.col("n_lines") > 3) & (F.col("n_dup_lines") == 0)),
        "repeated_words": vote(share("n_repeat_words", words) > 0.3, share("n_repeat_words", words) < 0.1),
        "capitals": vote(share("n_upper", letters) > 0.3, share("n_upper", letters) < 0.1),
        "marks": vote(share("n_marks", words) > 0.15, share("n_marks", words) < 0.05),
        "variety": vote((F.col("n_words") >= 100) & (share("n_distinct", words) < 0.15),
                        (F.col("n_words") >= 20) & (share("n_distinct", words) > 0.3)),
    }


#: Where estimation starts: P(vote -1, 0, 1 | bad text, good text), the same for every rule.
START = np.array([[0.35, 0.15, 0.5], [0.02, 0.2, 0.78]])


def estimate(patterns: np.ndarray, counts: np.ndarray, prior_good: float = 0.85, rounds: int = 100,
             pseudo: float = 1000.0) -> tuple[np.ndarray, np.ndarray, float]:
    """(posterior of good per vote pattern, vote rates by class, rule and vote, share of good texts), by expectation maximisation.

    ``patterns``: rows of -1, 0, 1. Votes are independent given the class. The
    start says that a rule rarely rejects a good text and often misses a bad
    one, as each rule knows one kind of fault; ``pseudo`` texts a class that
    vote as it says keep rates defined. Their number is fixed, so that the
    start gives way as the table grows. No pattern gives an empty answer.
    """
    n_rules = patterns.shape[1]
    likely, share = np.repeat(START[:, None, :], n_rules, axis=1), prior_good
    if not len(counts):
        return np.zeros(0), likely, share
    of = counts / counts.sum()
    post = np.full(len(counts), share)
    for _ in range(rounds):
        log = np.log(np.array([1 - share, share]))[:, None] + sum(
            np.log(likely[:, k, patterns[:, k] + 1]) for k in range(n_rules))
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))
        for c, p in ((1, new), (0, 1 - new)):
            mass = counts * p
            for k in range(n_rules):
                got = np.bincount(patterns[:, k] + 1, weights=mass, minlength=3)
                likely[c, k] = (got + pseudo * START[c]) / (mass.sum() + pseudo)
        share = float(np.clip((of * new).sum(), 0.05, 0.99))
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
    return new, likely, share


def vote_patterns(stats: DataFrame, votes: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(patterns, texts of each) of the texts with words: at most 3 to the power of the number of rules."""
    met = stats.where("n_words > 0").groupBy(*votes).count().orderBy(*votes).collect()
    return (np.array([[r[v] for v in votes] for r in met], dtype=np.int64).reshape(len(met), len(votes)),
            np.array([r["count"] for r in met], dtype=float))


def voted(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, list[str]]:
    """(counts and votes of every text, written once; the vote columns)."""
    named = rules()
    stats = stage(stats_frame(docs, id_col, text_col).select("id", *STATS, *(v.alias(f"vote_{k}") for k, v in named.items())),
                  "quality-stats")
    return stats, [f"vote_{k}" for k in named]


def rule_rates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pseudo: float = 1000.0) -> DataFrame:
    """(rule, vote, start_bad, start_good, bad, good): how often each rule votes -1, 0 and 1 on bad and good texts, as estimated beside the start."""
    stats, votes = voted(docs, id_col, text_col)
    _, likely, _ = estimate(*vote_patterns(stats, votes), pseudo=pseudo)
    rows = [(v[5:], k - 1, *(float(START[c, k]) for c in (0, 1)), *(float(likely[c, i, k]) for c in (0, 1)))
            for i, v in enumerate(votes) for k in range(3)]
    return docs.sparkSession.createDataFrame(rows, "rule string, vote int, start_bad double, start_good double, bad double, good double")


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_at: float = 0.5,
                  min_words: int = 50, max_repeat_percent: int = 50, pseudo: float = 1000.0) -> DataFrame:
    """One row per input row: id, counts, base_failed, posterior (of good), votes, kept.

    Null texts count as empty; an empty text has no words and fails the base
    rules. Repeated rows are judged one by one; other columns are ignored. An
    empty table gives an empty result. The driver sees the counts of vote
    patterns only: at most 3 to the power of the number of rules. ``pseudo``:
    see :func:`estimate`; :func:`rule_rates` reports what was estimated.
    """
    spark = docs.sparkSession
    stats, votes = voted(docs, id_col, text_col)
    patterns, counts = vote_patterns(stats, votes)
    good, _, _ = estimate(patterns, counts, pseudo=pseudo)
    table = spark.createDataFrame([(*map(int, p), float(g)) for p, g in zip(patterns, good, strict=True)],
                                  ", ".join(f"{v} int" for v in votes) + ", posterior double")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return (stats.join(F.broadcast(table), votes, "left")
            .withColumn("posterior", F.coalesce("posterior", F.lit(0.0)))
            .select(F.col("id").alias(id_col), *STATS[:5], failed.alias("base_failed"),
                    (~failed & (F.col("posterior") >= keep_at)).alias("kept"), "posterior", *votes))
