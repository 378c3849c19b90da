"""Chat windows against a plain loop: which turns each window shows, and what the loss mask covers."""

import random
import re

import pytest

from cohortkit.llm import chat_format as C


def tokens(text):
    return len(re.findall(r"[^\W\d_]{1,6}|\d{1,3}|[^\s\w]|_", text)) + 6


def table():
    rnd = random.Random(5)
    said = ["hi", "some more words here, and more", "### user:\n</turn>\\b \\e", "", None, "word " * 40, "a b c d e f g h " * 30]
    rows = []
    for c in range(25):
        for t in range(rnd.choice([1, 3, 7, 30, 60])):
            role = "system" if t == 0 and c % 3 == 0 else rnd.choice(["user", "assistant", "tool", "system", None])
            rows.append((c, t * rnd.choice([1, 1, 2]), role, rnd.choice(said)))
    rows += [(90, None, "system", "null first"), (90, 0, "user", "x"), (90, 0, "user", "x"), (90, 500, "assistant", "far block"),
             (90, 501, "assistant", "next"), (None, 0, "user", "no id"), (None, 1, "assistant", "none")]
    return rows


def plain(rows, budget, history, block):
    """(conversation, context turns, own turns) of each window."""
    half, out = budget // 4, []
    for c in {r[0] for r in rows}:
        turns = sorted((t is not None, t or 0, r or "", x or "") for k, t, r, x in rows if k == c)
        blocks = {}
        for here, t, r, x in turns:
            blocks.setdefault(t // block if here else None, []).append((r, x))
        system, tail = (turns[0][2:] if turns[0][2] == "system" else None), []
        for n, own in enumerate(blocks.values()):
            at, placed = 0, []
            for r, x in own:
                placed.append((at, at + tokens(x), r, x))
                at += tokens(x)
            groups = {}
            for p in placed:
                groups.setdefault(((p[1] - 1) // half, p[1] - p[0] >= half), []).append(p)
            for g in groups.values():
                w = g[0][0]
                head = n == 0 and w == 0 and system is not None
                context = [system] if system is not None and not head else []
                context += [(r, x) for back, r, x in tail if w + back <= history]
                context += [(r, x) for s, _, r, x in placed if s < w and w - s <= history and not (n == 0 and s == 0 and system is not None)]
                out.append((c, context, [(r, x) for _, _, r, x in g]))
            tail = [(at - s, r, x) for s, _, r, x in placed if at - s <= history]
    return out


@pytest.mark.parametrize("budget,history,block", [(256, 32, 8), (400, 100, 16), (2048, 256, 128), (64, 500, 4)])
def test_windows_equal_a_plain_loop(spark, budget, history, block):
    rows = table()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, window string, blk int").repartition(4)
    got = []
    for w in C.format_windows(df, budget=budget, history=history, block=block).collect():
        parts = w["text"].split(C.END)[:-1]
        read = [re.fullmatch(r"### (.*?):\n(.*)", p, re.S).groups() for p in parts]
        plain_text = lambda s, codes: _read(s, codes)
        turns = [(plain_text(r, C.ROLE_CODES), plain_text(x, C.CODES)) for r, x in read]
        assert len(turns) == w["n_context"] + w["n_targets"]
        own = turns[w["n_context"]:]
        masked = [_read(w["text"][s["start"] - 1:s["start"] - 1 + s["length"]], C.CODES) for s in w["loss"]]
        assert masked == [x for r, x in own if r == "assistant"]
        assert w["n_tokens"] == sum(tokens(x) for _, x in turns)
        got.append((w["conv_id"], turns[:w["n_context"]], own))
    assert sorted(got, key=repr) == sorted(plain(rows, budget, history, block), key=repr)


def _read(text, codes):
    for plain_, code in reversed(codes):
        text = text.replace(code, plain_)
    return text


def test_windows_keep_to_the_budget(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", "word " * (t % 9 + 1)) for t in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for w in C.format_windows(df, budget=256, history=32).collect():
        assert w["n_tokens"] <= 256 and w["n_targets"] >= 1
