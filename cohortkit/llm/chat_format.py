"""Chat formatting into budgeted, turn-aligned windows.

A conversation is cut into blocks of turn numbers and a block's texts are
shuffled once, to one place; everything else happens there. Turn tokens are
prefix-summed inside the block and the sums alone choose the spans: a turn
below half the target budget joins the window of the half-budget bucket its
end falls into, a larger turn is a window of its own. Two small turns of one
bucket start less than a full budget apart, so every span keeps to the budget
unless a single turn exceeds it, and no sequential scan is needed. A window is
the system turn, then earlier turns that start at most ``history`` tokens
before the span (context, no loss), then the span's turns, of which assistant
texts are the loss mask: each exactly once. The system turn and the last turns
of a block reach later blocks by a small table, one row per block.

Template: ``### role:\\n`` text ``</turn>\\n``. Inside texts and roles a
backslash and the control strings are replaced by backslash codes, so the
markers stand only where the template wrote them and reading back is exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HEAD, SEP, END = "### ", ":\n", "</turn>\n"
# Control strings and their codes; the backslash comes first when escaping and last when reading.
CODES = (("\\", "\\b"), ("</turn>", "\\e"), ("### ", "\\h"))
ROLE_CODES = (*CODES, ("\n", "\\n"))


def escape(text, codes=CODES):
    for plain, code in codes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text, codes=CODES):
    for plain, code in reversed(codes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def turn_tokens(text):
    """Approximate tokens of a rendered turn: word pieces of up to six letters, digits by three, marks; at least 1."""
    pieces = r"\p{L}{1,6}|\p{N}{1,3}|[^\s\p{L}\p{N}]"
    return F.regexp_count(text, F.lit(pieces)).cast("long") + 6


def format_windows(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text", budget: int = 2048, history: int = 256, block: int = 128) -> DataFrame:
    """One row per window: ``conv_col``, block and window (together its ordering position), text, n_context,
    n_targets, n_tokens, loss (array of 1-based start and length in ``text``).

    Half of ``budget`` is for a window's own turns, ``history`` for repeated
    ones, the rest for the system turn. Turns are ordered by turn, role and
    text; ties and repeated rows are all kept. ``block`` turn numbers make a
    block, and history reaches back one block at most. A null text or role is
    empty, a null turn comes first, a null conversation id is one
    conversation. A conversation's system turn is its first turn if the role
    is 'system'. Other columns are ignored.
    """
    half = budget // 4
    raw = turns.select(
        F.coalesce(F.col(conv_col), F.lit(0)).alias("conv"), F.col(conv_col).isNull().alias("noconv"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    raw = raw.withColumn("blk", F.coalesce(F.floor(F.col("turn") / block), F.lit(-(1 << 62))))
    conv = ["noconv", "conv"]
    here = [*conv, "blk"]
    # the blocks of a conversation in order: small rows without texts
    ordered = Window.partitionBy(*conv).orderBy("blk")
    blocks = raw.select(*here).distinct().select(*here, F.lag("blk").over(ordered).alias("before"), F.lead("blk").over(ordered).alias("after"))

    inside = Window.partitionBy(*here).orderBy("turn", "role", "text")
    placed = (raw.withColumn("cost", turn_tokens(F.col("text")))
              .withColumn("end", F.sum("cost").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("start", F.col("end") - F.col("cost"))
              .withColumn("group", F.struct(F.floor((F.col("end") - 1) / half).alias("bucket"), (F.col("cost") >= half).alias("big")))
              .withColumn("turn_", F.struct("start", "cost", "role", "text")))
    along = Window.partitionBy(*here).orderBy("start")
    opens = F.coalesce(F.lag("group").over(along) != F.col("group"), F.lit(True))
    near = F.collect_list("turn_").over(along.rangeBetween(-history, -1))
    spans = (placed.withColumn("past", F.when(opens, near)).groupBy(*here, "group")
             .agg(F.min("start").alias("window"), F.first("past", ignorenulls=True).alias("past"), F.array_sort(F.collect_list("turn_")).alias("own")))

    # what a block takes over: its conversation's system turn, and the last turns of the block before
    total = F.sum("cost").over(Window.partitionBy(*here))
    last = (placed.select(*here, "turn_", (total - F.col("start")).alias("back")).where(F.col("back") <= history)
            .join(blocks.where("after is not null").select(*here, "after"), here)
            .groupBy(*conv, F.col("after").alias("blk")).agg(F.array_sort(F.collect_list(F.struct(
                (-F.col("back")).alias("start"), F.col("turn_.cost").alias("cost"), F.col("turn_.role").alias("role"), F.col("turn_.text").alias("text")))).alias("tail")))
    heads = (placed.where("start = 0 and role = 'system'").join(blocks.where("before is null").select(*here), here, "left_semi")
             .select(*conv, F.col("turn_").alias("system")))
    brought = (blocks.select(*here, F.col("before").isNull().alias("leads")).join(heads, conv, "left").join(last, here, "left")
               .where("system is not null or tail is not null"))

    none = F.array().cast(spans.schema["past"].dataType)
    told = spans.join(brought, here, "left")
    leads = F.coalesce("leads", F.lit(False))
    is_head = F.coalesce(F.col("window") == 0, F.lit(False)) & leads & F.col("system").isNotNull()
    system = F.when(F.col("system").isNotNull() & ~is_head, F.array("system")).otherwise(none)
    tail = F.filter(F.coalesce("tail", none), lambda x: F.col("window") - x["start"] <= history)
    past = F.filter(F.coalesce("past", none), lambda x: ~(leads & F.col("system").isNotNull() & (x["start"] == 0)))
    shown = told.select(*here, "window", F.concat(system, tail, past).alias("context"), "own").select(
        *here, "window", F.size("context").alias("n_context"), F.size("own").alias("n_targets"), F.concat("context", "own").alias("t"))
    rendered = shown.select(
        "*", F.transform("t", lambda x: F.concat(F.lit(HEAD), escape(x["role"], ROLE_CODES), F.lit(SEP))).alias("heads"),
        F.transform("t", lambda x: escape(x["text"])).alias("bodies"))
    sizes = rendered.select("*", F.transform(F.arrays_zip("heads", "bodies"), lambda z: (
        F.length(z["heads"]) + F.length(z["bodies"]) + len(END)).cast("long")).alias("sizes"))
    spanned = sizes.select(
        "*", F.aggregate("sizes", F.array(F.lit(1).cast("long")),
                         lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n))).alias("at"))
    loss = F.filter(F.transform("t", lambda x, i: F.when(
        (i >= F.col("n_context")) & (x["role"] == "assistant"),
        F.struct((F.get("at", i) + F.length(F.get("heads", i))).alias("start"),
                 F.length(F.get("bodies", i)).cast("long").alias("length")))), lambda s: s.isNotNull())
    return spanned.select(
        F.when(~F.col("noconv"), F.col("conv")).alias(conv_col), F.col("blk").alias("block"), "window",
        F.array_join(F.transform(F.arrays_zip("heads", "bodies"), lambda z: F.concat(z["heads"], z["bodies"], F.lit(END))), "").alias("text"),
        "n_context", "n_targets", F.aggregate("t", F.lit(0).cast("long"), lambda a, x: a + x["cost"]).alias("n_tokens"), loss.alias("loss"))


def read_windows(windows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """The formatted text read back: per window its own turns (role, text) and its texts under the loss mask."""
    bodies = F.split("text", END, -1)
    own = F.slice(bodies, F.col("n_context") + 1, F.col("n_targets"))

    def parsed(turn):
        at = F.instr(turn, SEP)
        return F.struct(unescape(F.substr(turn, F.lit(len(HEAD) + 1), at - len(HEAD) - 1), ROLE_CODES).alias("role"),
                        unescape(F.substr(turn, at + len(SEP))).alias("text"))

    return windows.select(
        conv_col, "block", "window", F.length("text").cast("long").alias("chars"),
        F.transform(own, parsed).alias("turns"),
        F.transform("loss", lambda s: unescape(F.substr(F.col("text"), s["start"].cast("int"), s["length"].cast("int")))).alias("loss_texts"))


def conversation_digests(windows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Per conversation: turns and loss texts read back from its windows, as counts and SHA-256 digests.

    A digest runs over a whole conversation, which therefore meets in one row.
    Its turns are moved once: texts under the loss mask travel beside them
    only where they are not those of the assistant's turns.
    """
    held = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == "assistant"), lambda t: t["text"]), "")
    masked = F.array_join("loss_texts", "")
    read = read_windows(windows, conv_col).select(conv_col, "block", "window", "chars", "turns", F.when(masked != held, masked).alias("other"))
    both = read.groupBy(conv_col).agg(
        F.sum(F.size("turns")).cast("long").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.array_sort(F.collect_list(F.struct("block", "window", "turns", "other"))).alias("w"))
    said = lambda x: F.array_join(F.transform(x["turns"], lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    own = lambda x: F.array_join(F.transform(F.filter(x["turns"], lambda t: t["role"] == "assistant"), lambda t: t["text"]), "")
    lost = F.array_join(F.transform("w", lambda x: F.coalesce(x["other"], own(x))), "")
    return both.select(
        conv_col, "n_turns", F.sha2(F.array_join(F.transform("w", said), ""), 256).alias("turns_sha256"),
        F.length(lost).cast("long").alias("loss_chars"), F.sha2(lost, 256).alias("loss_sha256"), "formatted_chars")
