"""Preference pairs for training on chosen and rejected answers.

The longest common prefix of the two conversations' turns becomes the prompt, rendered once;
what follows it on either side is that side's completion, with a mask that tells the turns to
learn (the assistant's) from those only to read. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import sequential_id
from .columns import let
from .tables import fresh

TEMPLATE = ("<|", "|>\n", "<|end|>\n")
TURN = "array<struct<role:string,text:string>>"


def conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """(conv_id, turns): one row per conversation, its turns in order. Rows that repeat exactly
    count once; different rows of one turn number go by role, then text. Null role and text are
    empty. Rows without a conv_id or a turn number are in no conversation."""
    item = F.struct(F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                    F.coalesce(F.col(text), F.lit("")).alias("text"))
    return (turns.filter(F.col(conv_id).isNotNull() & F.col(turn).isNotNull())
            .groupBy(F.col(conv_id).alias("conv_id")).agg(F.sort_array(F.collect_set(item)).alias("turns"))
            .select("conv_id", F.transform("turns", lambda t: F.struct(t["role"], t["text"])).cast(TURN).alias("turns")))


def render(turns: Column, template: tuple[str, str, str] = TEMPLATE) -> Column:
    opened, named, closed = template
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit(opened), t["role"], F.lit(named), t["text"], F.lit(closed))), "")


def learnt(turns: Column, role: str = "assistant", template: tuple[str, str, str] = TEMPLATE) -> Column:
    """[start, end) in code points of the rendered ``turns`` for each turn of ``role``: its text
    and closing mark."""
    opened, named, closed = template
    head = lambda t: F.char_length(t["role"]) + len(opened) + len(named)
    tail = lambda t: F.char_length(t["text"]) + len(closed)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    walked = F.aggregate(turns, start, lambda a, t: F.struct(
        (a["at"] + head(t) + tail(t)).alias("at"),
        F.when(t["role"] == role, F.concat(a["spans"], F.array(F.struct(
            (a["at"] + head(t)).alias("start"), (a["at"] + head(t) + tail(t)).alias("end")))))
        .otherwise(a["spans"]).alias("spans")))
    return walked["spans"]


def common_prefix(a: Column, b: Column) -> Column:
    """How many leading turns (role and text) the two conversations share."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    return let(same, lambda s: let(F.array_position(s, False), lambda p: F.when(p == 0, F.size(s)).otherwise(p - 1))).cast("int")


def preference_rows(pairs: DataFrame, role: str = "assistant",
                    template: tuple[str, str, str] = TEMPLATE) -> DataFrame:
    """``pairs`` (chosen, rejected: arrays of turns; other columns stay) with n_prompt_turns,
    prompt, chosen_text, rejected_text and their masks.

    Pairs without a common turn have an empty prompt; identical ones have empty completions and
    empty masks. A null side counts as a conversation without turns. Each row is formatted by
    itself, so repeated rows give equal results; an empty table gives an empty result."""
    none = F.array().cast(TURN)
    made = ["n_prompt_turns", "prompt", "chosen_text", "rejected_text", "chosen_mask", "rejected_mask"]
    pairs = pairs.drop(*(c for c in pairs.columns if c.lower() in made))
    shared, ours, theirs = (fresh(pairs, x) for x in ("shared", "ours", "theirs"))
    sides = pairs.withColumns({c: F.coalesce(F.col(c), none) for c in ("chosen", "rejected")})
    cut = sides.withColumn("n_prompt_turns", common_prefix(F.col("chosen"), F.col("rejected")))
    rest = lambda c: F.slice(c, F.col("n_prompt_turns") + 1, F.size(c))
    return (cut.withColumns({shared: F.slice("chosen", F.lit(1), F.col("n_prompt_turns")),
                             ours: rest("chosen"), theirs: rest("rejected")})
            .withColumns({"prompt": render(F.col(shared), template),
                          "chosen_text": render(F.col(ours), template), "chosen_mask": learnt(F.col(ours), role, template),
                          "rejected_text": render(F.col(theirs), template), "rejected_mask": learnt(F.col(theirs), role, template)})
            .drop("chosen", "rejected", shared, ours, theirs))


def mismatched_pairs(convs: DataFrame, role: str = "assistant") -> DataFrame:
    """(pair_id, chosen_id, rejected_id, chosen, rejected), one row for each conversation with an answer.

    Chosen is the conversation up to its last answer. Its partner is the next conversation with an
    answer in the order of their ids, after the last one the first; a single one is its own partner.
    Rejected begins like chosen and goes on with the partner's turns from turn ``d`` (pair_id modulo the
    number of chosen turns) up to the partner's last answer; where the partner ends before that, with
    this answer alone. So pairs part at any turn. Partners are found by dense numbers of the ids, which
    range partitions make; only ids are sorted."""
    last = F.array_max(F.transform("turns", lambda t, i: F.when(t["role"] == role, i)))
    own = convs.withColumn("last", last).filter(F.col("last").isNotNull())
    numbers = sequential_id(own.select("conv_id"), ["conv_id"], "seq")
    after = numbers.select(F.col("conv_id").alias("rejected_id"), (F.col("seq") - 1).alias("seq"))
    total = numbers.agg(F.max("seq")).first()[0]                   # one number; the first one follows the last
    after = after.withColumn("seq", F.when(F.col("seq") == 0, F.lit(total)).otherwise(F.col("seq")))
    partners = numbers.join(after, "seq").select("conv_id", "rejected_id")
    other = own.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("others"), F.col("last").alias("end"))
    d = F.pmod(F.col("conv_id"), F.col("last") + 1).cast("int")
    theirs = F.when(F.col("end") >= d, F.slice("others", d + 1, F.greatest(F.col("end") + 1 - d, F.lit(0)))).otherwise(
        F.array(F.get("others", F.col("end"))))
    return (own.join(partners, "conv_id").join(other, "rejected_id")
            .select(F.col("conv_id").alias("pair_id"), F.col("conv_id").alias("chosen_id"), "rejected_id",
                    F.slice("turns", F.lit(1), F.col("last") + 1).alias("chosen"),
                    F.concat(F.slice("turns", F.lit(1), d), theirs).cast(TURN).alias("rejected")))
