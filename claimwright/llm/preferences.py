"""Operator 6 [native]: preference pairs as one prompt and two masked completions.

Chosen and rejected conversations are turn tables with one pair id. The longest common prefix of their turns
(role and text alike) is rendered once, as the prompt; what follows in each is its completion. A mask lists the
spans of a completion that are learned from: what the assistant says, with its end mark, as offsets of
characters [start, end) after the completion's begin.

DataFrame functions only. One shuffle, by pair id; a task holds the turns of a pair, which are one output row, however long
their texts. Other columns of the inputs are not read, so their names cannot clash.

Turns are in order of (turn, role, text), nulls first, so gaps and repeated turns do no harm. A null role is
rendered as ``unknown``, a null text as empty. If one conversation is the beginning of the other, its completion
is empty; if both are alike, all is prompt. A pair with one side only has an empty prompt, and an empty
completion on the side that lacks. A null pair id is a pair of its own. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPEN, CLOSE, SPEAKER = "<|im_start|>", "<|im_end|>", "assistant"


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(turn["role"], F.lit("unknown")), F.lit("\n"))


def _body(turn: Column) -> Column:
    return F.concat(F.coalesce(turn["text"], F.lit("")), F.lit(CLOSE + "\n"))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def spans(turns: Column, speaker: str) -> Column:
    """Array of (start, end) of what the speaker says in the rendered turns."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.length(_head(turn))
        end = begin + F.length(_body(turn))
        own = F.array(F.struct(begin.alias("start"), end.alias("end")))
        said = F.when(turn["role"] == speaker, F.concat(state["spans"], own)).otherwise(state["spans"])
        return F.struct(end.cast("bigint").alias("at"), said.cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    return F.aggregate(turns, start, step, lambda state: state["spans"])


def _common(chosen: Column, rejected: Column) -> Column:
    """Number of turns that both begin with."""

    def alike(a: Column, b: Column) -> Column:
        return a.isNotNull() & b.isNotNull() & a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"])

    same = F.zip_with(chosen, rejected, alike)
    at = F.array_position(same, False)
    return F.when(at == 0, F.size(same)).otherwise(at - 1).cast("int")


def _turn() -> Column:
    return F.struct(F.col("turn").cast("bigint").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))


def preference_pairs(chosen: DataFrame, rejected: DataFrame, pair_id: str = "pair_id", speaker: str = SPEAKER) -> DataFrame:
    """pair_id, n_common, prompt, chosen, rejected, chosen_mask, rejected_mask. Both inputs: pair_id, turn, role, text."""
    def side(df: DataFrame, is_chosen: bool) -> DataFrame:
        return df.select(F.col(pair_id).alias("pair_id"), F.lit(is_chosen).alias("is_chosen"), _turn().alias("t"))

    both = side(chosen, True).unionByName(side(rejected, False))
    # collect_list leaves nulls out: the other side's turns.
    pairs = both.groupBy("pair_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("is_chosen"), F.col("t")))).alias("c"),
        F.sort_array(F.collect_list(F.when(~F.col("is_chosen"), F.col("t")))).alias("r"),
    )
    return _formatted(pairs, speaker)


def _formatted(pairs: DataFrame, speaker: str) -> DataFrame:
    """``pairs``: pair_id and both sides' turns in order, c and r."""
    pairs = pairs.withColumn("n_common", _common(F.col("c"), F.col("r")))
    rest = {s: F.slice(F.col(s), F.col("n_common") + 1, F.size(s) - F.col("n_common")) for s in "cr"}
    return pairs.select(
        "pair_id", "n_common", rendered(F.slice("c", 1, F.col("n_common"))).alias("prompt"), rendered(rest["c"]).alias("chosen"),
        rendered(rest["r"]).alias("rejected"), spans(rest["c"], speaker).alias("chosen_mask"), spans(rest["r"], speaker).alias("rejected_mask"),
    )


def swapped_replies(turns: DataFrame, speaker: str = SPEAKER) -> tuple[DataFrame, DataFrame]:
    """Preference pairs from a table that names none: every conversation up to its last reply is chosen, the
    same with the last reply of its neighbour (ids 2k and 2k + 1) in place of its own is rejected.

    Without a neighbour, or one that replies, the rejected side ends before the reply. A conversation that has
    no reply is the same on both sides. Of replies with the same turn number the greatest text counts as the last.
    """
    rows = turns.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text")
    said = F.when(F.col("role") == speaker, F.struct("turn", F.coalesce("text", F.lit("")).alias("text")))
    last = rows.groupBy("conv_id").agg(F.max(said).alias("last"))
    last = last.select(F.col("conv_id").alias("pair_id"), F.col("last.turn").alias("last_turn"), F.col("last.text").alias("reply"))
    mine = rows.join(last, rows["conv_id"].eqNullSafe(last["pair_id"])).filter(F.col("last_turn").isNull() | (F.col("turn") <= F.col("last_turn")) | F.col("turn").isNull())
    chosen = mine.select("pair_id", "turn", "role", "text")
    before = mine.filter(F.col("last_turn").isNull() | F.col("turn").isNull() | (F.col("turn") < F.col("last_turn"))).select("pair_id", "turn", "role", "text")
    other = last.select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"), F.col("reply").alias("text")).filter("text is not null")
    swapped = last.filter("last_turn is not null").select("pair_id", F.col("last_turn").alias("turn"), F.lit(speaker).alias("role")).join(other, "pair_id")
    return chosen, before.unionByName(swapped)


def _reply(turns: Column, speaker: str) -> Column:
    """Turn number and text of the last that the speaker says; null without one."""
    said = F.filter(turns, lambda t: t["role"] == speaker)
    return F.array_max(F.transform(said, lambda t: F.struct(t["turn"].alias("turn"), F.coalesce(t["text"], F.lit("")).alias("text"))))


def swapped_pairs(turns: DataFrame, speaker: str = SPEAKER) -> DataFrame:
    """``preference_pairs(*swapped_replies(turns))`` in one scan and one shuffle: neighbours are grouped together,
    and each takes the other's reply out of the turns that are there. A task holds the turns of two conversations."""
    side = F.coalesce(F.col("conv_id").bitwiseAND(F.lit(1)), F.lit(0))
    both = turns.groupBy(F.shiftright("conv_id", 1).alias("k")).agg(
        *[F.sort_array(F.collect_list(F.when(side == n, _turn()))).alias(f"side{n}") for n in (0, 1)])
    kind = dict(turns.dtypes)["conv_id"]

    def one(mine: int) -> Column:
        return F.struct(F.shiftleft("k", 1).bitwiseOR(F.lit(mine)).cast(kind).alias("pair_id"), F.col(f"side{mine}").alias("c"),
                        _reply(F.col(f"side{1 - mine}"), speaker)["text"].alias("other"))

    mine = both.select(F.inline(F.array(one(0), one(1)))).filter(F.size("c") > 0).withColumn("at", _reply(F.col("c"), speaker)["turn"])
    at = F.col("at")
    reply = F.struct(at.alias("turn"), F.lit(speaker).alias("role"), F.col("other").alias("text"))
    swapped = F.when(at.isNotNull() & F.col("other").isNotNull(), F.array(reply)).otherwise(F.array().cast("array<struct<turn:bigint,role:string,text:string>>"))
    # Turns before the reply are in order already, those without a number first.
    return _formatted(mine.select(
        "pair_id", F.filter("c", lambda t: at.isNull() | t["turn"].isNull() | (t["turn"] <= at)).alias("c"),
        F.concat(F.filter("c", lambda t: at.isNull() | t["turn"].isNull() | (t["turn"] < at)), swapped).alias("r")), speaker)
