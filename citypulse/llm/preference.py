"""Preference formatting: a pair of conversations as one prompt and two masked completions.

The longest common prefix of whole turns is rendered once as the prompt; what follows on either
side is its completion. A mask names the stretches of a completion that count for the loss: the
assistant's words and the mark that ends its turn. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The marks around a turn. A turn's own text cannot contain them: "<|" in it becomes "< |".
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
SCORED = "assistant"
FORMATTED = (
    "prompt", "prompt_turns", "chosen_completion", "rejected_completion", "chosen_mask", "rejected_mask", "usable",
)


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id, turns (array of role, text): one row for each conversation.

    Turns go by number, null first, then by role and text; repeated rows are repeated turns. A null
    role is "user", a null text is empty. Rows without a conv_id belong to no conversation.
    """
    turn = F.struct(
        "turn", F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    kept = F.transform(F.sort_array(F.collect_list(turn)), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return turns.where("conv_id is not null").groupBy("conv_id").agg(kept.alias("turns"))


def _plain(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), _plain(turn["role"]), F.lit("\n"))


def _body(turn: Column) -> Column:
    return F.concat(_plain(turn["text"]), F.lit(CLOSE))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t), F.lit("\n"))), "")


def _mask(turns: Column) -> Column:
    """(start, end) of the scored stretches in the rendered turns: code points, end exclusive."""
    begun = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    step = F.transform(
        turns,
        lambda t: F.struct(
            F.length(_head(t)).alias("head"),
            F.length(_body(t)).alias("body"),
            (t["role"] == SCORED).alias("scored"),
        ),
    )
    folded = F.aggregate(
        step,
        begun,
        lambda done, t: F.struct(
            (done["at"] + t["head"] + t["body"] + 1).alias("at"),
            F.when(
                t["scored"],
                F.concat(
                    done["spans"],
                    F.array(
                        F.struct(
                            (done["at"] + t["head"]).alias("start"), (done["at"] + t["head"] + t["body"]).alias("end")
                        )
                    ),
                ),
            )
            .otherwise(done["spans"])
            .alias("spans"),
        ),
    )
    return folded["spans"]


def formatted(pairs: DataFrame) -> DataFrame:
    """The columns of ``pairs`` but chosen and rejected, and the pair in its written form.

    ``chosen`` and ``rejected`` are arrays of (role, text); null counts as an empty conversation.
    Adds prompt, prompt_turns, chosen_completion, rejected_completion, chosen_mask, rejected_mask, and
    usable: whether both completions have something to score and differ. Where one conversation goes
    on from the whole of the other, the shorter one's completion is empty; equal ones have two. Columns
    of these names in ``pairs`` are replaced.
    """
    nothing = F.array().cast("array<struct<role:string,text:string>>")
    sides = pairs.withColumns({c: F.coalesce(c, nothing) for c in ("chosen", "rejected")})
    agree = F.zip_with("chosen", "rejected", lambda a, b: a.eqNullSafe(b))
    apart = F.array_position(agree, False)
    # where one ends, zip_with goes on with null on its side, which equals no turn
    common = F.when(apart > 0, apart - 1).otherwise(F.size("chosen")).cast("int")
    cut = sides.withColumn("prompt_turns", common)
    rest = {
        side: F.slice(side, F.col("prompt_turns") + 1, F.greatest(F.size(side) - F.col("prompt_turns"), F.lit(0)))
        for side in ("chosen", "rejected")
    }
    cut = cut.withColumn("prompt", _rendered(F.slice("chosen", F.lit(1), F.col("prompt_turns")))).withColumns(rest)
    written = cut.withColumns(
        {
            f"{side}_{what}": made(F.col(side))
            for side in ("chosen", "rejected")
            for what, made in (("completion", _rendered), ("mask", _mask))
        }
    )
    usable = (F.size("chosen_mask") > 0) & (F.size("rejected_mask") > 0)
    kept = [c for c in pairs.columns if c not in ("chosen", "rejected", *FORMATTED)]
    return written.withColumn("usable", usable).select(*kept, *FORMATTED)


def _last_answer(turns: Column) -> Column:
    """The place (from 1) of the last assistant turn; 0 if there is none."""
    return F.aggregate(
        F.transform(turns, lambda t, i: F.when(t["role"] == SCORED, i + 1).otherwise(F.lit(0))),
        F.lit(0),
        lambda most, i: F.greatest(most, i),
    )


def with_swapped_answers(talks: DataFrame) -> DataFrame:
    """conv_id, chosen, rejected: each conversation against itself with a neighbour's last answer.

    Conversations 2n and 2n + 1 are neighbours. The rejected side keeps the turns before the last
    answer, puts the neighbour's last answer there, and stops. Without an answer on either side it
    is the conversation without its last answer, or the unchanged conversation.
    """
    place = _last_answer(F.col("turns"))
    sides = talks.select("conv_id", "turns", place.alias("at"), F.col("conv_id").bitwiseXOR(F.lit(1)).alias("neighbour"))
    answers = sides.where("at > 0").select(
        F.col("neighbour").alias("conv_id"), F.element_at("turns", F.col("at")).alias("answer")
    )
    before = F.slice("turns", F.lit(1), F.greatest(F.col("at") - 1, F.lit(0)))
    rejected = (
        F.when(F.col("at") == 0, F.col("turns"))
        .when(F.col("answer").isNull(), before)
        .otherwise(F.concat(before, F.array("answer")))
    )
    return sides.join(answers, "conv_id", "left").select("conv_id", F.col("turns").alias("chosen"), rejected.alias("rejected"))
