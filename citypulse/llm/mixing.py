"""Mixing sources to target sizes by entropy balancing.

Every document gets a rate of copies, min(2, exp(l * size / mean size)), with one multiplier l for
each source: of all rates up to the limit that bring the source's words to its target, those
nearest to one copy each in relative entropy. Safeguarded Newton steps on the dual find the
multipliers. A rate depends on source and size alone, so the steps run on counts of documents by
source and size. Rates are then rounded from the largest size to the smallest, each size taking on
what was left over before.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citypulse.llm.common import Rounds, map_rows, materialised, salted, word_blocks

WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2.0
SALTS = 64
STEPS = 60
CLOSE = 1e-9
#: So many rows at a time are made from the number of rows that agree.
BLOCK = 1_000


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words of the whole text; null: 0), tie (a hash of the text)."""

    def run(rows):
        for doc_id, source, text, tie in rows:
            yield doc_id, source, sum(map(len, word_blocks(text or b""))), tie

    rows = docs.select("doc_id", "source", "text", F.xxhash64("text").alias("tie"))
    return map_rows(rows, run, "doc_id long, source string, size long, tie long", binary=("text",))


def targets(totals: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """``totals`` (source, source_size) with target.

    Sources in the order of their code points, null last, have the weights in turn and share
    ``share`` of all sizes; none gets more than ``LIMIT`` times its size. Sources at their limit come
    first in the order of limit / weight, so one pass in that order finds who they are.
    There is one row for each source here.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (place % len(weights) + 1).cast("int"))
    limited = totals.withColumn("weight", weight).withColumn("limit", F.col("source_size") * LIMIT)
    ratio = F.col("limit") / F.col("weight")
    order = Window.orderBy(ratio, F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) * share - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    level = left / F.sum("weight").over(onward)  # what a unit of weight gets if all before are at their limit
    # the first source below its limit sees the level that holds for all after it; theirs are lower
    free = F.max(F.when(ratio > F.col("level"), F.col("level"))).over(everything)
    return limited.withColumn("level", level).withColumn("free", free).select(
        "source", "source_size",
        F.least("limit", F.coalesce(F.col("free") * F.col("weight"), "limit")).alias("target"),
    )


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def multipliers(counts: DataFrame, goals: DataFrame) -> DataFrame:
    """source, multiplier, mean by Newton steps over ``counts`` (source, size, n).

    A source at its limit, or without words, has no multiplier. Each step is one job over the counts;
    the multipliers stay in a table in the shared folder, the driver sees how many are unfinished.
    """
    spread = counts.where("size > 0").groupBy("source").agg(
        (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"), F.min("size").alias("least")
    )
    start = goals.join(spread, _same(goals.source, spread.source)).drop(spread.source)
    rounds = Rounds(
        start.where(F.col("target") < LIMIT * F.col("source_size") * (1 - 1e-12)).select(
            "source", "target", "mean",
            (F.col("mean") / F.col("least") * F.least(F.log(F.col("target") / F.col("source_size")), F.lit(0.0))).alias("low"),
            (F.col("mean") / F.col("least") * F.log(F.lit(LIMIT))).alias("high"),
            F.lit(0.0).alias("multiplier"), F.lit(False).alias("done"),
        ),
        "mixing-multipliers",
    )
    for _ in range(STEPS):
        if not rounds.state.where("not done").take(1):
            break
        rounds.replace(_step(counts, rounds.state))
    else:
        if rounds.state.where("not done").take(1):
            raise ArithmeticError(f"multipliers are not found within {STEPS} steps")
    return rounds.state.select("source", "multiplier", "mean")


def _rate(multiplier: Column, size: Column, mean: Column) -> Column:
    return F.exp(F.least(multiplier * size / mean, F.log(F.lit(LIMIT))))


def _step(counts: DataFrame, state: DataFrame) -> DataFrame:
    z = F.col("size") / F.col("mean")
    words = F.col("n") * F.col("size") * _rate(F.col("multiplier"), F.col("size"), F.col("mean"))
    sums = (
        counts.withColumnRenamed("source", "of").join(state, _same(F.col("of"), F.col("source")))
        .groupBy("source", "target", "mean", "low", "high", "multiplier")
        .agg(
            F.sum(words).alias("now"),
            F.sum(F.when(F.col("multiplier") * z < F.log(F.lit(LIMIT)), words * z).otherwise(0.0)).alias("slope"),
        )
    )
    low = F.when(F.col("now") <= F.col("target"), F.col("multiplier")).otherwise(F.col("low"))
    high = F.when(F.col("now") >= F.col("target"), F.col("multiplier")).otherwise(F.col("high"))
    done = (F.abs(F.col("now") - F.col("target")) <= CLOSE * F.col("target")) | (
        F.col("high") - F.col("low") <= 1e-14 * F.abs(F.col("high")) + 1e-300
    )
    moved = F.col("multiplier") - F.when(
        F.col("slope") > 0, F.col("now") / F.col("slope") * F.log(F.col("now") / F.col("target"))
    )
    inside = (moved > F.col("low")) & (moved < F.col("high"))
    return (
        sums.withColumns({"low": low, "high": high})
        .withColumn("done", done)
        .withColumn("next", F.when(inside, moved).otherwise((F.col("low") + F.col("high")) / 2))
        .select(
            "source", "target", "mean", "low", "high",
            F.when(F.col("done"), F.col("multiplier")).otherwise(F.col("next")).alias("multiplier"), "done",
        )
    )


def _rounded(sizes: pd.DataFrame) -> pd.DataFrame:
    """How many documents of each size of a source get one copy more than the whole part of their rate.

    From the largest size down; what rounding leaves over, in words, goes on to the next smaller size, so
    that a source ends within half a small document of its target. There is a row for each size.
    """
    sizes = sizes.sort_values("size", ascending=False)
    more, left = [], 0.0
    for size, n, whole, part in zip(sizes["size"], sizes["n"], sizes["whole"], sizes["part"]):
        wanted = n * part + (left / size if size else 0.0)
        more.append(0 if whole >= LIMIT or not size else int(min(n, max(0, math.floor(wanted + 0.5)))))
        left = (wanted - more[-1]) * size
    out = sizes.assign(more=more).rename(columns={"size": "z", "n": "total"})
    return out[["source", "z", "source_size", "target", "total", "whole", "more"]]


def _decided(docs: DataFrame, weights: tuple[float, ...], share: float) -> DataFrame:
    """doc_id, tie, source, size, source_size, target, whole, rows, more: a row for those that agree in doc_id, text and source.

    ``rows`` is how many they are; ``more`` of them get one copy more than ``whole``. Tables that grow
    with the documents are merged by sorting: their files are small for their rows, and Spark would
    take them for small enough to broadcast.
    """
    alike = sizes(docs).groupBy("doc_id", "source", "size", "tie").agg(F.count("*").alias("rows"))
    sized = materialised(alike.withColumn("salt", salted("doc_id", SALTS)), "mixing-sizes")
    cells = materialised(sized.groupBy("source", "size", "salt").agg(F.sum("rows").alias("n")), "mixing-cells")
    counts = materialised(cells.groupBy("source", "size").agg(F.sum("n").alias("n")), "mixing-counts")
    totals = counts.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    goals = materialised(targets(totals, weights, share), "mixing-targets")
    found = multipliers(counts, goals)
    rated = (
        counts.join(goals.withColumnRenamed("source", "s1"), _same(F.col("source"), F.col("s1")))
        .join(found.withColumnRenamed("source", "s2"), _same(F.col("source"), F.col("s2")), "left")
        .withColumn(
            "rate",
            F.when(F.col("size") == 0, 1.0)
            .when(F.col("multiplier").isNull(), LIMIT)
            .otherwise(_rate(F.col("multiplier"), F.col("size"), F.col("mean"))),
        )
        .withColumn("whole", F.floor("rate").cast("int"))
        .withColumn("part", F.col("rate") - F.col("whole"))
    )
    rounded = materialised(
        rated.select("source", "size", "source_size", "target", "n", "whole", "part")
        .groupBy("source")
        .applyInPandas(_rounded, "source string, z long, source_size long, target double, total long, whole int, more long"),
        "mixing-rates",
    )
    # the further copies of a size are spread over its salts in proportion
    turns = Window.partitionBy("of", "z").orderBy("salt")
    upto = F.sum("n").over(turns.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    reached = F.expr("CAST(more AS DECIMAL(18,0)) * CAST(upto AS DECIMAL(18,0)) div total")
    extras = (
        cells.withColumnRenamed("source", "of")
        .join(rounded.hint("merge"), _same(F.col("of"), F.col("source")) & (F.col("z") == F.col("size")))
        .withColumn("upto", upto)
        .withColumn("reached", reached)
        .withColumn("extra", F.col("reached") - F.coalesce(F.lag("reached").over(turns), F.lit(0)))
        .select("of", "z", F.col("salt").alias("cell"), "source_size", "target", "whole", "extra")
    )
    extras = materialised(extras, "mixing-extras")
    turn = Window.partitionBy("source", "size", "salt").orderBy(F.xxhash64("doc_id"), "doc_id", "tie")
    before = F.coalesce(F.sum("rows").over(turn.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        sized.withColumn("before", before)
        .join(
            extras.hint("merge"),
            _same(F.col("source"), F.col("of")) & (F.col("size") == F.col("z")) & (F.col("salt") == F.col("cell")),
        )
        .select(
            "doc_id", "tie", "source", "size", "source_size", "target", "whole", "rows",
            F.least("rows", F.greatest(F.col("extra") - F.col("before"), F.lit(0))).alias("more"),
        )
    )


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """doc_id, tie, size, source_size, target, copies (0, 1 or 2): one row for each row of ``docs``.

    Null and empty texts have size 0 and one copy; a null source is a source of its own, the last.
    Rows that agree in doc_id and text are interchangeable. Reruns give the same rows.
    """
    found = _decided(docs, weights, share)
    blocks = found.withColumn("block", F.explode(F.expr(f"sequence(0L, rows - 1, {BLOCK}L)")))
    turns = F.sequence(F.col("block") + 1, F.least("rows", F.col("block") + BLOCK))
    return blocks.withColumn("turn", F.explode(turns)).select(
        "doc_id", "tie", "size", "source_size", "target",
        (F.col("whole") + (F.col("turn") <= F.col("more")).cast("int")).alias("copies"),
    )


def _hashed(field: T.StructField) -> Column:
    """A column as it can be hashed: a type with maps as text."""
    column = F.col(f"`{field.name}`")
    return F.to_json(F.struct(column)) if "map<" in field.dataType.simpleString() else column


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as its copies, with all columns.

    Rows that agree in doc_id, text and source are ordered by a hash of all their columns; the first have no copy,
    the next one, the last two. Rows that agree in everything are one row with a number, summed before
    the shuffle, so that a crowd of them is nowhere gathered or numbered. Reruns give the same rows.
    """
    same = ["row key", "row tie", "row source"]
    source = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    usual, once_more = F.col("rows") - F.col("more"), F.col("more")
    bounds = materialised(
        _decided(docs, WEIGHTS, SHARE).select(
            key.alias(same[0]), F.col("tie").alias(same[1]), source.alias(same[2]),
            F.when(F.col("whole") == 0, usual).otherwise(0).alias("row none"),
            F.when(F.col("whole") == 0, usual + once_more).when(F.col("whole") == 1, usual).otherwise(0).alias("row once"),
        ),
        "mixing-bounds",
    )
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        key.alias(same[0]), F.xxhash64("text").alias(same[1]), source.alias(same[2]),
        F.xxhash64(*map(_hashed, docs.schema.fields)).alias("row hash"),
    )
    counts = keyed.groupBy(*same, "row hash").agg(F.count("*").alias("row held"))
    earlier = Window.partitionBy(*same).orderBy("row hash").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("row held").over(earlier), F.lit(0))
    placed = counts.withColumn("row first", first).join(bounds.hint("merge"), same)

    def behind(bound: str) -> Column:
        """How many of the rows come behind so many."""
        last = F.col("row first") + F.col("row held")
        return F.greatest(F.lit(0), last - F.greatest(F.col("row first"), F.col(bound)))

    # behind the rows without a copy each has one, behind those with one a second
    placed = placed.select(*same, "row hash", (behind("row none") + behind("row once")).alias("row copies"))
    whole = keyed.groupBy(*same, "row hash").agg(F.first("row").alias("row"))
    taken = whole.join(placed.where("`row copies` > 0").hint("merge"), [*same, "row hash"])
    blocks = taken.withColumn("row block", F.explode(F.expr(f"sequence(0L, `row copies` - 1, {BLOCK}L)")))
    turns = F.sequence(F.col("row block") + 1, F.least("row copies", F.col("row block") + BLOCK))
    return blocks.select("row", F.explode(turns)).select(*[F.col("row")[c].alias(c) for c in docs.columns])
