"""Deletes repeated runs of lines: the first occurrence stays, later ones go.

Lines are compared without white space around them, and blank ones are passed over; they stay or go
with the line before them. A repeated run is
a sequence of lines of ``least_chars`` characters or more that stood before: in a row with a smaller
doc_id (then a smaller hash of the text), or further up in the same text. It may be one long line
or many short ones.

Windows are the shortest runs of that size from each line onward, and from each line back. Each selects
the line with the smallest hash in it as its fingerprint, so equal runs are bound to share one. The
fingerprints that occur once anywhere are put aside; for the others the windows around them are
compared as a whole, which is the extension to both sides: what a repeated run holds is exactly what
the repeated windows in it hold together. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citypulse.llm.common import materialised

LEAST_CHARS = 200
#: First occurrences go to so many groups each, for lines that a large share of all texts has.
SALTS = 16
BLANK = " \t\r\x0b\x0c"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def windows(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """doc_id, tie, first, last (line numbers, blank ones after it included), at (the fingerprint's line), fp, whole, check.

    ``whole`` and ``check`` are hashes of the window's lines: of their sequence, and of their set by
    another function. Rows that agree in doc_id and text are one.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("tie"), "text").where("text is not null")
    split = rows.select("doc_id", "tie", _lines(F.col("text")).alias("lines"))
    lines = split.select("doc_id", "tie", F.size("lines").alias("total"), F.posexplode("lines").alias("line", "raw"))
    bare = lines.withColumn("bare", F.btrim("raw", F.lit(BLANK))).where("bare != ''")
    hashed = bare.select(
        "doc_id", "tie", "line", "total", F.length("bare").cast("long").alias("chars"),
        F.xxhash64("bare").alias("h"), F.xxhash64(F.lit("second"), F.col("bare")).alias("h2"),
    ).distinct()
    text = Window.partitionBy("doc_id", "tie").orderBy("line")
    ends = hashed.withColumn("end", F.sum("chars").over(text.rowsBetween(Window.unboundedPreceding, 0)))
    until = F.coalesce(F.lead("line").over(text), F.col("total")) - 1
    placed = ends.withColumns({"begin": F.col("end") - F.col("chars"), "until": until})
    onward = Window.partitionBy("doc_id", "tie").orderBy("begin").rangeBetween(0, least_chars - 1)
    back = Window.partitionBy("doc_id", "tie").orderBy("end").rangeBetween(-(least_chars - 1), 0)

    def facts(frame, name: str) -> Column:
        return F.struct(
            F.min("line").over(frame).alias("first"),
            F.max("until").over(frame).alias("last"),
            F.min(F.struct("h", "line")).over(frame).alias("least"),
            F.xxhash64(F.collect_list("h").over(frame)).alias("whole"),
            F.bit_xor("h2").over(frame).alias("check"),
            (F.max("end").over(frame) - F.min("begin").over(frame)).alias("chars"),
        ).alias(name)

    found = placed.select("doc_id", "tie", facts(onward, "onward"), facts(back, "back"))
    each = found.select("doc_id", "tie", F.explode(F.array("onward", "back")).alias("w")).where(
        F.col("w.chars") >= least_chars
    )
    return each.select(
        "doc_id", "tie", "w.first", "w.last", F.col("w.least.line").alias("at"), F.col("w.least.h").alias("fp"),
        "w.whole", "w.check",
    ).distinct()


def repeated(found: DataFrame) -> DataFrame:
    """doc_id, tie, first, last: the windows that stood somewhere before."""
    marks = found.select("doc_id", "tie", "at", "fp").distinct()
    shared = marks.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select("fp")
    candidates = materialised(_salted_join(found, shared, ["fp"], "left_semi"), "lines-candidates")
    place = F.struct("doc_id", "tie", "first")
    origins = candidates.groupBy("fp", "whole", "check").agg(F.min(place).alias("origin"), F.count("*").alias("n"))
    later = _salted_join(candidates, origins.where("n > 1").drop("n"), ["fp", "whole", "check"], "inner")
    return later.where(place > F.col("origin")).select("doc_id", "tie", "first", "last")


def _salted_join(large: DataFrame, small: DataFrame, keys: list[str], how: str) -> DataFrame:
    """A join on keys that many rows of ``large`` and one row of ``small`` have, split over tasks."""
    salt = F.pmod(F.xxhash64("doc_id", "tie"), F.lit(SALTS)).cast("int")
    copies = small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return large.withColumn("salt", salt).join(copies, [*keys, "salt"], how).drop("salt")


def deduplicated(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """All columns of ``docs`` with the text less its repeated runs, and removed_lines (int).

    A text without repeated runs is unchanged; one that is a repetition as a whole becomes empty.
    Null texts stay null. Rows that agree in doc_id and text lose the same lines and do not repeat
    each other. A null doc_id comes before all others.
    """
    found = materialised(windows(docs, least_chars), "lines-windows")
    gone = repeated(found).distinct().groupBy("doc_id", "tie").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    gone = gone.select(
        F.col("doc_id").alias("row of"), F.col("tie").alias("row of tie"),
        F.array_distinct(F.flatten(F.transform("runs", lambda r: F.sequence(r["first"], r["last"])))).alias("row gone"),
    )
    tied = docs.withColumn("row tie", F.xxhash64("text"))
    joined = tied.join(gone, F.col("doc_id").eqNullSafe(F.col("row of")) & (F.col("row tie") == F.col("row of tie")), "left")
    lines = _lines(F.col("text"))
    keep = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("row gone"))
    text = F.when(F.col("row gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(keep, lambda i: F.get(lines, i)), "\n")
    )
    kept = [c for c in docs.columns if c != "removed_lines"]
    written = joined.withColumn("removed_lines", F.coalesce(F.size("row gone"), F.lit(0))).withColumn("row text", text)
    return written.select(*(F.col("row text").alias("text") if c == "text" else F.col(c) for c in kept), "removed_lines")
