"""Quality rules: lines that many documents of a host share go, documents that little is left of are rejected.

A line is normalised (A-Z in lower case, white space around it off and within it one space, each number
one 0) and hashed together with its host. Its frequency is the number of different documents of the
host that hold it; documents of one host with the same text are one, so copies do not condemn each
other. A line goes when its frequency is above both limits: ``most_docs`` documents, and ``share`` of the host's
documents. A document is depleted when fewer than ``least_words`` words are left, or less than
``least_share`` of its words.

Lines travel as hashes; texts are not shuffled for the verdicts. Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citypulse.llm.common import materialised

MOST_DOCS = 6
SHARE = 0.001
LEAST_WORDS = 20
LEAST_SHARE = 0.2
#: Words of a window that counts as repeated, and the percentage of words in such windows that fails a text.
WINDOW = 8
MOST_REPEATED = 30
SALTS = 16
BLANK = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, where the body's lambdas would compute a column for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANK))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def repeated_words(words: Column) -> Column:
    """Number of words in windows of eight words that are found twice or more, the first one included."""

    def ordered(hashes: Column) -> Column:
        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(hashes) > F.size(F.array_distinct(hashes)), F.array_sort(placed))

    def found_twice(entries: Column) -> Column:
        def same(entry: Column, other: Column) -> Column:
            return F.coalesce(entry["h"] == F.get(entries, other)["h"], F.lit(False))

        return F.filter(entries, lambda e, k: same(e, k - 1) | same(e, k + 1))

    def covered(starts: Column) -> Column:
        steps = F.transform(starts, lambda p, k: F.least(F.lit(WINDOW), F.get(starts, k + 1) - p))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

    def windows(hashes: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(hashes) - WINDOW)
        return F.when(
            F.size(hashes) >= WINDOW,
            F.transform(places, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)])),
        )

    hashes = _let(F.transform(words, lambda w: F.xxhash64(w)), windows)
    twice = _let(_let(hashes, ordered), found_twice)
    starts = F.array_sort(F.transform(twice, lambda e: e["i"]))
    return F.coalesce(_let(starts, covered), F.lit(0).cast("long"))


def facts(text: Column) -> dict[str, Column]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text; all zero for a null one."""
    whole = F.coalesce(text, F.lit(""))
    worded = F.filter(lines_of(text), lambda line: F.btrim(line, F.lit(BLANK)) != "")
    words = words_of(text)
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.translate(whole, BLANK, "")).cast("long"),
        "n_symbols": (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": _let(worded, lambda found: F.size(found) - F.size(F.array_distinct(found))).cast("long"),
        "n_repeat_words": repeated_words(words),
    }


def _document(host: str) -> Column:
    """A text's hash within its host: what makes documents different."""
    return F.xxhash64(_host(host), F.coalesce(F.col("text"), F.lit("")))


def _host(host: str) -> Column:
    """The hash of a host; a null one is a host of its own."""
    return F.xxhash64(F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit("")))


def normalised(line: Column) -> Column:
    plain = F.regexp_replace(F.btrim(F.translate(line, UPPER, LOWER), F.lit(BLANK)), r"[\x20\x09-\x0D]+", " ")
    return F.regexp_replace(plain, "[0-9]+", "0")


def line_hashes(docs: DataFrame, host: str = "source") -> DataFrame:
    """document, host, line (its number), key, words: a row for each line with a word."""
    rows = docs.select(
        _document(host).alias("document"), _host(host).alias("host"), lines_of(F.col("text")).alias("lines")
    )
    # hashed before the lines are exploded: above the explode the whole text would be hashed for each line
    lines = rows.select("document", "host", F.posexplode("lines").alias("line", "raw"))
    worded = lines.where(F.btrim("raw", F.lit(BLANK)) != "")
    plain = worded.select("document", "host", "line", normalised(F.col("raw")).alias("plain"))
    return plain.select(
        "document", "host", "line", F.xxhash64("host", "plain").alias("key"),
        F.size(F.split("plain", " ")).alias("words"),
    )


def _salted_join(large: DataFrame, by: str, small: DataFrame, keys: list[str], how: str) -> DataFrame:
    """A join on keys that many rows of ``large`` and one row of ``small`` have, split over tasks by column ``by``."""
    copies = small.withColumn("row salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = large.withColumn("row salt", F.pmod(F.xxhash64(F.col(by), F.lit("salt")), F.lit(SALTS)).cast("int"))
    return dealt.join(copies, [*keys, "row salt"], how).drop("row salt")


def frequent(lines: DataFrame, most_docs: int = MOST_DOCS, share: float = SHARE) -> DataFrame:
    """key of the lines above both limits.

    Documents are made different before they are counted, by (line, document), so a line that a third of all
    documents hold is counted in many tasks, and only the counts meet.
    """
    seen = lines.select("host", "key", "document").distinct()
    counts = seen.groupBy("host", "key").agg(F.count("*").alias("held")).where(F.col("held") > most_docs)
    hosts = lines.select("host", "document").distinct().groupBy("host").agg(F.count("*").alias("all"))
    return _salted_join(counts, "key", hosts, ["host"], "inner").where(F.col("held") > F.col("all") * share).select("key")


def removed(
    docs: DataFrame, host: str = "source", most_docs: int = MOST_DOCS, share: float = SHARE
) -> DataFrame:
    """row of (document), gone (line numbers), gone_words: a row for each text that loses lines."""
    lines = materialised(line_hashes(docs, host), "frequency-lines")
    above = materialised(frequent(lines, most_docs, share), "frequency-above")
    hit = _salted_join(lines, "document", above, ["key"], "left_semi").dropDuplicates(["document", "line"])
    return hit.groupBy(F.col("document").alias("row of")).agg(
        F.collect_list("line").alias("gone"), F.sum("words").alias("gone_words")
    )


def _with_removed(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows with what their texts lose; many copies of a text are split over tasks by their doc_id."""
    copies = gone.withColumn("row salt of", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("row id"), F.lit(SALTS)).cast("int")
    dealt = docs.withColumn("row salt", salt)
    same = (F.col("row document") == F.col("row of")) & (F.col("row salt") == F.col("row salt of"))
    return dealt.join(copies, same, "left").drop("row salt", "row salt of", "row of")


def _kept(least_words: int, least_share: float) -> tuple[Column, Column]:
    """base_failed and kept, of the facts and n_left."""
    repetitive = 100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    base = (F.col("n_words") < LEAST_WORDS) | repetitive
    enough = (F.col("n_left") >= least_words) & (F.col("n_left") >= F.col("n_words") * least_share)
    return base, ~base & enough


def verdicts(
    docs: DataFrame,
    host: str = "source",
    most_docs: int = MOST_DOCS,
    share: float = SHARE,
    least_words: int = LEAST_WORDS,
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """doc_id, the facts of its text, base_failed, kept, n_removed_lines, n_left (words): a row for each row.

    A null, empty or blank text has no words, fails the base rules and counts as no document of its
    host. Equal rows get equal verdicts. An empty table gives none.
    """
    gone = removed(docs, host, most_docs, share)
    rows = docs.select(
        F.col("doc_id").alias("row id"), _document(host).alias("row document"),
        *[c.alias(n) for n, c in facts(F.col("text")).items()],
    )
    joined = _with_removed(rows, gone)
    left = joined.select(
        F.col("row id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed_lines"),
        (F.col("n_words") - F.coalesce("gone_words", F.lit(0))).alias("n_left"),
    )
    base, kept = _kept(least_words, least_share)
    return left.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), kept.alias("kept"), "n_removed_lines", "n_left",
    )


def cleaned(
    docs: DataFrame,
    host: str = "source",
    most_docs: int = MOST_DOCS,
    share: float = SHARE,
    least_words: int = LEAST_WORDS,
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """The documents that are kept, all their columns as they are, the text less its frequent lines."""
    gone = removed(docs, host, most_docs, share)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(
        whole, F.col("doc_id").alias("row id"), _document(host).alias("row document"), F.col("text").alias("row text"),
        *[c.alias(n) for n, c in facts(F.col("text")).items() if n in ("n_words", "n_repeat_words")],
    )
    joined = _with_removed(rows, gone)
    left = joined.withColumn("n_left", F.col("n_words") - F.coalesce("gone_words", F.lit(0)))
    stay = left.where(_kept(least_words, least_share)[1])
    lines = lines_of(F.col("row text"))
    keep = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    text = F.when(F.col("gone").isNull(), F.col("row text")).otherwise(
        _let(lines, lambda found: F.array_join(F.transform(keep, lambda i: F.get(found, i)), "\n"))
    )
    return stay.select(*(text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns))
