"""Phrases that occur together more often than their parts would, counted with HAT-tries.

Each task counts in a trie over word ids, whose levels are the digits of a phrase's ids: few of them, as below
are hash containers of whole phrases. A container that grows too large bursts into containers by the
next digit. When the trie holds too many entries, whole subtrees, those that repeat the least first, leave
it as runs sorted by words. Runs are a table in the shared folder. They are merged by prefix: rows that
begin with the same two words meet in one partition, and as every task has summed its own before, a
word or pair that a third of all texts holds comes as a few rows from each task.

The trie grows by level. The first pass counts words and pairs; the second counts three words in a row, but
only where both pairs in them may be frequent, as a phrase is never more frequent than its parts. The
frequent pairs are known to the tasks by a table of bits of fixed size, whatever their number: a pair that is
not among them may pass, and then costs an entry, a frequent one always does. Scores are exact integers.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citypulse.llm.common import materialised

LEAST = 10
TOP = 2_000
#: A candidate goes that has this percentage of its occurrences within a longer one.
WITHIN = 50
#: Entries of a container that bursts, of a trie that spills, and words that a trie knows at most.
BURST = 1 << 12
ENTRIES = 800_000
VOCABULARY = 200_000
#: Bits of the table of frequent pairs, 8 MB, whatever the input.
BITS = 1 << 26
#: Words that are counted in arrays before they go to the trie.
BLOCK = 1 << 18
#: Bits of a word id in a packed phrase: more than a vocabulary and the words of a block can be.
WIDTH = 21
MASK = (1 << WIDTH) - 1
#: Shift and mask of the digits by which a phrase is found: two of its first word, two of its second.
DIGITS = ((2 * WIDTH, 255), (2 * WIDTH + 8, 15), (WIDTH, 15), (WIDTH + 4, 15))
ROWS = 1 << 15
SALTS = 8
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
#: A byte that no text has stands between pieces.
END = b"\xff"
#: A-Z become a-z, separators ends of pieces.
PLAIN = bytes.maketrans(bytes(range(65, 91)) + SEPARATORS, bytes(range(97, 123)) + END * len(SEPARATORS))
EDGE = re.compile(rb"[\x20\x09\xff]")
#: Bytes of a text that are split into words at a time.
CHUNK = 1 << 20
RUN = pa.schema([("lang", pa.string()), ("first", pa.string()), ("second", pa.string()), ("third", pa.string()), ("n", pa.int64())])
RUN_DDL = "lang string, first string, second string, third string, n long"
UNKNOWN = "und"


class Node:
    """Phrases that agree in the digits of the levels above: in a container, or burst, in nodes by this level's digit."""

    __slots__ = ("level", "held", "nodes", "entries", "n")

    def __init__(self, level: int) -> None:
        self.level, self.held, self.nodes, self.entries, self.n = level, {}, None, 0, 0

    def add(self, keys: np.ndarray, counts: np.ndarray, burst: int) -> int:
        """Phrases, none twice. The number of those that are new."""
        before = self.entries
        self.n += int(counts.sum())
        if self.nodes is None:
            held, get = self.held, self.held.get
            for key, n in zip(keys.tolist(), counts.tolist()):
                held[key] = get(key, 0) + n
            self.entries = len(held)
            if self.entries > burst and self.level < len(DIGITS):
                self.held, self.nodes = {}, {}
                keys = np.fromiter(held, dtype=np.int64, count=len(held))
                self._deal(keys, np.fromiter(held.values(), dtype=np.int64, count=len(held)), burst)
        else:
            self.entries += self._deal(keys, counts, burst)
        return self.entries - before

    def _deal(self, keys: np.ndarray, counts: np.ndarray, burst: int) -> int:
        shift, most = DIGITS[self.level]
        digits = keys >> shift & most
        order = np.argsort(digits, kind="stable")
        digits, keys, counts = digits[order], keys[order], counts[order]
        starts = np.flatnonzero(np.diff(digits, prepend=-1))
        new = 0
        for digit, start, end in zip(digits[starts].tolist(), starts, [*starts[1:], len(keys)]):
            node = self.nodes.get(digit)
            if node is None:
                node = self.nodes[digit] = Node(self.level + 1)
            new += node.add(keys[start:end], counts[start:end], burst)
        return new

    def flat(self, keys: list[int], counts: list[int]) -> None:
        keys += self.held
        counts += self.held.values()
        for node in (self.nodes or {}).values():
            node.flat(keys, counts)


class HatTrie:
    """Counts of phrases of up to three words, of several languages, within a bound of entries."""

    def __init__(self, burst: int = BURST, entries: int = ENTRIES) -> None:
        self.burst, self.most = burst, entries
        self.roots: dict[str, Node] = {}
        self.entries = 0

    def add(self, lang: str, keys: np.ndarray, counts: np.ndarray) -> None:
        root = self.roots.get(lang)
        if root is None:
            root = self.roots[lang] = Node(0)
            root.nodes = {}
        self.entries += root.add(keys, counts, self.burst)

    def full(self) -> bool:
        return self.entries >= self.most

    def spilled(self, words: list[bytes], left: int | None = None) -> Iterator[pa.RecordBatch]:
        """Subtrees as sorted runs, those of the fewest occurrences an entry first, until so many (half) entries are left."""
        left = self.most // 2 if left is None else left
        below = [(n.n / n.entries, lang, digit) for lang, root in self.roots.items() for digit, n in root.nodes.items()]
        leaving: dict[str, list[Node]] = {}
        for _, lang, digit in sorted(below):
            if self.entries <= left:
                break
            root = self.roots[lang]
            node = root.nodes.pop(digit)
            leaving.setdefault(lang, []).append(node)
            root.entries -= node.entries
            self.entries -= node.entries
        yield from _runs(leaving, words)


def _runs(leaving: dict[str, list[Node]], words: list[bytes]) -> Iterator[pa.RecordBatch]:
    """Rows by language and words; ``words`` by id, from 1."""
    texts = pa.array(words, type=pa.binary())
    order = pc.sort_indices(texts)
    rank = np.zeros(len(words) + 1, dtype=np.int64)
    rank[order.to_numpy().astype(np.int64) + 1] = np.arange(1, len(words) + 1)
    names = pa.concat_arrays([pa.array([None], type=pa.string()), texts.take(order).cast(pa.string())])
    for lang in sorted(leaving):
        keys, counts = [], []
        for node in leaving[lang]:
            node.flat(keys, counts)
        ids = np.array(keys, dtype=np.int64)
        ranked = packed(rank[ids >> 2 * WIDTH], rank[ids >> WIDTH & MASK], rank[ids & MASK])
        order = np.argsort(ranked)
        ranked, n = ranked[order], np.array(counts, dtype=np.int64)[order]
        for cut in range(0, len(n), ROWS):
            part = ranked[cut : cut + ROWS]
            three = [names.take(pa.array(c)) for c in (part >> 2 * WIDTH, part >> WIDTH & MASK, part & MASK)]
            langs = pa.repeat(pa.scalar(lang, type=pa.string()), len(part))
            yield pa.RecordBatch.from_arrays([langs, *three, pa.array(n[cut : cut + ROWS])], schema=RUN)


def packed(first: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray:
    """A phrase's ids as one number; 0 is no word."""
    return first << 2 * WIDTH | second << WIDTH | third


def tokens(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in lower case, with ``END`` between pieces, some at a time."""
    plain, start = text.translate(PLAIN), 0
    while start < len(plain):
        edge = EDGE.search(plain, min(start + CHUNK, len(plain)))
        end = edge.start() if edge else len(plain)
        yield plain[start:end].replace(END, b" " + END + b" ").split()
        start = end
    yield [END]


def pair_places(left: np.ndarray, right: np.ndarray, lang: str, bits: int) -> np.ndarray:
    """The bit of pairs of words, given as 64-bit hashes, in a table of so many."""
    mixed = (left * np.uint64(0x9E3779B97F4A7C15)) ^ (right + np.uint64(xxhash.xxh64_intdigest(lang.encode())))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed ^ (mixed >> np.uint64(32))) % np.uint64(bits)


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 42)


class Ids(dict):
    """Words to numbers from 1 in the order in which they come, ``END`` to 0."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Words:
    """The words of a task by number, and their hashes, both as far as they are asked for."""

    def __init__(self) -> None:
        self.ids = Ids({END: 0})
        self.known: list[bytes] = []
        self.hashed = np.zeros(1, dtype=np.uint64)

    def all(self) -> list[bytes]:
        self.known += islice(self.ids, len(self.known) + 1, None)
        return self.known

    def hashes(self) -> np.ndarray:
        new = [word_hash(w) for w in self.all()[len(self.hashed) - 1 :]]
        self.hashed = np.concatenate((self.hashed, np.array(new, dtype=np.uint64)))
        return self.hashed


def counted(
    batches: Iterator[pa.RecordBatch], entries_of: Callable, burst: int, entries: int, vocabulary: int
) -> Iterator[pa.RecordBatch]:
    """The sorted runs of batches of (language, text).

    ``entries_of`` gives packed phrases, each once, and their counts, of the ids of a language's words,
    with 0 between pieces; those that begin among the first so many are asked for.
    """
    trie, words = HatTrie(burst, entries), Words()
    lines: dict[str, list[int]] = {}
    waiting = 0

    def taken(end: bool) -> Iterator[pa.RecordBatch]:
        """Count what begins in the lines; the last two words wait for those behind them, but at the end."""
        nonlocal words
        for lang, line in lines.items():
            ids = np.array([*line, 0, 0] if end else line, dtype=np.int64)
            if len(ids) > 2:
                trie.add(lang, *entries_of(lang, ids, words))
                lines[lang] = line[-2:]
        if trie.full():
            yield from trie.spilled(words.all())
        if end or len(words.ids) > vocabulary:
            yield from trie.spilled(words.all(), 0)
            old, words = words.all(), Words()
            for lang, line in lines.items():
                lines[lang] = [words.ids[old[i - 1]] if i else 0 for i in line]

    for batch in batches:
        texts = batch.column(1)
        texts = texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary())
        for lang, text in zip(batch.column(0).to_pylist(), texts):
            for part in tokens(text.as_py()):
                line = lines.setdefault(lang, [])
                line += map(words.ids.__getitem__, part)
                waiting += len(part)
                if waiting >= BLOCK:
                    yield from taken(False)
                    waiting = 0
    yield from taken(True)


def _texts(docs: DataFrame) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN))
    return docs.select(lang.alias("lang"), "text").where("text is not null")


def pairs_of(lang: str, ids: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Words by themselves, and pairs."""
    left, right = ids[:-2], ids[1:-1]
    none = np.zeros(1, dtype=np.int64)
    alone, pairs = packed(left, none, none)[left > 0], packed(left, right, none)[(left > 0) & (right > 0)]
    return np.unique(np.concatenate((alone, pairs)), return_counts=True)


def triples_of(bits: int, table: Callable[[], np.ndarray]) -> Callable:
    """Entries of three words whose pairs are both in a table of bits."""

    def entries_of(lang: str, ids: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
        held, frequent = words.hashes()[ids], table()
        place = pair_places(held[:-1], held[1:], lang, bits)
        known = (frequent[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
        known &= (ids[:-1] > 0) & (ids[1:] > 0)
        at = np.flatnonzero(known[:-1] & known[1:])
        return np.unique(packed(ids[at], ids[at + 1], ids[at + 2]), return_counts=True)

    return entries_of


def pair_runs(docs: DataFrame, burst: int = BURST, entries: int = ENTRIES, vocabulary: int = VOCABULARY) -> DataFrame:
    """lang, first, second, third (null), n: runs of pairs, and of words, with a null second."""
    return _texts(docs).mapInArrow(lambda batches: counted(batches, pairs_of, burst, entries, vocabulary), RUN_DDL)


def triple_runs(
    docs: DataFrame, frequent: np.ndarray, burst: int = BURST, entries: int = ENTRIES, vocabulary: int = VOCABULARY
) -> DataFrame:
    """Runs of three words in a row whose pairs are both in the table of bits."""
    table = docs.sparkSession.sparkContext.broadcast(frequent)
    entries_of = triples_of(len(frequent) * 64, lambda: table.value)
    return _texts(docs).mapInArrow(lambda batches: counted(batches, entries_of, burst, entries, vocabulary), RUN_DDL)


def bits_of(pairs: DataFrame, bits: int = BITS) -> np.ndarray:
    """The table of bits with those of all pairs (lang, first, second) set. Of fixed size, so it may come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, firsts, seconds = (np.array(c.to_pylist(), dtype=object) for c in batch.columns)
            for lang in set(langs):
                of = langs == lang
                left, right = (np.array([word_hash(w.encode()) for w in c[of]], dtype=np.uint64) for c in (firsts, seconds))
                place = np.unique(pair_places(left, right, lang, bits))
                words, starts = np.unique(place >> np.uint64(6), return_index=True)
                held = np.bitwise_or.reduceat(np.uint64(1) << (place & np.uint64(63)), starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words.astype(np.int64)), pa.array(held.view(np.int64))], names=["at", "held"]
                )

    parts = pairs.select("lang", "first", "second").mapInArrow(run, "at long, held long")
    found = parts.groupBy("at").agg(F.bit_or("held").alias("held")).toArrow()
    table = np.zeros(max(1, bits // 64), dtype=np.uint64)
    table[found["at"].to_numpy()] = found["held"].to_numpy().view(np.uint64)
    return table


def merged(runs: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, first, second, third, f: what occurs ``least`` times or more.

    Prefix partitions are by language and two words; within one the rows of a phrase are summed.
    """
    dealt = runs.repartition("lang", "first", "second")
    sums = dealt.groupBy("lang", "first", "second", "third").agg(F.sum("n").alias("f"))
    return sums.where(F.col("f") >= least)


def _salted(large: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on keys that one row of ``small`` and many of ``large`` have, split over tasks by phrase."""
    salt = F.pmod(F.xxhash64("first", "second", "third"), F.lit(SALTS)).cast("int")
    copies = small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return large.withColumn("salt", salt).join(copies, [*keys, "salt"]).drop("salt")


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)). Whole numbers of 38 digits: exact for counts below 10^15."""
    wide = [c.cast("decimal(15,0)") for c in (a, left, right)]
    above = wide[0] * wide[0] * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", above, wide[1] * wide[2]).cast("long")


def scored(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """lang, first, second, third, a, l, r, score of the candidates of two and of three words, at the cut with the lowest score.

    The counts of words are joined to the pairs once; three words get all their parts' counts from the
    pairs in them, which are candidates themselves.
    """
    words = counts.where("second is null").select("lang", F.col("first").alias("word"), F.col("f").alias("of_word"))
    pairs = counts.where("second is not null and third is null").select("lang", "first", "second", F.col("f").alias("a"))
    triples = counts.where("third is not null").select("lang", "first", "second", "third", F.col("f").alias("a"))

    def of(column: str, name: str) -> DataFrame:
        return words.select("lang", F.col("word").alias(column), F.col("of_word").alias(name))

    two = pairs.withColumn("third", F.lit(None).cast("string"))
    two = _salted(_salted(two, of("first", "l"), ["lang", "first"]), of("second", "r"), ["lang", "second"])
    columns = ("lang", "first", "second", "third", "a", "l", "r")
    two = materialised(two.select(*columns, score(F.col("a"), F.col("l"), F.col("r")).alias("score")), "phrases-two")

    before = two.select("lang", "first", "second", F.col("a").alias("l2"), F.col("l").alias("l1"))
    behind = two.select(
        "lang", F.col("first").alias("second"), F.col("second").alias("third"), F.col("a").alias("r1"), F.col("r").alias("r2")
    )
    three = triples.join(before, ["lang", "first", "second"]).join(behind, ["lang", "second", "third"])

    def cut(k: int) -> Column:
        left, right = F.col(f"l{k}"), F.col(f"r{k}")
        return F.struct(score(F.col("a"), left, right).alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r"))

    lowest = three.withColumn("cut", F.least(cut(1), cut(2)))
    return two, materialised(lowest.select(*columns[:5], "cut.l", "cut.r", "cut.score"), "phrases-three")


def unnested(pairs: DataFrame, triples: DataFrame, within: int = WITHIN) -> DataFrame:
    """Candidates but those with ``within`` percent or more of their occurrences inside one longer candidate."""
    held = triples.select("lang", "first", "second", "a").unionByName(
        triples.select("lang", F.col("second").alias("first"), F.col("third").alias("second"), "a")
    )
    most = held.groupBy("lang", "first", "second").agg(F.max("a").alias("inside"))
    joined = pairs.join(most, ["lang", "first", "second"], "left")
    alone = joined.where(F.col("inside").isNull() | (100 * F.col("inside") < within * F.col("a"))).drop("inside")
    return triples.unionByName(alone)


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    top: int = TOP,
    within: int = WITHIN,
    burst: int = BURST,
    entries: int = ENTRIES,
    vocabulary: int = VOCABULARY,
    bits: int = BITS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases of two and three words.

    A null language is ``und``, a null or empty text has no words. Repeated rows count as often as they occur. Other columns
    are not read. A language whose phrases are all rarer than ``least`` gives no row, an empty table none.
    """
    runs = materialised(pair_runs(docs, burst, entries, vocabulary), "phrases-runs")
    short = materialised(merged(runs, least), "phrases-pairs")
    frequent = bits_of(short.where("second is not null"), bits)
    long = materialised(merged(triple_runs(docs, frequent, burst, entries, vocabulary), least), "phrases-triples")
    found = unnested(*scored(short.unionByName(long)), within).withColumn("phrase", F.concat_ws(" ", "first", "second", "third"))
    # first within parts of a language, so that its last ranking sees few rows, however many candidates it has
    order = (F.desc("score"), F.desc("a"), F.col("phrase"))
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")
    of_part = Window.partitionBy("lang", "salt").orderBy(*order)
    best = found.withColumn("salt", salt).withColumn("rank", F.row_number().over(of_part)).where(F.col("rank") <= top)
    of_lang = Window.partitionBy("lang").orderBy(*order)
    first = best.withColumn("rank", F.row_number().over(of_lang)).where(F.col("rank") <= top)
    totals = runs.where("second is null").groupBy("lang").agg(F.sum("n").alias("n"))
    return first.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
