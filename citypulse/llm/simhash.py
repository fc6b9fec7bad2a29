"""Near-duplicate documents by SimHash, linked through covering locality-sensitive hashing.

A fingerprint has 64 bits; documents link when theirs differ in at most ``radius`` bits. For the
radius r every bit position gets one of the vectors of r + 1 bits other than zero. Each of the
2^(r+1) - 1 such vectors v then gives a mask: the positions whose vector has an odd overlap with
v. At most r differing positions span at most r dimensions, so some v is orthogonal to all of
them, and its mask shows no difference: every pair within the radius agrees under some mask. No
pair is left to chance.

Equal fingerprints fall together first. A table entry (mask, masked bits) that many different
fingerprints share is not compared all against all: the bits outside the mask are covered anew by
masks of their own, which leaves half as many free bits each time, down to ``LEAST_FREE`` bits, with
which an entry cannot hold more than 2^LEAST_FREE fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citypulse.llm.common import Rounds, is_empty, map_rows, materialised, word_blocks

BITS = 64
SHINGLE = 3
RADIUS = 3
SEED = 42
#: A table entry with more fingerprints than this is split by further masks.
CROWDED = 64
LEAST_FREE = 8


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a whole text, as an unsigned number.

    A-Z become a-z; words are runs of anything but space and 0x09-0x0D. Fewer words than a
    shingle make one shingle; no words (and null) give 0. Repeated shingles count each time.
    """
    hashed = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, dtype=np.int64)
    total = 0
    words: list[bytes] = []
    for block in word_blocks((text or b"").lower()):
        words = words[-(shingle - 1) :] + block if shingle > 1 else block
        hashes = np.array(
            [hashed(b" ".join(s), SEED) for s in zip(*(words[i:] for i in range(shingle)))], dtype=">u8"
        )
        total += len(hashes)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    if not total:
        return hashed(b" ".join(words), SEED) if words else 0
    bits = (2 * ones > total).astype(np.uint8)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed number) of every row."""

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            fp = fingerprint(text, shingle)
            yield doc_id, fp - (1 << 64) if fp >> 63 else fp

    return map_rows(docs.select("doc_id", "text"), run, "doc_id long, fp long", binary=("text",))


def covering_masks(free: list[int], radius: int) -> list[int]:
    """Masks over the bit positions in ``free``; any ``radius`` of those escape at least one mask.

    The vectors go round over the positions, so that masks are of nearly equal size.
    """
    vectors = (1 << (radius + 1)) - 1
    given = {bit: 1 + place % vectors for place, bit in enumerate(free)}
    return [
        sum(1 << bit for bit, vector in given.items() if (vector & v).bit_count() % 2)
        for v in range(1, vectors + 1)
    ]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _literal(value: int) -> Column:
    return F.lit(_signed(value)).cast("long")


def links(fps: DataFrame, radius: int = RADIUS, crowded: int = CROWDED) -> DataFrame:
    """a, b (a < b): every pair of different fingerprints at ``radius`` or fewer differing bits.

    ``fps`` holds each fingerprint once, in the column fp.
    """
    entries = _entries(fps.select("fp", F.lit(0).cast("long").alias("fixed")), radius)
    found = None
    free = BITS
    while True:
        sizes = entries.groupBy("fixed", "bits").agg(F.count("*").alias("n"))
        shared = sizes.where("n > 1")
        free -= min(m.bit_count() for m in covering_masks(list(range(free)), radius))
        last = free <= LEAST_FREE
        small = shared if last else shared.where(F.col("n") <= crowded)
        kept = entries.join(small.select("fixed", "bits"), ["fixed", "bits"], "left_semi")
        pairs = _within(kept, radius)
        found = pairs if found is None else found.unionByName(pairs)
        if last:
            break
        big = materialised(
            entries.join(shared.where(F.col("n") > crowded).select("fixed", "bits"), ["fixed", "bits"], "left_semi"),
            "simhash-crowded",
        )
        if is_empty(big):
            break
        entries = _entries(big, radius)
    return found.distinct()


def _entries(fps: DataFrame, radius: int) -> DataFrame:
    """fixed, bits, fp: each fingerprint under the masks over the bits that ``fixed`` leaves free.

    Entries of one ``fixed`` value come from different buckets, told apart by their bits.
    """
    if "bits" not in fps.columns:
        masks = covering_masks(list(range(BITS)), radius)
        each = F.explode(F.array(*(_literal(m) for m in masks))).alias("fixed")
        return fps.select("fp", each).select("fixed", F.col("fp").bitwiseAND(F.col("fixed")).alias("bits"), "fp")

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        known: dict[int, list[int]] = {}
        for fixed, fp in rows:
            if fixed not in known:
                taken = fixed & ((1 << BITS) - 1)
                rest = [bit for bit in range(BITS) if not taken >> bit & 1]
                known[fixed] = [_signed(taken | m) for m in covering_masks(rest, radius)]
            for mask in known[fixed]:
                yield mask, mask & fp, fp

    return map_rows(fps.select("fixed", "fp"), run, "fixed long, bits long, fp long").distinct()


def _within(entries: DataFrame, radius: int) -> DataFrame:
    a = entries.select("fixed", "bits", F.col("fp").alias("a"))
    b = entries.select("fixed", "bits", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    return a.join(b, ["fixed", "bits"]).where((F.col("a") < F.col("b")) & near).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node reachable, for every node of the edges (a, b).

    Rounds of linking each node's larger neighbours, then its smaller ones, to the smallest it
    knows (large star, small star); the number of rounds grows with the logarithm of the longest
    chain. Each round is written to the shared folder; the driver sees two sums a round.
    """
    rounds = Rounds(edges.select("a", "b"), "simhash-links")
    edges, before = rounds.state, None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.join(least, "a").where(F.col("b") > F.col("a"))
            .select(F.col("m").alias("a"), "b").where("a < b").distinct()
        )
        below = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (
            large.join(below, "b")
            .select(F.explode(F.array(F.struct(F.col("m").alias("a"), "b"), F.struct(F.col("m").alias("a"), F.col("a").alias("b")))).alias("e"))
            .select("e.a", "e.b").where("a < b").distinct()
        )
        edges = rounds.replace(small)
        now = edges.agg(
            F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("a", "b")).alias("x"),
        ).first()
        if now == before:
            break
        before = now
    return (
        edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
        .unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root")))
        .distinct()
    )


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 lower-case hex digits), component_id (smallest doc_id reachable).

    One row for each row of ``docs``; further columns are ignored. A null text counts as empty;
    a null doc_id takes part, but is never a component's id unless the whole component has none.
    Repeated rows are in the same component. An empty table gives no rows.
    """
    marked = materialised(fingerprints(docs, shingle), "simhash-fingerprints")
    classes = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    classes = materialised(classes, "simhash-classes")
    parts = components(links(classes, radius))
    linked = classes.join(parts, classes.fp == parts.node)
    roots = linked.groupBy("root").agg(F.min("least").alias("component"))
    of = linked.join(roots, "root").select("fp", "component")
    named = materialised(
        classes.join(of, "fp", "left").select("fp", F.coalesce("component", "least").alias("component_id")),
        "simhash-components",
    )
    # both sides come from files, so that a fingerprint with a third of the rows is split over tasks
    return marked.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` whose doc_id is their component's, with all columns.

    Rows without a doc_id cannot be told apart and stay. Of rows with the same doc_id all stay or go.
    """
    groups = near_duplicates(docs, shingle, radius)
    gone = groups.where("doc_id > component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
