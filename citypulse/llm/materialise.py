"""Token sequences in training order, in binary shards of fixed stride.

The documents' tokens, each document ended by ``end``, form one stream in an order that depends on
the rows alone. It is cut into sequences of ``length`` tokens, the last one filled up. A keyed
Feistel network over the least even number of bits that holds the number of sequences, walked along
its cycle until it lands below that number, permutes the sequences: the result is each one's slot
in the training order. A shard holds ``per_shard`` neighbouring slots, so the tokens of any slot
are found by arithmetic, and reading goes on from any slot after a stop.

Documents are tokenised once and stored. Their places in the stream are found from the token counts
alone; the tokens are shuffled twice, to meet their places and to their shard.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow.fs
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citypulse.llm.common import map_rows, materialised

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the vocabulary's texts are cut before merging; the second form differs at runs of white space alone.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PATTERN_NO_RUNS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
RUN = re.compile(r"\s\s")
END = 50256
LENGTH = 1024
PER_SHARD = 1024
KEY = 20240501
ROUNDS = 6
#: Into so many groups the rows are dealt by a hash, to number them without one task for all.
GROUPS = 4096
CHARS_AT_ONCE = 1 << 21
ROWS_AT_ONCE = 500


def encoders(ranks: str) -> tuple[tiktoken.Encoding, tiktoken.Encoding]:
    """The tokeniser, and a faster form of it for texts without runs of white space.

    Functions sent to tasks have globals of their own for every task, so what a worker process
    should build only once is kept with the module it comes from.
    """
    known = vars(tiktoken).setdefault("encoders_by_ranks", {})
    if ranks not in known:
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        known[ranks] = tuple(
            tiktoken.Encoding(f"bpe{i}", pat_str=pattern, mergeable_ranks=merges, special_tokens={})
            for i, pattern in enumerate((PATTERN, PATTERN_NO_RUNS))
        )
    return known[ranks]


def tokens(text: str | None, ranks: str = RANKS) -> np.ndarray:
    """The whole text's token ids and the end mark, as uint16. Null and empty texts give the end mark alone."""
    exact, fast = encoders(ranks)
    parts = []
    start = 0
    while text and start < len(text):
        end = start + CHARS_AT_ONCE
        if end < len(text):  # cut before a space that follows no other white space
            cut = re.compile(r"(?<=\S) (?=\S)").search(text, end)
            end = cut.start() if cut else len(text)
        part = text[start:end] if start or end < len(text) else text
        encoder = exact if RUN.search(part) else fast
        parts.append(encoder.encode_to_numpy(part, disallowed_special=()).astype("<u2"))
        start = end
    return np.concatenate((*parts, np.array([END], dtype="<u2")))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _round_keys(key: int) -> np.ndarray:
    steps = np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return _mixed(np.uint64(key % (1 << 64)) + steps)


def permuted(index: np.ndarray, n: int, key: int = KEY, inverse: bool = False) -> np.ndarray:
    """The slots of sequences 0 .. n - 1, or with ``inverse`` the sequences of slots."""
    half = np.uint64(max(1, ((n - 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    keys = _round_keys(key)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> half, x & mask
        for k in keys[::-1] if inverse else keys:
            if inverse:
                left, right = right ^ (_mixed(left + k) & mask), left
            else:
                left, right = right, left ^ (_mixed(right + k) & mask)
        return left << half | right

    x = once(np.asarray(index, dtype=np.uint64))
    while (outside := x >= np.uint64(n)).any():
        x[outside] = once(x[outside])
    return x.astype(np.int64)


def _tokenised(docs: DataFrame, ranks: str) -> DataFrame:
    """part, row, doc_id, tie, n, tokens: stored, so that every text is tokenised once.

    ``part`` and ``row`` only tell the rows of this table apart.
    """

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        for row, (part, doc_id, tie, text) in enumerate(rows):
            found = tokens(text, ranks)
            yield part, row, doc_id, tie, len(found), found.tobytes()

    source = docs.select(F.spark_partition_id().alias("part"), "doc_id", F.xxhash64("text").alias("tie"), "text")
    found = map_rows(source, run, "part int, row int, doc_id long, tie long, n int, tokens binary")
    return materialised(found, "tokens")


def _places(stored: DataFrame) -> DataFrame:
    """part, row, offset: where each row's tokens begin in the stream.

    The stream goes by group (a hash), doc_id and text. Rows that agree in both are interchangeable.
    """
    group = F.pmod(F.xxhash64("doc_id", "tie"), F.lit(GROUPS)).cast("int")
    counts = stored.select("part", "row", "doc_id", "tie", "n", group.alias("bucket"))
    inside = Window.partitionBy("bucket").orderBy("doc_id", "tie", "part", "row")
    running = F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    totals = counts.groupBy("bucket").agg(F.sum("n").alias("total"))
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # GROUPS rows at most
    bases = totals.select(
        F.col("bucket").alias("of"), F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base")
    )
    placed = counts.select("part", "row", "bucket", F.coalesce(running, F.lit(0)).alias("inside"))
    # broadcast: GROUPS rows of two numbers
    return placed.join(F.broadcast(bases), placed.bucket == F.col("of")).select(
        "part", "row", (F.col("base") + F.col("inside")).alias("offset")
    )


def shards(
    docs: DataFrame, ranks: str = RANKS, length: int = LENGTH, per_shard: int = PER_SHARD, key: int = KEY
) -> DataFrame:
    """shard, first_slot, n_sequences, stride (bytes of a sequence), payload, sha256 (of the payload).

    The payload holds the sequences of the shard's slots one after the other, each of ``length``
    token ids in two bytes, low byte first. An empty table gives no shards. The same rows, key and
    lengths give the same shards, however the table is split into files and tasks.
    """
    stored = _tokenised(docs, ranks)
    places = materialised(_places(stored), "token-places")
    total = stored.agg(F.sum(F.col("n").cast("long"))).first()[0] or 0
    n = -(-total // length)
    n_shards = -(-n // per_shard)
    tasks = max(1, min(n_shards, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))

    def cut(rows: Iterable[tuple]) -> Iterator[tuple]:
        rows = iter(rows)
        while group := list(islice(rows, ROWS_AT_ONCE)):
            begin = np.array([offset for offset, _ in group])
            end = begin + np.array([len(found) // 2 for _, found in group])
            first, last = begin // length, (end - 1) // length
            # one entry for each piece: its row, its sequence, and the part of the stream that it holds
            row = np.repeat(np.arange(len(group)), last - first + 1)
            sequence = first[row] + np.arange(len(row)) - np.searchsorted(row, row)
            start = np.maximum(begin[row], sequence * length)
            stop = np.minimum(end[row], (sequence + 1) * length)
            slot = permuted(sequence, n, key)
            at = slot % per_shard * length + start - sequence * length
            inside = (2 * (start - begin[row]), 2 * (stop - begin[row]))
            for r, shard, place, i, j in zip(*(a.tolist() for a in (row, slot // per_shard, at, *inside))):
                yield shard, place, group[r][1][i:j]

    def fill(rows: Iterable[tuple]) -> Iterator[tuple]:
        current, payload = None, bytearray()
        for shard, at, piece in rows:
            if shard != current:
                if current is not None:
                    yield packed(current, payload)
                here = min(per_shard, n - shard * per_shard)
                current, payload = shard, bytearray(np.full(here * length, END, dtype="<u2").tobytes())
            payload[2 * at : 2 * at + len(piece)] = piece
        if current is not None:
            yield packed(current, payload)

    def packed(shard: int, payload: bytearray) -> tuple:
        data = bytes(payload)
        return shard, shard * per_shard, len(data) // (2 * length), 2 * length, data, hashlib.sha256(data).hexdigest()

    joined = stored.select("part", "row", "tokens").join(places.hint("shuffle_hash"), ["part", "row"])
    pieces = map_rows(joined.select("offset", "tokens"), cut, "shard long, at long, piece binary")
    ranged = pieces.repartitionById(tasks, (F.col("shard") * tasks / F.lit(max(1, n_shards))).cast("int"))
    return map_rows(
        ranged.sortWithinPartitions("shard"), fill,
        "shard long, first_slot long, n_sequences int, stride int, payload binary, sha256 string",
    )


def training_order(table: DataFrame, start: int = 0) -> DataFrame:
    """slot, tokens (binary): the sequences from slot ``start`` on; earlier shards are not read."""
    width, first = F.col("stride"), F.col("first_slot")
    wanted = table.where(first + F.col("n_sequences") > start).withColumn(
        "i", F.explode(F.sequence(F.greatest(F.lit(start) - first, F.lit(0)).cast("int"), F.col("n_sequences") - 1))
    )
    return wanted.select(
        (first + F.col("i")).alias("slot"), F.substring("payload", F.col("i") * width + 1, width).alias("tokens")
    )


def write_files(table: DataFrame, folder: str) -> DataFrame:
    """shard, path, sha256: each payload written as one file below ``folder`` (a URI that pyarrow knows).

    A file appears under its name when it is whole, and a task that runs again replaces it by the same bytes.
    """

    def run(rows: Iterable[tuple]) -> Iterator[tuple]:
        store, root = pyarrow.fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        for shard, payload, digest in rows:
            path = f"{root}/shard-{shard:09d}.bin"
            part = f"{path}.{uuid.uuid4().hex}"
            with store.open_output_stream(part) as out:
                out.write(payload)
            store.move(part, path)
            yield shard, path, digest

    return map_rows(table.select("shard", "payload", "sha256"), run, "shard long, path string, sha256 string")
