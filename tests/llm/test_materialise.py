"""Token shards: permutation, exact round trip, resumption."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
import tiktoken

from citypulse.llm import materialise as M

from .conftest import DOCUMENTS, sentence


def plain(text: str | None) -> list[int]:
    return M.encoders(M.RANKS)[0].encode_ordinary(text or "")


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 1_000, 4_097, 70_000])
def test_permutation_is_one_and_turns_back(n):
    slots = M.permuted(np.arange(n), n)
    assert sorted(slots.tolist()) == list(range(n))
    assert (M.permuted(slots, n, inverse=True) == np.arange(n)).all()
    if n > 100:
        assert (slots != M.permuted(np.arange(n), n, key=1)).mean() > 0.9
        assert abs(np.corrcoef(np.arange(n), slots)[0, 1]) < 0.15


def slow_slot(x: int, n: int, key: int = M.KEY) -> int:
    """One slot by whole numbers alone: six rounds over two equal halves, again until the result is below n."""
    whole = (1 << 64) - 1

    def mix(v: int) -> int:
        v = (v ^ v >> 30) * 0xBF58476D1CE4E5B9 & whole
        v = (v ^ v >> 27) * 0x94D049BB133111EB & whole
        return v ^ v >> 31

    bits = 1
    while n > 1 << 2 * bits:
        bits += 1
    while True:
        left, right = divmod(x, 1 << bits)
        for i in range(1, 7):
            step = mix(key + i * 0x9E3779B97F4A7C15 & whole)
            left, right = right, left ^ mix(right + step & whole) % (1 << bits)
        x = (left << bits) + right
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 4, 5, 16, 17, 1_000, 4_096, 4_097])
@pytest.mark.parametrize("key", [M.KEY, 0, (1 << 64) - 1])
def test_permutation_equals_the_one_by_whole_numbers(n, key):
    assert M.permuted(np.arange(n), n, key=key).tolist() == [slow_slot(i, n, key) for i in range(n)]


@pytest.mark.parametrize("text", [None, "", "x", "a  b", "a \n\n b ", " lead", "it's <|endoftext|> 12é漢", "a  b"])
def test_tokens(text):
    assert M.tokens(text).tolist() == [*plain(text), M.END]


def test_long_texts_are_cut_without_a_trace(monkeypatch):
    text = sentence(1, 3_000).replace(" harbour", "\nharbour").replace("quiet", "it's  quiet")
    whole = M.tokens(text).tolist()
    monkeypatch.setattr(M, "CHARS_AT_ONCE", 50)
    assert M.tokens(text).tolist() == whole == [*plain(text), M.END]


def stream(table, length: int) -> list[int]:
    """The tokens in their first order, read back through the permutation."""
    rows = sorted(table.collect(), key=lambda r: r.shard)
    data = b"".join(r.payload for r in rows)
    for r in rows:
        assert r.stride == 2 * length and len(r.payload) == r.n_sequences * r.stride
        assert r.sha256 == hashlib.sha256(r.payload).hexdigest()
    n = len(data) // (2 * length)
    slots = np.frombuffer(data, dtype="<u2").reshape(n, length)
    return slots[[slow_slot(i, n) for i in range(n)]].reshape(-1).tolist()


def split(tokens: list[int], texts: int) -> list[list[int]]:
    out, now = [], []
    for t in tokens:
        if t == M.END:
            out.append(now)
            now = []
            if len(out) == texts:
                break
        else:
            now.append(t)
    return out


def test_round_trip(spark, odd_docs, odd_rows):
    table = M.shards(odd_docs, length=64, per_shard=16)
    tokens = stream(table, 64)
    got = split(tokens, len(odd_rows))
    assert sorted(got) == sorted(plain(r[1]) for r in odd_rows)
    used = sum(len(g) + 1 for g in got)
    assert len(tokens) - used < 64 and set(tokens[used:]) <= {M.END}


def test_shards_do_not_depend_on_the_tables_parts(spark):
    rows = [(i, sentence(i, i % 50), "en", "s", 1) for i in range(300)]
    one = M.shards(spark.createDataFrame(rows, DOCUMENTS).coalesce(1), length=32, per_shard=8)
    many = M.shards(spark.createDataFrame(rows[::-1], DOCUMENTS).repartition(9), length=32, per_shard=8)
    a, b = (sorted((r.shard, r.first_slot, r.sha256) for r in t.collect()) for t in (one, many))
    assert a == b and len(a) > 10
    other = M.shards(spark.createDataFrame(rows, DOCUMENTS), length=32, per_shard=8, key=7)
    assert sorted((r.shard, r.first_slot, r.sha256) for r in other.collect()) != a


def test_reading_goes_on_from_any_slot(spark):
    rows = [(i, sentence(i, 40), "en", "s", 1) for i in range(100)]
    table = M.shards(spark.createDataFrame(rows, DOCUMENTS), length=32, per_shard=8)
    every = [bytes(r.tokens) for r in M.training_order(table).orderBy("slot").collect()]
    assert b"".join(every) == b"".join(r.payload for r in table.orderBy("shard").collect())
    for start in (0, 7, 8, 21, len(every) - 1, len(every)):
        rest = M.training_order(table, start).orderBy("slot").collect()
        assert [bytes(r.tokens) for r in rest] == every[start:]
        assert [r.slot for r in rest] == list(range(start, len(every)))


def test_files(spark, tmp_path):
    rows = [(i, sentence(i, 40), "en", "s", 1) for i in range(50)]
    table = M.shards(spark.createDataFrame(rows, DOCUMENTS), length=32, per_shard=8)
    for _ in range(2):
        for r in M.write_files(table, f"file://{tmp_path}/out").collect():
            with open(r.path, "rb") as f:
                assert hashlib.sha256(f.read()).hexdigest() == r.sha256
    assert len(list((tmp_path / "out").iterdir())) == table.count()


def test_empty_table(spark, no_docs):
    assert M.shards(no_docs).collect() == []


def test_vocabulary_fits_two_bytes():
    assert M.END < 1 << 16
    assert isinstance(M.encoders(M.RANKS)[0], tiktoken.Encoding)
