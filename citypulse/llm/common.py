"""Helpers that several operators share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citypulse.session import fresh_path, remove

DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")
ROWS_PER_BATCH = 2_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialised(df: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read again.

    It cuts the lineage and keeps what is read more than once from being computed more than once;
    a lost executor loses none of it.
    """
    return _written(df, fresh_path(df.sparkSession, label))


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Rounds:
    """The state of a loop, as a table in the shared folder that each round replaces by a new one."""

    def __init__(self, first: DataFrame, label: str) -> None:
        self.path, self.count = fresh_path(first.sparkSession, label), 0
        self.state = _written(first, f"{self.path}/0")

    def replace(self, state: DataFrame) -> DataFrame:
        old = f"{self.path}/{self.count}"
        self.count += 1
        self.state = _written(state, f"{self.path}/{self.count}")
        remove(state.sparkSession, old)
        return self.state


def map_rows(
    df: DataFrame, function: Callable[[Iterable[tuple]], Iterator[tuple]], schema: str | T.StructType,
    binary: tuple[str, ...] = (),
) -> DataFrame:
    """``function`` over the rows of each partition, in Arrow batches, as an iterator of tuples.

    It is given an iterator over tuples, in the order of the columns, and yields tuples of the
    schema. Strings named in ``binary`` arrive as their UTF-8 bytes. Rows are sent on in small
    batches, so that memory does not follow the size of a partition.
    """
    out = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    arrow = pa.schema([pa.field(f.name, _arrow(f.dataType)) for f in out.fields])

    def tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_PER_BATCH):
                part = batch.slice(start, ROWS_PER_BATCH)
                columns = [_bytes(c) if n in binary else c for n, c in zip(part.schema.names, part.columns)]
                yield from zip(*(c.to_pylist() for c in columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for row in function(tuples(batches)):
            rows.append(row)
            size += sum(len(v) for v in row if isinstance(v, (str, bytes, list)))
            if len(rows) >= ROWS_PER_BATCH or size >= 8_000_000:
                yield _batch(rows, arrow)
                rows, size = [], 0
        if rows:
            yield _batch(rows, arrow)

    return df.mapInArrow(run, out)


def judged(
    df: DataFrame, column: str, make: Callable[[], Callable[[bytes | None], object]], added: T.StructType | None = None
) -> DataFrame:
    """The rows of ``df``, judged by the text in ``column``; other columns pass as they are.

    ``column`` is one of the columns that stay. ``make`` gives, once a task, a function from a text's UTF-8 bytes (or null). With ``added`` it
    returns the values of further columns, which replace others of their names; without, whether the
    row stays.
    """
    kept = [c for c in df.columns if added is None or c not in added.names]
    arrow = None if added is None else pa.schema([pa.field(f.name, _arrow(f.dataType)) for f in added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = make()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_PER_BATCH):
                part = batch.slice(start, ROWS_PER_BATCH)
                found = [judge(text) for text in _bytes(part.column(part.schema.get_field_index(column))).to_pylist()]
                if arrow is None:
                    yield part.filter(pa.array(found, type=pa.bool_()))
                else:
                    more = _batch(found, arrow)
                    names = [*part.schema.names, *more.schema.names]
                    yield pa.RecordBatch.from_arrays([*part.columns, *more.columns], names)

    schema = T.StructType([*df.select(*kept).schema.fields, *(added.fields if added else [])])
    return df.select(*kept).mapInArrow(run, schema)


def _bytes(texts: pa.Array) -> pa.Array:
    """The UTF-8 bytes of strings, without a copy."""
    return texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary())


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(values, type=field.type) for values, field in zip(columns, schema)], schema=schema
    )


def _arrow(kind: T.DataType) -> pa.DataType:
    simple = {
        T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64(), T.StringType: pa.string(),
        T.BinaryType: pa.binary(), T.BooleanType: pa.bool_(),
    }
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([pa.field(f.name, _arrow(f.dataType)) for f in kind.fields])
    return simple[type(kind)]


SPACE = re.compile(rb"[\x20\x09-\x0D]")


def word_blocks(text: bytes, size: int = 1 << 21) -> Iterator[list[bytes]]:
    """The words of a text (runs of anything but space and 0x09-0x0D), some megabytes at a time."""
    start = 0
    while start < len(text):
        cut = SPACE.search(text, min(start + size, len(text)))
        end = cut.start() if cut else len(text)
        if words := text[start:end].split():
            yield words
        start = end


def salted(key: str, salts: int) -> F.Column:
    """A number below ``salts`` from the value of a column, the same in every run."""
    return F.pmod(F.xxhash64(F.col(key), F.lit("salt")), F.lit(salts)).cast("int")


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)
