"""Arrow functions that hold a slice of text at a time, however large Spark's batches are."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
from pyspark.sql.types import DataType, StringType, StructType

#: Bytes of text that one step of an Arrow function holds, and the most rows. A batch of Spark has up to 10,000 rows and 64 MB.
SLICE_BYTES, SLICE_ROWS = 1 << 19, 4096


def bounds(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of rows of SLICE_BYTES and SLICE_ROWS at most, or of one row."""
    ends, start = np.cumsum(sizes), 0
    while start < len(ends):
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, min(int(np.searchsorted(ends, before + SLICE_BYTES, side="right")), start + SLICE_ROWS))
        yield start, stop
        start = stop


def sizes_of(values: pa.Array) -> np.ndarray:
    """Bytes of texts or binaries; a null has none."""
    return pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def over_slices(f: Callable[[list[str | None]], pa.Array], kind: DataType) -> Callable[[Column], Column]:
    """f, which gives a value for each text of a slice, as an Arrow function of a text column."""

    @F.arrow_udf(kind)
    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for values in arrays:
            for start, stop in bounds(sizes_of(values)):
                yield f(values.slice(start, stop - start).to_pylist())

    return run


def each(f: Callable[[str], object], kind: DataType | None = None) -> Callable[[Column], Column]:
    """f of one text as an Arrow function of a text column; nulls stay."""
    kind = kind or StringType()
    to = to_arrow_type(kind)
    return over_slices(lambda texts: pa.array([None if t is None else f(t) for t in texts], to), kind)


def row_size(row: tuple) -> int:
    """About as many bytes as a row takes in Arrow."""
    return 16 * len(row) + sum(3 * len(v) for v in row if isinstance(v, (str, bytes)))


def arrow_rows(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as batches of SLICE_BYTES and SLICE_ROWS at most, or one row."""
    held, n = [], 0
    for row in rows:
        more = row_size(row)
        if held and (n + more > SLICE_BYTES or len(held) == SLICE_ROWS):
            yield _batch(held, schema)
            held, n = [], 0
        held.append(row)
        n += more
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    plain = lambda c, kind: [None if v is None else list(v.items()) for v in c] if pa.types.is_map(kind) else c
    return pa.RecordBatch.from_arrays([pa.array(plain(c, f.type), f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def rows_of(df: DataFrame, names: list[str], schema: str, one: Callable[..., Iterator[tuple]]) -> DataFrame:
    """The rows that one(*values of names) gives for every row of df. The last name holds the text or bytes that are worked on."""
    kind = StructType.fromDDL(schema)
    to = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for start, stop in bounds(sizes_of(batch.column(batch.num_columns - 1))):
                    for values in zip(*(c.slice(start, stop - start).to_pylist() for c in batch.columns), strict=True):
                        yield from one(*values)

        yield from arrow_rows(rows(), to)

    return df.select(*names).mapInArrow(run, kind)
