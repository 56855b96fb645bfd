"""Helpers shared by the training-data operators: words, hashes, batches, shared scratch tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the query contracts, for JVM regular expressions. bytes.split() splits at the same characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that one step of a Python operator holds, and the most rows.
SLICE_BYTES = 4 << 20
SLICE_ROWS = 4096
MASK63 = np.int64((1 << 63) - 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo. A null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that the session names in spark.checkpoint.dir; where it is unset on one machine, as in tests, one is made."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    made = spark.sparkContext._jsc.sc().getCheckpointDir()
    if made.isDefined():
        return made.get()
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
    root = tempfile.mkdtemp(prefix="palmleaf-checkpoint-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it again, which cuts its lineage; it goes when the driver ends."""
    spark = df.sparkSession
    path = f"{scratch_root(spark).rstrip('/')}/palmleaf/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession, units: float, per_task: float) -> int:
    """Partitions for so many units: grows with the data, and is the session's number at least."""
    return int(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-units // per_task), 1))


def slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """The batches cut so that each piece has SLICE_BYTES of text or one row, and that text as bytes."""
    for batch in batches:
        raw = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary())
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(raw), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        ends, start = np.cumsum(sizes), 0
        while start < len(sizes):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, min(int(np.searchsorted(ends, before + SLICE_BYTES, side="right")), start + SLICE_ROWS))
            yield batch.slice(start, stop - start), raw.slice(start, stop - start).to_pylist()
            start = stop


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser over uint64 arrays."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


SEPARATOR = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
#: A random number for each byte, the same for letters of both cases and 0 for separators; and an odd base.
BYTE = np.random.default_rng(12).integers(1, 1 << 63, 256, np.uint64)
BYTE[ord("A") : ord("Z") + 1] = BYTE[ord("a") : ord("z") + 1]
BYTE[SEPARATOR] = 0
BASE = 0x9E3779B97F4A7C15
PIECE = 1 << 20
_powers: dict[bool, np.ndarray] = {}


def _powers_of_base(n: int, inverse: bool) -> np.ndarray:
    """The first powers of BASE or of its inverse, modulo 2 ** 64; kept for pieces of the usual size."""
    held = _powers.get(inverse)
    if held is None or len(held) < n:
        held = np.full(n, pow(BASE, -1 if inverse else 1, 1 << 64), np.uint64)
        held[:1] = 1
        held = np.multiply.accumulate(held)
        if n <= PIECE or inverse not in _powers:
            _powers[inverse] = held
    return held[:n]


def _piece_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of bytes that end with a separator: polynomials of BASE by one prefix sum."""
    inside = ~SEPARATOR[raw]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edges = np.r_[0, edges]
    starts, ends = edges[::2], edges[1::2]
    sums = np.cumsum(BYTE[raw] * _powers_of_base(len(raw), False))
    before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
    return starts, mix((sums[ends - 1] - before) * _powers_of_base(len(raw), True)[starts]) >> np.uint64(2)


def hashed_words(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """62-bit hashes of the lower-cased (A-Z) words of all texts, one after the other, and the number of words of each text.

    Equal to split(), text by text, but without an object for each word; texts are worked through in pieces cut at separators.
    """
    sizes = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts))
    raw = np.frombuffer(b" ".join([*(t or b"" for t in texts), b""]), np.uint8)
    starts, hashes, at = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
    while at < len(raw):
        stop = min(at + PIECE, len(raw))
        if stop < len(raw) and not SEPARATOR[raw[stop - 1]]:
            back = np.flatnonzero(SEPARATOR[raw[max(at, stop - 4096) : stop]])
            if len(back):
                stop = max(at, stop - 4096) + int(back[-1]) + 1
            while not SEPARATOR[raw[stop - 1]]:  # a word longer than what was looked at
                ahead = np.flatnonzero(SEPARATOR[raw[stop : stop + PIECE]])
                stop = stop + int(ahead[0]) + 1 if len(ahead) else min(stop + PIECE, len(raw))
        some, made = _piece_hashes(raw[at:stop])
        starts.append(some + at)
        hashes.append(made)
        at = stop
    bounds = np.searchsorted(np.concatenate(starts), np.r_[0, np.cumsum(sizes)])
    return np.concatenate(hashes).astype(np.int64), np.diff(bounds)


def groups_of(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, pa.Table]]:
    """Runs of equal keys in batches that are sorted by key; only one run is held."""
    held: list[pa.RecordBatch] = []
    last: object = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if held and keys[a] != last:
                yield last, pa.Table.from_batches(held)
                held = []
            last = keys[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield last, pa.Table.from_batches(held)
