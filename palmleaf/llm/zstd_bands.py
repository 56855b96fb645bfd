"""Quality rules from compression: zstandard ratios over the whole document and over fixed chunks, within bands by length.

Repetitive text compresses too well, random or encoded text hardly at all. A ratio is compressed size / size in bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .common import slices

LEVEL = 3
CHUNK = 2048
#: A last chunk under this many bytes is compressed with the one before it.
LEAST_CHUNK = 512
#: (documents under so many bytes, lowest ratio, highest ratio). Very short texts carry the frame's fixed cost. From 256 bytes
#: on the highest ratios are between good prose of sf0.1 and wrapped base64; from 4 KB on they are below hex too, which shorter
#: prose overlaps.
BANDS = ((64, 0.0, 9.0), (128, 0.45, 1.5), (256, 0.36, 1.1), (512, 0.33, 0.82), (1024, 0.31, 0.74), (4096, 0.29, 0.62), (16384, 0.27, 0.50), (float("inf"), 0.24, 0.48))
#: The same for each chunk of documents with more than one chunk, and the share of failing chunks that rejects.
CHUNK_BAND = (0.25, 0.70)
FAILING_CHUNKS = 0.25
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, zstd_ratio double, n_chunks long, n_bad_chunks long"


def repeated_words(words: list[bytes]) -> int:
    """Words within windows of WINDOW words that occur twice or more. Windows are compared exactly, by doubled ranks."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    rank = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    span = 1
    while span < WINDOW:
        pair = rank[:-span] * (rank.max() + 1) + rank[span:]
        rank = np.unique(pair, return_inverse=True)[1]
        span *= 2
    twice = np.bincount(rank)[rank] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + WINDOW, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def duplicate_lines(raw: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in raw.split(b"\n") if x.split(None, 1)]
    return len(lines) - len(set(lines))


def ratios(raw: bytes, press: zstandard.ZstdCompressor) -> tuple[float, list[float]]:
    """Of the whole text and of its chunks; 1 for an empty text."""
    if not raw:
        return 1.0, []
    cuts = list(range(0, len(raw), CHUNK))
    if len(cuts) > 1 and len(raw) - cuts[-1] < LEAST_CHUNK:
        cuts.pop()
    pieces = [raw[a:b] for a, b in zip(cuts, [*cuts[1:], len(raw)], strict=True)]
    return len(press.compress(raw)) / len(raw), [len(press.compress(p)) / len(p) for p in pieces] if len(pieces) > 1 else []


def within_bands(size: int, whole: float, chunks: list[float]) -> tuple[bool, int]:
    low, high = next((lo, hi) for under, lo, hi in BANDS if size < under)
    bad = sum(not CHUNK_BAND[0] <= r <= CHUNK_BAND[1] for r in chunks)
    return low <= whole <= high and bad <= FAILING_CHUNKS * len(chunks), bad


def compression_bands(docs: DataFrame) -> DataFrame:
    """One row per row of docs (doc_id, text; other columns are left behind).

    A null or empty text has no words, so it fails the base rule; its ratio is 1. A null doc_id stays null, repeated rows
    give repeated results, an empty table an empty result. Whole texts are compressed, however long.
    """
    kinds = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.float64(), pa.int64(), pa.int64()]
    schema = pa.schema([(c.split()[0], t) for c, t in zip(SCHEMA.split(", "), kinds, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=LEVEL)
        for rows, texts in slices(batches):
            out: list[list] = [[] for _ in range(10)]
            for text in texts:
                raw = text or b""
                words = raw.split()
                repeated = repeated_words(words)
                failed = len(words) < 20 or 100 * repeated > 30 * len(words)
                whole, chunks = ratios(raw, press)
                good, bad = within_bands(len(raw), whole, chunks)
                chars = sum(map(len, words)) if raw.isascii() else len(b"".join(words).decode("utf-8", "replace"))
                row = (len(words), chars, len(raw) - len(raw.translate(None, SYMBOLS)), duplicate_lines(raw), repeated, failed, good and not failed, whole, len(chunks), bad)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            yield pa.record_batch([rows.column(0).cast(pa.int64()), *(pa.array(c, f.type) for c, f in zip(out, list(schema)[1:], strict=True))], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
