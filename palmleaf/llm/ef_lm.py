"""Language-model scoring with a sharded Elias-Fano n-gram trie.

The model is an interpolated trigram model with absolute discounting over all training words and the end of a text; below
the bigrams are the add-one unigram shares of the query contract, so every word has a probability. No word, n-gram or count
is left out. The most frequent words (VOCABULARY of them, a bound on what is broadcast) have small ids, which only makes
their messages shorter; any other word goes by its 62-bit hash.

1. Training counts of all words are summed in shards by hash.
2. Every token goes, with its two predecessors and the place of its document, to the shard of its middle word. The shard
   sees all training tokens of its contexts, builds its trie and scores the tokens it was sent.
3. A token whose last word has no id goes on to the shard of that word, which knows its count, as two codes: its probability
   is a + b * (share of the word).
4. Sums per document come back to the batch that sent it.

A frequent middle word is split over a grid of shards, rows by the word before and columns by the word behind. A pass ahead
sums its bigrams, which go to the shards of their column, and (with more than one column) the counts and numbers of
successors of its contexts, which go to those of their row. So neither a frequent word, nor a frequent pair on either side of
it is one shard's work; only equal trigrams are.

A trie has three levels. Ids are made monotone by range offsets and kept with their pointers as Elias-Fano sequences in one
memory-mapped file; a successor in the third level is its position among the successors of the shorter context;
probabilities and back-off weights are quantised logarithms.
"""

from __future__ import annotations

import mmap
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import groups_of, hashed_words, id_remainder, mix, shuffle_width, slices, stored

#: Words with a short id, a bound on what is broadcast. It changes the size of messages and no score.
VOCABULARY = (1 << 18) - 2
DISCOUNT = 0.75
#: Steps of one unit of a base-10 logarithm, and the largest code.
STEPS, LARGEST = 200, 4095
#: Tokens of one shard.
PER_SHARD = 1_000_000
#: Shards of a middle word from which on its columns are split, too.
GRID = 16
#: Bytes of text that one task of the word count gets the words of.
COUNT_BYTES = 48 << 20
#: Bits of an id; three are packed into one number.
BITS = 18
START, END, FIRST = 0, 1, 2
#: Marks the hash of a word that has no id.
RARE = 1 << 62
#: Stands for a probability that has no part of its own.
NONE = 65535
#: Distinct trigrams of one trie.
CHUNK = 250_000
COLUMN = np.uint64(0x9E3779B97F4A7C15)


# ---- Elias-Fano sequences ---------------------------------------------------------------------------------------------


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Values of width bits each, one after the other, in 64-bit words."""
    out = np.zeros(len(values) * width // 64 + 2, np.uint64)
    if width and len(values):
        at = np.arange(len(values), dtype=np.uint64) * np.uint64(width)
        word, shift, v = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63), values.astype(np.uint64)
        np.bitwise_or.at(out, word, v << shift)
        over = shift + np.uint64(width) > np.uint64(64)
        np.bitwise_or.at(out, word[over] + 1, v[over] >> (np.uint64(64) - shift[over]))
    return out


def unpack(words: np.ndarray, width: int, index: np.ndarray) -> np.ndarray:
    if not width:
        return np.zeros(len(index), np.int64)
    at = index.astype(np.uint64) * np.uint64(width)
    word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
    low = words[word] >> shift
    high = np.where(shift > 0, words[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
    return ((low | high) & np.uint64((1 << width) - 1)).astype(np.int64)


class Levels:
    """Arrays in one memory-mapped file without a name, so that nothing stays when the process ends."""

    def __init__(self, arrays: list[np.ndarray]):
        place, size = [], 0
        for a in arrays:
            place.append(size)
            size += -(-a.nbytes // 8) * 8
        handle, path = tempfile.mkstemp(prefix="levels-")
        os.unlink(path)
        os.ftruncate(handle, max(size, 8))
        self.file = mmap.mmap(handle, max(size, 8))
        os.close(handle)
        self.arrays = []
        for a, at in zip(arrays, place, strict=True):
            view = np.frombuffer(self.file, a.dtype, len(a), at)
            np.frombuffer(self.file, np.uint8, a.nbytes, at)[:] = np.ascontiguousarray(a).view(np.uint8)
            self.arrays.append(view)


def select_in_word(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Position of the bit with so many ones before it in each 64-bit word."""
    at = np.zeros(len(words), np.int64)
    for half in (32, 16, 8, 4, 2, 1):
        ones = np.bitwise_count(words & np.uint64((1 << half) - 1)).astype(np.int64)
        over = rank >= ones
        rank = np.where(over, rank - ones, rank)
        words = np.where(over, words >> np.uint64(half), words)
        at += np.where(over, half, 0)
    return at


class EliasFano:
    """A monotone sequence: high parts in unary, low parts packed, and a directory of the ones before each 64-bit word of the
    high parts. find() is a successor search with a test for equality."""

    @staticmethod
    def encode(values: np.ndarray) -> tuple[list[np.ndarray], tuple[int, int]]:
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        width = max(0, (top // max(n, 1)).bit_length() - 1)
        high = np.zeros(-(-(n + (top >> width) + 2) // 64) * 64, np.uint8)
        high[(values >> width) + np.arange(n)] = 1
        words = np.packbits(high, bitorder="little").view(np.uint64)
        before = np.r_[0, np.cumsum(np.bitwise_count(words), dtype=np.int64)].astype(np.uint32 if n < 1 << 32 else np.uint64)
        return [words, before, pack(values & ((1 << width) - 1), width)], (n, width)

    def __init__(self, arrays: list[np.ndarray], shape: tuple[int, int]):
        self.high, self.before, self.low = arrays
        self.n, self.width = shape
        self.zeros = 64 * (len(self.before) - 1) - int(self.before[-1])

    def get(self, index: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.before, index, side="right") - 1
        high = 64 * word + select_in_word(self.high[word], index - self.before[word].astype(np.int64)) - index
        return (high << self.width) | unpack(self.low, self.width, index)

    def below(self, high: np.ndarray) -> np.ndarray:
        """Elements whose high part is at most this; the directory is searched for the zero that ends them."""
        lo, hi = np.zeros(len(high), np.int64), np.full(len(high), len(self.high) - 1)
        for _ in range(len(self.high).bit_length()):
            mid = (lo + hi + 1) >> 1
            fits = 64 * mid - self.before[mid].astype(np.int64) <= high
            lo, hi = np.where(fits, mid, lo), np.where(fits, hi, mid - 1)
        rank = high - (64 * lo - self.before[lo].astype(np.int64))
        return 64 * lo + select_in_word(~self.high[lo], rank) - high

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each value the index of its successor, the first element not below it, and whether that equals it."""
        if not self.n or not len(values):
            return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
        beyond = (values >> self.width) >= self.zeros
        high, back = compact(np.minimum(values >> self.width, self.zeros - 1))
        stop = self.below(high)[back]
        a = np.where(high > 0, self.below(np.maximum(high - 1, 0)), 0)[back]
        z, want = stop.copy(), values & ((1 << self.width) - 1)
        active = np.flatnonzero((a < z) & ~beyond)
        while len(active):
            mid = (a[active] + z[active]) >> 1
            less = unpack(self.low, self.width, mid) < want[active]
            a[active] = np.where(less, mid + 1, a[active])
            z[active] = np.where(less, z[active], mid)
            active = active[a[active] < z[active]]
        found = (a < stop) & ~beyond
        hit = np.flatnonzero(found)
        found[hit] = unpack(self.low, self.width, a[hit]) == want[hit]
        return np.where(beyond, self.n, a), found


def quantised(p: np.ndarray) -> np.ndarray:
    return np.minimum(np.rint(-np.log10(p) * STEPS), LARGEST).astype(np.uint16)


def starts_of(keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)


def _segments(keys: np.ndarray, counts: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of each wanted key in sorted keys, and the sums of the counts between them."""
    bounds = np.r_[np.searchsorted(keys, wanted), len(keys)].astype(np.int64)
    return bounds, np.diff(np.r_[0, np.cumsum(counts)].astype(np.int64)[bounds])


def _united(keys: np.ndarray, more: np.ndarray) -> np.ndarray:
    return compact(np.sort(np.r_[keys, more], kind="stable"))[0] if len(more) else keys


def _widths(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One more than the last value of each range, 0 for an empty one."""
    if not len(values):
        return np.zeros(len(bounds) - 1, np.int64)
    return np.where(bounds[1:] > bounds[:-1], values[np.maximum(bounds[1:] - 1, 0)] + 1, 0)


def compact(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first value of each run of equal ones, and for each value the place of its run."""
    starts = starts_of(values)
    return values[starts], np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(values)]))


class Trie:
    """The trigrams of some middle words. Sibling ranges are made monotone by adding an offset for each range."""

    def __init__(self, tri: np.ndarray, tri_n: np.ndarray, bi: np.ndarray, bi_n: np.ndarray, p1: np.ndarray, bits: tuple[int, int], sums2: np.ndarray | None = None, sums12: tuple[np.ndarray, ...] | None = None):
        """tri: sorted w2 << (b1 + b3) | w1 << b3 | w3; bi: sorted w2 << b3 | w3, a pair for every trigram; bits: b1, b3.

        p1: shares by w3, 0 for a word whose share is added later. sums2: (count, successors) by w2 where bi and tri do not
        tell them, else 0; sums12: sorted contexts w2 << b1 | w1 of which the same is given, counts and successors.
        """
        b1, b3 = bits
        word1, word3 = (1 << b1) - 1, (1 << b3) - 1
        sums2 = np.zeros((0, 2), np.int64) if sums2 is None else sums2
        keys12, given_c12, given_n12 = (np.zeros(0, np.int64),) * 3 if sums12 is None else sums12
        # bigrams
        w2 = _united(compact(bi >> b3)[0], np.flatnonzero(sums2[:, 0]))
        s2, c2 = _segments(bi >> b3, bi_n, w2)
        own2 = np.diff(s2)
        n2 = own2
        if len(sums2):
            c2, n2 = np.where(sums2[w2, 0] > 0, sums2[w2, 0], c2), np.where(sums2[w2, 0] > 0, sums2[w2, 1], n2)
        weight2 = DISCOUNT * n2 / np.maximum(c2, 1)
        of2, w3 = np.repeat(np.arange(len(w2)), own2), bi & word3
        p2 = (bi_n - DISCOUNT) / c2[of2] + weight2[of2] * p1[w3]
        off2 = np.r_[0, np.cumsum(_widths(w3, s2))]
        # contexts (w2, w1) and trigrams
        ctx = _united(compact(tri >> b3)[0], keys12)
        s12, c12 = _segments(tri >> b3, tri_n, ctx)
        own12 = np.diff(s12)
        n12, at = own12.copy(), np.searchsorted(ctx, keys12)
        c12[at], n12[at] = given_c12, given_n12
        weight12 = DISCOUNT * n12 / np.maximum(c12, 1)
        of12 = np.repeat(np.arange(len(ctx)), own12)
        above = np.searchsorted(bi, (tri >> (b1 + b3) << b3) | (tri & word3))
        p3 = (tri_n - DISCOUNT) / c12[of12] + weight12[of12] * p2[above]
        pos2 = np.searchsorted(w2, ctx >> b1)
        w1 = ctx & word1
        off_ctx = np.r_[0, np.cumsum(_widths(w1, np.searchsorted(pos2, np.arange(len(w2) + 1))))]
        rel = above - s2[pos2[of12]]  # position among the successors of the shorter context
        off3 = np.r_[0, np.cumsum(_widths(rel, s12))]
        plain = (w2, s2, off2, off2[of2] + w3, off_ctx, off_ctx[pos2] + w1, off3, off3[of12] + rel)
        coded = [EliasFano.encode(np.asarray(x, np.int64)) for x in plain]
        tables = [quantised(p2), quantised(np.minimum(weight2, 1)), quantised(p3), quantised(np.minimum(weight12, 1))]
        self.levels = Levels([a for arrays, _ in coded for a in arrays] + tables)
        held = self.levels.arrays
        self.w2, self.start2, self.off2, self.bi, self.off_ctx, self.ctx, self.off3, self.tri = (EliasFano(held[3 * i : 3 * i + 3], shape) for i, (_, shape) in enumerate(coded))
        self.q2, self.b2, self.q3, self.b12 = held[-4:]

    @staticmethod
    def child(level: EliasFano, offsets: EliasFano, parent: np.ndarray, there: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and presence of value in the range of parent, where the parent is there."""
        at, found = np.zeros(len(value), np.int64), np.zeros(len(value), bool)
        live = np.flatnonzero(there)
        some, back = compact(parent[live])
        base, end = offsets.get(some)[back], offsets.get(some + 1)[back]
        inside = value[live] < end - base
        live, base = live[inside], base[inside]
        at[live], found[live] = level.find(base + value[live])
        return at, found

    def score(self, w1: np.ndarray, w2: np.ndarray, w3: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes a and b of each w3 after w1, w2 (sorted by w2, w1, w3 at best): the probability is that of a where there is one, which holds the share of w3 if
        p1 had it, and b is the weight of that share."""
        some, back = compact(w2)
        top, seen = (x[back] for x in self.w2.find(some))
        wide = int(w3.max()) + 1 if len(w3) else 1
        some, back = np.unique(w2 * wide + w3, return_inverse=True)
        first = np.zeros(len(some), np.int64)
        first[back] = np.arange(len(w3))
        pair, has_pair = (x[back] for x in self.child(self.bi, self.off2, top[first], seen[first], w3[first]))
        context, has_context = self.child(self.ctx, self.off_ctx, top, seen, w1)
        a, b = np.full(len(w3), NONE, np.int64), np.zeros(len(w3), np.int64)
        b[seen] += self.b2[top[seen]]
        b[has_context] += self.b12[context[has_context]]
        a[has_pair] = self.q2[pair[has_pair]]
        short = has_pair & has_context
        rel = np.zeros(len(w3), np.int64)
        if short.any():
            some, back = compact(top[short])
            rel[short] = pair[short] - self.start2.get(some)[back]
        full, has_full = self.child(self.tri, self.off3, context, short, rel)
        short &= ~has_full
        a[short] += self.b12[context[short]]
        a[has_full] = self.q3[full[has_full]]
        return a, b


# ---- words ------------------------------------------------------------------------------------------------------------


class WordIds:
    """Hashes of words to ids, or to RARE | hash for a word that has none, by open addressing for whole arrays."""

    def __init__(self, hashes: np.ndarray | None = None):
        """hashes: of the words with ids, which count from FIRST."""
        hashes = np.zeros(0, np.int64) if hashes is None else hashes
        self.mask = (1 << max(4, (4 * len(hashes)).bit_length())) - 1
        self.keys, self.ids = np.full(self.mask + 1, -1, np.int64), np.zeros(self.mask + 1, np.int32)
        left, at = np.arange(len(hashes)), hashes & self.mask
        while len(left):
            free = self.keys[at] < 0
            self.ids[at[free]] = left[free] + FIRST
            self.keys[at[free]] = hashes[left[free]]  # the last of those that want a place has it
            put = self.keys[at] == hashes[left]
            self.ids[at[put]] = left[put] + FIRST
            left, at = left[~put], (at[~put] + 1) & self.mask

    def of(self, hashes: np.ndarray) -> np.ndarray:
        out, at, left = hashes | RARE, hashes & self.mask, np.arange(len(hashes))
        while len(left):
            key = self.keys[at]
            hit = key == hashes[left]
            out[left[hit]] = self.ids[at[hit]]
            more = ~hit & (key >= 0)
            left, at = left[more], (at[more] + 1) & self.mask
        return out


def tokens_of(texts: list[bytes | None], words: WordIds) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the words of all texts, each text followed by END; and the number of tokens of each."""
    hashes, lengths = hashed_words(texts)
    lengths = lengths + 1
    out = np.full(len(hashes) + len(texts), END, np.int64)
    mask = np.ones(len(out), bool)
    mask[np.cumsum(lengths) - 1] = False
    out[mask] = words.of(hashes)
    return out, lengths


def contexts_of(code: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two words before each token, START before a text."""
    first = np.cumsum(lengths) - lengths
    w2, w1 = np.r_[START, code[:-1]][: len(code)], np.r_[START, START, code[:-2]][: len(code)]
    w2[first] = START
    w1[first] = START
    w1[first[lengths > 1] + 1] = START
    return w1, w2


class Vocabulary:
    """What every task knows: ids and training counts of frequent words, and the totals."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, texts: int, words: int, distinct: int, per_shard: int):
        self.hashes = codes
        self.count = np.r_[texts, texts, counts].astype(np.int64)
        self.train, self.distinct = words + texts, distinct + (texts > 0)
        self.p1 = self.share(self.count)
        self.p1[START] = 1.0  # never predicted
        #: the grid of shards that a middle word is split over: its rows and columns
        parts = np.maximum(1, -(-self.count // max(per_shard // 8, 1)))
        self.columns = np.where(parts >= GRID, np.floor(np.sqrt(parts)), 1).astype(np.int64)
        self.rows = -(-parts // self.columns)
        self.split = parts > 1

    def share(self, counts: np.ndarray) -> np.ndarray:
        """The contract's share of a word with such a training count."""
        return (counts + 1) / (self.train + 1 * (self.distinct + 1))

    def grid(self, w2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows and columns of middle words, and whether they are split."""
        known = w2 < RARE
        at = np.where(known, w2, START)
        some = known & self.split[at]
        return np.where(some, self.rows[at], 1), np.where(some, self.columns[at], 1), some

    def shard(self, w1: np.ndarray, w2: np.ndarray, w3: np.ndarray, width: int) -> np.ndarray:
        cell = np.zeros(len(w2), np.uint64)
        rows, columns, some = self.grid(w2)
        some = np.flatnonzero(some)
        cell[some] = row_of(w1[some], rows[some]) * columns[some].astype(np.uint64) + column_of(w3[some], columns[some])
        return home_of(w2, cell, width)


def row_of(w1: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return mix(w1.astype(np.uint64)) % rows.astype(np.uint64)


def column_of(w3: np.ndarray, columns: np.ndarray) -> np.ndarray:
    return mix(w3.astype(np.uint64) ^ COLUMN) % columns.astype(np.uint64)


def home_of(w2: np.ndarray, cell: np.ndarray, width: int) -> np.ndarray:
    return (mix(mix(w2.astype(np.uint64)) + cell) % np.uint64(width)).astype(np.int64)


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their counts."""
    key, back = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(back, np.concatenate(counts), len(key)).astype(np.int64)


def _runs(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    starts = starts_of(keys).tolist()
    return zip(starts, [*starts[1:], len(keys)], strict=False)


def _distinct(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows and, for each row, the place of its own."""
    rank = columns[0]
    if len(rank) and int(rank.max()) >= 1 << 20:
        rank = np.unique(rank, return_inverse=True)[1]
    for c in columns[1:]:
        some, at = np.unique(c, return_inverse=True)
        rank = np.unique(rank * len(some) + at, return_inverse=True)[1]
    first = np.zeros(int(rank.max()) + 1 if len(rank) else 0, np.int64)
    first[rank[::-1]] = np.arange(len(rank))[::-1]
    return [c[first] for c in columns], rank


def _added_rows(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows, sorted by the first column and the others, and the sums of their counts."""
    some, place = _distinct(columns)
    return some, np.bincount(place, counts, len(some[0])).astype(np.int64)


def _count_words(docs: DataFrame, width: int, vocabulary: int, per_shard: int) -> Vocabulary:
    schema = pa.schema([("pid", pa.int64()), ("texts", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held, texts = WordIds(), [], 0

        def out() -> pa.RecordBatch:
            key, count = _added([k for k, _ in held], [c for _, c in held])
            pid = key % width
            by = np.argsort(pid, kind="stable")
            cuts = np.flatnonzero(np.diff(pid[by])) + 1
            pick = lambda v: pa.array([x.tobytes() for x in np.split(v[by], cuts)], pa.binary())
            some = pid[by][np.r_[0, cuts]] if len(key) else np.zeros(1, np.int64)
            return pa.record_batch([pa.array(some), pa.array(np.zeros(len(some), np.int64)), pick(key), pick(count)], schema=schema)

        for rows, raw in slices(batches):
            train = rows.column(2).to_numpy(zero_copy_only=False).astype(bool)
            codes, _ = tokens_of([t for t, x in zip(raw, train, strict=True) if x], words)
            texts += int(train.sum())
            held.append(np.unique(codes[codes != END], return_counts=True))
            if sum(len(k) for k, _ in held) > 700_000:
                yield out()
                held.clear()
        if held:
            yield out()
        yield pa.record_batch([pa.array([0]), pa.array([texts]), pa.array([b""]), pa.array([b""])], schema=schema)

    found = pa.schema([("top", pa.bool_()), ("code", pa.int64()), ("n", pa.int64()), ("texts", pa.int64())])

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in groups_of(batches, "pid"):
            key, count = _added([np.frombuffer(x, np.int64) for x in group.column("keys").to_pylist()], [np.frombuffer(x, np.int64) for x in group.column("counts").to_pylist()])
            top = np.lexsort((key, -count))[:vocabulary]
            yield pa.record_batch([pa.array([False] + [True] * len(top)), pa.array(np.r_[len(key), key[top]]), pa.array(np.r_[count.sum(), count[top]]), pa.array(np.r_[sum(group.column("texts").to_pylist()), np.zeros(len(top), np.int64)])], schema=found)

    made = docs.mapInArrow(local, "pid long, texts long, keys binary, counts binary").repartition(width, "pid").sortWithinPartitions("pid")
    made = stored(made.mapInArrow(shard, "top boolean, code long, n long, texts long"), "words")
    totals = made.filter("NOT top").agg(F.sum("code"), F.sum("n"), F.sum("texts")).first()
    best = made.filter("top").orderBy(F.desc("n"), "code").limit(vocabulary).toArrow()
    return Vocabulary(best.column("code").to_numpy() & (RARE - 1), best.column("n").to_numpy(), totals[2] or 0, totals[1] or 0, totals[0] or 0, per_shard)


# ---- messages ---------------------------------------------------------------------------------------------------------


def squeezed(keys: np.ndarray, press: zstandard.ZstdCompressor) -> bytes:
    """A sorted array as compressed byte planes of its differences."""
    return planes([np.diff(keys, prepend=np.int64(0))], press)


def restored(raw: bytes, plain: zstandard.ZstdDecompressor) -> np.ndarray:
    return np.cumsum(columns_of(raw, plain, 1)[0])


def planes(columns: list[np.ndarray], press: zstandard.ZstdCompressor) -> bytes:
    """Columns of one integer type as compressed byte planes."""
    return press.compress(b"".join(np.ascontiguousarray(c.view(np.uint8).reshape(len(c), c.itemsize).T).tobytes() for c in map(np.ascontiguousarray, columns)))


def columns_of(raw: bytes, plain: zstandard.ZstdDecompressor, n: int, kind: type = np.int64) -> list[np.ndarray]:
    size = np.dtype(kind).itemsize
    made = np.frombuffer(plain.decompress(raw), np.uint8).reshape(n, size, -1)
    return [np.ascontiguousarray(p.T).reshape(-1).view(kind) for p in made]


ONE, PAIRS, CONTEXTS, NGRAMS, MIXED, SUMS, ASKED, SHARES, TOTAL = range(9)
MESSAGE = pa.schema([("pid", pa.int64()), ("batch", pa.int64()), ("kind", pa.int32()), ("keys", pa.binary()), ("slots", pa.binary()), ("more", pa.binary())])
MESSAGE_DDL = "pid long, batch long, kind int, keys binary, slots binary, more binary"


def _batches(rows: list[tuple], size: int = 2048) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(rows), size):
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows[a : a + size], strict=True), MESSAGE, strict=True)], schema=MESSAGE)


def _ahead(rows: DataFrame, shared, width: int, homes: int) -> DataFrame:
    """Messages with the summed training bigrams of every middle word that is split, for the shards of their column; where it
    has more than one column also counts and successors of its contexts, for the shards of their row; and its totals.

    Bigrams and trigrams are summed in each task before they are moved, and a word's are dealt over as many homes as it has
    shards. A bigram is copied to as many shards as its word has rows, the root of their number.
    """
    packed = pa.schema([("home", pa.int64()), ("kind", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = shared.value
        words, press = WordIds(v.hashes), zstandard.ZstdCompressor(level=1)
        held: dict[int, list] = {PAIRS: [], CONTEXTS: []}

        def out(kind: int) -> Iterator[pa.RecordBatch]:
            if not held[kind]:
                return
            cols, n = _added_rows([np.concatenate(c) for c in zip(*(x[:-1] for x in held[kind]), strict=True)], np.concatenate([x[-1] for x in held[kind]]))
            held[kind].clear()
            deal = (v.rows * v.columns)[cols[0]].astype(np.uint64)
            home = home_of(cols[0], np.uint64(kind) + mix(cols[1].astype(np.uint64) ^ COLUMN) % deal, homes)
            by = np.argsort(home, kind="stable")
            runs = list(_runs(home[by]))
            yield pa.record_batch([pa.array([int(home[by[a]]) for a, _ in runs], pa.int64()), pa.array([kind] * len(runs), pa.int32()), pa.array([planes([c[by[a:b]] for c in cols], press) for a, b in runs], pa.binary()), pa.array([press.compress(n[by[a:b]].tobytes()) for a, b in runs], pa.binary())], schema=packed)

        for part, raw in slices(batches):
            train = part.column(2).to_numpy(zero_copy_only=False).astype(bool)
            code, lengths = tokens_of([t for t, x in zip(raw, train, strict=True) if x], words)
            w1, w2 = contexts_of(code, lengths)
            _, columns, hot = v.grid(w2)
            if hot.any():
                cols, n = _added_rows([w2[hot], code[hot]], np.ones(int(hot.sum())))
                held[PAIRS].append((*cols, n))
            wide = columns > 1
            if wide.any():
                cols, n = _added_rows([w2[wide], w1[wide], code[wide]], np.ones(int(wide.sum())))
                held[CONTEXTS].append((*cols, n))
            for kind in held:
                if sum(len(x[0]) for x in held[kind]) > 1_500_000:
                    yield from out(kind)
        for kind in held:
            yield from out(kind)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = shared.value
        press, plain = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        for _, group in groups_of(batches, "home"):
            kinds, raw, counts = (group.column(c).to_pylist() for c in ("kind", "keys", "counts"))
            for kind, wide in ((PAIRS, 2), (CONTEXTS, 3)):
                mine = [(columns_of(k, plain, wide), np.frombuffer(plain.decompress(c), np.int64)) for x, k, c in zip(kinds, raw, counts, strict=True) if x == kind]
                if not mine:
                    continue
                cols, n = _added_rows([np.concatenate(c) for c in zip(*(x[0] for x in mine), strict=True)], np.concatenate([x[1] for x in mine]))
                types = np.ones(len(n), np.int64)
                if kind == CONTEXTS:
                    at = np.flatnonzero(np.r_[True, (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])])
                    cols, types, n = [cols[0][at], cols[1][at]], np.diff(np.r_[at, len(n)]), np.add.reduceat(n, at)
                for a, b in _runs(cols[0]):
                    w2 = int(cols[0][a])
                    r, k = int(v.rows[w2]), int(v.columns[w2])
                    other, m, t = cols[1][a:b], n[a:b], types[a:b]
                    line = (column_of(other, np.full(1, k)) if kind == PAIRS else row_of(other, np.full(1, r))).astype(np.int64)
                    by, out = np.argsort(line, kind="stable"), []
                    if kind == PAIRS:
                        out.append((w2, b - a, TOTAL, None, None, None))
                    for c, d in _runs(line[by]):
                        some, at = by[c:d], int(line[by[c]])
                        cells = np.arange(r) * k + at if kind == PAIRS else at * k + np.arange(k)
                        keys = squeezed(other[some], press)
                        told = press.compress(m[some].tobytes() + (t[some].tobytes() if kind == CONTEXTS else b""))
                        out += [(int(pid), w2, kind, keys, told, None) for pid in np.unique(home_of(np.full(len(cells), w2), cells.astype(np.uint64), width))]
                    yield from _batches(out, 256)

    made = rows.mapInArrow(local, "home long, kind int, keys binary, counts binary").repartition(homes, "home").sortWithinPartitions("home")
    return stored(made.mapInArrow(merge, MESSAGE_DDL), "ahead")


# ---- scoring ----------------------------------------------------------------------------------------------------------


def score_texts(docs: DataFrame, per_shard: int = PER_SHARD, vocabulary: int = VOCABULARY) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of docs (doc_id, text).

    A null text is empty: one token, its end. A null id counts as an empty text for the fold. Without training rows N and V
    are 0. Repeated rows are scored alike and, in training, count each. Texts are whole, however long. Other columns are
    left behind. per_shard and vocabulary set the size of tasks and messages and change no score.
    """
    spark = docs.sparkSession
    held = id_remainder("doc_id", 7) == 2
    rows = docs.select("doc_id", "text", (~held).alias("train"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    known = _count_words(rows, shuffle_width(spark, size, COUNT_BYTES), vocabulary, per_shard)
    width = shuffle_width(spark, known.train * 7 / 6, per_shard)
    shared = spark.sparkContext.broadcast(known)
    ahead = _ahead(rows, shared, width, shuffle_width(spark, known.train, 4 * per_shard))
    # one number for each split word, all of which have ids
    totals = spark.sparkContext.broadcast({r[0]: r[1] for r in ahead.filter(F.col("kind") == TOTAL).groupBy("pid").agg(F.sum("batch")).toLocalIterator()})

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = shared.value
        words, press, number = WordIds(v.hashes), zstandard.ZstdCompressor(level=1), 0
        task = TaskContext.get().partitionId()
        base_of = np.log10(v.p1)
        base_of[END] = np.log10(v.share(v.count[END : END + 1]))[0]
        for part, raw in slices(batches):
            batch, number = (task << 28) + number, number + 1
            code, lengths = tokens_of(raw, words)
            train = part.column(2).to_numpy(zero_copy_only=False).astype(bool)
            doc = np.repeat(np.arange(len(lengths)), lengths)
            slot = (2 * doc + train[doc]).astype(np.uint16)
            rare = code >= RARE
            base = np.bincount(doc, np.where(rare, 0.0, base_of[np.where(rare, END, code)]), len(lengths))
            n_known = np.bincount(doc, np.where(rare, 0, v.count[np.where(rare, END, code)]) > 0, len(lengths)).astype(np.int64)
            ids = part.column(0).cast(pa.int64())
            out: list[tuple] = [(int(batch) % width, batch, ONE, ids.fill_null(0).to_numpy().tobytes() + np.asarray(ids.is_valid()).astype(np.uint8).tobytes(), lengths.tobytes() + train.astype(np.uint8).tobytes(), base.tobytes() + n_known.tobytes())]
            w1, w2 = contexts_of(code, lengths)
            pid = v.shard(w1, w2, code, width)
            mixed = rare | (w1 >= RARE) | (w2 >= RARE)
            plain = np.flatnonzero(~mixed)
            key = (w2[plain] << (2 * BITS)) | (w1[plain] << BITS) | code[plain]
            by = np.argsort(key)
            home = pid[plain].astype(np.uint16 if width < 1 << 16 else np.int64)
            by = by[np.argsort(home[by], kind="stable")]
            for a, b in _runs(home[by]):
                some = by[a:b]
                out.append((int(home[some[0]]), batch, NGRAMS, squeezed(key[some], press), planes([slot[plain[some]]], press), None))
            mixed = np.flatnonzero(mixed)
            mixed = mixed[np.lexsort((w2[mixed], pid[mixed]))]
            for a, b in _runs(pid[mixed]):
                some = mixed[a:b]
                flat = np.concatenate([w2[some], w1[some], code[some]])
                names, at = np.unique(flat[flat >= RARE], return_inverse=True)
                flat[flat >= RARE] = at + (1 << BITS)
                out.append((int(pid[some[0]]), batch, MIXED, planes(np.split(flat.astype(np.int32), 3), press), planes([slot[some]], press), squeezed(names, press)))
            yield from _batches(out, 4096)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = shared.value
        press, plain = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        for pid, group in groups_of(batches, "pid"):
            mine: dict[int, list[tuple]] = {k: [] for k in (ONE, PAIRS, CONTEXTS, NGRAMS, MIXED)}
            for batch, kind, keys, slots, more in zip(*(group.column(c).to_pylist() for c in ("batch", "kind", "keys", "slots", "more")), strict=True):
                mine[kind].append((batch, keys, slots, more))
            out = [(pid, batch, ONE, keys, slots, more) for batch, keys, slots, more in mine[ONE]]
            asked = mine[NGRAMS] + mine[MIXED]
            if asked:
                slots = [columns_of(x[2], plain, 1, np.uint16)[0] for x in asked]
                batch = np.repeat(np.array([x[0] for x in asked], np.int64), list(map(len, slots)))
                slot = np.concatenate(slots)
                packed = np.concatenate([restored(x[1], plain) for x in mine[NGRAMS]] or [np.zeros(0, np.int64)])
                loose = [named(x, plain) for x in mine[MIXED]]
                word = (1 << BITS) - 1
                some, back = np.unique(packed, return_inverse=True)
                cols, n = [some >> (2 * BITS), (some >> BITS) & word, some & word], np.bincount(back, slot[: len(packed)] & 1, len(some)).astype(np.int64)
                if loose:
                    rest = [np.concatenate(c) for c in zip(*loose, strict=True)]
                    more, place = _distinct(rest)
                    back = np.r_[back, place + len(some)]
                    n = np.r_[n, np.bincount(place, slot[len(packed) :] & 1, len(more[0])).astype(np.int64)]
                    cols = [np.r_[x, y] for x, y in zip(cols, more, strict=True)]
                given = {kind: [(b, restored(k, plain), np.frombuffer(plain.decompress(s), np.int64)) for b, k, s, _ in mine[kind]] for kind in (PAIRS, CONTEXTS)}
                a, b = _scored(v, cols, n, given, totals.value)
                own = cols[2] < RARE
                code = np.where(own, np.where(a == NONE, b + quantised(v.p1)[np.where(own, cols[2], END)], a), 0)
                token = code[back]
                # sums of the words with ids, for each batch
                for x, y in _runs(batch):
                    at = slot[x:y] >> 1
                    have = np.flatnonzero(np.bincount(at))
                    out.append((int(batch[x]) % width, int(batch[x]), SUMS, planes([have.astype(np.uint16)], press), planes([np.bincount(at, token[x:y])[have].astype(np.int64)], press), None))
                ask = np.flatnonzero(~own[back])
                if len(ask):
                    w3, pair = cols[2][back[ask]], back[ask]
                    there = (mix(w3.astype(np.uint64)) % np.uint64(width)).astype(np.int64)
                    by = np.lexsort((w3, there))
                    ask, w3, pair, there = ask[by], w3[by], pair[by], there[by]
                    for x, y in _runs(there):
                        names, index = np.unique(batch[ask[x:y]], return_inverse=True)
                        out.append((int(there[x]), int(pid), ASKED, squeezed(w3[x:y], press), planes([slot[ask[x:y]], a[pair[x:y]].astype(np.uint16), b[pair[x:y]].astype(np.uint16)], press), press.compress(names.tobytes() + index.astype(np.int32).tobytes()) + len(names).to_bytes(4, "little")))
            yield from _batches(out)

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = shared.value
        press, plain = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        for pid, group in groups_of(batches, "pid"):
            out, w3, parts, batch = [], [], [], []
            for home, kind, keys, slots, more in zip(*(group.column(c).to_pylist() for c in ("batch", "kind", "keys", "slots", "more")), strict=True):
                if kind != ASKED:
                    out.append((pid, home, kind, keys, slots, more))
                    continue
                w3.append(restored(keys, plain))
                parts.append(columns_of(slots, plain, 3, np.uint16))
                names, index = int.from_bytes(more[-4:], "little"), plain.decompress(more[:-4])
                batch.append(np.frombuffer(index, np.int64, names)[np.frombuffer(index, np.int32, -1, 8 * names)])
            if w3:
                slot, a, b = (np.concatenate(c) for c in zip(*parts, strict=True))
                some, back = np.unique(np.concatenate(w3), return_inverse=True)
                count = np.bincount(back, slot & 1, len(some)).astype(np.int64)[back]
                share = v.share(count)
                code = np.rint(-np.log10(np.where(a == NONE, 0.0, 10.0 ** (-a.astype(float) / STEPS)) + 10.0 ** (-b.astype(float) / STEPS) * share) * STEPS)
                base, where = np.log10(share), np.concatenate(batch)
                by = np.argsort(where, kind="stable")
                for x, y in _runs(where[by]):
                    rows = by[x:y]
                    at = slot[rows] >> 1
                    have = np.flatnonzero(np.bincount(at))
                    total = lambda c: np.bincount(at, c[rows])[have]  # noqa: B023, E731
                    out.append((pid, int(where[rows[0]]), SHARES, planes([have.astype(np.uint16)], press), planes([total(code).astype(np.int64), total(count > 0).astype(np.int64)], press), total(base).tobytes()))
            yield from _batches(out)

    result = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, plain = shared.value.train, zstandard.ZstdDecompressor()
        for _, group in groups_of(batches, "batch"):
            items = list(zip(*(group.column(c).to_pylist() for c in ("kind", "keys", "slots", "more")), strict=True))
            _, ids, lengths, sums = next(x for x in items if x[0] == ONE)
            k = len(ids) // 9
            valid = np.frombuffer(ids, np.uint8, k, 8 * k).astype(bool)
            train = np.frombuffer(lengths, np.uint8, k, 8 * k).astype(bool)
            base, n_known, steps = np.frombuffer(sums, np.float64, k).copy(), np.frombuffer(sums, np.int64, k, 8 * k).copy(), np.zeros(k, np.int64)
            for kind, keys, slots, more in items:
                if kind == ONE:
                    continue
                at = columns_of(keys, plain, 1, np.uint16)[0]
                if kind == SUMS:
                    steps[at] += columns_of(slots, plain, 1)[0]
                else:
                    code, known = columns_of(slots, plain, 2)
                    steps[at] += code
                    n_known[at] += known
                    base[at] += np.frombuffer(more, np.float64)
            yield pa.record_batch([pa.array(np.frombuffer(ids, np.int64, k), mask=~valid), pa.array(~train), pa.array(np.frombuffer(lengths, np.int64, k)), pa.array(n_known), pa.array(np.full(k, total)), pa.array(base), pa.array(-steps / STEPS)], schema=result)

    sent = rows.mapInArrow(send, MESSAGE_DDL).unionByName(ahead.filter(F.col("kind") != TOTAL)).repartition(width, "pid").sortWithinPartitions("pid", "kind", "batch")
    back = sent.mapInArrow(answer, MESSAGE_DDL).repartition(width, "pid").sortWithinPartitions("pid", "kind", "batch")
    back = back.mapInArrow(shares, MESSAGE_DDL).repartition(width, "batch").sortWithinPartitions("batch", "kind", "pid")
    return back.mapInArrow(gather, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def named(message: tuple, plain: zstandard.ZstdDecompressor) -> list[np.ndarray]:
    """The columns of a message whose words without ids are numbered in the order of its own list."""
    names, flat = restored(message[3], plain), np.concatenate(columns_of(message[1], plain, 3, np.int32)).astype(np.int64)
    own = flat >= 1 << BITS
    flat[own] = names[flat[own] - (1 << BITS)]
    return np.split(flat, 3)


def _scored(v: Vocabulary, cols: list[np.ndarray], n: np.ndarray, given: dict[int, list[tuple]], totals: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Codes a and b of distinct trigrams (w2, w1, w3) with training counts n, by tries of CHUNK of them or of one middle word."""
    a, b = np.empty(len(n), np.int64), np.empty(len(n), np.int64)
    order = np.argsort(cols[0], kind="stable")
    starts = [x for x, _ in _runs(cols[0][order])] + [len(order)]
    lo = 0
    while lo < len(starts) - 1:
        hi = lo + 1
        while hi < len(starts) - 1 and starts[hi + 1] - starts[lo] <= CHUNK:
            hi += 1
        rows = order[starts[lo] : starts[hi]]
        a[rows], b[rows] = _chunk(v, [c[rows] for c in cols], n[rows], given, totals)
        lo = hi
    return a, b


def _chunk(v: Vocabulary, cols: list[np.ndarray], n: np.ndarray, given: dict[int, list[tuple]], totals: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    (u2, w2), (u1, w1), (u3, w3) = (np.unique(c, return_inverse=True) for c in cols)
    b1, b3 = len(u1).bit_length(), len(u3).bit_length()
    _, _, split = v.grid(u2)
    key = (((w2 << b1) | w1) << b3) | w3
    by = np.argsort(key)
    tri = by[n[by] > 0]
    pair = (w2[tri] << b3) | w3[tri]
    whole = ~split[w2[tri]]
    keys, counts = [pair[whole]], [n[tri][whole]]
    at12, c12, n12 = [], [], []
    for kind, names, shift in ((PAIRS, u3, b3), (CONTEXTS, u1, b1)):
        for word, other, told in given[kind]:
            at = int(np.searchsorted(u2, word))
            if at == len(u2) or u2[at] != word:
                continue
            place = np.minimum(np.searchsorted(names, other), len(names) - 1)
            hit = names[place] == other
            if kind == PAIRS:
                keys.append((at << shift) | place[hit])
                counts.append(told[hit])
            else:
                at12.append((at << shift) | place[hit])
                c12.append(told[: len(other)][hit])
                n12.append(told[len(other) :][hit])
    bi, bi_n = _added(keys, counts)
    sums2 = np.zeros((len(u2), 2), np.int64)
    sums2[split, 0] = v.count[u2[split]]
    sums2[split, 1] = [totals.get(int(w), 0) for w in u2[split]]
    sums2[sums2[:, 1] == 0] = 0
    sums12 = None
    if at12:
        keys12 = np.concatenate(at12)
        order = np.argsort(keys12)
        sums12 = keys12[order], np.concatenate(c12)[order], np.concatenate(n12)[order]
    known = u3 < RARE
    p1 = np.where(known, v.p1[np.where(known, u3, END)], 0.0)
    trie = Trie(key[tri], n[tri], bi, bi_n, p1, (b1, b3), sums2, sums12)
    a, b = np.empty(len(n), np.int64), np.empty(len(n), np.int64)
    a[by], b[by] = trie.score(w1[by], w2[by], w3[by])
    return a, b
