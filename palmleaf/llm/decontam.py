"""Benchmark decontamination by pigeonhole edit matching.

An item with an error budget of k edits is cut into k + 1 pieces; a passage within k edits holds one piece unchanged. All
pieces are sought at once by an Aho-Corasick automaton, and every window around a hit is verified with Myers' bit-parallel
distance, in which a Python integer is the bit vector of the whole item. Text and items are compared in lower case (A-Z)
with runs of blanks as one space.

The automaton is broadcast and holds at most SLICE characters of items; a larger benchmark is cut into more slices, each of
which is one pass over the documents, and the passes are united.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stored

ERROR_RATE = 0.1
SLICE = 4_000_000
#: Items with fewer characters than this have no budget, and are only found as whole words.
LEAST_CHARS = 24
SCHEMA = "doc_id long, item_id long, distance int, end_char long"


def normalised(text: str) -> str:
    return b" ".join(text.encode("utf-8", "replace").lower().split()).decode("utf-8")


def pieces(item: str, budget: int) -> Iterator[tuple[int, str]]:
    """budget + 1 pieces of nearly equal length that cover the item, with their starts."""
    n = budget + 1
    for i in range(n):
        a, b = i * len(item) // n, (i + 1) * len(item) // n
        yield a, item[a:b]


def follows(text: str, at: int, left: str, right: str) -> bool:
    """Whether the piece left + right, with one edit at most, can start at text[at]: one of its halves is unchanged.

    Some piece without edits has this for its successor in every passage within budget: take the last place at which edits
    so far minus pieces so far is greatest; from there on, j pieces have fewer than j edits.
    """
    if text.startswith(left, at):
        return True
    at += len(left)
    return text.startswith(right, at) or text.startswith(right, at - 1) or text.startswith(right, at + 1)


class Myers:
    """Least edit distance between one pattern and any substring of a text."""

    def __init__(self, pattern: str):
        self.m, self.peq = len(pattern), {}
        for i, c in enumerate(pattern):
            self.peq[c] = self.peq.get(c, 0) | 1 << i

    def best(self, text: str, limit: int) -> tuple[int, int]:
        """The distance and the end of its first occurrence; limit + 1 if there is none within limit."""
        mask, top = (1 << self.m) - 1, 1 << (self.m - 1)
        pv, mv, score, best, end = mask, 0, self.m, limit + 1, -1
        get = self.peq.get
        for i, c in enumerate(text):
            eq = get(c, 0)
            xh = (((eq & pv) + pv) ^ pv) | eq
            xv = eq | mv
            ph = mv | (mask & ~(xh | pv))
            mh = pv & xh
            if ph & top:
                score += 1
            elif mh & top:
                score -= 1
            ph = (ph << 1) & mask
            pv = ((mh << 1) & mask) | (mask & ~(xv | ph))
            mv = ph & xv
            if score < best:
                best, end = score, i + 1
                if not score:
                    break
        return best, end


class Matcher:
    """The items of one slice: automaton of pieces, and a verifier for each item."""

    def __init__(self, items: list[tuple[int, str]], rate: float = ERROR_RATE):
        self.items, where = [], {}
        for item_id, text in items:
            form = normalised(text)
            if not form:
                continue
            if len(form) < LEAST_CHARS:
                form, budget = f" {form} ", 0
            else:
                budget = int(rate * len(form))
            cut = list(pieces(form, budget))
            for (start, piece), (_, after) in zip(cut, [*cut[1:], (0, "")], strict=True):
                half = len(after) // 2
                where.setdefault(piece, []).append((len(self.items), start, after[:half], after[half:]))
            self.items.append((item_id, form, budget))
        self.automaton = ahocorasick.Automaton()
        for piece, at in where.items():
            self.automaton.add_word(piece, (len(piece), tuple(at)))
        if where:
            self.automaton.make_automaton()
        self.exact: dict[int, Myers] = {}

    def find(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(item_id, distance, end in the normalised text) of the best match of every item within its budget."""
        if not self.items:
            return
        form = f" {normalised(text)} "  # so that whole words at its ends are found
        windows: dict[int, list[tuple[int, int]]] = {}
        for last, (size, at) in self.automaton.iter(form):
            begin = last + 1 - size
            for i, start, left, right in at:
                if not follows(form, last + 1, left, right):
                    continue
                _, item, budget = self.items[i]
                a, b = max(0, begin - start - budget), min(len(form), begin - start + len(item) + budget)
                runs = windows.setdefault(i, [])
                if runs and a <= runs[-1][1]:
                    runs[-1] = (min(a, runs[-1][0]), max(b, runs[-1][1]))
                else:
                    runs.append((a, b))
        for i, runs in windows.items():
            item_id, item, budget = self.items[i]
            best, end = budget + 1, -1
            for a, b in runs:
                if (here := form.find(item, a, b)) >= 0:
                    found = (0, here + len(item) - a)
                else:
                    check = self.exact.get(i)
                    if check is None:
                        check = self.exact[i] = Myers(item)
                    found = check.best(form[a:b], budget)
                if found[0] < best:
                    best, end = found[0], a + found[1]
                if not best:
                    break
            if best <= budget:
                yield item_id, best, min(max(end - 1 - (item[0] == " "), 0), len(form) - 2)


def item_slices(benchmark: DataFrame) -> list[DataFrame]:
    """The benchmark in parts of about SLICE characters at most, by hashed id. A single larger item is a part by itself."""
    items = benchmark.select("item_id", "text").filter("item_id IS NOT NULL AND text IS NOT NULL")
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = 1 + 2 * chars // SLICE if chars > SLICE else 1
    return [items if n == 1 else items.filter(F.pmod(F.xxhash64("item_id"), F.lit(n)) == i) for i in range(n)]


def find_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """doc_id, item_id, distance, end_char (in the normalised text) for every document row and item found in it.

    Null or empty texts match nothing; items that are null, empty or without id are matched by nothing, those under
    LEAST_CHARS only unchanged and as whole words. Repeated rows give repeated results. Of equal distances the first end is
    given. Whole texts are searched. Of a benchmark of several slices one at a time is on the driver.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int32()), ("end_char", pa.int64())])

    parts = item_slices(benchmark)

    def one(items: DataFrame) -> DataFrame:
        held = docs.sparkSession.sparkContext.broadcast([(r[0], r[1]) for r in items.orderBy("item_id", "text").collect()])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(held.value, rate)
            for rows, texts in slices(batches):
                out = [(doc, *hit) for doc, raw in zip(rows.column(0).to_pylist(), texts, strict=True) if raw for hit in matcher.find(raw.decode("utf-8", "replace"))]
                columns = zip(*out, strict=True) if out else [[]] * 4
                yield pa.record_batch([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        found = docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
        return _ended(found, held) if len(parts) > 1 else found

    return reduce(DataFrame.unionByName, map(one, parts))


def _ended(found: DataFrame, held) -> DataFrame:
    """A pass that is stored, so that its slice can leave the driver before the next one comes."""
    made = stored(found, "pass")
    held.destroy()
    return made


def drop_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """The rows of docs, all columns, in which no item is found. Rows with a null or empty text stay, repeated rows alike."""
    parts = item_slices(benchmark)

    def one(rest: DataFrame, items: DataFrame) -> DataFrame:
        held = docs.sparkSession.sparkContext.broadcast([(r[0], r[1]) for r in items.orderBy("item_id", "text").collect()])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(held.value, rate)
            for rows, texts in slices(batches):
                yield rows.filter(pa.array([not raw or next(matcher.find(raw.decode("utf-8", "replace")), None) is None for raw in texts], pa.bool_()))

        kept = rest.mapInArrow(run, rest.schema)
        return _ended(kept, held) if len(parts) > 1 else kept

    return reduce(one, parts, docs)
