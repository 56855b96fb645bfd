"""Script-aware column functions: normalisation, mark order, damage rules and scores. Counts and rates stay in the JVM;
rewriting is done in Arrow batches, which is faster than array functions there."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from ..tables import COMMON_ENGLISH, EXTRA_BASES, GLUE, IMPOSSIBLE, IMPOSSIBLE_LETTERS, IMPOSTERS, INDEX, KINZI, LATIN, LETTER_OR_MARK, MARKS, PLACEHOLDERS, PRIORITY, SCRIPT, SPLIT, VOWELLESS
from .batches import arrow_rows, bounds, each, over_slices, sizes_of

BY_PRIORITY = "".join(sorted(PRIORITY, key=PRIORITY.__getitem__))
LETTERS = "abcdefghijklmnopqr"
SCAN_BASE = f"{PLACEHOLDERS}{INDEX}{EXTRA_BASES}"  # the hyphen comes first in its class


def script_text(text: Column, alphabet: str = SCRIPT) -> Column:
    return F.translate(text, LATIN, alphabet)


def strip_glue(text: Column) -> Column:
    return F.translate(text, GLUE, "")


_KEYS = sorted(IMPOSTERS, key=len, reverse=True)
_IMPOSTER = re.compile("|".join([*(k for k in _KEYS if len(k) > 1), f"[{''.join(k for k in _KEYS if len(k) == 1)}]"]))
_RUN = re.compile(f"(?<=[{INDEX}])[{BY_PRIORITY}]{{2,}}")


def imposters_cleaned(text: str) -> str:
    return _IMPOSTER.sub(lambda m: IMPOSTERS[m[0]], text)


def marks_reordered(text: str) -> str:
    return _RUN.sub(lambda m: _ordered(m[0]), text)


@lru_cache(1 << 16)
def _ordered(run: str) -> str:
    return "".join(sorted(set(run), key=PRIORITY.__getitem__))


def _normalized(text: str) -> str:
    text = text if unicodedata.is_normalized("NFC", text) else unicodedata.normalize("NFC", text)
    return _GLUED.sub("", text)


_GLUED = re.compile("[" + re.escape(GLUE) + "]+")


#: Longest match first, in one pass; what is put in is not looked at again. In Arrow batches: 9 s to 1 s against a JVM form
#: with array functions, over 1,000 documents full of imposters.
clean_imposters = each(imposters_cleaned)
#: Behind every base the run of marks, space and newline, each once, in order of priority.
reorder_marks = each(marks_reordered)
normalize_text = each(_normalized)
#: Normalised and reordered, in one step.
order_text = each(lambda t: marks_reordered(_normalized(t)))
#: Normalised, imposters replaced, reordered, in one step.
cleanup_text = each(lambda t: marks_reordered(imposters_cleaned(_normalized(t))))


_IMPOSSIBLE_RUN = re.compile("\u1031[\u102d\u102f\u1030\u1036]+")


def cleanup_marks(text: str) -> str:
    """Reordered, and vowels dropped that cannot follow the e vowel."""
    return _IMPOSSIBLE_RUN.sub("\u1031", marks_reordered(text))


def drop_impossible_marks(text: Column) -> Column:
    return F.regexp_replace(text, "\u1031[\u102d\u102f\u1030\u1036]+", "\u1031")


def collapse_overprint(text: Column) -> Column:
    """A piece of at most nine characters that is one unit of up to three, repeated, is that unit."""
    return F.when(F.length(text) <= 9, F.regexp_replace(text, r"^(.{1,3}?)\1+$", "$1")).otherwise(text)


def myanmar_ratio(text: Column) -> Column:
    return F.when(F.length(text) > 0, F.regexp_count(text, F.lit("[\u1000-\u109f]")) / F.length(text)).otherwise(0.0)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def _table(chars: str) -> np.ndarray:
    """Membership by code point of the characters of a regular expression class."""
    pattern = re.compile(chars if chars.startswith("[") else f"[{chars}]")
    return np.array([bool(pattern.match(chr(i))) for i in range(LIMIT)] + [False])


#: Code points from here on are in no class.
LIMIT = 0x2100
IS_MARK, IS_INDEX, IS_SCAN_BASE, IS_SPLIT, IS_SIDE = map(_table, (MARKS, INDEX, SCAN_BASE, SPLIT, LETTER_OR_MARK))
IS_CONSONANT, IS_DIGIT, IS_DEBRIS = map(_table, ("\u1000-\u1021", "\u1040-\u1049", MARKS + "\u1039"))
IS_BREAK = IS_SPLIT.copy()  # what Python's regular expressions call a blank, too
IS_SPLIT[[0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0]] = IS_SPLIT[0x1680] = IS_SPLIT[0x2000:0x200B] = IS_SPLIT[0x2028:0x202A] = IS_SPLIT[[0x202F, 0x205F]] = False
RANK = np.zeros(LIMIT + 1, np.int64)
for _mark, _rank in PRIORITY.items():
    RANK[ord(_mark)] = _rank
_PAIRS = [tuple(map(_table, re.findall(r"\[[^]]*\]|.", p))) for p in IMPOSSIBLE]


class Codes:
    """The code points of a batch of texts as one array, a newline behind each text, and the row of every code point."""

    def __init__(self, texts: list[str | None]):
        plain = [t or "" for t in texts]
        self.n = len(plain)
        raw = np.frombuffer(("\n".join(plain) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
        self.raw = raw
        self.at = np.minimum(raw, LIMIT).astype(np.int64)
        self.row = np.repeat(np.arange(self.n), [len(t) + 1 for t in plain]) if self.n else np.zeros(len(raw), np.int64)
        self.index = np.arange(len(raw))

    def count(self, hit: np.ndarray) -> np.ndarray:
        return np.bincount(self.row[hit], minlength=self.n)

    def attached(self, bases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Marks that follow a base with nothing but marks between, and where each position's last other character is."""
        mark = IS_MARK[self.at]
        last = np.maximum.accumulate(np.where(mark, 0, self.index))
        return mark & bases[self.at[last]], last

    def followed(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Positions of the first class with the second behind them."""
        return np.r_[first[self.at[:-1]] & second[self.at[1:]], False]


def _one(char: str) -> np.ndarray:
    return _table(char)


_VIRAMA, _KILLER, _NGA = map(_one, ("\u1039", "\u103a", "\u1004"))
COUNTS = ("marks", "attached", "pairs", "descents", "repeats")


def _mark_counts(texts: list[str | None]) -> pa.Array:
    c = Codes(texts)
    attached, last = c.attached(IS_INDEX)
    rank = RANK[c.at]
    second = attached & np.r_[False, IS_MARK[c.at[:-1]]]
    at = np.flatnonzero(attached)
    key = np.sort(last[at] * 32 + rank[at])
    again = np.flatnonzero(key[1:] == key[:-1])
    descents, repeats = c.count(second & (np.r_[0, rank[:-1]] > rank)), np.bincount(c.row[key[again] // 32], minlength=c.n)
    found = (c.count(IS_MARK[c.at]), c.count(attached), c.count(second), descents, repeats)
    return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in found], COUNTS)


#: struct of marks, attached, pairs, descents, repeats: what the rates are made of. One numpy pass over each slice of texts.
mark_counts = over_slices(_mark_counts, StructType([StructField(c, LongType()) for c in COUNTS]))


def score(counts: Column) -> dict[str, Column]:
    """marks, orphan, disorder, duplicate and score of a column of mark_counts; all 0 without marks."""
    rate = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    orphan, disorder = rate(counts["marks"] - counts["attached"], counts["marks"]), rate(counts["descents"], counts["pairs"])
    return {"marks": counts["marks"], "orphan": orphan, "disorder": disorder, "duplicate": rate(counts["repeats"], counts["attached"]), "score": F.when(counts["marks"] > 0, 1 - F.greatest(orphan, disorder)).otherwise(0.0)}


_LATIN_RUN = re.compile("[A-Za-z]+")
_VOWEL, _FOUR, _LONE_Q = re.compile("[aeiouy]"), re.compile(r"(.)\1\1\1"), re.compile("q(?=[^u])")
# pairs overlap, so each position is looked at: a match of length 0 in front of a pair
_NO_PAIR = re.compile("(?=" + "|".join(IMPOSSIBLE_LETTERS.split()) + ")")
_COMMON, _VOWELLESS = frozenset(COMMON_ENGLISH.split()), frozenset(VOWELLESS.split())


def run_facts(run: str) -> tuple[bool, bool, int]:
    """Whether a run of letters is a word, a common one, and its faults."""
    low, n = run.lower(), len(run)
    vowelless = n >= 3 and not (n <= 6 and run.isupper()) and low not in _VOWELLESS and not _VOWEL.search(low)
    faults = vowelless + 2 * bool(_FOUR.search(low)) + len(_NO_PAIR.findall(low)) + len(_LONE_Q.findall(low)) + (n > 16) + (n > 20) + 2 * (n > 45)
    return n >= 2, n >= 2 and low in _COMMON, faults


_facts = lru_cache(1 << 16)(run_facts)
LIKENESS = StructType([StructField("letters", IntegerType()), StructField("runs", IntegerType()), StructField("common_ratio", DoubleType()), StructField("violation_rate", DoubleType()), StructField("max_run", IntegerType()), StructField("has_spaces", BooleanType())])


def likeness_of(text: str | None) -> tuple[int, int, float, float, int, bool]:
    """letters, runs, common_ratio, violation_rate, max_run and has_spaces of a text; every distinct run is judged once."""
    runs = _LATIN_RUN.findall(text or "")
    letters = words = common = bad = longest = 0
    for run, times in Counter(runs).items():
        n = len(run)
        word, known, faults = _facts(run) if n <= 64 else run_facts(run)
        letters, words, common, bad, longest = letters + n * times, words + word * times, common + known * times, bad + faults * times, max(longest, n)
    return letters, len(runs), common / words if words else 0.0, bad / letters if runs else 0.0, longest, len(runs) > 1 and " " in (text or "")


#: struct of letters, runs, common_ratio, violation_rate, max_run and has_spaces. In the JVM, array functions looked at every run alone.
likeness = over_slices(lambda texts: pa.array([dict(zip(LIKENESS.names, likeness_of(t), strict=True)) for t in texts], to_arrow_type(LIKENESS)), LIKENESS)


def english_likeness(text: Column) -> dict[str, Column]:
    """What english_verdict needs of a text, by name: fields of one Arrow function."""
    c = likeness(text)
    return {n: c[n] for n in LIKENESS.names}


def english_verdict(c: dict[str, Column]) -> Column:
    """english, not-english, or null where there is too little to tell."""
    ratio, rate = c["common_ratio"], c["violation_rate"]
    yes = ((ratio >= 0.15) & (rate <= 0.02) & (c["max_run"] <= 20)) | ((ratio >= 0.08) & c["has_spaces"] & (rate <= 0.01) & (c["max_run"] <= 16))
    no = ((rate > 0.03) & (ratio < 0.05)) | (~c["has_spaces"] & (c["max_run"] > 20) & (ratio < 0.05)) | ((ratio > 0) & (ratio < 0.05) & (rate > 0.015)) | ((ratio == 0) & (c["letters"] >= 24) & (c["runs"] >= 4))
    return F.when(c["letters"] >= 12, F.when(yes, "english").when(no, "not-english"))


def words(text: Column) -> Column:
    return F.filter(F.split(text, f"[{SPLIT}]+"), lambda x: x != "")


def scan_hits(c: Codes) -> dict[str, np.ndarray]:
    """For each damage rule whether it hits at a position. Of impossible pairs a position counts once for each pair."""
    loose = IS_MARK[c.at] & ~c.attached(IS_SCAN_BASE)[0]
    impossible = np.zeros(len(c.at), np.int64)
    for first, second in _PAIRS:
        hit = c.followed(first, second)
        if (first & second).any():  # matches do not overlap: every second one of a run
            starts = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], c.index, 0))
            hit &= (c.index - starts) % 2 == 0
        impossible += hit
    ends = np.r_[IS_CONSONANT[c.at[1:]], False]
    kinzi = np.zeros(len(c.at), bool)
    kinzi[:-2] = _NGA[c.at[:-2]] & _KILLER[c.at[1:-1]] & _VIRAMA[c.at[2:]] & ~ends[2:]
    split = IS_SPLIT[c.at]
    starts = ~split & np.r_[True, split[:-1]]
    clean = np.cumsum(~split & ~IS_DEBRIS[c.at])
    stop = np.searchsorted(np.flatnonzero(split), np.flatnonzero(starts))
    stray = np.zeros(len(c.at), bool)
    begin = np.flatnonzero(starts)
    stray[begin] = clean[np.flatnonzero(split)[stop]] == clean[begin] - (~IS_DEBRIS[c.at[begin]])
    side = IS_SIDE[c.at]
    digit = IS_DIGIT[c.at] & np.r_[False, side[:-1]] & np.r_[side[1:], False]
    return {"orphan": loose, "impossible": impossible + kinzi, "stray": stray, "digit": digit, "virama": _VIRAMA[c.at] & ~ends}


RULES = ("orphan", "impossible", "stray", "digit", "virama")


def _scan_totals(texts: list[str | None]) -> pa.Array:
    c = Codes(texts)
    hits = scan_hits(c)
    return pa.StructArray.from_arrays([pa.array(np.bincount(c.row, hits[r], c.n).astype(np.int32)) for r in RULES], RULES)


#: struct of the hits of each damage rule in one text; numpy over slices of texts.
scan_totals = over_slices(_scan_totals, StructType([StructField(r, IntegerType()) for r in RULES]))


_REPEAT = re.compile(r"([\u1000-\u109f]{2,4})\1{2,}")


def _repeated(c: Codes, texts: list[str | None], first: np.ndarray) -> Iterator[int]:
    """Where a unit of two to four characters stands three times or more, left to right; each search begins where it can succeed."""
    script = (c.raw >= 0x1000) & (c.raw <= 0x109F)
    may = np.zeros(len(c.raw), bool)
    for n in (2, 3, 4):
        if len(c.raw) > 3 * n:
            same = np.cumsum(np.r_[0, (c.raw[:-n] == c.raw[n:]) & script[:-n]])
            may[: len(same) - 2 * n] |= same[2 * n :] - same[: -2 * n] == 2 * n
    end = -1
    for at in np.flatnonzero(may).tolist():
        if at >= end:
            row = int(c.row[at])
            if m := _REPEAT.match(texts[row] or "", at - int(first[row])):
                end = at + m.end() - m.start()
                yield at


def hits_of(texts: list[str | None]) -> tuple[Codes, dict[str, np.ndarray]]:
    """Every hit of the six damage rules by rule and place: rule (of SIX), at (of all texts), row, pos, times, line, and the word from start to end."""
    c = Codes(texts)
    first = np.searchsorted(c.row, np.arange(c.n))
    hits = scan_hits(c)
    places = [np.flatnonzero(hits[r]) for r in RULES]
    times = [hits[r][p].astype(np.int64) for r, p in zip(RULES, places, strict=True)]
    places.append(np.fromiter(_repeated(c, texts, first), np.int64))
    times.append(np.ones(len(places[-1]), np.int64))
    at, row = np.concatenate(places), c.row[np.concatenate(places)]
    breaks = np.flatnonzero(IS_BREAK[c.at] | (c.raw == 0x3000))  # the newline behind each text is one
    after = np.searchsorted(breaks, at)
    start = np.maximum(np.maximum(np.where(after > 0, breaks[after - 1] + 1, 0), at - 4096), first[row])
    end = np.minimum(breaks[after], start + WORD) if len(breaks) else start
    lone = start >= breaks[after] if len(breaks) else start > start
    lines = np.cumsum(np.r_[0, c.at == 10])
    return c, {
        "rule": np.repeat(np.arange(len(SIX)), [len(p) for p in places]), "at": at, "row": row, "pos": at - first[row], "times": np.concatenate(times),
        "line": 1 + lines[at] - lines[first[row]], "start": np.where(lone, at, start) - first[row], "end": np.where(lone, at + 1, end) - first[row],
    }


#: The longest reported word and context.
WORD, CONTEXT = 27, 110
SIX = (*RULES, "repeat")
_SEEN = re.compile(r"\S")
HIT = StructType([StructField("rule", StringType()), StructField("pos", IntegerType()), StructField("word", StringType()), StructField("line", IntegerType()), StructField("context", StringType())])


def _scan_rows(texts: list[str | None]) -> pa.Array:
    _, h = hits_of(texts)
    found: list[list[dict]] = [[] for _ in texts]
    for rule, row, pos, times, line, start, end in zip(*(h[k].tolist() for k in ("rule", "row", "pos", "times", "line", "start", "end")), strict=True):
        t = texts[row] or ""
        found[row] += [{"rule": SIX[rule], "pos": pos, "word": t[start:end], "line": line, "context": context_at(t, pos)}] * times
    return pa.array(found, to_arrow_type(ArrayType(HIT)))


def context_at(text: str, at: int, size: int = CONTEXT) -> str:
    """The start of the line around a position, without outer blanks."""
    a, b = text.rfind("\n", 0, at) + 1, text.find("\n", at)
    b = b if b > 0 else len(text)
    if (m := _SEEN.search(text, a, b)) is None:
        return ""
    piece = text[m.start() : min(b, m.start() + size)]
    return piece if _SEEN.search(text, m.start() + size, b) else piece.rstrip()


#: Every hit of the six damage rules: rule, offset, word, line number and context.
scan_rows = over_slices(_scan_rows, ArrayType(HIT))
#: Words that a task counts before it passes them on.
MOST_WORDS = 1 << 16


def scan_words(docs: DataFrame) -> DataFrame:
    """lang, rule, word, n, first (doc_id, pos, line, context) of the hits in documents (lang, doc_id, t); hits are counted by word
    before they are moved, and only the first of a word has its line and context looked up."""
    names = ("lang", "rule", "word", "n", "doc_id", "pos", "line", "context")
    schema = pa.schema(list(zip(names, (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string()), strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        for batch in batches:
            for a, b in bounds(sizes_of(batch.column(2))):
                _count_words(held, *(batch.column(i).slice(a, b - a).to_pylist() for i in range(3)))
                if len(held) > MOST_WORDS:
                    yield from arrow_rows(((k[0], SIX[k[1]], k[2], *v) for k, v in held.items()), schema)
                    held.clear()
        yield from arrow_rows(((k[0], SIX[k[1]], k[2], *v) for k, v in held.items()), schema)

    kinds = "lang string, rule string, word string, n long, doc_id long, pos int, line int, context string"
    counted = docs.select("lang", F.col("doc_id").cast("long").alias("doc_id"), "t").mapInArrow(run, kinds)
    return counted.groupBy("lang", "rule", "word").agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "pos", "line", "context")).alias("first"))


def _count_words(held: dict[tuple, list], langs: list, ids: list, texts: list[str | None]) -> None:
    """Adds the hits of a slice to the words held: (lang, rule, word) to n, doc_id, pos, line, context."""
    _, h = hits_of(texts)
    order = np.lexsort((h["at"], h["start"], h["row"], h["rule"]))
    if not len(order):
        return
    h = {k: v[order] for k, v in h.items()}
    same = (h["rule"][1:] == h["rule"][:-1]) & (h["row"][1:] == h["row"][:-1]) & (h["start"][1:] == h["start"][:-1]) & (h["end"][1:] == h["end"][:-1])
    begin = np.flatnonzero(np.r_[True, ~same])
    n = np.add.reduceat(h["times"], begin).tolist()
    rank = lambda i: -math.inf if i is None else i
    for times, rule, row, pos, line, start, end in zip(n, *(h[k][begin].tolist() for k in ("rule", "row", "pos", "line", "start", "end")), strict=True):
        text = texts[row] or ""
        key = (langs[row], rule, text[start:end])
        old = held.get(key)
        if old is None:
            held[key] = [times, ids[row], pos, line, context_at(text, pos)]
            continue
        old[0] += times
        here, there = (rank(ids[row]), pos), (rank(old[1]), old[2])
        if here < there or here == there and (line, context_at(text, pos)) < (old[3], old[4]):
            old[1:] = ids[row], pos, line, context_at(text, pos)


def repeats(text: Column) -> Column:
    """A unit of two to four characters three times or more back to back."""
    return _count(text, r"([\x{1000}-\x{109f}]{2,4})\1{2,}")
