"""Mends of decoded script text: look-alike digits, visual order, pre-base marks, stored order, and the modes they make up.

Each is a function of one text; column() makes an Arrow function of any of them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Collection
from functools import lru_cache

from pyspark.sql import Column

from ..tables import INDEX, MARKS, MEDIAL_HOSTS, PRIORITY
from .batches import each
from .script import _normalized, cleanup_marks, imposters_cleaned, marks_reordered
from .text_udf import breaks

ZERO, WA, SEVEN, RA, E_VOWEL, MEDIAL_RA = "၀", "ဝ", "၇", "ရ", "ေ", "ြ"
KINZI = "င်္"
_LETTER = f"{INDEX}္{MARKS}"
_DIGIT = "၀-၉"
_CONSONANT = "က-အ"

#: A ra beside a digit is the digit seven, unless it begins a word.
_WRITTEN_RA = re.compile(f"(?<=[{_DIGIT}]){RA}(?![{_LETTER}](?<!{RA}))|{RA}(?=[{_DIGIT}])")


def column(f: Callable[[str], str]) -> Callable[[Column], Column]:
    """f as an Arrow function of a text column; nulls stay."""
    return each(f)


def digits_mended(text: str) -> str:
    """Zero to wa from left to right, where what was mended counts as a letter; then ra to seven, three rounds at most."""
    text = _ZEROS.sub(_zeros_mended, text)
    for _ in range(3):
        new = _WRITTEN_RA.sub(SEVEN, text)
        if new == text:
            break
        text = new
    return text


def _zeros_mended(m: re.Match[str]) -> str:
    text, out, before = m.string, [], m.string[max(0, m.start() - 1) : m.start()]
    for i in range(m.start(), m.end()):
        after = text[i + 1 : i + 2]
        inside = bool(before) and bool(_IS_LETTER.match(before)) and bool(_IS_LETTER.match(after))
        opens = not (before and (_IS_LETTER.match(before) or _IS_DIGIT.match(before))) and bool(_IS_CONSONANT.match(after))
        before = WA if (after and after in MARKS) or inside or opens else ZERO
        out.append(before)
    return "".join(out)


_ZEROS = re.compile(f"{ZERO}+")
_IS_LETTER, _IS_DIGIT, _IS_CONSONANT = (re.compile(f"[{x}]") for x in (_LETTER, _DIGIT, _CONSONANT))
_LEADING = re.compile(f"([{MEDIAL_RA}{E_VOWEL}]+)([{_CONSONANT}{ZERO}၈{SEVEN}])({KINZI})?((?:္[{_CONSONANT}])*)")
_LATE_KINZI = re.compile(f"([{_CONSONANT}][ါ-ှ]*)({KINZI})(?![{_CONSONANT}])")
_EARLY_E = re.compile(f"({E_VOWEL})([ျွဲှ္ြ]+)")
_SPLIT_KINZI = re.compile(f"([{_CONSONANT}])([{_CONSONANT}])({KINZI})")


def logical_order(text: str) -> str:
    """Text in the order of the eye to the order of speech: leading vowels and medials, kinzi, then digits."""
    text = text.replace("​", "")
    text = _LEADING.sub(lambda m: (m[3] or "") + m[2] + m[4] + m[1], text)
    text = _LATE_KINZI.sub(r"\2\1", text)
    text = _EARLY_E.sub(r"\2\1", text)
    text = _SPLIT_KINZI.sub(r"\1\3\2", text)
    return digits_mended(text.replace("ဦး", "ဦး"))


_PREBASE = frozenset((E_VOWEL, MEDIAL_RA))
_MEDIALS = frozenset("ျြွှ")
_IS_INDEX = re.compile(f"[{INDEX}]").match


def _spells(text: str, at: int, syllables: Collection[str]) -> bool:
    """Whether the cluster at a consonant, with e behind it and one more consonant at most, is a known syllable."""
    stop, second = at + 1, False
    while stop < len(text) and text[stop] not in " \n":
        if _IS_INDEX(text[stop]):
            if second:
                break
            second = True
        stop += 1
    return not syllables or marks_reordered(text[at] + E_VOWEL + text[at + 1 : stop]) in syllables


def _leads(text: str, at: int, stop: int, syllables: Collection[str]) -> bool:
    """Whether the pre-base marks from at to stop belong to the consonant behind them and not to what is before them."""
    if stop >= len(text) or not _IS_INDEX(text[stop]):
        return False
    if at == 0:
        return True
    mark, before = text[at], text[at - 1]
    if _IS_INDEX(before):
        if mark in _MEDIALS and before not in MEDIAL_HOSTS.get(mark, ""):
            return True
        return mark == E_VOWEL and _spells(text, stop, syllables)
    rank = PRIORITY.get(before)
    return rank is None or PRIORITY[mark] < rank


def prebase_moved(text: str, syllables: Collection[str] = frozenset()) -> str:
    """Runs of pre-base marks that lead a cluster stand behind its consonant. Syllables, if given, can refuse a move."""

    def moved(m: re.Match[str]) -> str:
        stop = m.end() - 1
        for i in range(m.start(), stop):
            if _leads(text, i, stop, syllables):
                return text[m.start() : i] + text[stop] + text[i:stop]
        return m[0]

    return _PREBASE_RUN.sub(moved, text)


_PREBASE_RUN = re.compile(f"[{E_VOWEL}{MEDIAL_RA}]+[{INDEX}]")
_STORED = frozenset((E_VOWEL, *_MEDIALS))


_ALL, _REST = "".join(PRIORITY), "".join(c for c in PRIORITY if c not in _STORED)
_KEPT = f"[{INDEX}][{_REST}]*+[{''.join(sorted(_STORED))}][{_ALL}]*+"
#: What can be unmixed by itself: clusters with stored marks, up to one without any, which carries nothing on, as a character that
#: is no base and no mark does; and clusters of two other marks or more. Nothing else changes.
_STRETCH = re.compile(f"(?:[{''.join(sorted(_STORED))}][{_ALL}]*+|{_KEPT})(?:{_KEPT})*+(?:[{INDEX}][{_REST}]*+)?+|[{INDEX}][{_REST}]{{2,}}+")
#: The longest stretch that is remembered.
_SHORT = 64


def stored_order_unmixed(text: str) -> str:
    """Clusters whose marks were stored in the order of typing: marks out of order are carried to the next base."""
    return _STRETCH.sub(_stretch_unmixed, text)


def _stretch_unmixed(m: re.Match[str]) -> str:
    stretch = m[0]
    return _remembered(stretch) if len(stretch) <= _SHORT else _unmixed(stretch)


@lru_cache(1 << 16)
def _remembered(stretch: str) -> str:
    return _unmixed(stretch)


def _unmixed(text: str) -> str:
    out, carry, i, n = [], "", 0, len(text)
    while i < n:
        if not _IS_INDEX(text[i]):
            stop = i
            while stop < n and text[stop] in _STORED:
                stop += 1
            if stop > i and stop < n and _IS_INDEX(text[stop]):
                carry, i = carry + text[i], i + 1
            else:
                out += (carry, text[i])
                carry, i = "", i + 1
            continue
        base, marks, carry, behind = text[i], list(carry), "", False
        highest = max((PRIORITY[m] for m in marks), default=0)
        i += 1
        while i < n and not _IS_INDEX(text[i]) and text[i] in PRIORITY:
            mark, rank = text[i], PRIORITY[text[i]]
            if mark in _PREBASE and rank < highest:
                stop = i
                while stop < n and text[stop] in _STORED:
                    stop += 1
                carry, i = text[i:stop], stop
                break
            behind |= mark == MEDIAL_RA
            if mark not in marks:
                marks.append(mark)
            highest = max(highest, rank)
            i += 1
        if behind and i < n and _IS_INDEX(text[i]) and E_VOWEL in marks:
            carry = "".join(m for m in marks if m in _MEDIALS)
            marks = [m for m in marks if m not in _MEDIALS]
        out += (base, *sorted(marks, key=PRIORITY.__getitem__))
    return "".join([*out, carry])


# ---- modes ----

_ENGLISH = re.compile(r"[A-Za-z]+(?:[ '-]+[A-Za-z]+)*")
_BLOCKS = re.compile(rf"({_ENGLISH.pattern})|([0-9]+)|([{_DIGIT}]+)")
_BRACED = re.compile(r"(\{[^{}]*\})")


def wrapped_blocks(text: str) -> str:
    """English, Latin digits and script digits in braces."""
    return _BLOCKS.sub(lambda m: "{" + m[0] + "}", text)


def english_dropped(text: str) -> str:
    return _ENGLISH.sub("", text)


def outside_braces(text: str, f: Callable[[str], str]) -> str:
    """f over what is not in braces."""
    return "".join(x if x.startswith("{") else f(x) for x in _BRACED.split(text))


MODES: dict[str, Callable[[str], str]] = {
    "normalize": lambda t: marks_reordered(imposters_cleaned(_normalized(t))),
    "wrapped": lambda t: wrapped_blocks(marks_reordered(imposters_cleaned(_normalized(t)))),
    "no_english": lambda t: marks_reordered(imposters_cleaned(english_dropped(_normalized(t)))),
    "ordered": lambda t: cleanup_marks(prebase_moved(_normalized(t))),
}


def normalized(text: Column, mode: str = "normalize", extra: Callable[[str], str] | None = None) -> Column:
    """A mode by name, behind it a caller's own function."""
    f = MODES[mode]
    return column(f if extra is None else lambda t: extra(f(t)))(text)


# ---- repairs with a dictionary ----

_END_DIGITS = re.compile(f"^([{_DIGIT}]+)([^{_DIGIT}]+)$|^([^{_DIGIT}]+)([{_DIGIT}]+)$")


def number_unglued(token: str, words: Collection[str], longest: int) -> str:
    """A token with digits at exactly one end, parted there if the rest is made of words."""
    m = _END_DIGITS.match(token)
    if m is None or breaks(token, words, longest):
        return token
    a, b = (m[1], m[2]) if m[1] else (m[3], m[4])
    word = b if m[1] else a
    return f"{a} {b}" if breaks(word, words, longest) else token


def repair_tally(pairs: Collection[tuple[str, str]]) -> list[tuple[str, str, int]]:
    """(from, to, times), most frequent first, of repairs that changed something."""
    found = Counter((a, b) for a, b in pairs if a != b)
    return [(a, b, n) for (a, b), n in sorted(found.items(), key=lambda x: (-x[1], x[0]))]


def cleaner_reading(text: str, other: str, faults: Callable[[str], int]) -> str:
    """The other reading only where it has strictly fewer faults and no more characters lost than it mends."""
    return other if faults(other) < faults(text) and len(other) >= len(text) - (faults(text) - faults(other)) else text


def lines_mended(text: str, mend: Callable[[str], str], faults: Callable[[str], int]) -> str:
    """Each line by the reading that is strictly cleaner."""
    return "\n".join(cleaner_reading(x, mend(x), faults) for x in text.split("\n"))
