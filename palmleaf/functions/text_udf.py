"""Arrow functions for what has no JVM form: ordered rules, dictionary word-break, encoding detection, homoglyph repair."""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

from .batches import each

RUN = re.compile("[\u1000-\u1049\u105a-\u109f]+")


def convert(text: Column, rules: list[tuple[str, str]]) -> Column:
    """Ordered substitutions (pattern, replacement with \\N), such as an encoding conversion's, in one pass over Arrow batches."""
    compiled = [(re.compile(a), b) for a, b in rules]

    def one(t: str) -> str:
        for pattern, to in compiled:
            t = pattern.sub(to, t)
        return t

    return each(one)(text)


def breaks(token: str, words: frozenset[str], longest: int) -> bool:
    """Whether the token is a sequence of words."""
    good = [True] + [False] * len(token)
    for i in range(1, len(token) + 1):
        good[i] = any(good[j] and token[j:i] in words for j in range(max(0, i - longest), i))
    return good[-1]


def unknown_tokens(text: Column, words: Iterable[str], pattern: re.Pattern[str] = RUN) -> Column:
    """Tokens of the text that no sequence of words makes up, in order."""
    known = frozenset(words)
    longest = max(map(len, known), default=0)
    memo: dict[str, bool] = {}

    def one(t: str) -> list[str]:
        out = []
        for token in pattern.findall(t):
            if token not in memo:
                if len(memo) > 1 << 18:
                    memo.clear()
                memo[token] = breaks(token, known, longest)
            if not memo[token]:
                out.append(token)
        return out

    return each(one, ArrayType(StringType()))(text)


def repaired(text: Column, words: Iterable[str], pairs: list[tuple[str, str]], pattern: re.Pattern[str] = RUN) -> Column:
    """Unknown tokens with exactly one swap of look-alikes that the dictionary resolves are replaced by it."""
    known = frozenset(words)
    longest = max(map(len, known), default=0)

    def variants(token: str) -> set[str]:
        out = set()
        for a, b in pairs:
            for x, y in ((a, b), (b, a)):
                if x in token:
                    out.add(token.replace(x, y))
                    out |= {token[:i] + y + token[i + len(x) :] for i in range(len(token)) if token.startswith(x, i)}
        return out - {token}

    def fix(token: str) -> str:
        if breaks(token, known, longest):
            return token
        found = [v for v in variants(token) if breaks(v, known, longest)]
        return found[0] if len(found) == 1 else token

    return each(lambda t: pattern.sub(lambda m: fix(m.group()), t))(text)


def segmented(text: Column, syllables: Iterable[str]) -> Column:
    """Longest syllables of a supplied list, two spaces between them; characters of no syllable stand alone."""
    known = frozenset(syllables)
    longest = max(map(len, known), default=1)

    def one(t: str) -> str:
        out, i = [], 0
        while i < len(t):
            n = next((n for n in range(min(longest, len(t) - i), 0, -1) if t[i : i + n] in known), 1)
            if t[i : i + n].strip():
                out.append(t[i : i + n])
            i += n
        return "  ".join(out)

    return each(one)(text)


def transition_probability(text: Column, alphabet: str, matrix: np.ndarray) -> Column:
    """Logistic of the negative sum of log-likelihood ratios of adjacent characters; the last row and column of the matrix are text
    borders and other characters, NaN is no evidence, and a text without any has negative infinity."""
    code, border = {c: i for i, c in enumerate(alphabet)}, len(alphabet)

    def one(t: str) -> float:
        at = np.array([border, *(code.get(c, border) for c in t), border])
        told = matrix[at[:-1], at[1:]]
        told = told[~np.isnan(told)]
        if (at == border).all() or not len(told):
            return float("-inf")
        return float(1 / (1 + np.exp(np.clip(told.sum(), -700, 700))))

    return each(one, DoubleType())(text)


def encoding_label(probability: Column, threshold: float = 0.5) -> Column:
    """ZAWGYI, UNICODE or UNKNOWN from a transition probability; negative infinity stands for text without known characters."""
    return F.when(probability == float("-inf"), "UNKNOWN").when(probability > threshold, "ZAWGYI").otherwise("UNICODE")
