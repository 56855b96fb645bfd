"""Secret scan: fixed patterns, and two character Markov models compared by log-likelihood ratio.

The models are trained from labelled samples: strings known to be random (label 1) and ordinary identifiers (label 0).
A candidate is a run of 20 or more characters of an identifier alphabet, whose mean ratio per character has to reach a
margin. The patterns' spans always stay; the models add spans of kind "markov" that overlap none of them.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices

# The kinds in the order of the listing, their patterns and least lengths.
ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGNED = 6
KINDS = ("assign", "access", "hex", "markov")

CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}(?![A-Za-z0-9+/_=-])", re.ASCII)
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_markov long"

# Parts that the default sample of ordinary identifiers is put together from.
PARTS = (
    "get set is has make read write open close load save find add remove update create delete list item user name file path "
    "data value index count size time date key map node tree graph table row column page text word line char string number "
    "integer float double array buffer stream source target input output result error message event handler manager service "
    "client server request response session config option default context factory builder parser token reader writer model "
    "view controller module package version release build test spec mock utils helper common core base main init start stop "
    "run process thread task queue worker pool cache memory storage disk network socket port host address url link image color "
    "width height margin border padding left right top bottom center header footer content section article title label button "
    "form field check select submit cancel the and for with from into over under between language international information "
    "development government university organization communication responsibility"
).split()


def default_samples(n: int = 4000, seed: int = 7) -> list[tuple[str, int]]:
    """Labelled strings: 1 for random ones over several alphabets, 0 for identifiers put together from parts."""
    rng, out = random.Random(seed), []
    for i in range(n):
        kind = (ALPHABET[:62], ALPHABET[:64], ALPHABET[26:62], ALPHABET[:36], "0123456789abcdef", ALPHABET[:26], ALPHABET[26:52])[i % 7]
        out.append(("".join(rng.choice(kind) for _ in range(rng.randint(20, 64))), 1))
        words = [rng.choice(PARTS) for _ in range(rng.randint(3, 7))]
        style = i % 5
        joined = "_".join(words) if style == 0 else "-".join(words) if style == 1 else "".join(w.title() for w in words) if style == 2 else "/".join(words) if style == 3 else "_".join(words).upper()
        out.append((joined + (str(rng.randint(0, 2030)) if rng.random() < 0.25 else ""), 0))
    return out


class MarkovPair:
    """Order-1 character models of both classes as one matrix of log-likelihood ratios, with add-half smoothing."""

    def __init__(self, samples: Iterable[tuple[str, int]]):
        k = len(ALPHABET)
        self.code = {c: i for i, c in enumerate(ALPHABET)}
        counts = np.full((2, k + 1, k), 0.5)
        for text, label in samples:
            last = k
            for c in text:
                if (i := self.code.get(c)) is not None:
                    counts[label, last, i] += 1
                    last = i
        logs = np.log(counts / counts.sum(axis=2, keepdims=True))
        self.ratio = logs[1] - logs[0]

    def score(self, text: str) -> float:
        """Mean log-likelihood ratio per character: above 0, the random model explains the text better."""
        codes = np.fromiter(map(self.code.__getitem__, text), np.int64, len(text))
        return float(self.ratio[np.concatenate(([len(ALPHABET)], codes[:-1])), codes].mean())


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns, code points, end exclusive."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def markov_spans(text: str, models: MarkovPair, margin: float, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    out = []
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        if models.score(m.group()) >= margin and not any(s < b and a < e for s, _, e in taken):
            out.append((a, 3, b))
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan_secrets(docs: DataFrame, samples: list[tuple[str, int]] | None = None, margin: float = 0.35) -> DataFrame:
    """One row per row of docs (doc_id, text; other columns are left behind).

    A null text counts as empty: no spans, and the digest of an empty string. A null doc_id stays null. Repeated rows give
    repeated results, an empty table an empty result. Texts are scanned whole.
    """
    models = MarkovPair(default_samples() if samples is None else samples)
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_assign", "n_access", "n_hex")), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_markov", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches):
            out: list[list] = [[] for _ in range(6)]
            for raw in texts:
                text = (raw or b"").decode("utf-8", "replace")
                base = base_spans(text)
                more = markov_spans(text, models, margin, base)
                for k in range(3):
                    out[k].append(sum(s[1] == k for s in base))
                out[3].append(hashlib.sha256(joined(base).encode()).hexdigest())
                out[4].append(joined(sorted(base + more)))
                out[5].append(len(more))
            yield pa.record_batch([rows.column(0).cast(pa.int64()), *(pa.array(c, f.type) for c, f in zip(out, list(schema)[1:], strict=True))], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
