"""Secret scans: fixed patterns, and values of credential contexts whose
guess cost is high.

The cost of guessing a value is found by dynamic programming: the value is
cut into dictionary words (cost: rank), dates, repeats, keyboard walks,
sequences and brute-force spans such that the sum of the logarithms of their
guesses is least, over all segmentations.  The dictionary is the ranked
vocabulary of a public tokenizer (a parameter).  Words and dates have a
bounded longest length.  Any three characters or more of a walk, sequence or
repeat are a span; as its cost grows with the logarithm of its length, the
starts that can be best for a later end are few, and the others are dropped.
"""

from __future__ import annotations

import base64
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
KINDS = ("assign", "access", "hex", "credential")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # the runs of [0-9a-f]+ that have 16 characters or more
#: Contexts that name a credential, in any of the usual spellings; the value is the run of visible characters after it.
CONTEXT = re.compile(
    r"""(?:password|passwd|passphrase|pwd|secret|token|api_?key|access_?key|private_?key|credentials?|auth|login)["']?"""
    r"""\x20*[:=]\x20*["']?([^\x20\x09-\x0D"'<>,;]+)""", re.I | re.A)
#: No keyword with its sign is longer.
_KEYWORD = 16
_HINT = re.compile("pass|pwd|secret|token|key|credential|auth|login", re.I | re.A)
#: A value that takes at least 10 to this power guesses is a secret.
GUESSES_LOG10 = 10.0
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
LONGEST_WORD = 20
_DATE = re.compile(r"(?:19|20)\d\d(?:[-/._]?(?:0[1-9]|1[0-2])(?:[-/._]?(?:0[1-9]|[12]\d|3[01]))?)?"
                   r"|(?:0?[1-9]|[12]\d|3[01])[-/._](?:0?[1-9]|1[0-2])[-/._](?:19|20)?\d\d")
_LEET = str.maketrans("@4310$5!7", "aaeiossit")


def load_words(path: str = RANKS) -> dict[str, int]:
    """Words of three letters or more with their rank among words.  Fixed
    size: that of the vocabulary file, read on the driver."""
    found: dict[str, int] = {}
    with open(path, "rb") as f:
        for line in f:
            piece = base64.b64decode(line.split()[0])
            try:
                word = piece.decode("utf-8").strip().lower()
            except UnicodeDecodeError:
                continue
            if len(word) >= 3 and word.isalpha() and word not in found:
                found[word] = len(found) + 1
    return found


def _adjacent() -> set[str]:
    pairs = set()
    for row in ROWS:
        pairs |= {a + b for a, b in zip(row, row[1:])}
    for upper, lower in zip(ROWS, ROWS[1:]):  # columns
        pairs |= {a + b for a, b in zip(upper, lower)}
    return pairs | {p[::-1] for p in pairs}


ADJACENT = _adjacent()


def guess_cost(value: str, words: dict[str, int]) -> float:
    """log10 of the guesses of the cheapest segmentation of the whole value."""
    low = value.lower()
    plain = low.translate(_LEET)
    n = len(value)
    best = [0.0] + [math.inf] * n
    dates: dict[int, list[int]] = {}
    for start in range(n):
        if "0" <= value[start] <= "9":
            dates[start] = [end for end in range(start + 4, min(n, start + 10) + 1) if _DATE.fullmatch(value, start, end)]
    split = math.log10(2)  # each further span doubles the ways to combine them
    runs = [_Run(goes_on, base) for goes_on, base in _RUNS]
    for i in range(n):
        # best[i] is final here: every span that ends at i starts before it
        for run in runs:
            best[i] = min(best[i], run.ending(low, i, best, split))
        here = best[i] + (split if i else 0.0)
        # brute force: one character more, from an alphabet of its class
        c = value[i]
        size = 10 if c.isdigit() else 26 if c.isascii() and c.isalpha() else 33
        best[i + 1] = min(best[i + 1], best[i] + math.log10(size))
        for j in range(i + 3, min(n, i + LONGEST_WORD) + 1):
            rank = words.get(plain[i:j])
            if rank:
                cost = math.log10(rank + 1)
                if plain[i:j] != low[i:j]:
                    cost += math.log10(4)  # substituted characters
                if value[i:j] != low[i:j]:
                    cost += math.log10(2 if value[i:j].istitle() or value[i:j].isupper() else 8)
                best[j] = min(best[j], here + cost)
        for j in dates.get(i, ()):
            best[j] = min(best[j], here + math.log10(365 * 120))
    return min([best[n], *[run.ending(low, n, best, split) for run in runs]])


#: Walks, sequences and repeats: whether two characters go on, and log10 of the guesses of one character of length.
_RUNS = (
    (lambda a, b: a + b in ADJACENT, math.log10(94 * 4)),
    (lambda a, b: a.isalnum() and b.isalnum() and abs(ord(a) - ord(b)) == 1, math.log10(26 * 4)),
    (lambda a, b: a == b, math.log10(36)),
)


class _Run:
    """The cheapest span of one kind that ends at each position, asked for from left to right."""

    def __init__(self, goes_on, base: float):
        self.goes_on, self.base = goes_on, base
        self.starts: list[tuple[int, float]] = []  # of the present run, with the cost before the span

    def ending(self, low: str, end: int, best: list[float], split: float) -> float:
        if end < 3:
            return math.inf
        if not self.goes_on(low[end - 2], low[end - 1]):
            self.starts = []
            return math.inf
        start = end - 3
        if self.goes_on(low[start], low[start + 1]):
            self.starts.append((start, best[start] + (split if start else 0.0)))
        # a start leaves where a later one costs no more before its span (it stays the cheaper one), and where an
        # earlier one is as cheap already (the longer span's handicap only shrinks)
        kept: list[tuple[int, float]] = []
        for s, before in self.starts:
            while kept and kept[-1][1] >= before:
                kept.pop()
            cost = before + math.log10(end - s)
            if not kept or cost < kept[-1][1] + math.log10(end - kept[-1][0]):
                kept.append((s, before))
        self.starts = kept
        return min((before + self.base + math.log10(end - s) for s, before in kept), default=math.inf)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, by start, then kind."""
    found = []
    if _HINT.search(text):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def credential_spans(text: str, words: dict[str, int], base: list[tuple[int, int, int]],
                     least: float = GUESSES_LOG10) -> list[tuple[int, int, int]]:
    """Values in credential contexts that cost at least 10**least guesses and
    that base spans do not cover wholly.  Contexts inside a value that is
    left out are looked at, too."""
    if not _HINT.search(text):
        return []
    merged: list[list[int]] = []
    for s, _, e in base:
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    found = []
    at, m = 0, CONTEXT.search(text)
    while m:
        start, end = m.span(1)
        while at < len(merged) and merged[at][1] <= start:
            at += 1
        covered = at < len(merged) and merged[at][0] <= start and end <= merged[at][1]
        if not covered and guess_cost(m[1], words) >= least:
            found.append((start, 3, end))
            start = end
        elif covered:  # values of contexts inside end where this one does: only a context that ends there can go on
            start = max(start, end - _KEYWORD)
        m = CONTEXT.search(text, start)
    return found


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base string, spans string, n_credential long"


def scan_secrets(docs: DataFrame, path: str = RANKS, least: float = GUESSES_LOG10) -> DataFrame:
    """One row per document: counts by kind, ``base`` (spans of the fixed
    patterns, kind:start:end in code points, comma-joined) and ``spans``
    (with the credentials the guess cost adds).

    Null and empty texts have no span.  Rows are scanned by themselves, so
    ties, repeated rows and extra columns do not matter.
    """
    words = docs.sparkSession.sparkContext.broadcast(load_words(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text)
                more = credential_spans(text, words.value, base, least)
                kinds = [k for _, k, _ in base]
                rows.append((kinds.count(0), kinds.count(1), kinds.count(2), written(base),
                             written(sorted(base + more)), len(more)))
            cols = list(zip(*rows)) if rows else [()] * 6
            types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(cols, types)]],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base", "spans", "n_credential"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole("text").alias("text")).mapInArrow(run, SCHEMA)
