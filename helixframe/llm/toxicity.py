"""Toxicity by a subsequence string kernel SVM with Nystroem landmarks.

Two strings are alike by the three-character subsequences they share; a
subsequence that spans m characters counts DECAY ** m in either string, and
spans up to SPAN characters count, so an insult with gaps or inserted
characters keeps most of its likeness.  A unit is a word, or a run of single
characters between blanks ("i d i o t").  Each unit's kernel is scaled by
its length.  Labelled documents are bags of units, texts are not cut into
sentences: in a toxic document its most suspicious unit stands for it (chosen
anew in each round by the machine of the round before), and every unit of
clean documents is clean.

The machine is trained on the driver from a bounded sample of labelled rows
(the only bounded part).  Units are mapped to their kernels with the
landmarks, whitened by the landmarks' own kernel matrix, and a linear SVM is
fitted there.  Its decision is linear in the subsequences, so it folds into
one table of weights by subsequence; documents are scored against that
table, all characters of a batch at once in numpy, over their whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remainder, whole

#: Alphabet of 32: 0 white space, 1-26 letters, 27 a unit's start, 28 digits, 29 other letters, 30 other signs.
CODES = 32
SPAN = 5
DECAY = 0.6
#: Labelled documents of either class that are learnt from, at most (smallest hashes of their ids).
SAMPLE = 1500
#: Clean units and landmarks, at most.
CLEAN_UNITS = 20_000
LANDMARKS = 256
ROUNDS = 3
_START = 27
_PAIRS = [(j, k) for j in range(1, SPAN) for k in range(j + 1, SPAN)]
#: Accented letters count as their base letter, other letters as 29.
_FOLD = {"à": "a", "á": "a", "â": "a", "ã": "a", "ä": "a", "å": "a", "ç": "c", "è": "e", "é": "e", "ê": "e", "ë": "e",
         "ì": "i", "í": "i", "î": "i", "ï": "i", "ñ": "n", "ò": "o", "ó": "o", "ô": "o", "õ": "o", "ö": "o", "ù": "u",
         "ú": "u", "û": "u", "ü": "u", "ý": "y", "ÿ": "y", "ß": "s"}


def _code_table() -> np.ndarray:
    """Code of each code point below 0x250; other code points count as letters."""
    table = np.full(0x250, 29, dtype=np.int64)
    for c in range(0x250):
        ch = chr(c)
        low = _FOLD.get(ch.lower(), ch.lower())
        if c == 32 or 9 <= c <= 13:
            table[c] = 0
        elif "a" <= low <= "z" and len(low) == 1:
            table[c] = ord(low) - 96
        elif ch.isdigit():
            table[c] = 28
        elif not ch.isalpha():
            table[c] = 30
    return table


_TABLE = _code_table()


def encode(text: str) -> np.ndarray:
    """Codes of a text's characters, with a start mark before each unit and
    blanks between units (blanks between single characters are taken out)."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    code = np.where(points < 0x250, _TABLE[np.minimum(points, 0x24F)], 29)
    blank = code == 0
    if len(code) >= 3:  # x_y with blanks or ends around both: no boundary
        b = np.concatenate([[True, True], blank, [True, True]])
        at = np.arange(2, len(b) - 2)
        code = code[~(b[at] & ~b[at - 1] & ~b[at + 1] & b[at - 2] & b[at + 2])]
        blank = code == 0
    first = ~blank & np.concatenate([[True], blank[:-1]])
    where = np.flatnonzero(first)
    return np.insert(code, where, _START)


def _norms(longest: int) -> np.ndarray:
    """Scale by the number of characters of a unit: as if all its subsequences differed."""
    n = np.zeros(longest + 1)
    for size in range(longest + 1):
        n[size] = sum(DECAY ** (2 * (k + 1)) * max(0, size - k) for _, k in _PAIRS)
    return 1.0 / np.sqrt(np.maximum(n, DECAY ** 6))


_NORMS = _norms(64)


def _subsequences(code: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(start positions, subsequence numbers, weight) of all subsequences inside units."""
    solid = code != 0
    unit = np.cumsum(~solid)
    n = len(code)
    for j, k in _PAIRS:
        if n <= k:
            continue
        at = np.flatnonzero(solid[:n - k] & solid[k:] & (unit[:n - k] == unit[k:]))
        yield at, (code[at] * CODES + code[at + j]) * CODES + code[at + k], DECAY ** (k + 1)


@dataclass
class Machine:
    """Weights by subsequence, and the two numbers that turn the highest unit into a probability."""
    weights: np.ndarray
    slope: float
    offset: float

    def unit_scores(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Position of each unit's start and its decision value."""
        starts = np.flatnonzero(code == _START)
        if not len(starts):
            return starts, np.zeros(0)
        total = np.zeros(len(code))
        for at, number, weight in _subsequences(code):
            total[at] += weight * self.weights[number]
        sizes = np.add.reduceat((code != 0).astype(np.int64), starts)
        return starts, np.add.reduceat(total, starts) * _NORMS[np.minimum(sizes, len(_NORMS) - 1)]

    def probability(self, highest: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * highest + self.offset, -50, 50)))


def _unit_words(code: np.ndarray) -> list[bytes]:
    """A text's units as bytes of codes."""
    starts = np.flatnonzero(code == _START)
    solid = code.astype(np.uint8).tobytes()
    return [solid[a:b].rstrip(b"\0") for a, b in zip(starts, [*starts[1:], len(code)])]


def _features(units: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of (unit numbers, subsequence numbers, scaled weights)."""
    sizes = np.array([len(u) for u in units])
    code = np.frombuffer(b"".join(u + b"\0" for u in units), dtype=np.uint8).astype(np.int64)
    owner = np.repeat(np.arange(len(units)), sizes + 1)
    scale = _NORMS[np.minimum(sizes, len(_NORMS) - 1)]
    for at, number, weight in _subsequences(code):
        yield owner[at], number, weight * scale[owner[at]]


def _kernel(units: list[bytes], landmarks: np.ndarray) -> np.ndarray:
    """Kernel of each unit with each landmark (rows of subsequence weights)."""
    out = np.zeros((len(units), landmarks.shape[1]), dtype=np.float32)
    for lo in range(0, len(units), 2000):
        for owner, number, weight in _features(units[lo:lo + 2000]):
            for cut in range(0, len(owner), 20_000):
                s = slice(cut, cut + 20_000)
                np.add.at(out, lo + owner[s], landmarks[number[s]] * weight[s, None].astype(np.float32))
    return out


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, reg: float = 1e-4, steps: int = 300) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss by accelerated gradient steps."""
    x1 = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)])
    w = np.zeros(x1.shape[1])
    ahead, t = w.copy(), 1.0
    rate = 1.0 / (2.0 * (weight[:, None] * x1 * x1).sum() / weight.sum() + reg)
    share = weight / weight.sum()
    for _ in range(steps):
        slack = np.maximum(0.0, 1.0 - y * (x1 @ ahead))
        grad = -2.0 * (x1.T @ (share * y * slack)) + reg * ahead
        new, t_new = ahead - rate * grad, (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return w[:-1], w[-1]


def train(toxic: list[str], clean: list[str], seed: int = 7) -> Machine:
    """Fit the machine to whole texts of either label."""
    rng = np.random.default_rng(seed)
    bags = [(list(dict.fromkeys(_unit_words(encode(t)))), 1) for t in toxic]
    bags += [(list(dict.fromkeys(_unit_words(encode(t)))), 0) for t in clean]
    bags = [(u, y) for u, y in bags if u]
    if not any(y for _, y in bags) or all(y for _, y in bags):  # nothing to learn
        return Machine(np.zeros(CODES ** 3), 1.0, 0.0 if not bags else (5.0 if bags[0][1] else -5.0))
    seen: dict[bytes, list[int]] = {}
    for units, y in bags:
        for u in units:
            seen.setdefault(u, [0, 0])[y] += 1
    n = [sum(1 for _, y in bags if y == c) for c in (0, 1)]

    def suspicion(u: bytes) -> float:  # smoothed log odds of the unit's documents
        a, b = seen[u]
        return float(np.log((b + 0.1) / (n[1] + 1)) - np.log((a + 0.1) / (n[0] + 1)))

    clean_units = sorted({u for units, y in bags if not y for u in units})
    if len(clean_units) > CLEAN_UNITS:
        clean_units = [clean_units[i] for i in np.sort(rng.choice(len(clean_units), CLEAN_UNITS, replace=False))]
    score = suspicion
    machine = None
    for _ in range(ROUNDS):
        witnesses: dict[bytes, float] = {}
        for units, y in bags:
            if y:
                w = max(units, key=score)
                witnesses[w] = witnesses.get(w, 0.0) + 1.0
        positive = sorted(witnesses)
        units = positive + [u for u in clean_units if u not in witnesses]
        y = np.array([1.0] * len(positive) + [-1.0] * (len(units) - len(positive)))
        weight = np.array([witnesses[u] for u in positive] + [1.0] * (len(units) - len(positive)))
        weight[y > 0] *= (y < 0).sum() / max(1.0, weight[y > 0].sum()) * 0.5
        by_weight = sorted(positive, key=lambda u: (-witnesses[u], u))[:LANDMARKS // 2]
        rest = [u for u in units if u not in set(by_weight)]
        marks = by_weight + [rest[i] for i in rng.permutation(len(rest))[:LANDMARKS - len(by_weight)]]
        rows = np.zeros((CODES ** 3, len(marks)), dtype=np.float32)
        for owner, number, value in _features(marks):
            np.add.at(rows, (number, owner), value.astype(np.float32))
        own = _kernel(marks, rows).astype(np.float64)
        values, vectors = np.linalg.eigh((own + own.T) / 2)
        good = values > 1e-6 * values.max()
        whiten = vectors[:, good] / np.sqrt(values[good])
        w, b = _svm(_kernel(units, rows) @ whiten, y, weight)
        table = rows @ (whiten @ w)
        machine = Machine(table.astype(np.float64), 1.0, b)
        value_of: dict[bytes, float] = {}

        def score(u: bytes) -> float:
            if u not in value_of:
                value_of[u] = float(machine.unit_scores(np.frombuffer(u, dtype=np.uint8).astype(np.int64))[1][0])
            return value_of[u]

        for units_of, _ in bags:  # all at once, then looked up
            fresh = [u for u in units_of if u not in value_of]
            if fresh:
                code = np.frombuffer(b"\0".join(fresh), dtype=np.uint8).astype(np.int64)
                value_of.update(zip(fresh, machine.unit_scores(code)[1].tolist()))
    highest = np.array([max(value_of[u] for u in units) for units, _ in bags])
    label = np.array([y for _, y in bags], dtype=float)
    machine.slope, machine.offset = _calibrate(highest, label)
    return machine


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic fit of the label to the highest decision value, by Newton's
    method, both classes weighing the same."""
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y == 0).sum()))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1.0 / (1.0 + np.exp(-np.clip(a * x + b, -50, 50)))
        g = np.array([(weight * (p - y) * x).sum() + 1e-4 * a, (weight * (p - y)).sum()])
        s = weight * p * (1 - p)
        h = np.array([[(s * x * x).sum() + 1e-4, (s * x).sum()], [(s * x).sum(), s.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
        a, b = a - step[0], b - step[1]
    return float(a), float(b)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """Train on at most ``sample`` documents of either label whose crc32
    remainder by 3 is not 1.  Rows without a label of 0 or 1 are not learnt
    from; several labels of one id count each."""
    rated = labels.select(F.col("doc_id").cast("long").alias("__id"), F.col("toxic").cast("int").alias("__toxic"))
    rated = rated.where((remainder("__id", 3) != 1) & F.col("__toxic").isin(0, 1))
    order = F.xxhash64(F.lit("sample"), F.col("__id"))

    def chosen(value: int) -> DataFrame:  # ids alone; a top-k of the sample's size
        return rated.where(F.col("__toxic") == value).orderBy(order, "__id").limit(sample)

    picked = F.broadcast(chosen(1).unionByName(chosen(0)))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole("text").alias("text"))
            .join(picked, F.col("doc_id") == F.col("__id")).select("doc_id", "__toxic", "text"))
    found = sorted((r["doc_id"], r["__toxic"], r["text"]) for r in rows.toLocalIterator())
    return train([t for _, y, t in found if y == 1], [t for _, y, t in found if y == 0])


def score_documents(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, score: a probability from the highest unit of the whole text.
    A text without units scores as the machine's offset alone."""
    held = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                part = batch.slice(lo, 128)
                codes = [encode(t) for t in part.column(1).to_pylist()]
                joined = np.concatenate([np.append(c, 0) for c in codes])
                starts, value = held.value.unit_scores(joined)
                ends = np.cumsum([len(c) + 1 for c in codes])
                highest = np.full(len(codes), -np.inf)
                np.maximum.at(highest, np.searchsorted(ends, starts, side="right"), value)
                score = held.value.probability(np.where(np.isfinite(highest), highest, 0.0))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score)], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole("text").alias("text")).mapInArrow(
        run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, toxic_at: float = 0.7) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.  Labels,
    language, source and ids are no inputs of a score.  Null and empty texts
    have no unit and get the score of a decision value of 0.  Without labels
    of both kinds every document scores the same.  Repeated rows score alike."""
    out = score_documents(docs, learn(docs, labels, sample))
    return out.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score",
                      (F.col("score") >= toxic_at).cast("int").alias("predicted"))
