"""Word shingles of whole texts as 64-bit hashes, a batch of texts at a time."""

from __future__ import annotations

import numpy as np

WORDS = 5
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(int(_P), -1, 1 << 64))
_PLACES = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                                  0xE7037ED1A0B428DB)]
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of each word's bytes, by differences of one running sum."""
    n = len(data)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_P, n), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _powers(_P_INVERSE, n)[starts])


def shingle_sets(texts: list[str], size: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingles of each text: A-Z lower-cased, words of
    non-blank characters, ``size`` words a shingle; a shorter text is one
    shingle of all its words, a text without words has none."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = _LOWER[np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)]
    blank = _BLANK[data]
    starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    ends = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
    limits = np.cumsum([len(r) + 1 for r in raw])
    h = _word_hashes(data, starts, ends)
    upto = np.searchsorted(starts, limits)
    rolled = np.zeros(max(0, len(h) - size + 1), dtype=np.uint64)
    for k in range(size):
        rolled += h[k:k + len(rolled)] * _PLACES[k]
    rolled = mix(rolled + np.uint64(size))
    out, lo = [], 0
    for hi in upto.tolist():
        n = hi - lo
        if n >= size:
            out.append(np.unique(rolled[lo:hi - size + 1]))
        elif n:
            whole = np.sum(h[lo:hi] * np.array(_PLACES[:n]), dtype=np.uint64, keepdims=True)
            out.append(mix(whole + np.uint64(n)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
        lo = hi
    return out
