"""Token counts by finite-state transducers compiled from a byte-level BPE file.

Two deterministic transducers run in cascade:

* ``Splitter`` reads classes of code points and marks where a pre-token
  starts.  It has few states, so a text is cut into chunks of fixed size
  anywhere, every chunk becomes a map (state before -> state after), and the
  maps compose by a parallel prefix scan; the state before each chunk is then
  known and all chunks write their marks together.
* ``Counter`` reads bytes.  Each transition carries the number of tokens it
  emits: the tokens of the prefix read so far less those of the prefix
  without its last byte, which can be negative when a byte joins tokens.  At
  every mark it is back in its root, so chunks that begin at marks have
  constant maps, their counts add up, and numpy steps all of them at once.
  States and transitions are compiled from the merges when first met.

A state of Counter is what the future of a pre-token depends on: for each
place where a token that is still unfinished may have begun, its node in the
trie of tokens, the last token before that place and the number of tokens up
to there.  A token may follow another one where merging both side by side
leaves the border between them; exactly one of the tokens that end at a byte
may follow what lies before it, and that one ends the tokens of the prefix.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import whole

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
#: Code points in a chunk of the splitter, bytes in one of the counter (more where a pre-token is longer).
SPLIT_CHUNK = 64
COUNT_CHUNK = 128
#: Bytes of text that go through the transducers together.
TOGETHER = 1 << 20
#: Beyond so many compiled states the counter starts anew before its next batch.
STATES = 1 << 18
#: Chunks still running below which they are stepped one by one.
FEW = 4
_NEVER = 1 << 30

# -- classes of code points and states of the splitter
LETTER, STMD, RV, E, ELL, NUMBER, OTHER, APOSTROPHE, SPACE, BLANK, END = range(11)
START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AP, AP_RV, AP_ELL, ONE_SPACE, ONE_BLANK, RUN_SPACE, RUN_BLANK = range(11)
_LETTERS, _BLANKS = (LETTER, STMD, RV, E, ELL), (SPACE, BLANK)
HERE, BEFORE = 1, 2


def split_table() -> tuple[np.ndarray, np.ndarray]:
    """Next state and marks (HERE: this code point starts a pre-token, BEFORE:
    the one before does) of every state and class.

    Pre-tokens are, at each place the first that fits: an apostrophe with s,
    t, m, d, re, ve or ll; letters, numbers or other signs, each with a blank
    before them if there is one; white space but its last character if
    something follows it; white space.
    """
    begin = {LETTER: IN_LETTERS, STMD: IN_LETTERS, RV: IN_LETTERS, E: IN_LETTERS, ELL: IN_LETTERS,
             NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, APOSTROPHE: AP, SPACE: ONE_SPACE, BLANK: ONE_BLANK}
    after_space = begin | {APOSTROPHE: IN_OTHERS}
    step: dict[tuple[int, int], tuple[int, int]] = {}
    for c, to in begin.items():
        for s in range(11):
            step[s, c] = (to, HERE)
        step[AP_RV, c] = step[AP_ELL, c] = (to, BEFORE) if c in _LETTERS else (to, HERE | BEFORE)
        if c not in _BLANKS:
            step[ONE_SPACE, c] = (after_space[c], 0)
            step[RUN_SPACE, c] = (after_space[c], BEFORE)
            step[RUN_BLANK, c] = (to, HERE | BEFORE)
    for s in (ONE_SPACE, ONE_BLANK, RUN_SPACE, RUN_BLANK):
        step[s, SPACE], step[s, BLANK] = (RUN_SPACE, 0), (RUN_BLANK, 0)
    for c in _LETTERS:
        step[IN_LETTERS, c] = (IN_LETTERS, 0)
    step[IN_NUMBERS, NUMBER] = (IN_NUMBERS, 0)
    for s in (IN_OTHERS, AP):
        step[s, OTHER] = step[s, APOSTROPHE] = (IN_OTHERS, 0)
    step[AP, STMD], step[AP, RV], step[AP, ELL] = (START, 0), (AP_RV, 0), (AP_ELL, 0)
    step[AP_RV, E] = step[AP_ELL, ELL] = (START, 0)
    for s in range(11):
        step[s, END] = (START, BEFORE if s in (AP_RV, AP_ELL) else 0)
    to, marks = np.zeros((2, 11, 11), dtype=np.uint8)
    for (s, c), (t, m) in step.items():
        to[s, c], marks[s, c] = t, m
    return to, marks


def _starts_after(pre_tokenizer, base: str, chars: list[str]) -> set[str]:
    """The characters that start a pre-token when they follow ``base``."""
    apart = "1" if base == "!" else "!"
    begun = {at for _, (at, _) in pre_tokenizer.pre_tokenize_str("".join(apart + base + c for c in chars))}
    return {c for k, c in enumerate(chars) if 3 * k + 2 in begun}


def code_point_classes(pre_tokenizer) -> np.ndarray:
    """The class of every code point.  Letters and numbers that Python's own
    tables do not know yet are what the file's pre-tokenizer takes them for,
    as libraries follow different versions of Unicode."""
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", BLANK)):
        for m in regex.finditer(pattern, every):
            out[np.frombuffer(m.group().encode("utf-32-le"), dtype=np.uint32)] = kind
    newer = [chr(p) for p in np.flatnonzero((out == LETTER) | (out == NUMBER)).tolist()
             if unicodedata.category(chr(p)) == "Cn"]
    alone = [_starts_after(pre_tokenizer, base, newer) for base in ("a", "1")]
    for c in newer:
        out[ord(c)] = LETTER if c not in alone[0] else NUMBER if c not in alone[1] else OTHER
    for chars, kind in (("stmd", STMD), ("rv", RV), ("e", E), ("l", ELL), ("'", APOSTROPHE), (" ", SPACE)):
        out[[ord(c) for c in chars]] = kind
    return out


def scan(maps: np.ndarray) -> np.ndarray:
    """Composition of each chunk's map (a row: state before -> state after)
    with those of all chunks before it, by doubling."""
    d = 1
    while d < len(maps):
        maps = np.concatenate([maps[:d], np.take_along_axis(maps[d:], maps[:-d], axis=1)])
        d *= 2
    return maps


class Splitter:
    def __init__(self, classes: np.ndarray) -> None:
        self.to, self.marks = split_table()
        self.classes = classes

    def starts(self, classes: np.ndarray, size: int = SPLIT_CHUNK) -> np.ndarray:
        """Whether a pre-token starts, for each of the classes; END closes a text."""
        n = len(classes)
        if not n:
            return np.zeros(0, dtype=bool)
        rows = -(-n // size)
        flat = np.full(rows * size, END, dtype=np.uint8)
        flat[:n] = classes
        cells = np.ascontiguousarray(flat.reshape(rows, size).T)  # one column a chunk
        maps = np.tile(np.arange(11, dtype=np.uint8), (rows, 1))
        for k in range(size):
            maps = self.to[maps, cells[k][:, None]]
        state = np.concatenate([[START], scan(maps)[:-1, START]]).astype(np.uint8)
        emitted = np.empty((size, rows), dtype=np.uint8)
        for k in range(size):
            emitted[k] = self.marks[state, cells[k]]
            state = self.to[state, cells[k]]
        marks = emitted.T.reshape(-1)[:n]
        out = (marks & HERE) > 0
        out[:-1] |= (marks[1:] & BEFORE) > 0
        return out


# -- the byte-pair file
def _written_bytes() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    printable Latin-1 for itself, the others from U+0100 on in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def load_bpe(name: str = TOKENIZER) -> dict:
    """Bytes of every token, merges as (left, right, merged) in order, the
    special tokens and the classes of code points of a byte-level BPE file.
    Raises ValueError for a file of another kind."""
    path = public_tokenizers.path(name)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    plain = (spec["normalizer"] is None and pre.get("type") == "ByteLevel" and pre["use_regex"]
             and not pre["add_prefix_space"] and model["type"] == "BPE" and not model.get("ignore_merges")
             and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]))
    if not plain:
        raise ValueError(f"{name} is no plain byte-level BPE file")
    written, vocab = _written_bytes(), model["vocab"]
    tokens = {i: bytes(written[c] for c in word) for word, i in vocab.items()}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
    return {"tokens": tokens, "merges": merges, "special": [t["content"] for t in spec["added_tokens"]],
            "classes": code_point_classes(Tokenizer.from_file(path).pre_tokenizer)}


class Counter:
    """The transducer of token counts, compiled as far as texts have needed it."""

    def __init__(self, bpe: dict) -> None:
        self.rank = {(a, b): r for r, (a, b, _) in enumerate(bpe["merges"])}
        made = {m: (a, b, r) for r, (a, b, m) in enumerate(bpe["merges"])}
        if len(made) < len(bpe["merges"]):
            raise ValueError("a token is made by two merges")
        self.left: dict[int, list[tuple[int, int]]] = {}
        self.right: dict[int, list[tuple[int, int]]] = {}
        self.follows: dict[tuple[int, int], bool] = {}
        usable = []
        for t, text in bpe["tokens"].items():
            if len(text) == 1:
                self.left[t] = self.right[t] = [(t, _NEVER)]
                usable.append(t)
        for m, (a, b, r) in made.items():  # in order of rank: parts come first
            if a in self.left and b in self.left and self._apart(a, b):
                self.left[m] = [*self.left[a][:-1], (a, r), (m, _NEVER)]
                self.right[m] = [*self.right[b][:-1], (b, r), (m, _NEVER)]
                usable.append(m)
        self.child: dict[int, int] = {}
        self.token, self.open = [-1], [False]
        for t in usable:
            node = 0
            for b in bpe["tokens"][t]:
                key = node << 8 | b
                at = self.child.get(key)
                if at is None:
                    at = self.child[key] = len(self.token)
                    self.token.append(-1)
                    self.open.append(False)
                    self.open[node] = True
                node = at
            self.token[node] = t
        if sum(len(bpe["tokens"][t]) == 1 for t in usable) < 256:
            raise ValueError("not every byte is a token")
        self.reset()

    def reset(self) -> None:
        root = ((0, -1, 0),)
        self.states, self.number = [root], {root: 0}
        self._grow(1 << 16)

    def _grow(self, size: int) -> None:
        """An open-addressing table of transitions: key state * 256 + byte, next state, tokens emitted."""
        old = (self.keys, self.next, self.emits) if getattr(self, "used", 0) and size > 1 << 16 else None
        self.mask, self.used = size - 1, 0
        self.keys = np.full(size, -1, dtype=np.int64)
        self.next = np.zeros(size, dtype=np.int32)
        self.emits = np.zeros(size, dtype=np.int8)
        if old:
            full = np.flatnonzero(old[0] >= 0)
            self._insert(old[0][full], old[1][full], old[2][full])

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.int64(0x9E3779B1)) >> np.int64(7)) & self.mask

    def _insert(self, keys: np.ndarray, to: np.ndarray, emits: np.ndarray) -> None:
        """Distinct new keys; of several that want one free slot one gets it, the others go on."""
        if 2 * (self.used + len(keys)) > self.mask:
            self._grow(4 * (self.mask + 1))
            return self._insert(keys, to, emits)
        self.used += len(keys)
        at = self._slot(keys)
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]
            mine = self.keys[at] == keys
            self.next[at[mine]], self.emits[at[mine]] = to[mine], emits[mine]
            keys, to, emits, at = keys[~mine], to[~mine], emits[~mine], (at[~mine] + 1) & self.mask

    def _apart(self, a: int, b: int) -> bool:
        """Whether merging a and b side by side never joins across their border
        but, at last, a with b.  Parts grow in order of rank; equal pairs merge
        from the left."""
        ra, rb, i, j = self.right[a], self.left[b], 0, 0
        while True:
            (x, grows_x), (y, grows_y) = ra[i], rb[j]
            if grows_x == grows_y == _NEVER:
                return True
            joins = self.rank.get((x, y), _NEVER)
            if joins < grows_x and joins <= grows_y:
                return False
            if grows_x <= grows_y:
                i += 1
            else:
                j += 1

    def may_follow(self, a: int, b: int) -> bool:
        """Whether the tokens of the bytes of a and b together are a and b."""
        key = (a, b)
        found = self.follows.get(key)
        if found is None:
            if len(self.follows) >= STATES:
                self.follows.clear()
            found = self.follows[key] = (a, b) not in self.rank and self._apart(a, b)
        return found

    def compile(self, key: int) -> tuple[int, int]:
        """Next state and tokens emitted for state * 256 + byte."""
        byte, child, token = key & 255, self.child, self.token
        last = emits = None
        going = []
        for node, before, upto in self.states[key >> 8]:
            at = child.get(node << 8 | byte)
            if at is None:
                continue
            t = token[at]
            if last is None and t >= 0 and (before < 0 or self.may_follow(before, t)):
                last, emits = t, upto + 1
            if self.open[at]:
                going.append((at, before, upto))
        state = (*((n, p, c - emits) for n, p, c in going), (0, last, 0))
        number = self.number.get(state)
        if number is None:
            number = self.number[state] = len(self.states)
            self.states.append(state)
        return number, emits

    def step(self, state: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = state.astype(np.int64) << 8 | data
        at = self._slot(keys)
        here = self.keys[at]
        lost = np.flatnonzero(here != keys)
        if len(lost):
            todo, spot = lost, at[lost]
            new = []
            while len(todo):  # linear probing; an empty slot means a transition not compiled yet
                found = self.keys[spot]
                hit, none = found == keys[todo], found < 0
                at[todo[hit]] = spot[hit]
                new.append(todo[none])
                more = ~(hit | none)
                todo, spot = todo[more], (spot[more] + 1) & self.mask
            missing = np.concatenate(new)
            if len(missing):
                fresh = np.unique(keys[missing])
                made = np.array([self.compile(k) for k in fresh.tolist()], dtype=np.int32)
                self._insert(fresh, made[:, 0], made[:, 1].astype(np.int8))
                return self.step(state, data)
        return self.next[at], self.emits[at]

    def counts(self, data: np.ndarray, starts: np.ndarray, size: int = COUNT_CHUNK) -> np.ndarray:
        """Tokens emitted at each byte; ``starts``: ascending places of pre-tokens, the first is 0."""
        out = np.zeros(len(data), dtype=np.int8)
        if not len(data):
            return out
        if len(self.states) > STATES:
            self.reset()
        root = np.zeros(len(data), dtype=bool)
        root[starts] = True
        cuts = starts[np.unique(np.minimum(np.searchsorted(starts, np.arange(0, len(data), size)), len(starts) - 1))]
        cuts = np.append(cuts, len(data))
        length = np.diff(cuts)
        order = np.argsort(-length, kind="stable")
        begin, length = cuts[:-1][order], length[order]
        state = np.zeros(len(begin), dtype=np.int32)
        running = np.searchsorted(-length, -np.arange(length[0] + 1), side="left")  # chunks longer than k
        for k in range(length[0]):
            n = running[k]
            if n <= FEW:
                for c in range(n):
                    self._one(data, root, out, int(state[c]), int(begin[c]) + k, int(begin[c] + length[c]))
                break
            at = begin[:n] + k
            s = np.where(root[at], 0, state[:n])
            state[:n], out[at] = self.step(s, data[at])
        return out

    def _one(self, data: np.ndarray, root: np.ndarray, out: np.ndarray, state: int, lo: int, hi: int) -> None:
        """One chunk from lo to hi, byte by byte."""
        known: dict[int, tuple[int, int]] = {}
        emitted = np.empty(hi - lo, dtype=np.int8)
        for k, (b, fresh) in enumerate(zip(data[lo:hi].tolist(), root[lo:hi].tolist())):
            key = (0 if fresh else state) << 8 | b
            found = known.get(key)
            if found is None:
                if len(known) > STATES:
                    known.clear()
                found = known[key] = self.compile(key)
            state, emitted[k] = found
        out[lo:hi] = emitted


class TokenCounter:
    def __init__(self, bpe: dict) -> None:
        self.splitter, self.counter = Splitter(bpe["classes"]), Counter(bpe)
        special = sorted(bpe["special"], key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.quick = special

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each whole text; a special token's own string is one token."""
        n = np.zeros(len(texts), dtype=np.int64)
        parts, owner = [], []
        for k, t in enumerate(texts):
            if self.special and any(s in t for s in self.quick):
                pieces = self.special.split(t)
                n[k] += len(pieces) - 1
                parts += pieces
                owner += [k] * len(pieces)
            else:
                parts.append(t)
                owner.append(k)
        joined = np.frombuffer(("\0".join(parts) + "\0").encode("utf-32-le"), dtype=np.uint32)
        ends = np.cumsum([len(p) + 1 for p in parts]) - 1
        classes = self.splitter.classes[joined]
        classes[ends] = END
        inside = np.ones(len(joined), dtype=bool)
        inside[ends] = False
        starts = self.splitter.starts(classes)[inside]
        points = joined[inside]
        width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000).astype(np.int64)
        place = np.cumsum(width) - width
        data = np.frombuffer("".join(parts).encode("utf-8"), dtype=np.uint8)
        emitted = self.counter.counts(data, place[starts])
        upto = np.concatenate([[0], np.cumsum(emitted, dtype=np.int64)])
        edges = np.concatenate([[0], np.append(place, len(data))[np.cumsum([len(p) for p in parts])]])
        np.add.at(n, np.array(owner, dtype=np.int64), np.diff(upto[edges]))
        return n


SCHEMA = "doc_id long, n_bytes long, n_tokens long"
_READY: dict[str, TokenCounter] = {}


def _together(texts: list[str], most: int = TOGETHER) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def count_tokens(docs: DataFrame, name: str = TOKENIZER, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every whole text.

    A null text counts as empty, an empty text has no tokens.  Rows are
    counted by themselves, so null ids, ties, repeated rows and extra columns
    of any name do not matter; an empty table gives no rows.  A special token's
    string inside a text is one token, as the file's own library counts it.
    """
    bpe = docs.sparkSession.sparkContext.broadcast(load_bpe(name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _READY.get(name)  # compiled states serve the next partition in the same worker
        if counter is None:
            counter = _READY[name] = TokenCounter(bpe.value)
        for batch in batches:
            counts = [counter.count(part) for part in _together(batch.column(2).to_pylist())]
            n = np.concatenate(counts) if counts else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())],
                                             names=["doc_id", "n_bytes", "n_tokens"])

    text = whole("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    return rows.mapInArrow(run, SCHEMA).withColumn("over_limit", F.col("n_tokens") > limit)
