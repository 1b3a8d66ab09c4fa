"""SentencePiece encoding and decoding by N-best segmentation.

The piece lattice of a text is searched twice: a forward Viterbi pass gives
the best score of every prefix, and those scores are the exact heuristic of
a backward A* search from the end of the text, which therefore pops whole
segmentations in order of score.  Pieces come from a public SentencePiece
model file (a parameter); a piece of rank r scores log(1 / (r + 1)), Zipf's
law, since byte-pair models carry ranks in place of probabilities.  A
character that no piece covers is written as its UTF-8 byte pieces.

No piece has a blank after another character, so a lattice falls apart at
every blank that follows a non-blank: the N best segmentations of the whole
text are merged exactly from those of its chunks, and chunks are cached.
"""

from __future__ import annotations

import heapq
import itertools
import math
import re
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Chunks and their characters kept by a task's table; a full one is emptied before the next texts.
CACHE = 400_000
CACHE_CHARS = 8_000_000
#: Texts encoded at a time.
TOGETHER = 256
#: Longer chunks are searched one by one.
LEARNT_CHARS = 64
#: Segmentations that are returned of each text.
NBEST = 5
#: Kinds of characters: other visible ones (and all from _LATIN on) are OTHER.
_BLANK, _NEWLINE, _OTHER, _LETTER = range(4)
_LATIN = 0x250
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: Bits of a hash that choose the slot of a prefix.
SLOTS = 20
#: Chunks times characters that go through the Viterbi passes together.
CELLS = 400_000

_BYTE = re.compile(r"<0x([0-9A-F]{2})>$")


def load_pieces(path: str = MODEL) -> tuple[dict[str, int], list[int], list[bytes]]:
    """Pieces with blanks for the word mark, the ids of the 256 bytes, and
    the bytes of every id.  Read on the driver; the vocabulary's size is
    fixed by the file."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids, byte_ids, written = {}, [0] * 256, []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if m := _BYTE.match(piece):
            byte_ids[int(m[1], 16)] = i
            written.append(bytes([int(m[1], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i):
            written.append(b"")
        else:
            text = piece.replace("▁", " ")
            written.append(text.encode())
            if "\n" not in text and " " not in text.lstrip(" "):
                ids[text] = i
    return ids, byte_ids, written


def _kinds() -> np.ndarray:
    """The kind of each code point up to _LATIN, which stands for all beyond."""
    kinds = np.array([_LETTER if _LETTERS.match(chr(c)) else _OTHER for c in range(_LATIN + 1)], dtype=np.uint8)
    kinds[[ord(" "), ord("\n")]] = _BLANK, _NEWLINE
    return kinds


def _parted(ids: dict[str, int]) -> np.ndarray:
    """Whether a chunk ends between two characters, by 4 * kind + kind of the
    next: around a newline, before a blank that follows no blank, and, if no
    piece has a Latin letter next to another visible character, between those."""
    parted = np.zeros((4, 4), dtype=bool)
    parted[_NEWLINE] = parted[:, _NEWLINE] = True
    parted[_NEWLINE:, _BLANK] = True
    parted[_OTHER, _LETTER] = parted[_LETTER, _OTHER] = not any(
        a != " " and bool(_LETTERS.match(a)) != bool(_LETTERS.match(b)) for p in ids for a, b in zip(p, p[1:]))
    return parted.ravel()


def _widths(codes: np.ndarray) -> np.ndarray:
    """UTF-8 bytes of each code point."""
    return 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)


class _Chunks:
    """Best segmentations of chunks: ``number`` of a chunk, and by number
    where its ids lie in ``flat``, how many, their score (``total``) and the
    loss of the second best (``lost``)."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.chars = 0
        self.flat = np.zeros(0, dtype=np.int32)
        self.start, self.size = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.lost, self.total = np.zeros(0), np.zeros(0)

    def add(self, chunks: list[str], ids: np.ndarray, size: np.ndarray, lost: np.ndarray, total: np.ndarray) -> None:
        """``ids`` of the chunks one after the other, ``size`` of them each."""
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, ids])
        self.lost, self.total = np.concatenate([self.lost, lost]), np.concatenate([self.total, total])
        self.number.update(zip(chunks, range(len(self.number), len(self.start))))
        self.chars += sum(map(len, chunks))

    def ids(self, numbers: np.ndarray) -> np.ndarray:
        """Ids of these chunks one after the other."""
        size = self.size[numbers]
        ends = np.cumsum(size)
        return self.flat[np.repeat(self.start[numbers] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]


#: Tables of this Python worker, by vocabulary size and n; they outlive a task where workers are reused.
_CACHES: dict[tuple[int, int], _Chunks] = {}


class Segmenter:
    """Encodes and decodes with one vocabulary."""

    def __init__(self, vocabulary: tuple[dict[str, int], list[int], list[bytes]], nbest: int = NBEST):
        ids, self.byte_ids, self.written = vocabulary
        self.nbest = nbest
        # every prefix of a piece; a piece itself with its edge, (ids, score)
        self.prefixes: dict[str, tuple | None] = {p[:k]: None for p in ids for k in range(1, len(p))}
        self.prefixes |= {p: ((i,), -math.log(i + 1)) for p, i in ids.items()}
        self.longest = max(map(len, ids), default=1)
        self.scores = -np.log(np.arange(1.0, len(self.written) + 1))
        hashed: dict[int, int] = {}
        for p in self.prefixes:
            h = 0
            for c in p:
                h = (h + ord(c)) * int(_MULTIPLIER) % (1 << 64)
            hashed[h] = ids.get(p, -1)
        order = sorted(hashed)
        # two last entries above any hash: that of an empty slot, and that of a slot with several prefixes
        self.hashes = np.array([*order, (1 << 64) - 1, (1 << 64) - 1], dtype=np.uint64)
        self.hashed_ids = np.array([*[hashed[h] for h in order], -1, -1], dtype=np.int64)
        slot = (self.hashes[:-2] >> np.uint64(64 - SLOTS)).astype(np.int64)
        self.slots = np.full(1 << SLOTS, len(order), dtype=np.int32)
        self.slots[slot] = np.arange(len(order))
        self.slots[np.bincount(slot, minlength=1 << SLOTS) > 1] = len(order) + 1
        self.kinds, self.parted = _kinds(), _parted(ids)
        self.chunks = _CACHES.setdefault((len(self.written), nbest), _Chunks())
        self.bytes_of = pa.array(self.written, pa.large_binary())
        self.widths = np.fromiter(map(len, self.written), dtype=np.int64, count=len(self.written))
        self.found: dict[str, list[tuple[float, np.ndarray]]] = {}

    def _spelt(self, char: str) -> tuple[tuple[int, ...], float]:
        spelt = tuple(self.byte_ids[b] for b in char.encode())
        return spelt, -sum(math.log(i + 1) for i in spelt)

    def search(self, text: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best segmentations of a chunk, best first; equal scores in order of ids."""
        if not text:
            return [(0.0, ())]
        size, prefixes = len(text), self.prefixes
        best = [-math.inf] * (size + 1)
        best[0] = 0.0
        into: list[list] = [[] for _ in range(size + 1)]
        for start in range(size):
            upto = best[start]
            end = start + 1
            edge = prefixes.get(text[start], False)
            if not edge:  # no piece of this character alone: its bytes
                pieces, score = self._spelt(text[start])
                into[end].append((start, pieces, score))
                best[end] = max(best[end], upto + score)
            while edge is not False:
                if edge:
                    pieces, score = edge
                    into[end].append((start, pieces, score))
                    if upto + score > best[end]:
                        best[end] = upto + score
                end += 1
                if end > size:
                    break
                edge = prefixes.get(text[start:end], False)
        # backward A*: a state is a position and the pieces after it; its bound best[position] + score is exact
        heap: list[tuple] = [(-best[size], (), size, 0.0)]
        found = []
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            cost, after, end, score = pop(heap)
            if end == 0:
                ids: list[int] = []
                node = after
                while node:
                    ids.extend(node[0])
                    node = node[1]
                found.append((-cost, tuple(ids)))
                if len(found) == n:
                    break
                continue
            edges = into[end]
            while len(edges) == 1 and edges[0][0]:  # no choice here
                start, pieces, s = edges[0]
                after, end, score = (pieces, after), start, score + s
                edges = into[end]
            for start, pieces, s in edges:
                s += score
                push(heap, (-(best[start] + s), (pieces, after), start, s))
        return found

    def _find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each hash is that of a prefix of a piece, and the id of the piece (-1: none)."""
        at = self.slots[h >> np.uint64(64 - SLOTS)]
        several = np.flatnonzero(at == len(self.hashes) - 1)
        at[several] = np.searchsorted(self.hashes, h[several])
        known = self.hashes[at] == h
        return known, np.where(known, self.hashed_ids[at], -1)

    def learn(self, chunks: list[str]) -> None:
        """Put new chunks into the table: ids and score of the best
        segmentation and the loss of the second best (infinite if there is
        none).

        Chunks go through the Viterbi passes together, a numpy column each,
        longest first.  From each position only the columns go on whose
        characters so far begin a piece.  The best score from the start to
        each position and from each position to the end price every edge;
        the second best segmentation loses what the cheapest edge off the
        best path loses.  Prefixes are looked up by a 64-bit hash of their
        characters; a chunk whose ids do not spell it is searched anew
        without hashes.
        """
        chunks = sorted(chunks, key=len, reverse=True)
        size = np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks))
        # too long, or too few of that length or more for numpy's columns to pay
        alone = int(np.count_nonzero((size > LEARNT_CHARS) | (2 * np.arange(1, len(size) + 1) < size)))
        self._add_one_by_one(chunks[:alone])
        while alone < len(chunks):
            upto = alone + max(1, CELLS // int(size[alone]))
            self._learn(chunks[alone:upto], size[alone:upto])
            alone = upto

    def _add_one_by_one(self, chunks: list[str]) -> None:
        if chunks:
            ids, lost, total = zip(*map(self._one, chunks))
            self.chunks.add(chunks, np.fromiter(itertools.chain.from_iterable(ids), np.int32),
                            np.fromiter(map(len, ids), np.int64, len(ids)), np.array(lost), np.array(total))

    def _learn(self, chunks: list[str], size: np.ndarray) -> None:
        """learn() for chunks in falling order of length."""
        count, longest, text = len(chunks), int(size[0]), "".join(chunks)
        flat = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        begin = np.cumsum(size) - size
        beyond = count - np.searchsorted(size[::-1], np.arange(longest + 1), side="right")  # columns longer than that
        codes = [flat[begin[:k] + at].astype(np.uint64) for at, k in enumerate(beyond[:-1].tolist())]
        best = np.full((longest + 1, count), -np.inf)
        best[0] = 0.0
        start_of = np.zeros((longest + 1, count), dtype=np.int8)
        id_of = np.zeros((longest + 1, count), dtype=np.int32)
        edges = []
        for start in range(longest):
            rows, h, end = np.arange(beyond[start]), np.uint64(0), start + 1
            while len(rows):
                h = (h + codes[end - 1][rows]) * _MULTIPLIER
                known, ids = self._find(h)
                at = np.flatnonzero(ids >= 0)
                reached, ids_ = rows[at], ids[at]
                score = self.scores[ids_]
                if end == start + 1 and len(at) < len(rows):  # spelt in bytes: kept as -2 - code point
                    reached, ids_ = rows, np.where(ids < 0, -2 - codes[start].astype(np.int64), ids)
                    score = self.scores[np.maximum(ids_, 0)]
                    for i in np.unique(ids_[ids_ < 0]).tolist():
                        score[ids_ == i] = self._spelt(chr(-2 - i))[1]
                if len(reached):
                    edges.append((start, end, reached, score))
                    to = best[start][reached] + score
                    better = np.flatnonzero(to > best[end][reached])
                    column = reached[better]
                    best[end][column] = to[better]
                    start_of[end][column] = start
                    id_of[end][column] = ids_[better]
                if end == longest:
                    break
                on = np.flatnonzero(known & (rows < beyond[end]))
                rows, h, end = rows[on], h[on], end + 1
        rest = np.full((longest + 1, count), -np.inf)
        columns = np.arange(count)
        rest[size, columns] = 0.0
        for start, end, reached, score in reversed(edges):
            rest[start][reached] = np.maximum(rest[start][reached], score + rest[end][reached])
        into = np.full((longest + 1, count), -1, dtype=np.int8)  # where the best path's edge to a position starts
        steps, at, left = [], size, columns
        while len(left):
            before, ids = start_of[at, left], id_of[at, left]
            into[at, left] = before
            steps.append((left, ids))
            on = np.flatnonzero(before)
            at, left = before[on].astype(np.int64), left[on]
        total = best[size, columns]
        loss = np.full(count, np.inf)
        for start, end, reached, score in edges:
            off = np.flatnonzero(into[end][reached] != start)
            reached, score = reached[off], score[off]
            lost = total[reached] - (best[start][reached] + score + rest[end][reached])
            loss[reached] = np.minimum(loss[reached], lost)
        owner, ids = np.concatenate([c for c, _ in steps]), np.concatenate([i for _, i in steps])
        many = np.bincount(owner, minlength=count)
        place = np.cumsum(many)[owner] - 1 - np.repeat(np.arange(len(steps)), [len(c) for c, _ in steps])
        path = np.empty(len(ids), dtype=np.int32)
        path[place] = ids
        if (bare := np.flatnonzero(path < 0)).size:
            spelt = [self._spelt(chr(-2 - i))[0] for i in path[bare].tolist()]
            wide = np.ones(len(path), dtype=np.int64)
            wide[bare] = [len(x) for x in spelt]
            many = np.add.reduceat(wide, np.cumsum(many) - many)
            written = np.repeat(path < 0, wide)
            path = np.repeat(path, wide)
            path[written] = list(itertools.chain.from_iterable(spelt))
        first = np.cumsum(many) - many
        same = np.array_equal(np.add.reduceat(self.widths[path], first), np.add.reduceat(_widths(flat), begin))
        if same and self.spell(path) == text.encode():
            self.chunks.add(chunks, path, many, loss, total)
            return
        good = [self.spell(path[f:f + m]) == c.encode() for c, f, m in zip(chunks, first.tolist(), many.tolist())]
        self._add_one_by_one([c for c, g in zip(chunks, good) if not g])  # two prefixes with one hash
        good = np.array(good)
        self.chunks.add([c for c, g in zip(chunks, good) if g], path[np.repeat(good, many)], many[good], loss[good], total[good])

    def _one(self, chunk: str) -> tuple:
        """As learn() for one chunk, by the search alone."""
        found = self.search(chunk, 2)
        return list(found[0][1]), found[0][0] - found[1][0] if len(found) > 1 else math.inf, found[0][0]

    def _nbest(self, chunk: str) -> list[tuple[float, np.ndarray]]:
        """search() for the n best, cached as chunks are."""
        found = self.found.get(chunk)
        if found is None:
            found = [(s, np.array(i, dtype=np.int32)) for s, i in self.search(chunk, self.nbest)]
            if len(chunk) <= LEARNT_CHARS:
                if len(self.found) >= CACHE // 10:
                    self.found.clear()
                self.found[chunk] = found
        return found

    def _cut(self, texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The chunks of the texts one after the other, each text with a blank
        before it (the empty one has none), and where each text's begin."""
        joined = "".join([" " + t if t else "" for t in texts])
        codes, data = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32), joined.encode()
        text_at = np.cumsum([0, *[len(t) + 1 if t else 0 for t in texts]])
        kinds = self.kinds[np.minimum(codes, _LATIN)]
        cut = np.ones(len(codes) + 1, dtype=bool)
        cut[1:-1] = self.parted[4 * kinds[:-1] + kinds[1:]]
        cut[text_at] = True
        at = np.flatnonzero(cut)
        offsets = at if len(data) == len(codes) else np.concatenate([[0], np.cumsum(_widths(codes))])[at]
        chunks = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(offsets), pa.py_buffer(data))
        return chunks.dictionary_encode(), np.searchsorted(at, text_at)

    def encode_all(self, texts: list[str]) -> list[list[tuple[float, np.ndarray]]]:
        """Score and ids of the n best segmentations of each whole text, best
        first.  The empty text has one, without pieces, of score 0."""
        every, chunk_at = self._cut(texts)
        kinds, at = every.dictionary.to_pylist(), every.indices.to_numpy()
        table = self.chunks
        new = [c for c in kinds if c not in table.number]
        if len(table.number) + len(new) > CACHE or table.chars + sum(map(len, new)) > CACHE_CHARS:
            table.clear()
            new = kinds
        self.learn(new)
        numbers = np.fromiter(map(table.number.__getitem__, kinds), dtype=np.int64, count=len(kinds))[at]
        best, size = table.ids(numbers), table.size[numbers]
        lost, total = table.lost[numbers], table.total[numbers].tolist()
        id_at = np.concatenate([[0], np.cumsum(size)])
        out = []
        for lo, hi in zip(chunk_at[:-1].tolist(), chunk_at[1:].tolist()):
            ends = id_at[lo:hi + 1] - id_at[lo]
            out.append(self._join(kinds, at[lo:hi], best[id_at[lo]:id_at[hi]], ends, lost[lo:hi], math.fsum(total[lo:hi])))
        return out

    def _join(self, kinds: list[str], chunks: np.ndarray, best: np.ndarray, ends: np.ndarray, lost: np.ndarray,
              total: float) -> list[tuple[float, np.ndarray]]:
        """The n best segmentations of a text from its best one: ``chunks``
        are places in ``kinds``, ``ends`` cuts its ids at the chunks, ``lost``
        is each chunk's least loss."""
        # a segmentation among the n best leaves the best one only in the n - 1 chunks that lose least by it
        few = self.nbest - 1
        near = np.arange(len(lost))
        if 0 < few < len(lost):
            near = np.flatnonzero(lost <= np.partition(lost, few - 1)[few - 1])
        near = near[np.argsort(lost[near], kind="stable")[:few]]
        merged: list[tuple[float, tuple]] = [(0.0, ())]  # loss, and the ids in each chunk looked at
        for k in near.tolist():
            if lost[k] < math.inf:
                found = self._nbest(kinds[chunks[k]])
                merged = sorted([(a + found[0][0] - s, (*how, (k, i))) for a, how in merged for s, i in found],
                                key=itemgetter(0))[:self.nbest]
        out = []
        for loss, how in merged:
            parts, at = [], 0
            for k, other in sorted(how):
                parts += [best[at:ends[k]], other]
                at = ends[k + 1]
            out.append((total - loss, np.concatenate([*parts, best[at:]])))
        return out

    def encode(self, text: str) -> tuple[list[int], list[float]]:
        """Ids of the best segmentation and the scores of the n best."""
        found = self.encode_all([text])[0]
        return found[0][1].tolist(), [s for s, _ in found]

    def segmentations(self, text: str, n: int) -> list[tuple[float, list[int]]]:
        """The n best segmentations of a whole text, by A* over its whole lattice."""
        return [(s, list(i)) for s, i in self.search(" " + text if text else "", n)]

    def decode(self, ids) -> str:
        """The text: the bytes of the pieces without the blank put before it."""
        written = self.written
        return b"".join([written[i] for i in ids]).decode("utf-8")[1:]

    def spell(self, ids: np.ndarray) -> bytes:
        """The bytes of the pieces, the blank put before the text included."""
        taken = self.bytes_of.take(pa.array(ids))
        ends = np.frombuffer(taken.buffers()[1], dtype=np.int64, count=len(ids) + 1)
        return taken.buffers()[2].to_pybytes()[ends[0]:ends[-1]] if len(ids) else b""


SCHEMA = ("doc_id long, n_pieces long, scores array<double>, round_trip boolean, "
          "segmentations array<struct<score:double,ids:array<int>>>")


def _listed(values: pa.Array, sizes: list[int]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values)


def encode_documents(docs: DataFrame, path: str = MODEL, nbest: int = NBEST) -> DataFrame:
    """doc_id, ids of the best segmentation, n_pieces, scores of the n best
    segmentations of the whole text (fewer if there are fewer), round_trip
    (decoding the ids gives the text back), and ``segmentations``: score and
    ids of each of the n best, best first.

    A null text counts as empty: no ids, scores [0].  Rows are encoded by
    themselves, so ties, repeated rows and extra columns do not matter.
    """
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(load_pieces(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg = Segmenter(vocabulary.value, nbest)
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1)
            for lo in range(0, len(texts), TOGETHER):
                part = texts.slice(lo, TOGETHER).to_pylist()
                coded = seg.encode_all(part)
                every = [x for found in coded for x in found]
                scores, counts = pa.array([s for s, _ in every], pa.float64()), [len(found) for found in coded]
                ids = _listed(pa.array(np.concatenate([i for _, i in every])), [len(i) for _, i in every])
                yield pa.RecordBatch.from_arrays([
                    doc_ids.slice(lo, TOGETHER),
                    pa.array([len(found[0][1]) for found in coded], pa.int64()),
                    _listed(scores, counts),
                    pa.array([seg.spell(found[0][1]) == (b" " + t.encode() if t else b"")
                              for found, t in zip(coded, part)], pa.bool_()),
                    _listed(pa.StructArray.from_arrays([scores, ids], names=["score", "ids"]), counts),
                ], names=["doc_id", "n_pieces", "scores", "round_trip", "segmentations"])

    coded = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole("text").alias("text")).mapInArrow(run, SCHEMA)
    return coded.select("doc_id", F.get("segmentations", 0)["ids"].alias("ids"), "n_pieces", "scores", "round_trip", "segmentations")


def decode_documents(coded: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id and the text of ``ids``; null ids give the empty text."""
    vocabulary = coded.sparkSession.sparkContext.broadcast(load_pieces(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg = Segmenter(vocabulary.value)
        for batch in batches:
            texts = [seg.decode(i or []) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return coded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")
