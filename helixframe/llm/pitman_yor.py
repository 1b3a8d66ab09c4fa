"""LM scoring by a hierarchical Pitman-Yor model.

A restaurant of words stands for the up to WORD_ORDER - 1 words before a
token.  The parent of a context is the context without its oldest word, down
to the empty one, whose base spells a word character by character; there a
restaurant stands for a context of up to ORDER - 1 characters, down to the
empty one, whose base is uniform over the code points.  Customers of a
restaurant are the tables of its children: all training n-grams seat the
longest contexts of words, and the tables of the word restaurant are spelt.
A text's probability is the product of its words' and its end's, each given
the words before it.

Seating is sampled by Gibbs steps on the number of tables of each dish given
the rest of its restaurant and the parent's predictive probability, both as
they stood before the sweep: all dishes are redrawn at once, which is a
parallel approximation of the sampler that redraws one after another.  Up to
EXACT customers the step draws from the exact conditional (generalised
Stirling numbers); beyond, the further customers are seated in turn, with
the waiting time to the next new table drawn in closed form.  A dish seen
once has one customer and one table whatever is drawn, so only dishes seen
more often are swept; the others enter as fixed numbers.  Draws are seeded by
the row, so a lost task redraws the same seating.  Predictive probabilities
are averaged over the sweeps after BURN_IN.

Trigrams are dealt by their middle word, so all restaurants of one or two
words and their dishes meet in the part of that word, which sweeps them as
arrays; only tables of the empty context, spelling and each part's words
travel in a sweep.  A middle word of more than SLICE tokens is cut into
slices by the token: a pair of words is in one part still, and what parts
share, the sums of that word's restaurants, is added up over them in every
sweep.  Texts are split three times: to find such words, to count and to
score.  A part's rows are held in a few bytes each and sorted up to ROWS at a
time, cut between contexts.  So the memory of a task grows with the texts'
most frequent pair of words, not with the most frequent word.

Words travel as 64-bit numbers of their bytes; two words of one number stop
the run.
"""

from __future__ import annotations

import ctypes
import math
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, configured, remainder, shuffles_freed, whole
from .shingles import mix

ORDER = 4
BITS = 16
SWEEPS = 3
BURN_IN = 1
#: Discount and strength by length of context.
DISCOUNT = (0.3, 0.5, 0.6, 0.7)
STRENGTH = (1.0, 1.0, 1.0, 1.0)
#: A word and the words before it that its probability depends on.
WORD_ORDER = 3
WORD_DISCOUNT = (0.7, 0.8, 0.85)
WORD_STRENGTH = (10.0, 1.0, 1.0)
EXACT = 48
FEW_CUSTOMERS = 8
START, END = 2, 3
_BASE = 1.0 / 0x110000
#: Bytes of text whose trigrams are dealt together, and bytes of text that a part of the contexts stands for.
BLOCK = 8 << 20
_TOGETHER = 1 << 19
PART = 24 << 20
#: Bytes of text that a range of the words' numbers stands for.
RANGE = 64 << 20
#: Tokens of one middle word in a part, and a part's rows that are sorted at a time.
SLICE = 1 << 21
ROWS = 1 << 18
#: Frequent words that payloads have by their place in a list, and how often a block has those it tells of.
COMMON = 1 << 16
FEW = 8


def _codes(words: list[str]) -> np.ndarray:
    """Sixteen-bit symbols of words, each with ORDER - 1 starts before and one
    end after it.  Code points beyond 16 bits share the 2048 numbers of surrogates."""
    frame = chr(END) + chr(START) * (ORDER - 1)
    points = np.frombuffer((frame[1:] + frame.join(words) + frame[0]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    points = points.astype(np.uint64)
    return np.where(points > 0xFFFF, 0xD800 + points % 2048, points).astype(np.uint64)


def _ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Packed context and symbol at each position of each word, and the number of the word."""
    code = _codes(words)
    n = len(code) - ORDER + 1
    key = np.zeros(n, dtype=np.uint64)
    for k in range(ORDER):
        key = (key << np.uint64(BITS)) | code[k:k + n]
    sizes = np.array([len(w) + 1 for w in words])  # positions of a word, the end among them
    first = np.cumsum(sizes + ORDER - 1) - (sizes + ORDER - 1)
    owner = np.repeat(np.arange(len(words)), sizes)
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return key.view(np.int64)[first[owner] + within], owner


def _numbers(words: np.ndarray) -> np.ndarray:
    """64-bit numbers (SipHash) of the words' bytes."""
    return hash_array(words, categorize=False).view(np.int64)


def _number(word: bytes) -> int:
    return int(_numbers(np.array([word], dtype=object))[0])


#: Numbers of the end of a text and of the places before its first word.
_END, _BEFORE = _number(b""), 0


def _pack(*arrays: np.ndarray) -> bytes:
    """Whole-number arrays as compressed planes of their bytes, as many as the largest number fills (negative: all)."""
    planes, head = [], []
    for a in arrays:
        width = 8 if len(a) and a.min() < 0 else (int(a.max()).bit_length() + 7) // 8 if len(a) else 0
        planes += [(a >> (8 * k)).astype(np.uint8) for k in range(width)]
        head += [width, len(a)]
    data = b"".join(planes)
    head = np.array([len(arrays), len(data), *head], dtype=np.int64)
    return head.tobytes() + pa.Codec("zstd", compression_level=1).compress(data, asbytes=True)


def _unpack(data: bytes | pa.Buffer, narrow: bool = False) -> list[np.ndarray]:
    """The arrays packed; if narrow, those of one or two bytes in types of that size."""
    count, size = np.frombuffer(data, dtype=np.int64, count=2).tolist()
    head = np.frombuffer(data, dtype=np.int64, count=2 * count, offset=16).reshape(-1, 2)
    planes = np.frombuffer(pa.Codec("zstd").decompress(data[16 + 16 * count:], decompressed_size=size), dtype=np.uint8)
    out, lo = [], 0
    for width, n in head.tolist():
        a = np.zeros(n, dtype=(np.uint8, np.uint8, np.uint16)[width] if narrow and width < 3 else np.int32 if width < 4 else np.int64)
        for k in range(width):
            a |= planes[lo:lo + n].astype(a.dtype) << (8 * k)
            lo += n
        out.append(a)
    return out


@cache
def _trim():
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def _release() -> None:
    """Gives memory back that arrays no longer need; else a worker keeps its largest block or part until it ends."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows in tables of up to BLOCK bytes of text; a longer text is a table of its own."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False), dtype=np.int64)
        lo = 0
        while lo < batch.num_rows:
            before = int(ends[lo - 1]) if lo else 0
            hi = max(int(np.searchsorted(ends, before + BLOCK - size, "right")), lo + (not held))
            if hi > lo:
                held.append(batch.slice(lo, hi - lo))
                size += int(ends[hi - 1]) - before
            lo = hi
            if lo < batch.num_rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _coded(text: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of the texts, the index of each word met, and how many each text has.  A-Z lower-cased;
    Arrow's ASCII white space is blank and \\t to \\r."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(text.combine_chunks()))
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    offsets, met = lists.offsets.to_numpy(), lists.values.dictionary_encode()
    del lists
    words, index = met.dictionary, met.indices.to_numpy()
    empty = pc.index(words, "").as_py()
    if empty < 0:
        return words, index, np.diff(offsets)
    filled = index != empty
    upto = np.concatenate([[0], np.cumsum(filled)])
    index = index[filled]
    words = pa.concat_arrays([words.slice(0, empty), words.slice(empty + 1)])
    return words, index - (index > empty), np.diff(upto[offsets])


def _part(numbers: np.ndarray, slices: np.ndarray, parts: int) -> np.ndarray:
    """Of middle words and of their slices, which are in different parts."""
    return ((mix(numbers.view(np.uint64)) % np.uint64(parts)).astype(np.int64) + slices) % parts


def _frequent(docs: DataFrame, size: int, texts: int, tasks: int, parts: int) -> tuple[dict[int, int], np.ndarray]:
    """Into how many slices the middle words of more than SLICE tokens are cut, by their numbers; ordered numbers of
    COMMON frequent words.  Blocks keep to themselves what they have too rarely to make half a SLICE in all of them."""
    most = SLICE
    cut, common = {_BEFORE: texts // most + 1}, np.empty(0, dtype=np.int64)
    if (size + texts) // 2 > most:
        blocks = 2 * size // BLOCK + tasks
        few = max(1, min(FEW, most // (2 * blocks)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in _blocks(batches):
                words, index, _ = _coded(block.column("text"))
                n = np.bincount(index, minlength=len(words))
                at = np.flatnonzero(n >= few)
                found = _numbers(words.take(pa.array(at)).cast(pa.binary()).to_numpy(zero_copy_only=False).astype(object))
                del words, index, block
                _release()
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(n[at], pa.int64())], names=["h0", "n"])

        often = docs.select(whole("text").alias("text")).mapInArrow(run, "h0 long, n long").groupBy("h0").agg(F.sum("n").alias("n"))
        often = often.orderBy(F.desc("n"), "h0").limit(max(COMMON, 2 * (size + texts) // most)).collect()
        cut |= {x["h0"]: (x["n"] + (few - 1) * blocks) // most + 1 for x in often if x["n"] >= most // 2}
        common = np.sort(np.array([x["h0"] for x in often[:COMMON]], dtype=np.int64))
    return {h: min(k, parts) for h, k in cut.items() if min(k, parts) > 1}, common


def _order(c0: np.ndarray, c1: np.ndarray, c2: np.ndarray, size: int) -> np.ndarray:
    """Order of trigrams by c1, c2 and c0, all below size; they come as a few ordered runs."""
    if size < 1 << 21:
        key = _key(c1, c2, 21)
        key <<= 21
        key |= c0
        return np.argsort(key, kind="stable")
    return np.lexsort((c0, c2, c1))


def _key(high: np.ndarray, low: np.ndarray, bits: int) -> np.ndarray:
    key = high.astype(np.int64)
    key <<= bits
    key |= low
    return key


def _by_two(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Order by a and b, which is below size."""
    least = int(a.min())
    low, high = len(a).bit_length(), size.bit_length()
    if low + high + (int(a.max()) - least).bit_length() > 63:
        return np.lexsort((b, a))
    packed = _key(a - least, b, high)
    packed <<= low
    packed |= np.arange(len(a))
    packed.sort()
    packed &= (1 << low) - 1
    return packed


def _ranks(at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The different numbers below size among those given, and which of them each is."""
    met = np.zeros(size, dtype=bool)
    met[at] = True
    return np.flatnonzero(met), (np.cumsum(met, dtype=np.int32) - 1)[at]


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins in ordered columns."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _dealt(docs: DataFrame, parts: int, cut: dict[int, int], common: np.ndarray, scored: bool) -> DataFrame:
    """part, payload, spelt: the trigrams of blocks of texts, dealt by their
    middle word (the one before the token) and, if that is cut, by the token.
    All restaurants of a part's contexts and all their dishes meet in it, but
    for those of words that are cut.  A payload has the places of its words
    in ``common`` or else their numbers, and indices into the words: of
    distinct trigrams with how often they are learnt or, if scored, of all
    tokens with their texts.
    ``spelt`` (not if scored): the middle words."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       (remainder("doc_id", 7) == 2).alias("held_out"), whole("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            words, index, sizes = _coded(block.column("text"))
            block = block.drop_columns("text")
            raw = np.concatenate([np.array([b"", b""], dtype=object), words.cast(pa.binary()).to_numpy(zero_copy_only=False)])
            numbers = np.concatenate([[_BEFORE, _END], _numbers(raw[2:])]).astype(np.int64)
            by_number = np.argsort(numbers)
            numbers, raw = numbers[by_number], raw[by_number]
            code = np.empty(len(numbers), dtype=np.int32)
            code[by_number] = np.arange(len(numbers), dtype=np.int32)
            before, end = code[:2].tolist()
            owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes + 1)
            place = np.arange(len(owner), dtype=np.int32)
            place += 2 * (owner + 1)
            own = np.ones(len(owner), dtype=bool)
            own[np.cumsum(sizes + 1) - 1] = False
            line = np.full(len(owner) + 2 * len(sizes), before, dtype=np.int32)
            tokens = np.full(len(owner), end, dtype=np.int32)
            tokens[own] = code[2 + index]
            line[place] = tokens
            columns = [tokens, line[place - 1], line[place - 2]]
            del words, index, own, place, line, code
            # middle words, and once more for each further slice of those that are cut, ordered by part
            slices = np.ones(len(numbers), dtype=np.int64)
            often = np.flatnonzero(np.isin(numbers, list(cut)))
            slices[often] = [cut[x] for x in numbers[often].tolist()]
            word = np.concatenate([np.arange(len(numbers)), np.repeat(np.arange(len(numbers)), slices - 1)])
            further = len(numbers) + np.cumsum(slices - 1) - (slices - 1)
            within = np.concatenate([np.zeros(len(numbers), np.int64), np.arange(len(numbers), len(word)) - further[word[len(numbers):]] + 1])
            part_of = _part(numbers[word], within, parts)
            by_part = np.lexsort((word, part_of))
            entry = np.empty(len(word), dtype=np.int32)
            entry[by_part] = np.arange(len(word), dtype=np.int32)
            word, part_of = word[by_part].astype(np.int32), part_of[by_part]
            middle = columns[1]
            columns[1] = entry[middle]
            if len(often):
                at = np.flatnonzero(slices[middle] > 1)
                slice_of = (mix(numbers.view(np.uint64))[tokens[at]] % slices[middle[at]].astype(np.uint64)).astype(np.int64)
                at, slice_of = at[slice_of > 0], slice_of[slice_of > 0]
                columns[1][at] = entry[further[middle[at]] + slice_of - 1]
            del middle, tokens
            if scored:
                order = _by_two(columns[1], columns[2], len(word))
                columns, more = [c[order] for c in columns], owner[order]
                del order
            else:
                columns, more = _distinct(*columns, (~block.column("held_out").to_numpy())[owner], len(word))
            ends = np.searchsorted(part_of[columns[1]], np.arange(parts + 1))
            columns[1] = word[columns[1]]
            listed = np.searchsorted(common, numbers)
            is_common = np.append(common, 0)[listed] == numbers
            is_common &= listed < len(common)
            used, local = np.zeros(len(numbers), dtype=bool), np.empty(len(numbers), dtype=np.int32)
            dealt, payloads, spelt = [], [], []
            for part in np.flatnonzero(np.diff(ends)).tolist():
                some = [c[ends[part]:ends[part + 1]] for c in columns]
                for c in some:
                    used[c] = True
                here = np.flatnonzero(used)
                used[here] = False
                local[here] = np.arange(len(here), dtype=np.int32)
                arrays = [np.diff(listed[here][is_common[here]], prepend=0), numbers[here][~is_common[here]], local[some[0]], np.diff(local[some[1]], prepend=np.int32(0)), local[some[2]],
                          more[ends[part]:ends[part + 1]]]
                if scored:
                    arrays[5:] = _texts_here(block, some[0] == end, arrays[5])
                dealt.append(part)
                payloads.append(_pack(*arrays))
                spelt.append(None if scored else b" ".join(raw[some[1][_starts(some[1])]]))
            del block, raw, owner, columns, more, some, arrays
            _release()
            yield pa.RecordBatch.from_arrays([pa.array(dealt, pa.int64()), pa.array(payloads, pa.binary()), pa.array(spelt, pa.binary())],
                                             names=["part", "payload", "spelt"])

    return rows.mapInArrow(run, "part long, payload binary, spelt binary")


def _distinct(c0: np.ndarray, c1: np.ndarray, c2: np.ndarray, learnt: np.ndarray, size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct trigrams ordered by c1, c2 and c0, and how often they are learnt."""
    if size < 1 << 21:
        key = _key(c1, c2, 21)
        key <<= 21
        key |= c0
        key = key.view(np.uint64)
        key <<= np.uint64(1)
        key |= learnt
        key.sort()
        learnt = (key & np.uint64(1)).astype(np.int32)
        key >>= np.uint64(1)
        start = np.flatnonzero(_starts(key))
        key = key[start]
        low = np.uint64((1 << 21) - 1)
        return [(key >> np.uint64(k) & low).astype(np.int32) for k in (0, 42, 21)], np.add.reduceat(learnt, start).astype(np.int32)
    order = _order(c0, c1, c2, size)
    columns = [c[order] for c in (c0, c1, c2)]
    start = np.flatnonzero(_starts(*columns))
    return [c[start] for c in columns], np.add.reduceat(learnt[order].astype(np.int32), start)


def _texts_here(block: pa.Table, ends: np.ndarray, owner: np.ndarray) -> list[np.ndarray]:
    """Which of the texts here each token is of; first row of the block, steps between the texts' places in it, which are
    held out, and of those whose end is here: which they are, doc_id, without id."""
    texts, owner = _ranks(owner, block.num_rows)
    ids = block.column("doc_id").take(pa.array(texts[owner[ends]]))
    return [owner, block.column("row").to_numpy()[:1], np.diff(texts, prepend=0), block.column("held_out").to_numpy()[texts].astype(np.uint8),
            owner[ends], pc.fill_null(ids, 0).to_numpy().astype(np.int64), pc.is_null(ids).to_numpy().astype(np.uint8)]


@cache
def _stirling(discount: float, size: int) -> np.ndarray:
    """log of the generalised Stirling numbers S(c, t), c and t up to size."""
    s = np.full((size + 1, size + 1), -np.inf)
    s[0, 0] = 0.0
    for c in range(size):
        for t in range(1, c + 2):
            stay = s[c, t] + math.log(c - discount * t) if c - discount * t > 0 and s[c, t] > -np.inf else -np.inf
            s[c + 1, t] = np.logaddexp(s[c, t - 1], stay)
    return s


def _uniform(seed: np.ndarray, draw: np.ndarray | int) -> np.ndarray:
    h = mix(mix(seed.view(np.uint64)) + (np.atleast_1d(np.asarray(draw, dtype=np.uint64)) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def _few_tables(size: int, others: np.ndarray, parent: np.ndarray, u: np.ndarray, discount: float, strength: float) -> np.ndarray:
    """Numbers of tables of dishes with as many customers each; a weight is that of a table less times a ratio."""
    stirling = _stirling(discount, EXACT)[size]
    weight = np.ones(len(others))
    upto = [weight]
    for t in range(1, size):
        weight = weight * (strength + discount * (others + t)) * parent * math.exp(stirling[t + 1] - stirling[t])
        upto.append(upto[-1] + weight)
    u = u * upto[-1]
    tables = np.ones(len(others), dtype=np.int64)
    for x in upto[:-1]:
        tables += x < u
    return tables


def sample_tables(customers: np.ndarray, others: np.ndarray, parent: np.ndarray, seed: np.ndarray,
                  discount: float, strength: float) -> np.ndarray:
    """Number of tables of each dish given its customers, the tables of the
    restaurant's other dishes and the parent's probability of the dish."""
    tables = np.minimum(customers, 1).astype(np.int64)
    stirling = _stirling(discount, EXACT)
    for size in range(2, FEW_CUSTOMERS + 1):
        at = np.flatnonzero(customers == size)
        if len(at):
            tables[at] = _few_tables(size, others[at], parent[at], _uniform(seed[at], 0), discount, strength)
    several = np.flatnonzero(customers > FEW_CUSTOMERS)
    several = several[np.argsort(np.minimum(customers[several], EXACT), kind="stable")]
    for lo in range(0, len(several), 20_000):
        at = several[lo:lo + 20_000]
        c = np.minimum(customers[at], EXACT)
        t = np.arange(1, int(c[-1]) + 1)  # no dish of these has more tables
        opened = np.cumsum(np.log(strength + discount * (others[at, None] + t[None, :] - 1)), axis=1)
        weight = stirling[c][:, t] + opened + t[None, :] * np.log(parent[at, None])
        weight = np.exp(weight - weight.max(axis=1, keepdims=True))
        upto = np.cumsum(weight, axis=1)
        u = _uniform(seed[at], 0) * upto[:, -1]
        tables[at] = 1 + (upto < u[:, None]).sum(axis=1)
    at = np.flatnonzero(customers > EXACT)
    most, rest, p, t = (x[at].astype(np.float64) for x in (customers, others, parent, tables))
    seated = np.full(len(at), float(EXACT))
    draw = 1
    while len(at):
        steps = 1 if len(at) > 4096 else 32
        logs = -np.log(_uniform(seed[at], np.arange(draw, draw + steps)[:, None]))
        for k in range(steps):  # a dish whose next table is beyond its customers stays as it is
            new = (strength + discount * (rest + t)) * p
            old = seated - discount * t + (new - 1) / 2
            wait = np.minimum(logs[k] / np.maximum(new, 1e-300), 80.0)
            seated = np.minimum(seated + np.maximum(old, 0.5) * np.expm1(wait), 1e200)
            seated = np.ceil(np.maximum(seated, EXACT + 1.0))
            on = seated <= most
            t += on
        tables[at] = t
        at, most, rest, p, t, seated = (x[on] for x in (at, most, rest, p, t, seated))
        draw += steps
    return tables


def _mask(symbols: int) -> Column:
    return F.lit((1 << (BITS * symbols)) - 1 if symbols < ORDER else -1).cast("long")


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
    """Columns of up to _TOGETHER rows at a time: the draws for many customers go on for as many steps as their longest."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if held and sum(map(len, held)) + len(batch) > _TOGETHER:
            yield [pa.concat_arrays([b.column(k) for b in held]) for k in range(batch.num_columns)]
            held = []
        held.append(batch)
    if held:
        yield [pa.concat_arrays([b.column(k) for b in held]) for k in range(held[0].num_columns)]


def _reseat(level: DataFrame, length: int, sweep: int) -> DataFrame:
    """key, c, t: the level with its tables drawn anew."""
    discount, strength = DISCOUNT[length], STRENGTH[length]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _together(batches):
            key, c, others, parent = (x.to_numpy() for x in columns)
            seed = key ^ np.int64(sweep * 1_000_003 + length * 7919 + 1)
            t = sample_tables(c, np.maximum(others, 0), parent, seed, discount, strength)
            yield pa.RecordBatch.from_arrays([*columns[:2], pa.array(t)], names=["key", "c", "t"])

    return level.select("key", "c", "others", "parent").mapInArrow(run, "key long, c long, t long")


def _predictive(levels: list[DataFrame], tables: Scratch) -> list[DataFrame]:
    """key, c, t, others, parent, p of every level, from the empty context up."""
    out: list[DataFrame] = []
    for length, rows in enumerate(levels):
        restaurant = Window.partitionBy(F.shiftrightunsigned("key", BITS) if length else F.lit(0))
        rows = rows.withColumns({"customers": F.sum("c").over(restaurant), "tables": F.sum("t").over(restaurant)})
        if length:
            below = out[-1].select(F.col("key").alias("__key"), F.col("p").alias("parent"))
            rows = rows.join(below, rows.key.bitwiseAND(_mask(length)) == F.col("__key")).drop("__key")
        else:
            rows = rows.withColumn("parent", F.lit(_BASE))
        d, s = DISCOUNT[length], STRENGTH[length]
        own = F.greatest(F.col("c") - d * F.col("t"), F.lit(0.0))
        p = (own + (s + d * F.col("tables")) * F.col("parent")) / (s + F.col("customers"))
        rows = rows.select("key", "c", "t", (F.col("tables") - F.col("t")).alias("others"), "parent", p.alias("p"))
        out.append(tables.land(rows, "characters"))
    return out


def _passed_down(level: DataFrame, length: int, rows: DataFrame) -> DataFrame:
    """The level below with the customers that the tables of ``rows`` send it."""
    sent = rows.groupBy(F.col("key").bitwiseAND(_mask(length)).alias("__key")).agg(F.sum("t").alias("sent"))
    return level.join(sent, level.key == F.col("__key")).drop("__key", "c").withColumnRenamed("sent", "c")


def _first_levels(counts: DataFrame, tables: Scratch) -> list[DataFrame]:
    """The levels of characters for n-grams of ``counts`` (key, c; c may be 0), to begin with a table for each dish."""
    levels = [tables.land(counts.select("key", "c", F.least("c", F.lit(1)).alias("t")), "level")]
    for length in range(ORDER - 1, 0, -1):
        key = F.col("key").bitwiseAND(_mask(length))
        lower = levels[0].groupBy(key.alias("key")).agg(F.sum("t").alias("c"))
        levels.insert(0, tables.land(lower.withColumn("t", F.least("c", F.lit(1))), "level"))
    return _predictive(levels, tables)


def _sweep_characters(state: list[DataFrame], counts: DataFrame, sweep: int, tables: Scratch) -> list[DataFrame]:
    """The levels of characters with their tables drawn anew for ``counts``."""
    above: DataFrame | None = None
    new: list[DataFrame] = []
    for length in range(ORDER - 1, -1, -1):
        level = state[length].drop("c").join(counts, "key") if above is None else _passed_down(state[length], length + 1, above)
        above = tables.land(_reseat(level, length, sweep), "level")
        new.insert(0, above)
    return _predictive(new, tables)


def _written(words: DataFrame) -> DataFrame:
    """part, gram, n: the character n-grams that a part of the words (word, part, t) has, each word spelt t times."""
    def grams_of(part: pa.Table) -> pa.Table:
        key, owner = _ngrams(part.column("word").to_pylist())
        found, inverse = np.unique(key, return_inverse=True)
        n = np.bincount(inverse, weights=part.column("t").to_numpy()[owner], minlength=len(found)).astype(np.int64)
        return pa.table({"part": pa.array(np.full(len(found), part.column("part")[0].as_py())), "gram": found, "n": n})

    return words.select("word", "part", "t").groupBy("part").applyInArrow(grams_of, "part long, gram long, n long")


def _spelt(words: DataFrame, grams: DataFrame, p: DataFrame) -> DataFrame:
    """h0, spelt: the probability of each word's spelling, from the probabilities (key, p) of its n-grams."""
    def spell(known: pa.Table, part: pa.Table) -> pa.Table:
        key = known.column("gram").to_numpy()
        order = np.argsort(key)
        key, logs = key[order], np.log(known.column("p").to_numpy()[order])
        found, owner = _ngrams(part.column("word").to_pylist())
        spelt = np.exp(np.maximum(np.bincount(owner, weights=logs[np.searchsorted(key, found)], minlength=part.num_rows), -700))
        return pa.table([part.column("h0"), pa.array(spelt)], names=["h0", "spelt"])

    known = grams.select("part", "gram").join(p, F.col("gram") == F.col("key")).select("part", "gram", "p")
    return known.groupBy("part").cogroup(words.select("h0", "word", "part").groupBy("part")).applyInArrow(
        spell, "h0 long, spelt double")


def _reseat_unigrams(sweep: int):
    """h0, c, t: a range of the empty context's dishes with their tables drawn anew."""
    def run(level: pa.Table, told: pa.Table) -> pa.Table:
        order = np.argsort(level.column("h0").to_numpy())
        h0, c, others, parent = (level.column(k).to_numpy()[order] for k in ("h0", "fixed", "others", "parent"))
        c = c.copy()
        for x in told.column("payload"):
            numbers, sent = _unpack(x.as_buffer())
            c[np.searchsorted(h0, numbers)] += sent
        t = sample_tables(c, np.maximum(others, 0), parent, word_seed([h0], sweep), WORD_DISCOUNT[0], WORD_STRENGTH[0])
        return pa.table({"h0": h0, "c": c, "t": t})
    return run


def word_seed(h: list[np.ndarray], sweep: int) -> np.ndarray:
    start = np.full(len(h[0]), sweep * 1_000_003 + len(h), dtype=np.uint64)
    return reduce(lambda s, k: mix(s ^ k.view(np.uint64)), h, start).view(np.int64)


def _word_probability(length: int, c, t, customers, tables, parent):
    """Of a dish, from columns or from arrays."""
    d, s = WORD_DISCOUNT[length], WORD_STRENGTH[length]
    own = F.greatest(c - d * t, F.lit(0.0)) if isinstance(c, Column) else np.maximum(c - d * t, 0.0)
    return (own + (s + d * tables) * parent) / (s + customers)


class _Rows:
    """The rows of a part's payloads, of which each has them ordered by context and token: a run of whole contexts at a
    time, up to about ``limit`` rows but for a longer context."""

    def __init__(self, payloads: list[pa.Buffer], common: np.ndarray, limit: int):
        self.payloads, words, self.ends = [], [], []
        for x in payloads:
            listed, others, c0, step, c2, *more = _unpack(x, narrow=True)
            numbers = np.sort(np.concatenate([common[np.cumsum(listed, dtype=np.int64)], others.astype(np.int64)]))
            words.append(numbers)
            self.payloads.append([c0, np.cumsum(step, dtype=np.uint16 if len(numbers) <= 1 << 16 else np.int32), c2, *more])
        numbers = np.sort(np.concatenate(words))
        self.numbers = numbers[_starts(numbers)]
        self.code = [np.searchsorted(self.numbers, x).astype(np.int32) for x in words]
        sizes = [len(x[0]) for x in self.payloads]
        step = 1 + limit // 256
        cuts = np.sort(np.concatenate([self._contexts(k, -at % step, step) for k, at in enumerate(np.cumsum(sizes) - sizes)]))
        cuts = cuts[limit // step::limit // step] if sum(sizes) > limit else cuts[:0]
        self.cuts = self._at_words(cuts)
        for k, size in enumerate(sizes):
            inner = np.searchsorted(self._contexts(k, 0, 1), self.cuts) if len(self.cuts) else self.cuts
            self.ends.append(np.concatenate([[0], inner, [size]]))

    @staticmethod
    def _at_words(cuts: np.ndarray) -> np.ndarray:
        """Cuts where a middle word begins, and within those that are cut more than once."""
        out, last = [], -1
        for x in cuts.tolist():
            x = x >> 32 << 32 if x >> 32 << 32 > last else x
            if x > last:
                out.append(x)
                last = x
        return np.array(out, dtype=np.int64)

    def _contexts(self, k: int, first: int, step: int) -> np.ndarray:
        _, c1, c2, *_ = self.payloads[k]
        return (self.code[k][c1[first::step]].astype(np.int64) << 32) | self.code[k][c2[first::step]]

    def runs(self) -> Iterator[tuple[list[np.ndarray], list[np.ndarray], bool]]:
        """The three words of a run's rows, what else each payload has of them, and if a middle word ends with the run."""
        ends = np.array(self.ends).T
        for lo, hi, cut in zip(ends[:-1], ends[1:], [*self.cuts.tolist(), 0]):
            if (hi > lo).any():
                some = [(code, [c[i:j] for c in x[:4]]) for code, x, i, j in zip(self.code, self.payloads, lo, hi)]
                yield [np.concatenate([code[x[k]] for code, x in some]) for k in range(3)], [x[3] for _, x in some], not cut & ((1 << 32) - 1)


def _sum(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(at, weights=values, minlength=size).astype(np.int64)


def _range(numbers: np.ndarray, ranges: int) -> np.ndarray:
    """The range that a number is in, in the order of numbers."""
    return (((numbers.view(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _range_of(column: str, ranges: int) -> Column:
    return F.shiftright(F.shiftrightunsigned(F.col(column).bitwiseXOR(F.lit(-(1 << 63))), 32) * ranges, 32).alias("range")


def _ranged(ranges: int, numbers: np.ndarray, *columns: np.ndarray) -> tuple[list[int], list[bytes]]:
    """Ranges, and what is packed for each, of ordered numbers and what is said of them."""
    ends = np.searchsorted(_range(numbers, ranges), np.arange(ranges + 1))
    some = np.flatnonzero(np.diff(ends)).tolist()
    return some, [_pack(*(c[ends[k]:ends[k + 1]] for c in (numbers, *columns))) for k in some]


def _pairs(found: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Ordered keys, each once, and the sums of their numbers, from those of the runs."""
    if len(found) == 1:
        return found[0]
    key = np.concatenate([x[0] for x in found])
    order = np.argsort(key)
    first = np.flatnonzero(_starts(key[order]))
    sums = [np.add.reduceat(np.concatenate(x)[order], first) for x in list(zip(*found))[1:]]
    return key[order[first]], *sums


def _merged(runs: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """As _pairs, of runs in the order of contexts: only the last word of one and the first of the next can be the same."""
    out, last = [], None
    for x in runs:
        if last is not None:
            k = int(np.searchsorted(x[0], ((last[0][-1] >> 32) + 1) << 32))
            out.append(_pairs([last, tuple(c[:k] for c in x)]) if k else last)
            x, last = tuple(c[k:] for c in x), None
            if not len(x[0]):
                last = out.pop()
                continue
        k = int(np.searchsorted(x[0], x[0][-1] >> 32 << 32))
        out.append(tuple(c[:k] for c in x))
        last = tuple(c[k:] for c in x)
    return tuple(np.concatenate(c) for c in zip(*out, last))


def _lists(**columns: np.ndarray) -> dict[str, pa.Array]:
    return {k: pa.array([v]) for k, v in columns.items()}


def _structs(name: str, columns: list[list], names: tuple[str, ...]) -> dict[str, pa.Array]:
    """A list of what is said by range."""
    x = pa.StructArray.from_arrays([pa.array(columns[0], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[1:])], names=["range", *names])
    return {name: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)}


def _passed_on(state: list[np.ndarray], seats: list[np.ndarray]) -> dict[str, pa.Array]:
    """What swept dishes add to the customers and tables of the restaurants of words that are cut, by the restaurant's place."""
    at2, at3, once2, once3, in3, place3, in2, place2 = (state[k] for k in (3, 5, 8, 10, 11, 12, 13, 14))
    t3, t2, customers2 = seats
    c = np.concatenate([np.zeros(len(in3), np.int64), _sum(at2, customers2, len(once2))[in2]])
    t = np.concatenate([_sum(at3, t3, len(once3))[in3], _sum(at2, t2, len(once2))[in2]])
    return _lists(place=np.concatenate([place3, place2]).astype(np.int64), c=c, t=t)


def _counted(limit: int, cut: dict[int, int], common: np.ndarray, ranges: int):
    """A part's dishes learnt more than once (state), what is fixed around
    them, a table for each to begin with (seats), what goes to the empty
    context by range (words met, bigrams learnt once by word, swept bigrams
    by word, how often words are learnt; middle words and their spelling;
    words with swept bigrams), and the restaurants of words that are cut:
    their places (of words below 0), words, fixed customers and tables."""
    def run(part: pa.Table) -> pa.Table:
        rows = _Rows([x.as_buffer() for x in part.column("payload")], common, limit)
        size = len(rows.numbers)
        is_cut = np.isin(rows.numbers, list(cut))
        live, shared, in3, place3, pairs, n_live, places = [], [], [], [], [], 0, 0
        for columns, n, _ in rows.runs():
            order = _order(*columns, size)
            columns = [c[order] for c in columns]
            first = np.flatnonzero(_starts(*columns))
            n3 = np.add.reduceat(np.concatenate(n)[order].astype(np.int64), first)
            c0, c1, c2 = (c[first] for c in columns)
            begins = np.flatnonzero(_starts(c1, c2))
            context = np.repeat(np.arange(len(begins)), np.diff(begins, append=len(c0)))
            once = np.bincount(context[n3 == 1], minlength=len(begins))
            several = n3 > 1
            met, at3 = _ranks(context[several], len(begins))
            live.append([c0[several], c1[several], c2[several], n3[several].astype(np.int32), (at3 + n_live).astype(np.int32), once[met]])
            ours = is_cut[c1[begins]]
            if ours.any():
                shared.append([rows.numbers[c1[begins]][ours], rows.numbers[c2[begins]][ours], np.add.reduceat(n3, begins)[ours], once[ours]])
                mine = np.flatnonzero(ours[met])
                in3.append(mine + n_live)
                place3.append((np.cumsum(ours) - 1)[met[mine]] + places)
                places += int(ours.sum())
            n_live += len(met)
            order = _by_two(c1, c0, size)
            first = np.flatnonzero(_starts(c1[order], c0[order]))
            key = (c1[order[first]].astype(np.int64) << 32) | c0[order[first]]
            pairs.append((key, np.add.reduceat(n3[order], first, dtype=np.int32), np.add.reduceat((n3 == 1)[order], first, dtype=np.int32)))
            del columns, order, first, n3, c0, c1, c2, context, several, key
        c0, c1, c2, n3, at3, once3 = (np.concatenate(x) for x in zip(*live))
        key, n2, fixed = _merged(pairs)
        del live, pairs
        b1, b0 = (key >> 32).astype(np.int32), (key & ((1 << 32) - 1)).astype(np.int32)
        begins = np.flatnonzero(_starts(b1))
        word = np.repeat(np.arange(len(begins), dtype=np.int32), np.diff(begins, append=len(b1)))
        live2 = n2 > 1
        firsts, at2 = _ranks(word[live2], len(begins))
        once = np.bincount(word[n2 == 1], minlength=len(begins))
        met = np.flatnonzero(np.bincount(b0, minlength=size))
        own, words = _own_words(part, rows)
        # the restaurants of words that are cut: their contexts of two words, then themselves, with _END for the word before
        ours = np.flatnonzero(is_cut[b1[begins]])
        shared.append([rows.numbers[b1[begins[ours]]], np.full(len(ours), _END), once[ours], once[ours]])
        shared = [np.concatenate(x).astype(np.int64) for x in zip(*shared)]
        in2 = np.flatnonzero(is_cut[b1[begins[firsts]]])
        place2 = -1 - np.searchsorted(ours, firsts[in2])
        placed = np.concatenate([np.arange(places), -1 - np.arange(len(ours))])
        nothing = np.empty(0, dtype=np.int64)
        in3, place3 = np.concatenate([nothing, *in3]), np.concatenate([nothing, *place3])
        n = _sum(b0, n2, size)[met]
        lone = _sum(b0, n2 == 1, size)[met]
        pair = np.searchsorted(key[live2], (c1.astype(np.int64) << 32) | c0)
        b0, b1, fixed = b0[live2], b1[live2], fixed[live2]
        sent = np.bincount(b0, minlength=size)[met]
        used, inverse = _ranks(np.concatenate([b0, b1, c2]), size)
        state = [rows.numbers[used], inverse[:len(b0)], inverse[len(b0):2 * len(b0)], at2, inverse[2 * len(b0):], at3, pair, fixed,
                 once[firsts], n3, once3, in3, place3, in2, place2]
        seats = [np.ones(len(pair), np.int64), np.ones(len(b0), np.int64), fixed + np.bincount(pair, minlength=len(b0))]
        met = rows.numbers[met]
        told, asked = _ranged(ranges, met, lone, sent, n), _ranged(ranges, met[sent > 0])
        ends = np.searchsorted(_range(own, ranges), np.arange(ranges + 1))
        spelt = [(own[i:j], b" ".join(words[i:j])) for i, j in zip(ends[told[0]], ends[np.array(told[0]) + 1])]
        told = [told[0], told[1], [_pack(x) for x, _ in spelt], [x for _, x in spelt]]
        del rows
        _release()
        return pa.table({
            "part": part.column("part").slice(0, 1), "state": pa.array([_pack(*state)], pa.binary()), "seats": pa.array([_pack(*seats)], pa.binary()),
            **_structs("told", told, ("met", "own", "spelt")), **_structs("asked", asked, ("payload",)),
            **_lists(rp=placed, **dict(zip(("r1", "r2", "rc", "rt"), shared))), **_passed_on(state, seats)})
    return run


def _own_words(part: pa.Table, rows: _Rows) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the middle words dealt to a part, of texts' ends for their beginnings, and the words."""
    own = np.concatenate([rows.numbers[code[x[1][_starts(x[1])]]] for code, x in zip(rows.code, rows.payloads)])
    words = np.array([w for x in part.column("spelt").to_pylist() for w in x.split(b" ")], dtype=object)
    order = np.argsort(own, kind="stable")
    own, words = own[order], words[order]
    new = _starts(own)
    if (words[1:] != words[:-1])[~new[1:]].any():
        raise ValueError("two different words share one number")
    own, words = own[new], words[new]
    own[own == _BEFORE] = _END  # as many texts begin as end
    order = np.argsort(own)
    return own[order], words[order]


def _vocabulary(rows: pa.Table) -> pa.Table:
    """The words of a range with what parts have of them."""
    own = np.concatenate([_unpack(x.as_buffer())[0].astype(np.int64) for x in rows.column("own")])
    words = np.array([w for k, x in zip(rows.column("own"), rows.column("spelt").to_pylist()) if len(_unpack(k.as_buffer())[0]) for w in x.split(b" ")],
                     dtype=object)
    order = np.argsort(own, kind="stable")
    own, words = own[order], words[order]
    new = _starts(own)
    if (words[1:] != words[:-1])[~new[1:]].any():
        raise ValueError("two different words share one number")
    h0, *sums = _pairs([tuple(c.astype(np.int64) for c in _unpack(x.as_buffer())) for x in rows.column("met")])
    words = pa.array(words[new][np.searchsorted(own[new], h0)], pa.binary()).cast(pa.string())
    return pa.table([pa.array(h0), words, *map(pa.array, sums)], names=["h0", "word", "fixed", "sent", "n"])


def _answered(*columns: str):
    """What is known of the words that parts ask for, in their order."""
    def run(known: pa.Table, asked: pa.Table) -> pa.Table:
        order = np.argsort(known.column("h0").to_numpy())
        h0, *values = (known.column(c).to_numpy()[order] for c in ("h0", *columns))
        out = []
        for x in asked.column("payload"):
            at = np.searchsorted(h0, _unpack(x.as_buffer())[0])
            out.append(_pack(*(v[at].view(np.int64) for v in values)))
        return pa.table({"part": asked.column("part"), "range": asked.column("range"), "payload": pa.array(out, pa.binary())})
    return run


def _added(own: np.ndarray, at: np.ndarray, places: np.ndarray, given: list[np.ndarray], k: int) -> None:
    """Puts the sums over all parts (k 1: customers, 2: tables) where restaurants have their own; what one part has is not given."""
    if given and len(places):
        there = np.minimum(np.searchsorted(given[0], places), len(given[0]) - 1)
        found = given[0][there] == places
        own[at[found]] = given[k][there[found]]


def _swept(sweep: int, ranges: int):
    """Draws a part's tables anew, given the sums over all parts and the probabilities of its words in the empty context."""
    def run(part: pa.Table) -> pa.Table:
        kinds = part.column("kind").to_numpy()
        order = np.argsort(kinds)
        state, seats, *more = (_unpack(part.column("payload")[k].as_buffer()) for k in order.tolist())
        given = [x for x, k in zip(more, kinds[order[2:]]) if k == 2]
        known = np.concatenate([np.empty(0), *(x[0].astype(np.int64).view(np.float64) for x, k in zip(more, kinds[order[2:]]) if k > 2)])
        numbers, b0, b1, at2, c2, at3, pair, fixed, once2, n3, once3, in3, place3, in2, place2 = state
        given = given[0] if given else []
        numbers = numbers.astype(np.int64)
        t3, t2, customers2 = seats
        words, where = _ranks(b0, len(numbers))
        parent2 = known[where]
        tables2, all2 = once2 + _sum(at2, t2, len(once2)), once2 + _sum(at2, customers2, len(once2))
        _added(all2, in2, place2, given, 1)
        _added(tables2, in2, place2, given, 2)
        p2 = _word_probability(1, customers2, t2, all2[at2], tables2[at2], parent2)
        tables3 = once3 + _sum(at3, t3, len(once3))
        _added(tables3, in3, place3, given, 2)
        h = [numbers[x] for x in (b0[pair], b1[pair], c2)]
        others3 = tables3[at3] - t3
        t3 = sample_tables(n3, np.maximum(others3, 0), p2[pair], word_seed(h, sweep), WORD_DISCOUNT[2], WORD_STRENGTH[2])
        customers2 = fixed + _sum(pair, t3, len(b0))
        t2 = sample_tables(customers2, np.maximum(tables2[at2] - t2, 0), parent2, word_seed([numbers[b0], numbers[b1]], sweep),
                           WORD_DISCOUNT[1], WORD_STRENGTH[1])
        seats = [t3, t2, customers2]
        return pa.table({"part": part.column("part").slice(0, 1), "seats": pa.array([_pack(*seats)], pa.binary()),
                         **_structs("told", _ranged(ranges, numbers[words], _sum(where, t2, len(words))), ("payload",)), **_passed_on(state, seats)})
    return run


def _scored(sweeps: int, limit: int, cut: dict[int, int], common: np.ndarray):
    """What a part's tokens add to the texts of each block: tokens, known ones, and log10 of base and model."""
    def run(part: pa.Table) -> pa.Table:
        kinds = part.column("kind").to_numpy()
        data = [[part.column("payload")[i].as_buffer() for i in np.flatnonzero(kinds == k).tolist()] for k in range(int(kinds.max()) + 1)]
        seats, given = [_unpack(x[0]) for x in data[:2 * sweeps:2]], [_unpack(x[0]) if x else [] for x in data[1:2 * sweeps:2]]
        n_word, *parent = (np.concatenate(x).astype(np.int64) for x in zip(*(_unpack(x) for k in data[2 * sweeps + 1:] for x in k)))
        rows = _Rows(data[2 * sweeps], common, limit)
        size = len(rows.numbers)
        is_cut = np.isin(rows.numbers, list(cut))
        start = np.cumsum([0, *(len(x[6]) for x in rows.payloads)])
        learnt = 1 - np.concatenate([x[6] for x in rows.payloads]).astype(np.int32)

        def owners(more: list[np.ndarray]) -> np.ndarray:
            return np.concatenate([x.astype(np.int32) + np.int32(at) for x, at in zip(more, start)])

        known = np.zeros(size, dtype=bool)
        for code, x in zip(rows.code, rows.payloads):
            known[code[x[0]]] = True
        at = np.cumsum(known, dtype=np.int32) - 1  # in the order of their numbers, as listed
        sums, base = np.zeros((3, start[-1])), np.log10(n_word + 1.0)
        done2 = done3 = places2 = places3 = 0
        held = []
        for columns, more, closed in rows.runs():
            order = _order(*columns, size)
            owner = owners(more)[order]
            columns = [c[order] for c in columns]
            new = _starts(*columns)
            first = np.flatnonzero(new)
            n3 = np.add.reduceat(learnt[owner], first, dtype=np.int32)
            c0, c1, c2 = (c[first] for c in columns)
            contexts = np.flatnonzero(_starts(c1, c2))
            context = np.repeat(np.arange(len(contexts), dtype=np.int32), np.diff(contexts, append=len(c0)))
            by_pair = _by_two(c1, c0, size)
            b0, b1 = c0[by_pair], c1[by_pair]
            begins = _starts(b1, b0)
            pair = np.empty(len(begins), dtype=np.int32)
            pair[by_pair] = np.cumsum(begins, dtype=np.int32) - 1
            begins = np.flatnonzero(begins)
            pairs = _key(b1[begins], b0[begins], 32), np.add.reduceat(n3[by_pair], begins, dtype=np.int32)
            held.append((pairs, pair, at[c0], n3, context, np.flatnonzero(is_cut[c1[contexts]]), owner, np.cumsum(new, dtype=np.int32) - 1))
            del columns, order, new, first, c0, c1, c2, by_pair, b0, b1, begins
            if not closed:
                continue
            # the pairs of the middle words that the held runs have whole
            key, n2 = _merged([x[0] for x in held])
            b1, b0 = (key >> 32).astype(np.int32), at[key & ((1 << 32) - 1)]
            begins = np.flatnonzero(_starts(b1))
            word = np.repeat(np.arange(len(begins), dtype=np.int32), np.diff(begins, append=len(b1)))
            live2 = n2 > 1
            upto = done2 + int(live2.sum())
            ours = np.flatnonzero(is_cut[b1[begins]])
            placed = -1 - places2 - np.arange(len(ours))
            p2 = []
            for k, (_, t2_live, c2_live) in enumerate(seats):
                t2, c2 = np.minimum(n2, 1), np.minimum(n2, 1)
                t2[live2], c2[live2] = t2_live[done2:upto], c2_live[done2:upto]
                all2, tables2 = _sum(word, c2, len(begins)), _sum(word, t2, len(begins))
                _added(all2, ours, placed, given[k], 1)
                _added(tables2, ours, placed, given[k], 2)
                p2.append(_word_probability(1, c2, t2, all2[word], tables2[word], parent[k].view(np.float64)[b0]))
            done2, places2 = upto, places2 + len(ours)
            for pairs, pair, word, n3, context, ours, owner, trigram in held:
                if len(held) > 1:
                    pair = np.searchsorted(key, pairs[0])[pair]
                live3 = n3 > 1
                upto = done3 + int(live3.sum())
                size3, placed = int(context[-1]) + 1, places3 + np.arange(len(ours))
                total = np.zeros(len(n3))
                for k, (t3_live, _, _) in enumerate(seats):
                    t3 = np.minimum(n3, 1)
                    t3[live3] = t3_live[done3:upto]
                    all3, tables3 = _sum(context, n3, size3), _sum(context, t3, size3)
                    _added(all3, ours, placed, given[k], 1)
                    _added(tables3, ours, placed, given[k], 2)
                    total += _word_probability(2, n3, t3, all3[context], tables3[context], p2[k][pair])
                done3, places3 = upto, places3 + len(ours)
                # back to the texts
                for out, values in zip(sums, (np.log10(total / sweeps), base[word], n_word[word] > 0)):
                    out += np.bincount(owner, weights=values[trigram], minlength=len(out))
            held = []
        if held:
            raise RuntimeError("rows of a part were left over")
        blocks, out = [], []
        for x, lo, hi in zip(rows.payloads, start[:-1].tolist(), start[1:].tolist()):
            *_, owner, first, texts, held_out, ended, ids, without = x
            score, known_as, n_known = (c[lo:hi] for c in sums)
            blocks.append(int(first[0]))
            texts = np.cumsum(texts, dtype=np.int64)
            out.append(_pack(texts, np.bincount(owner, minlength=hi - lo), n_known.astype(np.int64), known_as.view(np.int64), score.view(np.int64),
                             texts[ended], held_out[ended], ids, without))
        del rows, sums
        _release()
        return pa.table({"block": pa.array(blocks, pa.int64()), "payload": pa.array(out, pa.binary())})
    return run


def _texts(block: pa.Table) -> pa.Table:
    """The texts of a block, with the sums of what parts have of them."""
    found = [_unpack(x.as_buffer()) for x in block.column("payload")]
    size = 1 + max(int(x[5].max()) for x in found if len(x[5]))  # a text has one end
    sums = np.zeros((2, size), dtype=np.int64)
    logs = np.zeros((2, size))
    ids, flags = np.zeros(size, dtype=np.int64), np.zeros((2, size), dtype=bool)
    for texts, n_tokens, n_known, base, score, ended, held_out, doc_id, without in found:
        for out, x in zip((*sums, *logs), (n_tokens, n_known, base.view(np.float64), score.view(np.float64))):
            out[texts] += x
        ids[ended], flags[0, ended], flags[1, ended] = doc_id, held_out == 1, without == 1
    return pa.table({"doc_id": pa.array(ids, mask=flags[1]), "held_out": flags[0], "n_tokens": sums[0], "n_known": sums[1],
                     "base": logs[0], "score": logs[1]})


def _payload(rows: DataFrame, column: str, kind: Column | int) -> DataFrame:
    kind = kind if isinstance(kind, Column) else F.lit(kind)
    return rows.select("part", kind.cast("long").alias("kind"), F.col(column).alias("payload"))


def _answers(known: DataFrame, asked: DataFrame, ranges: int, first: int, *columns: str) -> DataFrame:
    """part, kind, payload: what is known of the words that parts ask for, of kinds that begin with ``first``."""
    known = known.select(_range_of("h0", ranges), "h0", *columns)
    rows = known.groupBy("range").cogroup(asked.groupBy("range")).applyInArrow(_answered(*columns), "part long, range long, payload binary")
    return _payload(rows, "payload", F.col("range") + first)


def _packed(totals: pa.Table) -> pa.Table:
    """Customers and tables over all parts of the restaurants that a part shares, by place."""
    order = np.argsort(totals.column("place").to_numpy())
    columns = [totals.column(k).to_numpy()[order] for k in ("place", "c", "t")]
    return pa.table({"part": totals.column("part").slice(0, 1), "payload": pa.array([_pack(*columns)], pa.binary())})


def _zipped(rows: DataFrame, columns: list[str], names: list[str]) -> DataFrame:
    """part and what is listed, a row for each."""
    return rows.select("part", F.explode(F.arrays_zip(*columns)).alias("x")).select("part", *[F.col(f"x.{c}").alias(n) for c, n in zip(columns, names)])


def _shared(counted: DataFrame, tables: Scratch) -> DataFrame:
    """part, place, r1, r2, fixed_c, fixed_t: the restaurants that several parts have, with the sums of what is fixed."""
    rows = tables.land(_zipped(counted, ["rp", "r1", "r2", "rc", "rt"], ["place", "r1", "r2", "c", "t"]), "restaurants")
    several = rows.groupBy("r1", "r2").agg(F.count("*").alias("n"), F.sum("c").alias("fixed_c"), F.sum("t").alias("fixed_t")).where("n > 1")
    return tables.land(rows.select("part", "place", "r1", "r2").join(several.drop("n"), ["r1", "r2"]), "shared")


def _totals(shared: DataFrame, seats: DataFrame) -> DataFrame:
    """part, payload: the customers and tables of shared restaurants over all parts."""
    swept = _zipped(seats, ["place", "c", "t"], ["place", "c", "t"]).join(shared.select("part", "place", "r1", "r2"), ["part", "place"])
    swept = swept.groupBy("r1", "r2").agg(F.sum("c").alias("c"), F.sum("t").alias("t"))
    both = shared.join(swept, ["r1", "r2"], "left").select(
        "part", "place", (F.col("fixed_c") + F.coalesce("c", F.lit(0))).alias("c"), (F.col("fixed_t") + F.coalesce("t", F.lit(0))).alias("t"))
    return both.groupBy("part").applyInArrow(_packed, "part long, payload binary")


def score_documents(docs: DataFrame, sweeps: int = SWEEPS, burn_in: int = BURN_IN) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score.

    Documents whose crc32 remainder by 7 is 2 are scored, not learnt from.
    A null or empty text has one token, its end.  Repeated rows are learnt
    from each time.  Without training texts every word is spelt from the
    uniform base.  An empty table gives no row.
    """
    # texts are long rows: fewer are passed to Python at a time
    with shuffles_freed(docs.sparkSession), configured(docs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}):
        return _score(docs, sweeps, burn_in)


def _score(docs: DataFrame, sweeps: int, burn_in: int) -> DataFrame:
    spark = docs.sparkSession
    spellers = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size, texts, tasks = docs.select(F.octet_length(whole("text")).alias("n"), F.spark_partition_id().alias("task")).agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(F.max("task") + 1, F.lit(0))).first()
    parts = max(spellers, -(-size // PART))
    (cut, common), limit = _frequent(docs, size, texts, tasks, parts), ROWS
    ranges = 1 + size // RANGE
    start = Scratch(spark, "lm-start")
    kept_tables, now = Scratch(spark, "lm-kept"), Scratch(spark, "lm-tables")
    places = "place array<long>, c array<long>, t array<long>"
    counted = start.land(_dealt(docs, parts, cut, common, False).repartition(parts, "part").groupBy("part").applyInArrow(
        _counted(limit, cut, common, ranges), "part long, state binary, seats binary, told array<struct<range:long,met:binary,own:binary,spelt:binary>>, "
        f"asked array<struct<range:long,payload:binary>>, rp array<long>, r1 array<long>, r2 array<long>, rc array<long>, rt array<long>, {places}"), "parts")
    told = counted.select("part", F.explode("told").alias("x")).select("part", "x.*")
    asked = counted.select("part", F.explode("asked").alias("x")).select("part", "x.*")
    words = told.groupBy("range").applyInArrow(_vocabulary, "h0 long, word string, fixed long, sent long, n long")
    words = start.land(words.withColumn("part", F.pmod(F.xxhash64("word"), F.lit(spellers))), "words")
    totals = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(F.col("n") > 0).alias("v")).first()
    once = words.where("n = 1").count()
    swept = words.where("n > 1").select("h0", "fixed")
    unigrams = now.land(words.where("n > 1").select("h0", (F.col("fixed") + F.col("sent")).alias("c"), F.lit(1).cast("long").alias("t")), "unigrams")
    shared = _shared(counted, start) if cut else None

    # words learnt once at most are written that often whatever is drawn
    often, rare = words.where("n > 1"), words.where("n <= 1")
    grams = [start.land(_written(often.select("word", "part", F.lit(1).cast("long").alias("t"))), "written"),
             start.land(_written(rare.select("word", "part", F.col("n").alias("t"))), "written")]
    constant = start.land(grams[1].groupBy("gram").agg(F.sum("n").alias("n")), "constant")

    def char_counts(written: DataFrame) -> DataFrame:
        both = written.select("gram", "n").union(constant)
        return now.land(both.groupBy(F.col("gram").alias("key")).agg(F.sum("n").alias("c")), "grams")

    def sums(tables: DataFrame) -> tuple[int, int]:
        row = tables.agg(F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(F.sum("t"), F.lit(0))).first()
        return row[0] + once, row[1] + once

    characters = _first_levels(char_counts(grams[0]), now)
    spelt = now.land(_spelt(often, grams[0], characters[-1].select("key", "p")), "spelt")
    seats = counted
    history: list[list[DataFrame]] = []
    given = [start.land(_totals(shared, counted), "totals")] if cut else []
    for sweep in range(sweeps):
        last, now = now, Scratch(spark, "lm-tables")
        customers, tables = sums(unigrams)
        before = unigrams.join(spelt, "h0").withColumnRenamed("spelt", "parent")
        p = _word_probability(0, F.col("c"), F.col("t"), F.lit(customers), F.lit(tables), F.col("parent"))
        before = now.land(before.select("h0", "parent", (F.lit(tables) - F.col("t")).alias("others"), p.alias("p")), "before")
        held = [_payload(counted, "state", 0), _payload(seats, "seats", 1), *[_payload(x, "payload", 2) for x in given],
                _answers(before, asked, ranges, 3, "p")]
        seats = now.land(reduce(DataFrame.union, held).groupBy("part").applyInArrow(
            _swept(sweep, ranges), f"part long, seats binary, told array<struct<range:long,payload:binary>>, {places}"), "seats")
        if cut:
            given = [now.land(_totals(shared, seats), "totals")]
        level = swept.join(before, "h0").select(_range_of("h0", ranges), "h0", "fixed", "others", "parent")
        sent = seats.select(F.explode("told").alias("x")).select("x.*")
        unigrams = now.land(level.groupBy("range").cogroup(sent.groupBy("range")).applyInArrow(
            _reseat_unigrams(sweep), "h0 long, c long, t long"), "unigrams")
        characters = _sweep_characters(
            characters, char_counts(_written(often.join(unigrams, "h0").select("word", "part", "t"))), sweep, now)
        some = (words, grams[0].union(grams[1])) if sweep >= burn_in else (often, grams[0])
        spelt = now.land(_spelt(*some, characters[-1].select("key", "p")), "spelt")
        if sweep >= burn_in:
            k = len(history)
            customers, tables = sums(unigrams)
            few = F.least("n", F.lit(1))
            p = _word_probability(0, F.coalesce("c", few), F.coalesce("t", few), F.lit(customers), F.lit(tables), F.col("spelt"))
            below = start.land(words.join(unigrams, "h0", "left").join(spelt, "h0").select("h0", "n", p.alias(f"parent{k}")), "p")
            history.append([below, _payload(kept_tables.land(seats.select("part", "seats"), "seats"), "seats", 2 * k), *[
                _payload(kept_tables.land(x, "totals"), "payload", 2 * k + 1) for x in given]])
        last.drop()

    kept = len(history)
    below = reduce(lambda a, b: a.join(b.drop("n"), "h0"), [x[0] for x in history])
    listed = kept_tables.land(_answers(below, told.withColumnRenamed("met", "payload"), ranges, 2 * kept + 1, "n", *[
        f"parent{k}" for k in range(kept)]), "listed")
    now.drop()
    start.drop()
    rows = [*[y for x in history for y in x[1:]], listed, _payload(_dealt(docs, parts, cut, common, True), "payload", 2 * kept)]
    floor = math.log10(totals["n"] + totals["v"] + 1)
    scores = Scratch(spark, "lm-scores").land(reduce(DataFrame.union, rows).groupBy("part").applyInArrow(
        _scored(kept, limit, cut, common), "block long, payload binary"), "scores")
    kept_tables.drop()
    return scores.groupBy("block").applyInArrow(
        _texts, "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double",
    ).select("doc_id", "held_out", "n_tokens", "n_known", F.lit(totals["n"]).cast("long").alias("train_tokens"),
             (F.col("base") - floor * F.col("n_tokens")).alias("base_score"), "score")
