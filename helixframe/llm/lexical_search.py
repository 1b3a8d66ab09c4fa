"""Ranked lexical search by dense blocked matrix products.

Items are taken in blocks.  A block's terms are its compact vocabulary, found
in texts by a double-array trie; what documents hold of it (term numbers and
occurrences) is landed once and gives the collection's statistics.  Then each
task multiplies tiles: weights of a tile of items over the tile's own
vocabulary, times impacts of a tile of documents, by BLAS in float64.  All
factors are whole numbers; a vocabulary tile ends where the sums of weights
times the largest impact could pass 2^53, so each product is exact, and the
tiles' products are added as 64-bit integers.  Of each tile of scores the best
of every item are kept, ties by the smaller id, and merged into the task's
best; a window over the tasks' best ranks them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import landed_parquet, lower_ascii, whole
from .double_array import DoubleArray

BEST = 20
#: Parameters of an impact: SCALE tf div (1000 tf + SPREAD m).
SCALE, SPREAD = 1_000_000_000, 12
LENGTH_SHARE = 25
#: Items and bytes of their texts in a block; one longer item is a block by itself.
BLOCK_ITEMS, BLOCK_BYTES = 4096, 4 << 20
#: Items, documents and cells of vocabulary times documents in a tile.
TILE_ITEMS, TILE_DOCS, TILE_CELLS = 32, 1024, 1 << 21
EXACT = 1 << 53
_TERM = np.ones(256, dtype=bool)
_TERM[:128] = [chr(c).isalnum() for c in range(128)]


def term_spans(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the texts in lower case, begin and end of every term, and its text."""
    raw = [lower_ascii(t).encode("utf-8") for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)
    inside = _TERM[data]
    begin = np.flatnonzero(inside & np.concatenate([[True], ~inside[:-1]]))
    end = np.flatnonzero(~inside[1:] & inside[:-1]) + 1
    owner = np.searchsorted(np.cumsum([len(r) + 1 for r in raw]), begin, side="right")
    return data, begin, end, owner


def _terms(text: str) -> list[bytes]:
    data, begin, end, _ = term_spans([text])
    held = data.tobytes()
    return [held[a:b] for a, b in zip(begin.tolist(), end.tolist())]


def _blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """Blocks of (number of the row, item_id, text), brought to the driver one at a time."""
    block, size = [], 0
    for k, r in enumerate(items.select("item_id", whole("text").alias("text")).toLocalIterator()):
        if block and (len(block) >= BLOCK_ITEMS or size + len(r.text) > BLOCK_BYTES):
            yield block
            block, size = [], 0
        block.append((k, r.item_id, r.text))
        size += len(r.text)
    if block:
        yield block


def document_terms(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, n (all terms of the text), terms (ascending numbers of the vocabulary's terms that it holds) and tfs."""
    trie = DoubleArray.of(vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast(trie.parts)
    v = len(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = DoubleArray(*shared.value)
        for batch in batches:
            ids, texts, lo = batch.column(0), batch.column(1).to_pylist(), 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and size < 1 << 20:
                    size += len(texts[hi])
                    hi += 1
                data, begin, end, owner = term_spans(texts[lo:hi])
                n = np.bincount(owner, minlength=hi - lo)
                term = trie.find(data, begin, end)
                key, tf = np.unique(owner[term >= 0] * v + term[term >= 0], return_counts=True)
                edges = pa.array(np.searchsorted(key, np.arange(hi - lo + 1) * v), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    ids.slice(lo, hi - lo), pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(edges, pa.array(key % v, pa.int32())),
                    pa.ListArray.from_arrays(edges, pa.array(tf, pa.int32()))], names=["doc_id", "n", "terms", "tfs"])
                lo = hi

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole("text").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>").where("n > 0")


def item_tiles(numbers: list[np.ndarray], weights: np.ndarray, size: int = TILE_ITEMS, cells: int = TILE_CELLS // TILE_DOCS,
               exact: int = EXACT) -> list[tuple[int, list[tuple[np.ndarray, np.ndarray]]]]:
    """Tiles of items: the first item, and for each part of the tile's own
    vocabulary its term numbers and the matrix of item weights.

    A part has at most ``cells`` terms, and for each item the sum of its
    weights times the largest impact stays below ``exact``.  (One weight
    alone, times its repeats, stays below it for items of under 10^5 equal terms;
    a larger one is cut into several columns of the same term.)
    """
    most = exact // (SCALE // 1000) - 1
    out = []
    for lo in range(0, len(numbers), size):
        part = numbers[lo:lo + size]
        columns: list[tuple[int, np.ndarray]] = []
        owner = np.repeat(np.arange(len(part)), [len(p) for p in part])
        flat = np.concatenate(part) if part else np.zeros(0, dtype=np.int64)
        terms, at = np.unique(flat, return_inverse=True)
        repeats = np.zeros((len(terms), len(part)), dtype=np.int64)
        np.add.at(repeats, (at, owner), 1)
        for term, row in zip(terms.tolist(), repeats * weights[terms][:, None]):
            while row.any():
                columns.append((term, np.minimum(row, most)))
                row = row - columns[-1][1]
        tiles, begin, sums = [], 0, np.zeros(len(part), dtype=np.int64)
        for k, (_, row) in enumerate(columns):
            if k > begin and (k - begin >= cells or (sums + row > most).any()):
                tiles.append(columns[begin:k])
                begin, sums = k, np.zeros(len(part), dtype=np.int64)
            sums = sums + row
        if columns[begin:]:
            tiles.append(columns[begin:])
        out.append((lo, [(np.array([t for t, _ in c], dtype=np.int64), np.array([r for _, r in c], dtype=np.float64).T)
                         for c in tiles]))
    return out


def _best_of(scores: np.ndarray, ids: np.ndarray, known: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of known (scores, ids: a row each item) and new scores, whose columns
    have ascending ids, the k best of each row: by score, then by id; 0 is no score."""
    if scores.shape[1] > k:  # whatever equals the k-th best stays in, for its id may be smaller
        least = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        wanted = ((scores >= np.maximum(least, known[0][:, -1])[:, None]) & (scores > 0)).any(axis=0)
        scores, ids = scores[:, wanted], ids[wanted]
    every = np.concatenate([known[0], scores], axis=1)
    named = np.concatenate([known[1], np.broadcast_to(ids, scores.shape)], axis=1)
    order = np.lexsort((named, -every), axis=1)[:, :k]
    return np.take_along_axis(every, order, axis=1), np.take_along_axis(named, order, axis=1)


def search(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """item_id, rank, doc_id, score: the ``best`` documents with a score above
    0 for each item, by score, then by doc_id.

    A null text counts as empty: as an item it finds nothing, as a document it
    is not found and not counted.  Each row of ``items`` is an item of its own
    and has its own ranks, also where ids are equal or null.  Repeated
    documents count and are returned as often as they occur; of equal scores
    documents without id come last.  An empty table on either side gives no
    rows.  Only item_id, doc_id and the texts are read.
    """
    spark = docs.sparkSession
    result = None
    for block in _blocks(items):
        terms = [_terms(text) for _, _, text in block]
        vocabulary = sorted({t for ts in terms for t in ts})
        if not vocabulary:
            continue
        held = landed_parquet(document_terms(docs, vocabulary), "document-terms")
        size = held.agg(F.count("*"), F.sum("n")).first()
        n_docs, n_terms = size[0], size[1] or 0
        df = np.zeros(len(vocabulary), dtype=np.int64)
        for r in held.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():
            df[r.t] = r["count"]
        weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
        number = {t: k for k, t in enumerate(vocabulary)}
        tiles = item_tiles([np.array([number[t] for t in ts], dtype=np.int64) for ts in terms], weights)
        found = _ranked(held, tiles, len(block), len(vocabulary), n_docs, n_terms, best)
        names = spark.createDataFrame([(k, block[k][0], block[k][1]) for k in range(len(block))],
                                      f"item int, row_no long, item_id {items.schema['item_id'].dataType.simpleString()}")
        part = found.join(F.broadcast(names), "item")
        result = part if result is None else result.unionByName(part)
    if result is None:
        return items.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"),
                            F.lit(0).cast("long").alias("score")).limit(0)
    order = Window.partitionBy("row_no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return result.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best).select(
        "item_id", "rank", "doc_id", "score")


#: Stands for a null id inside tasks, behind all others.
_LAST = np.iinfo(np.int64).max


def _ranked(held: DataFrame, tiles: list, n_items: int, n_vocabulary: int, n_docs: int, n_terms: int, best: int) -> DataFrame:
    """item (number in the block), doc_id, score: the best of every task."""
    shared = held.sparkSession.sparkContext.broadcast(tiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = (np.zeros((n_items, best), dtype=np.int64), np.full((n_items, best), _LAST))
        for batch in batches:
            for lo in range(0, batch.num_rows, TILE_DOCS):
                part = batch.slice(lo, TILE_DOCS)
                ids = part.column(0)
                null = np.asarray(ids.is_null())
                ids = np.where(null, _LAST, ids.fill_null(0).to_numpy())
                order = np.argsort(ids, kind="stable")
                place = np.empty(len(order), dtype=np.int64)
                place[order] = np.arange(len(order))
                n = part.column(1).to_numpy()
                m = 100 - LENGTH_SHARE + (LENGTH_SHARE * n * n_docs) // n_terms
                lists = part.column(2)
                term = lists.flatten().to_numpy()
                tf = part.column(3).flatten().to_numpy().astype(np.int64)
                doc = np.repeat(np.arange(len(n)), np.diff(lists.offsets.to_numpy()))
                impact = (SCALE * tf) // (1000 * tf + SPREAD * m[doc])
                by_term = np.argsort(term, kind="stable")  # each vocabulary tile picks its rows
                first = np.searchsorted(term[by_term], np.arange(n_vocabulary + 1))
                for begin, parts in shared.value:
                    scores = 0
                    for terms, weight in parts:
                        lengths = first[terms + 1] - first[terms]
                        cell = by_term[np.repeat(first[terms] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())]
                        dense = np.zeros((len(terms), len(n)))
                        dense[np.repeat(np.arange(len(terms)), lengths), place[doc[cell]]] = impact[cell]
                        scores = scores + (weight @ dense).astype(np.int64)
                    if parts:
                        rows = slice(begin, begin + len(scores))
                        top[0][rows], top[1][rows] = _best_of(scores, ids[order], (top[0][rows], top[1][rows]), best)
        item, at = np.nonzero(top[0])
        doc_id = top[1][item, at]
        yield pa.RecordBatch.from_arrays([
            pa.array(item, pa.int32()), pa.array(doc_id, pa.int64(), mask=doc_id == _LAST), pa.array(top[0][item, at], pa.int64())],
            names=["item", "doc_id", "score"])

    return held.mapInArrow(run, "item int, doc_id long, score long")
