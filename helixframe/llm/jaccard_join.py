"""N-gram Jaccard join: blocked sparse products of document by shingle.

Two documents link when their sets of 5-word shingles overlap in at least
0.8 of their union.  The join finds every link's component exactly:

1. Documents with one set are one class, found by a 128-bit digest of the
   set.  Classes get numbers of their own; a class's text is that of its
   smallest id, found again by id and digest, so ids need not be unique.
2. Sets that overlap so far must share a shingle among the rarest
   n - ceil(0.8 n) + 1 of the larger and the rarest n - ceil(8/9 n) + 1 of
   the smaller (size-derived prefixes).  "Rarest" goes by a histogram of
   hashed shingle counts over all documents: its size is fixed, any order
   gives the same links, and frequent shingles stay out of the prefixes.
3. Classes that share a prefix shingle meet in the group of that shingle's
   smallest indexing class (its pivot), never as pairs.  A group is cut into
   blocks of bounded size, each with the pivot.
4. Most members meet by one chance shingle.  A set's sketch counts its
   shingles by hash range, some bytes a set; the sum of the smaller counts of
   two sketches is never below the overlap.  A block is first cut, by its
   members' sketches, into parts that can hold links, and members that can
   link with nobody leave it, before any text is shuffled.
5. In a part the overlaps of all its members are the product of the
   document by shingle incidence matrix with its transpose, accumulated over
   column blocks; pairs below the bound of their sizes are dropped.  A part
   returns a spanning forest of its links.
6. Components of the links.  Members of a group of several blocks that the
   pivot's component did not reach are then compared with the group's other
   blocks, chunk by chunk, until every pair that shares a prefix shingle has
   been linked or compared.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from .common import landed, landed_parquet, whole
from .components import components
from .idfilter import flagged
from .shingles import shingle_sets

BUCKETS = 1 << 18
#: Members and shingles of a block, about.
BLOCK_MEMBERS = 512
BLOCK_SHINGLES = 2_000_000
#: Columns of one step of the product.
COLUMNS = 4096
#: Shingles in a hash range of a sketch: at most, and half of it at least but for the shortest sets.
SKETCH_LOAD = 8
LEAST_RANGES = 16
_TOGETHER = 256


def _buckets(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole("text").alias("text"))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    for batch in batches:
        for lo in range(0, batch.num_rows, _TOGETHER):
            part = batch.slice(lo, _TOGETHER)
            yield part.column(0), shingle_sets(part.column(1).to_pylist())


def shingle_histogram(docs: DataFrame) -> np.ndarray:
    """How many (document, shingle) pairs fall into each of BUCKETS hash
    ranges.  Counts are summed in each task, then by bucket; the driver gets
    BUCKETS numbers at any input size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, dtype=np.int64)
        for _, sets in _parts(batches):
            counts += np.bincount(_buckets(np.concatenate(sets)), minlength=BUCKETS)
        at = np.flatnonzero(counts)
        for lo in range(0, len(at), 50_000):
            some = at[lo:lo + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["bucket", "n"])

    found = _texts(docs).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS, dtype=np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def sketch(s: np.ndarray) -> bytes | None:
    """A byte for each of a power of two of hash ranges: how many shingles of
    the set fall into it.  None, which bounds nothing, where a byte is too small."""
    bits = (max(LEAST_RANGES, -(-len(s) // SKETCH_LOAD)) - 1).bit_length()
    counts = np.bincount((s >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else None


def _digest(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def keyed(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with the digest of each text's set (null: no shingle) in the column ``name``."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, _TOGETHER):
                part = batch.slice(lo, _TOGETHER)
                keys = [_digest(s) for s in shingle_sets([t or "" for t in part.column(at).to_pylist()])]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(keys, pa.binary())], names=[*part.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, BinaryType())]))


def set_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, key: a 128-bit digest of the set (null for the empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _parts(batches):
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([len(s) for s in sets], pa.int64()), pa.array([_digest(s) for s in sets], pa.binary())],
                names=["doc_id", "n_shingles", "key"])

    return landed_parquet(_texts(docs).mapInArrow(run, "doc_id long, n_shingles long, key binary"), "jaccard-sets")


def set_classes(digests: DataFrame) -> DataFrame:
    """node (a number of the class's own), key, rep (the smallest id, null
    where none has one), n_class: a row per different set."""
    classes = digests.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n_class"))
    return landed_parquet(classes.select(F.monotonically_increasing_id().alias("node"), "*"), "jaccard-classes")


def _ceil_share(n: int, up: int, down: int) -> int:
    return -(-up * n // down)


def prefixes(docs: DataFrame, histogram: np.ndarray, per_cent: int) -> DataFrame:
    """doc_id, key, n, n_index, prefix, sketch: the rarest shingles a link must meet in;
    the first n_index of them serve when the document is the smaller one."""
    held = docs.sparkSession.sparkContext.broadcast(histogram)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = held.value
        for ids, sets in _parts(batches):
            rows = []
            for s in sets:
                n = len(s)
                long = n - _ceil_share(n, per_cent, 100) + 1 if n else 0
                short = n - _ceil_share(n, 2 * per_cent, 100 + per_cent) + 1 if n else 0
                rows.append((n, short, s[np.lexsort((s, seen[_buckets(s)]))[:long]].view(np.int64), sketch(s) if n else None))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([_digest(s) for s in sets], pa.binary()), pa.array([r[0] for r in rows], pa.int32()),
                 pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.list_(pa.int64())),
                 pa.array([r[3] for r in rows], pa.binary())], names=["doc_id", "key", "n", "n_index", "prefix", "sketch"])

    return _texts(docs).mapInArrow(
        run, "doc_id long, key binary, n int, n_index int, prefix array<long>, sketch binary").where("n > 0")


def linked(sets: list[np.ndarray], per_cent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among some sets (positions): overlaps
    by the blocked product of the incidence matrix with its transpose."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    owner = np.repeat(np.arange(m), sizes)
    tokens, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1  # a column of one entry adds nothing off the diagonal
    number = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    overlap = np.zeros((m, m), dtype=np.float64)
    width = int(shared.sum())
    for lo in range(0, width, COLUMNS):
        a, b = np.searchsorted(column, (lo, lo + COLUMNS))
        block = np.zeros((m, min(COLUMNS, width - lo)), dtype=np.float32)
        block[owner[a:b], column[a:b] - lo] = 1.0
        overlap += block @ block.T
    both = overlap.astype(np.int64)
    least = np.minimum(sizes[:, None], sizes[None, :])
    most = np.maximum(sizes[:, None], sizes[None, :])
    ok = (100 * least >= per_cent * most) & (100 * both >= per_cent * (sizes[:, None] + sizes[None, :] - both))
    seen = np.zeros(m, dtype=bool)
    forest = []
    for root in range(m):  # breadth first over the link matrix
        if seen[root]:
            continue
        seen[root] = True
        front = [root]
        while front:
            i = front.pop()
            for j in np.flatnonzero(ok[i] & ~seen).tolist():
                seen[j] = True
                forest.append((i, j))
                front.append(j)
    return forest


def possible(sizes: list[int], sketches: list[bytes | None], per_cent: int) -> list[int]:
    """For each set the number of its part: sets that may link, by their sizes
    and sketches, share a part."""
    m = len(sizes)
    order = sorted(range(m), key=lambda k: (sizes[k], k))
    n = np.array([sizes[k] for k in order], dtype=np.int64)
    held = [None if sketches[k] is None else np.frombuffer(sketches[k], dtype=np.uint8) for k in order]
    ranges = np.array([0 if h is None else len(h) for h in held])
    upto = np.searchsorted(per_cent * n, 100 * n, side="right")
    part = np.arange(m)

    def join(i: int, others: np.ndarray) -> None:
        names = np.unique(part[others])
        if len(names):
            part[np.isin(part, names)] = part[i]

    for i in np.flatnonzero(ranges == 0):  # without a sketch only sizes bound
        join(i, np.flatnonzero((per_cent * n <= 100 * n[i]) & (per_cent * n[i] <= 100 * n)))
    for width in np.unique(ranges[ranges > 0]).tolist():
        own = np.flatnonzero(ranges == width)
        at = np.flatnonzero((ranges >= width) & (np.arange(m) < upto[own].max()))
        table = np.stack([held[k].reshape(width, -1).sum(axis=1, dtype=np.uint32) for k in at])
        for i in own.tolist():
            rows = np.flatnonzero((at > i) & (at < upto[i]) & (part[at] != part[i]))
            if len(rows):
                most = np.minimum(table[np.searchsorted(at, i)], table[rows]).sum(axis=1, dtype=np.int64)
                join(i, at[rows[100 * most >= per_cent * (n[i] + n[at[rows]] - most)]])
    out = np.empty(m, dtype=np.int64)
    out[order] = part
    return out.tolist()


def narrow_blocks(nodes: DataFrame, members: DataFrame, per_cent: int) -> DataFrame:
    """g, i, j, part, node: the members of each block (g, i, j) that may link
    with another one, in the parts that their sketches leave together."""

    def run(block: pa.Table) -> pa.Table:
        by_id = {node: (n, held) for node, n, held in zip(*(block.column(c).to_pylist() for c in ("node", "n", "sketch")))}
        ids = sorted(by_id)
        parts = possible([by_id[i][0] for i in ids], [by_id[i][1] for i in ids], per_cent)
        size = Counter(parts)
        kept = [(p, node) for p, node in zip(parts, ids) if size[p] > 1]
        where = [pa.array([block.column(c)[0].as_py()] * len(kept), kind) for c, kind in (("g", pa.int64()), ("i", pa.int32()), ("j", pa.int32()))]
        return pa.table([*where, pa.array([p for p, _ in kept], pa.int64()), pa.array([node for _, node in kept], pa.int64())],
                        names=["g", "i", "j", "part", "node"])

    held = nodes.select(F.col("node").alias("__node"), "n", "sketch")
    rows = members.join(held, F.col("node") == F.col("__node")).select("g", "i", "j", "node", "n", "sketch")
    return rows.groupBy("g", "i", "j").applyInArrow(run, "g long, i int, j int, part long, node long")


def compare_blocks(docs: DataFrame, classes: DataFrame, nodes: DataFrame, members: DataFrame, per_cent: int) -> DataFrame:
    """Links (a, b) inside each block of members (block columns g, i, j; node).
    Only the texts of members that may link, and few others, are shuffled."""

    def run(block: pa.Table) -> pa.Table:
        by_id = dict(zip(block.column("node").to_pylist(), block.column("text").to_pylist()))
        ids = sorted(by_id)
        sets = shingle_sets([by_id[i] for i in ids])
        forest = [(ids[a], ids[b]) for a, b in linked(sets, per_cent)] if len(ids) > 1 else []
        return pa.table({"a": pa.array([a for a, _ in forest], pa.int64()), "b": pa.array([b for _, b in forest], pa.int64())})

    of_class = classes.select(F.col("node").alias("__node"), "rep", F.col("key").alias("__key"))
    narrow = narrow_blocks(nodes, members, per_cent).join(of_class, F.col("node") == F.col("__node")).drop("__node")
    narrow = landed_parquet(narrow, "jaccard-members")
    texts = flagged(_texts(docs), F.col("doc_id"), narrow.select("rep").distinct(), "__member").where("__member")
    rows = keyed(texts.drop("__member"), "key").join(narrow, (F.col("doc_id") == F.col("rep")) & (F.col("key") == F.col("__key")))
    rows = rows.select("g", "i", "j", "part", "node", "text")
    return rows.groupBy("g", "i", "j", "part").applyInArrow(run, "a long, b long")


def class_links(docs: DataFrame, classes: DataFrame, per_cent: int) -> DataFrame:
    """node, label: components of the classes that some link joins."""
    reps = classes.select("node", "rep", F.col("key").alias("__key")).where("rep IS NOT NULL")
    rare = prefixes(docs, shingle_histogram(docs), per_cent)
    nodes = rare.join(reps, (F.col("doc_id") == F.col("rep")) & (F.col("key") == F.col("__key")))
    nodes = landed_parquet(nodes.select("node", "n", "n_index", "prefix", "sketch"), "jaccard-prefixes")
    index = nodes.select("node", F.explode(F.slice("prefix", F.lit(1), F.col("n_index"))).alias("token"))
    pivots = index.groupBy("token").agg(F.min("node").alias("g"))
    tokens = nodes.select("node", F.explode("prefix").alias("token"))
    met = tokens.join(pivots, "token").where(F.col("node") != F.col("g")).select("g", "node").distinct()
    n = nodes.select(F.col("node").alias("__node"), "n")
    met = landed_parquet(met.join(n, F.col("node") == F.col("__node")).groupBy("g", "node").agg(F.max("n").alias("n")), "jaccard-met")
    sizes = met.groupBy("g").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK_MEMBERS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    placed = met.join(sizes, "g").select("g", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("i"), "node")
    everywhere = sizes.select("g", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("i"), F.col("g").alias("node"))
    members = placed.unionByName(everywhere).withColumn("j", F.lit(-1))
    edges = landed(compare_blocks(docs, classes, nodes, members, per_cent))
    labels = components(edges)
    several = landed(sizes.where("blocks > 1"))
    if several.isEmpty():
        return labels
    # what the pivot's component did not reach, in groups of several blocks
    label = labels.select(F.col("node").alias("__node"), "label")
    of_pivot = several.join(label.withColumnRenamed("label", "pivot_label"), F.col("g") == F.col("__node"), "left").drop("__node")
    inside = (met.join(of_pivot, "g").join(label, F.col("node") == F.col("__node"), "left").drop("__node")
              .withColumn("at_pivot", F.coalesce("pivot_label", "g").eqNullSafe(F.coalesce("label", "node"))))
    inside = landed(inside.select("g", "node", "n", "blocks", "at_pivot",
                                  F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("i")))
    apart = inside.where(~F.col("at_pivot"))
    if apart.isEmpty():
        return labels
    chunks = apart.groupBy("g").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK_MEMBERS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("chunks"))
    left = apart.join(chunks, "g").select(
        "g", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("i"),
        F.pmod(F.xxhash64("node", F.lit(1)), F.col("chunks")).cast("int").alias("j"), "node")
    right = inside.join(chunks, "g").select(
        "g", "i", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("j"), "node")
    more = compare_blocks(docs, classes, nodes, left.unionByName(right).distinct(), per_cent)
    return components(edges.unionByName(more))


def _classified(docs: DataFrame, per_cent: int) -> DataFrame:
    """doc_id, n_shingles, key, n_class, component (the smallest id that links
    reach), keep (the digest of the component's class of that id, the smallest
    where the id has several)."""
    digests = set_digests(docs)
    classes = set_classes(digests)
    labels = class_links(docs, classes, per_cent).withColumnRenamed("node", "__node")
    linked = landed_parquet(classes.join(labels, F.col("node") == F.col("__node")).select("key", "rep", "label"), "jaccard-linked")
    first = linked.groupBy(F.col("label").alias("__label")).agg(F.min(F.struct("rep", "key")).alias("first"))
    named = linked.join(first, F.col("label") == F.col("__label")).select(F.col("key").alias("__linked"), "first")
    named = classes.join(named, F.col("key") == F.col("__linked"), "left").select(
        F.col("key").alias("__key"), "n_class", F.coalesce("first.rep", "rep").alias("component"),
        F.coalesce("first.key", "key").alias("keep"))
    return digests.join(named, F.col("key") == F.col("__key"), "left").drop("__key")


def jaccard_components(docs: DataFrame, per_cent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest
    doc_id that links reach), n_class (documents with the same set).

    Null and empty texts have no shingle and link with nothing: they are
    their own component, as is a row whose id is null.  Copies share a set
    and thus a component; repeated rows are copies.  Rows of one id with
    different texts are documents of their own, each with its links; their id
    names the component of each.  A link of exactly the threshold counts.  An
    empty table gives no row.
    """
    out = _classified(docs, per_cent)
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
                      F.coalesce("n_class", F.lit(1)).alias("n_class"))


def drop_near_copies(docs: DataFrame, per_cent: int = 80) -> DataFrame:
    """The documents with the smallest id of their component, columns as they
    came; where that id has several texts in the component, those of one set.
    Rows without id or shingles stay.  Only rows that may go are shuffled."""
    found = _classified(docs, per_cent)
    stays = F.col("doc_id").eqNullSafe(F.col("component")) & F.col("key").eqNullSafe(F.col("keep"))
    gone = landed(found.where(F.col("key").isNotNull() & F.col("doc_id").isNotNull() & ~stays).select(
        F.col("doc_id").alias("__gone_id"), F.col("key").alias("__gone_key")).distinct())
    marked = flagged(docs, F.col("doc_id"), gone.select("__gone_id").distinct(), "__may_go")
    sure = marked.where("not __may_go").drop("__may_go")
    kept = keyed(marked.where("__may_go").drop("__may_go"), "__key").join(
        gone, (F.col("doc_id").cast("long") == F.col("__gone_id")) & (F.col("__key") == F.col("__gone_key")), "left_anti")
    return sure.unionByName(kept.drop("__key"))
