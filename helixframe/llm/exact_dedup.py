"""Exact dedup: group by 128-bit content hash, compare bytes, keep one row.

Texts are equal when identical after all white space is deleted.  Classes
are built by grouping on (md5, normalised bytes): Spark's aggregation
compares the bytes themselves, so two texts with one hash stay two classes.
The aggregation buffers are fixed-width (a count and a 38-digit rank), so it
stays a hash aggregation with map-side combine: a group of copies holding a
third of all rows leaves each task as one row, and the text is shuffled
once.  Documents then find their class by (md5, sha256) in a shuffle of
digests only; AQE splits a hot class there.  Should two different texts share
both digests, the class table says so and the job fails instead of merging.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS, whole

MAX_LONG = (1 << 63) - 1
DIGITS = "decimal(38,0)"


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, f"[{WS}]+", "")


def content_hash(norm: Column) -> Column:
    """128 bits."""
    return F.unhex(F.md5(F.encode(norm, "UTF-8")))


def _rank(chars: Column, doc_id: Column) -> Column:
    """Orders rows by most code points, then smallest id, in one fixed-width
    number: code points * 2^64 + (2^63 - 1 - id).  A null id ranks last."""
    shift = F.lit(str(1 << 64)).cast(DIGITS)
    back = F.lit(str(MAX_LONG)).cast(DIGITS) - doc_id.cast(DIGITS)
    return (chars.cast(DIGITS) * shift).cast(DIGITS) + F.coalesce(back.cast(DIGITS), F.lit(-1).cast(DIGITS))


def _id_of(rank: Column) -> Column:
    shift = F.lit(str(1 << 64)).cast(DIGITS)
    rest = F.pmod(rank.cast(DIGITS), shift)
    doc_id = (F.lit(str(MAX_LONG)).cast(DIGITS) - rest.cast(DIGITS)).cast("long")
    # a null id was ranked -1, which reads back as -2^63
    return F.nullif(doc_id, F.lit(-MAX_LONG - 1))


def classes(docs: DataFrame, hash_of: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per distinct normalised text: its hash, sha256, size and the row that stays."""
    norm = normalised(whole("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), norm.alias("norm"),
                       F.char_length(whole("text")).alias("chars"))
    rows = rows.select(hash_of(F.col("norm")).alias("h"), "norm", _rank(F.col("chars"), F.col("doc_id")).alias("rank"))
    by_bytes = rows.groupBy("h", "norm").agg(F.count(F.lit(1)).alias("group_size"), F.max("rank").alias("rank"))
    small = by_bytes.select("h", F.sha2(F.encode("norm", "UTF-8"), 256).alias("sha"), "group_size",
                            _id_of(F.col("rank")).alias("keep_id"))
    checked = small.groupBy("h", "sha").agg(F.sum("group_size").alias("group_size"), F.max("keep_id").alias("keep_id"),
                                            F.count(F.lit(1)).alias("texts"))
    return checked.select("h", "sha", "keep_id", F.when(F.col("texts") == 1, F.col("group_size")).otherwise(
        F.raise_error(F.lit("two different texts share md5 and sha256")).cast("long")).alias("group_size"))


def exact_dedup(docs: DataFrame, hash_of: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per document, dropped ones too: doc_id, keep_id, group_size,
    kept, text_sha256.

    Null and empty texts (and texts of white space alone) are one class.
    Ties in length go to the smallest id.  Repeated rows (one id more than
    once) count in group_size and stay or go together.  An empty table gives
    an empty result.
    """
    norm = normalised(whole("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), norm.alias("norm"))
    rows = rows.select("doc_id", hash_of(F.col("norm")).alias("h"), F.sha2(F.encode("norm", "UTF-8"), 256).alias("sha"))
    return (rows.join(classes(docs, hash_of), ["h", "sha"])
            .select("doc_id", "keep_id", "group_size",
                    F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256")))


def drop_copies(docs: DataFrame) -> DataFrame:
    """One row of each class of equal texts, with its columns as they came:
    that of the id that stays.  Among several rows of that id (or without
    one) the longest text stays.  Rows of different texts stay whatever
    their ids are: none, or the same."""
    norm = normalised(whole("text"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.char_length(whole("text")).alias("chars"),
                       F.col("doc_id").cast("long").alias("id"), content_hash(norm).alias("h"),
                       F.sha2(F.encode(norm, "UTF-8"), 256).alias("sha"))
    keep = classes(docs).where("group_size > 0").select("h", "sha", F.col("keep_id").alias("id"))  # group_size: fails on a collision
    same = (rows.h == keep.h) & (rows.sha == keep.sha) & rows.id.eqNullSafe(keep.id)
    stay = rows.join(keep, same, "left_semi").groupBy("h", "sha").agg(F.max_by("row", "chars").alias("row"))
    return stay.select(*[F.col("row")[c].alias(c) for c in docs.columns])
