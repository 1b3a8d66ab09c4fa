"""Contig (chromosome) column expressions.

Inputs name contigs both ``chr17`` and ``17``; every operator compares the
normalised form.  All helpers are plain Column expressions (codegen'd, no
Python on the executors).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Karyotype order of the contigs the dashboards report.
KARYOTYPE = ["1", "2", "3", "4", "5", "6", "7", "8", "9", "10", "11", "12", "13",
             "14", "15", "16", "17", "18", "19", "20", "21", "22", "X", "Y"]

# The four calling shards and their contigs, in merge order.
SHARDS = [
    ("chr1-5", ["1", "2", "3", "4", "5"]),
    ("chr6-10", ["6", "7", "8", "9", "10"]),
    ("chr11-15", ["11", "12", "13", "14", "15"]),
    ("chr16-Y", ["16", "17", "18", "19", "20", "21", "22", "X", "Y"]),
]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_contig(c) -> Column:
    """``chr17``/``CHR17``/``17`` -> ``17``; ``chrM``/``M`` -> ``MT``."""
    s = F.regexp_replace(_c(c), r"^(?i)chr", "")
    return F.when(F.upper(s) == "M", F.lit("MT")).otherwise(F.upper(s))


def karyotype_index(c) -> Column:
    """1..24 for 1-22, X, Y; NULL for anything else (MT, scaffolds)."""
    n = normalize_contig(c)
    as_int = n.try_cast("int")
    return (F.when(n == "X", F.lit(23)).when(n == "Y", F.lit(24))
            .when(as_int.between(1, 22), as_int))


def contig_rank(c) -> Column:
    """A total order's first key: 1-22, X, Y, then MT, then scaffolds (order
    these by name), then NULL."""
    n = normalize_contig(c)
    return F.coalesce(karyotype_index(c), F.when(n == "MT", F.lit(25)).when(n.isNotNull(), F.lit(26)), F.lit(27))


def is_karyotype(c) -> Column:
    return normalize_contig(c).isin(KARYOTYPE)


def contig_shard(c) -> Column:
    """Calling shard of a contig; NULL (rejected) for MT and scaffolds."""
    n = normalize_contig(c)
    expr = None
    for name, members in SHARDS:
        expr = (F.when(n.isin(members), F.lit(name)) if expr is None
                else expr.when(n.isin(members), F.lit(name)))
    return expr


def shard_index(c) -> Column:
    n = normalize_contig(c)
    expr = None
    for i, (_, members) in enumerate(SHARDS):
        expr = (F.when(n.isin(members), F.lit(i)) if expr is None
                else expr.when(n.isin(members), F.lit(i)))
    return expr
