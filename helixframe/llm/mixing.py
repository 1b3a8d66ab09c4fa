"""Mixing sources to target weights by Poisson replication.

A source with n rows, target weight w and a mixture of N rows repeats each
of its documents Poisson(N * w / n) times.  The draw inverts the Poisson
distribution at a uniform number hashed from (seed, id and text, draw): a document's
count depends on nothing but the rates and the seed, so lost tasks recompute
the same mixture.  A rate above 8 is drawn as a sum of independent draws of
at most 8 each, so the inversion table has :data:`TERMS` entries at any
rate.  The documents are exploded by count and shuffled globally by a hash
of (seed, id and text, copy).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TERMS = 64
STEP = 8.0
#: A rate table of at most this many sources is broadcast; a larger one is shuffled.
BROADCAST_SOURCES = 10_000


def uniform(*parts: Column) -> Column:
    """[0, 1) from the first 52 bits of md5 over the parts, joined by ':' (null parts are left out)."""
    digest = F.md5(F.encode(F.concat_ws(":", *[p.cast("string") for p in parts]), "UTF-8"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def own_key() -> Column:
    """What tells a document's draws apart: its id and md5 of its text (null: empty)."""
    text = F.md5(F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8"))
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text)


def source_rates(docs: DataFrame, weights: dict[str | None, float] | None = None, power: float = 0.5,
                 total: int | None = None) -> DataFrame:
    """source, n, rate: how often each document of a source is repeated on
    average.  ``weights`` names target shares (sources it leaves out get
    none); without it a source weighs n ** power, which lifts small sources.
    ``total`` is the expected number of rows of the mixture, by default that
    of the input.  A null source is a source of its own."""
    counts = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        share = F.pow(F.col("n").cast("double"), F.lit(power))
    else:
        share = F.lit(0.0)
        for name, w in weights.items():
            share = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(share)
    counts = counts.withColumn("w", share)
    sums = counts.agg(F.sum("w").alias("w"), F.sum("n").alias("n"))
    all_w = sums.select("w").scalar()
    all_n = sums.select("n").scalar() if total is None else F.lit(total)
    rate = F.when(all_w > 0, all_n * F.col("w") / all_w / F.col("n")).otherwise(F.lit(0.0))
    return counts.select("source", "n", rate.alias("rate"))


def _inversion(rates: DataFrame) -> DataFrame:
    """Adds draws (how many independent draws make up the rate) and the
    cumulative Poisson probabilities of one draw."""
    r = rates.withColumn("draws", F.greatest(F.lit(1), F.ceil(F.col("rate") / STEP)).cast("int"))
    r = r.withColumn("step", F.col("rate") / F.col("draws"))
    fact, terms = 1.0, []
    for k in range(TERMS):
        fact *= max(k, 1)
        terms.append(F.exp(-F.col("step")) * F.pow(F.col("step"), F.lit(float(k))) / F.lit(fact))
    r = r.withColumn("pmf", F.array(*terms))
    cdf = F.transform(F.sequence(F.lit(1), F.lit(TERMS)),
                      lambda i: F.aggregate(F.slice("pmf", F.lit(1), i), F.lit(0.0), lambda a, x: a + x))
    return r.select("source", "rate", "draws", cdf.alias("cdf"))


def mix_sources(docs: DataFrame, weights: dict[str | None, float] | None = None, power: float = 0.5,
                total: int | None = None, seed: int = 17) -> DataFrame:
    """The documents, each repeated by its count, in a global pseudo-random
    order, with the extra columns copy_no (1 to count) and shuffle_key.

    A row draws by its id and its text's digest: rows without id, or under one
    id, draw apart unless their texts are equal, too; repeated rows draw alike.
    A document whose count is 0 has no row: that is the sampling asked for.
    Null texts and extra columns pass unchanged; a column of the input named
    copy_no or shuffle_key is replaced.  An empty table gives no rows.
    """
    cols = [c for c in docs.columns if c not in ("copy_no", "shuffle_key")]
    rates = _inversion(source_rates(docs, weights, power, total)).select(
        F.col("source").alias("__source"), F.col("draws").alias("__draws"), F.col("cdf").alias("__cdf"))
    if weights is not None or rates.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    drawn = docs.select(*[F.col(f"`{c}`") for c in cols]).withColumn("__own", own_key()).join(rates, F.col("source").eqNullSafe(F.col("__source")))
    count = F.aggregate(
        F.sequence(F.lit(1), F.col("__draws")), F.lit(0),
        lambda a, j: a + F.aggregate(
            F.array(uniform(F.lit(seed), F.col("__own"), j)), F.lit(0),
            lambda b, u: b + F.size(F.filter("__cdf", lambda c: c <= u))))
    drawn = drawn.withColumn("__count", count).where("__count > 0")
    copies = drawn.withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("__count"))))
    copies = copies.withColumn("shuffle_key", F.conv(F.substring(F.md5(F.encode(F.concat_ws(
        ":", F.lit(f"order {seed}"), F.col("__own"), F.col("copy_no").cast("string")), "UTF-8")), 1, 15),
        16, 10).cast("long"))
    return (copies.select(*[F.col(f"`{c}`") for c in cols], "copy_no", "shuffle_key")
            .repartition(F.col("shuffle_key")).sortWithinPartitions("shuffle_key"))


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The mixture with the columns of the input alone."""
    return mix_sources(docs, **how).select(*[F.col(f"`{c}`") for c in docs.columns])
