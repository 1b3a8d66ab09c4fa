"""Site normalisation: multi-allelic split, contig shards, shard merge,
storage layout."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import contig_shard as shard_expr
from ..functions import contig_rank, normalize_contig
from ..session import scratch_path


def _recode(genotype, alt_ix):
    """Allele codes for the split row of ALT number ``alt_ix`` (1-based):
    that ALT -> 1, other ALTs -> 0 (as ``bcftools norm -m -any``), no-call
    stays -1."""
    return F.transform(genotype, lambda g: F.when(g == alt_ix, F.lit(1).cast("long"))
                       .when(g > 0, F.lit(0).cast("long")).otherwise(g))


def split_multiallelic(variants: DataFrame) -> DataFrame:
    """One row per ALT allele; a site without ALT keeps one row with an
    empty ALT list and ``alt_index`` 0.

    Nested rows recode every call's genotype inside the row; a long genotype
    table (``genotype`` column, no ``calls``) recodes per row.  Both are
    narrow (``posexplode`` + ``transform``): no shuffle.  ``allele_depths`` of
    nested calls keep REF and the split ALT's depth.
    """
    keep = [c for c in variants.columns if c != "alternate_bases"]
    x = variants.select(*keep, F.posexplode_outer("alternate_bases").alias("_ix", "_alt"))
    x = x.withColumn("alternate_bases", F.when(F.col("_ix").isNull(), F.array().cast("array<string>"))
                     .otherwise(F.array("_alt"))).withColumn("alt_index", (F.col("_ix") + 1).cast("int"))
    if "calls" in variants.columns:
        def fix(c):
            ad = c["allele_depths"]
            return c.withField("genotype", _recode(c["genotype"], F.col("alt_index"))) \
                    .withField("allele_depths",
                               F.when(ad.isNull() | F.col("alt_index").isNull(), ad).otherwise(
                                   F.array(F.get(ad, 0), F.get(ad, F.col("alt_index")))))
        x = x.withColumn("calls", F.transform("calls", fix))
    elif "genotype" in variants.columns:
        x = x.withColumn("genotype", _recode(F.col("genotype"), F.col("alt_index")))
    return x.withColumn("alt_index", F.coalesce("alt_index", F.lit(0))).drop("_ix", "_alt")


def contig_shard(variants: DataFrame, contig_col: str = "reference_name") -> DataFrame:
    """Adds ``shard`` (chr1-5, chr6-10, chr11-15, chr16-Y); rows on other
    contigs (MT, scaffolds) are rejected."""
    return variants.withColumn("shard", shard_expr(contig_col)).where(F.col("shard").isNotNull())


def write_shards(sharded: DataFrame, names: list[str]) -> list[DataFrame]:
    """The shards ``names`` of rows with a ``shard``, written in one pass to a
    folder each and read back: what computes the rows runs once, not for every
    shard and once more for the sample that a merge draws its ranges from."""
    spark = sharded.sparkSession
    path = scratch_path(spark, f"shards-{uuid.uuid4().hex}")
    sharded.write.partitionBy("shard").parquet(path)
    # the names' folders are picked by the partition filter, empty shards included
    landed = spark.read.schema(sharded.schema).parquet(path).select(*sharded.columns)
    return [landed.where(F.col("shard") == name) for name in names]


def merge_shards(shards: list[DataFrame], contig_col: str = "reference_name",
                 pos_col: str = "start_position", num_partitions: int | None = None) -> DataFrame:
    """Concatenate shards into one globally ordered table (karyotype order,
    then position).  ``repartitionByRange`` samples the key distribution, so
    a contig holding a third of the rows is split over many partitions -
    unlike the fixed 4-shard layout."""
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), shards)
    u = u.withColumn("_k", contig_rank(contig_col)).withColumn("_c", normalize_contig(contig_col))
    if num_partitions:
        u = u.repartitionByRange(num_partitions, "_k", "_c", pos_col)
        return u.sortWithinPartitions("_k", "_c", pos_col).drop("_k", "_c")
    return u.orderBy("_k", "_c", pos_col).drop("_k", "_c")


def merge_ordered(variants: DataFrame, tie_cols: list[str], contig_col: str = "reference_name",
                  pos_col: str = "start_position", num_partitions: int | None = None) -> DataFrame:
    """All shards, one frame, in total order: 1-22, X, Y, MT, scaffolds by
    name, no contig; then position, then ``tie_cols``.  ``merge_position``
    (from 1) is each row's place in that order.

    The ordered rows are written once (their ranges come from a sample, which
    a second run may draw otherwise); a row's place is its place in its range
    and the sizes of the ranges before it, one number a range, so no task
    meets all rows."""
    spark = variants.sparkSession
    keys = ["_k", "_c", pos_col, *tie_cols]
    x = variants.withColumn("_k", contig_rank(contig_col)).withColumn("_c", normalize_contig(contig_col))
    x = x.repartitionByRange(num_partitions, *keys) if num_partitions else x.repartitionByRange(*keys)
    x = x.sortWithinPartitions(*keys).drop("_k", "_c").withColumn("_row", F.monotonically_increasing_id())
    path = scratch_path(spark, f"merged-{uuid.uuid4().hex}")
    x.write.parquet(path)
    x = spark.read.schema(x.schema).parquet(path).withColumn("_range", F.shiftright("_row", 33))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = x.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.col("_start") + F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return x.join(F.broadcast(starts), "_range").withColumn("merge_position", place).drop("_range", "_row", "_start")


def layout_for_write(variants: DataFrame, num_partitions: int, contig_col: str = "reference_name",
                     pos_col: str = "start_position") -> DataFrame:
    """Cluster by (contig, start): range partitions + sorted row groups, so
    Parquet min/max statistics let region predicates skip row groups."""
    k = normalize_contig(contig_col)
    return (variants.repartitionByRange(num_partitions, k, F.col(pos_col))
            .sortWithinPartitions(contig_col, pos_col))
