"""Flat (tab-separated) variant tables, patient CSVs, manifests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import FLAT_VARIANTS, FLAT_VARIANTS_WITH_SAMPLE, MANIFEST, PATIENTS


def read_flat_tsv(spark: SparkSession, path: str, with_sample: bool = False, header: bool = True) -> DataFrame:
    """Seven-column (or sample + seven) TSV with a header line skipped and
    ``.`` read as NULL; the schema is declared, never inferred."""
    schema = FLAT_VARIANTS_WITH_SAMPLE if with_sample else FLAT_VARIANTS
    return (spark.read.schema(schema).option("sep", "\\t").option("header", header)
            .option("nullValue", ".").option("mode", "PERMISSIVE").csv(path))


def read_patients(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """One patient CSV per node, header skipped, tagged with its ``node_id``
    and stacked into one frame (``unionByName``)."""
    frames = [spark.read.schema(PATIENTS).option("header", True).csv(p).withColumn("node_id", F.lit(node))
              for node, p in sorted(paths.items())]
    return reduce(lambda a, b: a.unionByName(b), frames)


def reject_counts(df: DataFrame, required: list[str]) -> DataFrame:
    """NOT NULL check on ingest (file readers do not enforce it): rows per
    required column that came in NULL."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Batch manifest / sample sheet (``sample_id,input_bam,node_id``)."""
    return spark.read.schema(MANIFEST).option("header", True).csv(path)


# Fixed value: default public alignment path for a sample id.
DEFAULT_BAM = "{base}bam/{sample}.mapped.ILLUMINA.bwa.GBR.low_coverage.20120522.bam"


def resolve_sample_path(manifest: DataFrame, base: str) -> DataFrame:
    """``input_bam`` when given, else the public default path of the sample."""
    default = F.concat(F.lit(f"{base}bam/"), F.col("sample_id"),
                       F.lit(".mapped.ILLUMINA.bwa.GBR.low_coverage.20120522.bam"))
    return manifest.withColumn("resolved_bam", F.coalesce(F.col("input_bam"), default))
