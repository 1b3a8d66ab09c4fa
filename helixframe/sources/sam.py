"""SAM alignment text -> ``reads`` DataFrame (11 mandatory columns)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

_COLS = [("qname", "string"), ("flag", "long"), ("rname", "string"), ("pos", "long"), ("mapq", "long"),
         ("cigar", "string"), ("rnext", "string"), ("pnext", "long"), ("tlen", "long"), ("seq", "string"),
         ("qual", "string")]


def parse_sam_lines(lines: DataFrame, sample_id=None) -> DataFrame:
    """Header (``@``) lines dropped, tab-split, typed.  ``sample_id`` is a
    Column or string; by default the file name without extension."""
    data = lines.where(~F.col("value").startswith("@") & (F.length("value") > 0))
    f = F.split("value", "\t")
    cols = [(F.get(f, i).try_cast(t) if t != "string" else F.get(f, i)).alias(n) for i, (n, t) in enumerate(_COLS)]
    if sample_id is None:
        sid = F.regexp_extract("source_file", r"([^/]+?)(\.sam)?(\.gz)?$", 1)
    elif isinstance(sample_id, str):
        sid = F.lit(sample_id)
    else:
        sid = sample_id
    return data.select(sid.alias("sample_id"), *cols)


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("source_file"))
    return parse_sam_lines(lines)


def sam_contig_order(lines: DataFrame) -> DataFrame:
    """``@SQ`` header lines -> (source_file, contig, length, contig_index):
    the file order idxstats reports in."""
    sq = lines.where(F.col("value").startswith("@SQ"))
    return sq.select(
        "source_file",
        F.regexp_extract("value", r"SN:([^\t]+)", 1).alias("contig"),
        F.regexp_extract("value", r"LN:(\d+)", 1).try_cast("long").alias("length"),
        F.monotonically_increasing_id().alias("contig_index"))
