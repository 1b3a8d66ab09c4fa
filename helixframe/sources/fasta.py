"""FASTA text <-> ``(name, sequence)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """Multi-line FASTA: records are split on a ``>`` that begins a line by
    the text reader, so a record never straddles two rows, a ``>`` inside a
    name stays there, and files split across tasks."""
    recs = spark.read.option("lineSep", "\n>").text(path)
    recs = recs.select(F.regexp_replace("value", "^>", "").alias("value"))  # of a file's first record
    recs = recs.where(F.length(F.trim("value")) > 0)
    name = F.trim(F.substring_index("value", "\n", 1))
    body = F.expr("substr(value, instr(value, '\\n') + 1)")
    has_nl = F.instr("value", "\n") > 0
    seq = F.when(has_nl, F.regexp_replace(body, r"[\r\n]", "")).otherwise(F.lit(""))
    return recs.select(name.alias("name"), seq.alias("sequence"))


def write_fasta(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``>name\\nsequence`` per record (sequence written as given)."""
    df.select(F.concat(F.lit(">"), "name", F.lit("\n"), "sequence").alias("value")) \
      .write.mode(mode).text(path)
