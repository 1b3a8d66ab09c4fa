"""Audit logs and model JSON blobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import AUDIT_LOG, NODE_WEIGHTS


def read_audit_log(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines audit records with a declared schema."""
    return spark.read.schema(AUDIT_LOG).json(path)


def read_weights_json(spark: SparkSession, path: str) -> DataFrame:
    """Node weight blobs (one JSON object per node file); the node id is the
    name of the file, or of the folder that Spark wrote it into.  Missing nodes are simply absent; no file at all is an error."""
    raw = spark.read.schema(NODE_WEIGHTS).option("multiLine", True).json(path)
    if not raw.inputFiles():
        raise FileNotFoundError(f"no weight files under {path}")
    return raw.withColumn("node_id", F.regexp_extract(F.col("_metadata.file_path"),
                                                      r"([^/]+?)(_weights)?\.json(?:/part-[^/]*)?$", 1))
