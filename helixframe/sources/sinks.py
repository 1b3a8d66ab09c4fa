"""Writers: variant warehouse tables, exports, model JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.normalize import layout_for_write


def write_variants(df: DataFrame, path: str, mode: str = "append", num_partitions: int | None = None) -> None:
    """Append (or overwrite) variants stamped with ``ingestion_timestamp``,
    partitioned by ingestion date and clustered by (contig, start):
    range-partitioned and sorted so row-group statistics prune region
    queries.  ``overwrite`` replaces the whole table, all dates."""
    ts = (F.coalesce(F.col("ingestion_timestamp"), F.current_timestamp()) if "ingestion_timestamp" in df.columns
          else F.current_timestamp())
    x = df.withColumn("ingestion_timestamp", ts).withColumn("ingestion_date", F.to_date("ingestion_timestamp"))
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = layout_for_write(x, n)
    (x.write.mode(mode).option("partitionOverwriteMode", "static").partitionBy("ingestion_date")
     .parquet(path))


def export_dataset(df: DataFrame, uri: str, fmt: str = "csv", compression: str = "gzip",
                   mode: str = "overwrite") -> None:
    """Query result -> compressed CSV (with header) / JSON / Parquet shards,
    one file per partition, written in parallel (no single-file funnel).
    Avro is not bundled with Spark; Parquet + snappy stands in for it."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).option("compression", compression).csv(uri)
    elif fmt == "json":
        w.option("compression", compression).json(uri)
    elif fmt in ("parquet", "avro"):
        w.option("compression", "snappy").parquet(uri)
    else:
        raise ValueError(f"unsupported export format {fmt}")


def write_model_json(model: DataFrame, path: str) -> None:
    """A one-row model (or one row per node) as JSON; the frame is tiny by
    construction, so one output file."""
    model.coalesce(1).write.mode("overwrite").json(path)
