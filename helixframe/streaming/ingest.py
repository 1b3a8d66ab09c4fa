"""Landing-folder ingest: new flat variant files appended to the warehouse
as they arrive (file stream + checkpoint = each file loaded exactly once)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.joins import sized_lookup
from ..schemas import FLAT_VARIANTS_WITH_SAMPLE
from ..sources.vcf import data_with_names, site_fields


def flat_stream(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = (spark.readStream.schema(FLAT_VARIANTS_WITH_SAMPLE).option("sep", "\t").option("header", True)
         .option("nullValue", "."))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(landing)


def stream_ingest_flat(spark: SparkSession, landing: str, out: str, checkpoint: str,
                       available_now: bool = True, processing_time: str | None = None):
    """Append every new TSV in ``landing`` to Parquet at ``out`` (partitioned
    by chromosome), stamped with the ingestion time.  ``availableNow``
    processes the backlog and stops; otherwise runs on a timer."""
    s = flat_stream(spark, landing).withColumn("ingestion_timestamp", F.current_timestamp())
    w = (s.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
         .partitionBy("chromosome").outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def parse_landed(lines: DataFrame) -> DataFrame:
    """Lines of whole files (``value``, ``source_file``), VCF and flat TSV
    mixed, as flat rows with their sample.  A file with a ``#CHROM`` line is
    a VCF: each site gives a row for each of its file's samples (one without
    sample where the file has none).  Other files are TSV, a header line
    skipped.  Lines of neither kind give NULLs (see ``reject_counts``)."""
    x = data_with_names(lines.where("value IS NOT NULL"))
    vcf = F.col("_sample_names").isNotNull()
    first = "\t".join(f.name for f in FLAT_VARIANTS_WITH_SAMPLE.fields)
    sites = x.where(vcf).select(F.explode_outer("_sample_names").alias("sample_id"), "source_file",
                                F.split("value", "\t").alias("_f"))
    sites = sites.select("sample_id", *site_fields(F.col("_f")), "source_file")
    flat = x.where(~vcf & (F.col("value") != first)).select(
        F.from_csv("value", FLAT_VARIANTS_WITH_SAMPLE.simpleString()[len("struct<"):-1].replace(":", " "),
                   {"sep": "\t", "nullValue": ".", "mode": "PERMISSIVE"}).alias("_t"), "source_file")
    return sites.unionByName(flat.select("_t.*", "source_file"))


def committed_files(spark: SparkSession, out: str) -> DataFrame:
    """source_file, load of every file loaded so far."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/commits")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "source_file string, load string")
    return spark.read.schema("source_file string, load string").parquet(f"{out}/commits")


def _new_lines(batch: DataFrame, out: str) -> tuple[DataFrame, DataFrame]:
    """The files of a micro-batch that no commit names (a row a file, kept
    once), and their lines.  The list is broadcast after a check of its count,
    so no line is shuffled to meet it: by file, a task would gather and sort
    whole files."""
    known = committed_files(batch.sparkSession, out).select("source_file")
    new = sized_lookup(batch.select("source_file").distinct().join(known, "source_file", "left_anti"))
    return new, batch.join(new, "source_file", "left_semi")


def _load_batch(batch: DataFrame, out: str) -> None:
    new, lines = _new_lines(batch, out)
    if new.isEmpty():
        return
    load = uuid.uuid4().hex
    rows = parse_landed(lines)
    (rows.withColumn("ingestion_timestamp", F.current_timestamp()).write.partitionBy("chromosome")
     .parquet(f"{out}/data/load={load}"))
    new.coalesce(1).withColumn("load", F.lit(load)).write.mode("append").parquet(f"{out}/commits")


def stream_ingest_landing(spark: SparkSession, landing: str, out: str, checkpoint: str,
                          max_files_per_trigger: int | None = None, processing_time: str | None = None):
    """Every new file under ``landing``, VCF or flat TSV (folders within
    too, ``.gz`` fine), parsed into ``out``.

    A micro-batch holds whole files, so a VCF's header always comes with its
    lines.  Rows are written under a load of their own, which counts only
    once the commit table names its files: a trigger that dies half-way
    leaves nothing to be seen, and files that come again, in a repeated
    trigger or under a lost checkpoint, are left out.  A file is known by its
    path: land changed content under a new name."""
    r = spark.readStream.option("recursiveFileLookup", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = r.text(landing).select("value", F.col("_metadata.file_path").alias("source_file"))
    w = lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda b, _: _load_batch(b, out))
    w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)
    q = w.start()
    if not processing_time:
        q.awaitTermination()
    return q


def read_landed(spark: SparkSession, out: str) -> DataFrame:
    """The committed rows.  The list of loads (one a trigger) passes the driver."""
    loads = [r[0] for r in committed_files(spark, out).select("load").distinct().collect()]
    schema = f"{FLAT_VARIANTS_WITH_SAMPLE.simpleString()[len('struct<'):-1]},source_file:string,ingestion_timestamp:timestamp"
    if not loads:
        return spark.createDataFrame([], schema.replace(":", " "))
    return (spark.read.schema(schema.replace(":", " ")).option("basePath", f"{out}/data")
            .parquet(*[f"{out}/data/load={x}" for x in sorted(loads)]))
