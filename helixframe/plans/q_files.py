"""Registered file queries: tables written as TSV, CSV, JSON and Parquet into
the shared folder and read back through the sources, and options of readers
(encoding of sample names, previews)."""

from __future__ import annotations

from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import FLAT_VARIANTS
from ..session import scratch_path
from ..sources import flat, logs, sinks
from ..sources import vcf as V
from . import proxy as P
from .oracle_views import with_views as W
from .q_variants import _FEAT_SQL
from .registry import register

NODES = ("EU", "SG", "US")
_FLAT_SQL = """SELECT chromosome, position, CAST(NULL AS VARCHAR) AS id, ref,
  CASE WHEN alt2 IS NULL THEN alt ELSE alt || ',' || alt2 END AS alt, quality, filter FROM px_sites"""


@register("read_flat_tsv", W(_FLAT_SQL, "px_sites"))
def read_flat_tsv(t):
    """The flat table as TSV shards with ``.`` for missing values, read back."""
    path = scratch_path(t.spark, f"flat-{uuid4().hex}")
    P.flat_variants(t).write.csv(path, sep="\t", header=True, nullValue=".")
    return flat.read_flat_tsv(t.spark, path)


@register("read_patients", W("""
SELECT node_id, patient_id, age, variant_brca1, variant_tp53, variant_apoe4, bmi, diagnosis_cancer FROM px_patients""",
                             "px_samples", "px_patients"))
def read_patients(t):
    """Each node's patients as CSV of its own, read back with the node's name."""
    base = scratch_path(t.spark, f"patients-{uuid4().hex}")
    columns = [f.name for f in flat.PATIENTS.fields]
    for node in NODES:
        P.px_patients(t).where(F.col("node_id") == node).select(*columns).write.csv(f"{base}/{node}", header=True)
    return flat.read_patients(t.spark, {node: f"{base}/{node}" for node in NODES}).select("node_id", *columns)


@register("read_manifest", W("""
SELECT sample_id, CASE WHEN ck % 3 = 0 THEN '/data/node/' || sample_id || '.bam' END AS input_bam, 'node-' || (ck % 4) AS node_id
FROM px_samples""", "px_samples"))
def read_manifest(t):
    """A manifest of all samples, some without a path of their own."""
    path = scratch_path(t.spark, f"manifest-{uuid4().hex}")
    own = F.when(F.col("ck") % 3 == 0, F.concat(F.lit("/data/node/"), "sample_id", F.lit(".bam")))
    P.px_samples(t).select("sample_id", own.alias("input_bam"), F.concat(
        F.lit("node-"), (F.col("ck") % 4).cast("string")).alias("node_id")).write.csv(path, header=True)
    return flat.read_manifest(t.spark, path)


@register("read_audit_log", W("""
SELECT epoch_us(ts) // 1000 AS ts_ms, method_name, bucket, severity, job_name FROM px_audit""", "px_audit"))
def read_audit_log(t):
    """Audit records as JSON lines, read back under the declared schema."""
    path = scratch_path(t.spark, f"audit-{uuid4().hex}")
    P.px_audit(t).drop("event_id").write.json(path)
    return logs.read_audit_log(t.spark, path).select(
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"), "method_name", "bucket", "severity", "job_name")


@register("weights_json_round_trip", W("""
SELECT node_id, avg(age) AS w0, avg(variant_brca1) AS w1, avg(diagnosis_cancer) AS bias, count(*) AS n_samples,
  max(age) / 8.0::DOUBLE AS final_loss FROM px_patients GROUP BY node_id""", "px_samples", "px_patients"))
def weights_json_round_trip(t):
    """A model for each node, written as JSON and read back with the node its place names."""
    base = scratch_path(t.spark, f"models-{uuid4().hex}")
    models = P.px_patients(t).groupBy("node_id").agg(
        F.array(F.avg("age"), F.avg("variant_brca1")).alias("weights"), F.avg("diagnosis_cancer").alias("bias"),
        F.count(F.lit(1)).alias("n_samples"), (F.max("age") / F.lit(8.0)).alias("final_loss"))
    for node in NODES:
        sinks.write_model_json(models.where(F.col("node_id") == node).drop("node_id"), f"{base}/{node}_weights.json")
    read = logs.read_weights_json(t.spark, f"{base}/*_weights.json")
    return read.select("node_id", F.get("weights", F.lit(0)).alias("w0"), F.get("weights", F.lit(1)).alias("w1"), "bias",
                       "n_samples", "final_loss")


@register("export_dataset", W(f"""
SELECT format, f.* FROM ({_FLAT_SQL}) f, (SELECT unnest(['csv', 'json', 'parquet']) AS format) x""", "px_sites"))
def export_dataset(t):
    """The flat table exported in three formats, each read back."""
    base = scratch_path(t.spark, f"export-{uuid4().hex}")
    read = t.spark.read.schema(FLAT_VARIANTS)
    readers = {"csv": lambda p: read.option("header", True).csv(p), "json": read.json, "parquet": read.parquet}
    parts: list[DataFrame] = []
    for fmt, reader in readers.items():
        sinks.export_dataset(P.flat_variants(t), f"{base}/{fmt}", fmt)
        parts.append(reader(f"{base}/{fmt}").select(F.lit(fmt).alias("format"), "*"))
    return reduce(DataFrame.unionByName, parts)


@register("sample_name_encoding", W("""
SELECT 'hash' AS encoding, reference_name, start_position, sha256(sample_id) AS sample_id, CAST(0 AS INTEGER) AS sample_index FROM px_geno
UNION ALL
SELECT 'none', reference_name, start_position, NULL, 0 FROM px_geno""", "px_geno"))
def sample_name_encoding(t):
    """VCF text read with hashed sample names and without any."""
    lines = P.vcf_text(t)
    return reduce(DataFrame.unionByName, [
        V.parse_vcf_genotypes(lines, names=names).select(
            F.lit(names).alias("encoding"), "reference_name", "start_position", "sample_id", "sample_index")
        for names in ("hash", "none")])


@register("variant_preview", W(f"""
SELECT * FROM ({_FEAT_SQL}) x ORDER BY reference_name, start_position, reference_bases, alt LIMIT 20""", "px_sites"))
def variant_preview(t):
    """Twenty rows of the feature table, the first by position."""
    from ..operators.features import variant_features
    return variant_features(P.variant_sites(t, annotated=False), limit=20)
