"""Registered streaming queries.  Each derives its input files from the
driver tables into a fresh folder under the shared checkpoint folder, runs
the streaming job to completion (``availableNow``) and returns the sink
table, so the result can be compared with the equivalent batch SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import scratch_path
from ..streaming import hub as H
from ..streaming import ingest as I
from ..streaming import rounds as R
from . import proxy as P
from .oracle_views import with_views as W
from .registry import register

NUM_NODES = 4
# The fixed columns of a VCF header line.
VCF_COLUMNS = ["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO"]


def _scratch(t, name):
    return scratch_path(t.spark, f"{name}-{uuid.uuid4().hex[:12]}")


def _messages(t):
    """Update messages: weights as an array, event time for watermarking."""
    u = P.px_updates(t)
    e = t.events.select("event_id", "ts")
    return u.join(e, "event_id").select("node_id", F.array("w0", "w1").alias("weights"), "bias", "n_samples",
                                        "round", "event_id", "ts")


@register("round_aggregator", W(f"""
WITH d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY round, node_id ORDER BY event_id) AS rn
                          FROM px_updates) x WHERE rn = 1)
SELECT round, 'complete' AS status, CAST(count(*) AS BIGINT) AS n_nodes, CAST(sum(n_samples) AS BIGINT) AS total_samples,
  round(list_reduce(list(w0 * n_samples ORDER BY node_id), lambda a, b: a + b) / sum(n_samples), 9) + 0.0 AS w0,
  round(list_reduce(list(w1 * n_samples ORDER BY node_id), lambda a, b: a + b) / sum(n_samples), 9) + 0.0 AS w1,
  round(list_reduce(list(bias * n_samples ORDER BY node_id), lambda a, b: a + b) / sum(n_samples), 9) + 0.0 AS bias,
  string_agg(node_id, ',' ORDER BY node_id) AS nodes_aggregated
FROM d GROUP BY round HAVING count(*) >= {NUM_NODES}""", "px_updates"))
def round_aggregator(t):
    """Update messages landed as JSON, aggregated per round by the stateful
    streaming operator; rounds emitted once >= 4 nodes reported."""
    spark = t.spark
    src, out, ck = _scratch(t, "updates"), _scratch(t, "rounds"), _scratch(t, "rounds-ckpt")
    _messages(t).write.json(src)
    R.run_rounds(spark, src, out, ck, NUM_NODES, timeout="10 minutes")
    r = spark.read.parquet(out).where(F.col("status") == "complete")
    return r.select("round", "status", "n_nodes", "total_samples",
                    F.round(F.get("weights", 0), 9).alias("w0"), F.round(F.get("weights", 1), 9).alias("w1"),
                    F.round("bias", 9).alias("bias"), "nodes_aggregated")


@register("round_aggregator_batch", W(f"""
WITH d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY round, node_id ORDER BY event_id) AS rn
                          FROM px_updates) x WHERE rn = 1)
SELECT round, CAST(count(*) AS BIGINT) AS n_nodes, CAST(sum(n_samples) AS BIGINT) AS total_samples,
  round(list_reduce(list(w0 * n_samples ORDER BY node_id), lambda a, b: a + b) / sum(n_samples), 9) + 0.0 AS w0,
  round(list_reduce(list(w1 * n_samples ORDER BY node_id), lambda a, b: a + b) / sum(n_samples), 9) + 0.0 AS w1,
  round(list_reduce(list(bias * n_samples ORDER BY node_id), lambda a, b: a + b) / sum(n_samples), 9) + 0.0 AS bias
FROM d GROUP BY round HAVING count(*) >= {NUM_NODES}""", "px_updates"))
def round_aggregator_batch(t):
    """The batch plan of the same rounds (dedupe -> count -> FedAvg)."""
    r = R.round_aggregator_batch(_messages(t), NUM_NODES)
    return r.select("round", "n_nodes", "total_samples", F.round(F.get("weights", 0), 9).alias("w0"),
                    F.round(F.get("weights", 1), 9).alias("w1"), F.round("bias", 9).alias("bias"))


_ARRIVALS = """
u AS (SELECT 'hub-' || CAST(round % 2 AS VARCHAR) AS hub, CAST(floor(round / 2) AS BIGINT) AS round, node_id, n_samples,
        w0, w1, bias, event_id, (event_id * 7 + round) % 3 AS part FROM px_updates),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hub, round, node_id ORDER BY part, event_id) AS again FROM u) x
      WHERE again = 1),
o AS (SELECT *, row_number() OVER (PARTITION BY hub, round ORDER BY part, event_id) AS place FROM f)"""


@register("hub_rounds", W(f"""
WITH {_ARRIVALS}
SELECT hub, round, CASE WHEN count(*) = {NUM_NODES} THEN 'complete' ELSE 'incomplete' END AS status, count(*) AS n_nodes,
  CAST(sum(n_samples) AS BIGINT) AS total_samples,
  CASE WHEN count(*) = {NUM_NODES} THEN round(list_reduce(list(w0 * n_samples ORDER BY node_id), lambda a, b: a + b) / sum(n_samples), 13) + 0.0 END AS w0,
  CASE WHEN count(*) = {NUM_NODES} THEN round(list_reduce(list(w1 * n_samples ORDER BY node_id), lambda a, b: a + b) / sum(n_samples), 13) + 0.0 END AS w1,
  CASE WHEN count(*) = {NUM_NODES} THEN round(list_reduce(list(bias * n_samples ORDER BY node_id), lambda a, b: a + b) / sum(n_samples), 13) + 0.0 END AS bias,
  string_agg(node_id, ',' ORDER BY node_id) AS nodes_aggregated
FROM o WHERE place <= {NUM_NODES} GROUP BY hub, round""", "px_updates"))
def hub_rounds(t):
    """Two hubs whose updates arrive in three triggers, late, early and
    repeated ones among them; a heartbeat at last closes every round that
    waits.  Complete and incomplete rounds equal the batch SQL."""
    spark = t.spark
    src, out, ck = _scratch(t, "hub-updates"), _scratch(t, "hub-rounds"), _scratch(t, "hub-ckpt")
    u = _messages(t).withColumn("part", (F.col("event_id") * 7 + F.col("round")) % 3)
    u = u.withColumn("hub", F.concat(F.lit("hub-"), (F.col("round") % 2).cast("string"))).withColumn(
        "round", F.floor(F.col("round") / 2).cast("long"))
    last = t.events.agg(F.max("ts").alias("ts"))
    beats = spark.createDataFrame([("hub-0",), ("hub-1",)], "hub string").select(
        "hub", (last.scalar() + F.expr("INTERVAL 100 DAYS")).alias("ts"))
    for part in range(3):
        u.where(F.col("part") == part).drop("part").write.mode("append").json(src)
        if part == 2:
            beats.write.mode("append").json(src)
        H.run_hub(spark, src, out, ck, NUM_NODES, timeout="10 minutes", watermark="60 days", first_round=0)
    r = H.read_rounds(spark, out)
    return r.select("hub", "round", "status", "n_nodes", "total_samples", F.round(F.get("weights", 0), 13).alias("w0"),
                    F.round(F.get("weights", 1), 13).alias("w1"), F.round("bias", 13).alias("bias"), "nodes_aggregated")


@register("stream_ingest_flat", W("""
SELECT chromosome, position, ref, alt, quality, filter, sample_id FROM px_flat, (SELECT 'HG-proxy' AS sample_id)""",
                                  "px_flat"))
def stream_ingest_flat(t):
    """Flat TSV files landed (one per contig), picked up by the file stream
    and appended to the warehouse; the table read back."""
    spark = t.spark
    land, out, ck = _scratch(t, "landing"), _scratch(t, "flat"), _scratch(t, "flat-ckpt")
    flat = P.flat_variants(t).select(F.lit("HG-proxy").alias("sample_id"), "*")
    (flat.repartition("chromosome").write.option("sep", "\t").option("header", True).option("nullValue", ".")
     .csv(land))
    I.stream_ingest_flat(spark, land, out, ck)
    r = spark.read.parquet(out)
    return r.select(F.col("chromosome").cast("string").alias("chromosome"), "position", "ref", "alt", "quality",
                    "filter", "sample_id")


@register("stream_ingest_landing", W("""
SELECT chromosome, position, ref, alt, quality, filter, sample_id FROM px_flat,
  (SELECT unnest(['HG-a', 'HG-b', 'HG-tsv']) AS sample_id) s
WHERE (sample_id = 'HG-tsv') = (position % 2 = 1)""", "px_flat"))
def stream_ingest_landing(t):
    """VCF files of two samples (even positions) and TSV files (odd ones), a
    file a contig, landed in one folder in two triggers; then all files come
    again under a fresh checkpoint and add nothing."""
    spark = t.spark
    land, out = _scratch(t, "mixed-landing"), _scratch(t, "landed")
    flat = P.flat_variants(t)
    odd = F.col("position") % 2 == 1
    text = [F.coalesce(F.col(c).cast("string"), F.lit(".")) for c in ("position", "id", "ref", "alt", "quality", "filter")]
    sites = flat.where(~odd).select(F.col("chromosome").alias("c"), F.concat_ws(
        "\t", "chromosome", *text, F.lit("."), F.lit("GT"), F.lit("0/1"), F.lit("./.")).alias("value"))
    heads = flat.where(~odd).select(F.col("chromosome").alias("c")).distinct().select("c", F.explode(F.array(
        F.lit("##fileformat=VCFv4.2"), F.lit("\t".join(VCF_COLUMNS + ["FORMAT", "HG-a", "HG-b"])))).alias("value"))
    tsv = flat.where(odd).select(F.lit("HG-tsv").alias("sample_id"), "*")
    first = F.col("chromosome").isin("X", "Y")
    ck = _scratch(t, "landed-ckpt")
    # trigger 1: contigs X and Y as VCF, the others as TSV; trigger 2: the rest
    for vcf_part, tsv_part in ((F.col("c").isin("X", "Y"), ~first), (~F.col("c").isin("X", "Y"), first)):
        (sites.unionByName(heads).where(vcf_part).repartition("c").write.mode("append").partitionBy("c").text(f"{land}/vcf"))
        (tsv.where(tsv_part).repartition("chromosome").write.mode("append").option("sep", "\t").option("header", True)
         .option("nullValue", ".").csv(f"{land}/tsv"))
        I.stream_ingest_landing(spark, land, out, ck)
    I.stream_ingest_landing(spark, land, out, _scratch(t, "landed-ckpt"))
    r = I.read_landed(spark, out)
    return r.select("chromosome", "position", "ref", "alt", "quality", "filter", "sample_id")
