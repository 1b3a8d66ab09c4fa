"""Registered governance queries over the audit-log and patient views."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import federated as FD
from ..operators import governance as G
from ..session import scratch_path
from ..sources import snapshots as SN
from ..streaming.rounds import dedupe_updates
from . import proxy as P
from .oracle_views import with_views as W
from .registry import register


def _audit(t):
    a = P.px_audit(t)
    svc = (F.when(F.col("method_name").startswith("storage."), F.lit("storage-service"))
           .otherwise(F.lit("warehouse-service")))
    return a.withColumn("service", svc)


_SVC = """CASE WHEN starts_with(method_name, 'storage.') THEN 'storage-service'
  ELSE 'warehouse-service' END"""


@register("egress_audit", W("""
SELECT event_id, method_name, bucket FROM px_audit
WHERE method_name = 'storage.objects.create' AND NOT contains(bucket, 'node-us')""", "px_audit"))
def egress_audit(t):
    return G.egress_audit(_audit(t), "node-us").select("event_id", "method_name", "bucket")


@register("access_audit", W(f"""
SELECT {_SVC} AS service, method_name, count(*) AS events,
  strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_ts, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_ts
FROM px_audit GROUP BY 1, 2""", "px_audit"))
def access_audit(t):
    out = G.access_audit(_audit(t))
    return out.select("service", "method_name", "events",
                      F.date_format("first_ts", "yyyy-MM-dd HH:mm:ss").alias("first_ts"),
                      F.date_format("last_ts", "yyyy-MM-dd HH:mm:ss").alias("last_ts"))


@register("error_log", W("""
SELECT event_id, severity, job_name FROM px_audit
WHERE severity IN ('ERROR', 'CRITICAL', 'ALERT', 'EMERGENCY') AND regexp_matches(job_name, '^nf-.*')""",
                         "px_audit"))
def error_log(t):
    return G.error_log(_audit(t), r"^nf-.*").select("event_id", "severity", "job_name")


@register("round_log_check", W("""
WITH d AS (SELECT round, node_id FROM px_updates GROUP BY round, node_id)
SELECT round, count(*) AS updates, CAST(1 AS BIGINT) AS log_lines, count(*) >= 4 AS complete
FROM d GROUP BY round""", "px_updates"))
def round_log_check(t):
    """Hub log lines ("Round k: Aggregated n updates", one per round, from the
    deduplicated update view) parsed and checked for completeness."""
    d = dedupe_updates(P.px_updates(t)).groupBy("round").agg(F.count(F.lit(1)).alias("n"))
    lines = d.select(F.format_string("Round %d: Aggregated %d updates", "round", "n").alias("text_payload"))
    return G.round_log_check(lines, num_nodes=4)


@register("aggregate_release", W("""
SELECT node_id, count(*) AS n, round(avg(diagnosis_cancer) * 100, 1) AS rate, round(avg(age), 1) AS avg_age,
  round(avg(variant_brca1), 2) AS brca1
FROM px_patients GROUP BY node_id HAVING count(*) >= 300""", "px_patients"))
def aggregate_release(t):
    """Per-node statistics released with a minimum cell size of 300."""
    return G.aggregate_release(FD.node_statistics(P.px_patients(t)), ["patient_id", "age_raw"], min_n=300)


# Fixed proxy values: where each node may store data.
RESIDENCY_POLICY = [("US", "us-central1"), ("EU", "europe-west2"), ("SG", "asia-southeast1")]


@register("residency_check", W("""
WITH a AS (SELECT event_id, CASE user_id % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'EU' ELSE 'SG' END AS node_id,
             CASE event_type WHEN 'purchase' THEN 'us-central1' WHEN 'view' THEN 'europe-west2'
                             WHEN 'click' THEN 'asia-southeast1' ELSE 'us-east4' END AS region FROM events)
SELECT event_id, node_id, region FROM a
WHERE NOT ((node_id = 'US' AND region = 'us-central1') OR (node_id = 'EU' AND region = 'europe-west2')
           OR (node_id = 'SG' AND region = 'asia-southeast1'))"""))
def residency_check(t):
    """Stored objects (one per event) whose region breaks their node's policy."""
    e = t.events
    node = F.when(F.col("user_id") % 3 == 0, "US").when(F.col("user_id") % 3 == 1, "EU").otherwise("SG")
    et = F.col("event_type")
    region = (F.when(et == "purchase", "us-central1").when(et == "view", "europe-west2")
              .when(et == "click", "asia-southeast1").otherwise("us-east4"))
    assets = e.select("event_id", node.alias("node_id"), region.alias("region"))
    policy = t.spark.createDataFrame(RESIDENCY_POLICY, "node_id string, allowed_region string")
    return G.residency_check(assets, policy).select("event_id", "node_id", "region")


@register("erase_patients", W("""
SELECT p.patient_id, p.node_id FROM px_patients p
WHERE p.patient_id NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal < 0)""",
                              "px_patients"))
def erase_patients(t):
    """Erasure requests: customers with a negative balance withdrew consent."""
    ids = t.customer.where(F.col("c_acctbal") < 0).select(F.col("c_custkey").cast("string").alias("patient_id"))
    return G.erase_patients(P.px_patients(t), ids).select("patient_id", "node_id")


@register("erase_from_table", W("""
SELECT p.patient_id, p.node_id, p.node_id <> 'EU' AS file_kept FROM px_patients p
WHERE NOT (p.node_id = 'EU' AND p.patient_id IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal < 0))""",
                                "px_patients"))
def erase_from_table(t):
    """Patients written as a table, a file a node; those of one node with a
    negative balance are erased.  ``file_kept``: the row's file is one of the
    first version, under its first name."""
    path = scratch_path(t.spark, f"patients-{uuid.uuid4().hex}")
    p = P.px_patients(t).select("patient_id", "node_id")
    for node in ("US", "EU", "SG"):  # a version a load
        SN.append_table(p.where(F.col("node_id") == node), path, ["patient_id"], 1)
    before = {f.rsplit("/", 1)[1] for f in SN.snapshot_files(t.spark, path)}
    gone = t.customer.where(F.col("c_acctbal") < 0).select(F.col("c_custkey").cast("string").alias("patient_id"))
    gone = gone.join(p.where(F.col("node_id") == "EU"), "patient_id", "left_semi")
    G.erase_from_table(t.spark, path, gone)
    return SN.read_table(t.spark, path).select(
        "patient_id", "node_id", F.col("_metadata.file_name").isin(sorted(before)).alias("file_kept"))


@register("node_row_counts", W("""
SELECT 'patients' AS "table", node_id, count(*) AS "rows" FROM px_patients GROUP BY node_id
UNION ALL
SELECT 'updates', node_id, count(*) FROM px_updates GROUP BY node_id""", "px_patients", "px_updates"))
def node_row_counts(t):
    return G.node_row_counts({"patients": P.px_patients(t), "updates": P.px_updates(t)})
