"""Governance checks as data jobs over audit logs and released outputs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources import snapshots
from .joins import sized_lookup
from .lineage import column_sources

# Log severity levels in rank order.
SEVERITY_RANK = [("DEFAULT", 0), ("DEBUG", 100), ("INFO", 200), ("NOTICE", 300), ("WARNING", 400),
                 ("ERROR", 500), ("CRITICAL", 600), ("ALERT", 700), ("EMERGENCY", 800)]

ROUND_LINE = r"Round (\d+): Aggregated (\d+) updates"


def severity_rank(col: str = "severity"):
    expr = None
    for name, rank in SEVERITY_RANK:
        expr = (F.when(F.upper(col) == name, F.lit(rank)) if expr is None
                else expr.when(F.upper(col) == name, F.lit(rank)))
    return expr


def egress_audit(log: DataFrame, own_bucket: str, method: str = "storage.objects.create") -> DataFrame:
    """Object writes to buckets that are not the node's own (expected empty)."""
    return log.where((F.col("method_name") == method) & ~F.col("bucket").contains(own_bucket))


def access_audit(log: DataFrame, service: str | None = None) -> DataFrame:
    """Data-access events per service and method with first/last time."""
    x = log if service is None else log.where(F.col("service") == service)
    return x.groupBy("service", "method_name").agg(
        F.count(F.lit(1)).alias("events"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def error_log(log: DataFrame, job_pattern: str | None = None, min_severity: str = "ERROR") -> DataFrame:
    """Entries at or above ``min_severity``, optionally for jobs matching a
    regex (e.g. ``^nf-.*``)."""
    rank = dict(SEVERITY_RANK)[min_severity]
    x = log.where(severity_rank() >= rank)
    return x if job_pattern is None else x.where(F.col("job_name").rlike(job_pattern))


def round_log_check(lines: DataFrame, num_nodes: int, text_col: str = "text_payload") -> DataFrame:
    """Parse ``Round k: Aggregated n updates`` lines; per round the reported
    update count and whether it reached ``num_nodes``."""
    x = lines.where(F.col(text_col).rlike(ROUND_LINE)).select(
        F.regexp_extract(text_col, ROUND_LINE, 1).cast("long").alias("round"),
        F.regexp_extract(text_col, ROUND_LINE, 2).cast("long").alias("updates"))
    return (x.groupBy("round").agg(F.max("updates").alias("updates"), F.count(F.lit(1)).alias("log_lines"))
            .withColumn("complete", F.col("updates") >= num_nodes))


class ReleaseError(ValueError):
    pass


def aggregate_release(df: DataFrame, forbidden: list[str], min_n: int | None = None,
                      count_col: str = "n") -> DataFrame:
    """Only aggregates leave a node: refuse frames that carry patient-level
    columns, under their own name or another, alone, inside an expression, as
    a grouping key, or through an aggregate that returns one row's value
    (min, max, first, lists); optionally suppress cells with fewer than
    ``min_n`` members."""
    names = {f.lower() for f in forbidden}
    bad = {c: sorted(x for x in sources | {c} if x.lower() in names) for c, sources in column_sources(df).items()}
    bad = {c: x for c, x in bad.items() if x}
    if bad:
        raise ReleaseError(f"patient-level columns in release (column: comes from): {bad}")
    if min_n is None:
        return df
    if count_col not in df.columns:
        raise ReleaseError(f"no member count {count_col!r} to hold against the minimum cell size")
    return df.where(F.col(count_col) >= min_n)


def residency_check(assets: DataFrame, policy: DataFrame) -> DataFrame:
    """Assets stored in a region their node's policy does not allow.
    ``policy``: (node_id, allowed_region), one row per allowed pair - a
    bounded lookup (nodes x regions), joined left so nodes without a policy
    are flagged too."""
    allowed = policy.select("node_id", F.col("allowed_region").alias("region"), F.lit(True).alias("_ok"))
    j = assets.join(sized_lookup(allowed), ["node_id", "region"], "left")
    return j.where(F.col("_ok").isNull()).drop("_ok")


def erase_patients(patients: DataFrame, erase_ids: DataFrame, id_col: str = "patient_id") -> DataFrame:
    """Right to erasure: every row whose id is in ``erase_ids`` removed
    (left anti-join against the size-checked request list).  For a stored
    table see ``erase_from_table``."""
    return patients.join(sized_lookup(erase_ids.select(F.col(id_col)).distinct()), id_col, "left_anti")


def erase_from_table(spark: SparkSession, path: str, erase_ids: DataFrame, id_col: str = "patient_id",
                     purge: bool = True) -> int:
    """Right to erasure on a stored table (``sources.snapshots``): files with
    a requested id are rewritten, the rest stay, and a new version takes
    over.  ``purge`` then deletes the older versions, so the rows are gone
    from storage too.  Returns the version."""
    version = snapshots.rewrite_without(spark, path, erase_ids, id_col)
    if purge:
        snapshots.purge(spark, path)
    return version


def node_row_counts(tables: dict[str, DataFrame], node_col: str = "node_id") -> DataFrame:
    """Post-load row counts per table and node."""
    parts = [df.groupBy(F.col(node_col).alias("node_id")).agg(F.count(F.lit(1)).alias("rows"))
             .withColumn("table", F.lit(name)) for name, df in sorted(tables.items())]
    return reduce(lambda a, b: a.unionByName(b), parts).select("table", "node_id", "rows")
