"""Registered QC queries: SAM text -> reads -> flagstat / idxstats / stats;
per-sample variant stats; the joined QC report."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import qc as Q
from ..sources.sam import parse_sam_lines
from . import proxy as P
from .oracle_views import with_views as W
from .registry import register


def _reads(t):
    return parse_sam_lines(P.sam_text(t))


_R = "px_reads"


_FLAGSTAT_SQL = """
SELECT sample_id, count(*) AS total,
  count(*) FILTER (WHERE flag & 256 = 0 AND flag & 2048 = 0) AS "primary",
  count(*) FILTER (WHERE flag & 256 <> 0) AS secondary,
  count(*) FILTER (WHERE flag & 2048 <> 0) AS supplementary,
  count(*) FILTER (WHERE flag & 1024 <> 0) AS duplicates,
  count(*) FILTER (WHERE flag & 512 <> 0) AS qc_failed,
  count(*) FILTER (WHERE flag & 4 = 0) AS mapped,
  count(*) FILTER (WHERE flag & 256 = 0 AND flag & 2048 = 0 AND flag & 4 = 0) AS primary_mapped,
  count(*) FILTER (WHERE flag & 256 = 0 AND flag & 2048 = 0 AND flag & 1 <> 0) AS paired,
  count(*) FILTER (WHERE flag & 256 = 0 AND flag & 2048 = 0 AND flag & 1 <> 0 AND flag & 64 <> 0) AS read1,
  count(*) FILTER (WHERE flag & 256 = 0 AND flag & 2048 = 0 AND flag & 1 <> 0 AND flag & 128 <> 0) AS read2,
  count(*) FILTER (WHERE flag & 256 = 0 AND flag & 2048 = 0 AND flag & 1 <> 0 AND flag & 2 <> 0 AND flag & 4 = 0)
    AS properly_paired,
  count(*) FILTER (WHERE flag & 256 = 0 AND flag & 2048 = 0 AND flag & 1 <> 0 AND flag & 4 = 0 AND flag & 8 = 0)
    AS with_mate_mapped,
  count(*) FILTER (WHERE flag & 256 = 0 AND flag & 2048 = 0 AND flag & 1 <> 0 AND flag & 4 = 0 AND flag & 8 <> 0)
    AS singletons
FROM px_reads GROUP BY sample_id"""

_IDXSTATS_SQL = """
SELECT sample_id, rname, count(*) FILTER (WHERE flag & 4 = 0) AS mapped,
  count(*) FILTER (WHERE flag & 4 <> 0) AS unmapped
FROM px_reads GROUP BY sample_id, rname"""

_SAMSTATS_SQL = """
SELECT sample_id, count(*) AS sequences, count(*) FILTER (WHERE flag & 4 = 0) AS reads_mapped,
  count(*) FILTER (WHERE flag & 4 <> 0) AS reads_unmapped,
  count(*) FILTER (WHERE flag & 1024 <> 0) AS reads_duplicated,
  count(*) FILTER (WHERE flag & 4 = 0 AND mapq = 0) AS reads_mq0,
  CAST(sum(read_length) AS BIGINT) AS total_length,
  CAST(sum(CASE WHEN flag & 4 = 0 THEN read_length ELSE 0 END) AS BIGINT) AS bases_mapped,
  CAST(max(read_length) AS BIGINT) AS maximum_length,
  CAST(sum(read_length) AS DOUBLE) / count(*) AS average_length,
  CAST(40 AS DOUBLE) AS average_quality
FROM px_reads GROUP BY sample_id"""

FLAG_COLS = ["total", "primary", "secondary", "supplementary", "duplicates", "qc_failed", "mapped",
             "primary_mapped", "paired", "read1", "read2", "properly_paired", "with_mate_mapped", "singletons"]
STAT_COLS = ["sequences", "reads_mapped", "reads_unmapped", "reads_duplicated", "reads_mq0", "total_length",
             "bases_mapped", "maximum_length", "average_length", "average_quality"]
_DOUBLE_STATS = ("average_length", "average_quality")


def _qc_report_sql() -> str:
    nl, tab = "chr(10)", "chr(9)"
    flag_lines = ", ".join(f"CAST(f.\"{c}\" AS VARCHAR) || ' {c}'" for c in FLAG_COLS)
    sn = ", ".join(
        f"'SN' || {tab} || '{c.replace('_', ' ')}:' || {tab} || "
        + (f"printf('%.6f', st.{c})" if c in _DOUBLE_STATS else f"CAST(st.{c} AS VARCHAR)")
        for c in STAT_COLS)
    return f"""
WITH f AS ({_FLAGSTAT_SQL}), st AS ({_SAMSTATS_SQL}), ix AS ({_IDXSTATS_SQL}),
ixt AS (SELECT sample_id, string_agg(rname || {tab} || CAST(mapped AS VARCHAR) || {tab} || CAST(unmapped AS VARCHAR),
                                     {nl} ORDER BY rname) AS idxstats_text
        FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY rname) AS rn FROM ix) x
        WHERE rn <= 10 GROUP BY sample_id)
SELECT f.sample_id, concat_ws({nl}, repeat('=', 80), 'Quality Control Report: ' || f.sample_id, repeat('=', 80),
  'FLAGSTAT SUMMARY', concat_ws({nl}, {flag_lines}), 'CHROMOSOME COVERAGE (Top 10)', ixt.idxstats_text,
  'DETAILED STATISTICS', concat_ws({nl}, {sn}), repeat('=', 80)) AS report
FROM f JOIN st ON f.sample_id = st.sample_id JOIN ixt ON f.sample_id = ixt.sample_id"""


@register("read_sam", W("""
SELECT sample_id, CAST(qname AS VARCHAR) AS qname, CAST(flag AS BIGINT) AS flag, rname,
  CAST(CASE WHEN flag & 4 <> 0 THEN 0 ELSE pos END AS BIGINT) AS pos, CAST(mapq AS BIGINT) AS mapq,
  CASE WHEN flag & 4 <> 0 THEN '*' ELSE CAST(read_length AS VARCHAR) || 'M' END AS cigar,
  CAST(read_length AS INTEGER) AS seq_length
FROM px_reads""", _R))
def read_sam(t):
    r = _reads(t)
    return r.select("sample_id", "qname", "flag", "rname", "pos", "mapq", "cigar",
                    F.length("seq").alias("seq_length"))


@register("flagstat", W(_FLAGSTAT_SQL, _R))
def flagstat(t):
    return Q.flagstat(_reads(t))


@register("idxstats", W(_IDXSTATS_SQL, _R))
def idxstats(t):
    return Q.idxstats(_reads(t))


@register("samstats", W(_SAMSTATS_SQL, _R))
def samstats(t):
    return Q.samstats(_reads(t))


@register("samstats_primary", W(_SAMSTATS_SQL.replace(
    "FROM px_reads", "FROM px_reads WHERE flag & 256 = 0 AND flag & 2048 = 0"), _R))
def samstats_primary(t):
    """The summary over sequences: secondary and supplementary alignments left out."""
    return Q.samstats(_reads(t), primary_only=True)


@register("qc_report", W(_qc_report_sql(), _R))
def qc_report(t):
    """Joined per-sample text report: flagstat block, first ten contigs of
    idxstats, SN lines."""
    r = _reads(t)
    return Q.qc_report(Q.flagstat(r), Q.idxstats(r), Q.samstats(r))


@register("vcf_stats", W("""
SELECT sample_id, count(*) AS records,
  count(*) FILTER (WHERE length(reference_bases) = 1 AND length(alt) = 1 AND (alt2 IS NULL OR length(alt2) = 1)) AS snvs,
  count(*) FILTER (WHERE length(reference_bases) > 1 AND length(alt) = length(reference_bases)
                   AND (alt2 IS NULL OR length(alt2) = length(reference_bases))) AS mnps,
  count(*) FILTER (WHERE length(alt) <> length(reference_bases) OR length(alt2) <> length(reference_bases)) AS indels,
  count(*) FILTER (WHERE alt2 IS NOT NULL) AS multiallelic,
  count(*) FILTER (WHERE length(reference_bases) = 1 AND length(alt) = 1 AND alt2 IS NULL AND
    ((reference_bases = 'A' AND alt = 'G') OR (reference_bases = 'G' AND alt = 'A') OR
     (reference_bases = 'C' AND alt = 'T') OR (reference_bases = 'T' AND alt = 'C'))) AS ts,
  count(*) FILTER (WHERE length(reference_bases) = 1 AND length(alt) = 1 AND alt2 IS NULL AND NOT
    ((reference_bases = 'A' AND alt = 'G') OR (reference_bases = 'G' AND alt = 'A') OR
     (reference_bases = 'C' AND alt = 'T') OR (reference_bases = 'T' AND alt = 'C'))) AS tv,
  CAST(count(*) FILTER (WHERE length(reference_bases) = 1 AND length(alt) = 1 AND alt2 IS NULL AND
    ((reference_bases = 'A' AND alt = 'G') OR (reference_bases = 'G' AND alt = 'A') OR
     (reference_bases = 'C' AND alt = 'T') OR (reference_bases = 'T' AND alt = 'C'))) AS DOUBLE)
  / nullif(CAST(count(*) FILTER (WHERE length(reference_bases) = 1 AND length(alt) = 1 AND alt2 IS NULL AND NOT
    ((reference_bases = 'A' AND alt = 'G') OR (reference_bases = 'G' AND alt = 'A') OR
     (reference_bases = 'C' AND alt = 'T') OR (reference_bases = 'T' AND alt = 'C'))) AS DOUBLE), 0) AS ts_tv
FROM px_geno GROUP BY sample_id""", "px_geno"))
def vcf_stats(t):
    """Per-sample variant summary over the calls of each sample."""
    return Q.vcf_stats(P.genotypes(t))


def _contigs(t):
    """The header of each sample's file: 22 contigs and one that no read lies on, in descending order of name."""
    s = P.px_reads(t).select("sample_id").distinct()
    k = F.explode(F.sequence(F.lit(1), F.lit(23))).alias("k")
    return s.select("sample_id", k).select("sample_id", (F.lit(24) - F.col("k")).cast("string").alias("contig"),
                                           (F.col("k") * 1000).cast("long").alias("length"), (F.col("k") - 1).alias("contig_index"))


def _reads_split(t):
    """Reads with QC failures, mates elsewhere and read numbers, derived from the event's number."""
    r = _reads(t)
    k = F.col("qname").cast("long")
    flag = F.col("flag").bitwiseOR(F.when(k % 7 == 0, Q.QCFAIL).otherwise(0)).bitwiseOR(
        F.when(k % 2 == 0, Q.READ1).otherwise(Q.READ2))
    return r.withColumn("flag", flag).withColumn("rnext", F.when(k % 3 == 0, "=").when(k % 5 == 0, "22").otherwise("*"))


def _flag_lines_sql() -> str:
    p = "f & 256 = 0 AND f & 2048 = 0"
    q = f"{p} AND f & 1 <> 0"
    both = f"{q} AND f & 4 = 0 AND f & 8 = 0"
    away = f"{both} AND rnext <> '=' AND rnext <> rname AND rnext <> '*'"
    cond = {"total": "true", "primary": p, "secondary": "f & 256 <> 0", "supplementary": "f & 2048 <> 0 AND f & 256 = 0",
            "duplicates": "f & 1024 <> 0", "primary_duplicates": f"{p} AND f & 1024 <> 0", "mapped": "f & 4 = 0",
            "primary_mapped": f"{p} AND f & 4 = 0", "paired": q, "read1": f"{q} AND f & 64 <> 0", "read2": f"{q} AND f & 128 <> 0",
            "properly_paired": f"{q} AND f & 2 <> 0 AND f & 4 = 0", "with_mate_mapped": both,
            "singletons": f"{q} AND f & 4 = 0 AND f & 8 <> 0", "mate_elsewhere": away, "mate_elsewhere_mapq5": f"{away} AND mapq >= 5"}
    sums = ", ".join(f"count(*) FILTER (WHERE {c} AND f & 512 = 0) AS p_{k}, count(*) FILTER (WHERE {c} AND f & 512 <> 0) AS f_{k}"
                     for k, c in cond.items())
    rate = lambda s, a, b: "CAST(NULL AS DOUBLE)" if b is None else f"round(CAST({s}_{a} * 100 AS DOUBLE) / nullif({s}_{b}, 0), 2)"
    lines = " UNION ALL ".join(
        f"SELECT sample_id, {n} AS line_no, '{text}' AS category, p_{a} AS passed, f_{a} AS failed, {rate('p', a, b)} AS passed_rate, "
        f"{rate('f', a, b)} AS failed_rate FROM g" for n, (text, a, b) in enumerate(Q.FLAG_LINES, 1))
    return f"""
WITH r AS (SELECT sample_id, rname, mapq,
    (flag | CASE WHEN qname % 7 = 0 THEN 512 ELSE 0 END) | CASE WHEN qname % 2 = 0 THEN 64 ELSE 128 END AS f,
    CASE WHEN qname % 3 = 0 THEN '=' WHEN qname % 5 = 0 THEN '22' ELSE '*' END AS rnext FROM px_reads),
g AS (SELECT sample_id, {sums} FROM r GROUP BY sample_id)
{lines}"""


@register("flagstat_report", W(_flag_lines_sql(), _R))
def flagstat_report(t):
    """All sixteen lines of the flag report, QC-passed and QC-failed reads apart."""
    return Q.flagstat_report(_reads_split(t))


@register("idxstats_report", W("""
WITH c AS (SELECT sample_id, CAST(24 - k AS VARCHAR) AS rname, k * 1000 AS length, k - 1 AS contig_index
           FROM (SELECT DISTINCT sample_id FROM px_reads) s, range(1, 24) r(k)
           UNION ALL SELECT DISTINCT sample_id, '*', 0, 23 FROM px_reads),
n AS (SELECT sample_id, rname, count(*) FILTER (WHERE flag & 4 = 0) AS mapped, count(*) FILTER (WHERE flag & 4 <> 0) AS unmapped
      FROM px_reads GROUP BY sample_id, rname)
SELECT c.sample_id, CAST(contig_index AS INTEGER) AS contig_index, c.rname, CAST(length AS BIGINT) AS length,
  coalesce(mapped, 0) AS mapped, coalesce(unmapped, 0) AS unmapped
FROM c LEFT JOIN n ON n.sample_id = c.sample_id AND n.rname = c.rname""", _R))
def idxstats_report(t):
    """Every contig of the header with its length, reads or not, and the reads without coordinate."""
    return Q.idxstats_report(_reads(t), _contigs(t))


@register("read_histograms", W("""
WITH p AS (SELECT * FROM px_reads WHERE flag & 256 = 0 AND flag & 2048 = 0)
SELECT sample_id, 'mapq' AS metric, CAST(least(mapq, 254) AS BIGINT) AS bin, count(*) AS reads FROM p GROUP BY ALL
UNION ALL SELECT sample_id, 'length', CAST(least(read_length, 1000) AS BIGINT), count(*) FROM p GROUP BY ALL""", _R))
def read_histograms(t):
    return Q.read_histograms(_reads(t))


@register("vcf_quality_histogram", W("""
WITH k AS (SELECT sample_id, CAST(floor(quality / 10) * 10 AS BIGINT) AS bin,
    length(reference_bases) = 1 AND length(alt) = 1 AND coalesce(length(alt2), 1) = 1 AS snv,
    length(alt) <> length(reference_bases) OR coalesce(length(alt2) <> length(reference_bases), false) AS differs FROM px_geno)
SELECT sample_id, bin, count(*) FILTER (WHERE snv) AS snvs, count(*) FILTER (WHERE NOT snv AND differs) AS indels,
  count(*) FILTER (WHERE NOT snv AND NOT differs) AS others
FROM k GROUP BY sample_id, bin""", "px_geno"))
def vcf_quality_histogram(t):
    return Q.vcf_quality_histogram(P.genotypes(t))


@register("qc_report_file_order", W(_qc_report_sql().replace(
    "row_number() OVER (PARTITION BY sample_id ORDER BY rname) AS rn FROM ix",
    "row_number() OVER (PARTITION BY sample_id ORDER BY CASE WHEN rname = '*' THEN 99 ELSE 23 - CAST(rname AS INTEGER) END) AS rn FROM ix")
    .replace("chr(10) ORDER BY rname)", "chr(10) ORDER BY rn)"), _R))
def qc_report_file_order(t):
    """The report with each sample's first ten contigs in the order of its own header."""
    r = _reads(t)
    return Q.qc_report(Q.flagstat(r), Q.idxstats(r), Q.samstats(r), contig_order=_contigs(t))
