"""Registered source/normalisation queries: VCF text parsing, flat
projection, multi-allelic split, contig shards, sequences, sample paths."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import SHARDS, genotype_string
from ..operators import normalize as N
from ..operators.filters import valid_sequence as vs
from ..operators.joins import unnest_calls
from ..sources import vcf as V
from ..sources.flat import resolve_sample_path as rsp
from . import proxy as P
from .oracle_views import with_views as W
from .registry import register

_GT_SQL = """CASE WHEN {a1} < 0 THEN '.' ELSE CAST({a1} AS VARCHAR) END
  || CASE WHEN phaseset IS NOT NULL THEN '|' ELSE '/' END
  || CASE WHEN {a2} < 0 THEN '.' ELSE CAST({a2} AS VARCHAR) END"""


@register("read_vcf", W(f"""
SELECT reference_name, start_position, start_position + length(reference_bases) AS end_position, reference_bases,
  CASE WHEN alt2 IS NULL THEN alt ELSE alt || ',' || alt2 END AS alternate_bases,
  'rs' || CAST(start_position + 1 AS VARCHAR) AS variant_id, quality, filter, sample_id,
  {_GT_SQL.format(a1='a1', a2='a2')} AS gt, phaseset, genotype_quality
FROM px_geno""", "px_geno"))
def read_vcf(t):
    """Per-sample VCF text (derived from the genotype view) parsed back into
    nested rows, calls flattened for comparison."""
    v = V.parse_vcf_lines(P.vcf_text(t))
    c = v.select("reference_name", "start_position", "end_position", "reference_bases",
                 F.array_join("alternate_bases", ",").alias("alternate_bases"), "variant_id", "quality",
                 F.array_join("filter", ";").alias("filter"), "calls")
    return unnest_calls(c).select("reference_name", "start_position", "end_position", "reference_bases", "alternate_bases",
                    "variant_id", "quality", "filter", "sample_id",
                    genotype_string("genotype", F.col("phaseset").isNotNull()).alias("gt"), "phaseset",
                    "genotype_quality")


@register("read_vcf_genotypes", W(f"""
SELECT reference_name, start_position, reference_bases,
  CASE WHEN alt2 IS NULL THEN alt ELSE alt || ',' || alt2 END AS alternate_bases, quality, filter, sample_id,
  CAST(0 AS INTEGER) AS sample_index, {_GT_SQL.format(a1='a1', a2='a2')} AS gt, phaseset, genotype_quality
FROM px_geno""", "px_geno"))
def read_vcf_genotypes(t):
    """The same VCF text parsed straight into the long genotype table."""
    g = V.parse_vcf_genotypes(P.vcf_text(t))
    return g.select("reference_name", "start_position", "reference_bases",
                    F.array_join("alternate_bases", ",").alias("alternate_bases"), "quality",
                    F.array_join("filter", ";").alias("filter"), "sample_id", "sample_index",
                    genotype_string("genotype", F.col("phaseset").isNotNull()).alias("gt"), "phaseset",
                    "genotype_quality")


_END_SQL = P.MULTI_END
_ALT_SQL = P.MULTI_ALT
_MULTI = f"""
f AS (SELECT DISTINCT pk, ln, ck // {P.SAMPLES_PER_FILE} AS b FROM px_calls),
x AS (SELECT f.*, s.ck, s.sample_id, row_number() OVER (PARTITION BY f.pk, f.ln, f.b ORDER BY s.ck) - 1 AS i
      FROM f JOIN px_samples s ON s.ck // {P.SAMPLES_PER_FILE} = f.b)"""


@register("read_vcf_multi", W(f"""
WITH {_MULTI}
SELECT 'batch_' || CAST(b AS VARCHAR) || '.vcf' AS source_file, chromosome AS reference_name, position - 1 AS start_position,
  end_position, ref AS reference_bases, alternate_bases, quality, x.sample_id,
  CAST(i AS INTEGER) AS sample_index, CASE WHEN c.a1 IS NULL THEN './.' ELSE {_GT_SQL.format(a1='c.a1', a2='c.a2')} END AS gt,
  c.genotype_quality
FROM x JOIN (SELECT *, {_END_SQL} AS end_position, {_ALT_SQL} AS alternate_bases FROM px_sites) t ON t.pk = x.pk AND t.ln = x.ln
LEFT JOIN px_calls c ON c.pk = x.pk AND c.ln = x.ln AND c.ck = x.ck""", "px_calls", "px_sites", "px_samples"))
def read_vcf_multi(t):
    """Files of eight samples, three orders of FORMAT, reference blocks and
    deletions with END, read into nested rows."""
    v = V.parse_vcf_lines(P.vcf_multi_text(t))
    c = v.select("source_file", "reference_name", "start_position", "end_position", "reference_bases",
                 F.array_join("alternate_bases", ",").alias("alternate_bases"), "quality",
                 "calls")
    return unnest_calls(c).select("source_file", "reference_name", "start_position", "end_position", "reference_bases",
                                  "alternate_bases", "quality", "sample_id", "sample_index",
                                  genotype_string("genotype", F.col("phaseset").isNotNull()).alias("gt"), "genotype_quality")


@register("vcf_info_values", W(f"""
WITH f AS (SELECT DISTINCT pk, ln, ck // {P.SAMPLES_PER_FILE} AS b FROM px_calls),
y AS (SELECT f.b, t.* FROM f JOIN px_sites t ON t.pk = f.pk AND t.ln = f.ln),
v AS (
  SELECT b, pk, ln, position, chromosome, 'END' AS info_id, 'Integer' AS type, 0 AS value_index,
    CASE WHEN pk % 5 = 0 THEN position + 10 * ln ELSE position + 500 END AS int_value, CAST(NULL AS DOUBLE) AS float_value,
    CAST(NULL AS VARCHAR) AS string_value, false AS flag FROM y WHERE pk % 5 = 0 OR pk % 11 = 0
  UNION ALL SELECT b, pk, ln, position, chromosome, 'SVTYPE', 'String', 0, NULL, NULL, 'DEL', false FROM y WHERE pk % 5 <> 0 AND pk % 11 = 0
  UNION ALL SELECT b, pk, ln, position, chromosome, 'DP', 'Integer', 0, pk % 90, NULL, NULL, false FROM y WHERE pk % 5 <> 0 AND pk % 11 <> 0
  UNION ALL SELECT b, pk, ln, position, chromosome, 'AF', 'Float', 0, NULL, ln / 10.0, NULL, false FROM y WHERE pk % 5 <> 0 AND pk % 11 <> 0
  UNION ALL SELECT b, pk, ln, position, chromosome, 'AF', 'Float', 1, NULL, NULL, NULL, false FROM y
    WHERE pk % 5 <> 0 AND pk % 11 <> 0 AND alt2 IS NOT NULL
  UNION ALL SELECT b, pk, ln, position, chromosome, 'DB', 'Flag', 0, NULL, NULL, NULL, true FROM y
    WHERE pk % 5 <> 0 AND pk % 11 <> 0 AND ln % 2 = 0)
SELECT 'batch_' || CAST(b AS VARCHAR) || '.vcf' AS source_file, chromosome AS reference_name, position - 1 AS start_position,
  info_id, type, CAST(value_index AS INTEGER) AS value_index, CAST(int_value AS BIGINT) AS int_value, float_value, string_value, flag
FROM v""", "px_calls", "px_sites"))
def vcf_info_values(t):
    """INFO text as values of their headers' types."""
    lines = P.vcf_multi_text(t)
    return V.info_values(V.parse_vcf_lines(lines), V.info_definitions(lines), ["source_file", "reference_name", "start_position"])


@register("gene_span_variants", W(f"""
WITH s AS (SELECT chromosome AS reference_name, position - 1 AS start_position, {_END_SQL} AS end_position, ref AS reference_bases
           FROM px_sites),
g AS (SELECT 'G' || p_partkey AS gene_symbol, CASE WHEN p_partkey % 24 = 22 THEN 'X' WHEN p_partkey % 24 = 23 THEN 'Y'
        ELSE CAST(p_partkey % 24 + 1 AS VARCHAR) END AS chromosome, p_partkey * 100 - 300 AS gene_start,
        p_partkey * 100 + (p_partkey % 7) * 400 AS gene_end FROM part WHERE p_partkey % 4 = 0)
SELECT reference_name, start_position, end_position, reference_bases, gene_symbol, gene_start, gene_end
FROM s JOIN g ON chromosome = reference_name AND start_position <= gene_end AND end_position > gene_start""", "px_sites"))
def gene_span_variants(t):
    """Sites whose spans touch a gene, blocks and deletions that begin before it among them."""
    from ..operators.joins import gene_span_variants as spans
    return spans(P.span_sites(t).drop("alternate_bases"), P.span_genes(t))


@register("region_overlaps", W(f"""
SELECT chromosome AS reference_name, position - 1 AS start_position, {_END_SQL} AS end_position, ref AS reference_bases
FROM px_sites WHERE chromosome = '17' AND position - 1 <= 60000 AND {_END_SQL} > 20000""", "px_sites"))
def region_overlaps(t):
    """Sites whose spans reach into a region, under either spelling of its contig."""
    from ..operators.filters import region_overlaps as reach
    return reach(P.span_sites(t), "chr17", 20_000, 60_000, limit=None).drop("alternate_bases")


@register("vcf_to_flat", W("""
SELECT sample_id, reference_name AS chromosome, start_position + 1 AS position,
  'rs' || CAST(start_position + 1 AS VARCHAR) AS id, reference_bases AS ref,
  CASE WHEN alt2 IS NULL THEN alt ELSE alt || ',' || alt2 END AS alt, quality, filter
FROM px_geno""", "px_geno"))
def vcf_to_flat(t):
    return V.vcf_to_flat(P.vcf_text(t), F.regexp_extract("source_file", r"sample_(.+)\.vcf$", 1))


@register("vcf_header_union", W("""
SELECT 'FORMAT' AS kind, 'GT' AS id, count(*) AS files FROM px_samples""", "px_samples"))
def vcf_header_union(t):
    return V.vcf_header_union(P.vcf_text(t)).select("kind", "id", "files")


@register("split_multiallelic", W(f"""
SELECT reference_name, start_position, alt AS alternate_base, CAST(1 AS INTEGER) AS alt_index, sample_id,
  {_GT_SQL.format(a1="CASE WHEN a1 = 1 THEN 1 WHEN a1 > 0 THEN 0 ELSE a1 END",
                  a2="CASE WHEN a2 = 1 THEN 1 WHEN a2 > 0 THEN 0 ELSE a2 END")} AS gt
FROM px_geno
UNION ALL
SELECT reference_name, start_position, alt2, CAST(2 AS INTEGER), sample_id,
  {_GT_SQL.format(a1="CASE WHEN a1 = 2 THEN 1 WHEN a1 > 0 THEN 0 ELSE a1 END",
                  a2="CASE WHEN a2 = 2 THEN 1 WHEN a2 > 0 THEN 0 ELSE a2 END")}
FROM px_geno WHERE alt2 IS NOT NULL""", "px_geno"))
def split_multiallelic(t):
    s = N.split_multiallelic(P.genotypes(t))
    return s.select("reference_name", "start_position", F.get(F.col("alternate_bases"), 0).alias("alternate_base"),
                    "alt_index", "sample_id",
                    genotype_string("genotype", F.col("phaseset").isNotNull()).alias("gt"))


@register("merge_shards", W("""
SELECT chromosome AS reference_name, position - 1 AS start_position, ref AS reference_bases,
  CASE WHEN chromosome IN ('1','2','3','4','5') THEN 'chr1-5' WHEN chromosome IN ('6','7','8','9','10') THEN 'chr6-10'
       WHEN chromosome IN ('11','12','13','14','15') THEN 'chr11-15' ELSE 'chr16-Y' END AS shard
FROM px_sites""", "px_sites"))
def merge_shards(t):
    """Split sites into the four contig shards, each written once to a folder
    of its own, then merge them back in karyotype/position order
    (range-partitioned)."""
    parts = N.write_shards(N.contig_shard(P.variant_sites(t, annotated=False)), [name for name, _ in SHARDS])
    m = N.merge_shards(parts, num_partitions=None)
    return m.select("reference_name", "start_position", "reference_bases", "shard")


# Fixed proxy values: some sites lie on MT, scaffolds or no contig.
_ANY_CONTIG = """CASE WHEN pk % 31 = 0 THEN 'chrM' WHEN pk % 37 = 0 THEN 'GL0002' || CAST(pk % 3 AS STRING)
  WHEN pk % 101 = 0 THEN NULL ELSE chromosome END"""


@register("merge_shards_ordered", W(f"""
WITH s AS (SELECT {_ANY_CONTIG} AS reference_name, position - 1 AS start_position, ref AS reference_bases, ln FROM px_sites),
k AS (SELECT *, CASE WHEN reference_name = 'chrM' THEN 25 WHEN reference_name = 'X' THEN 23 WHEN reference_name = 'Y' THEN 24
        WHEN reference_name IS NULL THEN 27 WHEN starts_with(reference_name, 'GL') THEN 26
        ELSE CAST(reference_name AS INT) END AS k FROM s)
SELECT reference_name, start_position, reference_bases,
  row_number() OVER (ORDER BY k, reference_name NULLS FIRST, start_position, reference_bases, ln) AS merge_position
FROM k""".replace("CAST(reference_name AS INT)", "try_cast(reference_name AS INT)"), "px_sites"))
def merge_shards_ordered(t):
    """Sites on all kinds of contigs merged in one order, with each row's place in it."""
    s = P.px_sites(t).select(F.expr(_ANY_CONTIG).alias("reference_name"), (F.col("position") - 1).alias("start_position"),
                             F.col("ref").alias("reference_bases"), "ln")
    return N.merge_ordered(s, ["reference_bases", "ln"]).select(
        "reference_name", "start_position", "reference_bases", "merge_position")


@register("valid_sequence", W("""
SELECT doc_id, regexp_full_match(regexp_replace(upper(text), '[ \\n]', '', 'g'), '[ACDEFGHIKLMNPQRSTVWY]*')
  AS is_valid
FROM documents"""))
def valid_sequence(t):
    """Amino-acid alphabet check over every document text (whole texts)."""
    return vs(t.documents.select("doc_id", F.col("text").alias("sequence"))).select("doc_id", "is_valid")


@register("resolve_sample_path", W("""
SELECT sample_id, coalesce(CASE WHEN ck % 3 = 0 THEN '/data/node/bam/' || sample_id || '.bam' END,
  '/data/public/bam/' || sample_id || '.mapped.ILLUMINA.bwa.GBR.low_coverage.20120522.bam') AS resolved_bam
FROM px_samples""", "px_samples"))
def resolve_sample_path(t):
    m = P.px_samples(t).select(
        "sample_id", F.when(F.col("ck") % 3 == 0, F.concat(F.lit("/data/node/bam/"), "sample_id",
                                                            F.lit(".bam"))).alias("input_bam"))
    return rsp(m, "/data/public/").select("sample_id", "resolved_bam")


@register("split_multiallelic_no_alt", W(f"""
SELECT reference_name, start_position, CAST(NULL AS VARCHAR) AS alternate_base, CAST(0 AS INTEGER) AS alt_index, sample_id,
  {_GT_SQL.format(a1="CASE WHEN a1 > 0 THEN 0 ELSE a1 END", a2="CASE WHEN a2 > 0 THEN 0 ELSE a2 END")} AS gt
FROM px_geno WHERE start_position % 5 = 0
UNION ALL
SELECT reference_name, start_position, alt, CAST(1 AS INTEGER), sample_id,
  {_GT_SQL.format(a1="CASE WHEN a1 = 1 THEN 1 WHEN a1 > 0 THEN 0 ELSE a1 END",
                  a2="CASE WHEN a2 = 1 THEN 1 WHEN a2 > 0 THEN 0 ELSE a2 END")}
FROM px_geno WHERE start_position % 5 <> 0
UNION ALL
SELECT reference_name, start_position, alt2, CAST(2 AS INTEGER), sample_id,
  {_GT_SQL.format(a1="CASE WHEN a1 = 2 THEN 1 WHEN a1 > 0 THEN 0 ELSE a1 END",
                  a2="CASE WHEN a2 = 2 THEN 1 WHEN a2 > 0 THEN 0 ELSE a2 END")}
FROM px_geno WHERE alt2 IS NOT NULL AND start_position % 5 <> 0""", "px_geno"))
def split_multiallelic_no_alt(t):
    """Every fifth position has no ALT (a ``.`` in the file): its row stays."""
    g = P.genotypes(t).withColumn("alternate_bases", F.when(
        F.col("start_position") % 5 == 0, F.array().cast("array<string>")).otherwise(F.col("alternate_bases")))
    s = N.split_multiallelic(g)
    return s.select("reference_name", "start_position", F.get(F.col("alternate_bases"), 0).alias("alternate_base"),
                    "alt_index", "sample_id",
                    genotype_string("genotype", F.col("phaseset").isNotNull()).alias("gt"))


@register("valid_sequence_parts", W("""
SELECT p_partkey, regexp_full_match(regexp_replace(upper(CASE p_partkey % 5 WHEN 0 THEN 'mkt ayi'
    WHEN 1 THEN 'MKV' || chr(10) || 'ac' WHEN 2 THEN 'ACD' || chr(8232) WHEN 3 THEN 'ACD' || chr(13) ELSE p_name END),
  '[ \\n]', '', 'g'), '[ACDEFGHIKLMNPQRSTVWY]*') AS is_valid
FROM part"""))
def valid_sequence_parts(t):
    """Valid sequences, inner blanks and line feeds, and line terminators that make one invalid."""
    k = F.col("p_partkey") % 5
    seq = (F.when(k == 0, "mkt ayi").when(k == 1, "MKV\nac").when(k == 2, "ACD\u2028").when(k == 3, "ACD\r")
           .otherwise(F.col("p_name")))
    return vs(t.part.select("p_partkey", seq.alias("sequence"))).select("p_partkey", "is_valid")


@register("fasta_round_trip", W("""
SELECT 'p' || p_partkey || ' A>T ' || p_type AS name, replace(p_name, ' ', '') AS sequence FROM part"""))
def fasta_round_trip(t):
    """Names that hold ``>`` written as FASTA and read back."""
    from uuid import uuid4

    from ..session import scratch_path
    from ..sources import fasta

    path = scratch_path(t.spark, f"fasta-{uuid4().hex}")
    fasta.write_fasta(t.part.select(F.concat(F.lit("p"), "p_partkey", F.lit(" A>T "), "p_type").alias("name"),
                                    F.replace("p_name", F.lit(" "), F.lit("")).alias("sequence")), path)
    return fasta.read_fasta(t.spark, path)


@register("write_variants_replace", W("""
SELECT chromosome AS reference_name, position - 1 AS start_position FROM px_sites WHERE position % 2 = 0""", "px_sites"))
def write_variants_replace(t):
    """Sites written twice on two dates: the second write replaces the whole table."""
    from uuid import uuid4

    from ..session import scratch_path
    from ..sources.sinks import write_variants

    path = scratch_path(t.spark, f"variants-{uuid4().hex}")
    sites = P.variant_sites(t, annotated=False)
    old = sites.withColumn("ingestion_timestamp", F.lit("2020-01-01 00:00:00").cast("timestamp"))
    write_variants(old, path, mode="overwrite")
    write_variants(sites.where(F.col("start_position") % 2 == 1), path, mode="overwrite")
    return t.spark.read.parquet(path).select("reference_name", "start_position")
