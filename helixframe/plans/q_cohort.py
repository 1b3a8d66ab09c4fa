"""Registered cohort queries: joins over the long genotype table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import genotype_string
from ..operators import cohort as C
from ..operators import joins as J
from . import proxy as P
from .oracle_views import with_views as W
from .registry import register

GKEY = ["reference_name", "start_position", "reference_bases", "alternate_bases"]


def _alts(prefix: str = "") -> str:
    return f"CASE WHEN {prefix}alt2 IS NULL THEN {prefix}alt ELSE {prefix}alt || ',' || {prefix}alt2 END"


def _joined(df):
    return df.withColumn("alternate_bases", F.array_join("alternate_bases", ","))


@register("allele_frequency", W(f"""
SELECT reference_name, start_position, reference_bases, {_alts()} AS alternate_bases,
  CAST(sum((a1 = 1)::INT + (a2 = 1)::INT) AS DOUBLE) / CAST(count(*) * 2 * 2 AS DOUBLE) AS calculated_af,
  CAST(sum((a1 > 0)::INT + (a2 > 0)::INT) AS DOUBLE) / nullif(CAST(sum((a1 >= 0)::INT + (a2 >= 0)::INT) AS DOUBLE), 0)
    AS alt_af
FROM px_geno GROUP BY reference_name, start_position, reference_bases, alt, alt2""", "px_geno"))
def allele_frequency(t):
    """AF per site over the whole genotype table (reference and corrected)."""
    return _joined(C.allele_frequency(P.genotypes(t), key=GKEY))


@register("population_carriers", W(f"""
SELECT g.reference_name, g.start_position, g.reference_bases, {_alts('g.')} AS alternate_bases,
  count(*) FILTER (WHERE p.super_population = 'EUR' AND g.phaseset IS NOT NULL) AS eur_carriers,
  count(*) FILTER (WHERE p.super_population = 'EUR' AND (g.a1 > 0 OR g.a2 > 0)) AS eur_true_carriers,
  count(*) FILTER (WHERE p.super_population = 'AFR' AND g.phaseset IS NOT NULL) AS afr_carriers,
  count(*) FILTER (WHERE p.super_population = 'AFR' AND (g.a1 > 0 OR g.a2 > 0)) AS afr_true_carriers
FROM px_geno g LEFT JOIN (SELECT * FROM px_populations WHERE super_population IN ('EUR', 'AFR')) p
  ON g.sample_id = p.sample_id
GROUP BY g.reference_name, g.start_position, g.reference_bases, g.alt, g.alt2""", "px_geno", "px_populations"))
def population_carriers(t):
    return _joined(C.population_carriers(P.genotypes(t), P.px_populations(t), ["EUR", "AFR"], key=GKEY))


@register("cohort_size", W("""
SELECT p.super_population, p.population, count(DISTINCT s.sample_id) AS sample_count
FROM px_samples s JOIN px_populations p ON s.sample_id = p.sample_id
GROUP BY p.super_population, p.population""", "px_samples", "px_populations"))
def cohort_size(t):
    return J.cohort_size(P.px_samples(t), P.px_populations(t))


_BURDEN = """
WITH vc AS (
  SELECT s.sample_id, s.disease_status,
    count(DISTINCT g.reference_name || ':' || CAST(g.start_position AS VARCHAR)) AS variant_count
  FROM px_samples s JOIN px_geno g ON s.sample_id = g.sample_id JOIN px_ann a ON g.pk = a.pk
  WHERE a.gene_symbol = '{gene}' AND a.impact IN ('HIGH', 'MODERATE')
  GROUP BY s.sample_id, s.disease_status)
SELECT disease_status, count(*) AS sample_count, avg(variant_count) AS avg_variants,
  round(stddev_samp(variant_count), 6) AS std_variants, min(variant_count) AS min_variants,
  max(variant_count) AS max_variants
FROM vc GROUP BY disease_status"""


@register("case_control_burden", W(_BURDEN.format(gene="BRCA1"), "px_samples", "px_geno", "px_ann"))
def case_control_burden(t):
    return C.case_control_burden(P.px_samples(t), P.genotypes(t), P.site_genes(t), "BRCA1", key=["pk", "ln"])


@register("gene_carriers", W("""
SELECT g.sample_id, count(*) AS carried_sites
FROM px_geno g JOIN px_ann a ON g.pk = a.pk
WHERE a.gene_symbol = 'BRCA2' AND (g.a1 > 0 OR g.a2 > 0) GROUP BY g.sample_id""", "px_geno", "px_ann"))
def gene_carriers(t):
    """"Find BRCA2 carriers in the entire cohort"."""
    return J.gene_carriers(P.genotypes(t), P.site_genes(t), "BRCA2", key=["pk", "ln"])


@register("sample_vs_population", W("""
WITH y AS (SELECT count(*) AS n, count(*) FILTER (WHERE gnomad_af < 0.01) AS rare,
                  count(*) FILTER (WHERE gnomad_af < 0.01 OR gnomad_af IS NULL) AS rare_novel FROM px_summary),
     e AS (SELECT count(*) > 0 AS present FROM px_samples WHERE sample_id = '7'),
     p AS (SELECT count(*) / CAST(2504 AS DOUBLE) AS population_avg FROM px_sites WHERE chromosome = '17')
SELECT CAST(CASE WHEN present THEN n ELSE 0 END AS BIGINT) AS your_variant_count,
  CAST(CASE WHEN present THEN rare ELSE 0 END AS BIGINT) AS your_rare_count,
  CAST(CASE WHEN present THEN rare_novel ELSE 0 END AS BIGINT) AS your_rare_or_novel_count, population_avg,
  round(CAST(CASE WHEN present THEN n ELSE 0 END AS DOUBLE) / nullif(population_avg, 0) * 100 - 100, 2)
    AS pct_diff_from_avg
FROM y, e, p""", "px_summary", "px_samples", "px_sites"))
def sample_vs_population(t):
    return C.sample_vs_population(P.summary(t), P.px_samples(t), P.variant_sites(t, annotated=False), "7")


@register("clinvar_join", W(f"""
SELECT s.chromosome AS reference_name, s.position - 1 AS start_position, s.ref AS reference_bases,
  {_alts('s.')} AS alternate_bases, c.clinical_significance
FROM px_sites s JOIN px_clinvar c ON s.chromosome = c.chromosome AND s.position - 1 = c.start
  AND s.ref = c.reference AND s.alt = c.alternate
WHERE c.clinical_significance LIKE '%Pathogenic%'""", "px_sites", "px_clinvar"))
def clinvar_join(t):
    j = J.clinvar_join(P.variant_sites(t, annotated=False), P.px_clinvar(t))
    return _joined(j).select("reference_name", "start_position", "reference_bases", "alternate_bases",
                             "clinical_significance")


@register("pathogenic_like", W("""
SELECT clinical_significance, count(*) AS sites FROM px_clinvar
WHERE clinical_significance LIKE '%Pathogenic%' GROUP BY 1""", "px_clinvar"))
def pathogenic_like(t):
    from ..operators.filters import pathogenic_like as pl
    return P.px_clinvar(t).where(pl()).groupBy("clinical_significance").agg(F.count(F.lit(1)).alias("sites"))


@register("gene_region_variants", W("""
SELECT g.gene_symbol, g.chromosome, count(*) AS variant_count,
  count(*) FILTER (WHERE s.filter = 'PASS') AS pass_count
FROM px_sites s JOIN px_genes g ON s.chromosome = g.chromosome
  AND s.position BETWEEN g.start_position AND g.end_position
GROUP BY g.gene_symbol, g.chromosome""", "px_sites", "px_genes"))
def gene_region_variants(t):
    j = J.gene_region_variants(P.px_sites(t), P.px_genes(t), pos_col="position", contig_col="chromosome")
    return j.groupBy("gene_symbol", "chromosome").agg(F.count(F.lit(1)).alias("variant_count"),
                                                     F.count_if(F.col("filter") == "PASS").alias("pass_count"))


@register("sample_in_calls", W("""
SELECT s.sample_id, s.disease_status, count(*) AS site_count
FROM px_samples s JOIN px_calls c ON s.sample_id = CAST(c.ck AS VARCHAR) GROUP BY s.sample_id, s.disease_status""",
                               "px_samples", "px_calls"))
def sample_in_calls(t):
    j = J.sample_in_calls(P.px_samples(t).select("sample_id", "disease_status"), P.genotypes(t))
    return j.groupBy("sample_id", "disease_status").agg(F.count(F.lit(1)).alias("site_count"))


@register("unnest_genotypes", W("""
SELECT reference_name, start_position, sample_id, CAST(0 AS INTEGER) AS allele_index, CAST(a1 AS BIGINT) AS allele
FROM px_geno
UNION ALL
SELECT reference_name, start_position, sample_id, CAST(1 AS INTEGER), CAST(a2 AS BIGINT) FROM px_geno""",
                                "px_geno"))
def unnest_genotypes(t):
    return J.unnest_genotypes(P.genotypes(t)).select("reference_name", "start_position", "sample_id",
                                                     "allele_index", "allele")


@register("cohort_membership", W("""
SELECT g.reference_name, g.start_position, g.sample_id,
  CASE WHEN a1 < 0 THEN '.' ELSE CAST(a1 AS VARCHAR) END || '/' || CASE WHEN a2 < 0 THEN '.' ELSE CAST(a2 AS VARCHAR) END
    AS gt
FROM px_geno g WHERE g.sample_id IN (SELECT sample_id FROM px_populations WHERE super_population = 'EUR')""",
                                 "px_geno", "px_populations"))
def cohort_membership(t):
    eur = P.px_populations(t).where(F.col("super_population") == "EUR")
    return J.cohort_membership(P.genotypes(t), eur).select(
        "reference_name", "start_position", "sample_id", genotype_string("genotype").alias("gt"))


@register("phenotype_join", W("""
SELECT 'HP:0002664' AS phenotype_id, CASE s.disease_status WHEN 'case' THEN TRUE WHEN 'control' THEN FALSE END AS present,
  count(*) AS calls, count(*) FILTER (WHERE g.a1 > 0 OR g.a2 > 0) AS carrier_calls,
  count(DISTINCT g.sample_id) AS samples
FROM px_geno g JOIN px_samples s ON g.sample_id = s.sample_id GROUP BY 1, 2""", "px_geno", "px_samples"))
def phenotype_join(t):
    from ..functions import is_carrier
    j = J.phenotype_join(P.genotypes(t), P.samples_with_phenotypes(t))
    return j.groupBy("phenotype_id", "present").agg(
        F.count(F.lit(1)).alias("calls"), F.count_if(is_carrier("genotype")).alias("carrier_calls"),
        F.count_distinct("sample_id").alias("samples"))


@register("cohort_quality", W("""
SELECT s.super_population, count(DISTINCT g.sample_id) AS sample_count, count(*) AS call_count,
  count(*) FILTER (WHERE g.filter = 'PASS') AS pass_calls, round(avg(g.quality), 6) AS mean_quality,
  CAST(count(*) FILTER (WHERE g.filter = 'PASS') AS DOUBLE) / count(*) * 100 AS pass_rate_pct
FROM px_geno g JOIN px_samples s ON g.sample_id = s.sample_id GROUP BY s.super_population""",
                              "px_geno", "px_samples"))
def cohort_quality(t):
    return C.cohort_quality(P.genotypes(t), P.px_samples(t))
