"""Registered site-level queries: dashboards, Ti/Tv, summary, filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dashboards as D
from ..operators import filters as FL
from . import proxy as P
from .oracle_views import with_views as W
from .registry import register

# Region used by the region reports: contig 17, a window wide enough to hold
# sites at every scale factor (a report parameter, not a sampling device).
REGION = ("17", 50_000, 5_000_000)


def _alts_sql(alias: str = "") -> str:
    a = f"{alias}." if alias else ""
    return f"CASE WHEN {a}alt2 IS NULL THEN {a}alt ELSE {a}alt || ',' || {a}alt2 END"


# ------------------------------------------------------------- Ti/Tv --------

TITV_CASE = """CASE WHEN ({r} = 'A' AND {a} = 'G') OR ({r} = 'G' AND {a} = 'A')
  OR ({r} = 'C' AND {a} = 'T') OR ({r} = 'T' AND {a} = 'C') THEN 'Transition' ELSE 'Transversion' END"""


@register("titv", W(f"""
SELECT {TITV_CASE.format(r='reference_bases', a='alternate_base')} AS mutation_type, count(*) AS count
FROM px_summary WHERE length(reference_bases) = 1 AND length(alternate_base) = 1 GROUP BY 1""", "px_summary"))
def titv(t):
    """Ti/Tv over the flattened summary view (SNVs on the first ALT)."""
    return D.titv_summary(P.summary(t))


@register("titv_nested", W(f"""
SELECT {TITV_CASE.format(r='ref', a='alt')} AS mutation_type, count(*) AS count
FROM px_sites WHERE length(ref) = 1 AND alt2 IS NULL AND length(alt) = 1 GROUP BY 1""", "px_sites"))
def titv_nested(t):
    return D.titv_nested(P.variant_sites(t, annotated=False))


@register("titv_flat_pass", W(f"""
SELECT {TITV_CASE.format(r='ref', a='alt')} AS variant_type, count(*) AS count
FROM px_flat WHERE filter = 'PASS' AND length(ref) = 1 AND length(alt) = 1 GROUP BY 1""", "px_flat"))
def titv_flat_pass(t):
    return D.titv_flat_pass(P.flat_variants(t))


@register("titv_nested_pass", W(f"""
SELECT {TITV_CASE.format(r='ref', a='alt')} AS variant_type, count(*) AS count
FROM px_sites WHERE filter = 'PASS' GROUP BY 1""", "px_sites"))
def titv_nested_pass(t):
    return D.titv_nested_pass(P.variant_sites(t, annotated=False))


@register("titv_ratio", W(f"""
SELECT CAST(count(*) FILTER (WHERE m = 'Transition') AS BIGINT) AS transitions,
  CAST(count(*) FILTER (WHERE m = 'Transversion') AS BIGINT) AS transversions,
  round(CAST(count(*) FILTER (WHERE m = 'Transition') AS DOUBLE)
        / nullif(count(*) FILTER (WHERE m = 'Transversion'), 0), 6) AS titv_ratio
FROM (SELECT {TITV_CASE.format(r='reference_bases', a='alternate_base')} AS m FROM px_summary
      WHERE length(reference_bases) = 1 AND length(alternate_base) = 1) x""", "px_summary"))
def titv_ratio(t):
    return D.titv_ratio(D.titv_summary(P.summary(t)))


# --------------------------------------------------------- summary ----------

@register("variant_summary", W("""
SELECT reference_name, start_position, reference_bases, alternate_base, variant_id, quality, gene_symbol,
  consequence, impact, gnomad_af, sample_count, alt_allele_count FROM px_summary""", "px_summary"))
def variant_summary(t):
    return P.summary(t)


@register("frequency_spectrum", W("""
SELECT CASE WHEN gnomad_af IS NULL THEN 'Novel (Not in gnomAD)'
  WHEN gnomad_af < 0.0001 THEN 'Ultra-rare (<0.01%)' WHEN gnomad_af < 0.001 THEN 'Very rare (0.01-0.1%)'
  WHEN gnomad_af < 0.01 THEN 'Rare (0.1-1%)' WHEN gnomad_af < 0.05 THEN 'Low frequency (1-5%)'
  ELSE 'Common (>5%)' END AS frequency_bin, count(*) AS variant_count
FROM px_summary GROUP BY 1""", "px_summary"))
def frequency_spectrum(t):
    return D.frequency_spectrum(P.summary(t))


@register("af_by_gene", W("""
SELECT CASE WHEN gnomad_af IS NULL THEN 'Novel (Not in gnomAD)'
  WHEN gnomad_af < 0.0001 THEN 'Ultra-rare (<0.01%)' WHEN gnomad_af < 0.001 THEN 'Very rare (0.01-0.1%)'
  WHEN gnomad_af < 0.01 THEN 'Rare (0.1-1%)' WHEN gnomad_af < 0.05 THEN 'Low frequency (1-5%)'
  ELSE 'Common (>5%)' END AS frequency_bin, count(*) AS variant_count
FROM px_summary WHERE gene_symbol = 'BRCA2' GROUP BY 1""", "px_summary"))
def af_by_gene(t):
    return D.af_by_gene(P.summary(t), "BRCA2")


@register("gene_impact_burden", W("""
SELECT gene_symbol, count(*) AS total_variants,
  count(*) FILTER (WHERE impact = 'HIGH') AS high_impact,
  count(*) FILTER (WHERE impact = 'MODERATE') AS moderate_impact,
  count(*) FILTER (WHERE impact = 'LOW') AS low_impact,
  round(CAST(count(*) FILTER (WHERE impact = 'HIGH') AS DOUBLE) / count(*) * 100, 2) AS pct_high_impact
FROM px_summary WHERE gene_symbol IS NOT NULL GROUP BY gene_symbol HAVING count(*) >= 10
ORDER BY high_impact DESC, gene_symbol LIMIT 50""", "px_summary"))
def gene_impact_burden(t):
    return D.gene_impact_burden(P.summary(t))


@register("variants_by_gene", W("""
SELECT gene_symbol, count(*) AS variant_count, count(DISTINCT reference_name) AS contig_count
FROM px_summary WHERE gene_symbol IS NOT NULL GROUP BY gene_symbol""", "px_summary"))
def variants_by_gene(t):
    return D.variants_by_gene(P.summary(t))


# ------------------------------------------------------ dashboards ----------

@register("chromosome_counts", W("""
SELECT chromosome, count(*) AS count FROM px_flat GROUP BY chromosome""", "px_flat"))
def chromosome_counts(t):
    return D.chromosome_counts(P.flat_variants(t), "chromosome")


@register("chromosome_counts_karyotype", W("""
SELECT chromosome AS reference_name, count(*) AS variant_count FROM px_sites
WHERE chromosome IN ('1','2','3','4','5','6','7','8','9','10','11','12','13','14','15','16','17','18','19',
                     '20','21','22','X','Y')
GROUP BY chromosome""", "px_sites"))
def chromosome_counts_karyotype(t):
    return D.chromosome_counts_karyotype(P.variant_sites(t, annotated=False))


@register("quality_histogram", W("""
SELECT CAST(floor(quality / 10) * 10 AS BIGINT) AS quality_bin, count(*) AS count
FROM px_flat WHERE filter = 'PASS' GROUP BY 1""", "px_flat"))
def quality_histogram(t):
    return D.quality_histogram(P.flat_variants(t))


@register("quality_histogram_nested", W("""
SELECT CAST(floor(quality / 10) * 10 AS BIGINT) AS quality_bin, count(*) AS count
FROM px_sites WHERE filter = 'PASS' GROUP BY 1""", "px_sites"))
def quality_histogram_nested(t):
    return D.quality_histogram(P.variant_sites(t, annotated=False))


@register("filter_distribution", W("""
SELECT filter, count(*) AS count,
  round(CAST(count(*) AS DOUBLE) * 100 / CAST(sum(count(*)) OVER () AS DOUBLE), 4) AS pct
FROM px_flat GROUP BY filter""", "px_flat"))
def filter_distribution(t):
    return D.filter_distribution(P.flat_variants(t))


@register("top_allele_pairs", W("""
SELECT ref, alt, count(*) AS count FROM px_flat GROUP BY ref, alt ORDER BY count DESC, ref, alt LIMIT 10""",
                                  "px_flat"))
def top_allele_pairs(t):
    return D.top_allele_pairs(P.flat_variants(t))


@register("scorecards", W("""
SELECT count(*) AS total_variants, count(*) FILTER (WHERE filter = 'PASS') AS pass_count,
  round(CAST(count(*) FILTER (WHERE filter = 'PASS') AS DOUBLE) / count(*) * 100, 4) AS pass_rate_pct,
  round(avg(quality), 6) AS avg_quality, min(quality) AS min_quality, max(quality) AS max_quality,
  count(DISTINCT chromosome) AS chromosome_count
FROM px_flat""", "px_flat"))
def scorecards(t):
    return D.scorecards(P.flat_variants(t))


@register("dashboard_filter", W("""
SELECT chromosome, count(*) AS count FROM px_flat WHERE chromosome IN ('1', '17', 'X') GROUP BY chromosome""",
                                "px_flat"))
def dashboard_filter(t):
    return D.chromosome_counts(D.dashboard_filter(P.flat_variants(t), ["1", "17", "X"], "chromosome"),
                               "chromosome")


@register("region_counts", W(f"""
SELECT chromosome AS reference_name, count(*) AS variant_count, count(DISTINCT position - 1) AS unique_positions
FROM px_sites WHERE chromosome = '{REGION[0]}' AND position - 1 BETWEEN {REGION[1]} AND {REGION[2]}
GROUP BY chromosome""", "px_sites"))
def region_counts(t):
    return D.region_counts(P.variant_sites(t, annotated=False), *REGION)


@register("chr17_count", W("""
SELECT count(*) AS variant_count FROM px_sites WHERE chromosome = '17'""", "px_sites"))
def chr17_count(t):
    """Smoke count on one contig (deploy check)."""
    return P.variant_sites(t, annotated=False).where(F.col("reference_name") == "17").agg(
        F.count(F.lit(1)).alias("variant_count"))


# --------------------------------------------------------- filters ----------

_SITE_OUT = """chromosome AS reference_name, position - 1 AS start_position, position - 1 + length(ref) AS end_position,
  ref AS reference_bases, {alts} AS alternate_bases, quality"""


@register("region_variants", W(f"""
SELECT {_SITE_OUT.format(alts=_alts_sql())}, filter
FROM px_sites WHERE chromosome = '{REGION[0]}' AND position - 1 BETWEEN {REGION[1]} AND {REGION[2]}
ORDER BY start_position, reference_bases, alternate_bases LIMIT 100""", "px_sites"))
def region_variants(t):
    return FL.flat_sites(FL.region_variants(P.variant_sites(t, annotated=False), *REGION, limit=100))


@register("region_quality", W(f"""
SELECT {_SITE_OUT.format(alts=_alts_sql())}, filter
FROM px_sites WHERE chromosome = '{REGION[0]}' AND position - 1 BETWEEN {REGION[1]} AND {REGION[2]}
  AND quality > 30""", "px_sites"))
def region_quality(t):
    return FL.flat_sites(FL.region_quality(P.variant_sites(t, annotated=False), *REGION, min_q=30))


@register("filter_pass_qual", W(f"""
SELECT {_SITE_OUT.format(alts=_alts_sql())}, filter FROM px_sites
WHERE filter = 'PASS' AND quality >= 30""", "px_sites"))
def filter_pass_qual(t):
    return FL.flat_sites(FL.filter_pass_qual(P.variant_sites(t, annotated=False), 30))


@register("filter_pass_qual_flat", W("""
SELECT chromosome, position, ref, alt, quality FROM px_flat WHERE filter = 'PASS' AND quality >= 30""", "px_flat"))
def filter_pass_qual_flat(t):
    return FL.filter_pass_qual(P.flat_variants(t), 30).select("chromosome", "position", "ref", "alt", "quality")


@register("pass_member", W("""
SELECT chromosome AS reference_name, count(*) AS pass_sites FROM px_sites WHERE filter = 'PASS'
GROUP BY chromosome""", "px_sites"))
def pass_member(t):
    from ..functions import pass_member as pm
    return (P.variant_sites(t, annotated=False).where(pm("filter")).groupBy("reference_name")
            .agg(F.count(F.lit(1)).alias("pass_sites")))


@register("snv_only", W(f"""
SELECT {_SITE_OUT.format(alts=_alts_sql())} FROM px_sites
WHERE length(ref) = 1 AND alt2 IS NULL AND length(alt) = 1""", "px_sites"))
def snv_only(t):
    return FL.flat_sites(FL.snv_only(P.variant_sites(t, annotated=False))).drop("filter")


@register("biallelic_scored", W(f"""
SELECT {_SITE_OUT.format(alts=_alts_sql())} FROM px_sites WHERE alt2 IS NULL AND quality IS NOT NULL""",
                                "px_sites"))
def biallelic_scored(t):
    return FL.flat_sites(FL.biallelic_scored(P.variant_sites(t, annotated=False))).drop("filter")


@register("first_alt", W("""
SELECT chromosome AS reference_name, position - 1 AS start_position, alt AS alternate_base,
  CAST(CASE WHEN alt2 IS NULL THEN 1 ELSE 2 END AS INTEGER) AS alt_count FROM px_sites""", "px_sites"))
def first_alt(t):
    from ..functions import alt_count, first_alt as fa
    return P.variant_sites(t, annotated=False).select(
        "reference_name", "start_position", fa("alternate_bases").alias("alternate_base"),
        alt_count("alternate_bases").alias("alt_count"))


@register("json_alt", W("""
SELECT chromosome AS reference_name, position - 1 AS start_position, ref AS reference_bases, alt AS alt_allele,
  'rs' || CAST(position AS VARCHAR) AS rsid
FROM px_sites""", "px_sites"))
def json_alt(t):
    """ALT out of JSON-encoded elements (``{"alt": "G"}``) plus the first rsid."""
    return FL.json_alt(FL.json_encoded_alts(P.variant_sites(t, annotated=False)))


@register("normalize_contig", W("""
SELECT CASE WHEN pk % 2 = 0 THEN 'chr' || chromosome ELSE chromosome END AS raw_contig,
  chromosome AS contig, count(*) AS sites
FROM px_sites GROUP BY 1, 2""", "px_sites"))
def normalize_contig(t):
    from ..functions import normalize_contig as nc
    s = P.px_sites(t).select(
        F.when(F.col("pk") % 2 == 0, F.concat(F.lit("chr"), "chromosome")).otherwise(F.col("chromosome"))
         .alias("raw_contig"))
    return s.groupBy("raw_contig", nc("raw_contig").alias("contig")).agg(F.count(F.lit(1)).alias("sites"))


@register("contig_shard", W("""
SELECT CASE WHEN chromosome IN ('1','2','3','4','5') THEN 'chr1-5'
            WHEN chromosome IN ('6','7','8','9','10') THEN 'chr6-10'
            WHEN chromosome IN ('11','12','13','14','15') THEN 'chr11-15'
            ELSE 'chr16-Y' END AS shard, count(*) AS sites, min(position) AS min_position, max(position) AS max_position
FROM px_sites GROUP BY 1""", "px_sites"))
def contig_shard(t):
    from ..operators.normalize import contig_shard as cs
    return (cs(P.variant_sites(t, annotated=False)).groupBy("shard")
            .agg(F.count(F.lit(1)).alias("sites"), F.min(F.col("start_position") + 1).alias("min_position"),
                 F.max(F.col("start_position") + 1).alias("max_position")))


@register("high_impact", W("""
SELECT s.chromosome AS reference_name, s.position - 1 AS start_position, s.ref AS reference_bases,
  a.gene_symbol, a.impact
FROM px_sites s JOIN px_ann a ON s.pk = a.pk WHERE a.gene_symbol = 'BRCA1' AND a.impact IN ('HIGH', 'MODERATE')""",
                           "px_sites", "px_ann"))
def high_impact(t):
    return FL.high_impact(P.variant_sites(t), "BRCA1").select(
        "reference_name", "start_position", "reference_bases", "gene_symbol", "impact")


@register("unnest_annotations", W("""
SELECT s.chromosome AS reference_name, s.position - 1 AS start_position, a.gene_symbol, a.impact,
  CASE a.impact WHEN 'HIGH' THEN 'stop_gained' WHEN 'MODERATE' THEN 'missense_variant'
       WHEN 'LOW' THEN 'synonymous_variant' WHEN 'MODIFIER' THEN 'intron_variant' END AS consequence
FROM px_sites s JOIN px_ann a ON s.pk = a.pk WHERE a.gene_symbol IS NOT NULL""", "px_sites", "px_ann"))
def unnest_annotations(t):
    from ..operators.joins import unnest_annotations as ua
    return ua(P.variant_sites(t)).select("reference_name", "start_position", "gene_symbol", "impact",
                                         "consequence")


# ------------------------------------------------------ ML features ---------

_FEAT_SQL = """SELECT chromosome AS reference_name, position - 1 AS start_position, ref AS reference_bases, alt,
  quality, CAST(length(ref) AS INTEGER) AS ref_length, CAST(length(alt) AS INTEGER) AS alt_length,
  CASE WHEN length(ref) = length(alt) THEN 'SNP' WHEN length(ref) > length(alt) THEN 'DEL' ELSE 'INS' END
    AS variant_type
FROM px_sites WHERE alt2 IS NULL AND quality IS NOT NULL"""


@register("variant_features", W(_FEAT_SQL, "px_sites"))
def variant_features(t):
    from ..operators.features import variant_features as vf
    return vf(P.variant_sites(t, annotated=False))


def _hist_sql(col: str, bins: int) -> str:
    return f"""SELECT '{col}' AS profile, CAST(NULL AS VARCHAR) AS label, bin,
  lo + bin * (CAST(hi AS DOUBLE) - lo) / {bins} AS lower_edge, count(*) AS count
FROM (SELECT CAST(least(coalesce(floor(CAST({col} - lo AS DOUBLE) / nullif(CAST(hi - lo AS DOUBLE), 0) * {bins}), 0),
                        {bins - 1}) AS BIGINT) AS bin, lo, hi
      FROM f, (SELECT min({col}) AS lo, max({col}) AS hi FROM f) m WHERE {col} IS NOT NULL) x
GROUP BY bin, lo, hi"""


@register("feature_profiles", W(f"""
WITH f AS ({_FEAT_SQL})
SELECT 'variant_type' AS profile, variant_type AS label, CAST(NULL AS BIGINT) AS bin,
  CAST(NULL AS DOUBLE) AS lower_edge, count(*) AS count FROM f GROUP BY variant_type
UNION ALL
{_hist_sql('quality', 50)}
UNION ALL
{_hist_sql('ref_length', 20)}""", "px_sites"))
def feature_profiles(t):
    from ..operators.features import feature_profiles as fp, variant_features as vf
    return fp(vf(P.variant_sites(t, annotated=False)))


@register("label_with_annotations", W(f"""
WITH f AS ({_FEAT_SQL})
SELECT f.reference_name, f.start_position, f.variant_type, c.clinical_significance,
  CASE WHEN c.clinical_significance IS NULL THEN NULL WHEN c.clinical_significance LIKE '%Pathogenic%' THEN 1 ELSE 0 END
    AS label
FROM f LEFT JOIN px_clinvar c ON f.reference_name = c.chromosome AND f.start_position = c.start
  AND f.reference_bases = c.reference AND f.alt = c.alternate""", "px_sites", "px_clinvar"))
def label_with_annotations(t):
    from ..operators.features import label_with_annotations as lw, variant_features as vf
    j = lw(vf(P.variant_sites(t, annotated=False)), P.px_clinvar(t))
    return j.select("reference_name", "start_position", "variant_type", "clinical_significance", "label")
