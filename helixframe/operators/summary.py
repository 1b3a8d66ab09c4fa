"""``variant_summary``: the flattened one-row-per-site view every dashboard
query reads.

Two physical forms of the same definition:

* nested rows (``calls`` array inside the site, as read from VCF): computed
  with higher-order functions inside each row - no shuffle at all;
* sites + long genotype table (one row per site and sample): per-site
  counts are a partial/final ``groupBy`` on the site key, so a site with a
  huge number of calls is pre-aggregated map-side, then joined to sites.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import first_alt, has_allele

SUMMARY_COLUMNS = ["reference_name", "start_position", "reference_bases", "alternate_base", "variant_id",
                   "quality", "gene_symbol", "consequence", "impact", "gnomad_af", "sample_count",
                   "alt_allele_count"]

SITE_KEY = ["reference_name", "start_position", "reference_bases", "alternate_bases"]


def _annotation_cols() -> list:
    # Element 0 for all three fields (the reference's three independent
    # LIMIT 1 subqueries could pick different elements).
    a0 = F.get(F.col("annotations"), 0)
    return [a0.getField("gene_symbol").alias("gene_symbol"),
            a0.getField("consequence").alias("consequence"),
            a0.getField("impact").alias("impact"),
            F.col("population_frequencies.gnomad_af").alias("gnomad_af")]


def variant_summary_nested(variants: DataFrame) -> DataFrame:
    """Summary of nested rows: counts via ``size``/``filter`` over ``calls``."""
    calls = F.col("calls")
    return variants.select(
        "reference_name", "start_position", "reference_bases",
        first_alt("alternate_bases").alias("alternate_base"), "variant_id", "quality",
        *_annotation_cols(),
        F.coalesce(F.size(calls), F.lit(0)).cast("long").alias("sample_count"),
        # number of calls that contain allele 1 (not the number of alleles)
        F.coalesce(F.size(F.filter(calls, lambda c: has_allele(c["genotype"], 1))), F.lit(0))
         .cast("long").alias("alt_allele_count"),
    )


def call_counts(genotypes: DataFrame, key: list[str]) -> DataFrame:
    """Per-site sample_count and alt_allele_count from the long table."""
    return (genotypes.groupBy(*key)
            .agg(F.count(F.lit(1)).alias("sample_count"),
                 F.count_if(has_allele(F.col("genotype"), 1)).alias("alt_allele_count")))


def variant_summary(sites: DataFrame, genotypes: DataFrame, key: list[str] | None = None,
                    keep_key: bool = False) -> DataFrame:
    """Summary of site rows whose calls live in a long genotype table.

    ``key`` identifies a site in both frames (default: contig, start, REF,
    ALT array).  Sites without calls get zero counts, like an empty array.
    """
    key = key or SITE_KEY
    counts = call_counts(genotypes, key)
    j = sites.join(counts, key, "left")
    out = j.select(
        *(key if keep_key else []),
        *[c for c in ("reference_name", "start_position", "reference_bases") if not (keep_key and c in key)],
        first_alt("alternate_bases").alias("alternate_base"), "variant_id", "quality",
        *_annotation_cols(),
        F.coalesce("sample_count", F.lit(0)).cast("long").alias("sample_count"),
        F.coalesce("alt_allele_count", F.lit(0)).cast("long").alias("alt_allele_count"),
    )
    return out
