"""Warehouse dashboard aggregates (scorecards, per-contig counts, quality
bins, Ti/Tv, frequency spectrum, gene burden).

All are single ``groupBy`` aggregations: Spark runs them as partial
(map-side) + final aggregation, so only one row per group and partition
crosses the shuffle and a hot contig or gene costs no more than a cold one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import (KARYOTYPE, first_alt, is_snv, karyotype_index, mutation_type, pass_member,
                         safe_ratio)


def _is_pass(df: DataFrame, filter_col: str = "filter"):
    """PASS test for either the nested (array) or flat (string) filter column."""
    typ = df.schema[filter_col].dataType.typeName()
    return pass_member(filter_col) if typ == "array" else (F.col(filter_col) == "PASS")


# --------------------------------------------------------------- Ti/Tv ------

def titv_summary(summary: DataFrame) -> DataFrame:
    """Ti/Tv over the flattened view: SNV rows only (1-base REF and first ALT)."""
    return (summary.where(is_snv("reference_bases", "alternate_base"))
            .groupBy(mutation_type("reference_bases", "alternate_base").alias("mutation_type"))
            .agg(F.count(F.lit(1)).alias("count")))


def titv_nested(variants: DataFrame) -> DataFrame:
    """Ti/Tv over nested sites: 1-base REF, exactly one ALT of length 1."""
    alt = first_alt("alternate_bases")
    return (variants.where((F.length("reference_bases") == 1) & (F.size("alternate_bases") == 1)
                           & (F.length(alt) == 1))
            .groupBy(mutation_type("reference_bases", alt).alias("mutation_type"))
            .agg(F.count(F.lit(1)).alias("count")))


def titv_flat_pass(flat: DataFrame) -> DataFrame:
    """Ti/Tv over the flat call table, PASS rows, SNVs only."""
    return (flat.where((F.col("filter") == "PASS") & is_snv("ref", "alt"))
            .groupBy(mutation_type("ref", "alt").alias("variant_type"))
            .agg(F.count(F.lit(1)).alias("count")))


def titv_nested_pass(variants: DataFrame) -> DataFrame:
    """Ti/Tv over nested PASS sites with no length filter (indels fall into
    'Transversion', as in the dashboard form)."""
    return (variants.where(pass_member("filter"))
            .groupBy(mutation_type("reference_bases", first_alt("alternate_bases")).alias("variant_type"))
            .agg(F.count(F.lit(1)).alias("count")))


def titv_ratio(counts: DataFrame, label_col: str = "mutation_type") -> DataFrame:
    """One row: transitions, transversions and their ratio (NULL if no Tv)."""
    return counts.agg(
        F.coalesce(F.sum(F.when(F.col(label_col) == "Transition", F.col("count"))), F.lit(0)).cast("long")
         .alias("transitions"),
        F.coalesce(F.sum(F.when(F.col(label_col) == "Transversion", F.col("count"))), F.lit(0)).cast("long")
         .alias("transversions"),
    ).withColumn("titv_ratio", F.round(safe_ratio("transitions", "transversions"), 6))


# ------------------------------------------------------ contig counts ------

def chromosome_counts(df: DataFrame, contig_col: str = "reference_name") -> DataFrame:
    """Variants per contig, largest first (ties by contig)."""
    return (df.groupBy(contig_col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(contig_col)))


def chromosome_counts_karyotype(df: DataFrame, contig_col: str = "reference_name") -> DataFrame:
    """Counts restricted to 1-22, X, Y in karyotype order."""
    return (df.where(F.col(contig_col).isin(KARYOTYPE))
            .groupBy(contig_col).agg(F.count(F.lit(1)).alias("variant_count"))
            .orderBy(karyotype_index(contig_col)))


def dashboard_filter(df: DataFrame, chroms: list[str] | None = None,
                     contig_col: str = "reference_name") -> DataFrame:
    """The report-wide contig drop-down: ``None`` keeps everything."""
    return df if not chroms else df.where(F.col(contig_col).isin(list(chroms)))


# ----------------------------------------------------------- quality -------

def quality_histogram(df: DataFrame, width: int = 10, filter_col: str = "filter") -> DataFrame:
    """floor(quality / width) * width bins over PASS rows; NULL quality kept
    as its own bin."""
    qbin = (F.floor(F.col("quality") / F.lit(float(width))) * width).cast("long")
    return (df.where(_is_pass(df, filter_col)).groupBy(qbin.alias("quality_bin"))
            .agg(F.count(F.lit(1)).alias("count")).orderBy(F.asc_nulls_first("quality_bin")))


def filter_distribution(flat: DataFrame) -> DataFrame:
    """Rows per FILTER value and their share of the total (percent).

    The total is a window sum over the (few) grouped rows: one scan."""
    g = flat.groupBy("filter").agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return g.select("filter", "count", F.round(F.col("count") * 100.0 / total, 4).alias("pct"))


def top_allele_pairs(flat: DataFrame, n: int = 10) -> DataFrame:
    """Most frequent (ref, alt) pairs; ties broken by the pair."""
    return (flat.groupBy("ref", "alt").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), "ref", "alt").limit(n))


def scorecards(flat: DataFrame) -> DataFrame:
    """Total, PASS count/rate, quality mean/min/max and contig count in one pass."""
    return flat.agg(
        F.count(F.lit(1)).alias("total_variants"),
        F.count_if(F.col("filter") == "PASS").alias("pass_count"),
        F.round(safe_ratio(F.count_if(F.col("filter") == "PASS"), F.count(F.lit(1))) * 100, 4)
         .alias("pass_rate_pct"),
        F.round(F.avg("quality"), 6).alias("avg_quality"),
        F.min("quality").alias("min_quality"),
        F.max("quality").alias("max_quality"),
        F.count_distinct("chromosome").alias("chromosome_count"),
    )


def region_counts(variants: DataFrame, contig: str, start: int, end: int) -> DataFrame:
    """Count and distinct start positions of the region, per contig."""
    return (variants.where((F.col("reference_name") == contig)
                           & F.col("start_position").between(start, end))
            .groupBy("reference_name")
            .agg(F.count(F.lit(1)).alias("variant_count"),
                 F.count_distinct("start_position").alias("unique_positions")))


# ------------------------------------------------- frequency / burden -------

# Frequency spectrum bins (upper bounds are exclusive; the last
# bin, labelled ">5%", starts at exactly 5%).
FREQUENCY_BINS = [
    (0.0001, "Ultra-rare (<0.01%)"),
    (0.001, "Very rare (0.01-0.1%)"),
    (0.01, "Rare (0.1-1%)"),
    (0.05, "Low frequency (1-5%)"),
]
NOVEL_LABEL = "Novel (Not in gnomAD)"
COMMON_LABEL = "Common (>5%)"


def frequency_bin(af_col: str = "gnomad_af"):
    af = F.col(af_col)
    expr = F.when(af.isNull(), F.lit(NOVEL_LABEL))
    for upper, label in FREQUENCY_BINS:
        expr = expr.when(af < upper, F.lit(label))
    return expr.otherwise(F.lit(COMMON_LABEL))


def frequency_spectrum(summary: DataFrame) -> DataFrame:
    return (summary.groupBy(frequency_bin().alias("frequency_bin"))
            .agg(F.count(F.lit(1)).alias("variant_count"))
            .orderBy(F.desc("variant_count"), "frequency_bin"))


def gene_impact_burden(summary: DataFrame, min_total: int = 10, limit: int = 50) -> DataFrame:
    """Per gene: totals by impact class and % HIGH; genes with >= min_total
    variants, top ``limit`` by HIGH count (ties by gene)."""
    imp = F.col("impact")
    g = (summary.where(F.col("gene_symbol").isNotNull()).groupBy("gene_symbol")
         .agg(F.count(F.lit(1)).alias("total_variants"),
              F.count_if(imp == "HIGH").alias("high_impact"),
              F.count_if(imp == "MODERATE").alias("moderate_impact"),
              F.count_if(imp == "LOW").alias("low_impact")))
    return (g.where(F.col("total_variants") >= min_total)
            .withColumn("pct_high_impact", F.round(safe_ratio("high_impact", "total_variants") * 100, 2))
            .orderBy(F.desc("high_impact"), "gene_symbol").limit(limit))


def variants_by_gene(summary: DataFrame) -> DataFrame:
    """"Variant distribution by gene" tile: sites per first-annotation gene."""
    return (summary.where(F.col("gene_symbol").isNotNull()).groupBy("gene_symbol")
            .agg(F.count(F.lit(1)).alias("variant_count"),
                 F.count_distinct("reference_name").alias("contig_count")))


def af_by_gene(summary: DataFrame, gene: str) -> DataFrame:
    """Allele-frequency spectrum for one gene."""
    return frequency_spectrum(summary.where(F.col("gene_symbol") == gene))
