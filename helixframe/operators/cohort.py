"""Cohort-level genotype statistics: allele frequency, carriers by
population, case/control burden, sample vs. population, cohort QC.

Inputs are either nested site rows (``calls`` array; statistics computed
inside each row with higher-order functions, no shuffle) or the long
genotype table (one row per site and sample; per-site ``groupBy`` with
partial aggregation, so a site or sample holding a third of all calls is
pre-reduced map-side and never collected into one task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import first_alt, is_carrier, safe_ratio
from .joins import sized_lookup
from .summary import SITE_KEY


def _n(arr: Column, pred) -> Column:
    return F.coalesce(F.size(F.filter(arr, pred)), F.lit(0))


def allele_frequency(df: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Per site:

    * ``calculated_af`` - the reference definition: alleles equal to 1
      divided by 2 x (number of call-allele entries); diploid AF therefore
      comes out halved and only allele 1 counts;
    * ``alt_af`` - corrected: called non-reference alleles / called alleles.

    Sites with no calls get NULL for both (SAFE_DIVIDE).
    """
    if "calls" in df.columns:
        alleles = F.flatten(F.transform("calls", lambda c: c["genotype"]))
        n = F.coalesce(F.size(alleles), F.lit(0))
        return df.select(
            "reference_name", "start_position", "reference_bases", "alternate_bases",
            F.try_divide(_n(alleles, lambda g: g == 1).cast("double"), (n * 2).cast("double"))
             .alias("calculated_af"),
            F.try_divide(_n(alleles, lambda g: g > 0).cast("double"),
                         _n(alleles, lambda g: g >= 0).cast("double")).alias("alt_af"))
    key = key or SITE_KEY
    g = F.col("genotype")
    agg = df.groupBy(*key).agg(
        F.sum(F.size(g)).alias("_n"),
        F.sum(_n(g, lambda a: a == 1)).alias("_ones"),
        F.sum(_n(g, lambda a: a > 0)).alias("_nonref"),
        F.sum(_n(g, lambda a: a >= 0)).alias("_called"))
    return agg.select(
        *key,
        F.try_divide(F.col("_ones").cast("double"), (F.col("_n") * 2).cast("double")).alias("calculated_af"),
        F.try_divide(F.col("_nonref").cast("double"), F.col("_called").cast("double")).alias("alt_af"))


def population_carriers(genotypes: DataFrame, cohorts: DataFrame, names: list[str],
                        key: list[str] | None = None, cohort_col: str = "super_population") -> DataFrame:
    """Per site and cohort in ``names``:

    * ``<cohort>_carriers`` - reference definition: calls with a phase set
      (hom-ref calls included);
    * ``<cohort>_true_carriers`` - calls with a called non-reference allele.

    ``cohorts`` maps ``sample_id`` -> ``cohort_col``.  Every site with calls
    appears (zero counts when no cohort sample is called there).
    """
    key = key or SITE_KEY
    c = cohorts.where(F.col(cohort_col).isin(list(names))).select("sample_id", F.col(cohort_col).alias("_cohort"))
    j = genotypes.join(sized_lookup(c), "sample_id", "left")
    aggs = []
    for n in names:
        in_c = F.col("_cohort") == n
        aggs.append(F.count_if(in_c & F.col("phaseset").isNotNull()).alias(f"{n.lower()}_carriers"))
        aggs.append(F.count_if(in_c & is_carrier("genotype")).alias(f"{n.lower()}_true_carriers"))
    return j.groupBy(*key).agg(*aggs)


def case_control_burden(samples: DataFrame, genotypes: DataFrame, site_genes: DataFrame, gene: str,
                        key: list[str], impacts=("HIGH", "MODERATE")) -> DataFrame:
    """Distinct sites (contig:position) per sample in ``gene`` at the given
    impacts, then count/mean/sd/min/max per disease status.

    Reference semantics kept: any sample *listed* in the calls counts
    (hom-ref included) and samples with zero such sites are absent.
    """
    gs = sized_lookup(site_genes.where((F.col("gene_symbol") == gene) & F.col("impact").isin(list(impacts)))
                      .select(*key).distinct())
    per = (genotypes.join(gs, key, "left_semi")
           .join(sized_lookup(samples.select("sample_id", "disease_status")), "sample_id")
           .groupBy("sample_id", "disease_status")
           .agg(F.count_distinct(F.concat_ws(":", "reference_name", F.col("start_position").cast("string")))
                .alias("variant_count")))
    return per.groupBy("disease_status").agg(
        F.count(F.lit(1)).alias("sample_count"),
        F.avg("variant_count").alias("avg_variants"),
        F.round(F.stddev_samp("variant_count"), 6).alias("std_variants"),
        F.min("variant_count").alias("min_variants"),
        F.max("variant_count").alias("max_variants"))


def sample_vs_population(summary: DataFrame, samples: DataFrame, pop_variants: DataFrame, sample_id: str,
                         n_pop: int = 2504, pop_contig: str = "17") -> DataFrame:
    """"Your sample" counts vs. the per-sample mean of a population table.

    Reference semantics: the sample side counts the whole summary when the
    sample row exists (else 0); the population side is one contig divided by
    ``n_pop``.  The sample check and the population mean are scalar
    subqueries.
    """
    present = samples.where(F.col("sample_id") == sample_id).agg(F.count(F.lit(1)) > 0).scalar()
    af = F.col("gnomad_af")
    y = summary.agg(F.count(F.lit(1)).alias("_n"), F.count_if(af < 0.01).alias("_rare"),
                    F.count_if((af < 0.01) | af.isNull()).alias("_rare_novel"))
    pop = pop_variants.where(F.col("reference_name") == pop_contig).agg(
        F.count(F.lit(1)) / F.lit(float(n_pop))).scalar()

    def gated(c):
        return F.when(present, F.col(c)).otherwise(F.lit(0)).cast("long")

    y = y.select(gated("_n").alias("your_variant_count"), gated("_rare").alias("your_rare_count"),
                 # corrected: novel (not in gnomAD) sites are rare too
                 gated("_rare_novel").alias("your_rare_or_novel_count"), pop.alias("population_avg"))
    return y.select(
        "your_variant_count", "your_rare_count", "your_rare_or_novel_count", "population_avg",
        F.round(safe_ratio("your_variant_count", "population_avg") * 100 - 100, 2).alias("pct_diff_from_avg"))


def cohort_quality(genotypes: DataFrame, samples: DataFrame, by: str = "super_population") -> DataFrame:
    """Per cohort: samples, calls, PASS calls and rate, mean site quality."""
    filt = F.col("filter")
    is_pass = (F.array_contains(filt, "PASS") if dict(genotypes.dtypes)["filter"].startswith("array")
               else filt == "PASS")
    j = genotypes.join(sized_lookup(samples.select("sample_id", by)), "sample_id")
    return j.groupBy(by).agg(
        F.count_distinct("sample_id").alias("sample_count"),
        F.count(F.lit(1)).alias("call_count"),
        F.count_if(is_pass).alias("pass_calls"),
        F.round(F.avg("quality"), 6).alias("mean_quality"),
    ).withColumn("pass_rate_pct", safe_ratio("pass_calls", "call_count") * 100)


def carriers_by_cohort(genotypes: DataFrame, samples: DataFrame, by: str = "super_population") -> DataFrame:
    """Carrier calls per cohort and site count (dashboard "cohort comparisons")."""
    j = genotypes.join(sized_lookup(samples.select("sample_id", by)), "sample_id")
    return j.groupBy(by).agg(F.count_if(is_carrier("genotype")).alias("carrier_calls"),
                             F.count(F.lit(1)).alias("calls"))


def first_alt_col(df: DataFrame) -> DataFrame:
    return df.withColumn("alt_allele", first_alt("alternate_bases"))
