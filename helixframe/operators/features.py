"""ML feature sets over sites: allele lengths and class, profiles
(histograms with data-driven bin edges), ClinVar labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import alt_count, first_alt, variant_class


def variant_features(variants: DataFrame, limit: int | None = None) -> DataFrame:
    """Biallelic sites with a quality: REF/ALT lengths and SNP/DEL/INS class
    (equal lengths count as SNP, MNPs included).  ``limit`` is an optional
    training-sample size, ordered by position so it is deterministic."""
    alt = first_alt("alternate_bases")
    x = variants.where((alt_count("alternate_bases") == 1) & F.col("quality").isNotNull()).select(
        "reference_name", "start_position", "reference_bases", alt.alias("alt"), "quality",
        F.length("reference_bases").alias("ref_length"), F.length(alt).alias("alt_length"),
        variant_class("reference_bases", alt).alias("variant_type"))
    if limit:
        x = x.orderBy("reference_name", "start_position", "reference_bases", "alt").limit(limit)
    return x


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width histogram between the column's min and max (max falls in
    the last bin).  min and max are scalar subqueries (one small aggregate
    each, run once), then a grouped count: no sort, no driver round trip."""
    lo = df.agg(F.min(col)).scalar()
    hi = df.agg(F.max(col)).scalar()
    x = df.where(F.col(col).isNotNull()).select(F.col(col), lo.alias("_lo"), hi.alias("_hi"))
    span = (F.col("_hi") - F.col("_lo")).cast("double")
    raw = F.floor(F.try_divide((F.col(col) - F.col("_lo")).cast("double"), span) * bins)
    b = F.least(F.coalesce(raw, F.lit(0)), F.lit(bins - 1)).cast("long")
    g = x.groupBy(b.alias("bin"), "_lo", "_hi").agg(F.count(F.lit(1)).alias("count"))
    return g.select("bin", (F.col("_lo") + F.col("bin") * span / bins).alias("lower_edge"), "count")


def profiles(df: DataFrame, classes: list[str], bins: dict[str, int]) -> DataFrame:
    """Value counts of the ``classes`` columns and equal-width histograms of
    the ``bins`` columns (column: number of bins) as one frame (profile,
    label, bin, lower_edge, count), in two scans however many columns: one
    aggregate for all ranges, then one count of a row's entries stacked.
    Nulls fall in no bin and count as a class of their own."""
    ranges = df.agg(F.struct(*[f(c).alias(f"{n}_{i}") for i, c in enumerate(bins)
                               for n, f in (("lo", F.min), ("hi", F.max))]).alias("_r")).scalar()
    none, number = F.lit(None).cast("string"), F.lit(None).cast("long")

    def entry(profile, label, b):
        return F.struct(F.lit(profile).alias("profile"), label.alias("label"), b.alias("bin"))

    entries = [entry(c, F.col(c).cast("string"), number) for c in classes]
    edges = F.lit(None).cast("double")
    for i, (c, n) in enumerate(bins.items()):
        lo = F.col(f"_r.lo_{i}")
        span = (F.col(f"_r.hi_{i}") - lo).cast("double")
        place = F.floor(F.try_divide((F.col(c) - lo).cast("double"), span) * n)
        b = F.least(F.coalesce(place, F.lit(0)), F.lit(n - 1)).cast("long")
        entries.append(F.when(F.col(c).isNotNull(), entry(c, none, b)))
        edges = F.when((F.col("profile") == c) & F.col("bin").isNotNull(), lo + F.col("bin") * span / n).otherwise(edges)
    x = df.select(*classes, *bins, ranges.alias("_r")).select(F.explode(F.array(*entries)).alias("_e"))
    x = x.where(F.col("_e").isNotNull()).groupBy("_e.profile", "_e.label", "_e.bin").agg(
        F.count(F.lit(1)).alias("count"))
    return x.select("*", ranges.alias("_r")).select("profile", "label", "bin", edges.alias("lower_edge"), "count")


def feature_profiles(features: DataFrame, quality_bins: int = 50, length_bins: int = 20) -> DataFrame:
    """Class counts, quality histogram and REF-length histogram in one frame
    (profile, label, bin, lower_edge, count)."""
    return profiles(features, ["variant_type"], {"quality": quality_bins, "ref_length": length_bins})


def label_with_annotations(features: DataFrame, clinvar: DataFrame) -> DataFrame:
    """Supervised labels: 1 when ClinVar calls the site pathogenic-like, 0
    when ClinVar lists it otherwise, NULL when unlabeled (left join on
    contig, start, REF, ALT)."""
    from ..functions import normalize_contig
    c = clinvar.select(normalize_contig("chromosome").alias("_c"), F.col("start").alias("start_position"),
                       F.col("reference").alias("reference_bases"), F.col("alternate").alias("alt"),
                       "clinical_significance")
    f = features.withColumn("_c", normalize_contig("reference_name"))
    j = f.join(c, ["_c", "start_position", "reference_bases", "alt"], "left").drop("_c")
    lab = F.when(F.col("clinical_significance").isNull(), F.lit(None).cast("int")) \
           .when(F.col("clinical_significance").like("%Pathogenic%"), F.lit(1)).otherwise(F.lit(0))
    return j.withColumn("label", lab)
