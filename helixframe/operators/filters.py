"""Row filters and projections over site tables.

Every predicate is a plain Column expression, so Catalyst pushes it into the
Parquet scan (``PushedFilters``) when the input is a stored table: a region
lookup on a table laid out by ``(reference_name, start_position)`` reads only
the row groups whose min/max cover the interval.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import alt_count, first_alt, normalize_contig, pass_member


def _is_array(df: DataFrame, col: str) -> bool:
    return df.schema[col].dataType.typeName() == "array"


def in_region(contig: str, start: int, end: int, contig_col: str = "reference_name",
              pos_col: str = "start_position", normalize: bool = False) -> Column:
    """Contig equality plus an inclusive position interval.  ``normalize``
    compares ``chr17`` and ``17`` alike (costs the pushdown of the contig
    predicate, the interval still pushes)."""
    c = normalize_contig(contig_col) if normalize else F.col(contig_col)
    target = normalize_contig(F.lit(contig)) if normalize else F.lit(contig)
    return (c == target) & F.col(pos_col).between(start, end)


def region_variants(variants: DataFrame, contig: str, start: int, end: int, limit: int | None = 100,
                    normalize: bool = False) -> DataFrame:
    """Sites in a region ordered by position (REF/ALT tie-breaks), top ``limit``."""
    out = variants.where(in_region(contig, start, end, normalize=normalize))
    order = [F.col("start_position"), F.col("reference_bases"), F.array_join("alternate_bases", ",")]
    out = out.orderBy(*order)
    return out.limit(limit) if limit else out


def contig_spellings(contig: str) -> list[str]:
    """A contig with and without ``chr``: an IN list that the scan can push down."""
    bare = contig[3:] if contig.lower().startswith("chr") else contig
    return [bare, f"chr{bare}"]


def overlaps_region(contig: str, start: int, end: int) -> Column:
    """Spans [start_position, end_position) that touch the region's positions
    ``start`` to ``end`` (0-based, both inclusive), under either spelling of
    the contig; every part is pushed down to the scan."""
    return (F.col("reference_name").isin(contig_spellings(contig)) & (F.col("start_position") <= end)
            & (F.col("end_position") > start))


def region_overlaps(variants: DataFrame, contig: str, start: int, end: int, limit: int | None = 100) -> DataFrame:
    """As ``region_variants``, but sites that begin before the region and
    reach into it (deletions, reference blocks) count, too."""
    out = variants.where(overlaps_region(contig, start, end))
    out = out.orderBy("start_position", "end_position", "reference_bases", F.array_join("alternate_bases", ","))
    return out.limit(limit) if limit else out


def region_quality(variants: DataFrame, contig: str, start: int, end: int, min_q: float = 30,
                   normalize: bool = False) -> DataFrame:
    """Sites in a region with ``quality > min_q`` (NULL quality drops)."""
    return variants.where(in_region(contig, start, end, normalize=normalize) & (F.col("quality") > min_q))


def filter_pass_qual(variants: DataFrame, min_q: float = 30) -> DataFrame:
    """``bcftools view -f PASS -i 'QUAL >= min_q'``: PASS and quality >= min_q;
    works on array (nested) and string (flat) FILTER columns."""
    is_pass = pass_member("filter") if _is_array(variants, "filter") else (F.col("filter") == "PASS")
    return variants.where(is_pass & (F.col("quality") >= min_q))


def snv_only(variants: DataFrame) -> DataFrame:
    """1-base REF and exactly one 1-base ALT (nested) / 1-base ref+alt (flat)."""
    if "alternate_bases" in variants.columns:
        return variants.where((F.length("reference_bases") == 1) & (alt_count("alternate_bases") == 1)
                              & (F.length(first_alt("alternate_bases")) == 1))
    return variants.where((F.length("ref") == 1) & (F.length("alt") == 1))


def biallelic_scored(variants: DataFrame) -> DataFrame:
    """Exactly one ALT and a quality value."""
    return variants.where((alt_count("alternate_bases") == 1) & F.col("quality").isNotNull())


def high_impact(variants: DataFrame, gene: str, impacts=("HIGH", "MODERATE")) -> DataFrame:
    """Sites x annotations of ``gene`` with impact in ``impacts``."""
    from .joins import unnest_annotations
    a = unnest_annotations(variants)
    return a.where((F.col("gene_symbol") == gene) & F.col("impact").isin(list(impacts)))


def pathogenic_like(col: str = "clinical_significance") -> Column:
    """``LIKE '%Pathogenic%'`` (case-sensitive: 'Likely_pathogenic' alone fails)."""
    return F.col(col).like("%Pathogenic%")


# The 20 standard amino-acid letters.
AMINO_ACIDS = "ACDEFGHIKLMNPQRSTVWY"


def valid_sequence(df: DataFrame, col: str = "sequence") -> DataFrame:
    """Adds ``clean_sequence`` (upper-case, blanks and line feeds removed) and
    ``is_valid`` (only amino-acid letters; the empty string is valid)."""
    clean = F.regexp_replace(F.upper(F.col(col)), r"[ \n]", "")
    return (df.withColumn("clean_sequence", clean)
            .withColumn("is_valid", F.col("clean_sequence").rlike(rf"\A[{AMINO_ACIDS}]*\z")))


def json_encoded_alts(variants: DataFrame) -> DataFrame:
    """Re-encode ALT elements as JSON objects ``{"alt": ...}`` and variant ids
    as a ``names`` array (the public table's shape)."""
    return (variants.withColumn("alternate_bases",
                                F.transform("alternate_bases", lambda a: F.to_json(F.struct(a.alias("alt")))))
            .withColumn("names", F.array("variant_id")))


def json_alt(variants: DataFrame) -> DataFrame:
    """``JSON_EXTRACT_SCALAR(alternate_bases[0], '$.alt')`` and ``names[0]``."""
    return variants.select(
        "reference_name", "start_position", "reference_bases",
        F.get_json_object(first_alt("alternate_bases"), "$.alt").alias("alt_allele"),
        F.get(F.col("names"), 0).alias("rsid"))


def flat_sites(variants: DataFrame) -> DataFrame:
    """Report projection of site rows: arrays joined to strings."""
    return variants.select(
        "reference_name", "start_position", "end_position", "reference_bases",
        F.array_join("alternate_bases", ",").alias("alternate_bases"), "quality",
        F.array_join("filter", ";").alias("filter"))
