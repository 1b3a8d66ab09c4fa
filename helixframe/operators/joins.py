"""Joins: lateral unnests, cohort joins, ClinVar and gene-range joins.

Broadcast policy: a join side is broadcast only behind a size check.
Lookups whose size is bounded by the cohort (samples, cohort lists, one
gene's sites) go through ``sized_lookup``: materialised once, counted, and
broadcast only under ``LOOKUP_MAX_ROWS`` - so the genotype table is not
shuffled just to meet a small lookup.  Everything else (ClinVar, gene bins,
site tables) is left to Spark's plan-time threshold and AQE's runtime
conversion, which measure before broadcasting and otherwise keep the
shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import is_carrier, normalize_contig

# A lookup side up to this many rows is broadcast (tens of MB for the
# narrow lookups used here); above it the join stays a shuffle join.
LOOKUP_MAX_ROWS = 1_000_000


def sized_lookup(df: DataFrame, max_rows: int = LOOKUP_MAX_ROWS) -> DataFrame:
    """Materialise a lookup side once into the shared checkpoint folder and
    broadcast it only if its *actual* row count is within ``max_rows``.

    Plan-time estimates of derived lookups (filtered joins of dimension
    tables) are products of input sizes and would force a shuffle of the
    genotype table; the runtime count avoids that shuffle when the lookup is
    small and keeps the shuffle join when it is not.  The checkpoint cuts
    the lookup's lineage, so the count and the join read it once."""
    m = df.checkpoint(eager=True)
    return F.broadcast(m) if m.count() <= max_rows else m


def unnest_annotations(variants: DataFrame) -> DataFrame:
    """Site x annotation rows (``inline``; sites without annotations drop,
    as the reference's inner UNNEST join does)."""
    keep = [c for c in variants.columns if c != "annotations"]
    return variants.select(*keep, F.inline("annotations"))


def unnest_calls(variants: DataFrame) -> DataFrame:
    """Nested rows -> long genotype table (site columns x one call, with its
    place ``sample_index`` in the row).

    The outer form, then a filter: for the inner one Spark puts a filter on
    the number of calls before it, and where the calls are computed (parsed
    from text) that computes them all a second time."""
    keep = [c for c in variants.columns if c not in ("calls", "sample_index")]
    x = variants.select(*keep, F.posexplode_outer("calls").alias("sample_index", "_c"))
    return x.where(F.col("sample_index").isNotNull()).select(*keep, "sample_index", "_c.*")


def unnest_genotypes(genotypes: DataFrame) -> DataFrame:
    """Call x allele rows: ``allele_index`` and ``allele`` per genotype entry."""
    keep = [c for c in genotypes.columns if c != "genotype"]
    return genotypes.select(*keep, F.posexplode("genotype").alias("allele_index", "allele"))


def cohort_size(samples: DataFrame, populations: DataFrame) -> DataFrame:
    """Distinct samples per (super_population, population) of the lookup
    (the lookup's labels are the ones grouped, as in the reference)."""
    p = populations.select("sample_id", "super_population", "population")
    return (samples.select("sample_id").join(p, "sample_id")
            .groupBy("super_population", "population")
            .agg(F.count_distinct("sample_id").alias("sample_count"))
            .orderBy("super_population", F.desc("sample_count"), "population"))


def cohort_membership(genotypes: DataFrame, cohort: DataFrame) -> DataFrame:
    """Calls of samples listed in ``cohort`` (one ``sample_id`` column):
    a left-semi join, so a sample listed twice does not duplicate calls."""
    return genotypes.join(sized_lookup(cohort.select("sample_id").distinct()), "sample_id", "left_semi")


def cohort_membership_list(genotypes: DataFrame, sample_ids: list[str]) -> DataFrame:
    """Short literal lists (query parameters) become an ``isin`` filter."""
    return genotypes.where(F.col("sample_id").isin(list(sample_ids)))


def sample_in_calls(samples: DataFrame, genotypes: DataFrame) -> DataFrame:
    """Sample rows joined to every site whose calls list the sample: the
    reference's ``sample_id IN (SELECT ... FROM UNNEST(calls))`` ON clause
    rewritten as an equi-join on the long table (no nested-loop join)."""
    return sized_lookup(samples).join(genotypes, "sample_id")


def clinvar_join(variants: DataFrame, clinvar: DataFrame, contig: str | None = None,
                 start: int | None = None, end: int | None = None,
                 pathogenic_only: bool = True, how: str = "inner") -> DataFrame:
    """Sites joined to ClinVar on contig, 0-based start, REF and first ALT.

    Contig names are normalised on both sides (``chr17`` = ``17``).  Filters
    on ClinVar run before the shuffle; a region, when given, is pushed to the
    site scan.
    """
    v = variants.withColumn("_contig", normalize_contig("reference_name")) \
                .withColumn("_alt", F.get(F.col("alternate_bases"), 0))
    if contig is not None:
        v = v.where((v._contig == normalize_contig(F.lit(contig)))
                    & F.col("start_position").between(start, end))
    c = clinvar
    if pathogenic_only:
        c = c.where(F.col("clinical_significance").like("%Pathogenic%"))
    c = c.select(normalize_contig("chromosome").alias("_contig"), F.col("start").alias("start_position"),
                 F.col("reference").alias("reference_bases"), F.col("alternate").alias("_alt"),
                 *[x for x in ("clinical_significance", "review_status", "phenotypes") if x in clinvar.columns])
    return v.join(c, ["_contig", "start_position", "reference_bases", "_alt"], how).drop("_contig", "_alt")


def gene_region_variants(sites: DataFrame, genes: DataFrame, pos_col: str = "start_position",
                         contig_col: str = "reference_name", bin_size: int = 100_000) -> DataFrame:
    """Range join: each site x every gene whose [start, end] holds it.

    Equi-join on (contig, position bin) then the exact BETWEEN: genes are
    exploded into the bins they span (bounded by span / bin_size), each site
    falls in exactly one bin, so the join is a hash/sort-merge join on a
    well-spread key instead of a per-contig nested loop (one contig may hold
    a third of all sites).
    """
    g = genes.select(
        normalize_contig("chromosome").alias("_contig"), "gene_symbol",
        F.col("start_position").alias("gene_start"), F.col("end_position").alias("gene_end"))
    g = g.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("gene_start") / bin_size).cast("long"),
                                                  F.floor(F.col("gene_end") / bin_size).cast("long"))))
    s = sites.withColumn("_contig", normalize_contig(contig_col)) \
             .withColumn("_bin", F.floor(F.col(pos_col) / bin_size).cast("long"))
    j = s.join(g, ["_contig", "_bin"])
    return j.where(F.col(pos_col).between(F.col("gene_start"), F.col("gene_end"))).drop("_contig", "_bin")


# Bins of 2^14, 2^17, ... 2^29 positions (16 kb to 512 Mb).
SPAN_LEVELS = (14, 17, 20, 23, 26, 29)


def _span_bins(df: DataFrame, start: str, end: str, prefix: str) -> DataFrame:
    """Each span [start, end) once per bin it touches, at every level whose
    bins are at least as long as the span: two bins a level at most, however
    long the span.  ``_level`` is the lowest of these levels."""
    length = F.col(end) - F.col(start)
    own = F.lit(len(SPAN_LEVELS) - 1)
    for k in range(len(SPAN_LEVELS) - 2, -1, -1):
        own = F.when(length <= (1 << SPAN_LEVELS[k]), F.lit(k)).otherwise(own)
    shift = F.element_at(F.array(*[F.lit(x) for x in SPAN_LEVELS]), F.col("_at") + 1)
    at = df.withColumn(f"{prefix}_level", own).withColumn(
        "_at", F.explode(F.sequence(F.col(f"{prefix}_level"), F.lit(len(SPAN_LEVELS) - 1))))
    first, last = F.call_function("shiftright", F.col(start), shift), F.call_function("shiftright", F.col(end) - 1, shift)
    return at.withColumn(f"{prefix}_first", first).withColumn("_bin", F.explode(F.sequence(first, last)))


def _span_candidates(left: DataFrame, right: DataFrame, left_span: tuple[str, str, str],
                     right_span: tuple[str, str, str]) -> DataFrame:
    """The pairs that meet in a bin, before their spans are compared."""
    (lc, ls, le), (rc, rs, re_) = left_span, right_span
    a = _span_bins(left.where(F.col(ls) < F.col(le)).withColumn("_lc", normalize_contig(lc)), ls, le, "_l")
    b = _span_bins(right.where(F.col(rs) < F.col(re_)).withColumn("_rc", normalize_contig(rc)), rs, re_, "_r")
    levels = b.where("_at = _r_level").agg(F.collect_set("_r_level").alias("levels"))
    a = a.where((F.col("_at") == F.col("_l_level")) | F.array_contains(levels.scalar(), F.col("_at")))
    a = a.withColumn("_left_longer", F.col("_at") == F.col("_l_level"))
    b = b.withColumn("_right_meets", F.explode(F.when(F.col("_at") == F.col("_r_level"), F.array(F.lit(True), F.lit(False)))
                                            .otherwise(F.array(F.lit(True)))))
    a = a.withColumnRenamed("_at", "_lat").withColumnRenamed("_bin", "_lbin")
    b = b.withColumnRenamed("_at", "_rat").withColumnRenamed("_bin", "_rbin")
    return a.join(b, (F.col("_lc") == F.col("_rc")) & (F.col("_lat") == F.col("_rat")) & (F.col("_lbin") == F.col("_rbin"))
                  & (F.col("_left_longer") == F.col("_right_meets")))


def overlap_join(left: DataFrame, right: DataFrame, left_span: tuple[str, str, str], right_span: tuple[str, str, str]) -> DataFrame:
    """Pairs of rows whose half-open spans (contig, start, end columns) share
    a position, each pair once.

    A pair meets at the level of its longer span and counts in the later of
    the two spans' first bins there (the owning bin), so nothing is removed
    afterwards.  An equi-join on (contig, level, bin) and on which side is
    the longer one: where the left span is as long as the level, it meets
    right spans of its level and below, else a right span of the level meets
    left ones below.  So short spans meet in small bins alone; the bins of a
    whole chromosome hold pairs only where a span is that long.  No side is
    exploded into more than two bins a level, a chromosome-long span
    included, and a hot contig is spread by its bins.  Left spans pass only
    to levels that right spans have.  Empty spans and NULLs meet nothing.
    Column names of the two sides must differ."""
    (_, ls, le), (_, rs, re_) = left_span, right_span
    j = _span_candidates(left, right, left_span, right_span).where(
        (F.col("_lbin") == F.greatest("_l_first", "_r_first")) & (F.col(ls) < F.col(re_)) & (F.col(rs) < F.col(le)))
    return j.select(*left.columns, *right.columns)


def gene_span_variants(sites: DataFrame, genes: DataFrame) -> DataFrame:
    """Each site x every gene that its span [start_position, end_position)
    touches: deletions and reference blocks are found in all genes they cross,
    not only where they begin.  ``genes``: gene_symbol, chromosome,
    start_position and end_position, both inclusive as in the gene table."""
    g = genes.select("gene_symbol", F.col("chromosome").alias("gene_contig"), F.col("start_position").alias("gene_start"),
                     F.col("end_position").alias("gene_end"), (F.col("end_position") + 1).alias("_gene_stop"))
    out = overlap_join(sites, g, ("reference_name", "start_position", "end_position"), ("gene_contig", "gene_start", "_gene_stop"))
    return out.drop("gene_contig", "_gene_stop")


def gene_carriers(genotypes: DataFrame, site_genes: DataFrame, gene: str, key: list[str]) -> DataFrame:
    """Samples carrying a called non-reference allele at any site of ``gene``.

    ``site_genes`` maps site key -> gene_symbol (one row per site and gene).
    The gene filter runs on the annotation side before the join, so only
    that gene's sites meet the genotype table.
    """
    gs = sized_lookup(site_genes.where(F.col("gene_symbol") == gene).select(*key).distinct())
    c = genotypes.where(is_carrier("genotype")).join(gs, key, "left_semi")
    return (c.groupBy("sample_id")
            .agg(F.count(F.lit(1)).alias("carried_sites")))


def phenotype_join(genotypes: DataFrame, samples: DataFrame) -> DataFrame:
    """Calls joined to the samples' phenotype records (``inline(phenotypes)``)."""
    ph = sized_lookup(samples.select("sample_id", F.inline("phenotypes")))
    return genotypes.join(ph, "sample_id")
