"""Allele / site column expressions (REF, ALT, FILTER, genotype arrays)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The four transition pairs (purine<->purine, pyrimidine<->pyrimidine).
TRANSITIONS = [("A", "G"), ("G", "A"), ("C", "T"), ("T", "C")]


def first_alt(alts="alternate_bases") -> Column:
    """First alternate allele; NULL for an empty or NULL array (ANSI-safe)."""
    return F.get(_c(alts), 0)


def alt_count(alts="alternate_bases") -> Column:
    """Number of ALT alleles; 0 for NULL (``size(NULL)`` is NULL on 4.x)."""
    return F.coalesce(F.size(_c(alts)), F.lit(0))


def pass_member(filt="filter") -> Column:
    """``'PASS' IN UNNEST(filter)`` for array filters, ``= 'PASS'`` for strings."""
    return F.array_contains(_c(filt), "PASS")


def mutation_type(ref, alt) -> Column:
    """'Transition' for the four purine/pyrimidine-preserving pairs, else
    'Transversion' (including N, * and indels when no length filter applies)."""
    r, a = _c(ref), _c(alt)
    cond = None
    for x, y in TRANSITIONS:
        term = (r == x) & (a == y)
        cond = term if cond is None else (cond | term)
    return F.when(cond, F.lit("Transition")).otherwise(F.lit("Transversion"))


def is_snv(ref, alt) -> Column:
    return (F.length(_c(ref)) == 1) & (F.length(_c(alt)) == 1)


def variant_class(ref, alt) -> Column:
    """SNP when lengths are equal (MNPs included), DEL when REF longer, else INS."""
    lr, la = F.length(_c(ref)), F.length(_c(alt))
    return (F.when(lr == la, F.lit("SNP")).when(lr > la, F.lit("DEL")).otherwise(F.lit("INS")))


def has_allele(genotype, allele: int) -> Column:
    """``allele IN UNNEST(genotype)``."""
    return F.exists(_c(genotype), lambda g: g == F.lit(allele))


def is_carrier(genotype) -> Column:
    """Any called non-reference allele."""
    return F.exists(_c(genotype), lambda g: g > 0)


def is_called(genotype) -> Column:
    """At least one allele called (no-call is -1 or NULL)."""
    return F.exists(_c(genotype), lambda g: g >= 0)


def _allele_text(a: Column) -> Column:
    return F.when(a < 0, F.lit(".")).otherwise(a.cast("string"))


def genotype_string(genotype, phased=None) -> Column:
    """``[0,1]`` -> ``0/1`` (``0|1`` when phased); -1 -> ``.``.

    Diploid calls take a lambda-free path (stays in generated code); other
    ploidies fall back to ``transform``."""
    g = _c(genotype)
    sep = F.lit("/") if phased is None else F.when(_c(phased), F.lit("|")).otherwise(F.lit("/"))
    diploid = F.concat(_allele_text(F.get(g, 0)), sep, _allele_text(F.get(g, 1)))
    other = F.array_join(F.transform(g, _allele_text), "/")
    if phased is not None:
        other = F.when(_c(phased), F.array_join(F.transform(g, _allele_text), "|")).otherwise(other)
    return F.when(F.size(g) == 2, diploid).otherwise(other)
