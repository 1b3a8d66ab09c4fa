"""Column-expression helpers (all JVM-side built-ins)."""

from .alleles import (alt_count, first_alt, genotype_string, has_allele, is_called, is_carrier,
                      is_snv, mutation_type, pass_member, variant_class)
from .contigs import (KARYOTYPE, SHARDS, contig_rank, contig_shard, is_karyotype, karyotype_index,
                      normalize_contig, shard_index)
from .numeric import dot, pct, safe_ratio, sigmoid, truncate_1dp

__all__ = [
    "alt_count", "first_alt", "genotype_string", "has_allele", "is_called", "is_carrier", "is_snv",
    "mutation_type", "pass_member", "variant_class", "KARYOTYPE", "SHARDS", "contig_shard",
    "is_karyotype", "karyotype_index", "normalize_contig", "shard_index", "dot", "pct",
    "safe_ratio", "sigmoid", "truncate_1dp",
]
