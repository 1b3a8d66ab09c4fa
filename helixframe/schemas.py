"""Declared schemas.  Inputs are always read with one of these: inference
could, for example, type ``chromosome`` as an integer for files without X/Y.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, I, B = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType(), T.BooleanType()


def _f(name, typ, nullable=True):
    return T.StructField(name, typ, nullable)


CALL = T.StructType([
    _f("sample_id", S),
    _f("genotype", T.ArrayType(L)),
    _f("phaseset", S),
    _f("genotype_quality", L),
    _f("read_depth", L),
    _f("allele_depths", T.ArrayType(L)),
])

ANNOTATION = T.StructType([_f(n, S) for n in (
    "gene_symbol", "gene_id", "transcript_id", "consequence", "impact",
    "amino_acid_change", "codon_change")])

POPULATION_FREQUENCIES = T.StructType([_f(n, D) for n in (
    "gnomad_af", "gnomad_af_nfe", "gnomad_af_afr", "gnomad_af_eas")])

# Nested site table: one row per site, calls inside.
VARIANTS = T.StructType([
    _f("reference_name", S, False),
    _f("start_position", L, False),
    _f("end_position", L, False),
    _f("reference_bases", S, False),
    _f("alternate_bases", T.ArrayType(S), False),
    _f("variant_id", S),
    _f("quality", D),
    _f("filter", T.ArrayType(S)),
    _f("calls", T.ArrayType(CALL)),
    _f("annotations", T.ArrayType(ANNOTATION)),
    _f("population_frequencies", POPULATION_FREQUENCIES),
    _f("clinical_significance", S),
    _f("source_file", S),
    _f("ingestion_timestamp", T.TimestampType()),
])

# Long (one row per site and sample) genotype table: the scalable form for
# cohort-wide aggregation; produced by ``unnest_genotypes`` or natively.
GENOTYPES = T.StructType([
    _f("reference_name", S, False),
    _f("start_position", L, False),
    _f("reference_bases", S, False),
    _f("alternate_bases", T.ArrayType(S)),
    _f("sample_id", S),
    _f("genotype", T.ArrayType(L)),
    _f("phaseset", S),
    _f("genotype_quality", L),
])

PHENOTYPE = T.StructType([_f("phenotype_id", S), _f("phenotype_name", S), _f("present", B)])

SAMPLES = T.StructType([
    _f("sample_id", S, False), _f("study_id", S), _f("population", S), _f("super_population", S),
    _f("sex", S), _f("sequencing_center", S), _f("sequencing_platform", S), _f("coverage", D),
    _f("capture_kit", S), _f("phenotypes", T.ArrayType(PHENOTYPE)), _f("disease_status", S),
    _f("disease_name", S), _f("collection_date", T.DateType()), _f("created_at", T.TimestampType()),
    _f("updated_at", T.TimestampType()),
])

GENES = T.StructType([
    _f("gene_id", S, False), _f("gene_symbol", S, False), _f("gene_name", S), _f("chromosome", S),
    _f("start_position", L), _f("end_position", L), _f("strand", S), _f("gene_type", S),
    _f("description", S), _f("omim_id", S), _f("hgnc_id", S), _f("pli_score", D),
    _f("loeuf_score", D), _f("mis_z_score", D), _f("go_terms", T.ArrayType(S)),
    _f("kegg_pathways", T.ArrayType(S)),
])

# Flat call table (seven columns; the loader variant adds a leading sample_id).
FLAT_VARIANTS = T.StructType([
    _f("chromosome", S), _f("position", L), _f("id", S), _f("ref", S), _f("alt", S),
    _f("quality", D), _f("filter", S),
])
FLAT_VARIANTS_WITH_SAMPLE = T.StructType([_f("sample_id", S)] + FLAT_VARIANTS.fields)

POPULATIONS = T.StructType([_f("sample_id", S), _f("population", S), _f("super_population", S)])

CLINVAR = T.StructType([
    _f("chromosome", S), _f("start", L), _f("reference", S), _f("alternate", S),
    _f("clinical_significance", S), _f("review_status", S), _f("phenotypes", S),
])

PATIENTS = T.StructType([
    _f("patient_id", S), _f("age", I), _f("variant_brca1", I), _f("variant_tp53", I),
    _f("variant_apoe4", I), _f("bmi", D), _f("diagnosis_cancer", I),
])

FEATURES = ["age", "variant_brca1", "variant_tp53", "variant_apoe4", "bmi"]
TARGET = "diagnosis_cancer"

NODE_WEIGHTS = T.StructType([
    _f("weights", T.ArrayType(D)), _f("bias", D), _f("n_samples", L),
    _f("final_loss", D), _f("final_accuracy", D),
])

UPDATE_MESSAGE = T.StructType([
    _f("node_id", S), _f("weights", T.ArrayType(D)), _f("bias", D), _f("n_samples", L),
    _f("round", L),
])

READS = T.StructType([
    _f("qname", S), _f("flag", L), _f("rname", S), _f("pos", L), _f("mapq", L), _f("cigar", S),
    _f("rnext", S), _f("pnext", L), _f("tlen", L), _f("seq", S), _f("qual", S),
])

AUDIT_LOG = T.StructType([
    _f("ts", T.TimestampType()), _f("project", S), _f("service", S), _f("method_name", S),
    _f("bucket", S), _f("severity", S), _f("job_name", S), _f("text_payload", S),
])

MANIFEST = T.StructType([_f("sample_id", S), _f("input_bam", S), _f("node_id", S)])
