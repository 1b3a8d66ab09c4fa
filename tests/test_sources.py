"""Text sources on hand-made fixtures: VCF, flat TSV, SAM, FASTA, CSV, JSON."""

from pyspark.sql import functions as F

from helixframe.sources import fasta, flat, logs, sam, vcf


def _rows(df, key):
    return {r[key]: r for r in df.collect()}


def test_read_vcf_nested(spark, fx):
    v = vcf.read_vcf(spark, fx("mini.vcf"))
    rows = sorted(v.collect(), key=lambda r: (r.reference_name, r.start_position))
    assert len(rows) == 5
    first = [r for r in rows if r.start_position == 41196312][0]
    assert first.reference_name == "chr17" and first.end_position == 41196313
    assert first.alternate_bases == ["G"] and first.quality == 50.5 and first.filter == ["PASS"]
    c0, c1 = first.calls
    assert (c0.sample_id, c0.genotype, c0.phaseset, c0.genotype_quality, c0.read_depth, c0.allele_depths) == \
        ("NA001", [0, 1], None, 40, 20, [10, 10])
    assert (c1.sample_id, c1.genotype, c1.phaseset) == ("NA002", [1, 1], "*")
    multi = [r for r in rows if r.start_position == 41196319][0]
    assert multi.variant_id is None and multi.quality is None
    assert multi.alternate_bases == ["T", "A"] and multi.calls[0].allele_depths == [5, 15, 10]
    refcall = [r for r in rows if r.start_position == 41196399][0]
    assert refcall.filter == ["RefCall"] and refcall.calls[0].genotype == [-1, -1]
    assert refcall.end_position == 41196402 and refcall.calls[0].read_depth is None
    sym = [r for r in rows if r.start_position == 41196499][0]
    assert sym.alternate_bases == ["<DEL>"] and sym.calls[1].genotype_quality is None  # FORMAT field missing
    x = [r for r in rows if r.reference_name == "chrX"][0]
    assert x.filter == ["PASS", "LowQual"] and x.calls[0].genotype_quality is None


def test_read_vcf_long_matches_nested(spark, fx):
    from helixframe.operators.joins import unnest_calls
    lines = vcf.text_lines(spark, fx("mini.vcf"))
    long_ = vcf.parse_vcf_genotypes(lines).select("start_position", "sample_id", "genotype", "phaseset",
                                                  "genotype_quality", "read_depth", "allele_depths")
    nested = unnest_calls(vcf.parse_vcf_lines(lines)).select(*long_.columns)
    assert sorted(map(tuple, long_.collect())) == sorted(map(tuple, nested.collect()))


def test_sample_name_modes(spark, fx):
    h = vcf.read_vcf(spark, fx("mini.vcf"), names="hash").select(F.inline("calls")).select("sample_id").distinct()
    ids = [r.sample_id for r in h.collect()]
    assert len(ids) == 2 and all(len(i) == 64 for i in ids)
    n = vcf.read_vcf(spark, fx("mini.vcf"), names="none").select(F.inline("calls"))
    assert n.where(F.col("sample_id").isNotNull()).count() == 0


def test_vcf_glob_and_source_file(spark, fx):
    v = vcf.read_vcf(spark, fx("mini*.vcf"))
    files = {r.source_file.rsplit("/", 1)[-1] for r in v.select("source_file").distinct().collect()}
    assert files == {"mini.vcf", "mini2.vcf"}
    na3 = v.where(F.col("source_file").endswith("mini2.vcf")).select(F.inline("calls")).collect()
    assert [r.sample_id for r in na3] == ["NA003"]


def test_vcf_header_union_flags_conflict(spark, fx):
    u = {(r.kind, r.id): r for r in vcf.vcf_header_union(vcf.text_lines(spark, fx("mini*.vcf"))).collect()}
    assert u[("INFO", "DP")].conflict and u[("INFO", "DP")].types == ["Float", "Integer"]
    assert not u[("FORMAT", "GT")].conflict and u[("FORMAT", "GT")].files == 2
    assert u[("INFO", "AF")].files == 1 and not u[("FORMAT", "DP")].conflict


def test_vcf_to_flat(spark, fx):
    f = vcf.vcf_to_flat(vcf.text_lines(spark, fx("mini.vcf")), "HG00119").collect()
    assert len(f) == 5 and f[0].sample_id == "HG00119" and f[0].position == 41196313
    assert {r.alt for r in f} >= {"T,A", "<DEL>"}


def test_read_flat_tsv(spark, fx):
    rows = flat.read_flat_tsv(spark, fx("mini.tsv")).orderBy("position").collect()
    assert [r.chromosome for r in rows] == ["1", "X", "Y"]
    assert rows[1].quality is None and rows[1].id == "rs2" and rows[0].id is None


def test_read_patients_and_rejects(spark, fx):
    p = flat.read_patients(spark, {"US": fx("patients_us.csv"), "EU": fx("patients_eu.csv")})
    assert {(r.node_id, r.patient_id) for r in p.collect()} == {("US", "US-0001"), ("US", "US-0002"),
                                                                ("EU", "EU-0001")}
    assert flat.reject_counts(p, ["patient_id", "age"]).first().asDict() == {"null_patient_id": 0, "null_age": 0}


def test_read_sam_and_contigs(spark, fx):
    r = sam.read_sam(spark, fx("mini.sam"))
    assert r.count() == 8 and {x.sample_id for x in r.collect()} == {"mini"}
    lines = spark.read.text(fx("mini.sam")).select("value", F.col("_metadata.file_path").alias("source_file"))
    order = [x.contig for x in sam.sam_contig_order(lines).orderBy("contig_index").collect()]
    assert order == ["chr1", "chr2"]


def test_fasta_roundtrip(spark, fx, tmp_out):
    s = _rows(fasta.read_fasta(spark, fx("mini.fasta")), "name")
    assert s["seq1 first protein"].sequence == "MKTAYIAKQRQISFVKSHFS"
    assert s["seq4 empty"].sequence == ""
    fasta.write_fasta(spark.createDataFrame([("a", "MKT"), ("b", "QQ")], "name string, sequence string"),
                      tmp_out)
    back = _rows(fasta.read_fasta(spark, tmp_out), "name")
    assert back["a"].sequence == "MKT" and back["b"].sequence == "QQ"


def test_weights_json(spark, fx):
    w = _rows(logs.read_weights_json(spark, fx("weights")), "node_id")
    assert set(w) == {"us", "eu"} and w["eu"].n_samples == 3000 and len(w["us"].weights) == 5


def test_audit_log(spark, fx):
    a = logs.read_audit_log(spark, fx("audit.jsonl"))
    assert a.count() == 5 and a.where(F.col("bucket").isNull()).count() == 3


def test_manifest_paths(spark):
    m = spark.createDataFrame([("HG00119", None, "US"), ("S2", "gs://b/s2.bam", "EU")],
                              "sample_id string, input_bam string, node_id string")
    r = _rows(flat.resolve_sample_path(m, "gs://public/"), "sample_id")
    assert r["S2"].resolved_bam == "gs://b/s2.bam"
    assert r["HG00119"].resolved_bam == \
        "gs://public/bam/HG00119.mapped.ILLUMINA.bwa.GBR.low_coverage.20120522.bam"


def test_read_vcf_with_manifest_names_and_long(spark, fx):
    v = vcf.read_vcf(spark, fx("mini.vcf"), sample_names={"mini.vcf": ["S1", "S2"]}, long=True)
    assert {r.sample_id for r in v.collect()} == {"S1", "S2"} and v.count() == 10
