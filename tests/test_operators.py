"""Operators on hand-made data: nested vs long forms, QC, federated maths,
governance, streaming rounds, plan shape."""

import pytest
from pyspark.sql import functions as F

from helixframe.operators import cohort, dashboards, federated as fd, governance as gov, normalize, qc
from helixframe.operators import summary
from helixframe.operators.joins import unnest_calls
from helixframe.sources import sam, vcf


@pytest.fixture()
def nested(spark, fx):
    return vcf.read_vcf(spark, fx("mini.vcf"))


KEY = ["reference_name", "start_position", "reference_bases", "alternate_bases"]


def test_allele_frequency_nested_equals_long(spark, nested):
    a = {(r.start_position): (r.calculated_af, r.alt_af) for r in cohort.allele_frequency(nested).collect()}
    b = {(r.start_position): (r.calculated_af, r.alt_af)
         for r in cohort.allele_frequency(unnest_calls(nested), key=KEY).collect()}
    assert a == b
    # 0/1 and 1|1: alleles = [0,1,1,1]; ones = 3 -> reference AF halves: 3 / 8
    assert a[41196312] == (3 / 8, 3 / 4)
    # ./. and 0/0: no allele 1, one called pair of zeros
    assert a[41196399] == (0.0, 0.0)


def test_variant_summary_nested_equals_long(spark, nested):
    sites = nested.drop("calls")
    s1 = summary.variant_summary_nested(nested).select("start_position", "sample_count", "alt_allele_count")
    s2 = summary.variant_summary(sites, unnest_calls(nested), key=KEY).select(*s1.columns)
    assert sorted(map(tuple, s1.collect())) == sorted(map(tuple, s2.collect()))
    r = {x.start_position: x for x in s1.collect()}
    assert r[41196312].alt_allele_count == 2 and r[41196319].alt_allele_count == 2
    assert r[41196399].alt_allele_count == 0 and r[41196312].sample_count == 2


def test_split_multiallelic_recodes(spark, nested):
    s = normalize.split_multiallelic(nested).where(F.col("start_position") == 41196319)
    rows = {r.alt_index: r for r in s.collect()}
    assert rows[1].alternate_bases == ["T"] and rows[2].alternate_bases == ["A"]
    assert rows[1].calls[0].genotype == [1, 0] and rows[2].calls[0].genotype == [0, 1]
    assert rows[1].calls[0].allele_depths == [5, 15] and rows[2].calls[0].allele_depths == [5, 10]
    # called non-ref alleles are preserved in total
    tot = normalize.split_multiallelic(nested).select(F.inline("calls")).select(
        F.aggregate("genotype", F.lit(0), lambda a, g: a + F.when(g > 0, 1).otherwise(0)).alias("n"))
    before = nested.select(F.inline("calls")).select(
        F.aggregate("genotype", F.lit(0), lambda a, g: a + F.when(g > 0, 1).otherwise(0)).alias("n"))
    assert tot.agg(F.sum("n")).first()[0] == before.agg(F.sum("n")).first()[0]


def test_contig_shard_merge_roundtrip(spark):
    rows = [(c, p) for c in ["chr1", "2", "chr7", "12", "chrX", "Y", "chrM"] for p in (5, 1)]
    df = spark.createDataFrame(rows, "reference_name string, start_position long")
    sh = normalize.contig_shard(df)
    assert sh.where(F.col("reference_name") == "chrM").count() == 0
    parts = [sh.where(F.col("shard") == s) for s, _ in __import__("helixframe.functions", fromlist=["x"]).SHARDS]
    merged = normalize.merge_shards(parts, num_partitions=3).select("reference_name", "start_position").collect()
    assert [tuple(r) for r in merged] == sorted(
        [r for r in rows if r[0] != "chrM"],
        key=lambda r: (["1", "2", "7", "12", "X", "Y"].index(r[0].replace("chr", "")), r[1]))


def test_titv_forms(spark, nested):
    t = {r.mutation_type: r["count"] for r in dashboards.titv_nested(nested).collect()}
    assert t == {"Transition": 2}   # A>G and C>T; multi-ALT, indel and symbolic excluded
    p = {r.variant_type: r["count"] for r in dashboards.titv_nested_pass(nested).collect()}
    assert p == {"Transition": 3, "Transversion": 1}


def test_flagstat_counts(spark, fx):
    f = qc.flagstat(sam.read_sam(spark, fx("mini.sam"))).first().asDict()
    assert f["total"] == 8 and f["secondary"] == 1 and f["supplementary"] == 1 and f["duplicates"] == 1
    assert f["mapped"] == 6 and f["paired"] == 4 and f["read1"] == 2 and f["read2"] == 2
    assert f["properly_paired"] == 2 and f["singletons"] == 1 and f["with_mate_mapped"] == 2
    i = {r.rname: (r.mapped, r.unmapped) for r in qc.idxstats(sam.read_sam(spark, fx("mini.sam"))).collect()}
    assert i["*"] == (0, 1) and i["chr2"] == (2, 1)
    s = qc.samstats(sam.read_sam(spark, fx("mini.sam"))).first()
    assert s.sequences == 8 and s.reads_mq0 == 1
    # qualities: 'I' = 40, '#' = 2
    n_i = 10 + 0 + 5 + 10 + 5 + 10 + 10
    n_h = 10 + 5
    assert s.average_quality == pytest.approx((40 * n_i + 2 * n_h) / (n_i + n_h))


def test_samstats_of_sequences(spark, fx):
    """The file's secondary and supplementary alignments are no sequences of their own."""
    r = sam.read_sam(spark, fx("mini.sam"))
    s, every = qc.samstats(r, primary_only=True).first(), qc.samstats(r).first()
    rest = r.where("flag & 256 <> 0 OR flag & 2048 <> 0")
    assert s.sequences == 6 and s.sequences == s.reads_mapped + s.reads_unmapped
    assert every.total_length - s.total_length == sum(len(x.seq) for x in rest.collect())


def test_qc_report_joins(spark, fx):
    r = sam.read_sam(spark, fx("mini.sam"))
    rep = qc.qc_report(qc.flagstat(r), qc.idxstats(r), qc.samstats(r)).first()
    assert rep.sample_id == "mini" and "FLAGSTAT SUMMARY" in rep.report and "chr1\t" in rep.report


def test_federated_rate_golden(spark):
    stats = spark.createDataFrame([("US", 1000, 7.1), ("EU", 1000, 5.2), ("SG", 1000, 10.8)],
                                  "node_id string, n long, rate double")
    r = fd.federated_rate(stats).first()
    assert r.federated_rate == 7.7 and r.weighted_rate == pytest.approx(7.7)


def test_fed_avg_identity_and_order_free(spark):
    rows = [("A", 0.1, 0.2, 0.3, 0.4, 0.5, 1.0, 10), ("B", 0.1, 0.2, 0.3, 0.4, 0.5, 1.0, 30)]
    schema = "node_id string, w0 double, w1 double, w2 double, w3 double, w4 double, bias double, n_samples long"
    a = fd.fed_avg(spark.createDataFrame(rows, schema)).first()
    assert [round(a[f"w{i}"], 12) for i in range(5)] == [0.1, 0.2, 0.3, 0.4, 0.5] and a.total_samples == 40
    rows2 = [("A", 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 100), ("B", 3.0, 0.0, 0.0, 0.0, 0.0, 1.0, 300)]
    x = fd.fed_avg(spark.createDataFrame(rows2, schema)).first()
    y = fd.fed_avg(spark.createDataFrame(rows2[::-1], schema)).first()
    assert x.w0 == y.w0 == 2.5 and x.bias == 0.75 and x.nodes_aggregated == ["A", "B"]


def test_fed_avg_from_weight_blobs(spark, fx):
    from helixframe.sources.logs import read_weights_json
    g = fd.fed_avg(read_weights_json(spark, fx("weights"))).first()
    assert g.total_samples == 4000 and g.w0 == pytest.approx((0.1 * 1000 + 0.5 * 3000) / 4000)
    assert g.nodes_aggregated == ["eu", "us"]


def test_local_gd_first_step_closed_form(spark):
    rows = [("N", str(i), 20 + i, i % 3, 0, 1, 20.0 + i, i % 2) for i in range(10)]
    p = spark.createDataFrame(rows, "node_id string, patient_id string, age int, variant_brca1 int, "
                                    "variant_tp53 int, variant_apoe4 int, bmi double, diagnosis_cancer int")
    out = fd.local_gd(p, epochs=1).first()
    z = fd.standardize_per_node(p).collect()
    g0 = sum((0.5 - r.diagnosis_cancer) * r.age for r in z) / len(z)
    assert out.w0 == pytest.approx(-0.01 * g0) and out.final_accuracy == 0.5
    assert out.final_loss == pytest.approx(0.6931471605599453, rel=1e-7)


def test_governance(spark, fx):
    from helixframe.sources.logs import read_audit_log
    a = read_audit_log(spark, fx("audit.jsonl"))
    assert [r.bucket for r in gov.egress_audit(a, "node-us").collect()] == ["exfil-bucket"]
    assert gov.error_log(a, r"^nf-.*").count() == 1 and gov.error_log(a).count() == 2
    rl = {r["round"]: r.complete for r in gov.round_log_check(a, 2).collect()}
    assert rl == {1: True, 2: False}
    stats = spark.createDataFrame([("US", 5), ("EU", 500)], "node_id string, n long")
    assert gov.aggregate_release(stats, ["patient_id"], min_n=10).count() == 1
    with pytest.raises(gov.ReleaseError):
        gov.aggregate_release(stats.withColumn("patient_id", F.lit("x")), ["patient_id"])
    assets = spark.createDataFrame([("US", "us-central1"), ("US", "europe-west2"), ("XX", "us-central1")],
                                   "node_id string, region string")
    pol = spark.createDataFrame([("US", "us-central1")], "node_id string, allowed_region string")
    assert gov.residency_check(assets, pol).count() == 2


def test_stream_rounds_equal_batch(spark, fx, tmp_out):
    from helixframe.streaming import rounds as R
    R.run_rounds(spark, fx("updates"), tmp_out + "/out", tmp_out + "/ckpt", num_nodes=3, timeout="1 minute",
                 broadcast_path=tmp_out + "/bcast")
    out = {r["round"]: r for r in spark.read.parquet(tmp_out + "/out").collect()}
    assert out[1].status == "complete" and out[1].n_nodes == 3 and out[1].total_samples == 500
    assert out[1].weights[0] == pytest.approx((0.1 * 100 + 0.3 * 300) / 500)  # first EU update kept
    assert out[2].status == "incomplete" and out[2].n_nodes == 1             # timed out in event time
    assert out[3].status == "complete" and out[3].n_nodes == 3               # duplicates did not fill it
    assert out[3].weights[0] == pytest.approx((1 * 50 + 3 * 150 + 1 * 50) / 250)
    batch = {r["round"]: r for r in R.round_aggregator_batch(
        spark.read.schema(R.UPDATE_WITH_ID).json(fx("updates")), 3).collect()}
    assert set(batch) == {1, 3} and batch[3].weights[0] == pytest.approx(out[3].weights[0])
    b = spark.read.json(tmp_out + "/bcast")
    assert sorted(r["round"] for r in b.collect()) == [1, 3]


def test_plans_stay_jvm_side(spark):
    import __spark_entry__ as E
    for name in ("titv", "allele_frequency", "gene_region_variants", "case_control_burden", "clinvar_join"):
        plan = E.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "CartesianProduct" not in plan, name


def test_region_filter_reaches_scan(spark, tmp_out):
    from helixframe.operators.filters import in_region
    from helixframe.sources.sinks import write_variants
    df = spark.createDataFrame([("17", i * 10, "A", ["G"], 30.0) for i in range(100)],
                               "reference_name string, start_position long, reference_bases string, "
                               "alternate_bases array<string>, quality double")
    write_variants(df, tmp_out + "/v", mode="overwrite", num_partitions=4)
    v = spark.read.parquet(tmp_out + "/v")
    q = v.where(in_region("17", 100, 200)).select("start_position")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(reference_name,17)" in plan and "GreaterThanOrE" in plan, plan
    assert "ReadSchema: struct<reference_name:string,start_position:bigint>" in plan, plan
    assert q.count() == 11


def test_sinks_and_training_paths(spark, tmp_out):
    from helixframe.sources.sinks import export_dataset, write_model_json
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    export_dataset(df, tmp_out + "/csv", "csv")
    back = spark.read.option("header", True).csv(tmp_out + "/csv")
    assert sorted(r.k for r in back.collect()) == ["a", "b"]
    export_dataset(df, tmp_out + "/js", "json")
    assert spark.read.json(tmp_out + "/js").count() == 2
    model = spark.createDataFrame([([0.1, 0.2], 0.5, 10, ["US"])],
                                  "weights array<double>, bias double, total_samples long, "
                                  "nodes_aggregated array<string>")
    write_model_json(model, tmp_out + "/model")
    assert spark.read.json(tmp_out + "/model").first().bias == 0.5
    rep = fd.fed_transfer_report(model).first()
    assert rep.volume_gain == 0.01 and rep.raw_bytes_est == 10 * 50 * 1024 and rep.weights_bytes > 0


def test_fed_train_gd_and_sgd(spark):
    rows = [(n, f"{n}-{i:03d}", 25 + (i * 7) % 50, i % 3, (i // 3) % 2, i % 2, 20.0 + i % 20, int(i % 5 == 0))
            for n in ("US", "EU") for i in range(60)]
    p = spark.createDataFrame(rows, "node_id string, patient_id string, age int, variant_brca1 int, "
                                    "variant_tp53 int, variant_apoe4 int, bmi double, diagnosis_cancer int")
    for local in ("sgd", "gd"):
        h = fd.fed_train(p, rounds=2, local=local, n_rows=20, lr=0.1).orderBy("round").collect()
        assert [r["round"] for r in h] == [1, 2] and 0.0 <= h[-1]["GLOBAL"] <= 1.0


def test_cohort_membership_list_and_manifest(spark, fx, tmp_out):
    from helixframe.operators.joins import cohort_membership, cohort_membership_list
    from helixframe.sources.flat import read_manifest
    g = unnest_calls(vcf.read_vcf(spark, fx("mini.vcf")))
    assert cohort_membership_list(g, ["NA001"]).count() == 5
    ids = spark.createDataFrame([("NA002",), ("NA002",)], "sample_id string")
    assert cohort_membership(g, ids).count() == 5       # listed twice, no duplicates
    open(tmp_out + "/m.csv", "w").write("sample_id,input_bam,node_id\nHG00119,,US\nS2,gs://b/s2.bam,EU\n")
    assert {r.sample_id: r.input_bam for r in read_manifest(spark, tmp_out + "/m.csv").collect()} == \
        {"HG00119": None, "S2": "gs://b/s2.bam"}


def test_stream_dedupe_within_watermark(spark, fx, tmp_out):
    from helixframe.streaming import rounds as R
    s = R.dedupe_updates_stream(R.updates_stream(spark, fx("updates")), watermark="1 hour")
    q = (s.writeStream.format("memory").queryName("dedup_updates").outputMode("append")
         .option("checkpointLocation", tmp_out + "/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    rows = spark.sql("SELECT round, node_id FROM dedup_updates").collect()
    assert sorted((r["round"], r.node_id) for r in rows) == [
        (1, "EU"), (1, "SG"), (1, "US"), (2, "US"), (3, "EU"), (3, "SG"), (3, "US")]


def test_flag_report_lines_and_contig_dictionary(spark, fx):
    r = sam.read_sam(spark, fx("mini.sam"))
    lines = {x.category: x for x in qc.flagstat_report(r).collect()}
    assert len(lines) == 16 and [lines[c].passed for c in ("in total", "primary", "secondary", "supplementary", "mapped")] == [8, 6, 1, 1, 6]
    assert lines["mapped"].passed_rate == 75.0 and lines["mapped"].failed_rate is None and lines["singletons"].passed == 1
    failed = qc.flagstat_report(r.withColumn("flag", F.col("flag").bitwiseOR(qc.QCFAIL)))
    assert {x.category: (x.passed, x.failed) for x in failed.collect()}["read1"] == (0, lines["read1"].passed)
    contigs = spark.createDataFrame([("mini", "chr2", 2000, 0), ("mini", "chr1", 1000, 1), ("mini", "chrM", 16, 2), ("empty", "chr1", 9, 0)],
                                    "sample_id string, contig string, length long, contig_index int")
    got = [tuple(x) for x in qc.idxstats_report(r, contigs).orderBy("sample_id", "contig_index").collect()]
    assert [(x[0], x[2], x[3]) for x in got] == [("empty", "chr1", 9), ("empty", "*", 0), ("mini", "chr2", 2000), ("mini", "chr1", 1000),
                                                 ("mini", "chrM", 16), ("mini", "*", 0)]
    assert got[2][4:] == (2, 1) and got[4][4:] == (0, 0) and got[5][4:] == (0, 1)
    h = {(x.metric, x.bin): x.reads for x in qc.read_histograms(r).collect()}
    assert h["mapq", 60] == 2 and sum(v for (m, _), v in h.items() if m == "mapq") == 6


def test_report_orders_contigs_by_each_file(spark, fx):
    r = sam.read_sam(spark, fx("mini.sam"))
    two = r.unionByName(r.withColumn("sample_id", F.lit("other")))
    order = spark.createDataFrame([("mini", "chr1", 0), ("mini", "chr2", 1), ("other", "chr2", 0), ("other", "chr1", 1)],
                                  "sample_id string, contig string, contig_index int")
    text = {x.sample_id: x.report for x in qc.qc_report(qc.flagstat(two), qc.idxstats(two), qc.samstats(two), contig_order=order).collect()}
    assert text["mini"].index("chr1\t") < text["mini"].index("chr2\t") and text["other"].index("chr2\t") < text["other"].index("chr1\t")
    assert text["mini"].count("chr1\t") == 1


def test_quality_histogram_kinds(spark, nested):
    h = qc.vcf_quality_histogram(unnest_calls(nested)).agg(F.sum("snvs"), F.sum("indels"), F.sum("others")).first()
    kinds = {"s": 0, "i": 0, "o": 0}
    for v in nested.collect():
        alts = v.alternate_bases
        plain = alts and all(set(a) <= set("ACGTN") for a in alts)
        k = "s" if plain and len(v.reference_bases) == 1 and all(len(a) == 1 for a in alts) else (
            "i" if plain and any(len(a) != len(v.reference_bases) for a in alts) else "o")
        kinds[k] += len(v.calls)
    assert tuple(h) == (kinds["s"], kinds["i"], kinds["o"]) and min(kinds.values()) > 0
