"""Spans: the overlap join against all pairs, INFO END, typed INFO, header joins."""

import random

import pytest
from pyspark.sql import functions as F

from helixframe.operators import filters, joins
from helixframe.sources import vcf

LINES = [
    ("##fileformat=VCFv4.2", "a"), ("##fileformat=VCFv4.2", "b"),
    ('##INFO=<ID=DP,Number=1,Type=Integer,Description="x">', "a"), ('##INFO=<ID=DP,Number=1,Type=Integer,Description="x">', "b"),
    ('##INFO=<ID=AF,Number=A,Type=Float,Description="x">', "a"), ('##INFO=<ID=DB,Number=0,Type=Flag,Description="x">', "a"),
    ('##INFO=<ID=T,Number=1,Type=Integer,Description="x">', "a"), ('##INFO=<ID=T,Number=1,Type=String,Description="x">', "b"),
    ('##INFO=<ID=N,Number=1,Type=String,Description="x">', "a"),
    ("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2\tS3", "a"),
    ("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS9", "b"),
    ("17\t100\t.\tA\tG,T\t50\tPASS\tDP=7;AF=0.25,.;DB;T=1;N=x,y;U=q\tGT:GQ\t0/1:9\t1|2:8\t./.", "a"),
    ("17\t200\t.\tC\t<NON_REF>\t.\t.\tEND=450\tGQ:GT\t5:0/0\t.:./.\t3:0/0", "a"),
    ("17\t300\t.\tGAT\t<DEL>\t9\tPASS\tSVTYPE=DEL;END=900;BEND=7\tGT:DP:GQ\t0/1:4:1\t0/0:.:2\t1", "a"),
    ("chr17\t500\t.\tGAT\tG\t9\tPASS\tT=abc;END=x\tGT\t1/1", "b"),
]


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame(LINES, "value string, source_file string")


@pytest.fixture()
def forced(monkeypatch):
    return lambda n: monkeypatch.setattr(vcf, "HEADER_BROADCAST_BYTES", n)


@pytest.mark.parametrize("most", [1 << 20, 0])
def test_several_samples_and_formats(lines, forced, most):
    forced(most)
    v = {r.start_position: r for r in vcf.parse_vcf_lines(lines).collect()}
    assert [(c.sample_id, c.genotype, c.genotype_quality) for c in v[99].calls] == [
        ("S1", [0, 1], 9), ("S2", [1, 2], 8), ("S3", [-1, -1], None)]
    assert [(c.genotype, c.genotype_quality) for c in v[199].calls] == [([0, 0], 5), ([-1, -1], None), ([0, 0], 3)]
    assert [(c.genotype, c.read_depth, c.genotype_quality) for c in v[299].calls] == [
        ([0, 1], 4, 1), ([0, 0], None, 2), ([1], None, None)]
    assert {k: r.end_position for k, r in v.items()} == {99: 100, 199: 450, 299: 900, 499: 502}
    assert v[499].calls[0].sample_id == "S9"
    long = vcf.parse_vcf_genotypes(lines)
    assert {(r.sample_id, r.sample_index) for r in long.collect()} == {("S1", 0), ("S2", 1), ("S3", 2), ("S9", 0)}


def test_small_headers_shuffle_no_line(lines):
    plan = vcf.parse_vcf_lines(lines)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


def test_info_by_declared_types(lines):
    d = vcf.info_definitions(lines)
    assert {r.id: (r.number, r.type) for r in d.collect()} == {
        "DP": ("1", "Integer"), "AF": ("A", "Float"), "DB": ("0", "Flag"), "T": (".", "String"), "N": ("1", "String")}
    got = vcf.info_values(vcf.parse_vcf_lines(lines), d, ["start_position"]).collect()
    rows = {(r.start_position, r.info_id, r.value_index): (r.type, r.int_value, r.float_value, r.string_value, r.flag) for r in got}
    assert rows[99, "DP", 0] == ("Integer", 7, None, None, False)
    assert rows[99, "AF", 0] == ("Float", None, 0.25, None, False) and rows[99, "AF", 1] == ("Float", None, None, None, False)
    assert rows[99, "DB", 0] == ("Flag", None, None, None, True)
    assert rows[99, "N", 0] == ("String", None, None, "x,y", False) and rows[99, "U", 0][3] == "q"
    assert rows[99, "T", 0][3] == "1" and rows[499, "T", 0][3] == "abc" and rows[499, "END", 0][3] == "x"
    assert rows[299, "BEND", 0][3] == "7" and len(rows) == len(got)


def test_overlap_join_is_all_pairs_that_overlap(spark):
    rnd = random.Random(4)

    def spans(n):
        out = []
        for k in range(n):
            start = rnd.randrange(0, 3 << 20)
            out.append((k, rnd.choice(["1", "chr1", "X"]), start, start + rnd.choice([0, 1, 3, 1 << 14, (1 << 14) + 1, 1 << 17, 1 << 21, 1 << 30])))
        return out
    a, b = spans(150), spans(120)
    left = spark.createDataFrame(a, "i long, c string, s long, e long")
    right = spark.createDataFrame(b + [(None, "1", None, 5)], "j long, d string, t long, f long")
    got = [(r.i, r.j) for r in joins.overlap_join(left, right, ("c", "s", "e"), ("d", "t", "f")).collect()]
    bare = lambda c: c.replace("chr", "")
    want = [(x[0], y[0]) for x in a for y in b if bare(x[1]) == bare(y[1]) and x[2] < x[3] and y[2] < y[3] and x[2] < y[3] and y[2] < x[3]]
    assert len(want) > 500 and sorted(got) == sorted(want)


def test_a_long_span_is_few_rows(spark):
    one = spark.createDataFrame([(0, "1", 5, 1 << 29)], "i long, c string, s long, e long")
    assert joins._span_bins(one, "s", "e", "_l").count() <= 2
    point = spark.createDataFrame([(0, "1", 16383, 16385)], "i long, c string, s long, e long")
    assert joins._span_bins(point, "s", "e", "_l").count() <= 2 * len(joins.SPAN_LEVELS)


def test_regions_find_what_reaches_in(spark, lines, tmp_out):
    v = vcf.parse_vcf_lines(lines)
    at = lambda lo, hi: [r.start_position for r in filters.region_overlaps(v, "chr17", lo, hi).collect()]
    assert at(449, 449) == [199, 299] and at(450, 450) == [299] and at(501, 800) == [299, 499] and at(902, 950) == []
    v.select("reference_name", "start_position", "end_position").write.parquet(tmp_out + "/v")
    plan = spark.read.parquet(tmp_out + "/v").where(filters.overlaps_region("17", 5, 9))._jdf.queryExecution().executedPlan().toString()
    assert "In(reference_name, [17,chr17])" in plan and "LessThanOrEq" in plan[plan.index("PushedFilters"):]


def test_genes_crossed_by_a_deletion(spark, lines):
    genes = spark.createDataFrame([("A", "17", 440, 445), ("B", "17", 600, 700), ("C", "17", 902, 999), ("D", "18", 0, 10**6)],
                                  "gene_symbol string, chromosome string, start_position long, end_position long")
    got = joins.gene_span_variants(vcf.parse_vcf_lines(lines).drop("calls"), genes)
    assert sorted((r.gene_symbol, r.start_position) for r in got.select("gene_symbol", F.col("start_position")).collect()) == [
        ("A", 199), ("A", 299), ("B", 299)]
