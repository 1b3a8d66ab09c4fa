"""Landing of mixed files, tables behind snapshots, release lineage, ordered merge, profiles in two scans."""

import os

import pytest
from pyspark.sql import Window, functions as F

from helixframe.operators import features, governance as gov, normalize
from helixframe.operators.lineage import column_sources
from helixframe.sources import snapshots as S
from helixframe.streaming import ingest as I


@pytest.fixture()
def patients(spark):
    return spark.createDataFrame([("p1", "US", 40, 10), ("p2", "US", 50, 20), ("p3", "EU", 60, 30)],
                                 "patient_id string, node_id string, age int, n int")


def test_release_refuses_patient_columns_in_any_form(spark, patients):
    refused = [
        patients.withColumnRenamed("patient_id", "x").select("x"),
        patients.select(F.concat(F.lit("id-"), F.upper("patient_id")).alias("label"), "n"),
        patients.select("node_id", F.sha2("patient_id", 256).alias("code")).distinct(),
        patients.groupBy("node_id").agg(F.max("patient_id").alias("latest")),
        patients.groupBy("node_id").agg(F.collect_list("patient_id").alias("members")),
        patients.groupBy(F.col("patient_id").alias("k")).agg(F.count("*").alias("n")).select("n"),
        patients.select("node_id", F.lit(1).alias("v")).union(patients.select("patient_id", "n")),
        patients.select(F.explode(F.array("patient_id")).alias("e")),
        patients.select("node_id", F.max("patient_id").over(Window.partitionBy("node_id")).alias("m")),
    ]
    patients.createOrReplaceTempView("pt")
    refused.append(spark.sql("WITH a AS (SELECT patient_id AS b FROM pt) SELECT x.b AS c FROM a x JOIN a y ON x.b = y.b"))
    refused.append(spark.sql("SELECT node_id, (SELECT min(patient_id) FROM pt) AS d FROM pt"))
    for df in refused:
        with pytest.raises(gov.ReleaseError):
            gov.aggregate_release(df, ["Patient_ID"])


def test_release_lets_blended_values_pass(spark, patients):
    per_patient = patients.groupBy("node_id", "patient_id").agg(F.sum("n").alias("k"))
    for df in (patients.groupBy("node_id").agg(F.count_distinct("patient_id").alias("n"), F.avg("age").alias("a")),
               per_patient.groupBy("node_id").agg(F.avg("k").alias("k"), F.count("*").alias("n")),
               patients.where("patient_id <> 'p1'").groupBy("node_id").agg(F.count("*").alias("n"))):
        assert gov.aggregate_release(df, ["patient_id"], min_n=1).count() == 2
    assert gov.aggregate_release(df, ["patient_id"], min_n=2).count() == 0
    with pytest.raises(gov.ReleaseError):  # no count to hold against the cell size
        gov.aggregate_release(patients.groupBy("node_id").agg(F.avg("age").alias("a")), ["patient_id"], min_n=2)
    assert column_sources(patients.select((F.col("age") + F.col("n")).alias("s")))["s"] == {"age", "n"}


def test_erase_rewrites_only_files_with_a_requested_row(spark, tmp_out):
    path = os.path.join(tmp_out, "t")
    df = spark.range(1000).select(F.when(F.col("id") != 500, F.col("id")).alias("patient_id"),
                                  (F.col("id") % 7).alias("v"))
    assert S.write_table(df, path, ["patient_id"], 4) == 1
    first = set(S.snapshot_files(spark, path))
    assert len(first) == 4
    ids = spark.createDataFrame([(3,), (4,), (3,), (None,), (5000,)], "patient_id long")
    assert gov.erase_from_table(spark, path, ids, purge=False) == 2
    assert S.read_table(spark, path, 1).count() == 1000      # the old version still stands
    now = S.read_table(spark, path)
    assert now.count() == 998 and now.where("patient_id IN (3, 4)").count() == 0
    assert now.where("patient_id IS NULL").count() == 1      # no id, not asked for
    kept = set(S.snapshot_files(spark, path)) & first
    assert len(kept) == 3
    assert S.purge(spark, path) == 1 and S.versions(spark, path) == [2]
    assert S.read_table(spark, path).count() == 998
    (dead,) = first - kept
    assert not os.path.exists(dead.removeprefix("file://"))
    # nothing asked for is held: no new version
    assert gov.erase_from_table(spark, path, ids) == 2
    # all rows of a table
    assert gov.erase_from_table(spark, path, now.select("patient_id")) == 3
    assert S.read_table(spark, path).count() == 1
    with pytest.raises(S.SnapshotConflict):
        S._publish(spark, path, "again", [], 3)


def test_merge_has_one_order(spark):
    rows = [("chr2", 5, "A"), (None, 1, "A"), ("chrM", 3, "C"), ("GL2", 1, "A"), ("GL1", 9, "A"), ("10", 1, "T"),
            ("2", 5, "A"), ("X", 1, "G"), ("chr2", 4, "G"), ("Y", 0, "G")]
    df = spark.createDataFrame(rows, "reference_name string, start_position long, ref string")
    out = normalize.merge_ordered(df, ["ref", "reference_name"], num_partitions=3).orderBy("merge_position").collect()
    assert [r.merge_position for r in out] == list(range(1, 11))
    assert [(r.reference_name, r.start_position) for r in out] == [
        ("chr2", 4), ("2", 5), ("chr2", 5), ("10", 1), ("X", 1), ("Y", 0), ("chrM", 3), ("GL1", 9), ("GL2", 1), (None, 1)]
    assert normalize.merge_ordered(df.limit(0), ["ref"]).count() == 0


def test_profiles_in_two_scans(spark, tmp_out):
    rows = [("SNP", 1.0, 1), ("SNP", 2.0, 1), ("DEL", None, 3), (None, 9.0, 5)]
    spark.createDataFrame(rows, "variant_type string, quality double, ref_length int").write.parquet(tmp_out + "/f")
    f = spark.read.parquet(tmp_out + "/f")
    out = features.feature_profiles(f, 4, 2)
    got = {(r.profile, r.label, r.bin): (r.lower_edge, r["count"]) for r in out.collect()}
    assert got == {("variant_type", "SNP", None): (None, 2), ("variant_type", "DEL", None): (None, 1),
                   ("variant_type", None, None): (None, 1), ("quality", None, 0): (1.0, 2), ("quality", None, 3): (7.0, 1),
                   ("ref_length", None, 0): (1.0, 2), ("ref_length", None, 1): (3.0, 2)}
    plan = out._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert plan.split("== Physical Plan ==")[-1].count("\nLocation: ") == 2
    assert features.feature_profiles(f.limit(0), 4, 2).count() == 0


VCF = ["##fileformat=VCFv4.2", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2",
       "1\t10\trs1\tA\tT,C\t30.5\tPASS\t.\tGT\t0/1\t1/1", "1\t11\t.\tG\t.\t.\t.\t.\tGT\t0/0\t./."]
SITES = ["#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO", "2\t7\t.\tC\tG\t9\tq10\t."]
TSV = ["sample_id\tchromosome\tposition\tid\tref\talt\tquality\tfilter", "s9\t1\t10\t.\tA\tT\t.\tPASS"]


def _land(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_landing_of_both_kinds_and_replay(spark, tmp_out):
    land, out = f"{tmp_out}/land", f"{tmp_out}/out"
    _land(land, "a.vcf", VCF)
    _land(land, "b.tsv", TSV)
    I.stream_ingest_landing(spark, land, out, f"{tmp_out}/ck")
    rows = {tuple(r)[:8] for r in I.read_landed(spark, out).select(
        "sample_id", "chromosome", "position", "id", "ref", "alt", "quality", "filter").collect()}
    assert rows == {("s1", "1", 10, "rs1", "A", "T,C", 30.5, "PASS"), ("s2", "1", 10, "rs1", "A", "T,C", 30.5, "PASS"),
                    ("s1", "1", 11, None, "G", None, None, None), ("s2", "1", 11, None, "G", None, None, None),
                    ("s9", "1", 10, None, "A", "T", None, "PASS")}
    _land(land, "c.vcf", SITES)
    _land(land + "/deep", "d.tsv", TSV[:1])     # a header alone
    I.stream_ingest_landing(spark, land, out, f"{tmp_out}/ck", max_files_per_trigger=1)
    assert I.read_landed(spark, out).count() == 6
    assert I.read_landed(spark, out).where("sample_id IS NULL").select("chromosome", "quality").collect() == [("2", 9.0)]
    # the checkpoint is lost: every file comes again
    I.stream_ingest_landing(spark, land, out, f"{tmp_out}/ck2")
    assert I.read_landed(spark, out).count() == 6
    assert I.committed_files(spark, out).count() == 4
    # a trigger that died between its rows and its commit
    (I.read_landed(spark, out).drop("load").write.partitionBy("chromosome").parquet(f"{out}/data/load=dead"))
    assert I.read_landed(spark, out).count() == 6


def test_nothing_landed_yet(spark, tmp_out):
    assert I.read_landed(spark, tmp_out + "/none").count() == 0
