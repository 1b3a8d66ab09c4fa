"""Steps whose cost must not grow faster than the input: what the plans hold,
and how many rows pass, on small inputs."""

import pytest
from pyspark.sql import functions as F

from helixframe.operators import joins
from helixframe.sources import vcf

LINES = [("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2", "a"), ("##fileformat=VCFv4.2", "b"),
         ("1\t5\t.\tA\tG\t9\tPASS\t.\tGT:GQ\t0/1:9\t1|2:.", "a"), ("1\t6\t.\tA\tG\t9\tPASS\t.\tGQ:GT\t4:1\t.", "a"),
         ("1\t7\t.\tA\tG\t9\tPASS\t.", "b")]


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame(LINES, "value string, source_file string")


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_calls_are_parsed_once(lines):
    """No filter on the number of calls before they are exploded, and the
    FORMAT column is not split within the lambdas that run for every call."""
    x = joins.unnest_calls(vcf.parse_vcf_lines(lines))
    plan = _optimized(x).split("\n")
    assert not any("Filter" in line and "size(" in line for line in plan)
    assert not any("lambdafunction" in line and "[8]" in line for line in plan)
    got = {(r.start_position, r.sample_index): (r.sample_id, r.genotype, r.phaseset, r.genotype_quality) for r in x.collect()}
    assert got == {(4, 0): ("S1", [0, 1], None, 9), (4, 1): ("S2", [1, 2], "*", None),
                   (5, 0): ("S1", [1], None, 4), (5, 1): ("S2", None, None, None)}


@pytest.mark.parametrize("n", [200, 2000])
def test_short_spans_do_not_meet_in_chromosome_bins(spark, n):
    """Spans in a row on one contig: what the join compares grows with n, not with its square."""
    ids = spark.range(n)
    left = ids.select(F.col("id").alias("i"), F.lit("1").alias("c"), (F.col("id") * 9000).alias("s"), (F.col("id") * 9000 + 5).alias("e"))
    right = ids.select(F.col("id").alias("j"), F.lit("chr1").alias("d"), (F.col("id") * 9000 + 2).alias("t"), (F.col("id") * 9000 + 7).alias("f"))
    met = joins.overlap_join(left, right, ("c", "s", "e"), ("d", "t", "f"))
    assert sorted((r.i, r.j) for r in met.collect()) == [(k, k) for k in range(n)]
    assert joins._span_candidates(left, right, ("c", "s", "e"), ("d", "t", "f")).count() <= 4 * n


def test_repeated_updates_are_dropped_in_linear_time():
    """Few different rows: one frame at the end.  Many: passed on in pieces, none held for long."""
    import pandas as pd

    from helixframe.streaming.rounds import reduce_batches

    seen = []

    def reduce(x):
        seen.append(len(x))
        return x.drop_duplicates("k")

    def batches(keys):
        return (pd.DataFrame({"k": keys[i:i + 10]}) for i in range(0, len(keys), 10))
    few = list(reduce_batches(batches([i % 7 for i in range(1000)]), reduce, rows=100))
    assert [sorted(x["k"]) for x in few] == [list(range(7))] and max(seen) <= 110
    seen.clear()
    many = list(reduce_batches(batches(list(range(5000))), reduce, rows=100))
    assert sorted(k for x in many for k in x["k"]) == list(range(5000))
    assert max(seen) <= 110 and sum(seen) <= 2 * 5000


def test_rounds_of_a_block_keep_their_own_timers():
    """One block: a complete round, one that runs out while another gets news, and one that waits on."""
    import json

    import pandas as pd

    from helixframe.streaming import rounds as R

    class State:
        raw, watermark, timer = None, 0, None
        exists = property(lambda self: self.raw is not None)
        get = property(lambda self: (self.raw,))
        getCurrentWatermarkMs = lambda self: self.watermark

        def update(self, value):
            self.raw = value[0]

        def remove(self):
            self.raw = None

        def setTimeoutTimestamp(self, ms):
            self.timer = ms

    def news(*rows):
        return pd.DataFrame([{"round": r, "node_id": n, "event_id": e, "n_samples": 10, "weights": [1.0], "bias": 0.0,
                              "ts": pd.Timestamp(ms, unit="ms")} for r, n, e, ms in rows])
    state, fn = State(), R._round_fn(2, 1000)

    def call(*pdfs):
        return [(r.round, r.status, r.n_nodes) for x in fn((0,), iter(pdfs), state) for r in x.itertuples()]
    assert call(news((1, "A", 1, 5000), (2, "A", 2, 6000), (1, "B", 3, 5000)), news((3, "A", 4, 9000))) == [(1, "complete", 2)]
    assert state.timer == 6000 and set(json.loads(state.raw)) == {"1", "2", "3"}
    state.watermark = 7500
    assert call(news((3, "A", 9, 9500), (3, "A", 8, 9400))) == [(2, "incomplete", 1)]
    assert state.timer == 10500 and set(json.loads(state.raw)) == {"3"}
    state.watermark = 10501
    assert call() == [(3, "incomplete", 1)] and state.raw is None


def test_hub_state_by_blocks_follows_the_rules():
    """Random updates of 400 rounds in four batches: the rows are those of the
    rules over all updates at once, and the state has an entry for 64 rounds."""
    import random

    import pandas as pd

    from helixframe.streaming import hub as H

    class Value:
        value = None
        exists = lambda self: self.value is not None
        get = lambda self: self.value

        def update(self, value):
            self.value = value

    class Map(dict):
        getValue, updateValue = dict.__getitem__, dict.__setitem__
        keys = lambda self: iter(list(dict.keys(self)))

        def removeKey(self, key):
            del self[key]

    class Handle:
        def __init__(self):
            self.value, self.map, self.timers = Value(), Map(), set()
            self.getValueState = lambda *_: self.value
            self.getMapState = lambda *_: self.map
            self.registerTimer, self.deleteTimer = self.timers.add, self.timers.discard

    class Times:
        def __init__(self, ms):
            self.getCurrentWatermarkInMs = lambda: ms
    rnd, handle = random.Random(7), Handle()
    processor = H.HubProcessor(2, 1000, 0)
    processor.init(handle)
    rules, sizes = H.Hub(2, 1000, 0, {}), []
    for batch, watermark in enumerate((0, 3000, 9000, 20_000)):
        rows = [(rnd.randrange(400), rnd.choice("ABC"), batch * 1000 + k, rnd.randrange(1, 9), [rnd.random()], 0.5,
                 rnd.randrange(1, 12_000)) for k in range(700)]
        shuffled = pd.DataFrame(rnd.sample(rows, len(rows)), columns=["round", "node_id", "event_id", "n_samples", "weights", "bias", "ts"])
        shuffled["ts"] = pd.to_datetime(shuffled["ts"], unit="ms")
        out = pd.concat([pd.DataFrame(columns=["round", "status"]), *processor.handleInputRows(
            ("x",), iter([shuffled[:300], shuffled[300:]]), Times(watermark))])
        rules.take([r[0] for r in rows], [r[1] for r in rows], [[r[2], r[3], r[4], r[5], r[6]] for r in rows])
        want = [H._row("x", *x) for x in rules.close(watermark)]
        got = out[out["status"] != "open"][list(want[0])].to_dict("records") if want else []
        assert [(g["round"], g["status"], g["total_samples"], g["nodes_aggregated"]) for g in got] == [
            (w["round"], w["status"], w["total_samples"], w["nodes_aggregated"]) for w in want]
        due = rules.next_deadline()
        assert handle.value.value == (rules.expected, -1 if due is None else due) and (due is None or due in handle.timers)
        sizes.append(len(handle.map))
    assert 0 < max(sizes) <= 7 and rules.expected > 0


def test_shards_are_written_once(spark):
    """What computes the rows is not in the shards' plans any more; an empty shard stays empty."""
    from helixframe.operators import normalize

    sites = spark.createDataFrame([("1", 5), ("X", 3), ("2", 9), ("1", 5)], "reference_name string, start_position long").distinct()
    names = ["chr1-5", "chr6-10", "chr16-Y"]
    parts = normalize.write_shards(normalize.contig_shard(sites), names)
    assert [sorted(r.reference_name for r in p.collect()) for p in parts] == [["1", "2"], [], ["X"]]
    merged = normalize.merge_shards(parts)
    assert "Aggregate" not in _optimized(merged)
    assert [(r.reference_name, r.start_position) for r in merged.collect()] == [("1", 5), ("2", 9), ("X", 3)]


@pytest.mark.parametrize("names", ["keep", "hash"])
def test_a_header_row_is_shuffled_once(spark, lines, monkeypatch, names):
    """By the shuffle join, too, a file's header row is one row, not one for each of many keys."""
    monkeypatch.setattr(vcf, "HEADER_BROADCAST_BYTES", 0)
    x = vcf.data_with_names(lines, names)
    plan = _optimized(x)
    assert "Generate" not in plan and "Join LeftOuter" in plan and "broadcast" not in plan
    assert sorted((r.source_file, len(r["_sample_names"] or [])) for r in x.collect()) == [("a", 2), ("a", 2), ("b", 0)]


def test_no_names_need_no_header(lines):
    x = vcf.parse_vcf_genotypes(lines, names="none")
    assert "Join" not in _optimized(x)
    assert sorted((r.start_position, r.sample_index, r.sample_id, r.genotype_quality) for r in x.collect()) == [
        (4, 0, None, 9), (4, 1, None, None), (5, 0, None, 4), (5, 1, None, None)]


def test_rendered_lines_are_landed_as_columns(spark):
    """VCF text comes back from compressed files that a reader can prune, not from rows in Spark's own form."""
    from helixframe.plans import proxy
    from helixframe.sources.tables import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    for text in (proxy.vcf_text(t), proxy.vcf_multi_text(t)):
        plan = text.where(F.col("value").startswith("#CHROM"))._jdf.queryExecution().executedPlan().toString()
        assert "FileScan parquet" in plan and "StringStartsWith(value,#CHROM)" in plan


def test_landed_lines_are_not_shuffled_by_file(spark, lines, tmp_out):
    from helixframe.streaming import ingest

    spark.createDataFrame([("b", "x")], "source_file string, load string").write.parquet(f"{tmp_out}/commits")
    new, kept = ingest._new_lines(lines, tmp_out)
    assert [r.source_file for r in new.collect()] == ["a"] and {r.source_file for r in kept.collect()} == {"a"}
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_multi_sample_rendering_is_compiled(spark, monkeypatch):
    """HotSpot leaves methods over 8,000 bytes to its interpreter."""
    import re

    from helixframe.plans import proxy
    from helixframe.sources.tables import Tables

    monkeypatch.setattr(proxy, "_landed", lambda frame, name: frame)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = proxy.vcf_multi_text(Tables(spark, "/root/testdata/sf0.001"))
        code = spark._jvm.PythonSQLUtils.explainString(text._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert len(sizes) > 3 and max(sizes) < 8000
