"""Chains of links, draws without ids, the split reader, long credential runs."""

import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from helixframe.llm import components as comp
from helixframe.llm import jaccard_join, mixing, secrets_scan, warc


def union_find(edges):
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    for a, b in edges:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    return {x: root(x) for x in up}


def found(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    return {r.node: r.label for r in comp.components(df).collect()}


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    rounds = []
    grow = comp._large_star
    monkeypatch.setattr(comp, "_large_star", lambda e: rounds.append(1) or grow(e))
    ids = list(range(1000))
    random.Random(1).shuffle(ids)
    t0 = time.time()
    assert set(found(spark, list(zip(ids, ids[1:]))).values()) == {0}
    assert len(rounds) < 25 and time.time() - t0 < 60


def test_components_of_any_graph(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(-50, 300), rnd.randrange(-50, 300)) for _ in range(160)]
    edges += [(1000, k) for k in range(1001, 1100)] + [(2000 - k, 2001 - k) for k in range(70)] + edges[:9]
    want = union_find(e for e in edges if e[0] != e[1])
    assert found(spark, edges + [(5000, 5000)]) == want
    assert found(spark, []) == {}
    assert found(spark, [(7, None), (3, 7)]) == {3: 3, 7: 3}


def test_chain_of_near_copies(make):
    """Each text links with the next one only; all are one component."""
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(words[8 * k:8 * k + 100]) for k in range(38)]
    ids = list(range(38))
    random.Random(3).shuffle(ids)
    got = jaccard_join.jaccard_components(make([(i, t, "s") for i, t in zip(ids, texts)])).collect()
    sets = [set(zip(*[t.split()[j:] for j in range(5)])) for t in texts]
    links = [(ids[a], ids[b]) for a in range(38) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = union_find(links)
    assert links and {r.doc_id: r.component_id for r in got} == {i: want.get(i, i) for i in ids}


def test_ids_with_several_texts_keep_their_links(make):
    """Twenty ids, each with two unrelated texts, and a near copy of every text under an id of its own."""
    rnd = random.Random(4)
    rows, copies = [], []
    for k in range(40):
        words = [f"w{rnd.randrange(10 ** 6)}" for _ in range(60)]
        rows.append((k % 20, " ".join(words), "s"))
        copies.append((100 + k, " ".join([*words[:-1], "other"]), "s"))
    docs = make(rows + copies + [(None, rows[0][1], "s"), (None, "no id of its own but a text", "s")])
    got = jaccard_join.jaccard_components(docs).collect()
    assert {r.doc_id: r.component_id for r in got if (r.doc_id or 0) >= 100} == {100 + k: k % 20 for k in range(40)}
    assert all(r.component_id == r.doc_id for r in got if r.doc_id is not None and r.doc_id < 20)
    kept = jaccard_join.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.where("doc_id IS NOT NULL").collect()) == sorted((i, t) for i, t, _ in rows)
    assert kept.where("doc_id IS NULL").count() == 2
    # one id, two texts that link with each other: one stays
    both = [(7, rows[0][1], "s"), (7, copies[0][1], "s"), (9, rows[0][1], "s")]
    assert [r.doc_id for r in jaccard_join.drop_near_copies(make(both)).collect()] == [7]


def test_rows_without_ids_draw_apart(make):
    docs = make([(None, f"text {k}", "a") for k in range(600)] + [(7, f"same id {k}", "a") for k in range(600)])
    out = mixing.mix_sources(docs, total=1200)
    counts = [r["count"] for r in docs.join(out.select("text", "copy_no"), "text", "left").groupBy("text").agg(
        F.count("copy_no").alias("count")).collect()]
    assert len(counts) == 1200 and abs(sum(counts) - 1200) < 140
    assert len(Counter(counts)) > 3 and abs(sum(counts) / 1200 - 1) < 0.12
    twice = mixing.mix_sources(make([(None, "t", "a"), (None, "t", "a")]), total=40).count()
    assert twice % 2 == 0  # repeated rows draw alike


def test_the_reader_runs_in_several_tasks(spark, tmp_out):
    rnd = random.Random(5)
    pages = spark.createDataFrame([(k, f"u{k}", "".join(rnd.choice("abcdefgh \n") for _ in range(3000)), 1, "x") for k in range(200)],
                                  "page_id long, url string, html string, offset int, payload string")
    warc.write_warc(pages.coalesce(1), tmp_out + "/w")
    records = warc.read_warc(spark, tmp_out + "/w", range_bytes=32 << 10)
    tasks = records.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 4
    got = warc.page_records(records).orderBy("page_id").collect()
    assert [r.page_id for r in got] == list(range(200)) and {r.payload_bytes for r in got} == {3000}


def test_small_pages_are_spread(spark):
    pages = spark.range(2000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.lit("small").alias("html"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spread = warc.with_revisits(pages).select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(spread) > 1 and max(r["count"] for r in spread) < 1500


@pytest.fixture(scope="module")
def words():
    return secrets_scan.load_words(secrets_scan.RANKS)


def test_long_credential_runs_take_linear_time(words):
    def seconds(n):
        text = "secret=" * n
        t0 = time.perf_counter()
        base = secrets_scan.base_spans(text)
        assert secrets_scan.credential_spans(text, words, base) == [] and len(base) == 1
        return time.perf_counter() - t0
    seconds(1000)
    assert seconds(80_000) < 2.0


def test_contexts_that_begin_in_a_covered_value(words):
    text = "token=abcdefghijkl.auth=\"Xk9#mQ2$vL8!pR\" end"
    base = secrets_scan.base_spans(text)
    assert [(s, e) for s, _, e in base] == [(0, 24)]
    more = secrets_scan.credential_spans(text, words, base)
    assert [text[s:e] for s, _, e in more] == ["Xk9#mQ2$vL8!pR"]
