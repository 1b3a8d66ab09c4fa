"""Minibatch descent and the hub's loop on hand-made patients."""

import hashlib
import json
import math

import pytest
from pyspark.sql import functions as F

from helixframe.operators import federated as fd
from helixframe.schemas import FEATURES

SCHEMA = ("node_id string, patient_id string, age int, variant_brca1 int, variant_tp53 int, variant_apoe4 int, "
          "bmi double, diagnosis_cancer int")


def patients(spark, sizes):
    rows = [(n, f"{n}-{i:03d}", 25 + (i * 7) % 50, i % 3, (i // 3) % 2, i % 2, 20.0 + i % 20, int(i % 5 == 0))
            for n, k in sizes.items() for i in range(k)]
    return spark.createDataFrame(rows, SCHEMA), rows


def by_hand(rows, epochs, size, lr, seed):
    w, b, steps = [0.0] * 5, 0.0, 0
    for e in range(1, epochs + 1):
        order = sorted(rows, key=lambda r: (hashlib.md5(f"{seed}:{e}:{r[1]}".encode()).hexdigest(), r[1]))
        loss, hits = 0.0, 0
        for lo in range(0, len(order), size):
            batch = order[lo:lo + size]
            p = [1 / (1 + math.exp(-(b + sum(w[i] * r[2 + i] for i in range(5))))) for r in batch]
            err = [q - r[7] for q, r in zip(p, batch)]
            loss -= sum(math.log(q + 1e-8) if r[7] else math.log(1 - q + 1e-8) for q, r in zip(p, batch))
            hits += sum((q > 0.5) == (r[7] == 1) for q, r in zip(p, batch))
            w = [w[i] - lr * sum(x * r[2 + i] for x, r in zip(err, batch)) / len(batch) for i in range(5)]
            b -= lr * sum(err) / len(batch)
            steps += 1
    return w, b, steps, loss / len(rows), hits / len(rows)


@pytest.mark.parametrize("size", [1, 7, 32, 500])
def test_minibatch_steps(spark, size):
    p, rows = patients(spark, {"A": 70, "B": 33, "C": 1})
    got = {r.node_id: r for r in fd.local_minibatch(p, epochs=3, batch_size=size, lr=0.001, standardize=False).collect()}
    assert set(got) == {"A", "B", "C"}
    for n, r in got.items():
        w, b, steps, loss, hits = by_hand([x for x in rows if x[0] == n], 3, size, 0.001, 17)
        assert [r[f"w{i}"] for i in range(5)] == pytest.approx(w, rel=1e-9, abs=1e-12)
        assert (r.bias, r.final_loss, r.final_accuracy) == pytest.approx((b, loss, hits), rel=1e-9)
        assert (r.steps, r.n_samples) == (steps, sum(x[0] == n for x in rows))


def test_minibatch_does_not_hang_on_partitions(spark):
    p, _ = patients(spark, {"A": 90, "B": 50})
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")  # batches of rows cut across steps
    try:
        small = sorted(fd.local_minibatch(p.repartition(7), epochs=2, standardize=False).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert small == sorted(fd.local_minibatch(p.coalesce(1), epochs=2, standardize=False).collect())
    assert fd.local_minibatch(p.limit(0)).collect() == []
    holes = p.withColumn("bmi", F.when(F.col("patient_id") != "A-000", F.col("bmi")))
    assert {r.node_id: r.n_samples for r in fd.local_minibatch(holes, standardize=False).collect()} == {"A": 89, "B": 50}


def test_full_batches_are_the_full_gradient(spark):
    p, _ = patients(spark, {"A": 40})
    a, b = fd.local_minibatch(p, epochs=3, batch_size=40).first(), fd.local_gd(p, epochs=3).first()
    assert [a[f"w{i}"] for i in range(5)] == pytest.approx([b[f"w{i}"] for i in range(5)], rel=1e-9)


def test_hub_loop_publishes_each_round(spark, tmp_out):
    p, rows = patients(spark, {"US": 60, "EU": 30})
    h = fd.fed_train(p, rounds=4, n_rows=20, lr=0.1, path=tmp_out + "/models").orderBy("round").collect()
    published = {r["round"]: r for r in spark.read.json(tmp_out + "/models").collect()}
    assert sorted(published) == [1, 2, 3, 4, 5] and published[1].weights == [fd.INIT_WEIGHT] * 5
    for r in h:
        assert published[r["round"] + 1].weights == [r[f"w{i}"] for i in range(5)]
        assert r.GLOBAL == pytest.approx((r.accuracy["US"] * 60 + r.accuracy["EU"] * 30) / 90)
    # round 2 by the operators of one round
    scaled = fd.scale_fixed(p)
    one = spark.createDataFrame([tuple(published[2].weights) + (published[2].bias,)],
                                ", ".join(f"w{i} double" for i in range(5)) + ", bias double")
    up = fd.local_sgd(scaled, one, 20, 0.1).join(p.groupBy("node_id").agg(F.count("*").alias("n_samples")), "node_id")
    again = fd.fed_avg(up).first()
    assert [again[f"w{i}"] for i in range(5)] == pytest.approx([h[1][f"w{i}"] for i in range(5)])
    acc = {r.node_id: r.accuracy for r in fd.evaluate_nodes(scaled, fd.fed_avg(up)).collect()}
    assert acc["GLOBAL"] == pytest.approx(h[1].GLOBAL) and acc["EU"] == pytest.approx(h[1].accuracy["EU"])


def test_transfer_size_is_that_of_the_sent_json(spark):
    model = {"weights": [0.1, -2.0], "bias": 0.5, "total_samples": 10, "nodes_aggregated": ["eu", "us"]}
    df = spark.createDataFrame([tuple(model.values())],
                               "weights array<double>, bias double, total_samples long, nodes_aggregated array<string>")
    text = df.select(fd.model_json(df)).first()[0]
    assert json.loads(text) == model and len(text) == fd.fed_transfer_report(df).first().weights_bytes
    import re
    assert re.sub(r"-?\d\.\d{16}e[+-]\d\d", "0.5", text) == json.dumps({**model, "weights": [0.5, 0.5]})
