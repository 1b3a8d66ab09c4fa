"""Registered per-node statistics and federated-training queries over the
patient view (one frame, ``node_id`` = sovereign node)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import federated as FD
from ..schemas import FEATURES, TARGET
from . import proxy as P
from .oracle_views import with_views as W
from .registry import register

_FEATS = ", ".join(FEATURES)
_D = 9  # digits kept on trained weights (order-free float comparison)


def _r(df: DataFrame, cols: list[str], digits: int = _D) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


@register("patient_features", W(f"""
SELECT node_id, patient_id, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in FEATURES + [TARGET])}
FROM px_patients""", "px_patients"))
def patient_features(t):
    return FD.patient_features(P.px_patients(t))


@register("node_statistics", W("""
SELECT node_id, count(*) AS n, round(avg(diagnosis_cancer) * 100, 1) AS rate, round(avg(age), 1) AS avg_age,
  round(avg(variant_brca1), 2) AS brca1
FROM px_patients GROUP BY node_id""", "px_patients"))
def node_statistics(t):
    return FD.node_statistics(P.px_patients(t))


@register("federated_rate", W("""
WITH s AS (SELECT node_id, count(*) AS n, round(avg(diagnosis_cancer) * 100, 1) AS rate FROM px_patients
           GROUP BY node_id)
SELECT floor(CAST(sum(CAST(round(rate * 10) AS BIGINT)) AS DOUBLE) / count(*)) / 10.0 AS federated_rate,
  round(sum(rate * n) / sum(n), 6) AS weighted_rate, CAST(sum(n) AS BIGINT) AS total_patients,
  CAST(count(*) AS BIGINT) AS nodes
FROM s""", "px_patients"))
def federated_rate(t):
    return FD.federated_rate(FD.node_statistics(P.px_patients(t)))


@register("node_union", W("""
SELECT node_id AS region, count(*) AS n, avg(diagnosis_cancer) AS cancer_rate FROM px_patients GROUP BY node_id""",
                          "px_patients"))
def node_union(t):
    return FD.node_union(P.px_patients(t))


_ZSCORE = "(CAST({c} AS DOUBLE) - avg({c}) OVER (PARTITION BY node_id)) / (stddev_pop({c}) OVER (PARTITION BY node_id) + 1e-8)"


@register("standardize_per_node", W(f"""
SELECT node_id, patient_id, {', '.join(f'round({_ZSCORE.format(c=c)}, {_D}) AS {c}' for c in FEATURES)},
  CAST(diagnosis_cancer AS DOUBLE) AS diagnosis_cancer
FROM px_patients""", "px_patients"))
def standardize_per_node(t):
    return _r(FD.standardize_per_node(P.px_patients(t)), FEATURES)


@register("scale_fixed", W("""
SELECT node_id, patient_id, CAST(age AS DOUBLE) / 100.0 AS age, CAST(variant_brca1 AS DOUBLE) AS variant_brca1,
  CAST(variant_tp53 AS DOUBLE) AS variant_tp53, CAST(variant_apoe4 AS DOUBLE) AS variant_apoe4, bmi / 50.0 AS bmi,
  CAST(diagnosis_cancer AS DOUBLE) AS diagnosis_cancer
FROM px_patients""", "px_patients"))
def scale_fixed(t):
    return FD.scale_fixed(P.px_patients(t))


def _sig(z: str) -> str:
    return f"1.0 / (1.0 + exp(-least(greatest({z}, -500.0), 500.0)))"


def gd_oracle(epochs: int, lr: float = FD.GD_LR) -> str:
    """Full-batch GD unrolled into one CTE per epoch."""
    zs = ", ".join(f"{_ZSCORE.format(c=c)} AS {c}" for c in FEATURES)
    ctes = [f"zd AS (SELECT node_id, {zs}, CAST(diagnosis_cancer AS DOUBLE) AS y FROM px_patients)",
            "e0 AS (SELECT DISTINCT node_id, " + ", ".join(f"0.0 AS w{i}" for i in range(5)) + ", 0.0 AS b, "
            "0.0 AS final_loss, 0.0 AS final_accuracy, CAST(0 AS BIGINT) AS n_samples FROM zd)"]
    z = "m.b + " + " + ".join(f"m.w{i} * d.{c}" for i, c in enumerate(FEATURES))
    for k in range(1, epochs + 1):
        inner = (f"SELECT d.node_id, d.y, {', '.join(f'd.{c}' for c in FEATURES)}, "
                 f"{', '.join(f'm.w{i}' for i in range(5))}, m.b, {_sig(z)} AS p "
                 f"FROM zd d JOIN e{k - 1} m ON d.node_id = m.node_id")
        ctes.append(
            f"e{k} AS (SELECT node_id, "
            + ", ".join(f"w{i} - {lr} * avg((p - y) * {c}) AS w{i}" for i, c in enumerate(FEATURES))
            + f", b - {lr} * avg(p - y) AS b, "
            "-avg(y * ln(p + 1e-8) + (1 - y) * ln(1 - p + 1e-8)) AS final_loss, "
            "avg(CASE WHEN (p > 0.5) = (y = 1) THEN 1.0 ELSE 0.0 END) AS final_accuracy, count(*) AS n_samples "
            f"FROM ({inner}) x GROUP BY node_id, w0, w1, w2, w3, w4, b)")
    sel = ", ".join(f"round(w{i}, {_D}) + 0.0 AS w{i}" for i in range(5))
    return ("WITH " + ",\n".join(ctes) +
            f"\nSELECT node_id, {sel}, round(b, {_D}) + 0.0 AS bias, n_samples, "
            f"round(final_loss, {_D}) + 0.0 AS final_loss, "
            f"round(final_accuracy, {_D}) + 0.0 AS final_accuracy FROM e{epochs}")


def _gd(t, epochs):
    out = FD.local_gd(P.px_patients(t), epochs=epochs)
    return _r(out, [f"w{i}" for i in range(5)] + ["bias", "final_loss", "final_accuracy"])


@register("local_gd_step", W(gd_oracle(1), "px_patients"))
def local_gd_step(t):
    """One full-batch epoch per node from zero weights."""
    return _gd(t, 1)


@register("local_gd", W(gd_oracle(FD.GD_EPOCHS), "px_patients"))
def local_gd(t):
    """Five full-batch epochs per node (reference node training job)."""
    return _gd(t, FD.GD_EPOCHS)


def sgd_oracle(n_rows: int, lr: float, scaled: bool) -> str:
    """Sequential per-row SGD as a recursive CTE (one step per row)."""
    feats = ("CAST(age AS DOUBLE) / 100.0 AS age, CAST(variant_brca1 AS DOUBLE) AS variant_brca1, "
             "CAST(variant_tp53 AS DOUBLE) AS variant_tp53, CAST(variant_apoe4 AS DOUBLE) AS variant_apoe4, "
             "bmi / 50.0 AS bmi") if scaled else ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURES)
    z = "s.b + " + " + ".join(f"s.w{i} * r.{c}" for i, c in enumerate(FEATURES))
    err = f"(r.y - {_sig(z)})"
    step = ", ".join(f"s.w{i} + {lr} * {err} * r.{c}" for i, c in enumerate(FEATURES))
    return f"""
WITH RECURSIVE r AS (
  SELECT node_id, row_number() OVER (PARTITION BY node_id ORDER BY patient_id) AS rn, {feats},
    CAST(diagnosis_cancer AS DOUBLE) AS y FROM px_patients),
s(node_id, k, w0, w1, w2, w3, w4, b) AS (
  SELECT DISTINCT node_id, CAST(0 AS BIGINT), {', '.join(['CAST(0.01 AS DOUBLE)'] * 5)}, CAST(0.0 AS DOUBLE) FROM r
  UNION ALL
  SELECT s.node_id, s.k + 1, {step}, s.b + {lr} * {err}
  FROM s JOIN r ON r.node_id = s.node_id AND r.rn = s.k + 1 WHERE s.k < {n_rows})
SELECT s.node_id, {', '.join(f'round(w{i}, {_D}) + 0.0 AS w{i}' for i in range(5))}, round(b, {_D}) + 0.0 AS bias,
  s.k AS n_rows
FROM s JOIN (SELECT node_id, max(k) AS mk FROM s GROUP BY node_id) m ON s.node_id = m.node_id AND s.k = m.mk"""


@register("local_sgd", W(sgd_oracle(FD.DEMO_ROWS, FD.DEMO_LR, True), "px_patients"))
def local_sgd(t):
    """Demo client update: 200 rows at lr 0.1 on fixed-scaled features from
    the initial global model (0.01 weights)."""
    p = FD.scale_fixed(P.px_patients(t))
    m = FD.initial_model(None, t.spark)
    out = FD.local_sgd(p, m, FD.DEMO_ROWS, FD.DEMO_LR)
    return _r(out, [f"w{i}" for i in range(5)] + ["bias"])


@register("fed_avg", W(f"""
WITH d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY round, node_id ORDER BY event_id) AS rn
                          FROM px_updates) x WHERE rn = 1)
SELECT round, round(list_reduce(list(w0 * n_samples ORDER BY node_id), lambda a, b: a + b) / sum(n_samples), {_D}) AS w0,
  round(list_reduce(list(w1 * n_samples ORDER BY node_id), lambda a, b: a + b) / sum(n_samples), {_D}) AS w1,
  round(list_reduce(list(bias * n_samples ORDER BY node_id), lambda a, b: a + b) / sum(n_samples), {_D}) AS bias, CAST(sum(n_samples) AS BIGINT) AS total_samples,
  string_agg(node_id, ',' ORDER BY node_id) AS nodes_aggregated
FROM d GROUP BY round""", "px_updates"))
def fed_avg(t):
    """n-weighted FedAvg per round over the first update of each node."""
    from ..streaming.rounds import dedupe_updates
    u = dedupe_updates(P.px_updates(t))
    out = FD.fed_avg(u, group=["round"], ordered=True)
    out = _r(out, ["w0", "w1", "bias"])
    return out.withColumn("nodes_aggregated", F.array_join("nodes_aggregated", ","))


@register("evaluate_nodes", W(f"""
WITH d AS (SELECT node_id, CAST(age AS DOUBLE) / 100.0 AS age, CAST(variant_brca1 AS DOUBLE) AS variant_brca1,
             CAST(variant_tp53 AS DOUBLE) AS variant_tp53, CAST(variant_apoe4 AS DOUBLE) AS variant_apoe4,
             bmi / 50.0 AS bmi, CAST(diagnosis_cancer AS DOUBLE) AS y FROM px_patients),
p AS (SELECT node_id, CASE WHEN ({_sig('0.0 + 0.01 * age + 0.01 * variant_brca1 + 0.01 * variant_tp53 + 0.01 * variant_apoe4 + 0.01 * bmi')} >= 0.5) = (y = 1)
             THEN 1 ELSE 0 END AS hit FROM d),
n AS (SELECT node_id, count(*) AS n, sum(hit) AS correct FROM p GROUP BY node_id
      UNION ALL SELECT 'GLOBAL', count(*), sum(hit) FROM p)
SELECT node_id, CAST(n AS BIGINT) AS n, CAST(correct AS BIGINT) AS correct, CAST(correct AS DOUBLE) / n AS accuracy
FROM n""", "px_patients"))
def evaluate_nodes(t):
    """Accuracy of the initial global model per node and n-weighted."""
    p = FD.scale_fixed(P.px_patients(t))
    return FD.evaluate_nodes(p, FD.initial_model(None, t.spark))


NODES = ["EU", "SG", "US"]   # proxy node set (by construction of the patient view)


def fed_train_oracle(rounds: int, n_rows: int, lr: float) -> str:
    """Rounds unrolled into CTEs: per round a recursive per-row SGD from the
    previous global model, n-weighted average, then per-node accuracy."""
    feats = ("CAST(age AS DOUBLE) / 100.0 AS age, CAST(variant_brca1 AS DOUBLE) AS variant_brca1, "
             "CAST(variant_tp53 AS DOUBLE) AS variant_tp53, CAST(variant_apoe4 AS DOUBLE) AS variant_apoe4, "
             "bmi / 50.0 AS bmi")
    ctes = [f"""d AS (SELECT node_id, row_number() OVER (PARTITION BY node_id ORDER BY patient_id) AS rn, {feats},
    CAST(diagnosis_cancer AS DOUBLE) AS y FROM px_patients)""",
            "n AS (SELECT node_id, count(*) AS n FROM d GROUP BY node_id)",
            "m0 AS (SELECT " + ", ".join(f"CAST(0.01 AS DOUBLE) AS w{i}" for i in range(5))
            + ", CAST(0.0 AS DOUBLE) AS b)"]
    z_s = "s.b + " + " + ".join(f"s.w{i} * r.{c}" for i, c in enumerate(FEATURES))
    err = f"(r.y - {_sig(z_s)})"
    z_m = "m.b + " + " + ".join(f"m.w{i} * d.{c}" for i, c in enumerate(FEATURES))
    sel = []
    for k in range(1, rounds + 1):
        ctes.append(f"""s{k}(node_id, k, w0, w1, w2, w3, w4, b) AS (
  SELECT n.node_id, CAST(0 AS BIGINT), m.w0, m.w1, m.w2, m.w3, m.w4, m.b FROM n, m{k - 1} m
  UNION ALL
  SELECT s.node_id, s.k + 1, {", ".join(f"s.w{i} + {lr} * {err} * r.{c}" for i, c in enumerate(FEATURES))},
    s.b + {lr} * {err}
  FROM s{k} s JOIN d r ON r.node_id = s.node_id AND r.rn = s.k + 1 WHERE s.k < {n_rows})""")
        ctes.append(f"""f{k} AS (SELECT s.*, n.n FROM s{k} s JOIN n ON s.node_id = n.node_id
  WHERE s.k = (SELECT max(k) FROM s{k} x WHERE x.node_id = s.node_id))""")
        ctes.append(f"m{k} AS (SELECT " + ", ".join(f"sum(w{i} * n) / sum(n) AS w{i}" for i in range(5))
                    + f", sum(b * n) / sum(n) AS b FROM f{k})")
        ctes.append(f"""h{k} AS (SELECT d.node_id, CASE WHEN ({_sig(z_m)} >= 0.5) = (d.y = 1) THEN 1 ELSE 0 END AS hit
  FROM d, m{k} m)""")
        accs = ", ".join(
            f"(SELECT CAST(sum(hit) AS DOUBLE) / count(*) FROM h{k} WHERE node_id = '{nd}') AS {nd}" for nd in NODES)
        sel.append(f"SELECT {', '.join(f'round(w{i}, {_D}) + 0.0 AS w{i}' for i in range(5))}, "
                   f"round(b, {_D}) + 0.0 AS bias, {accs}, "
                   f"(SELECT CAST(sum(hit) AS DOUBLE) / count(*) FROM h{k}) AS GLOBAL, {k} AS round FROM m{k}")
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + "\nUNION ALL\n".join(sel)


def _fed_train(t, rounds):
    out = FD.fed_train(P.px_patients(t), rounds=rounds, local="sgd")
    return _r(out, [f"w{i}" for i in range(5)] + ["bias"]).select(
        *[f"w{i}" for i in range(5)], "bias", *[F.col("accuracy")[nd].alias(nd) for nd in NODES], "GLOBAL",
        F.col("round").cast("int").alias("round"))


@register("fed_train", W(fed_train_oracle(3, FD.DEMO_ROWS, FD.DEMO_LR), "px_patients"))
def fed_train(t):
    """Three demo rounds (SGD clients on the first 200 rows per node, FedAvg,
    evaluation of the new global model per node and overall)."""
    return _fed_train(t, 3)


@register("fed_train_rounds", W(fed_train_oracle(10, FD.DEMO_ROWS, FD.DEMO_LR), "px_patients"))
def fed_train_rounds(t):
    """Ten rounds of the hub's loop over published models."""
    return _fed_train(t, 10)


def minibatch_oracle(epochs: int, size: int, lr: float, seed: int) -> str:
    """Batches numbered over all epochs, one step a batch by a recursive CTE."""
    zs = ", ".join(f"{_ZSCORE.format(c=c)} AS {c}" for c in FEATURES)
    p = _sig("s.b + " + " + ".join(f"s.w{i} * d.{c}" for i, c in enumerate(FEATURES)))
    step = ", ".join(f"s.w{i} - {lr} * avg(({p} - d.y) * d.{c})" for i, c in enumerate(FEATURES))
    ws = ", ".join(f"s.w{i}" for i in range(5))
    return f"""
WITH RECURSIVE z AS (SELECT node_id, patient_id, {zs}, CAST(diagnosis_cancer AS DOUBLE) AS y FROM px_patients),
d AS (SELECT z.*, e, (e - 1) * CAST(ceil(count(*) OVER (PARTITION BY node_id, e) / {size}.0) AS BIGINT)
        + (row_number() OVER (PARTITION BY node_id, e ORDER BY md5('{seed}:' || e || ':' || patient_id), patient_id) - 1) // {size} AS k
      FROM z, range(1, {epochs + 1}) r(e)),
s(node_id, k, w0, w1, w2, w3, w4, b) AS (
  SELECT DISTINCT node_id, CAST(0 AS BIGINT), {', '.join(['CAST(0.0 AS DOUBLE)'] * 6)} FROM d
  UNION ALL
  SELECT s.node_id, s.k + 1, {step}, s.b - {lr} * avg({p} - d.y)
  FROM s JOIN d ON d.node_id = s.node_id AND d.k = s.k GROUP BY s.node_id, s.k, {ws}, s.b),
l AS (SELECT d.node_id, d.y, {p} AS p FROM s JOIN d ON d.node_id = s.node_id AND d.k = s.k WHERE d.e = {epochs}),
f AS (SELECT node_id, count(*) AS n_samples, -avg(y * ln(p + 1e-8) + (1 - y) * ln(1 - p + 1e-8)) AS final_loss,
        avg(CASE WHEN (p > 0.5) = (y = 1) THEN 1.0 ELSE 0.0 END) AS final_accuracy FROM l GROUP BY node_id)
SELECT s.node_id, {', '.join(f'round(w{i}, {_D}) + 0.0 AS w{i}' for i in range(5))}, round(b, {_D}) + 0.0 AS bias, n_samples,
  k AS steps, round(final_loss, {_D}) + 0.0 AS final_loss, round(final_accuracy, {_D}) + 0.0 AS final_accuracy
FROM s JOIN f ON s.node_id = f.node_id WHERE k = (SELECT max(k) FROM s x WHERE x.node_id = s.node_id)"""


@register("local_minibatch", W(minibatch_oracle(FD.GD_EPOCHS, FD.BATCH_SIZE, FD.GD_LR, 17), "px_patients"))
def local_minibatch(t):
    """Five epochs in batches of 32 rows, in a seeded order of their own per node and epoch."""
    out = FD.local_minibatch(P.px_patients(t))
    return _r(out, [f"w{i}" for i in range(5)] + ["bias", "final_loss", "final_accuracy"])


def transfer_report_oracle() -> str:
    gd = gd_oracle(FD.GD_EPOCHS)
    body = gd[gd.index("WITH ") + 5:gd.rindex("\nSELECT ")]
    num = "printf('%.16e', {})"
    js = ("'{\"weights\": [' || " + " || ', ' || ".join(num.format(f"w{i}") for i in range(5))
          + " || '], \"bias\": ' || " + num.format("b") + " || ', \"total_samples\": ' || CAST(n AS VARCHAR)"
          " || ', \"nodes_aggregated\": [\"' || nodes || '\"]}'")
    return f"""WITH {body},
g AS (SELECT {", ".join(f"sum(w{i} * n_samples) / sum(n_samples) AS w{i}" for i in range(5))},
        sum(b * n_samples) / sum(n_samples) AS b, CAST(sum(n_samples) AS BIGINT) AS n,
        string_agg(node_id, '", "' ORDER BY node_id) AS nodes FROM e{FD.GD_EPOCHS})
SELECT n / 1000.0 AS volume_gain, CAST(n * 51200 AS BIGINT) AS raw_bytes_est,
  CAST(length({js}) AS BIGINT) AS weights_bytes, CAST(n * 51200 AS DOUBLE) / length({js}) AS reduction_factor
FROM g"""


@register("fed_transfer_report", W(transfer_report_oracle(), "px_patients"))
def fed_transfer_report(t):
    """Transfer report of the global model after FedAvg of the five-epoch
    node models."""
    m = FD.model_array(FD.fed_avg(FD.local_gd(P.px_patients(t))))
    return FD.fed_transfer_report(m)
