"""Per-node statistics and federated logistic training as Spark jobs.

All nodes live in one frame tagged by ``node_id``; every computation is
grouped by ``node_id`` so only per-node aggregates (a few doubles per node)
ever leave a node's rows.  Model state is a tiny DataFrame (one row per
node, or one global row) joined back to the data each epoch; it is
checkpointed to the shared checkpoint folder every round so lineage stays
short and a lost executor never forces a replay of earlier rounds.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import sigmoid
from ..schemas import FEATURES, TARGET
from ..session import scratch_path

EPS = 1e-8
# Training defaults (epochs, learning rates, initial weights).
GD_EPOCHS, GD_LR = 5, 0.01
BATCH_SIZE = 32
SGD_ROWS, SGD_LR = 100, 0.01
DEMO_ROWS, DEMO_LR = 200, 0.1
INIT_WEIGHT, INIT_BIAS = 0.01, 0.0


# ------------------------------------------------------------ statistics ----

def node_statistics(patients: DataFrame) -> DataFrame:
    """n, cancer rate % (1 dp), mean age (1 dp), mean BRCA1 count (2 dp)."""
    return patients.groupBy("node_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(TARGET) * 100, 1).alias("rate"),
        F.round(F.avg("age"), 1).alias("avg_age"),
        F.round(F.avg("variant_brca1"), 2).alias("brca1"))


def federated_rate(stats: DataFrame) -> DataFrame:
    """Combined cancer rate from per-node statistics.

    * ``federated_rate`` - reference definition: equal-weight mean of the
      already rounded node rates, cut (not rounded) to one decimal; done in
      integer tenths so 23.1 / 3 gives 7.7, not 7.6;
    * ``weighted_rate`` - n-weighted rate from the same rounded rates.
    """
    tenths = F.round(F.col("rate") * 10).cast("long")
    agg = stats.agg(F.sum(tenths).alias("_t"), F.count(F.lit(1)).alias("_k"),
                    F.sum(F.col("rate") * F.col("n")).alias("_rn"), F.sum("n").alias("_n"))
    return agg.select(
        (F.floor(F.col("_t") / F.col("_k")) / 10.0).alias("federated_rate"),
        F.round(F.col("_rn") / F.col("_n"), 6).alias("weighted_rate"),
        F.col("_n").cast("long").alias("total_patients"),
        F.col("_k").cast("long").alias("nodes"))


def node_union(patients: DataFrame) -> DataFrame:
    """Per-node (region, n, cancer_rate) rows - the UNION ALL of one query per
    node, expressed as one grouped scan."""
    return patients.groupBy(F.col("node_id").alias("region")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(TARGET).alias("cancer_rate"))


def patient_features(patients: DataFrame) -> DataFrame:
    """The five model features and the target as doubles."""
    keep = [c for c in ("node_id", "patient_id") if c in patients.columns]
    return patients.select(*keep, *[F.col(c).cast("double").alias(c) for c in FEATURES + [TARGET]])


def scale_fixed(patients: DataFrame) -> DataFrame:
    """age / 100 and bmi / 50; allele counts unchanged."""
    return (patient_features(patients)
            .withColumn("age", F.col("age") / 100.0).withColumn("bmi", F.col("bmi") / 50.0))


# Per-node tables (moments, models) are broadcast when the frame has at most
# this many nodes - checked once per job by counting the distinct node ids.
MAX_BROADCAST_NODES = 100_000


def nodes_bounded(df: DataFrame) -> bool:
    """True when ``df`` has at most ``MAX_BROADCAST_NODES`` distinct nodes, so
    one-row-per-node tables may be broadcast (a shuffle join on a handful of
    node ids would put each node's rows in a single task)."""
    return df.select("node_id").distinct().count() <= MAX_BROADCAST_NODES


def standardize_per_node(patients: DataFrame, broadcast: bool | None = None) -> DataFrame:
    """z-score per node: (x - node mean) / (node population sd + 1e-8).

    The per-node moments are one row per node, joined back by ``node_id``
    (broadcast after the node-count check)."""
    p = patient_features(patients)
    m = p.groupBy("node_id").agg(*[F.avg(c).alias(f"_m_{c}") for c in FEATURES],
                                 *[F.stddev_pop(c).alias(f"_s_{c}") for c in FEATURES])
    if broadcast is None:
        broadcast = nodes_bounded(p)
    j = p.join(F.broadcast(m) if broadcast else m, "node_id")
    return j.select("node_id", *[c for c in ("patient_id",) if c in p.columns],
                    *[((F.col(c) - F.col(f"_m_{c}")) / (F.col(f"_s_{c}") + EPS)).alias(c) for c in FEATURES],
                    TARGET)


# --------------------------------------------------------------- models -----

def _weights_cols(prefix: str = "w") -> list[str]:
    return [f"{prefix}{i}" for i in range(len(FEATURES))]


def initial_model(nodes: DataFrame | None, spark=None, weight: float = INIT_WEIGHT,
                  bias: float = INIT_BIAS) -> DataFrame:
    """One global row ``(w0..w4, bias)`` (``nodes`` None) or one row per node."""
    cols = [F.lit(float(weight)).alias(c) for c in _weights_cols()] + [F.lit(float(bias)).alias("bias")]
    if nodes is None:
        return spark.range(1).select(*cols)
    return nodes.select("node_id").distinct().select("node_id", *cols)


def model_array(model: DataFrame) -> DataFrame:
    """``w0..w4`` columns -> ``weights array<double>``."""
    keep = [c for c in model.columns if c not in _weights_cols()]
    return model.select(*keep, F.array(*_weights_cols()).alias("weights"))


def model_scalars(model: DataFrame) -> list[Column]:
    """w0..w4 and bias of a one-row model as scalar-subquery columns (each
    evaluated once), so the model meets the data without a join."""
    return [model.select(c).scalar().alias(c) for c in _weights_cols() + ["bias"]]


def _logit(prefix: str = "w") -> Column:
    z = F.col("bias")
    for i, f in enumerate(FEATURES):
        z = z + F.col(f"{prefix}{i}") * F.col(f)
    return z


def gd_epoch(data: DataFrame, model: DataFrame, lr: float = GD_LR, broadcast: bool = True) -> DataFrame:
    """One full-batch gradient step per node (mean gradient of the log-loss).

    Also returns the loss and accuracy of the forward pass that produced the
    gradient (before the update), threshold ``p > 0.5``.  Written as one SQL
    statement: the model (one row per node) is broadcast when the caller has
    checked the node count, the data is aggregated per node with partial
    aggregation."""
    hint = "/*+ BROADCAST(m) */ " if broadcast else ""
    k = range(len(FEATURES))
    z = "m.bias + " + " + ".join(f"m.w{i} * d.{f}" for i, f in zip(k, FEATURES))
    y = TARGET
    return data.sparkSession.sql(f"""
SELECT node_id, {", ".join(f"w{i} - {lr}D * g{i} AS w{i}" for i in k)}, bias - {lr}D * gb AS bias,
  n_samples, final_loss, final_accuracy
FROM (
  SELECT node_id, {", ".join(f"first(w{i}) AS w{i}" for i in k)}, first(bias) AS bias,
    {", ".join(f"avg((p - {y}) * {f}) AS g{i}" for i, f in zip(k, FEATURES))}, avg(p - {y}) AS gb,
    -avg({y} * ln(p + {EPS}D) + (1 - {y}) * ln(1 - p + {EPS}D)) AS final_loss,
    avg(CASE WHEN (p > 0.5D) = ({y} = 1) THEN 1.0D ELSE 0.0D END) AS final_accuracy,
    count(*) AS n_samples
  FROM (
    SELECT {hint}d.node_id, {", ".join(f"d.{f}" for f in FEATURES)}, d.{y},
      {", ".join(f"m.w{i}" for i in k)}, m.bias,
      1.0D / (1.0D + exp(-least(greatest({z}, -500.0D), 500.0D))) AS p
    FROM {{data}} d JOIN {{model}} m ON d.node_id = m.node_id) x
  GROUP BY node_id) g""", data=data, model=model)


def local_gd(patients: DataFrame, epochs: int = GD_EPOCHS, lr: float = GD_LR, standardize: bool = True,
             model: DataFrame | None = None, checkpoint_every: int = 0) -> DataFrame:
    """Full-batch logistic regression per node: zero init (unless ``model``),
    ``epochs`` steps.  Output per node: w0..w4, bias, n_samples, final_loss,
    final_accuracy (of the last forward pass)."""
    bounded = nodes_bounded(patients)
    data = standardize_per_node(patients, bounded) if standardize else patient_features(patients)
    data = data.select("node_id", *FEATURES, TARGET)
    if epochs > 1:
        data = data.checkpoint(eager=True)  # read by every epoch; spark.sql(..., data=...) would drop a cache
    m = model if model is not None else initial_model(data, weight=0.0, bias=0.0)
    m = m.select("node_id", *_weights_cols(), "bias")
    out = None
    for e in range(epochs):
        out = gd_epoch(data, m, lr, broadcast=bounded)
        if checkpoint_every and (e + 1) % checkpoint_every == 0:
            out = out.checkpoint(eager=True)
        m = out.select("node_id", *_weights_cols(), "bias")
    return out


class _Fold:
    """Minibatch steps of one node; at most one batch of rows waits."""

    def __init__(self, k: int, batch_size: int, lr: float) -> None:
        self.w, self.b, self.lr, self.batch_size = np.zeros(k), 0.0, lr, batch_size
        self.x, self.y = np.zeros((0, k)), np.zeros(0)
        self.steps = 0
        self.open_epoch()

    def open_epoch(self) -> None:
        self.n, self.loss, self.hits = 0, 0.0, 0

    def _step(self, x: np.ndarray, y: np.ndarray) -> None:
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ self.w + self.b, -500.0, 500.0)))
        self.n += len(y)
        self.loss -= float(np.sum(y * np.log(p + EPS) + (1 - y) * np.log(1 - p + EPS)))
        self.hits += int(np.sum((p > 0.5) == (y == 1)))
        self.w = self.w - self.lr * ((p - y) @ x) / len(y)
        self.b = self.b - self.lr * float(np.mean(p - y))
        self.steps += 1

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        x, y = np.concatenate([self.x, x]), np.concatenate([self.y, y])
        whole = len(y) - len(y) % self.batch_size
        for lo in range(0, whole, self.batch_size):
            self._step(x[lo:lo + self.batch_size], y[lo:lo + self.batch_size])
        self.x, self.y = x[whole:], y[whole:]

    def close_epoch(self) -> None:
        if len(self.y):
            self._step(self.x, self.y)
            self.x, self.y = self.x[:0], self.y[:0]


def local_minibatch(patients: DataFrame, epochs: int = GD_EPOCHS, batch_size: int = BATCH_SIZE, lr: float = GD_LR,
                    standardize: bool = True, seed: int = 17) -> DataFrame:
    """Minibatch gradient descent per node from zero weights.

    Each epoch puts a node's rows in an order of its own, by md5 of seed,
    epoch and ``patient_id`` (then the id), and takes steps with the mean
    gradient of ``batch_size`` rows; the last batch may be smaller.  Rows are
    shuffled and sorted by (node, epoch, order) and folded as they stream by:
    a task holds the weights and one unfinished batch, whatever the node's
    size.  Steps of one node follow one another, so a node is one task's work.

    Output per node: w0.., bias, n_samples, steps, and final_loss and
    final_accuracy over the last epoch's batches, each before its step.  Rows
    without a value among features and target are left out; an empty frame
    gives no rows."""
    data = standardize_per_node(patients) if standardize else patient_features(patients)
    data = data.select("node_id", "patient_id", *FEATURES, TARGET).dropna(subset=FEATURES + [TARGET])
    key = F.concat_ws(":", F.lit(str(seed)), F.col("_e").cast("string"), F.col("patient_id").cast("string"))
    each = data.withColumn("_e", F.explode(F.sequence(F.lit(1), F.lit(epochs)))).withColumn("_o", F.md5(key.cast("binary")))
    rows = each.repartition("node_id").sortWithinPartitions("node_id", "_e", "_o", "patient_id").select(
        "node_id", "_e", *FEATURES, TARGET)
    k, names = len(FEATURES), ["node_id", *_weights_cols(), "bias", "n_samples", "steps", "final_loss", "final_accuracy"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, node, epoch = None, None, None

        def row() -> pa.RecordBatch:
            fold.close_epoch()
            values = [node, *fold.w.tolist(), fold.b, fold.n, fold.steps, fold.loss / fold.n, fold.hits / fold.n]
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=names)

        for batch in batches:
            nodes, epochs_ = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            values = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[2:]], axis=1)
            cuts = [0, *[i for i in range(1, len(nodes)) if (nodes[i], epochs_[i]) != (nodes[i - 1], epochs_[i - 1])], len(nodes)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if fold is None or nodes[lo] != node:
                    if fold is not None:
                        yield row()
                    fold, node, epoch = _Fold(k, batch_size, lr), nodes[lo], epochs_[lo]
                elif epochs_[lo] != epoch:
                    fold.close_epoch()
                    fold.open_epoch()
                    epoch = epochs_[lo]
                fold.add(values[lo:hi, :k], values[lo:hi, k])
        if fold is not None:
            yield row()

    types = ", ".join(f"{c} double" for c in _weights_cols())
    return rows.mapInArrow(run, f"node_id string, {types}, bias double, n_samples long, steps long, final_loss double, "
                                "final_accuracy double")


def local_sgd(patients: DataFrame, model: DataFrame, n_rows: int = SGD_ROWS, lr: float = SGD_LR,
              clip: bool = True) -> DataFrame:
    """Per-row SGD over the first ``n_rows`` rows of each node (ordered by
    ``patient_id``), starting from the global ``model`` row.

    The update is sequential by nature, so it runs as a SQL ``aggregate``
    fold over a bounded array: ``row_number() <= n`` is planned as a
    per-partition group limit before the shuffle, and only n rows per node
    are gathered."""
    return sgd_fold(first_rows(patients, n_rows), model, lr, clip)


def first_rows(patients: DataFrame, n_rows: int) -> DataFrame:
    """node_id, _rows (the first ``n_rows`` rows by ``patient_id``), n_rows."""
    w = Window.partitionBy("node_id").orderBy("patient_id")
    return (patients.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n_rows)
            .groupBy("node_id")
            .agg(F.sort_array(F.collect_list(F.struct("_rn", *FEATURES, TARGET))).alias("_rows"),
                 F.count(F.lit(1)).alias("n_rows")))


def sgd_fold(rows: DataFrame, model: DataFrame, lr: float = SGD_LR, clip: bool = True) -> DataFrame:
    """One step a row over the gathered rows of each node, from the one-row ``model``."""
    j = rows.select("*", *model_scalars(model))
    init = F.struct(*[F.col(c).cast("double").alias(c) for c in _weights_cols()],
                    F.col("bias").cast("double").alias("bias"))

    def step(acc, r):
        z = acc["bias"]
        for i, f in enumerate(FEATURES):
            z = z + acc[f"w{i}"] * r[f]
        p = sigmoid(z) if clip else F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
        err = r[TARGET] - p
        return F.struct(*[(acc[f"w{i}"] + lr * err * r[f]).alias(f"w{i}") for i, f in enumerate(FEATURES)],
                        (acc["bias"] + lr * err).alias("bias"))

    fold = F.aggregate("_rows", init, step)
    keep = [c for c in rows.columns if c not in ("node_id", "_rows", "n_rows")]
    return j.select("node_id", *[fold[f"w{i}"].alias(f"w{i}") for i in range(len(FEATURES))],
                    fold["bias"].alias("bias"), "n_rows", *keep)


def weight_columns(df: DataFrame) -> list[str]:
    """``w0, w1, ...`` columns present, in index order."""
    import re
    ws = [c for c in df.columns if re.fullmatch(r"w\d+", c)]
    return sorted(ws, key=lambda c: int(c[1:]))


def _ordered_sum(values: Column) -> Column:
    """Left fold of ``array<struct<k, v>>`` values in key order (plain double
    additions in a fixed order: the same bits on every run and partitioning)."""
    return F.aggregate(F.transform(F.sort_array(values), lambda s: s["v"]), F.lit(0.0),
                       lambda acc, x: acc + x)


def fed_avg(updates: DataFrame, group: list[str] | None = None, ordered: bool = False) -> DataFrame:
    """n-weighted mean of node weights and bias (per ``group``, e.g. round).

    ``updates``: node_id, w0..wk (or a ``weights`` array of the model's
    five features), bias, n_samples.  Output: w0..wk, bias, total_samples,
    nodes_aggregated (sorted; bounded by the node count).  ``ordered`` sums
    in node-id order for bit-reproducible results on deduplicated updates;
    the default is a partial-aggregation sum."""
    group = group or []
    u = updates
    if "weights" in u.columns and "w0" not in u.columns:
        u = u.select("*", *[F.get(F.col("weights"), i).alias(f"w{i}") for i in range(len(FEATURES))])
    ws = weight_columns(u)
    n = F.col("n_samples")
    if ordered:
        # one update per node and group (deduplicated input): the per-group
        # arrays are bounded by the node count
        def wsum(c):
            return _ordered_sum(F.collect_list(F.struct(F.col("node_id").alias("k"), (c * n).alias("v"))))
    else:
        def wsum(c):
            return F.sum(c * n)
    agg = u.groupBy(*group).agg(
        *[wsum(F.col(w)).alias(f"_s{w}") for w in ws],
        wsum(F.col("bias")).alias("_sb"), F.sum(n).alias("total_samples"),
        F.sort_array(F.collect_set("node_id")).alias("nodes_aggregated"))
    return agg.select(
        *group, *[(F.col(f"_s{w}") / F.col("total_samples")).alias(w) for w in ws],
        (F.col("_sb") / F.col("total_samples")).alias("bias"), F.col("total_samples").cast("long"),
        "nodes_aggregated")


def evaluate_nodes(data: DataFrame, model: DataFrame, threshold_ge: bool = True) -> DataFrame:
    """Accuracy per node of a global model row (``p >= 0.5`` by default) and
    the n-weighted global accuracy as node ``GLOBAL``."""
    j = data.select("*", *model_scalars(model))
    p = sigmoid(_logit())
    hit = ((p >= 0.5) if threshold_ge else (p > 0.5)) == (F.col(TARGET) == 1)
    per = j.groupBy("node_id").agg(F.count(F.lit(1)).alias("n"),
                                   F.sum(F.when(hit, 1).otherwise(0)).alias("correct"))
    glob = per.agg(F.lit("GLOBAL").alias("node_id"), F.sum("n").alias("n"), F.sum("correct").alias("correct"))
    out = per.unionByName(glob)
    return out.select("node_id", F.col("n").cast("long"), F.col("correct").cast("long"),
                      (F.col("correct") / F.col("n")).alias("accuracy"))


def _published(spark, path: str, r: int) -> DataFrame:
    """The model that opened round ``r``: w0.. and bias, one row."""
    m = spark.read.schema("weights array<double>, bias double").json(f"{path}/round={r}")
    return m.select(*[F.get("weights", i).alias(c) for i, c in enumerate(_weights_cols())], "bias")


def long_updates(updates: DataFrame) -> DataFrame:
    """node_id, n_samples, i, w: one row a node and weight; the bias comes last."""
    return updates.select("node_id", "n_samples", F.posexplode(F.array(*_weights_cols(), "bias")).alias("i", "w"))


def average_long(updates: DataFrame) -> DataFrame:
    """The n-weighted mean of long updates as one row: weights, bias."""
    k = len(FEATURES)
    mean = updates.groupBy("i").agg((F.sum(F.col("w") * F.col("n_samples")) / F.sum("n_samples")).alias("w"))
    every = mean.agg(F.sort_array(F.collect_list(F.struct("i", "w")))["w"].alias("w"))
    return every.select(F.slice("w", 1, k).alias("weights"), F.get("w", k).alias("bias"))


def fed_train(patients: DataFrame, rounds: int = 3, local: str = "sgd", n_rows: int = DEMO_ROWS,
              lr: float = DEMO_LR, epochs: int = 1, scale: str = "fixed", path: str | None = None) -> DataFrame:
    """The hub's loop: publish a model, train at the nodes, average, publish.

    Round k reads the model published for it (as the broadcast sink does) under
    ``path`` (a folder of its own in the shared checkpoint folder by default)
    and publishes that of round k + 1: the written folder is the barrier, so
    every round's plan is of the same size and a lost executor never forces a
    replay of earlier rounds.  The patients are read once; SGD then runs on
    the nodes' first rows, gathered and landed before the first round.  All
    rounds' models are evaluated together by one scan of the landed data.

    One row per round: w0.., bias (after the round), ``GLOBAL`` accuracy, and
    ``accuracy``: a map of node -> accuracy."""
    from ..streaming.rounds import publish

    spark = patients.sparkSession
    path = path or scratch_path(spark, f"fed-{uuid.uuid4().hex}")
    data = scale_fixed(patients) if scale == "fixed" else (
        standardize_per_node(patients) if scale == "zscore" else patient_features(patients))
    data = data.checkpoint(eager=True)
    if local == "sgd":
        sizes = data.groupBy("node_id").agg(F.count(F.lit(1)).alias("n_samples"))
        gathered = first_rows(data, n_rows).join(sizes, "node_id").checkpoint(eager=True)

    def send(model: DataFrame, r: int) -> None:
        publish(model.select(F.lit(r).alias("round"), "weights", "bias"), path, ["round"])

    send(model_array(initial_model(None, spark)), 1)
    for r in range(1, rounds + 1):
        model = _published(spark, path, r)
        if local == "sgd":
            updates = sgd_fold(gathered, model, lr)
        else:
            nodes = data.select("node_id").distinct().select("node_id", *model_scalars(model))
            updates = local_gd(data, epochs=epochs, lr=lr, standardize=False, model=nodes)
        send(average_long(long_updates(updates)), r + 1)

    models = spark.read.schema("weights array<double>, bias double, round int").json(path).where("round > 1").select(
        (F.col("round") - 1).alias("round"), "weights", "bias")
    # one row of all rounds' models (bounded by the rounds) meets the data as a scalar
    every = models.agg(F.sort_array(F.collect_list(F.struct("round", "weights", "bias")))).scalar()
    each = data.select("node_id", TARGET, *FEATURES, F.explode(every).alias("m"))
    z = F.col("m.bias")
    for i, f in enumerate(FEATURES):
        z = z + F.get("m.weights", F.lit(i)) * F.col(f)
    hit = (sigmoid(z) >= 0.5) == (F.col(TARGET) == 1)
    per = each.groupBy(F.col("m.round").alias("round"), "node_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(hit).alias("correct"))
    acc = per.groupBy("round").agg(
        (F.sum("correct") / F.sum("n")).alias("GLOBAL"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("node_id", F.col("correct") / F.col("n"))))).alias("accuracy"))
    return models.join(acc, "round").select(
        *[F.get("weights", i).alias(c) for i, c in enumerate(_weights_cols())], "bias", "GLOBAL", "accuracy", "round")


def model_json(model: DataFrame) -> Column:
    """The model as the JSON text that is sent: ", " and ": " between parts,
    the nodes aggregated if the frame names them, every number of the weights
    as 17 significant digits (``%.16e``): lossless, and of a length that does
    not depend on how an engine shortens doubles."""
    num = lambda c: F.format_string("%.16e", c)
    parts = [F.lit('{"weights": ['), F.array_join(F.transform("weights", num), ", "),
             F.lit('], "bias": '), num(F.col("bias")),
             F.lit(', "total_samples": '), F.col("total_samples").cast("string")]
    if "nodes_aggregated" in model.columns:
        quoted = F.transform("nodes_aggregated", lambda x: F.concat(F.lit('"'), x, F.lit('"')))
        parts += [F.lit(', "nodes_aggregated": ['), F.array_join(quoted, ", "), F.lit("]")]
    return F.concat(*parts, F.lit("}"))


def fed_transfer_report(model: DataFrame, per_node_baseline: int = 1000,
                        bytes_per_patient: int = 50 * 1024) -> DataFrame:
    """Volume gain (total / single-node baseline), estimated raw bytes kept
    local, bytes of the serialized model (``model_json``) and the reduction
    factor."""
    size = F.length(model_json(model)).cast("long")
    return model.select(
        (F.col("total_samples") / F.lit(float(per_node_baseline))).alias("volume_gain"),
        (F.col("total_samples") * bytes_per_patient).cast("long").alias("raw_bytes_est"),
        size.alias("weights_bytes"),
        (F.col("total_samples") * bytes_per_patient / size).alias("reduction_factor"))
