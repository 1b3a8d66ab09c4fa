"""Model-update stream: node updates -> one averaged model per round.

Source is a folder of JSON update messages (``readStream.json``; a Kafka
source is a configuration change).  Per-round state lives in
``applyInPandasWithState`` keyed by blocks of ``1 << ROUND_BITS`` rounds, so
that a call of Python serves a block and not one round: it holds at most one
update per round and node (bounded by the node count), emits the n-weighted average once
``num_nodes`` distinct nodes have reported, ignores late or repeated
updates for an emitted round, and drops a round's state after ``timeout``
without progress in event time (incomplete rounds are reported as such).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from ..schemas import UPDATE_MESSAGE

UPDATE_WITH_ID = T.StructType(UPDATE_MESSAGE.fields + [T.StructField("event_id", T.LongType()),
                                                       T.StructField("ts", T.TimestampType())])

ROUND_OUT = ("round long, status string, n_nodes long, total_samples long, weights array<double>, "
             "bias double, nodes_aggregated string")
ROUND_STATE = "rounds string"
# Rounds of one block share a state and a timer.
ROUND_BITS = 6
# Rows that a partition holds while it looks for repeated updates.
REDUCE_ROWS = 1 << 16


def updates_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming source of update messages (declared schema)."""
    r = spark.readStream.schema(UPDATE_WITH_ID)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(path)


def dedupe_updates(updates: DataFrame, order_col: str = "event_id") -> DataFrame:
    """Batch: the first update (lowest ``order_col``) of each (round, node).
    ``min_by`` is a partial aggregate, so no group is sorted whole."""
    cols = [c for c in updates.columns if c not in ("round", "node_id")]
    s = F.min_by(F.struct(*cols), F.col(order_col))
    return updates.groupBy("round", "node_id").agg(s.alias("_u")).select("round", "node_id", "_u.*")


def dedupe_updates_stream(updates: DataFrame, watermark: str | None = "10 minutes") -> DataFrame:
    """Streaming: one update per (round, node); with an event-time watermark
    the dedupe state is bounded (``dropDuplicatesWithinWatermark``)."""
    if watermark:
        return updates.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["round", "node_id"])
    return updates.dropDuplicates(["round", "node_id"])


def _fold(values) -> float:
    """Plain left-to-right double additions (no compensation), the same
    operation sequence as the SQL fold over node-ordered contributions."""
    acc = 0.0
    for v in values:
        acc = acc + v
    return acc


def _average(ups: dict) -> tuple:
    """n-weighted mean summed in node-id order, so the result does not
    depend on the order the updates arrived in (bit-reproducible)."""
    us = [ups[k] for k in sorted(ups)]
    n = sum(u["n_samples"] for u in us)
    k = len(us[0]["weights"])
    w = [_fold(u["weights"][i] * u["n_samples"] for u in us) / n for i in range(k)]
    b = _fold(u["bias"] * u["n_samples"] for u in us) / n
    return n, w, b


def _incomplete(rnd: int, ups: dict) -> dict:
    return {"round": rnd, "status": "incomplete", "n_nodes": len(ups),
            "total_samples": sum(u["n_samples"] for u in ups.values()), "weights": None, "bias": None,
            "nodes_aggregated": ",".join(sorted(ups))}


def _complete(rnd: int, ups: dict) -> dict:
    n, w, b = _average(ups)
    return {"round": rnd, "status": "complete", "n_nodes": len(ups), "total_samples": n, "weights": w, "bias": b,
            "nodes_aggregated": ",".join(sorted(ups))}


def _round_fn(num_nodes: int, timeout_ms: int):
    def fn(key, pdfs, state):
        # round -> [idle timer in ms, emitted, node -> update]
        rounds = {int(k): v for k, v in json.loads(state.get[0]).items()} if state.exists else {}
        watermark = state.getCurrentWatermarkMs()
        last_ms: dict[int, int] = {}
        out = []
        for pdf in pdfs:        # none when the timer calls
            p = pdf.sort_values("event_id")
            at = p["ts"].astype("datetime64[ms]").astype("int64")
            for rnd, node, event, n, w, b, ms in zip(p["round"], p["node_id"], p["event_id"], p["n_samples"], p["weights"],
                                                     p["bias"], at):
                rnd = int(rnd)
                last_ms[rnd] = max(last_ms.get(rnd, 0), int(ms))
                _, done, ups = rounds.setdefault(rnd, [0, False, {}])
                # late or repeated updates for an emitted round are dropped
                if not done and (node not in ups or event < ups[node]["event_id"]):
                    ups[node] = {"event_id": int(event), "n_samples": int(n), "weights": [float(x) for x in w],
                                 "bias": float(b)}
        for rnd in sorted(rounds):
            expire, done, ups = rounds[rnd]
            if rnd in last_ms:
                # idle timer in event time: the round is given up (or, once emitted,
                # forgotten) when the watermark passes its last update + timeout
                expire = max(last_ms[rnd] + timeout_ms, watermark + 1)
                if not done and len(ups) >= num_nodes:
                    out.append(_complete(rnd, ups))
                    done, ups = True, {}
                rounds[rnd] = [expire, done, ups]
            elif expire < watermark:
                if not done:
                    out.append(_incomplete(rnd, ups))
                del rounds[rnd]
        if rounds:
            state.update((json.dumps(rounds),))
            state.setTimeoutTimestamp(max(min(r[0] for r in rounds.values()), watermark))
        else:
            state.remove()
        if out:
            yield pd.DataFrame(out)
    return fn


def reduce_batches(batches: Iterable[pd.DataFrame], reduce: Callable[[pd.DataFrame], pd.DataFrame],
                   rows: int = 0) -> Iterator[pd.DataFrame]:
    """``reduce`` over a partition's batches within bounded memory and linear
    time: it runs once ``rows`` (REDUCE_ROWS) are held.  What it leaves is
    held on while that is at most half of them, so the next run comes after as
    many new rows; otherwise most rows differ, and they are passed on."""
    rows = rows or REDUCE_ROWS
    held, n = [], 0
    for pdf in batches:
        if not len(pdf):
            continue
        held.append(pdf)
        n += len(pdf)
        if n >= rows:
            left = reduce(pd.concat(held))
            held, n = [left], len(left)
            if n > rows // 2:
                yield left
                held, n = [], 0
    if held:
        yield reduce(pd.concat(held))


def _first_per_round_node(batches):
    """Map-side pre-reduction inside each partition of a micro-batch: keep
    the lowest-``event_id`` update per (round, node).  A round flooded with
    repeated messages therefore sends few rows through the shuffle, not all
    of them (see :func:`reduce_batches`)."""
    return reduce_batches(batches, lambda x: x.sort_values("event_id").drop_duplicates(["round", "node_id"]))


def round_aggregator(updates: DataFrame, num_nodes: int, timeout: str = "60 seconds",
                     watermark: str = "1 minute") -> DataFrame:
    """Streaming rounds: see module doc.  Output mode ``append``.  Rounds
    time out in event time (``ts``): ``timeout`` after their last update,
    once the watermark (max ts - ``watermark``) has passed it.  Repeated
    updates are pre-reduced per partition before the shuffle by blocks of rounds."""
    ms = _duration_ms(timeout)
    reduced = updates.mapInPandas(_first_per_round_node, updates.schema)
    blocks = reduced.withWatermark("ts", watermark).withColumn("_block", F.shiftright("round", ROUND_BITS))
    return (blocks.groupBy("_block")
            .applyInPandasWithState(_round_fn(num_nodes, ms), ROUND_OUT, ROUND_STATE, "append",
                                    GroupStateTimeout.EventTimeTimeout))


def _duration_ms(s: str) -> int:
    n, unit = s.split()
    mult = {"ms": 1, "milliseconds": 1, "second": 1000, "seconds": 1000, "minute": 60_000, "minutes": 60_000}
    return int(float(n) * mult[unit])


def round_aggregator_batch(updates: DataFrame, num_nodes: int) -> DataFrame:
    """The same result as a batch plan: first update per (round, node), rounds
    with at least ``num_nodes`` nodes, n-weighted average."""
    d = dedupe_updates(updates)
    n = F.col("n_samples")
    x = d.select("round", "node_id", "n_samples", "bias", F.posexplode("weights").alias("i", "w"))

    def wsum(v):
        # deduplicated: one row per node and round, so the fold is bounded
        # by the node count; node-id order makes the sum bit-reproducible
        vals = F.collect_list(F.struct(F.col("node_id").alias("k"), (v * n).alias("v")))
        return F.aggregate(F.transform(F.sort_array(vals), lambda s: s["v"]), F.lit(0.0), lambda a, b: a + b)

    per_w = x.groupBy("round", "i").agg((wsum(F.col("w")) / F.sum(n)).alias("w"))
    ws = per_w.groupBy("round").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "w"))), lambda s: s["w"]).alias("weights"))
    r = d.groupBy("round").agg(F.count(F.lit(1)).alias("n_nodes"), F.sum(n).alias("total_samples"),
                               (wsum(F.col("bias")) / F.sum(n)).alias("bias"),
                               F.array_join(F.sort_array(F.collect_list("node_id")), ",").alias("nodes_aggregated"))
    return (r.where(F.col("n_nodes") >= num_nodes).join(ws, "round")
            .select("round", F.lit("complete").alias("status"), F.col("n_nodes").cast("long"),
                    F.col("total_samples").cast("long"), "weights", "bias", "nodes_aggregated"))


def broadcast_sink(batch: DataFrame, epoch_id: int, path: str, by: list[str] | None = None) -> None:
    """``foreachBatch`` sink publishing ``{round, weights, bias}`` per
    completed round; written per round folder (or per folder of ``by``) with
    overwrite, so a replayed micro-batch rewrites the same files (idempotent
    by round)."""
    by = by or ["round"]
    done = batch.where(F.col("status") == "complete").select(*by, "weights", "bias")
    if not done.isEmpty():
        publish(done, path, by)


def publish(models: DataFrame, path: str, by: list[str]) -> None:
    """Write models as JSON, one folder for each value of ``by``; folders that are there already are replaced."""
    models.write.mode("overwrite").partitionBy(*by).option("partitionOverwriteMode", "dynamic").json(path)


def run_rounds(spark: SparkSession, source: str, out: str, checkpoint: str, num_nodes: int,
               timeout: str = "60 seconds", broadcast_path: str | None = None) -> None:
    """Drive the round aggregator over everything in ``source`` now
    (``availableNow``), appending rounds to Parquet at ``out``."""
    s = updates_stream(spark, source)
    agg = round_aggregator(s, num_nodes, timeout)
    if broadcast_path:
        def both(df, eid):
            # one folder per micro-batch, overwritten on replay: a batch
            # re-run after a failure rewrites its own output (idempotent)
            df.persist()
            df.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={eid}")
            broadcast_sink(df, eid, broadcast_path)
            df.unpersist()
        q = agg.writeStream.foreachBatch(both).option("checkpointLocation", checkpoint)
    else:
        q = agg.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    q.outputMode("append").trigger(availableNow=True).start().awaitTermination()
