"""The hub of a federation: rounds in order, by keyed state with timers.

A hub expects one round at a time.  Per hub the state holds the expected
round (all below it are closed), and for each round met so far the first
update of every node, in the order of arrival.

* An update of a round below the expected one is stale and dropped.
* An update of a later round is early and held until its round is expected.
* A second update of a node for a round is a repetition and dropped.
* The expected round is closed as ``complete`` when ``num_nodes`` nodes have
  reported: the first ones to arrive, whatever came on top while it was held.
* It is closed as ``incomplete`` when event time passes its last update by
  ``timeout``; rounds that no node reported are passed over then, too.
* A message without a round is a heartbeat: it moves event time only.

A closed round is never opened again.  Output mode is update: the expected
round is also reported as ``open`` with what it has, and the sink keeps the
latest row by hub and round, so a replayed micro-batch changes nothing.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from .rounds import ROUND_BITS, _average, _duration_ms, broadcast_sink, reduce_batches

HUB_UPDATE = ("hub string, node_id string, weights array<double>, bias double, n_samples long, round long, "
              "event_id long, ts timestamp")
HUB_OUT = ("hub string, round long, status string, n_nodes long, total_samples long, weights array<double>, "
           "bias double, nodes_aggregated string")
# Rows of a frame that the hub's task passes on.
ROWS_OUT = 10_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Hub:
    """The rules of one hub, apart from where its state is kept.

    ``held`` maps a round to its updates in order of arrival: node ->
    [event_id, n_samples, weights, bias, time in ms]."""

    def __init__(self, num_nodes: int, timeout_ms: int, expected: int, held: dict[int, dict[str, list]]) -> None:
        self.num_nodes, self.timeout_ms = num_nodes, timeout_ms
        self.expected, self.held = expected, held

    def take(self, rounds: list[int], nodes: list[str], updates: list[list]) -> set[int]:
        """Updates in order of arrival; the rounds that changed."""
        changed = set()
        for r, node, update in zip(rounds, nodes, updates):
            if r >= self.expected and node not in (known := self.held.setdefault(r, {})):
                known[node] = update
                changed.add(r)
        return changed

    def deadline(self, r: int) -> int:
        return max(u[4] for u in self.held[r].values()) + self.timeout_ms

    def close(self, watermark_ms: int) -> Iterator[tuple[int, str, dict]]:
        """(round, status, updates) of the rounds that can be closed now, in order."""
        for r in sorted(self.held):
            reported = self.held[r]
            full = len(reported) >= self.num_nodes
            if not (full and r == self.expected) and watermark_ms < self.deadline(r):
                return
            first = dict(list(reported.items())[:self.num_nodes])
            del self.held[r]
            self.expected = r + 1
            yield r, "complete" if full else "incomplete", first

    def next_deadline(self) -> int | None:
        return self.deadline(min(self.held)) if self.held else None


def _row(hub: str, r: int, status: str, ups: dict) -> dict:
    n, w, b = (None, None, None)
    if status == "complete":
        n, w, b = _average({k: {"n_samples": u[1], "weights": u[2], "bias": u[3]} for k, u in ups.items()})
    return {"hub": hub, "round": r, "status": status, "n_nodes": len(ups),
            "total_samples": n if n is not None else sum(u[1] for u in ups.values()), "weights": w, "bias": b,
            "nodes_aggregated": ",".join(sorted(ups))}


class _Arrivals:
    """A micro-batch's updates of one hub in flat arrays (numbers of fixed
    width, nodes by number), to be met block by block."""

    def __init__(self, parts: Iterator[pd.DataFrame]) -> None:
        names: dict[str, int] = {}
        columns: list[list[np.ndarray]] = [[] for _ in range(8)]
        for part in parts:
            p = part.dropna(subset=["round", "node_id"])
            if not len(p):
                continue
            weights = p["weights"].tolist()
            for held, values in zip(columns, (
                    p["round"].astype("int64"), p["event_id"].astype("int64"), p["n_samples"].astype("int64"), p["bias"].astype("float64"),
                    p["ts"].astype("datetime64[ms]").astype("int64"), [names.setdefault(x, len(names)) for x in p["node_id"]],
                    [len(w) for w in weights], np.concatenate(weights))):
                held.append(np.asarray(values))
        self.nodes = list(names)
        if not columns[0]:
            self.starts: dict[int, tuple[int, int]] = {}
            return
        self.round, self.event, self.n, self.bias, self.at, self.node, size, self.weights = map(np.concatenate, columns)
        self.ends = np.cumsum(size)
        block = self.round >> ROUND_BITS
        self.order = np.lexsort((self.event, block))
        found, first = np.unique(block[self.order], return_index=True)
        self.starts = dict(zip(found.tolist(), zip(first.tolist(), [*first[1:].tolist(), len(block)])))

    def of(self, block: int) -> tuple[list[int], list[str], list[list]]:
        """Rounds, nodes and updates of a block's rows, in order of arrival."""
        first, stop = self.starts[block]
        rows = self.order[first:stop]
        begin = np.where(rows > 0, self.ends[rows - 1], 0).tolist()
        return (self.round[rows].tolist(), [self.nodes[k] for k in self.node[rows].tolist()], [
            [e, n, self.weights[i:j].tolist(), b, t] for e, n, i, j, b, t in zip(
                self.event[rows].tolist(), self.n[rows].tolist(), begin, self.ends[rows].tolist(),
                self.bias[rows].tolist(), self.at[rows].tolist())])


class HubProcessor(StatefulProcessor):
    """The rules over state that Spark keeps: the expected round and its
    timer, and one entry for ``1 << ROUND_BITS`` rounds.  A batch reads and
    writes only the entries it touches or closes, one at a time and in order,
    so no more than one is held in memory."""

    def __init__(self, num_nodes: int, timeout_ms: int, first_round: int) -> None:
        self.num_nodes, self.timeout_ms, self.first_round = num_nodes, timeout_ms, first_round

    def init(self, handle) -> None:
        self.handle = handle
        self.meta = handle.getValueState("meta", "expected long, timer long")
        self.blocks = handle.getMapState("blocks", "block long", "rounds string")

    def _blocks(self, hub_id: str, arrivals: _Arrivals, watermark_ms: int, replace_timer: bool) -> Iterator[pd.DataFrame]:
        expected, timer = self.meta.get() if self.meta.exists() else (self.first_round, -1)
        hub, timer = Hub(self.num_nodes, self.timeout_ms, int(expected), {}), int(timer)
        kept = {int(k[0]) for k in self.blocks.keys()}
        rows, due = [], None
        for block in sorted(kept | set(arrivals.starts)):
            if due is not None and block not in arrivals.starts:
                continue            # an earlier round waits, and nothing is new here
            hub.held = {int(k): v for k, v in json.loads(self.blocks.getValue((block,))[0]).items()} if block in kept else {}
            changed = bool(block in arrivals.starts and hub.take(*arrivals.of(block)))
            if due is None:
                for r, status, ups in hub.close(watermark_ms):
                    rows.append(_row(hub_id, r, status, ups))
                    changed = True
                if hub.expected in hub.held:
                    rows.append(_row(hub_id, hub.expected, "open", hub.held[hub.expected]))
                due = hub.next_deadline()
            if hub.held and changed:
                self.blocks.updateValue((block,), (json.dumps(hub.held),))
            elif not hub.held and block in kept:
                self.blocks.removeKey((block,))
            if len(rows) >= ROWS_OUT:
                yield pd.DataFrame(rows)
                rows = []
        if replace_timer and timer >= 0 and timer != due and timer > watermark_ms:
            self.handle.deleteTimer(timer)
        if due is not None and not (replace_timer and timer == due):
            self.handle.registerTimer(due)
        self.meta.update((hub.expected, -1 if due is None else due))
        if rows:
            yield pd.DataFrame(rows)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from self._blocks(key[0], _Arrivals(rows), timerValues.getCurrentWatermarkInMs(), True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._blocks(key[0], _Arrivals(iter(())), timerValues.getCurrentWatermarkInMs(), False)

    def close(self) -> None:
        pass


def _first_per_node(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Repeated updates of a partition, before the shuffle by hub: the first of
    each hub, round and node stays, of heartbeats the last of each hub."""
    def first(rows: pd.DataFrame) -> pd.DataFrame:
        beats = rows["round"].isna()
        return pd.concat([
            rows[~beats].sort_values("event_id", kind="stable").drop_duplicates(["hub", "round", "node_id"]),
            rows[beats].sort_values("ts", kind="stable").drop_duplicates(["hub"], keep="last")])
    return reduce_batches(batches, first)


def hub_rounds(updates: DataFrame, num_nodes: int, timeout: str = "60 seconds", watermark: str = "1 minute",
               first_round: int = 1) -> DataFrame:
    """The rounds of every hub: see the module's text.

    ``updates``: hub, node_id, weights, bias, n_samples, round, event_id, ts;
    within a micro-batch event_id is the order of arrival.  A null hub is a
    hub of its own; an update without a node is a heartbeat.  Needs the
    RocksDB state store (see :func:`run_hub`)."""
    reduced = updates.mapInPandas(_first_per_node, updates.schema).withWatermark("ts", watermark)
    return reduced.groupBy("hub").transformWithStateInPandas(
        HubProcessor(num_nodes, _duration_ms(timeout), first_round), HUB_OUT, "Update", "EventTime")


def run_hub(spark: SparkSession, source: str, out: str, checkpoint: str, num_nodes: int, timeout: str = "60 seconds",
            watermark: str = "1 minute", first_round: int = 1, broadcast_path: str | None = None) -> None:
    """Take in all that ``source`` (a folder of JSON messages) holds now and
    was not taken in before.  Each micro-batch writes its rows in a folder of
    its own under ``out`` and, if asked for, the models of its complete rounds
    under ``broadcast_path``, by hub and round."""
    def sink(rows: DataFrame, batch: int) -> None:
        rows.persist()
        rows.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={batch}")
        if broadcast_path:
            broadcast_sink(rows, batch, broadcast_path, by=["hub", "round"])
        rows.unpersist()

    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, ROCKSDB)
    try:
        rounds = hub_rounds(spark.readStream.schema(HUB_UPDATE).json(source), num_nodes, timeout, watermark, first_round)
        query = (rounds.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).outputMode("update")
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        spark.conf.set(key, before)


def read_rounds(spark: SparkSession, out: str) -> DataFrame:
    """The latest row of every hub and round that run_hub wrote."""
    rows = spark.read.schema(HUB_OUT + ", batch long").parquet(out)
    latest = Window.partitionBy("hub", "round").orderBy(F.desc("batch"))
    return rows.withColumn("_n", F.row_number().over(latest)).where("_n = 1").drop("_n", "batch")
