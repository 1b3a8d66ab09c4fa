"""The hub's rules on hand-made arrivals, by themselves and as a stream."""

import json

import pytest

from helixframe.streaming import hub as H


def update(event_id, at=0, n=10, w=1.0):
    return [event_id, n, [w, 0.0], 0.0, at]


def test_rounds_close_in_order_and_never_twice():
    hub = H.Hub(2, 1000, 1, {})
    assert hub.take([2, 2, 1], ["A", "B", "A"], [update(1), update(2), update(3)]) == {1, 2}
    assert list(hub.close(0)) == []                       # round 1 is expected, round 2 is early and waits
    hub.take([1, 1], ["A", "B"], [update(4, w=9.0), update(5)])
    closed = list(hub.close(0))
    assert [(r, s, sorted(u)) for r, s, u in closed] == [(1, "complete", ["A", "B"]), (2, "complete", ["A", "B"])]
    assert closed[0][2]["A"][2] == [1.0, 0.0]             # the repetition left the first update alone
    assert hub.take([1, 2], ["C", "C"], [update(6), update(7)]) == set() and hub.expected == 3


def test_timeout_closes_incomplete_and_passes_gaps():
    hub = H.Hub(2, 1000, 1, {})
    hub.take([4, 6], ["A", "A"], [update(1, at=5000), update(2, at=9000)])
    assert hub.next_deadline() == 6000
    assert list(hub.close(5999)) == []
    assert [(r, s) for r, s, _ in hub.close(6000)] == [(4, "incomplete")]
    assert hub.next_deadline() == 10_000
    hub.take([6, 5], ["B", "A"], [update(3, at=9100), update(4, at=9200)])
    assert list(hub.close(9999)) == []                    # round 5 is expected and waits for its second node
    assert [(r, s) for r, s, _ in hub.close(10_200)] == [(5, "incomplete"), (6, "complete")]


def test_the_first_nodes_count_whatever_was_held():
    hub = H.Hub(2, 1000, 1, {})
    hub.take([2, 2, 2, 1, 1], list("CABAB"), [update(k) for k in range(5)])
    assert [(r, list(u)) for r, _, u in hub.close(0)] == [(1, ["A", "B"]), (2, ["C", "A"])]


@pytest.fixture()
def folders(tmp_out):
    return tmp_out + "/in", tmp_out + "/out", tmp_out + "/ck", tmp_out + "/models"


def messages(folder, name, rows):
    import os
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as f:
        for hub, node, r, event, minute, w in rows:
            f.write(json.dumps({"hub": hub, "node_id": node, "weights": w and [w, 0.0], "bias": 0.0, "n_samples": 10,
                                "round": r, "event_id": event, "ts": f"2024-01-01T00:{minute:02d}:00"}) + "\n")


def test_hub_stream_over_three_triggers(spark, folders):
    src, out, ck, models = folders

    def run():
        H.run_hub(spark, src, out, ck, num_nodes=2, timeout="5 minutes", watermark="1 minute", broadcast_path=models)
        return {(r.hub, r["round"]): r for r in H.read_rounds(spark, out).collect()}

    messages(src, "a", [("x", "A", 1, 1, 0, 1.0), ("x", "A", 1, 2, 0, 8.0), ("x", "A", 2, 3, 1, 1.0), (None, "A", 1, 4, 0, 5.0)])
    got = run()
    assert (got["x", 1].status, got["x", 1].n_nodes) == ("open", 1) and ("x", 2) not in got
    messages(src, "b", [("x", "B", 1, 5, 2, 3.0), ("x", "B", 2, 6, 3, 3.0), ("x", "C", 1, 7, 3, 9.0), ("x", "A", 3, 8, 3, 1.0),
                        (None, "B", 1, 9, 3, 7.0)])
    got = run()
    assert got["x", 1].status == got["x", 2].status == "complete" and got["x", 1].weights[0] == 2.0
    assert got[None, 1].weights[0] == 6.0 and got["x", 3].status == "open"
    messages(src, "c", [("x", None, None, 10, 30, None), ("x", "C", 2, 11, 30, 9.0)])
    got = run()
    assert (got["x", 3].status, got["x", 3].n_nodes, got["x", 3].weights) == ("incomplete", 1, None)
    assert got["x", 2].nodes_aggregated == "A,B" and got["x", 2].total_samples == 20
    published = {(r.hub, r["round"]) for r in spark.read.json(models).collect()}
    assert published == {("x", 1), ("x", 2), ("__HIVE_DEFAULT_PARTITION__", 1)} or published == {("x", 1), ("x", 2), (None, 1)}


def test_a_replayed_batch_changes_nothing(spark, folders):
    src, out, ck, _ = folders
    messages(src, "a", [("x", "A", 1, 1, 0, 1.0), ("x", "B", 1, 2, 0, 3.0)])
    H.run_hub(spark, src, out, ck, num_nodes=2)
    once = H.read_rounds(spark, out).collect()
    H.run_hub(spark, src, out, ck + "-again", num_nodes=2)  # the same batch number, written once more
    assert H.read_rounds(spark, out).collect() == once
