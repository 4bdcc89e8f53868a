"""Idempotent requests: run once, refused in flight, stored afterwards."""

import json
import time

import pytest
from pyspark.sql import functions as F

from inspectra.streaming import requests as rq

REQUEST = "key string, request_id string, timestamp timestamp, value string"


@pytest.fixture
def desk(spark, tmp_path):
    """Two folders that stream, and a way to step one decision stream."""
    for name in ("in", "out"):
        (tmp_path / name).mkdir()
    n = [0]

    def put(folder, *rows):
        n[0] += 1
        (tmp_path / folder / f"{n[0]:03d}.json").write_text("\n".join(json.dumps({"timestamp": f"2024-01-01T00:00:{n[0]:02d}", **r}) for r in rows))

    def step(remember=rq.REMEMBER, patience=rq.PATIENCE):
        asked = spark.readStream.schema(REQUEST).json(f"file://{tmp_path}/in")
        given = spark.readStream.schema(REQUEST + ", ok boolean").json(f"file://{tmp_path}/out")
        out, seen = [], f"file://{tmp_path}/cp"
        rq.start(rq.decide(asked, given, remember, patience), lambda df, i: out.extend(df.collect()), seen).awaitTermination()
        return [(r.key, r.request_id, r.decision, r.value) for r in out]

    return put, step


def test_second_request_is_refused_and_then_answered_from_memory(desk):
    put, step = desk
    put("in", {"key": "k", "request_id": "1", "value": "a"}, {"key": "other", "request_id": "9", "value": "z"})
    assert sorted(step()) == [("k", "1", rq.RUN, "a"), ("other", "9", rq.RUN, "z")]
    put("in", {"key": "k", "request_id": "2", "value": "a"})
    assert step() == [("k", "2", rq.REFUSED, "a")]
    put("out", {"key": "k", "request_id": "1", "value": "done", "ok": True})
    assert step() == [("k", "1", rq.ANSWERED, "done")]
    put("in", {"key": "k", "request_id": "3", "value": "a"})
    assert step() == [("k", "3", rq.STORED, "done")]
    put("out", {"key": "other", "request_id": "8", "value": "x", "ok": True}, {"key": "other", "request_id": "9", "value": "broken", "ok": False})
    assert sorted(step()) == [("other", "8", rq.LATE, "x"), ("other", "9", rq.FAILED, "broken")]
    # A failure is not remembered: the key may run again.
    put("in", {"key": "other", "request_id": "10", "value": "z"}, {"key": None, "request_id": "11", "value": "z"})
    assert step() == [("other", "10", rq.RUN, "z")]


def test_two_in_one_batch_run_one(desk):
    put, step = desk
    put("in", {"key": "k", "request_id": "1", "value": "a"}, {"key": "k", "request_id": "2", "value": "a"})
    assert step() == [("k", "1", rq.RUN, "a"), ("k", "2", rq.REFUSED, "a")]


def test_answers_expire_and_runs_are_given_up(desk):
    put, step = desk
    put("in", {"key": "k", "request_id": "1", "value": "a"}, {"key": "s", "request_id": "5", "value": "b"})
    step(60_000, 4000)
    put("out", {"key": "k", "request_id": "1", "value": "done", "ok": True})
    got = step(1500, 60_000)
    assert ("k", "1", rq.ANSWERED, "done") in got
    time.sleep(2)
    put("in", {"key": "k", "request_id": "2", "value": "a"}, {"key": "new", "request_id": "7", "value": "c"})
    got += step(1500, 60_000)
    # A run is given up in the first batch after its time, whatever that brings.
    assert ("k", "2", rq.RUN, "a") in got and got.count(("s", "5", rq.GIVEN_UP, None)) == 1
    put("in", {"key": "s", "request_id": "6", "value": "b"})
    assert ("s", "6", rq.RUN, "b") in step(60_000, 60_000)


def test_served_end_to_end(spark, tmp_path):
    for name in ("in", "out"):
        (tmp_path / name).mkdir()
    root, ran = f"file://{tmp_path}", []

    def run(due):
        ran.extend(r.request_id for r in due.collect())
        return due.withColumn("value", F.upper("value")).withColumn("ok", F.lit(True))

    def step():
        asked = spark.readStream.schema(REQUEST).json(f"{root}/in")
        given = spark.readStream.schema(REQUEST + ", ok boolean").option("recursiveFileLookup", "true").json(f"{root}/out")
        rq.serve(asked, given, run, f"{root}/out", f"{root}/said", f"{root}/cp").awaitTermination()

    for i in range(2):
        (tmp_path / "in" / f"{i}.json").write_text(json.dumps({"key": "k", "request_id": str(i), "timestamp": "2024-01-01T00:00:00", "value": "a"}))
        step()
        step()
    said = {(r.request_id, r.decision, r.value) for r in spark.read.json(f"{root}/said").collect()}
    assert ran == ["0"] and said == {("0", rq.RUN, "a"), ("0", rq.ANSWERED, "A"), ("1", rq.STORED, "A")}
