"""Streams over file sources, run to the end twice."""

import json

from pyspark.sql import functions as F

from inspectra.functions.verdict import SHIPPED_LOWER, SHIPPED_UPPER
from inspectra.sources import images
from inspectra.streaming import flows


def envelope(offset, value):
    return json.dumps({"topic": "events", "partition": 0, "offset": offset, "timestamp": "2024-01-01T00:00:00", "key": str(offset), "value": value})


def event(i, **more):
    return json.dumps({"event": "inference", "bucket": "images", "object_key": f"img-{i}.png", "created_at": "2024-01-02T03:04:05", **more})


def test_inference_quarantine_and_redelivery(spark, tmp_path):
    box = tmp_path / "in"
    box.mkdir()
    lines = [envelope(i, event(i)) for i in range(6)] + [envelope(6, "notjson"), envelope(7, json.dumps({"event": "train"})), envelope(1, event(1))]
    (box / "a.json").write_text("\n".join(lines))
    root = f"file://{tmp_path}"

    def score(df):
        n = F.regexp_extract("object_key", r"(\d+)", 1).cast("int")
        return df.withColumn("anomaly_score", F.when(n < 5, n * 6.0))

    def broken(df):
        raise RuntimeError("second model")

    def start(second):
        flows.inference(flows.files(spark, f"{root}/in"), score, (SHIPPED_LOWER, SHIPPED_UPPER), "m3", f"{root}/res", f"{root}/bad", f"{root}/cp", second, f"{root}/cl").awaitTermination()

    start(broken)
    (box / "b.json").write_text(envelope(2, event(2)))
    start(None)
    got = {r.object_key: r.status for r in spark.read.parquet(f"{root}/res").collect()}
    assert got == {"img-0.png": "normal", "img-1.png": "normal", "img-2.png": "normal", "img-3.png": "anomaly", "img-4.png": "anomaly"}
    assert spark.read.parquet(f"{root}/res").count() == 5
    errors = sorted(r.error for r in spark.read.json(f"{root}/bad").collect())
    assert len(errors) == 3 and errors[-1] == "no score"
    assert "second model" in spark.read.json(f"{root}/bad-second").first().error


def test_ingest_takes_a_file_once(spark, tmp_path):
    box = tmp_path / "files"
    box.mkdir()
    (box / "a.png").write_bytes(b"one")
    (box / "b.txt").write_bytes(b"no")
    root = f"file://{tmp_path}"
    for _ in range(2):
        flows.ingest(images.scan_stream(spark, f"{root}/files"), f"{root}/objects", f"{root}/images", f"{root}/out", f"{root}/letters", f"{root}/cp").awaitTermination()
    row = spark.read.parquet(f"{root}/images").collect()
    assert len(row) == 1 and row[0].size_bytes == 3
    value = json.loads(spark.read.parquet(f"{root}/out").first().value)
    assert value["event"] == "inference" and value["object_key"] == row[0].object_key


def test_training_hands_on_train_events(spark, tmp_path):
    box = tmp_path / "in"
    box.mkdir()
    (box / "a.json").write_text("\n".join([envelope(0, '{"event":"train","model":"patchcore","images":"/b/k"}'), envelope(1, event(1)), envelope(2, "x")]))
    root, seen = f"file://{tmp_path}", []
    flows.training(flows.files(spark, f"{root}/in"), lambda df: seen.extend(r.object_key for r in df.collect()), f"{root}/bad", f"{root}/cp").awaitTermination()
    assert seen == ["k"]


def test_demo_and_idempotency(spark, tmp_path):
    box = tmp_path / "in"
    box.mkdir()
    (box / "a.json").write_text("\n".join(envelope(i % 2, json.dumps({"event": "e", "data": "an Alert" if i else None})) for i in range(4)))
    root = f"file://{tmp_path}"
    stream = flows.demo(flows.deduplicated(flows.files(spark, f"{root}/in")))
    q = stream.writeStream.format("memory").queryName("demo_out").option("checkpointLocation", f"{root}/cp").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("demo_out").count() == 2


def test_connectivity(spark):
    assert spark.createDataFrame([(i,) for i in range(1, 6)], "x int").agg(F.sum("x")).first()[0] == 15
