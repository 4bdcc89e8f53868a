"""Streams: ingest, inference and training as Structured Streaming queries.

File sources and ``availableNow`` stand in for Kafka where there is no broker;
:func:`kafka` is the same stream from one.  Tables are written by key and retrains
are registered with their event, so a batch that runs again after a failure writes
nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import events as ev
from ..functions.keys import event_key, heatmap_key, stem
from ..functions.verdict import classify, keyword_predict
from ..sources import sinks

ENVELOPE = "topic string, partition int, offset long, timestamp timestamp, key string, value string"


def kafka(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """From the earliest offset; the checkpoint holds what was done."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", "earliest").option("failOnDataLoss", "false").load()
    return ev.messages(raw)


def files(spark: SparkSession, folder: str) -> DataFrame:
    """Messages as JSON lines of the envelope."""
    return spark.readStream.schema(ENVELOPE).json(folder)


def _start(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, once: bool, seconds: int) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{seconds} seconds")).start()


def ingest(files_: DataFrame, objects: str, images: str, outbox: str, letters: str, checkpoint: str, bucket: str = "images", once: bool = True, seconds: int = 5) -> StreamingQuery:
    """Image files to objects, image rows and inference events, in this order:
    an image's row is there before its event. If the event cannot be written it
    is kept as a dead letter and the batch fails, to run again."""

    def each(batch: DataFrame, number: int) -> None:
        key = F.concat(F.substring(F.sha2(F.col("content"), 256), 1, 32), F.lit("."), F.element_at(F.split("path", r"\."), -1))
        rows = batch.select(F.lit(bucket).alias("bucket"), key.alias("object_key"), "content_type", "content", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("created_at")).persist()
        try:
            sinks.insert_if_absent(rows.select("bucket", "object_key", "content_type", "content"), objects, "object_key")
            sinks.insert_if_absent(rows.select(stem(F.col("object_key")).alias("image_id"), "object_key", "bucket", "content_type", "size_bytes", "created_at"), images, "image_id")
            out = rows.withColumn("event", F.lit("inference")).select(stem(F.col("object_key")).alias("image_id"), ev.encode_inference().alias("value"), F.col("event").alias("key"))
            try:
                sinks.insert_if_absent(out, outbox, "image_id")
            except Exception as e:
                try:
                    sinks.dead_letter(out, letters, number)
                except Exception as second:  # noqa: BLE001  the first error is the one to see
                    e.add_note(f"the dead letters were not written: {second}")
                raise
        finally:
            rows.unpersist()

    return _start(files_, each, checkpoint, once, seconds)


def inference(messages: DataFrame, score: Callable[[DataFrame], DataFrame], band: tuple[float, float], model_id: str, results: str, quarantine: str, checkpoint: str, second: Callable[[DataFrame], DataFrame] | None = None, clusters: str | None = None, once: bool = True, seconds: int = 5) -> StreamingQuery:
    """Decode, score, classify and store inference events.  ``score`` adds
    ``anomaly_score``; bad messages and images without a score go to quarantine.
    The optional second model writes its own table after the first's rows are
    safe, and its failure is noted there without touching them."""

    def each(batch: DataFrame, number: int) -> None:
        decoded = ev.decode_inference(batch).persist()
        try:
            mine, rest = ev.route(decoded, "inference")
            bad = rest.where("error is not null").select("topic", "partition", "offset", "value", "error")
            rows = score(mine).persist()
            lost = rows.where("anomaly_score is null").select("topic", "partition", "offset", "value", F.lit("no score").alias("error"))
            sinks.dead_letter(bad.unionAll(lost), quarantine, number)
            done = rows.where("anomaly_score is not null").select(
                event_key(F.col("topic"), F.col("partition"), F.col("offset")).alias("event_id"),
                stem(F.col("object_key")).alias("image_id"),
                F.lit(model_id).alias("model_id"),
                "object_key",
                "bucket",
                "anomaly_score",
                classify(F.col("anomaly_score"), F.lit(band[0]), F.lit(band[1])).alias("status"),
                heatmap_key(F.col("object_key")).alias("heatmap_key"),
                F.current_timestamp().alias("inferred_at"),
            )
            sinks.insert_if_absent(done, results, "event_id")
            if second is not None and clusters is not None:
                try:
                    sinks.insert_if_absent(second(rows), clusters, "event_id")
                except Exception as e:  # noqa: BLE001  never fails the primary rows
                    note = batch.sparkSession.createDataFrame([(number, f"{type(e).__name__}: {e}"[:300])], "batch long, error string")
                    sinks.dead_letter(note, f"{quarantine}-second", number)
            rows.unpersist()
        finally:
            decoded.unpersist()

    return _start(messages, each, checkpoint, once, seconds)


def training(messages: DataFrame, retrain: Callable[[DataFrame], None], quarantine: str, checkpoint: str, once: bool = True, seconds: int = 5) -> StreamingQuery:
    """Hand each batch's train events to ``retrain``; others are skipped, bad
    ones go to quarantine. A batch that failed is handed on again;
    :func:`inspectra.plans.retrain.retrain_events` then does what is left of it."""

    def each(batch: DataFrame, number: int) -> None:
        decoded = ev.decode_train(batch)
        mine, rest = ev.route(decoded, "train")
        sinks.dead_letter(rest.where("error is not null").select("value", "error"), quarantine, number)
        if not mine.isEmpty():
            retrain(mine)

    return _start(messages, each, checkpoint, once, seconds)


def deduplicated(messages: DataFrame, key: str = "key", delay: str = "10 minutes") -> DataFrame:
    """Requests by idempotency key, repeats within the delay dropped."""
    return messages.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark([key])


def demo(messages: DataFrame) -> DataFrame:
    """Parsed messages with the keyword prediction."""
    return ev.project_demo(messages).withColumn("prediction", keyword_predict(F.col("data")))


def to_console(stream: DataFrame, checkpoint: str, seconds: int = 5) -> StreamingQuery:
    return stream.writeStream.format("console").outputMode("append").option("truncate", "false").option("numRows", 50).option("checkpointLocation", checkpoint).trigger(processingTime=f"{seconds} seconds").start()
