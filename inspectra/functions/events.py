"""Decoding, encoding and routing of event messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import FALLBACK_TYPE

INFERENCE = "event string, bucket string, object_key string, content_type string, size_bytes long, created_at string"
TRAIN = "event string, model string, images string"
DEMO = "event string, data string"
_REQUIRED = ("event", "bucket", "object_key", "created_at")


def decode_inference(df: DataFrame, value: str = "value") -> DataFrame:
    """Adds the payload's fields with their defaults and ``error``: null for a
    good message, else what is wrong with it."""
    p = F.from_json(F.col(value), INFERENCE)
    out = df.withColumn("_p", p)
    missing = F.filter(F.array(*(F.when(F.col(f"_p.{c}").isNull(), F.lit(c)) for c in _REQUIRED)), lambda x: x.isNotNull())
    created = F.try_to_timestamp(F.col("_p.created_at"))
    return out.select(
        *df.columns,
        F.col("_p.event").alias("event"),
        F.col("_p.bucket").alias("bucket"),
        F.col("_p.object_key").alias("object_key"),
        F.coalesce("_p.content_type", F.lit(FALLBACK_TYPE)).alias("content_type"),
        F.coalesce("_p.size_bytes", F.lit(0)).cast("long").alias("size_bytes"),
        created.alias("created_at"),
        F.when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ", "))).when(created.isNull(), "bad created_at").alias("error"),
    )


def encode_inference() -> Column:
    """JSON text of an inference event from columns of the same names."""
    return F.to_json(
        F.struct("event", "bucket", "object_key", "content_type", "size_bytes", F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"))
    )


def decode_train(df: DataFrame, value: str = "value") -> DataFrame:
    from .keys import image_path

    p = F.from_json(F.col(value), TRAIN)
    path = image_path(p["images"])
    return df.select(
        "*",
        p["event"].alias("event"),
        p["model"].alias("model"),
        path["bucket"].alias("bucket"),
        path["object_key"].alias("object_key"),
        F.when(p["event"].isNull() | path.isNull(), "bad message").alias("error"),
    )


def encode_train(model: Column, bucket: Column, key: Column) -> Column:
    return F.to_json(F.struct(F.lit("train").alias("event"), model.alias("model"), F.concat(F.lit("/"), bucket, F.lit("/"), key).alias("images")))


def route(df: DataFrame, event: str) -> tuple[DataFrame, DataFrame]:
    """Messages of one event type, and the rest (skipped, or in quarantine)."""
    mine = F.coalesce(F.col("event") == event, F.lit(False)) & F.col("error").isNull()
    return df.where(mine), df.where(~mine)


def messages(kafka: DataFrame) -> DataFrame:
    """Text key and value of Kafka rows, with the time they were read."""
    return kafka.select(
        "topic", "partition", "offset", "timestamp", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), F.current_timestamp().alias("ingested_at")
    )


def project_demo(df: DataFrame, value: str = "value") -> DataFrame:
    p = F.from_json(F.col(value), DEMO)
    return df.select("*", p["event"].alias("event"), p["data"].alias("data"))
