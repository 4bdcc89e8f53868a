"""Writes: keyed inserts, dead letters, event tables, folder manifests."""

from __future__ import annotations

import mimetypes
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.keys import FALLBACK_TYPE, basename
from .images import _exists


def read_or_empty(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path) if _exists(spark, path) else spark.createDataFrame([], like.schema)


def new_rows(rows: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not stored yet, one for each key (the least row)."""
    one = Window.partitionBy(key).orderBy(*[c for c in rows.columns if c != key])
    fresh = rows.where(F.col(key).isNotNull()).withColumn("_rn", F.row_number().over(one)).where("_rn = 1").drop("_rn")
    return fresh.join(stored.select(key), key, "left_anti").select(*rows.columns)


#: Folders that a keyed table is cut into by a hash of its key.
BUCKET = "_bucket"


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def stored_keys(rows: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """The stored keys of the buckets that ``rows`` touch; the others' folders are
    not read."""
    touched = [r[0] for r in rows.select(_bucket(key, buckets)).distinct().collect()]
    stored = rows.sparkSession.read.schema(f"`{key}` {rows.schema[key].dataType.simpleString()}, {BUCKET} int").parquet(path)
    return stored.where(F.col(BUCKET).isin(touched)).select(key)


def insert_if_absent(rows: DataFrame, path: str, key: str, buckets: int | None = None) -> None:
    """Append the rows whose key the table lacks. Meant for one writer a table;
    a repeated call with the same rows adds nothing.

    With ``buckets`` the table is laid out by a hash of its key (in a further
    column, ``_bucket``), and only the keys of the buckets that the rows touch are
    read and met. A table keeps the number of buckets that it began with."""
    spark = rows.sparkSession
    if buckets is None:
        new_rows(rows, read_or_empty(spark, path, rows), key).write.mode("append").parquet(path)
        return
    stored = stored_keys(rows, path, key, buckets) if _exists(spark, path) else spark.createDataFrame([], rows.schema)
    fresh = new_rows(rows, stored, key).withColumn(BUCKET, _bucket(key, buckets))
    fresh.repartition(BUCKET).write.mode("append").partitionBy(BUCKET).parquet(path)


#: Bytes of a stored chunk; chunks that a reader fetches at once.
CHUNK, WINDOW = 1 << 20, 16


def put_objects(objects: DataFrame, path: str, chunk: int = CHUNK) -> DataFrame:
    """Store ``bucket, object_key, content_type, content`` as numbered chunks,
    partitioned by bucket (a new bucket is a new partition); returns the rows with
    their sizes. A later object of a key replaces an earlier one for readers."""
    size = F.coalesce(F.length("content").cast("long"), F.lit(0).cast("long"))
    rows = objects.withColumn("size_bytes", size).withColumn("stored_at", F.current_timestamp())
    places = F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.expr(f"(size_bytes - 1) div {chunk}")))
    parts = rows.withColumn("chunk", F.explode(places))
    part = F.coalesce(F.col("content").substr((F.col("chunk") * chunk + 1).cast("int"), F.lit(chunk)), F.lit(b""))
    parts = parts.select("bucket", "object_key", "content_type", "size_bytes", "stored_at", "chunk", part.alias("content"))
    parts.sortWithinPartitions("bucket", "object_key", "chunk").write.mode("append").option("parquet.block.size", 16 * chunk).partitionBy("bucket").parquet(path)
    return rows.select("bucket", "object_key", "content_type", "size_bytes")


def _object(spark: SparkSession, path: str, bucket: str, key: str, allowed: tuple[str, ...]) -> tuple[DataFrame, int]:
    """The chunks of the newest object of a key, and their number. The bucket prunes
    partitions, key and chunk are pushed to the scan."""
    if bucket not in allowed:
        raise PermissionError(bucket)
    rows = spark.read.parquet(path).where((F.col("bucket") == bucket) & (F.col("object_key") == key))
    newest = rows.agg(F.max("stored_at").alias("at")).first()["at"]
    if newest is None:
        raise KeyError(key)
    rows = rows.where(F.col("stored_at") == newest)
    return rows, rows.agg(F.max("chunk")).first()[0] + 1


def get_object(spark: SparkSession, path: str, bucket: str, key: str, allowed: tuple[str, ...] = ("images",)) -> bytes:
    """An object's bytes: PermissionError for other buckets, KeyError if absent."""
    return b"".join(stream_object(spark, path, bucket, key, allowed, None)[1])


def stream_object(spark: SparkSession, path: str, bucket: str, key: str, allowed: tuple[str, ...] = ("images",), chunk: int | None = 32 * 1024) -> tuple[str, Iterator[bytes]]:
    """An object's media type, by the key's suffix, and its bytes in pieces of
    ``chunk`` (None: as they are stored); the errors are those of :func:`get_object`
    and come before the first piece. ``WINDOW`` stored chunks are fetched at once, so
    a reader holds that much of an object of any size."""
    rows, n = _object(spark, path, bucket, key, allowed)

    def stored() -> Iterator[bytes]:
        for first in range(0, n, WINDOW):
            part = rows.where(F.col("chunk").between(first, first + WINDOW - 1)).dropDuplicates(["chunk"]).orderBy("chunk")
            yield from (bytes(r.content) for r in part.select("content").collect())

    def pieces() -> Iterator[bytes]:
        left = b""
        for content in stored():
            left += content
            whole = len(left) // chunk * chunk
            yield from (left[i : i + chunk] for i in range(0, whole, chunk))
            left = left[whole:]
        if left:
            yield left

    return mimetypes.guess_type(key)[0] or FALLBACK_TYPE, stored() if chunk is None else pieces()


def dead_letter(rows: DataFrame, path: str, batch: int | None = None) -> None:
    """Messages that could not be handled, as JSON lines. With the number of a
    stream's batch, a batch that runs again replaces its own letters; such a path
    belongs to one checkpoint."""
    if batch is None:
        rows.write.mode("append").json(path)
    else:
        rows.write.mode("overwrite").json(f"{path}/batch={batch}")


def as_kafka(events: DataFrame, key: Column, value: Column) -> DataFrame:
    """Rows in the shape that the Kafka sink takes."""
    return events.select(key.cast("string").alias("key"), value.alias("value"))


def publish(events: DataFrame, servers: str, topic: str) -> None:
    events.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).option("kafka.acks", "all").option("kafka.retries", "3").save()


def cluster_manifest(rows: DataFrame, path: str = "path", label: str = "label", cluster: str = "cluster") -> DataFrame:
    """Source and target of each image of a folder export by cluster."""
    folder = F.when(F.col(cluster) == -1, F.lit("noise")).otherwise(F.concat(F.lit("cluster"), F.col(cluster)))
    return rows.select(F.col(path).alias("src"), F.concat_ws("/", folder, F.concat_ws("_", F.col(label), basename(F.col(path)))).alias("dst"))


def write_files(rows: DataFrame, root: str, name: str = "name", content: str = "content") -> DataFrame:
    """Write each row's bytes as a file of its name below ``root`` (a local path or
    any URI that Arrow's file systems open), in the tasks; returns ``name, bytes,
    error``. A file gets its name when it is whole, so a task that runs again
    replaces what it wrote; a file that fails is a row with its error."""

    def run(batches):
        import pyarrow as pa
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)
        for b in batches:
            names, sizes, errors = b.column(0).to_pylist(), [], []
            for at, data in zip(names, b.column(1).to_pylist()):
                try:
                    if not at or data is None:
                        raise ValueError("no name or no content")
                    if ".." in at.split("/"):
                        raise ValueError(f"{at} leaves the folder")
                    to = f"{base.rstrip('/')}/{at}"
                    store.create_dir(to.rsplit("/", 1)[0], recursive=True)
                    part = f"{to}.{uuid.uuid4().hex}.part"
                    with store.open_output_stream(part) as f:
                        f.write(data)
                    store.move(part, to)
                    sizes.append(len(data))
                    errors.append(None)
                except (OSError, ValueError) as e:
                    sizes.append(None)
                    errors.append(f"{type(e).__name__}: {e}"[:200])
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64()), pa.array(errors, pa.string())], ["name", "bytes", "error"])

    return rows.select(F.col(name).alias("name"), F.col(content).alias("content")).mapInArrow(run, "name string, bytes long, error string")


def export_clusters(files: DataFrame, rows: DataFrame, target: str, report: str, path: str = "path", label: str = "label", cluster: str = "cluster") -> dict[str, int]:
    """Copy images into a folder for each cluster: ``files`` (``path, content``)
    meet the manifest of ``rows`` and become real files under the manifest's names
    below ``target``. What became of each is written to ``report`` (``name, bytes,
    error``); returns how many were ``written``, ``failed`` and, for want of a file,
    ``absent``. Of images whose folder, label and name are equal the one of
    greatest path is written."""
    spark = rows.sparkSession
    to = cluster_manifest(rows, path, label, cluster)
    moved = to.join(files.select(F.col("path").alias("src"), "content"), "src", "left")
    newest = Window.partitionBy("dst").orderBy(F.desc("src"))
    there = moved.where("content is not null").withColumn("_rn", F.row_number().over(newest)).where("_rn = 1")
    write_files(there, target, "dst").write.mode("overwrite").parquet(report)
    done = spark.read.parquet(report).agg(F.count("bytes").alias("written"), F.count("error").alias("failed")).first()
    return {"written": done.written, "failed": done.failed, "absent": moved.where("content is null").count()}
