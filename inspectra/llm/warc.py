"""Content-addressed WARC archive.

An archive is a folder of three Parquet tables:

``payloads``  one row per distinct payload: strong digest (SHA-256), bytes;
``headers``   one row per record: id, the exact header block, the payload's
              strong digest, and whether the record is a response;
``info``      format version.

Records are rebuilt by joining the two on the digest and read from their bytes:
what a reader returns comes out of the header block, a response's payload is
hashed again, and a revisit is joined with the record that it names.  A missing
or damaged payload, or a header that says something else, raises.  Payload bytes
cross the network once in writing and once in reading; everything else moves
digests only, so a payload shared by a third of all records stays one row, and
the joins by digest or record are plain ones whose hot keys Spark can split.

Edge cases: a null payload is empty; very long payloads are one value of their
row; payloads shorter than ``min_revisit`` bytes are stored once but each of
their records is a response; equal payloads refer to the record with the smallest
id; rows with a null id are archived as responses that nobody refers to; rows
that repeat an id have record ids of their own, and where they repeat the payload
too, one is the response; a null URL leaves the target header out, and line
breaks in it are percent-encoded; an empty table gives an empty archive; other
columns are never read and may have any names.
"""

from __future__ import annotations

import base64
import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace

VERSION = "WARC/1.1"
#: Payloads of fewer bytes are never revisited.
MIN_REVISIT = 0
#: All records of a batch are written with this date unless a column names one.
DATE = "1970-01-01T00:00:00Z"


def block_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(archive: str, key: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{key}')}>"


def header_block(kind: str, key: str, url: str | None, sha1: str, length: int, refers_to: str | None, date: str) -> bytes:
    """The header lines of one record, ended by the empty line."""
    lines = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id('inspectra', key)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    lines.append(f"WARC-Payload-Digest: sha1:{sha1}")
    if kind == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {record_id('inspectra', refers_to)}")
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {0 if kind == 'revisit' else length}", "", ""]
    return "\r\n".join(lines).encode()


def write_archive(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit: int = MIN_REVISIT
) -> None:
    """Write one record per row of ``pages`` below ``path``."""
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.encode(F.col(payload_col), "UTF-8"), F.lit(b"")).alias("payload"))
    keyed = rows.select("id", F.unhex(F.sha2("payload", 256)).alias("digest"), "payload")

    def digests(batches):
        for b in batches:
            p = [v or b"" for v in b.column("payload").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("url"), pa.array([len(x) for x in p], pa.int64()), pa.array([hashlib.sha256(x).digest() for x in p], pa.binary()), pa.array([block_digest(x) for x in p])],
                ["id", "url", "length", "digest", "sha1"],
            )

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{path}/_{name}")
        return spark.read.parquet(f"{path}/_{name}")

    kind = pages.schema[id_col].dataType.simpleString()
    # The number tells rows apart that repeat an id; it is written, so it stays.
    staged = kept(rows.mapInArrow(digests, f"id {kind}, url string, length long, digest binary, sha1 string").withColumn("row", F.monotonically_increasing_id()), "staged")
    first = staged.where("id is not null").groupBy("digest").agg(F.min(F.struct("id", "row")).alias("f"))
    first = kept(first.select("digest", F.col("f.id").alias("first_id"), F.col("f.row").alias("first_row")), "first")
    nameless = kept(staged.where("id is null").select("digest").distinct().join(first, "digest", "left_anti"), "nameless")
    n_first, n_nameless = first.count(), nameless.count()
    repeats = staged.where("id is not null").groupBy("id", "digest").count().where("count > 1").limit(1).count() > 0

    # Payload bytes move once, to the row that keeps them.
    stored = keyed.where("id is not null").join(first.select(F.col("first_id").alias("id"), "digest"), ["id", "digest"], "left_semi").select("digest", "payload")
    if repeats:
        stored = stored.dropDuplicates(["digest"])
    if n_nameless:
        lonely = keyed.where("id is null").select("digest", "payload").join(nameless, "digest", "left_semi")
        stored = stored.unionAll(lonely.dropDuplicates(["digest"]))
    stored.write.option("compression", "zstd").parquet(f"{path}/payloads")
    if spark.read.parquet(f"{path}/payloads").count() != n_first + n_nameless:
        raise RuntimeError("not every payload was stored once")

    response = F.col("id").isNull() | ((F.col("id") == F.col("first_id")) & (F.col("row") == F.col("first_row"))) | (F.col("length") < min_revisit)
    placed = staged.join(first, "digest", "left").withColumn("record_type", F.when(response, "response").otherwise("revisit"))

    def headers(batches):
        names = ("id", "row", "url", "length", "sha1", "record_type", "first_id", "first_row")
        for b in batches:
            out = [
                header_block(t, f"{i}/{r}", u, s, n, f"{fi}/{fr}", DATE)
                for i, r, u, n, s, t, fi, fr in zip(*(b.column(c).to_pylist() for c in names), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(out, pa.binary()), b.column("digest"), b.column("record_type")], ["id", "header", "digest", "record_type"])

    placed.mapInArrow(headers, f"id {kind}, header binary, digest binary, record_type string").write.option("compression", "zstd").parquet(f"{path}/headers")
    spark.createDataFrame([(VERSION, 1)], "version string, layout int").coalesce(1).write.parquet(f"{path}/info")
    for name in ("staged", "first", "nameless"):
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_{name}")
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _read_back(batches):
    """Records rebuilt from header and payload, and what their bytes say."""
    for b in batches:
        out = {n: [] for n in ("record_id", "payload_bytes", "payload_digest", "record_type", "refers")}
        columns = (b.column(c).to_pylist() for c in ("header", "payload", "digest", "record_type"))
        for header, payload, digest, kind in zip(*columns, strict=True):
            if kind == "response" and payload is None:
                raise ValueError(f"no payload for digest {digest.hex()}")
            if kind == "response" and hashlib.sha256(payload).digest() != digest:
                raise ValueError(f"payload does not match its digest {digest.hex()}")
            fields, content = parse_record(header + (payload if kind == "response" else b"") + b"\r\n\r\n")
            sha1 = fields["WARC-Payload-Digest"].removeprefix("sha1:")
            if fields["WARC-Type"] != kind or (kind == "response" and block_digest(content) != sha1):
                raise ValueError(f"record {fields['WARC-Record-ID']} does not match its header")
            for name, v in zip(out, (fields["WARC-Record-ID"], len(content), sha1, fields["WARC-Type"], fields.get("WARC-Refers-To")), strict=True):
                out[name].append(v)
        kinds = {"payload_bytes": pa.int64()}
        cols = [pa.array(v, kinds.get(k, pa.string())) for k, v in out.items()]
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("header"), *cols], ["id", "header", *out])


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Per record, read from its rebuilt bytes: id, ``payload_bytes``,
    ``payload_digest``, ``record_type``, ``refers_to``, ``header``."""
    heads, stored = spark.read.parquet(f"{path}/headers"), spark.read.parquet(f"{path}/payloads")
    kind = heads.schema["id"].dataType.simpleString()
    shape = f"id {kind}, header binary, record_id string, payload_bytes long, payload_digest string, record_type string, refers string"
    whole = heads.where("record_type = 'response'").join(stored, "digest", "left").select("id", "header", "payload", "digest", "record_type")
    bare = heads.where("record_type <> 'response'").select("id", "header", F.lit(None).cast("binary").alias("payload"), "digest", "record_type")
    ws = Workspace(spark, "records")
    responses = ws.save(whole.mapInArrow(_read_back, shape), "responses")
    theirs = responses.select(F.col("record_id").alias("refers"), F.col("id").alias("refers_to"), F.col("payload_bytes").alias("n"), F.col("payload_digest").alias("sha1"))
    revisits = bare.mapInArrow(_read_back, shape).join(theirs, "refers", "left")
    sound = F.coalesce(F.col("sha1") == F.col("payload_digest"), F.lit(False))
    n = F.when(sound, F.col("n")).otherwise(F.raise_error(F.concat(F.lit("revisit does not match record "), F.coalesce("refers", F.lit("")))).cast("long"))
    out = ("id", "payload_bytes", "payload_digest", "record_type", "refers_to", "header")
    return responses.withColumn("refers_to", F.lit(None).cast(kind)).select(*out).unionAll(revisits.withColumn("payload_bytes", n).select(*out))


def reconstruct(spark: SparkSession, path: str) -> DataFrame:
    """Whole original records: ``id``, ``record`` (header, payload of responses,
    closing line breaks) and the full ``payload`` for revisits too."""
    heads, stored = spark.read.parquet(f"{path}/headers"), spark.read.parquet(f"{path}/payloads")
    payload = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return heads.join(stored, "digest").select("id", "payload", F.concat("header", payload, F.lit(b"\r\n\r\n")).alias("record"))


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and content of one record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"not a record: {lines[0]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    n = int(fields["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("content length does not match")
    return fields, rest[:n]
