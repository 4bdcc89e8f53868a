"""The registered queries of this subpackage and their SQL, where SQL can
express them. Each thin query derives the contract's columns from what the
operator returns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import divergence, line_dedup, mixing, neardup_text, neardup_vectors, periodic, pieces, pii, quality, secrets, substring_dedup, suffix_dedup, warc
from .common import WORD, Workspace, table


def op1_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Workspace(spark, "warc").path("archive")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.read_records(spark, path).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", F.length("header").cast("long").alias("header_bytes")
    )


def op2_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup_vectors.link(table(spark, sf_dir, "embeddings"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode(docs, check=True).select(
        "doc_id", F.coalesce(F.size("token_ids"), F.lit(0)).cast("long").alias("n_tokens"), F.xxhash64("token_ids").alias("ids_hash"), "round_trip"
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.find_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.find_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup_text.link(table(spark, sf_dir, "documents"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.sample(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != secrets.INFERRED)
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in secrets.KINDS),
        F.sha2(text(base), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )


def pii_columns(found: DataFrame) -> DataFrame:
    """Counts, digest and list of spans."""
    kinds = [k.name for k in pii.BASE]
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in kinds),
        F.sha2(text(F.filter("spans", lambda s: s["kind"].isin(kinds))), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_columns(pii.find(table(spark, sf_dir, "documents")))


def planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with the periods that the contract plants: of documents
    whose id's checksum ends in 0, the words from one on repeat the first of them."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), 0))
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("w")).withColumn("n", F.size("w"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n"))).withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")
    text = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("w", place(i))), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


def run_columns(found: DataFrame) -> DataFrame:
    """The run of greatest exponent and digests of what :func:`periodic.find_runs` tells."""
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    best = found.withColumn("best", periodic.greatest(F.col("runs")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        "collapsed_sha256",
        "n_words",
        "n_dropped",
    )


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_columns(periodic.find_runs(planted_periods(table(spark, sf_dir, "documents"))))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_warc_archive": op1_warc_archive,
    "op2_embedding_neardup": op2_embedding_neardup,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_line_dedup": op4_line_dedup,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_quality_rules": op7_quality_rules,
    "op8_minhash_neardup": op8_minhash_neardup,
    "op9_source_mixing": op9_source_mixing,
    "op10_secret_scan": op10_secret_scan,
    "op11_pii": op11_pii,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_source_divergence": op13_source_divergence,
}
ORACLES: dict[str, str] = {"op9_source_mixing": mixing.oracle(), "op11_pii": pii.oracle(), "op13_source_divergence": divergence.oracle()}
