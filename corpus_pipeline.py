"""A training corpus from raw documents: five stages, each an operator of
``inspectra.llm`` applied to all that its predecessor kept.

All stages but the last return the columns of ``documents``; the last returns
token ids.  Every stage takes null and empty texts, very long ones, repeated rows,
empty tables and further columns of any names; each says what becomes of them.  A stage's output is written as Parquet in the shared folder and read
again, so a lost executor repeats one stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inspectra.llm import line_dedup, mixing, neardup_text, pieces, quality
from inspectra.llm.common import Workspace, table
from inspectra.session import ship


#: Similarity, in a hundred, from which the pipeline takes texts as near-duplicates;
#: op8 keeps its own 85.
SIMILAR = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the isolation forest. Null, empty
    and short texts fail the base rules and go; repeated rows are judged alike;
    without labels the base rules alone decide; columns stay as they are."""
    ship(spark)
    return quality.filter_documents(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines of recurring templates; every row stays, null
    texts stay null, a text that loses every line becomes empty, ``n_chars``
    follows; rows with a null id keep their lines."""
    ship(spark)
    return line_dedup.drop_lines(docs, length_col="n_chars")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of every group of near-duplicates. Texts without
    words and rows with a null id are in no group and stay; rows that repeat a
    kept id all stay."""
    ship(spark)
    gone = neardup_text.link(docs, percent=SIMILAR).where("not kept").select("doc_id").distinct()
    return docs.join(gone.hint("merge"), "doc_id", "left_anti").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose token shares follow the raked targets. Texts without words
    are never drawn; null sources and languages are categories of their own; rows
    that repeat an id are drawn together."""
    return mixing.filter_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents that are left. They are decoded again, and a
    text that does not come back is an error. A null text has null ids and no
    tokens."""
    ship(spark)
    coded = pieces.encode(docs.select("doc_id", "source", "lang", "text"), check=True)
    wrong = F.raise_error(F.concat(F.lit("decoding does not give the text of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    coded = coded.withColumn("token_ids", F.when(F.col("round_trip"), F.col("token_ids")).otherwise(wrong.cast("array<int>")))
    return coded.select("doc_id", "source", "lang", F.coalesce(F.size("token_ids"), F.lit(0)).cast("long").alias("n_tokens"), "token_ids")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", lines),
    ("MinHash near-dedup", near_duplicates),
    ("mixing", mix),
    ("SentencePiece", tokens),
]
#: SQL has no isolation forest, near-duplicate components or BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        nxt = ws.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        ws.drop(docs)
        docs = nxt
    return docs
