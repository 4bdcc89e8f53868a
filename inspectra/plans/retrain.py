"""The whole retrain as one batch job."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.events import encode_train
from ..functions.keys import event_key
from ..operators import registry as reg
from ..operators.results import recent_good, retrain_candidates
from ..operators.vectors import append_bank, calibrate, coreset, image_scores, nearest
from ..sources import assets, sinks


@dataclass
class Candidate:
    """A new version: its bank, band and registry row (not yet valid)."""

    version: tuple[int, int, int]
    bank: DataFrame
    band: DataFrame
    row: DataFrame
    base: str


def retrain(registry: DataFrame, results: DataFrame, bank: DataFrame, new_patches: DataFrame, validation_patches: DataFrame, previous: tuple[float, float], model_type: str, n_recent: int = 200) -> Candidate:
    """Newest version, coreset of the new image's patches, appended bank, scores
    of the recent good images, percentile band, next version; registering comes
    last and makes a candidate only.

    ``new_patches`` and ``validation_patches`` have ``image_id, patch_idx, vec``;
    images of the validation set without patches are left out.
    """
    spark = registry.sparkSession
    base = reg.latest(registry, model_type)
    added = coreset(new_patches, F.xxhash64(F.lit(42), "patch_idx"))
    grown = append_bank(bank.select("vec"), added.select("vec"))
    good = recent_good(results, registry, model_type, n_recent).select("image_id").distinct()
    scored = nearest(validation_patches.join(good, "image_id", "left_semi"), grown, ["image_id", "patch_idx"])
    band = calibrate(image_scores(scored), previous)
    version = reg.next_version(registry, base)
    name = ".".join(map(str, version))
    row = spark.createDataFrame([(f"{model_type}-{name}", model_type, base.bucket, *version, False)], "model_id string, model_type string, bucket string, major_version int, minor_version int, patch_version int, is_valid boolean")
    return Candidate(version, grown, band, row, base.version)


def commit(candidate: Candidate, root: str, registry_path: str, unchanged: Iterable[str] = (), source: str | None = None) -> str:
    """Store a candidate and return its version: bank, band and the assets that
    stay as in the base version go under its version, and the registry row comes
    last, so a registered version is whole; with it goes ``source_event``, the event
    that asked for it. What a run that failed left under an unregistered version is
    replaced; a registered one is never written again (ValueError). Meant for one
    retrain of a type at a time."""
    spark, row = candidate.row.sparkSession, candidate.row.first()
    version = ".".join(map(str, candidate.version))
    stored = sinks.read_or_empty(spark, registry_path, candidate.row)
    if not stored.where(F.col("model_id") == row.model_id).isEmpty():
        raise ValueError(f"{row.model_id} is registered already")
    assets.write_bank(candidate.bank, root, row.model_type, version, "overwrite")
    band = candidate.band.first()
    assets.write_band(spark, root, row.model_type, version, band.lower, band.upper, "overwrite")
    assets.copy_assets(spark, root, row.model_type, candidate.base, version, unchanged, replace=True)
    sinks.insert_if_absent(candidate.row.withColumn("created_at", F.current_timestamp()).withColumn("source_event", F.lit(source).cast("string")), registry_path, "model_id")
    return version


def registered_events(spark: SparkSession, registry_path: str) -> DataFrame:
    """Ids of the events whose candidates are registered."""
    like = spark.createDataFrame([], "source_event string")
    return sinks.read_or_empty(spark, registry_path, like).where("source_event is not null").distinct()


def retrain_events(events: DataFrame, registry_path: str, root: str, make: Callable[[Row, DataFrame], Candidate], unchanged: Iterable[str] = ()) -> dict[str, str]:
    """Retrain once for each train event (``topic, partition, offset`` and what
    ``make`` reads), in the order of their offsets; returns the versions by event id.

    ``make`` gets the event and the registry as it is then. The registry row that
    ends a commit names its event, and events that are named there are left out: a
    batch that stops anywhere, also after a commit and before its stream notes it,
    runs again and registers nothing twice."""
    spark, unchanged, done = events.sparkSession, list(unchanged), {}
    keyed = events.withColumn("source_event", event_key(F.col("topic"), F.col("partition"), F.col("offset"))).dropDuplicates(["source_event"])
    todo = keyed.join(registered_events(spark, registry_path), "source_event", "left_anti").orderBy("topic", "partition", "offset")
    like = spark.createDataFrame([], "model_id string, model_type string, bucket string, major_version int, minor_version int, patch_version int, is_valid boolean")
    for event in todo.toLocalIterator():
        candidate = make(event, sinks.read_or_empty(spark, registry_path, like))
        done[event.source_event] = commit(candidate, root, registry_path, unchanged, event.source_event)
    return done


def train_events(results: DataFrame, registry: DataFrame, event_ids: Iterable[str] | DataFrame) -> DataFrame:
    """One train event for each chosen result that is still pending: ``event_id``
    and the ``key, value`` that :func:`inspectra.sources.sinks.publish` sends."""
    value = encode_train(F.col("model_type"), F.col("bucket"), F.col("object_key"))
    return retrain_candidates(results, registry, event_ids).select("event_id", F.lit("train").alias("key"), value.alias("value"))
