"""Model registry: which version is newest, which comes next, registering."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..functions.keys import semver

SCHEMA = "model_id string, model_type string, bucket string, major_version int, minor_version int, patch_version int, is_valid boolean, created_at timestamp"
_VERSION = ("major_version", "minor_version", "patch_version")


def latest_by_type(registry: DataFrame) -> DataFrame:
    """The newest valid version of every type; versions compare as numbers, and
    of rows with one version the greatest model_id counts."""
    best = F.max_by(F.struct("model_id", "bucket", *_VERSION), F.struct(*_VERSION, "model_id"))
    return registry.where("is_valid").groupBy("model_type").agg(best.alias("b")).select("model_type", "b.*", semver(*(F.col(f"b.{v}") for v in _VERSION)).alias("version"))


def latest(registry: DataFrame, model_type: str) -> Row:
    """The newest valid version of a type; LookupError if there is none."""
    rows = (
        registry.where((F.col("model_type") == model_type.lower()) & F.col("is_valid"))
        .orderBy(*(F.col(c).desc() for c in (*_VERSION, "model_id")))
        .limit(1)
        .withColumn("version", semver(*map(F.col, _VERSION)))
        .collect()
    )
    if not rows:
        raise LookupError(f"no valid version of {model_type!r}")
    return rows[0]


def next_patches(registry: DataFrame) -> DataFrame:
    """The next patch number of every (type, major, minor), valid or not."""
    return registry.groupBy("model_type", "major_version", "minor_version").agg((F.max("patch_version") + 1).alias("next_patch"))


def next_version(registry: DataFrame, base: Row) -> tuple[int, int, int]:
    """Version that a retrain of ``base`` gets."""
    top = registry.where(
        (F.col("model_type") == base.model_type) & (F.col("major_version") == base.major_version) & (F.col("minor_version") == base.minor_version)
    ).agg(F.max("patch_version").alias("p")).first()
    return base.major_version, base.minor_version, (base.patch_version if top.p is None else top.p) + 1


class ModelFactory:
    """Builders of models by type; the plug-in surface of the engine."""

    def __init__(self):
        self._builders = {}

    def register(self, model_type: str, builder) -> None:
        self._builders[model_type.lower()] = builder

    def create(self, registry: DataFrame, model_type: str):
        """A model of the newest valid version; unknown types raise ValueError."""
        builder = self._builders.get(model_type.lower())
        if builder is None:
            raise ValueError(f"unknown model type {model_type!r}; known: {sorted(self._builders)}")
        return builder(latest(registry, model_type))

    def create_optional(self, registry: DataFrame, model_type: str):
        """Like create, but None where no valid version is registered."""
        try:
            return self.create(registry, model_type)
        except LookupError:
            return None
