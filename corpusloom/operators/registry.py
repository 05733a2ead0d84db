"""Datasets, versions, registry documents and freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions.dates import age_in_days
from corpusloom.functions.versions import version_key
from corpusloom.schemas import DATASET_META, REGISTRY

STALE_AFTER_DAYS = 7


def list_datasets(manifests: DataFrame) -> DataFrame:
    return manifests.select("dataset").distinct()


def list_versions(manifests: DataFrame, dataset: str | None = None) -> DataFrame:
    """Versions, newest first by their numbers; of one dataset or of all."""
    if dataset is not None:
        manifests = manifests.where(F.col("dataset") == dataset)
    return manifests.select("dataset", "version").distinct().orderBy("dataset", version_key("version").desc())


def latest_versions(manifests: DataFrame) -> DataFrame:
    """The newest version per dataset; a partial aggregate over (dataset, version) rows."""
    return manifests.groupBy("dataset").agg(F.max_by("version", version_key("version")).alias("version"))


def build_registry(manifests: DataFrame) -> DataFrame:
    """Registry rows from manifests ``(dataset, version, row_count, created_at)``: current version and history size."""
    newest = F.max_by(F.struct("version", "row_count", "created_at"), version_key("version")).alias("_n")
    rows = manifests.groupBy("dataset").agg(newest, F.countDistinct("version").alias("versions"))
    return rows.select(
        F.col("dataset").alias("name"), F.col("_n.version").alias("current_version"),
        F.col("_n.row_count").alias("record_count"), F.col("_n.created_at").alias("updated_at"), "versions",
    )


def registry_datasets(documents: DataFrame, json: str = "value") -> DataFrame:
    """One row per dataset listed in registry JSON documents."""
    parsed = documents.select(F.from_json(json, REGISTRY).alias("r"))
    return parsed.select(F.col("r.version").alias("registry_version"), F.inline("r.datasets"))


def dataset_metadata(documents: DataFrame, json: str = "value") -> DataFrame:
    """Dataset metadata JSON documents as typed rows."""
    return documents.select(F.from_json(json, DATASET_META).alias("m")).select("m.*")


def version_history(metadata: DataFrame) -> DataFrame:
    """One row per version of each metadata document, with a flag for the current one."""
    current = F.col("versioning.current")
    rows = metadata.select("name", current.alias("current"), F.inline("versioning.versions"))
    return rows.withColumn("is_current", F.col("version") == F.col("current"))


def dataset_health(registry: DataFrame, manifests: DataFrame, as_of: Column) -> DataFrame:
    """Age and status of the current version of each dataset.

    A current version without manifest stays visible as ``missing``.
    """
    stamped = manifests.groupBy("dataset", "version").agg(F.max("created_at").alias("last_modified"))
    joined = registry.select(F.col("name").alias("dataset"), F.col("current_version").alias("version")).join(
        stamped, ["dataset", "version"], "left"
    )
    age = age_in_days("last_modified", as_of)
    status = F.when(age.isNull(), "missing").when(age < STALE_AFTER_DAYS, "healthy").otherwise("stale")
    return joined.select("dataset", "version", "last_modified", age.alias("age_days"), status.alias("status"))
