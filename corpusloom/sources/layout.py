"""Versioned dataset folders.

``<root>/<table>/dataset=<d>/version=<v>/`` holds the Parquet files of one table of one version. Two folders of JSON lines are only
ever added to: ``<root>/manifest/`` describes each table as it was written (rows, checksum, schema), and
``<root>/release/`` says which tables of which versions readers see. A release of all tables of a version is one line
each in one file, written last, so a version appears whole or not at all. What a failed build left behind is not released:
no listing or ``latest`` finds it, and the next attempt replaces it. What is released never changes; it can only be
deleted. Listings read these lines only and never touch the data.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from corpusloom.functions.digest import fold, row_hash, word_sums
from corpusloom.functions.versions import version_key
from corpusloom.schemas import MANIFEST, RELEASE

COMPRESSIONS = ("zstd", "snappy", "gzip")
RELEASED, DELETED = "released", "deleted"


def version_path(root: str, table: str, dataset: str, version: str) -> str:
    return f"{root}/{table}/dataset={dataset}/version={version}"


def _folder(spark: SparkSession, path: str):
    """Spark's own handle of a folder, whatever store it is in: (file system, path)."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All JSON lines of a folder; none if it does not exist yet."""
    files, where = _folder(spark, path)
    return spark.read.schema(schema).json(path) if files.exists(where) else spark.createDataFrame([], schema)


def releases(spark: SparkSession, root: str) -> DataFrame:
    """What readers see: (dataset, version, table)."""
    last = _lines(spark, f"{root}/release", RELEASE).groupBy("dataset", "version", "table").agg(F.max_by("state", "at").alias("state"))
    return last.where(F.col("state") == RELEASED).drop("state")


def _record(rows: DataFrame, root: str, state: str) -> None:
    """Add lines for (dataset, version, table) rows, all in one file."""
    lines = rows.select("dataset", "version", "table", F.lit(state).alias("state"), F.current_timestamp().alias("at"))
    lines.coalesce(1).write.mode("append").json(f"{root}/release")


def release(spark: SparkSession, root: str, dataset: str, version: str, tables: list[str]) -> None:
    """Show the written tables of a version to readers, all at once (an action)."""
    rows = [(dataset, version, table) for table in tables]
    _record(spark.createDataFrame(rows, "dataset string, version string, table string"), root, RELEASED)


SIDECAR = T.StructType([
    T.StructField(name, kind) for name, kind in (
        ("dataset_name", T.StringType()), ("version", T.StringType()), ("record_count", T.LongType()),
        ("created_at", T.TimestampType()), ("source", T.StringType()), ("license", T.StringType()),
    )
])


def write_sidecar(sidecar: DataFrame, root: str, dataset: str, version: str) -> None:
    """Store the one row that describes a version as JSON beside its tables (an action); that of a failed attempt is replaced."""
    sidecar.coalesce(1).write.mode("overwrite").json(version_path(root, "metadata", dataset, version))


def read_sidecar(spark: SparkSession, root: str, dataset: str, version: str = "latest") -> DataFrame:
    """What :func:`write_sidecar` stored with a version that readers see."""
    version = resolve_version(spark, root, dataset, version)
    return _lines(spark, version_path(root, "metadata", dataset, version), SIDECAR)


def delete_version(spark: SparkSession, root: str, dataset: str, version: str) -> list[str]:
    """Take a version from readers and remove its files, those of failed attempts included; its tables (an action).

    Readers lose it before the first file goes. The manifest lines stay as a record.
    """
    written = _lines(spark, f"{root}/manifest", MANIFEST).where((F.col("dataset") == dataset) & (F.col("version") == version))
    tables = sorted(r.table for r in written.select("table").distinct().collect())
    rows = [(dataset, version, table) for table in tables]
    _record(spark.createDataFrame(rows, "dataset string, version string, table string"), root, DELETED)
    for table in [*tables, "metadata"]:
        files, where = _folder(spark, version_path(root, table, dataset, version))
        files.delete(where, True)
    return tables


def write_version(
    df: DataFrame,
    root: str,
    table: str,
    dataset: str,
    version: str,
    compression: str = "zstd",
    checksum_of: str | None = None,
    chunk_size: int | None = None,
    chunk_overlap: int | None = None,
    sort_by: str | None = None,
    released: bool = True,
) -> DataFrame:
    """Write one table of a version and its manifest, which is returned, and release it (an action).

    With ``released=False`` readers do not see it until :func:`release` is called for the whole version. A released table is
    never replaced; one that is not is.

    ``sort_by`` stores the rows in ranges of a column with many distinct values, so that a lookup by it reads one row
    group. The row count and the checksum of column ``checksum_of`` are observed while the data is written, so nothing is
    read twice; the count is then compared with the file footers.
    """
    if compression not in COMPRESSIONS:
        raise ValueError(f"compression must be one of {COMPRESSIONS}")
    spark = df.sparkSession
    known = releases(spark, root).where((F.col("dataset") == dataset) & (F.col("version") == version) & (F.col("table") == table))
    if not known.isEmpty():
        raise FileExistsError(f"{table} of {dataset} {version} is released and cannot be replaced")
    if sort_by:
        df = df.repartitionByRange(sort_by).sortWithinPartitions(sort_by)
    seen = Observation("write_version")
    measures = [F.count(F.lit(1)).alias("row_count")]
    if checksum_of:
        measures += [F.count("_h").alias("texts"), *word_sums("_h")]
        watched = df.withColumn("_h", row_hash(checksum_of)).observe(seen, *measures).drop("_h")
    else:
        watched = df.observe(seen, *measures)
    path = version_path(root, table, dataset, version)
    watched.write.mode("overwrite").option("compression", compression).parquet(path)
    measured = seen.get

    stored = spark.read.schema(df.schema).parquet(path).count()
    if stored != measured["row_count"]:
        raise RuntimeError(f"{path} holds {stored} rows, {measured['row_count']} were written")
    checksum: Column = F.lit(None).cast("string")
    one = spark.range(1).select(*[F.lit(value).cast("long").alias(name) for name, value in measured.items()])
    if checksum_of:
        checksum = fold("texts")
    manifest = one.select(
        F.lit(dataset).alias("dataset"), F.lit(version).alias("version"), F.lit(table).alias("table"), "row_count",
        F.array(*[F.lit(c) for c in df.columns]).alias("columns"), F.lit(compression).alias("compression"),
        F.lit(chunk_size).cast("int").alias("chunk_size"), F.lit(chunk_overlap).cast("int").alias("chunk_overlap"),
        checksum.alias("content_checksum"), F.lit(df.schema.json()).alias("schema"), F.current_timestamp().alias("created_at"),
    )
    manifest.coalesce(1).write.mode("append").json(f"{root}/manifest")
    if released:
        release(spark, root, dataset, version, [table])
    return manifest


def write_versions(df: DataFrame, root: str, table: str, compression: str = "zstd") -> None:
    """Write and release many versions at once from rows that carry ``dataset`` and ``version`` (an action).

    The rebalance brings rows of a version together without tying a large version to one task.
    """
    spark = df.sparkSession
    path = f"{root}/{table}"
    placed = df.hint("rebalance", "dataset", "version")
    placed.write.mode("errorifexists").option("compression", compression).partitionBy("dataset", "version").parquet(path)
    columns = [c for c in df.columns if c not in ("dataset", "version")]
    stored = T.StructType([f for f in df.schema if f.name in columns])
    # Only partition values and footers are read for the counts.
    counts = spark.read.schema(_with_version(stored)).parquet(path).groupBy("dataset", "version").agg(
        F.count(F.lit(1)).alias("row_count")
    )
    manifests = counts.select(
        "dataset", "version", F.lit(table).alias("table"), "row_count",
        F.array(*[F.lit(c) for c in columns]).alias("columns"), F.lit(compression).alias("compression"),
        F.lit(stored.json()).alias("schema"), F.current_timestamp().alias("created_at"),
    )
    manifests.write.mode("append").json(f"{root}/manifest")
    _record(_lines(spark, f"{root}/manifest", MANIFEST).where(F.col("table") == table), root, RELEASED)


def _with_version(schema: T.StructType) -> T.StructType:
    """A table's schema with the partition columns, which are strings whatever they look like."""
    named = [T.StructField("dataset", T.StringType()), T.StructField("version", T.StringType())]
    return T.StructType([f for f in schema if f.name not in ("dataset", "version")] + named)


def read_manifests(spark: SparkSession, root: str, released: bool = True) -> DataFrame:
    """The last manifest of every table below ``root``: of what readers see, or of everything ever written."""
    keys = ["dataset", "version", "table"]
    rest = [f.name for f in MANIFEST if f.name not in keys]
    lines = _lines(spark, f"{root}/manifest", MANIFEST)
    last = lines.groupBy(*keys).agg(F.max_by(F.struct(*rest), "created_at").alias("_last")).select(*keys, "_last.*")
    return last.join(releases(spark, root), keys, "left_semi") if released else last


def read_manifest(spark: SparkSession, root: str, dataset: str, version: str, table: str) -> DataFrame:
    return read_manifests(spark, root, released=False).where(
        (F.col("dataset") == dataset) & (F.col("version") == version) & (F.col("table") == table)
    )


def resolve_version(spark: SparkSession, root: str, dataset: str, version: str = "latest", table: str | None = None) -> str:
    """Turn ``latest`` into the newest version of the dataset that readers see, and that has ``table`` (an action)."""
    if version != "latest":
        return version
    known = releases(spark, root).where(F.col("dataset") == dataset)
    if table:
        known = known.where(F.col("table") == table)
    newest = known.agg(F.max_by("version", version_key("version"))).first()[0]
    if newest is None:
        raise LookupError(f"no version of {dataset!r} under {root}")
    return newest


def _declared(manifests: DataFrame, what: str) -> T.StructType:
    """The schema that the last of some manifests declares."""
    found = manifests.agg(F.max_by("schema", "created_at")).first()[0]
    if found is None:
        raise LookupError(f"{what} was never written")
    return _with_version(T.StructType.fromJson(json.loads(found)))


def read_version(
    spark: SparkSession, root: str, table: str, dataset: str, version: str = "latest"
) -> DataFrame:
    """One version of one table, with its ``dataset`` and ``version`` columns, in the schema it was written with.

    Reads manifests while it is built (an action). A version given by name is read even if it is not released.
    """
    version = resolve_version(spark, root, dataset, version, table)
    schema = _declared(read_manifest(spark, root, dataset, version, table), f"{table} of {dataset} {version}")
    path = version_path(root, table, dataset, version)
    return spark.read.schema(schema).option("basePath", f"{root}/{table}").parquet(path)


def read_all_versions(spark: SparkSession, root: str, table: str, with_files: bool = False) -> DataFrame:
    """Every released version of one table; filters on ``dataset`` and ``version`` prune folders.

    ``with_files`` adds the path and size of the file that a row is in, for :func:`version_files`.
    """
    written = read_manifests(spark, root).where(F.col("table") == table)
    rows = spark.read.schema(_declared(written, table)).parquet(f"{root}/{table}")
    if with_files:
        rows = rows.select("*", *[F.col(f"_metadata.{c}").alias(c) for c in ("file_path", "file_size")])
    seen = releases(spark, root).where(F.col("table") == table).drop("table")
    return rows.join(seen, ["dataset", "version"], "left_semi")


def version_files(rows: DataFrame) -> DataFrame:
    """Files behind a table read ``with_files``: (dataset, version, file_path, file_size, row_count)."""
    return rows.groupBy("dataset", "version", "file_path", "file_size").agg(F.count(F.lit(1)).alias("row_count"))


def version_of_path(path: Column) -> Column:
    """The version component of a data file path: the folder the file is in."""
    return F.regexp_replace(F.split_part(path, F.lit("/"), F.lit(-2)), "^version=", "")
