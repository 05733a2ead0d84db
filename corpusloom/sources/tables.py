"""Catalog tables: create with a declared schema and partitioning, append, overwrite, drop partitions.

These run against whatever catalog the session names. Without a table format on the class path the tables are
partitioned Parquet tables of the session catalog.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def ensure_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    """Create the namespace unless it exists; ``location`` is where its tables are kept (default: the warehouse)."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}{where}")


def list_namespaces(spark: SparkSession) -> list[str]:
    return [row.namespace for row in spark.sql("SHOW NAMESPACES").collect()]


def ensure_table(
    spark: SparkSession, name: str, schema: T.StructType, partition_by: tuple[str, ...] = (), provider: str = "parquet"
) -> bool:
    """Create the table unless it exists; True when it was created.

    File tables do not keep which columns are required, so that is a table property; :func:`append_rows` and
    :func:`overwrite_rows` hold to it, and :func:`table_schema` gives the schema with it.
    """
    if spark.catalog.tableExists(name):
        return False
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    parts = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    required = ",".join(f.name for f in schema if not f.nullable)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING {provider} {parts} TBLPROPERTIES ('{_REQUIRED}' = '{required}')")
    return True


_REQUIRED = "required.columns"


def table_schema(spark: SparkSession, name: str) -> T.StructType:
    """Schema of a table with the columns it requires."""
    properties = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    required = properties.get(_REQUIRED, "").split(",")
    return T.StructType([T.StructField(f.name, f.dataType, f.name not in required) for f in spark.table(name).schema])


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def list_tables(spark: SparkSession, namespace: str) -> list[str]:
    return [t.name for t in spark.catalog.listTables(namespace)]


def _fitted(df: DataFrame, name: str) -> DataFrame:
    """Columns in table order, cast to the declared types; inserting goes by position. A null in a required column fails the
    insert, which then adds nothing."""

    def value(field: T.StructField):
        cast = df[field.name].cast(field.dataType)
        if not field.nullable:
            cast = F.when(cast.isNull(), F.raise_error(F.lit(f"{name}.{field.name} is required"))).otherwise(cast)
        return cast.alias(field.name)

    return df.select(*[value(f) for f in table_schema(df.sparkSession, name)])


def append_rows(df: DataFrame, name: str, rebalance_on: tuple[str, ...] = ()) -> None:
    _balanced(_fitted(df, name), rebalance_on).write.insertInto(name)


def overwrite_rows(df: DataFrame, name: str, rebalance_on: tuple[str, ...] = ()) -> None:
    """Replace the whole table, keeping its definition."""
    _balanced(_fitted(df, name), rebalance_on).write.insertInto(name, overwrite=True)


def _balanced(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return df.hint("rebalance", *columns) if columns else df


def list_partitions(spark: SparkSession, name: str) -> DataFrame:
    """Dataset and version partitions from the catalog alone."""
    return spark.sql(f"SHOW PARTITIONS {name}").selectExpr(
        "regexp_extract(partition, 'dataset=([^/]*)', 1) AS dataset",
        "regexp_extract(partition, 'version=([^/]*)', 1) AS version",
    )


def delete_version(spark: SparkSession, name: str, dataset: str, version: str) -> None:
    """Drop one version of a table partitioned by dataset and version."""
    where = ", ".join(f"{k}='{v.replace(chr(39), chr(92) + chr(39))}'" for k, v in
                      (("dataset", dataset), ("version", version)))
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({where})")


def merge_rows(updates: DataFrame, name: str, key: str, columns: list[str] | None = None) -> None:
    """Row-level upsert into a catalog that supports MERGE; ``updates`` has one row per key.

    Parquet tables have no row-level operations: use :func:`corpusloom.operators.upsert.upsert` for them.
    """
    columns = columns or updates.columns
    values = {c: F.col(f"s.{c}") for c in columns}
    changed = {c: v for c, v in values.items() if c != key}
    (
        updates.alias("s").mergeInto(name, F.col(f"{name}.{key}") == F.col(f"s.{key}"))
        .whenMatched().update(changed).whenNotMatched().insert(values).merge()
    )
