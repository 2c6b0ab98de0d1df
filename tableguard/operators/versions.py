"""Tables whose content is replaced without a moment in which they cannot be read.

A versioned table is a view ``name`` over the newest of its version tables ``name__v1``, ``name__v2``, ..., each
an external Parquet table in a directory of its own.  A new version is written and registered beside the old
one, and then the view is replaced in one catalog call: a query sees the old version or the new one, never none,
and readers of the old version keep its files until ``drop_versions``.

A job that stops before the last call has changed nothing that a reader sees; the next ``replace`` takes the next
number.  Null partition values and values such as ``08`` stay as they are, because versions are declared tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .loads import LoadConfigError, table_schema


def _versions(spark: SparkSession, name: str) -> list[int]:
    *db, table = name.split(".")
    rows = spark.sql(f"SHOW TABLES{f' IN {db[0]}' if db else ''} LIKE '{table}__v*'").collect()
    found = (re.fullmatch(rf"{re.escape(table.lower())}__v(\d+)", r.tableName.lower()) for r in rows)
    return sorted(int(m[1]) for m in found if m)


def current_version(spark: SparkSession, name: str) -> int:
    """The version that the view shows."""
    text = spark.sql(f"SHOW CREATE TABLE {name}").first()[0]
    found = re.search(r"__v(\d+)`?\s*$", text.strip())
    if not found:
        raise LoadConfigError(f"{name} is not a versioned table")
    return int(found[1])


def _register(spark: SparkSession, name: str, number: int, schema: T.StructType, keys: list[str], location: str) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = f" PARTITIONED BY ({', '.join(f'`{k}`' for k in keys)})" if keys else ""
    spark.sql(f"CREATE TABLE {name}__v{number} ({columns}) USING parquet{by} LOCATION '{location}'")
    if keys:
        spark.sql(f"ALTER TABLE {name}__v{number} RECOVER PARTITIONS")


def create_versioned(spark: SparkSession, name: str, columns, root: str, partition_keys=(), with_audit: bool = True) -> None:
    """An empty versioned table of declared columns (see ``loads.table_schema``) or of a ``StructType``, with its
    versions under ``root``."""
    schema = columns if isinstance(columns, T.StructType) else table_schema(columns, with_audit)
    spark.createDataFrame([], schema).write.mode("errorifexists").parquet(f"{root}/v1")
    _register(spark, name, 1, schema, list(partition_keys), f"{root}/v1")
    spark.sql(f"CREATE VIEW {name} AS SELECT * FROM {name}__v1")


def replace(spark: SparkSession, name: str, rows: DataFrame, root: str) -> int:
    """Write ``rows``, which may be computed from the table itself, as the next version and show it.  Returns its
    number."""
    shown = f"{name}__v{current_version(spark, name)}"
    listed = spark.catalog.listColumns(shown)
    keys = [c.name for c in listed if c.isPartition]
    schema = spark.table(shown).schema
    number = max(_versions(spark, name)) + 1
    location = f"{root}/v{number}"
    writer = rows.select(*schema.fieldNames()).write.mode("overwrite")      # of a job that stopped before it was registered
    (writer.partitionBy(*keys) if keys else writer).parquet(location)
    _register(spark, name, number, schema, keys, location)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {name}__v{number}")
    return number


def drop_versions(spark: SparkSession, name: str, keep: int = 1) -> list[int]:
    """Drop the catalog's entries of all but the ``keep`` newest versions up to the shown one; their files stay
    for the store's own rules.  Returns the numbers dropped."""
    if keep < 1:
        raise LoadConfigError("the shown version cannot be dropped")
    gone = [v for v in _versions(spark, name) if v <= current_version(spark, name) - keep]
    for v in gone:
        spark.sql(f"DROP TABLE {name}__v{v}")
    return gone
