"""Aggregates of a stored table that are kept for each of its directories (partitions).

A fingerprint of a directory's files is kept beside its aggregates.  ``current`` lists the files (no rows are read
for that), reads only directories whose fingerprint it does not know, replaces their rows and drops those of
directories that are gone.  So the kept rows are right whoever has written to the table.  They are a versioned table
(``operators.versions``), replaced in one catalog call after the scan: a run that stops before has changed nothing.
Files are told apart by their names, as writers never give a name twice.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import versions
from .loads import LoadConfigError

# A directory is known by its path without the scheme: Spark writes ``file:/`` in one place, ``file:///`` in another.
SCHEME = r"^[A-Za-z0-9]+:/+"
_LISTING = T.StructType([T.StructField("directory", T.StringType()), T.StructField("files", T.StringType())])


def directory_of_row() -> Column:
    return F.regexp_replace(F.regexp_extract("_metadata.file_path", r"^(.*)/[^/]*$", 1), SCHEME, "/")


def listed(df: DataFrame) -> dict[str, str]:
    """Directory -> fingerprint of its files, from the listing that Spark has made of the table."""
    files: dict[str, list[str]] = {}
    for f in df.inputFiles():
        directory, _, name = f.rpartition("/")
        files.setdefault(re.sub(SCHEME, "/", directory), []).append(name)
    return {d: hashlib.sha256("\n".join(sorted(names)).encode()).hexdigest() for d, names in files.items()}


class DirectoryPartials:
    """The kept table ``name`` with its versions under ``root``: directory, files and the aggregates ``columns``.

    ``read(directories)`` gives the rows of those directories, or of the whole table for ``None``; ``prepare`` is
    applied to rows before they are aggregated (a filter, say).  A directory without a row has empty aggregates.
    ``scanned`` holds the directories that the last call of ``current`` read.
    """

    def __init__(self, spark: SparkSession, name: str, root: str, read: Callable[[list[str] | None], DataFrame],
                 columns: list[str], prepare: Callable[[DataFrame], DataFrame] = lambda df: df):
        self.spark, self.name, self.root, self.read, self.columns, self.prepare = spark, name, root, read, columns, prepare
        self.scanned: list[str] = []

    def _rows(self, listing: DataFrame, df: DataFrame) -> DataFrame:
        rows = self.prepare(df.withColumn("_tg_dir", directory_of_row()))
        return listing.join(rows.groupBy(F.col("_tg_dir").alias("directory")).agg(*map(F.expr, self.columns)), "directory", "left")

    def current(self) -> DataFrame:
        """Bring the kept rows up to the table's files; returns them."""
        whole = self.read(None)
        now = listed(whole)
        listing = self.spark.createDataFrame(sorted(now.items()), _LISTING)
        try:
            kept = self.spark.table(self.name)
        except AnalysisException:
            empty = self._rows(listing.limit(0), whole)
            versions.create_versioned(self.spark, self.name, empty.schema, self.root)
            kept = self.spark.table(self.name)
        known = {(r.directory, r.files) for r in kept.select("directory", "files").collect()}      # one row a directory
        new = {d: f for d, f in now.items() if (d, f) not in known}
        self.scanned = sorted(new)
        if not new and len(known) == len(now):
            return kept
        rows = kept.join(listing, ["directory", "files"], "left_semi")
        if new:
            fresh = self.spark.createDataFrame(sorted(new.items()), _LISTING)
            rows = rows.unionByName(self._rows(fresh, self.read(sorted(new))))
        versions.replace(self.spark, self.name, rows, self.root)
        return self.spark.table(self.name)


class KeyRanges:
    """Smallest and largest key of each partition of a catalog table, for updates that touch few partitions.

    ``candidates(keys)`` are the partitions that may hold one of the keys: the keys are cut into at most
    ``intervals`` ranges, and a partition stays if for some range its own range meets it in every key column.  That
    is a superset of the partitions that hold a key, so a search within them finds all.  Only the ranges are
    broadcast, at most ``intervals`` rows whatever the size of the update.
    """

    def __init__(self, spark: SparkSession, table: str, primary_key, root: str, intervals: int = 256):
        self.spark, self.table, self.intervals = spark, table, intervals
        self.keys = [primary_key] if isinstance(primary_key, str) else list(primary_key)
        self.parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
        if not self.parts:
            raise LoadConfigError(f"{table} is not partitioned")
        name = "tg_ranges_" + hashlib.sha256(repr((table, self.keys)).encode()).hexdigest()[:16]
        columns = [f"min(`{p}`) AS `{p}`" for p in self.parts]
        for i, k in enumerate(self.keys):
            columns += [f"min(`{k}`) AS _tg_lo{i}", f"max(`{k}`) AS _tg_hi{i}"]
        self.kept = DirectoryPartials(spark, name, f"{root.rstrip('/')}/{name}", self._read, columns)

    def _read(self, directories: list[str] | None) -> DataFrame:
        df = self.spark.table(self.table)
        return df if directories is None else df.where(directory_of_row().isin(directories))    # prunes files

    def _intervals(self, keys: DataFrame) -> DataFrame:
        schema = self.spark.table(self.table).schema
        other = [k for k in self.keys if keys.schema[k].dataType != schema[k].dataType]
        if other:       # another type may have another order
            raise LoadConfigError(f"key columns of another type than in {self.table}: {other}")
        cut = keys.select(*self.keys).repartitionByRange(self.intervals, *self.keys).withColumn("_tg_cut", F.spark_partition_id())
        aggs = [f(k).alias(f"_tg_{n}{i}") for i, k in enumerate(self.keys) for n, f in (("from", F.min), ("to", F.max))]
        return cut.groupBy("_tg_cut").agg(*aggs).drop("_tg_cut")

    def candidates(self, keys: DataFrame) -> DataFrame:
        """Partition columns of the partitions whose key range meets the keys."""
        meet = F.lit(True)
        for i in range(len(self.keys)):
            meet = meet & (F.col(f"_tg_lo{i}") <= F.col(f"_tg_to{i}")) & (F.col(f"_tg_hi{i}") >= F.col(f"_tg_from{i}"))
        return self.kept.current().join(F.broadcast(self._intervals(keys)), meet, "left_semi").select(*self.parts)
