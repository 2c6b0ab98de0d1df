"""Table loads (L1-L11): pure DataFrame transforms plus thin writers.

Every mode is first a ``DataFrame -> DataFrame`` function, so it composes,
explains and tests like any query; the writers only decide *where* the rows
go.  Parquet tables have no DELETE or MERGE, and Spark refuses to overwrite a
path it is reading, so:

* overwrite  -> ``INSERT OVERWRITE TABLE`` (whole table),
* append     -> static ``INSERT OVERWRITE ... PARTITION (y, m, d, h)``: only the
                run's partition is rewritten, and it is cleared even when the
                source is empty,
* update     -> in place, only the touched partitions, staged first and restartable
                (``write_upsert_partitions``), or as a new version behind a view
                (``versions.replace``).
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..context import RunContext
from ..scratch import scratch_root
from ..spec import _literal

# The declarable logical types and their Spark types.
TYPE_MAP = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "timestamp": T.TimestampNTZType(),
    "date": T.DateType(),
    "float": T.DoubleType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
}
# Audit columns appended to every created table, in order.
AUDIT_COLUMNS = [
    ("dw_create_ts", T.TimestampNTZType()),
    ("dw_create_user", T.StringType()),
    ("dw_modified_ts", T.TimestampNTZType()),
    ("dw_modified_user", T.StringType()),
    ("dl_partition_year", T.StringType()),
    ("dl_partition_month", T.StringType()),
    ("dl_partition_day", T.StringType()),
    ("dl_partition_hour", T.StringType()),
]
AUDIT_NAMES = [n for n, _ in AUDIT_COLUMNS]
DEFAULT_PARTITION_KEYS = ["dl_partition_year", "dl_partition_month", "dl_partition_day",
                          "dl_partition_hour"]
MODES = ("overwrite", "update", "append")


class LoadConfigError(ValueError):
    """A load step that cannot run as declared."""


def _declared(columns) -> list[tuple[str, str, dict]]:
    """Normalise declared columns: ``[{name: {type: ...}}]`` or ``[(name, type)]``."""
    out = []
    for c in columns:
        if isinstance(c, dict):
            for name, meta in c.items():
                meta = dict(meta) if isinstance(meta, dict) else {"type": meta}
                out.append((name, meta["type"], meta))
        else:
            name, typ = c[0], c[1]
            out.append((name, typ, {"type": typ}))
    return out


def table_schema(columns, with_audit: bool = True) -> T.StructType:
    """L1 schema: declared columns (all nullable) + the audit columns.

    An unknown logical type raises ``KeyError``; ``pii`` / ``description``
    go to the field metadata.
    """
    fields = []
    for name, typ, meta in _declared(columns):
        md = {k: meta[k] for k in ("pii", "description") if k in meta}
        fields.append(T.StructField(name, TYPE_MAP[typ], True, md))
    if with_audit:
        fields += [T.StructField(n, t, True) for n, t in AUDIT_COLUMNS]
    return T.StructType(fields)


def column_names(columns) -> list[str]:
    return [name for name, _, _ in _declared(columns)]


def create_table(spark: SparkSession, name: str, columns, partition_keys=None,
                 location: str | None = None) -> None:
    """L1: CREATE TABLE ... USING parquet PARTITIONED BY (defaults to the four
    ``dl_partition_*`` columns).  Descriptions become column comments; the columns declared ``pii`` are a
    property of the table (``pii_columns``)."""
    schema = table_schema(columns)
    keys = list(partition_keys or DEFAULT_PARTITION_KEYS)
    unknown = set(keys) - set(schema.fieldNames())
    if unknown:
        raise LoadConfigError(f"partition keys not in table: {sorted(unknown)}")
    cols = ", ".join(_column_ddl(f) for f in schema.fields)
    loc = f" LOCATION '{location}'" if location else ""
    pii = ",".join(f.name for f in schema.fields if f.metadata.get("pii"))
    props = f" TBLPROPERTIES ('{PII_PROPERTY}' = {_literal(pii)})" if pii else ""
    spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet PARTITIONED BY "
              f"({', '.join(f'`{k}`' for k in keys)}){loc}{props}")


#: Table property that lists the columns declared as personal data.
PII_PROPERTY = "tableguard.pii"


def _column_ddl(f: T.StructField) -> str:
    comment = f" COMMENT {_literal(str(f.metadata['description']))}" if f.metadata.get("description") else ""
    return f"`{f.name}` {f.dataType.simpleString()}{comment}"


def pii_columns(spark: SparkSession, name: str) -> list[str]:
    """Columns of a created table that were declared as personal data."""
    found = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}.get(PII_PROPERTY)
    return found.split(",") if found else []


def tmp_step(df: DataFrame, name: str, materialize: str = "checkpoint") -> DataFrame:
    """L2: replace the intermediate ``name`` with ``df``.

    ``materialize``: ``checkpoint`` (written once to the shared folder, lineage cut: later steps read it and a
    change of its inputs no longer shows), ``persist`` (cached, recomputed from lineage if an executor is lost)
    or ``none`` (a view, recomputed where used).
    """
    if materialize == "persist":
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
    elif materialize == "checkpoint":
        df.sparkSession.sparkContext.setCheckpointDir(scratch_root(df.sparkSession))
        df = df.checkpoint(eager=True)
    elif materialize != "none":
        raise LoadConfigError(f"unknown materialize {materialize!r}")
    df.createOrReplaceTempView(name)
    return df


def drop_tmp(spark: SparkSession, names) -> None:
    """L3: drop this run's intermediates (views and their cached data)."""
    for n in names:
        if spark.catalog.tableExists(n):
            if spark.catalog.isCached(n):
                spark.catalog.uncacheTable(n)
        spark.catalog.dropTempView(n)


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The cluster's shared ``spark.checkpoint.dir``; set ``fallback`` only when unset."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if fallback is None:
            raise LoadConfigError("spark.checkpoint.dir is not set")
        d = fallback
    spark.sparkContext.setCheckpointDir(d)
    return d


def with_audit(df: DataFrame, ctx: RunContext, user: str | None = None) -> DataFrame:
    """created/modified time and user, and the run's partition strings."""
    user = ctx.unix_user if user is None else user
    cols = {
        "dw_create_ts": ctx.now_col(),
        "dw_create_user": F.lit(user),
        "dw_modified_ts": ctx.now_col(),
        "dw_modified_user": F.lit(user),
    }
    cols.update({k: F.lit(v) for k, v in ctx.partition_values().items()})
    return df.withColumns(cols)


def project(df: DataFrame, columns) -> DataFrame:
    """Declared columns, in declared order."""
    return df.select(*column_names(columns))


def _not_deleted(df: DataFrame, delete_pred: str | Column | None) -> DataFrame:
    """Rows a ``DELETE ... WHERE pred`` keeps (NULL predicate keeps the row)."""
    if delete_pred is None:
        return df
    pred = F.expr(delete_pred) if isinstance(delete_pred, str) else delete_pred
    return df.where(~F.coalesce(pred, F.lit(False)))


def stage(stg: DataFrame, new: DataFrame, delete_pred: str | Column | None = None) -> DataFrame:
    """L4: staging table after ``DELETE WHERE pred`` then ``INSERT new``."""
    return _not_deleted(stg, delete_pred).unionByName(new.select(*stg.columns))


def overwrite(src: DataFrame, columns, ctx: RunContext) -> DataFrame:
    """The table becomes the declared columns of ``src`` plus audit."""
    return with_audit(project(src, columns), ctx)


def _key_list(primary_key) -> list[str]:
    pk = [primary_key] if isinstance(primary_key, str) else list(primary_key or [])
    if not pk:
        raise LoadConfigError("update mode requires a primary key")
    return pk


def _guarded(src: DataFrame, pk: list[str]) -> DataFrame:
    """``src`` whose key columns fail the job on a NULL (inside the plan)."""
    return src.withColumns({k: F.when(F.col(k).isNull(),
                                      F.raise_error(F.lit(f"NULL primary key {k} in update source")))
                            .otherwise(F.col(k)) for k in pk})


def upsert(tgt: DataFrame, src: DataFrame, primary_key, columns, ctx: RunContext,
           restamp: bool = True, strict_not_in: bool = False) -> DataFrame:
    """Every source row, plus target rows whose key is not in the source.

    The key test is a hash anti-join on the key columns (never a multi-column
    ``NOT IN``, which would plan as a nested-loop join).  A NULL key in the
    source raises; ``strict_not_in=True`` additionally drops target rows with a
    NULL key part when the source is non-empty, as ``NOT IN`` would.
    ``restamp=True`` gives kept rows this run's audit and partition values (the
    historical behaviour); ``False`` keeps their original audit columns.
    Duplicate source keys are all kept.
    """
    pk = _key_list(primary_key)
    names = column_names(columns)
    src = _guarded(src, pk)
    new_rows = with_audit(src.select(*names), ctx)
    kept = tgt.join(src.select(*pk), pk, "left_anti")
    if strict_not_in:
        any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in pk])
        some = src.select(*pk).limit(1).agg((F.count(F.lit(1)) > 0).alias("_tg_some"))     # one row
        kept = kept.crossJoin(F.broadcast(some)).where(~(F.col("_tg_some") & any_null)).drop("_tg_some")
    if restamp:
        kept = with_audit(kept.select(*names), ctx)
    else:
        kept = kept.select(*names, *AUDIT_NAMES)
    return new_rows.unionByName(kept)


def append(tgt: DataFrame, src: DataFrame, columns, ctx: RunContext,
           delete_pred: str | Column | None = None) -> DataFrame:
    """Delete the run's partition (or ``delete_pred``), insert ``src``."""
    if delete_pred is None:
        pv = ctx.partition_values()
        delete_pred = reduce(lambda a, b: a & b, [F.col(k) == v for k, v in pv.items()])
    return _not_deleted(tgt, delete_pred).unionByName(with_audit(project(src, columns), ctx))


def load(tgt: DataFrame, src: DataFrame | None, mode: str | None, columns, ctx: RunContext,
         primary_key=None, delete: str | None = None, **kw) -> DataFrame:
    """Dispatch on ``mode`` (``from`` and ``mode`` are mandatory)."""
    if src is None:
        raise LoadConfigError("target load requires a source ('from')")
    if not mode:
        raise LoadConfigError("target load mode is not set")
    mode = mode.lower()
    if mode == "overwrite":
        return overwrite(src, columns, ctx)
    if mode == "update":
        if not primary_key:
            raise LoadConfigError("update mode requires a primary key")
        return upsert(tgt, src, primary_key, columns, ctx, **kw)
    if mode == "append":
        return append(tgt, src, columns, ctx, delete)
    raise LoadConfigError(f"unknown load mode {mode!r}")


# -- writers ---------------------------------------------------------------

def write_overwrite(spark: SparkSession, table: str, df: DataFrame) -> None:
    """Replace all rows of ``table`` (static overwrite of every partition)."""
    view = f"_tg_src_{abs(hash(table))}"
    df.createOrReplaceTempView(view)
    cols = ", ".join(f"`{c}`" for c in spark.table(table).columns)
    with_static_overwrite(spark, lambda: spark.sql(
        f"INSERT OVERWRITE TABLE {table} SELECT {cols} FROM {view}"))
    spark.catalog.dropTempView(view)


def write_partition(spark: SparkSession, table: str, src_rows: DataFrame, ctx: RunContext) -> None:
    """L7 writer: static ``INSERT OVERWRITE ... PARTITION`` of the run's
    partition only; an empty source leaves the partition empty."""
    pv = ctx.partition_values()
    view = f"_tg_part_{abs(hash(table))}"
    src_rows.createOrReplaceTempView(view)
    data_cols = [c for c in spark.table(table).columns if c not in pv]
    spec = ", ".join(f"{k}='{v}'" for k, v in pv.items())
    with_static_overwrite(spark, lambda: spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({spec}) "
        f"SELECT {', '.join('`%s`' % c for c in data_cols)} FROM {view}"))
    spark.catalog.dropTempView(view)


def write_version(spark: SparkSession, table: str, df: DataFrame, location: str) -> None:
    """L6 writer: write ``df`` to a new directory, then point ``table`` at it.

    The rows are computed from the current version while the new one is
    written, so the table is never read and overwritten at once.  The table
    definition is then re-registered over the new directory (its partitions
    recovered from the files), which also drops the catalog's partition
    entries of the previous version.  The previous directory is left in place
    for readers that still hold it; remove it once they are done.  The rows
    are complete in ``location`` before the catalog is touched; should the
    driver stop between the drop and the create, re-running the create over
    ``location`` restores the table.
    """
    schema = spark.table(table).schema
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    w = df.select(*schema.fieldNames()).write.mode("errorifexists").format("parquet")
    if parts:
        w = w.partitionBy(*parts)
    w.save(location)
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = f" PARTITIONED BY ({', '.join(parts)})" if parts else ""
    spark.sql(f"DROP TABLE {table}")
    spark.sql(f"CREATE TABLE {table} ({cols}) USING parquet{by} LOCATION '{location}'")
    if parts:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    spark.catalog.refreshTable(table)


def write_upsert_partitions(spark: SparkSession, table: str, src: DataFrame, primary_key, columns,
                            ctx: RunContext, staging: str, resume: bool = False, ranges=None) -> int:
    """L6 writer when kept rows keep their audit columns (``restamp=False``):
    rewrite only the partitions the update touches.

    Touched partitions are those holding a target row whose key is in the
    source, and those the new rows land in.  They are searched by key columns
    only, within the partitions that ``ranges`` (``partials.KeyRanges``) names,
    else in the whole table.  Their values, never more than the catalog's own
    list, are written and become partition predicates, so only touched
    partitions are read whole; a null-safe join (a partition key may be NULL)
    selects the exact ones.  The new content is staged under
    ``staging`` first (the table is never read and overwritten at once), then
    written with one dynamic partition overwrite; touched partitions left
    without any row are dropped in one catalog call.
    The table's result equals ``upsert(..., restamp=False)``.  Returns the
    number of touched partitions.  A stopped call is finished by the same call with
    ``resume=True`` (see ``_rewrite_partitions``).
    """
    pk = _key_list(primary_key)
    src = _guarded(src, pk)
    keys = src.select(*pk)
    return _rewrite_partitions(spark, table, with_audit(project(src, columns), ctx),
                               lambda tgt: tgt.join(keys, pk, "left_semi"),
                               lambda tgt: tgt.join(keys, pk, "left_anti"), staging, resume,
                               ranges and (lambda: ranges.candidates(keys)))


def write_delete_insert(spark: SparkSession, table: str, new_rows: DataFrame, delete_pred: str | Column,
                        staging: str, resume: bool = False) -> int:
    """L4/L8 writer: ``DELETE WHERE pred`` (NULL keeps the row), then insert ``new_rows``, in place.

    Only partitions that hold a deleted row or receive a new one are rewritten, as in
    ``write_upsert_partitions``; the table's result equals ``stage(table, new_rows, pred)``.  For an append
    with its own delete give the audited rows: ``overwrite(src, columns, ctx)``.
    """
    pred = F.expr(delete_pred) if isinstance(delete_pred, str) else delete_pred
    return _rewrite_partitions(spark, table, new_rows, lambda tgt: tgt.where(pred),
                               lambda tgt: _not_deleted(tgt, pred), staging, resume)


STEPS = ("touched", "rows", "replaced", "cleared")


def _steps_done(spark: SparkSession, staging: str) -> set[str]:
    """Steps of a load that are marked as finished in its staging folder."""
    done = set()
    for step in STEPS:
        try:
            if spark.read.schema("id long").parquet(f"{staging}/done-{step}").limit(1).count():
                done.add(step)
        except AnalysisException:       # not there
            pass
    return done


def in_partitions(df: DataFrame, parts: list[str], values: list[tuple]) -> DataFrame:
    """Rows of ``df`` whose every partition column has one of its values in ``values``: a predicate that prunes
    the scan, and a superset of those partitions where there are several columns."""
    for i, p in enumerate(parts):
        own = {row[i] for row in values}
        some = F.col(p).isin(*sorted(own - {None}))
        df = df.where(some | F.col(p).isNull() if None in own else some)
    return df


def _rewrite_partitions(spark: SparkSession, table: str, new_rows: DataFrame, removed, kept_of, staging: str,
                        resume: bool = False, within=None) -> int:
    """Rewrite the partitions that hold ``removed(table)`` rows or receive ``new_rows`` with the new rows and
    their ``kept_of`` rows; see ``write_upsert_partitions``.  ``within()`` gives the partitions that may hold
    removed rows (by default any).

    The steps, each marked in the staging folder when it is complete: list the touched partitions, stage their new
    rows, overwrite the partitions from the stage, drop those left empty.  The table is first changed when
    everything that is read from it has been staged, and the last two steps give the same table however often
    they run; so a load that stopped anywhere is finished by calling it again with ``resume=True``, which
    skips the marked steps.  Without ``resume`` the folder must be new.
    """
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if not parts:
        raise LoadConfigError(f"{table} is not partitioned; use versions.replace")
    tgt = spark.table(table)
    cols = tgt.columns
    new_rows = new_rows.select(*cols)
    part_schema = T.StructType([tgt.schema[p] for p in parts])
    done = _steps_done(spark, staging)
    if done and not resume:
        raise LoadConfigError(f"{staging} belongs to another load; resume it or give this one its own folder")

    def step(name: str, action) -> None:
        if name not in done:
            action()
            spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{staging}/done-{name}")

    def same_partition(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        right = right.select(*(F.col(p).alias(f"_tg_{p}") for p in parts))
        return left.join(right, reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.col(f"_tg_{p}")) for p in parts]), how)

    def search() -> None:
        searched = tgt if within is None else in_partitions(tgt, parts, [tuple(r) for r in within().distinct().collect()])
        (removed(searched).select(*parts).unionByName(new_rows.select(*parts)).distinct()
         .write.mode("overwrite").parquet(f"{staging}/touched"))

    step("touched", search)
    touched = spark.read.schema(part_schema).parquet(f"{staging}/touched")
    values = [tuple(r) for r in touched.collect()]
    touched_rows = same_partition(in_partitions(tgt, parts, values), touched, "left_semi")
    step("rows", lambda: new_rows.unionByName(kept_of(touched_rows).select(*cols))
         .write.mode("overwrite").partitionBy(*parts).parquet(f"{staging}/rows"))
    # The table's schema keeps partition values as written ('08', not 8).
    staged = spark.read.schema(tgt.schema).parquet(f"{staging}/rows")

    def replaced() -> None:
        view = f"_tg_upsert_{abs(hash((table, staging)))}"
        staged.select(*cols).createOrReplaceTempView(view)
        try:
            _with_overwrite(spark, "dynamic", lambda: spark.sql(
                f"INSERT OVERWRITE TABLE {table} PARTITION ({', '.join(f'`{p}`' for p in parts)}) "
                f"SELECT {', '.join('`%s`' % c for c in cols)} FROM {view}"))
        finally:
            spark.catalog.dropTempView(view)

    step("replaced", replaced)
    # one row for each partition that the load leaves empty, for one catalog call
    step("cleared", lambda: _drop_partitions(spark, table, parts, [
        tuple(r) for r in same_partition(touched, staged.select(*parts).distinct(), "left_anti").collect()]))
    spark.catalog.refreshTable(table)
    return len(values)


def _drop_partitions(spark: SparkSession, table: str, parts: list[str], values: list[tuple]) -> None:
    """Drop partitions and their files.  A catalog keeps the files of an external table, so those go by hand."""
    if not values:
        return
    specs = ", ".join("PARTITION (" + ", ".join(f"`{p}` = {_literal(v)}" for p, v in zip(parts, row)) + ")" for row in values)
    facts = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
    if facts.get("Type") == "EXTERNAL":
        jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
        escape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
        for row in values:
            names = (escape(p, None if v is None else str(v)) for p, v in zip(parts, row))
            path = jvm.org.apache.hadoop.fs.Path("/".join([facts["Location"].rstrip("/"), *names]))
            path.getFileSystem(conf).delete(path, True)


def _with_overwrite(spark: SparkSession, mode: str, action):
    key = "spark.sql.sources.partitionOverwriteMode"
    old = spark.conf.get(key)
    spark.conf.set(key, mode)
    try:
        return action()
    finally:
        spark.conf.set(key, old)


def with_static_overwrite(spark: SparkSession, action):
    return _with_overwrite(spark, "static", action)
