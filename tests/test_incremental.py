"""Checks from partial results of partitions."""

import pytest

from tableguard import CheckSpec, RunContext, Suite, TableRef, run_suite
from tableguard.plans.incremental import IncrementalChecks
from tableguard.spec import CheckConfigError

CTX = RunContext.create("2024-03-01 06:00:00", now="2024-03-01 06:30:00", dq_key=5, env="TEST")
SCHEMA = "v int, t string, d date, p string"


def _specs():
    return [CheckSpec.make("trending", columns=["count(*)", "sum(v)", "min(v)", "max(t)", "avg(v)", "count(t)"], threshold="0.1"),
            CheckSpec.make("empty_null", columns=["t", "v"]), CheckSpec.make("up_to_date", columns=["d"])]


def _write(spark, path, p, rows):
    spark.createDataFrame([(*r, p) for r in rows], "v int, t string, d string, p string").selectExpr(
        "v", "t", "CAST(d AS DATE) AS d", "p").write.mode("append").partitionBy("p").parquet(path)


def _same(spark, checks, path, filt=None):
    df = spark.read.schema(SCHEMA).parquet(path)
    want = run_suite(spark, Suite(TableRef("a.b.t", df, filt), _specs()), CTX)
    assert sorted(map(str, checks.results(CTX).collect())) == sorted(map(str, want.collect()))


def _drop(spark, checks):
    from tableguard.operators import versions
    for v in versions._versions(spark, checks.state_name):
        spark.sql(f"DROP TABLE {checks.state_name}__v{v}")
    spark.sql(f"DROP VIEW IF EXISTS {checks.state_name}")


@pytest.mark.parametrize("filt", [None, "v > 2"])
def test_only_new_partitions_are_read(spark, tmp_path, filt):
    import shutil
    path, root = f"{tmp_path}/t", f"{tmp_path}/state"
    _write(spark, path, "08", [(1, "a", "2024-01-01"), (5, "", None)])
    _write(spark, path, "a b/c=d'e", [(7, None, "2024-02-01")])
    _write(spark, path, None, [(None, "z", "2024-01-05"), (2, "y", None)])
    schema = spark.read.schema(SCHEMA).parquet(path).schema
    checks = IncrementalChecks(spark, "a.b.t", path, _specs(), root, filter=filt, schema=schema)
    try:
        _same(spark, checks, path, filt)
        assert len(checks.scanned) == 3
        _same(spark, checks, path, filt)
        assert checks.scanned == []
        _write(spark, path, "new", [(100, "b", "2024-03-01"), (0, "", "2024-03-02")])
        _write(spark, path, "08", [(50, "late", None)])              # a known partition gets a file
        again = IncrementalChecks(spark, "a.b.t", path, _specs(), root, filter=filt, schema=schema)
        _same(spark, again, path, filt)
        assert [s.rpartition("=")[2] for s in again.scanned] == ["08", "new"]
        shutil.rmtree(f"{path}/p=08")                               # and one goes
        spark.catalog.refreshByPath(path)
        _same(spark, again, path, filt)
        assert again.scanned == []
    finally:
        _drop(spark, checks)


def test_what_cannot_be_merged_is_refused(spark, tmp_path):
    for column in ("count(DISTINCT v)", "sum(v) / count(*)", "stddev(v)"):
        with pytest.raises(CheckConfigError):
            IncrementalChecks(spark, "a.b.t", str(tmp_path), [CheckSpec.make("trending", columns=[column])], str(tmp_path))
    with pytest.raises(CheckConfigError):
        IncrementalChecks(spark, "a.b.t", str(tmp_path), [CheckSpec.make("unique", columns=["v"])], str(tmp_path))
