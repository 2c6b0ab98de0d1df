"""Checks answered from file statistics."""

import pytest

from tableguard import CheckSpec, RunContext, Suite, TableRef, run_suite
from tableguard.plans.file_statistics import PUSHDOWN, READERS, StatisticsChecks
from tableguard.spec import CheckConfigError

CTX = RunContext.create("2024-03-01 06:00:00", now="2024-03-01 06:30:00", dq_key=5, env="TEST")
FAST = ("count(*)", "count(s)", "max(i)", "min(id)", "count(d)")


@pytest.fixture()
def table(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(500).selectExpr("id", "CAST(id % 90 AS INT) AS i", "date_add(DATE'2023-01-01', CAST(id AS INT)) AS d",
                                "IF(id % 3 = 0, NULL, CAST(id AS STRING)) AS s", "id / 7 AS f", "CAST(NULL AS INT) AS never",
                                "CAST(id % 3 AS STRING) AS p").write.partitionBy("p").parquet(path)
    return path


def _check(spark, path, columns, filt=None, days=("d",), source=None):
    specs = [CheckSpec.make("trending", columns=list(columns), threshold="0.1"), CheckSpec.make("up_to_date", columns=list(days))]
    if source is not None:
        specs.append(CheckSpec.make("compare_to_source", source=source, threshold="0.1"))
    before = spark.conf.get(READERS), spark.conf.get(PUSHDOWN)
    checks = StatisticsChecks(spark, "a.b.t", path, specs, filter=filt)
    got = checks.results(CTX)
    want = run_suite(spark, Suite(TableRef("a.b.t", spark.read.parquet(path), filt), specs), CTX)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.schema == want.schema
    assert (spark.conf.get(READERS), spark.conf.get(PUSHDOWN)) == before
    return checks.from_footers


@pytest.mark.parametrize("filt", [None, "p = '1'", "p IN ('0', '2')"])
def test_footers_answer(spark, table, filt):
    source = TableRef("a.b.src", spark.read.parquet(table))
    assert _check(spark, table, FAST, filt, source=source) is True


@pytest.mark.parametrize("columns,filt", [(FAST, "i > 5"), ((*FAST, "sum(i)"), None), ((*FAST, "max(s)"), None),
                                          ((*FAST, "count(DISTINCT i)"), None), ((*FAST, "max(f)"), None), (("max(id + 1)",), None)])
def test_rows_are_read_where_footers_cannot(spark, table, columns, filt):
    assert _check(spark, table, columns, filt) is False


def test_a_column_without_values_in_a_file(spark, table):
    assert _check(spark, table, ("max(never)", "count(*)")) is False
    assert _check(spark, table, ("count(never)", "count(*)")) is True


def test_nan_is_not_lost(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq
    pq.write_table(pa.table({"f": [1.0, float("nan")], "d": pa.array([1, 2], pa.date32())}), f"{tmp_path}/x.parquet")
    assert _check(spark, f"{tmp_path}/x.parquet", ("max(f)",)) is False


def test_an_empty_table(spark, tmp_path):
    spark.range(0).selectExpr("id", "current_date() AS d").write.parquet(f"{tmp_path}/e")
    _check(spark, f"{tmp_path}/e", ("count(*)", "max(id)"))


def test_other_families_are_refused(spark, table):
    with pytest.raises(CheckConfigError):
        StatisticsChecks(spark, "a.b.t", table, [CheckSpec.make("unique", columns=["id"])])
