"""Versions behind a view, restartable partition rewrites, kept newest verdicts, column metadata."""

import datetime as dt
import threading

import pytest

from tableguard import RunContext
from tableguard.operators import loads as L
from tableguard.operators import reports as K
from tableguard.operators import results as R
from tableguard.operators import versions as V

CTX = RunContext.create("2024-03-01 06:00:00", now="2024-03-01 06:30:00", dq_key=7, env="TEST", unix_user="u")


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _drop(spark, name):
    for v in V._versions(spark, name):
        spark.sql(f"DROP TABLE IF EXISTS {name}__v{v}")
    spark.sql(f"DROP VIEW IF EXISTS {name}")


def test_versions_are_never_absent(spark, tmp_path):
    root = f"{tmp_path}/versions"
    V.create_versioned(spark, "t_ver", [("k", "int"), ("p", "string")], root, ["p"], with_audit=False)
    try:
        assert spark.table("t_ver").count() == 0 and V.current_version(spark, "t_ver") == 1
        V.replace(spark, "t_ver", spark.sql("SELECT * FROM VALUES (0, '08'), (1, NULL), (2, \"it's/a=b\") AS t(k, p)"), root)
        assert _rows(spark.table("t_ver")) == [(0, "08"), (1, None), (2, "it's/a=b")]
        seen, failed, stop = [], [], threading.Event()

        def reader():
            while not stop.is_set():
                try:
                    seen.append(spark.table("t_ver").count())
                except Exception as e:      # noqa: BLE001
                    failed.append(e)

        t = threading.Thread(target=reader)
        t.start()
        old = spark.table("t_ver")
        for i in range(3):
            V.replace(spark, "t_ver", spark.table("t_ver").unionByName(spark.sql(f"SELECT CAST({i} AS INT) AS k, 'new' AS p")), root)
        stop.set()
        t.join()
        assert not failed and set(seen) <= {3, 4, 5, 6} and spark.table("t_ver").count() == 6
        assert old.count() == 3                         # a reader of an older version keeps its files
        assert V.current_version(spark, "t_ver") == 5
        # a job that stopped after writing and registering a version nobody sees
        spark.range(1).selectExpr("CAST(id AS INT) AS k", "'lost' AS p").write.partitionBy("p").parquet(f"{root}/v6")
        V._register(spark, "t_ver", 6, spark.table("t_ver").schema, ["p"], f"{root}/v6")
        assert spark.table("t_ver").count() == 6
        assert V.replace(spark, "t_ver", spark.table("t_ver").where("k > 0"), root) == 7
        assert V.drop_versions(spark, "t_ver", keep=2) == [1, 2, 3, 4, 5]
        assert spark.table("t_ver").where("p = 'lost'").count() == 0
        with pytest.raises(L.LoadConfigError):
            V.drop_versions(spark, "t_ver", keep=0)
    finally:
        _drop(spark, "t_ver")


def test_not_a_versioned_table(spark):
    spark.sql("DROP TABLE IF EXISTS t_plain")
    spark.sql("CREATE TABLE t_plain (k INT) USING parquet")
    try:
        with pytest.raises(L.LoadConfigError):
            V.current_version(spark, "t_plain")
    finally:
        spark.sql("DROP TABLE t_plain")


def _table(spark, name, location=None):
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE {name} (k INT, v STRING, p STRING) USING parquet PARTITIONED BY (p){loc}")
    df = spark.sql("SELECT * FROM VALUES (1, 'a', 'it''s'), (2, 'b', 'it''s'), (3, 'c', NULL), (4, 'd', '08'), (5, 'e', 'x/y=z'), (6, 'f', 'stays') AS t(k, v, p)")
    L.write_overwrite(spark, name, df)


@pytest.mark.parametrize("external", [False, True])
@pytest.mark.parametrize("stop", [None, *L.STEPS])
def test_stop_and_rerun(spark, tmp_path, monkeypatch, external, stop):
    """Stopped after any step and called again, the load ends with the same table; emptied partitions go."""
    name = f"t_restart_{int(external)}_{stop}"
    _table(spark, name, f"{tmp_path}/t" if external else None)
    try:
        new = spark.sql("SELECT * FROM VALUES (9, 'new', '08'), (10, 'new', 'fresh') AS t(k, v, p)")
        pred = "k IN (1, 2, 3, 4, 5)"
        want = _rows(L.stage(spark.table(name), new, pred))
        staging = f"{tmp_path}/staging"
        if stop:
            done = L._steps_done
            first = dict.fromkeys(L.STEPS[:L.STEPS.index(stop) + 1])

            class Stop(Exception):
                pass

            parquet = type(spark.range(1).write).parquet

            def stopping(self, path, *a, **k):
                parquet(self, path, *a, **k)
                if path.endswith(f"done-{list(first)[-1]}"):
                    raise Stop

            monkeypatch.setattr(type(spark.range(1).write), "parquet", stopping)
            with pytest.raises(Stop):
                L.write_delete_insert(spark, name, new, pred, staging)
            monkeypatch.undo()
            assert done(spark, staging) == set(first)
            with pytest.raises(L.LoadConfigError):
                L.write_delete_insert(spark, name, new, pred, staging)
        L.write_delete_insert(spark, name, new, pred, staging, resume=True)
        assert _rows(spark.table(name)) == want
        assert L.write_delete_insert(spark, name, new, pred, staging, resume=True) == 5    # and once more changes nothing
        assert _rows(spark.table(name)) == want
        left = sorted(str(r[0]) for r in spark.sql(f"SHOW PARTITIONS {name}").collect())
        assert left == ["p=08", "p=fresh", "p=stays"]
        if external:
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
            assert _rows(spark.table(name)) == want
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _result(spark, **have):
    at = have.pop("at", "2024-03-01 06:00:00")
    base = {"dq_run_hour": f"TIMESTAMP_NTZ'{at}'", "dq_end_tstamp": f"TIMESTAMP_NTZ'{at}'", "database_name": "'d'", "schema_name": "'s'",
            "table_name": "'t'", "env": "'TEST'", "is_pass": "true", "stop_on_failure": "true", "dq_key": "1L", "dq_name": "'unique'",
            "check_id": "'unique'", "dq_column": "'a'", "dq_tgt_value": "'1'", "dq_run_date": f"DATE'{at[:10]}'"} | have
    base.setdefault("rule_column", base["dq_column"])
    return spark.sql("SELECT " + ", ".join(f"CAST({base.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in R.RESULT_SCHEMA.fields))


def test_kept_newest_rows(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS t_kept")
    R.create_results(spark, "t_kept")
    try:
        label = "'a\n [b] [2024-01-01]'"
        first = (_result(spark, is_pass="false").unionByName(_result(spark, dq_column="'b'"))
                 .unionByName(_result(spark, dq_name="'day_to_day'", check_id="'day_to_day'", dq_column=label, rule_column="'a\n [b]'", is_pass="false"))
                 .unionByName(_result(spark, dq_key="NULL", dq_column="'seeded'")))
        again = (_result(spark, dq_tgt_value="'2'", at="2024-03-01 07:00:00")
                 .unionByName(_result(spark, dq_name="'day_to_day'", check_id="'day_to_day'", dq_column=label, rule_column="'a\n [b]'", at="2024-03-01 07:00:00"))
                 .unionByName(_result(spark, dq_column="'b'", is_pass="false", at="2024-03-01 05:00:00")))
        later = _result(spark, dq_key="2L", at="2024-03-02 06:00:00", is_pass="false")
        everything = None
        for i, rows in enumerate((first, again, later, again)):
            everything = rows if everything is None else everything.unionByName(rows)
            assert K.keep_newest(spark, rows, "t_kept", f"{tmp_path}/{i}") == 1
            kept = K.kept_results(spark, "t_kept")
            assert _rows(kept.select("dq_key", "dq_column", "dq_end_tstamp", "is_pass")) == _rows(
                K.newest(everything).select("dq_key", "dq_column", "dq_end_tstamp", "is_pass"))
            for report in (R.verdicts, R.summary):
                assert _rows(report(kept)) == _rows(report(K.newest(everything)))
        assert _rows(R.verdicts(kept)) == _rows(R.verdicts(everything))
        rolled = R.rollup_day_to_day(kept, 1).first()
        assert (rolled.dq_column, rolled.is_pass, rolled.n_keys) == ("a\n [b]", True, 1)
        assert kept.count() == 5
        with pytest.raises(R.StopOnFailure):
            R.stop_gate(kept, 2)
        R.stop_gate(kept, 1)
    finally:
        spark.sql("DROP TABLE IF EXISTS t_kept")


def test_column_comments_and_personal_data(spark):
    spark.sql("DROP TABLE IF EXISTS t_meta")
    L.create_table(spark, "t_meta", [{"id": {"type": "int", "description": "the key's \\ number"}}, {"mail": {"type": "string", "pii": True}},
                                     {"plain": "string"}])
    try:
        about = {c.name: c.description for c in spark.catalog.listColumns("t_meta")}
        assert about["id"] == "the key's \\ number" and not about["plain"]
        assert L.pii_columns(spark, "t_meta") == ["mail"]
    finally:
        spark.sql("DROP TABLE t_meta")


def test_tmp_steps_are_computed_once(spark, tmp_path):
    path = f"{tmp_path}/in"
    spark.range(3).write.parquet(path)
    L.tmp_step(spark.read.parquet(path), "tmp_once")
    spark.range(5).write.mode("append").parquet(path)
    assert spark.table("tmp_once").count() == 3
    L.drop_tmp(spark, ["tmp_once"])
    assert dt.date.today() and not spark.catalog.tableExists("tmp_once")
