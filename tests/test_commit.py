"""Outputs of a run are all old or all new, whichever step breaks; tables; objects written at the same time."""

import os
import time

import pytest
from pyspark.sql import functions as F

from contractspark.operators import commit
from contractspark.operators.write import save
from contractspark.plans.apply import run_contracts
from contractspark.spec import ContractSpec, ObjectSpec

NAMES = ("a", "b", "c")


def contract(names=NAMES, critical=False):
    column = {"name": "id", "logicalType": "integer", "physicalType": "BIGINT", "required": True, "criticalDataElement": critical}
    return ContractSpec.from_dict({"version": "1", "kind": "k", "apiVersion": "v", "id": "i", "status": "s",
                                   "schema": [{"name": n, "properties": [column]} for n in names]})


def frames(spark, first, names=NAMES):
    return {n: spark.range(first, first + 3, 1, 1) for n in names}


def contents(spark, target, names=NAMES):
    return [sorted(r.id for r in spark.read.parquet(f"{target}/{n}").collect()) for n in names]


OLD, NEW = [0, 1, 2], [10, 11, 12]


class Ended(BaseException):
    """The process ends here: nothing after it runs."""


def broken(monkeypatch, at, lasting):
    """The ``at``-th rename fails; with ``lasting`` every call on files after it too, as if the process had ended."""
    real, calls = commit._Files.rename, {"n": 0}

    def rename(self, old, new):
        calls["n"] += 1
        if calls["n"] == at or lasting and calls["n"] > at:
            raise Ended() if lasting else OSError("broken")
        real(self, old, new)

    monkeypatch.setattr(commit._Files, "rename", rename)
    if lasting:
        kept = commit._Files.delete
        monkeypatch.setattr(commit._Files, "delete", lambda self, path: kept(self, path) if calls["n"] < at else None)
    return calls


def test_each_broken_rename_leaves_all_old(spark, tmp_path, monkeypatch):
    run_contracts(frames(spark, 0), contract(), str(tmp_path))
    for at in range(1, 8):  # the commit, and two renames for each of three targets
        with monkeypatch.context() as m:
            broken(m, at, lasting=False)
            with pytest.raises(OSError):
                run_contracts(frames(spark, 10), contract(), str(tmp_path), at_once=1)
        assert contents(spark, tmp_path) == [OLD] * 3, at
        assert sorted(os.listdir(tmp_path)) == list(NAMES), at  # nothing is left behind
    run_contracts(frames(spark, 10), contract(), str(tmp_path))
    assert contents(spark, tmp_path) == [NEW] * 3 and sorted(os.listdir(tmp_path)) == list(NAMES)


@pytest.mark.parametrize("at", range(1, 8))
def test_a_run_that_ends_anywhere_is_recovered(spark, tmp_path, monkeypatch, at):
    """Before the commit all stay old; after it the next start makes all new."""
    run_contracts(frames(spark, 0), contract(), str(tmp_path))
    with monkeypatch.context() as m:
        broken(m, at, lasting=True)
        with pytest.raises(Ended):
            run_contracts(frames(spark, 10), contract(), str(tmp_path), at_once=1)
    commit.recover(spark, str(tmp_path))
    assert contents(spark, tmp_path) == ([OLD] if at == 1 else [NEW]) * 3
    commit.recover(spark, str(tmp_path), stale_after=-1)  # what an uncommitted run has left
    assert sorted(os.listdir(tmp_path)) == list(NAMES)


def test_recovery_can_be_done_again_and_runs_first(spark, tmp_path, monkeypatch):
    run_contracts(frames(spark, 0), contract(), str(tmp_path))
    with monkeypatch.context() as m:
        broken(m, 4, lasting=True)
        with pytest.raises(Ended):
            run_contracts(frames(spark, 10), contract(), str(tmp_path), at_once=1)
    with monkeypatch.context() as m:  # the recovery ends too
        broken(m, 1, lasting=True)
        with pytest.raises(Ended):
            commit.recover(spark, str(tmp_path))
    run_contracts(frames(spark, 20, ("d",)), contract(("d",)), str(tmp_path))  # another run in the folder starts with it
    assert contents(spark, tmp_path) == [NEW] * 3 and sorted(os.listdir(tmp_path)) == [*NAMES, "d"]


def test_first_run_and_running_writers(spark, tmp_path):
    """A record of a run that is being written stays until it is stale; a record that is cut off harms nothing."""
    (tmp_path / "_run-1.writing").write_text('[{"path": "x", "new": "')
    (tmp_path / "_run-2.writing").write_text('[{"path": "x", "new": "%s/_staging-x-2", "old": "y"}]' % tmp_path)
    (tmp_path / "_staging-x-2").mkdir()
    run_contracts(frames(spark, 0), contract(), str(tmp_path))
    assert contents(spark, tmp_path) == [OLD] * 3 and (tmp_path / "_staging-x-2").exists()
    assert len(commit.recover(spark, str(tmp_path), stale_after=-1)) == 2 and sorted(os.listdir(tmp_path)) == list(NAMES)
    assert commit.recover(spark, str(tmp_path / "nowhere")) == []


def test_objects_run_at_the_same_time_and_the_first_failure_ends_the_rest(spark, tmp_path):
    names = [f"o{k}" for k in range(20)]
    slow = F.pandas_udf(lambda s: (time.sleep(0.15), s)[1], "long")
    inputs = {n: spark.range(0, 3, 1, 1).select(slow("id").alias("id")) for n in names}
    run_contracts({"o0": inputs["o0"]}, contract(["o0"]), str(tmp_path / "warm"))
    took = {}
    for at_once in (1, 8):
        began = time.time()
        run_contracts(inputs, contract(names), str(tmp_path / f"x{at_once}"), at_once=at_once)
        took[at_once] = time.time() - began
    assert took[8] < 0.7 * took[1]
    assert contents(spark, tmp_path / "x8", names) == [OLD] * 20

    bad = dict(inputs, o3=spark.createDataFrame([(None,)], "id long"))
    for n in names[10:]:  # these would take very long
        bad[n] = spark.range(0, 400, 1, 1).repartition(400).select(slow("id").alias("id"))
    began = time.time()
    with pytest.raises(Exception, match="o3|NULL"):
        run_contracts(bad, contract(names, critical=True), str(tmp_path / "x8"))
    assert time.time() - began < 30
    assert contents(spark, tmp_path / "x8", names) == [OLD] * 20 and sorted(os.listdir(tmp_path / "x8")) == sorted(names)


def test_table_is_replaced_by_rename(spark, monkeypatch):
    obj = ObjectSpec.from_dict({"name": "t", "description": "it's new", "tags": ["owner:me"], "properties": [{"name": "id", "logicalType": "integer", "physicalType": "BIGINT"}]})
    spark.sql("CREATE DATABASE IF NOT EXISTS kept")
    rows = lambda: sorted(r.id for r in spark.table("kept.t").collect())
    real = commit._renamed
    try:
        save(spark.range(3), obj, table="kept.t")
        for at in (1, 2):  # a rename fails: the old rows stay
            calls = []

            def renamed(s, old, new):
                calls.append(new)
                if len(calls) == at:
                    raise OSError("broken")
                real(s, old, new)

            monkeypatch.setattr(commit, "_renamed", renamed)
            with pytest.raises(OSError):
                save(spark.range(10, 13), obj, table="kept.t")
            assert rows() == OLD and [t.name for t in spark.catalog.listTables("kept")] == ["t"]
        monkeypatch.setattr(commit, "_renamed", real)
        real(spark, "kept.t", "kept.t_replaced_1")  # a process that ended between the renames
        commit.recover_table(spark, "kept.t")
        assert rows() == OLD
        save(spark.range(10, 13), obj, table="kept.t")
        assert rows() == NEW and [t.name for t in spark.catalog.listTables("kept")] == ["t"]
        assert spark.catalog.getTable("kept.t").description == "it's new"
        assert spark.sql("SHOW TBLPROPERTIES kept.t ('tag.owner')").first().value == "me"
    finally:
        spark.sql("DROP DATABASE kept CASCADE")
