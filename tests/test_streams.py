"""Streams: ledger, NOT NULL, keys over increments, micro-batches that run again."""

import datetime
import glob
import os

import pytest

import contractspark as cs
from contractspark.operators.keys import key_suspects, key_violations_against, key_violations_in_two_steps
from contractspark.plans.stream_queries import stream_contract
from contractspark.plans.table_queries import ORACLE
from contractspark.spec import ObjectSpec
from contractspark.streaming.keys import run_key_check, streamed_key_violations
from contractspark.streaming.stream import ledger_counts, run_stream

OBJ = ObjectSpec.from_dict({"name": "t", "properties": [
    {"name": "id", "logicalType": "integer", "physicalType": "BIGINT", "primaryKey": True, "logicalTypeOptions": {"minimum": 3}},
    {"name": "word", "logicalType": "string", "physicalType": "STRING", "logicalTypeOptions": {"maxLength": 2}}]})
ROWS = [[(1, "a"), (2, "abc"), (3, None)], [(4, "abcd"), (1, "x"), (5, "y")], [(6, "zzz"), (5, "y"), (5, "w")]]


def increment(spark, folder, k):
    spark.createDataFrame(ROWS[k], "id long, word string").coalesce(1).write.mode("append").parquet(folder)


def again(checkpoint):
    """The last micro-batch ended between its writes and its commit: it runs again."""
    last = max(glob.glob(f"{checkpoint}/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    os.remove(last)
    crc = f"{checkpoint}/commits/.{os.path.basename(last)}.crc"
    if os.path.exists(crc):
        os.remove(crc)


def test_ledger_of_three_increments_equals_the_batch_summary(spark, tmp_path):
    src, out, ledger = (str(tmp_path / x) for x in ("in", "out", "ledger"))
    for k in range(3):
        increment(spark, src, k)
        run_stream(spark, OBJ, src, out, ledger=ledger)
        batch = spark.createDataFrame(sum(ROWS[:k + 1], []), "id long, word string")
        expect = {r.expectation: (r.checked, r.failed, r.passed) for r in cs.summarize(batch, cs.rules(OBJ)).collect()}
        for _ in range(2):
            got = {r.expectation: (r.checked, r.failed, r.passed) for r in ledger_counts(spark, ledger).collect()}
            assert got == expect
            assert sorted((r.id, r.word or "") for r in spark.read.parquet(out).collect()) == sorted((i, w or "") for i, w in sum(ROWS[:k + 1], []))
            again(f"{out}_checkpoint")
            run_stream(spark, OBJ, src, out, ledger=ledger)
    assert len(os.listdir(ledger)) == 3 and not [x for x in os.listdir(out) if x.startswith("_")]


@pytest.mark.parametrize("ledger", [False, True])
def test_null_in_a_key_ends_the_stream_as_it_ends_the_batch(spark, tmp_path, ledger):
    spark.createDataFrame([(None, "a")], "id long, word string").write.parquet(f"{tmp_path}/in")
    more = {"ledger": f"{tmp_path}/ledger"} if ledger else {}
    with pytest.raises(Exception, match="NOT NULL|NULL in"):
        run_stream(spark, OBJ, f"{tmp_path}/in", f"{tmp_path}/out", **more)
    run_stream(spark, OBJ, f"{tmp_path}/in", f"{tmp_path}/out2", enforce_not_null=False)
    assert spark.read.parquet(f"{tmp_path}/out2").count() == 1


def test_key_broken_over_increments_and_restarts(spark, tmp_path):
    src, found = str(tmp_path / "in"), str(tmp_path / "found")
    for k in range(3):
        increment(spark, src, k)
        run_key_check(spark, OBJ, src, found)  # a new query each time: a restart
        again(f"{found}_checkpoint")
        run_key_check(spark, OBJ, src, found)
        batch = spark.createDataFrame(sum(ROWS[:k + 1], []), "id long, word string")
        expect = {tuple(r) for r in cs.key_violations(batch, ["id"]).collect()}
        assert {tuple(r) for r in streamed_key_violations(spark, OBJ, found).collect()} == expect
    assert expect == {(1, 2, "duplicate"), (5, 3, "duplicate")}


KEYED = [(i % 700, "k" * (i % 3) if i % 50 else None) for i in range(1500)] + [(None, "x"), (None, None)] * 20


@pytest.mark.parametrize("bits", [1 << 15, 1 << 20, 8])
def test_two_steps_equal_one(spark, bits):
    """Few bits let other rows through as well; the result stays exact."""
    df = spark.createDataFrame(KEYED, "a long, `b.c` string")
    expect = {tuple(r) for r in cs.key_violations(df, ["a", "b.c"]).collect()}
    assert {tuple(r) for r in key_violations_in_two_steps(df, ["a", "b.c"], bits).collect()} == expect
    assert key_violations_in_two_steps(df.limit(0), ["a"], bits).count() == 0


def test_two_steps_shuffle_hashes_and_suspects_only(spark):
    df = spark.range(0, 100_000, 1, 8).selectExpr("id as a", "concat('a long key text ', id) as b")
    df = df.union(df.where("a % 1000 = 0"))
    suspects = key_suspects(df, ["a", "b"])
    assert suspects.count() < 1000  # of 100,100 rows: the 200 rows of 100 keys, and a few whose bit is set by chance
    plan = key_violations_in_two_steps(df, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert any("hashpartitioning(h#" in line for line in moved) and "BroadcastExchange" in plan
    assert key_violations_in_two_steps(df, ["a", "b"]).count() == 100


def test_keys_against_rows_that_are_there(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, "n"), (4, "d")], "a long, b string")
    new = spark.createDataFrame([(1, "a"), (3, "c"), (5, "e"), (5, "e"), (None, "n")], "a long, b string")
    got = {tuple(r) for r in key_violations_against(new, old, ["a", "b"]).collect()}
    assert got == {(1, "a", 2, 1, "duplicate"), (5, "e", 2, 2, "duplicate"), (None, "n", 1, 1, "null_key")}
    assert key_violations_against(new.limit(0), old, ["a"]).count() == 0 and key_violations_against(new, old.limit(0), ["a", "b"]).count() == 2


def test_stream_contract_takes_the_source_file_from_the_files_read(spark, tmp_path):
    ddl = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    rows = [(i, datetime.datetime(2024, 1, 1 + i), i % 2, "view", 1.5, '{"k": %d, "j": "x"}' % i) for i in (0, 1, 1, 2, 3)]
    spark.createDataFrame(rows, ddl).write.parquet(f"{tmp_path}/events.parquet")
    got = stream_contract(spark, str(tmp_path)).select("event_id", "props_k", "_source_file").collect()
    assert sorted(map(tuple, got)) == [(r[0], r[0], "events.parquet") for r in rows]
    assert "'events.parquet' AS _source_file" in ORACLE["stream_contract"]
