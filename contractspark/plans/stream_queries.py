"""Queries of streams (S1/P2) and of keys in two steps (W4) over the driver's tables, registered into ``table_queries.QUERIES``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.keys import key_violations_against, key_violations_in_two_steps
from ..spec import ObjectSpec
from ..streaming.keys import run_key_check, streamed_key_violations
from ..streaming.stream import ledger_counts, run_stream
from . import tables as tb
from .table_queries import EVENTS_SQL, EXCLUDE, events_flat, obj, query, summary_sql, table, work_dir


def increments(spark, d, folder):
    """The events in two files, of which the second comes later: nothing is lost or doubled when the stream runs again."""
    events = table(spark, d, "events")
    for k, part in enumerate((F.col("event_id") % 2 == 0, ~F.coalesce(F.col("event_id") % 2 == 0, F.lit(False)))):
        events.where(part).write.mode("append").parquet(folder)
        yield k


@query("stream_contract", EVENTS_SQL.replace("'events' AS _source_file", "'events.parquet' AS _source_file"))
def stream_contract(spark, d):
    """The events contract run as a stream (``availableNow``) over two increments, into a folder under the shared checkpoint
    folder, then read back: the same rows as the batch run, with ``_source_file`` filled by the loader from the metadata of the
    file that a row was read from: the table's name, under which Spark keeps its part files."""
    source, target = work_dir(spark, "stream_contract", "in") + "/events.parquet", work_dir(spark, "stream_contract", "out")
    read_from = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    for _ in increments(spark, d, source):
        run_stream(spark, obj(tb.EVENTS), source, target, exclude=EXCLUDE, operational={"_source_file": read_from})
    return events_flat(spark.read.parquet(target))


@query("stream_ledger", summary_sql("events", [
    ("event_id_not_null", "fail", "event_id IS NOT NULL"), ("event_id_min", "fail", "event_id >= 0"), ("ts_not_null", "warn", "ts IS NOT NULL"),
    ("user_id_min", "warn", "user_id >= 0"), ("event_type_pattern", "warn", "regexp_matches(event_type, '^(view|click|purchase|signup)$')"),
    ("amount_min", "warn", "value >= 0"), ("amount_max", "warn", "value <= 50")]))
def stream_ledger(spark, d):
    """E20 on a stream: the rule counts of all micro-batches of two runs, added up in a ledger."""
    columns = ["event_id", "ts", "user_id", "event_type", "amount"]
    source, target, ledger = (work_dir(spark, "stream_ledger", x) for x in ("in", "out", "ledger"))
    for _ in increments(spark, d, source):
        run_stream(spark, obj(tb.EVENTS, columns), source, target, exclude=EXCLUDE, ledger=ledger)
    return ledger_counts(spark, ledger).select("expectation", "action", "checked", "failed")


_USERS = {"name": "events", "properties": [tb._p("user_id", "integer", "BIGINT", primaryKey=True), tb._p("event_type", "string", "STRING", primaryKey=True)]}


@query("stream_key_violations",
       "SELECT user_id, event_type, count(*) AS n_rows, CASE WHEN user_id IS NULL OR event_type IS NULL THEN 'null_key' ELSE 'duplicate' END AS violation "
       "FROM events GROUP BY ALL HAVING count(*) > 1 OR user_id IS NULL OR event_type IS NULL")
def stream_key_violations(spark, d):
    """W4 over two increments: keys that are in both, or twice in one."""
    source, found = work_dir(spark, "stream_keys", "in"), work_dir(spark, "stream_keys", "found")
    for _ in increments(spark, d, source):
        run_key_check(spark, ObjectSpec.from_dict(_USERS), source, found)
    return streamed_key_violations(spark, ObjectSpec.from_dict(_USERS), found)


_PAIRS = ["l_partkey", "l_suppkey"]


@query("key_violations_suspects", "SELECT l_partkey, l_suppkey, count(*) AS n_rows, 'duplicate' AS violation FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def key_violations_suspects(spark, d):
    return key_violations_in_two_steps(table(spark, d, "lineitem"), _PAIRS)


@query("key_violations_existing",
       "SELECT l_partkey, l_suppkey, count(*) AS n_rows, CAST(sum(CASE WHEN l_orderkey % 10 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_new, 'duplicate' AS violation "
       "FROM lineitem GROUP BY l_partkey, l_suppkey HAVING count(*) > 1 AND sum(CASE WHEN l_orderkey % 10 = 0 THEN 1 ELSE 0 END) > 0")
def key_violations_existing(spark, d):
    """Every tenth order is new; the others are the target's rows."""
    rows, new = table(spark, d, "lineitem"), F.col("l_orderkey") % 10 == 0
    return key_violations_against(rows.where(new), rows.where(~new), _PAIRS)
