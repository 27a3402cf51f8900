"""A contract applied to a stream.

Every data operator is a projection or a filter, so the batch plan is valid on a streaming DataFrame unchanged:
``readStream.schema(read_schema)`` → convert → cast → gate → ``writeStream``, NOT NULL checks as in batch.

With a ledger the micro-batches go through ``foreachBatch``. A micro-batch's rows and its rule counts (collected by the write
itself) are each a folder named by the batch id, put in place by a rename when complete. A micro-batch that runs again after a
fault replaces its own folders and nothing else, so rows and counts are there once. ``ledger_counts`` adds the counts up.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cast import rename_cast
from ..operators.convert import convert
from ..operators.commit import replace_all
from ..operators.expect import _count_exprs, gate, observe_rules, rule_counts, rules
from ..operators.write import write_frame
from ..sources.load import load, read_schema
from ..spec import SCD2_COLUMNS, ContractError, object_spec


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A new folder under the cluster's shared checkpoint folder (``spark.checkpoint.dir``), which must be set."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ContractError("ODCS-RUN-002", "set spark.checkpoint.dir to a folder that the driver and all executors share")
    return "/".join([base.rstrip("/"), *parts, uuid.uuid4().hex])


def checked_stream(spark: SparkSession, obj, source_path: str, fmt: str = "parquet", exclude=SCD2_COLUMNS,
                   mode: str = "strict", read_as: str = "final", max_files_per_trigger: int | None = None,
                   operational: dict | None = None, options: dict | None = None) -> DataFrame:
    """The stream's renamed and cast rows, before rules: read with the contract's schema, converted, cast.

    ``operational`` adds loader columns (operational metadata) such as ``{"_source_file":
    F.col("_metadata.file_name")}``; they flow through uncast like any excluded column.
    """
    obj = object_spec(obj)
    reader = spark.readStream.schema(read_schema(obj, exclude, read_as=read_as)).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    df = reader.load(source_path)
    if operational:
        df = df.withColumns(operational)
    df = convert(load(df, obj, exclude, read_as="source"), obj, exclude, mode=mode)
    return rename_cast(df, obj, exclude, mode=mode)


def stream_frame(spark: SparkSession, obj, source_path: str, exclude=SCD2_COLUMNS, enforce_not_null: bool = False, **kw) -> DataFrame:
    """The streaming plan: ``checked_stream``, gated and projected to the write shape.

    Rule counts come with each micro-batch through ``observe`` (``query.lastProgress["observedMetrics"]``). With
    ``enforce_not_null`` a NULL in a required or key column ends the query, as it ends a batch run (W2).
    """
    obj = object_spec(obj)
    checked = checked_stream(spark, obj, source_path, exclude=exclude, **kw)
    rule_list = rules(obj, checked.columns)
    if rule_list:
        checked = checked.observe(f"rules_{obj.name}", F.count(F.lit(1)).alias("rows"), *_count_exprs(rule_list, "r"))
    return write_frame(gate(checked, rule_list, message=f"contract {obj.name}: rule failed"), obj, exclude, enforce_not_null=enforce_not_null)


LEDGER_DDL = "batch_id long, rule_idx int, expectation string, column_name string, action string, checked long, failed long"


def batch_sink(obj, target_path: str, ledger: str, out_fmt: str = "parquet", exclude=SCD2_COLUMNS, enforce_not_null: bool = True):
    """The ``foreachBatch`` function: a micro-batch's rows to ``<target>/batch_id=<id>``, its counts to ``<ledger>/batch=<id>``."""
    obj = object_spec(obj)

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark, rule_list = batch.sparkSession, rules(obj, batch.columns)
        watched, seen = observe_rules(batch, rule_list, name=f"rules_{obj.name}_{batch_id}") if rule_list else (batch, None)
        frame = write_frame(gate(watched, rule_list, message=f"contract {obj.name}: rule failed"), obj, exclude, enforce_not_null=enforce_not_null)

        def counts(folder: str) -> None:  # the rows have been written: their counts are known
            rows = [(batch_id, i, r["expectation"], r["column_name"], r["action"], r["checked"], r["failed"]) for i, r in enumerate(rule_counts(seen, rule_list))] if seen else []
            spark.createDataFrame(rows, LEDGER_DDL).coalesce(1).write.parquet(folder)

        replace_all(spark, [(f"{target_path.rstrip('/')}/batch_id={batch_id}", frame.write.format(out_fmt).save), (f"{ledger.rstrip('/')}/batch={batch_id}", counts)])

    return sink


def ledger_counts(spark: SparkSession, ledger: str) -> DataFrame:
    """``(rule_idx, expectation, column_name, action, checked, failed, passed)`` over all micro-batches so far, as ``summarize`` has them."""
    read = spark.read.schema(LEDGER_DDL).option("recursiveFileLookup", "true").parquet(ledger)
    total = read.groupBy("rule_idx", "expectation", "column_name", "action").agg(F.sum("checked").alias("checked"), F.sum("failed").alias("failed"))
    return total.withColumn("passed", F.col("checked") - F.col("failed"))


def run_stream(spark: SparkSession, obj, source_path: str, target_path: str, checkpoint: str | None = None,
               fmt: str = "parquet", out_fmt: str = "parquet", ledger: str | None = None, enforce_not_null: bool = True, **kw):
    """Run the stream once over everything that is new (``availableNow``) and return the finished query.

    The checkpoint belongs to the target: by default it is the folder ``<target>_checkpoint`` beside it (on the target's
    shared storage), so a further run into the same target goes on where the last one ended. ``ledger`` is a folder for the rule
    counts of all runs; the target then has a folder ``batch_id=<id>`` per micro-batch (a partition column to its readers).
    """
    checkpoint = checkpoint or f"{target_path.rstrip('/')}_checkpoint"
    if ledger is None:
        df = stream_frame(spark, obj, source_path, fmt=fmt, enforce_not_null=enforce_not_null, **kw)
        start = df.writeStream.format(out_fmt).outputMode("append")
    else:
        df = checked_stream(spark, obj, source_path, fmt=fmt, **kw)
        start = df.writeStream.foreachBatch(batch_sink(obj, target_path, ledger, out_fmt, kw.get("exclude", SCD2_COLUMNS), enforce_not_null))
    start = start.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    q = start.start(target_path) if ledger is None else start.start()
    q.awaitTermination()
    return q
