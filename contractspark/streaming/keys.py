"""W4 on a stream: key groups that break the key over all increments, with the counts kept as Spark's keyed state.

The state is a count per key, dealt over the tasks by key and stored with the query's checkpoint, so it outlives restarts. Each
micro-batch gives the keys it has touched with their counts so far; those that break the key go to a folder named by the batch
id, which a micro-batch that runs again replaces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import col
from ..operators.commit import replace_all
from ..operators.keys import _any_null
from ..operators.write import primary_key
from ..spec import ContractError, object_spec
from .stream import checked_stream


def run_key_check(spark: SparkSession, obj, source_path: str, violations_path: str, checkpoint: str | None = None, fmt: str = "parquet", **kw):
    """Check the object's key over everything that is new and all that was read before; returns the finished query."""
    obj = object_spec(obj)
    keys = primary_key(obj)
    if not keys:
        raise ContractError("ODCS-KEY-001", f"object {obj.name!r} has no primary key")
    rows = checked_stream(spark, obj, source_path, fmt=fmt, **kw)
    counts = rows.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("n_rows"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        broken = batch.where(_any_null(keys) | (F.col("n_rows") > 1))
        replace_all(spark, [(f"{violations_path.rstrip('/')}/batch_id={batch_id}", broken.write.save)])

    q = (counts.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint or f"{violations_path.rstrip('/')}_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def streamed_key_violations(spark: SparkSession, obj, violations_path: str) -> DataFrame:
    """``(keys..., n_rows, violation)`` as ``key_violations`` has them for all rows read so far."""
    keys = primary_key(object_spec(obj))
    found = spark.read.parquet(violations_path).groupBy(*[col(k) for k in keys]).agg(F.max("n_rows").alias("n_rows"))
    return found.withColumn("violation", F.when(_any_null(keys), F.lit("null_key")).otherwise(F.lit("duplicate")))
