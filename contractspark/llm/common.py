"""Helpers that the operators of this subpackage share: reading tables, shared folders, words, label folds."""

from __future__ import annotations

import re
import sys
import types
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that separate words in the alphanumeric word rule: everything below 0x80 but 0-9 and a-z (A-Z is lower-cased).
_ALNUM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: A-Z lower-cased, everything else as it is; bytes.split() then cuts at 0x20 and 0x09-0x0D.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def alnum_words(text: str | None) -> list[bytes]:
    """UTF-8 words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased; none for null."""
    return text.encode("utf-8", "replace").translate(_ALNUM).split() if text else []


def blank_words(text: str | None) -> list[bytes]:
    """UTF-8 words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; none for null."""
    return text.encode("utf-8", "replace").translate(_LOWER).split() if text else []


def bounded_batches(spark: SparkSession, bytes_per_batch: int = 16 << 20, rows_per_batch: int = 2000) -> None:
    """Let Python tasks get texts in batches of at most these rows and about these bytes, unless the session asks for less.

    The default of 10,000 rows is far too many where a row is a whole document.
    """
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows_per_batch), ("spark.sql.execution.arrow.maxBytesPerBatch", bytes_per_batch)):
        now = spark.conf.get(key, None)
        if not (now and now.isdigit() and 0 < int(now) <= most):
            spark.conf.set(key, str(most))


def per_process(key: tuple, make: Callable[[], object]) -> object:
    """One object per Python worker process, which runs many tasks: for what is costly to make and only saves time.

    A worker keeps the object of one key at a time: an executor's workers outlive the job that filled it, and memories of
    several operators would add up.
    """
    kept = sys.modules.setdefault("_contractspark_llm_kept", types.ModuleType("_contractspark_llm_kept")).__dict__
    if key not in kept:
        for other in [k for k in kept if isinstance(k, tuple)]:
            del kept[other]
        kept[key] = make()
    return kept[key]


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether ``crc32(doc_id as text) mod folds`` is 0; a null id is never held out (and never learnt from)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns of these names (in any case): the operator's own result columns replace them."""
    low = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in low])


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder for an intermediate table below ``spark.checkpoint.dir``; every executor sees that folder.

    Only where the session names none (tests on one machine) the context's own checkpoint folder is used; without
    either it raises, as a machine-local folder would be wrong on a cluster.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        kept = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = kept.get() if kept.isDefined() else None
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        import tempfile

        base = tempfile.mkdtemp(prefix="contractspark-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Lets Spark delete the shuffle files of a query when it ends, not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: cuts lineage, survives lost executors."""
    return stored_in_turn([df], name)


def stored_in_turn(frames: Iterable[DataFrame], name: str) -> DataFrame:
    """The rows of one or more frames of one schema as one stored table; a frame's shuffle files go before the next is computed."""
    path = None
    for df in frames:
        spark = df.sparkSession
        path = path or shared_path(spark, name)
        before = spark.conf.get(_CLEANUP, None)
        spark.conf.set(_CLEANUP, "true")
        try:
            df.write.mode("append").parquet(path)
        finally:
            spark.conf.set(_CLEANUP, before) if before else spark.conf.unset(_CLEANUP)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def forget(*frames: DataFrame) -> None:
    """Delete the folders of ``stored`` frames that nothing reads any more."""
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(df.sparkSession._jsc.sc().hadoopConfiguration()).delete(path, True)
