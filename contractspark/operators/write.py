"""The written shape of a contract object, its key, and the sink."""

from __future__ import annotations

import datetime as _dt
import decimal as _dec
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import col
from ..spec import ContractError, SCD2_COLUMNS, object_spec
from ..types import plan_columns
from .commit import replace_all, replace_table
from .sized import sized
from .tags import column_tag_map, table_tag_map


def _meta(plan) -> dict:
    m = {}
    if plan.spec.has_description:
        m["comment"] = plan.spec.description
    tags = column_tag_map(plan.spec)
    if tags:
        m["tags"] = json.dumps(tags, sort_keys=True)
    return m


def write_schema(obj) -> T.StructType:
    """Every column (operational and SCD2 too), contract names, final types, declared order; not nullable
    when required or a primary key; description as comment; column tags as JSON metadata."""
    obj = object_spec(obj)
    return T.StructType([T.StructField(p.name, p.final.dtype, p.write_nullable, _meta(p)) for p in plan_columns(obj)])


def primary_key(obj) -> list[str]:
    """Key columns ordered by ``primaryKeyPosition`` (default 0), declaration order breaking ties."""
    obj = object_spec(obj)
    return [c.name for c in sorted((c for c in obj.columns if c.primary_key), key=lambda c: c.pk_position)]


def _zero(dt: T.DataType) -> Column:
    """A non-null constant of any type: lets ``coalesce`` turn a checked column into a NOT NULL one."""
    if isinstance(dt, T.StructType):
        return F.struct(*[_zero(f.dataType).alias(f.name) for f in dt.fields])
    if isinstance(dt, T.ArrayType):
        return F.array().cast(dt)
    if isinstance(dt, T.MapType):
        return F.create_map().cast(dt)
    if isinstance(dt, T.StringType):
        return F.lit("")
    if isinstance(dt, T.BinaryType):
        return F.lit(bytearray())
    if isinstance(dt, T.BooleanType):
        return F.lit(False)
    if isinstance(dt, T.DateType):
        return F.lit(_dt.date(1970, 1, 1))
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01 00:00:00").cast(dt)
    if isinstance(dt, T.DecimalType):
        return F.lit(_dec.Decimal(0)).cast(dt)
    if isinstance(dt, T.VariantType):
        return F.parse_json(F.lit("null"))
    return F.lit(0).cast(dt)


def write_frame(df: DataFrame, obj, exclude=SCD2_COLUMNS, enforce_not_null: bool = False) -> DataFrame:
    """Project to the write schema in one ``select``.

    Excluded columns that are absent (injected later by the writer) come out as typed NULLs; an absent contract column
    is an error. With ``enforce_not_null`` a row with NULL in a not-nullable column aborts the job, and those columns
    come out NOT NULL in the schema (W2); without it nullability is carried as the ``write_schema`` only.
    """
    obj = object_spec(obj)
    present = {f.name.lower(): f for f in df.schema.fields}
    plans = plan_columns(obj, exclude)
    missing = [p.name for p in plans if not p.excluded and p.name.lower() not in present]
    if missing:
        raise ContractError("ODCS-COL-002", f"object {obj.name!r}: columns not found for write: {missing}")
    out, checks = [], []
    for p in plans:
        f = present.get(p.name.lower())
        c = F.lit(None).cast(p.final.dtype) if f is None else col(f.name)
        if f is not None and f.dataType != p.final.dtype:
            c = c.cast(p.final.dtype)
        if enforce_not_null and not p.write_nullable:
            checks.append((p.name, c))
            c = F.coalesce(c, _zero(p.final.dtype))
        out.append(c.alias(p.name, metadata=_meta(p)))
    if checks:
        bad = F.lit(False)
        for _, c in checks:
            bad = bad | c.isNull()
        names = F.concat_ws(",", *[F.when(c.isNull(), F.lit(n)) for n, c in checks])
        df = df.filter(F.when(~bad, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("NULL in NOT NULL column: "),
                                                                                    names))))
    return df.select(*out)


def key_violations(df: DataFrame, keys) -> DataFrame:
    """Key groups that break the key: ``(keys..., n_rows, violation)`` with violation ``null_key`` or ``duplicate``.

    One ``groupBy`` on the key: partial counts are made per partition before the shuffle, so even a key that holds a
    third of the rows moves one row per map task.
    """
    keys = list(keys)
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | col(k).isNull()
    return (df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(any_null | (F.col("n_rows") > 1))
            .withColumn("violation", F.when(any_null, F.lit("null_key")).otherwise(F.lit("duplicate"))))


def save(df: DataFrame, obj, path: str | None = None, table: str | None = None, fmt: str = "parquet",
         mode: str = "overwrite", partition_by=None, file_bytes: int | None = None, scratch: str | None = None) -> None:
    """Write the (already projected) frame, replacing the previous output only once the new one is complete.

    With ``file_bytes`` the rows are dealt first so that files have about that size (``operators.sized``); ``scratch`` is a shared
    folder for the sample that this measures, by default the one beside ``path``.

    ``table`` creates a catalog table with the table description as comment and the merged table tags as table
    properties (``tag.<key>``); ``path`` writes files. Exactly one of the two.
    """
    obj = object_spec(obj)
    if (path is None) == (table is None):
        raise ValueError("give exactly one of path= or table=")
    spark = df.sparkSession
    if file_bytes:
        if not (scratch or path):
            raise ValueError("file_bytes needs scratch= where there is no path=")
        df = sized(df, scratch or path.rstrip("/").rpartition("/")[0] or ".", file_bytes, partition_by or (), fmt)
    w = df.write.format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path is not None:
        if mode == "overwrite":
            replace_all(spark, [(path, w.save)])
        else:
            w.mode(mode).save(path)
        return

    def described(name: str) -> None:
        props = {f"tag.{k}": v for k, v in table_tag_map(obj).items()}
        if props:
            body = ", ".join(f"{_sql_str(k)} = {_sql_str(v)}" for k, v in props.items())
            spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({body})")
        if obj.has_description and obj.description is not None:
            spark.sql(f"COMMENT ON TABLE {name} IS {_sql_str(obj.description)}")

    def made(name: str) -> None:
        w.saveAsTable(name)
        described(name)

    if mode == "overwrite":
        # the rows are made (and gates run) in a table beside it, which takes its place with tags and comment
        replace_table(spark, table, made)
    else:
        w.mode(mode).saveAsTable(table)
        described(table)


def _sql_str(v) -> str:
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
