"""Rename source columns to contract names and cast them to their final types (nested types by name)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import col
from ..spec import SCD2_COLUMNS, ContractError, object_spec
from ..types import plan_columns


def _has_struct(dt: T.DataType) -> bool:
    if isinstance(dt, T.StructType):
        return True
    if isinstance(dt, T.ArrayType):
        return _has_struct(dt.elementType)
    if isinstance(dt, T.MapType):
        return _has_struct(dt.keyType) or _has_struct(dt.valueType)
    return False


def _plain_cast(c: Column, dst: T.DataType, lenient: bool) -> Column:
    return c.try_cast(dst) if lenient else c.cast(dst)


def cast_to(c: Column, src: T.DataType, dst: T.DataType, lenient: bool = False) -> Column:
    """Cast ``c`` from ``src`` to ``dst``; struct fields are matched by name, not by position.

    Spark casts one struct to another by position, and cannot cast a MAP to a STRUCT at all, so structs are rebuilt
    field by field (a NULL parent stays NULL); arrays and maps of structs go through ``transform``.
    """
    if src == dst:
        return c
    if isinstance(dst, T.StructType) and isinstance(src, (T.StructType, T.MapType)):
        fields = []
        if isinstance(src, T.StructType):
            by_name = {f.name: f for f in src.fields}
            by_lower = {f.name.lower(): f for f in src.fields}
            for f in dst.fields:
                sf = by_name.get(f.name) or by_lower.get(f.name.lower())
                if sf is None:
                    fields.append(F.lit(None).cast(f.dataType).alias(f.name))
                else:
                    fields.append(cast_to(c.getField(sf.name), sf.dataType, f.dataType, lenient).alias(f.name))
        else:
            for f in dst.fields:
                key = F.lit(f.name) if isinstance(src.keyType, T.StringType) else F.lit(f.name).cast(src.keyType)
                fields.append(cast_to(F.try_element_at(c, key), src.valueType, f.dataType, lenient).alias(f.name))
        return F.when(c.isNull(), F.lit(None).cast(dst)).otherwise(F.struct(*fields))
    if isinstance(dst, T.ArrayType) and isinstance(src, T.ArrayType) and _has_struct(dst):
        return F.transform(c, lambda x: cast_to(x, src.elementType, dst.elementType, lenient))
    if isinstance(dst, T.MapType) and isinstance(src, T.MapType) and _has_struct(dst):
        c = F.transform_values(c, lambda k, v: cast_to(v, src.valueType, dst.valueType, lenient))
        if src.keyType != dst.keyType:
            c = F.transform_keys(c, lambda k, v: _plain_cast(k, dst.keyType, lenient))
        return c
    return _plain_cast(c, dst, lenient)


def rename_cast(df: DataFrame, obj, exclude=SCD2_COLUMNS, mode: str = "strict", keep_other: bool = False) -> DataFrame:
    """Rename source → contract names and cast every kept column to its final type, in one ``select``.

    Strict projection (T5): only contract columns survive; excluded (operational / SCD2) columns that are present flow
    through uncast. ``keep_other=True`` keeps unknown columns as well, after the contract ones. A rename is a single
    projection, so swapping two names works. ``mode="lenient"`` uses ``try_cast`` (NULL instead of an error).
    """
    obj = object_spec(obj)
    lenient = mode == "lenient"
    present = {f.name.lower(): f for f in df.schema.fields}
    out, used = [], set()
    for p in plan_columns(obj, exclude):
        if p.excluded:
            f = present.get(p.name.lower())
            if f is not None:
                out.append(col(f.name))
                used.add(f.name.lower())
            continue
        f = present.get(p.source.lower())
        if f is None:
            raise ContractError("ODCS-COL-002", f"object {obj.name!r}: column {p.source!r} not found")
        used.add(f.name.lower())
        out.append(cast_to(col(f.name), f.dataType, p.final.dtype, lenient).alias(p.name))
    if keep_other:
        out += [col(f.name) for f in df.schema.fields if f.name.lower() not in used]
    return df.select(*out)
