"""Parse string-encoded source columns into their typed form, with Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import types as ty
from ..functions.names import col
from ..spec import SCD2_COLUMNS, object_spec
from ..types import ColumnPlan, plan_columns

MODES = ("strict", "lenient")


def conversion_expr(c: Column, plan: ColumnPlan, mode: str = "strict") -> Column:
    """The expression that turns the text in ``c`` into the column's final type.

    ``strict`` uses the plain functions (under ANSI a bad date or timestamp text aborts the job); ``lenient`` uses
    the ``try_`` forms, which give NULL instead. JSON to struct/array is permissive in both modes (malformed text
    gives NULL fields), as Spark's ``from_json`` is.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    kind = plan.conversion
    opts = plan.spec.options
    lenient = mode == "lenient"
    if kind == ty.TO_DATE:
        return F.try_to_date(c, opts["format"]) if lenient else F.to_date(c, opts["format"])
    if kind == ty.TO_TIMESTAMP:
        fmt = opts["format"]
        return F.try_to_timestamp(c, F.lit(fmt)) if lenient else F.to_timestamp(c, fmt)
    if kind == ty.TO_UTC_TIMESTAMP:
        # The text is a wall clock in ``defaultTimezone``. Parse it without a zone, move the wall clock from that zone
        # to the session zone, then read it as an instant: right whatever the session time zone is.
        fmt = opts["format"]
        parsed = F.try_to_timestamp(c, F.lit(fmt)) if lenient else F.to_timestamp(c, fmt)
        wall = parsed.cast("timestamp_ntz")
        return F.convert_timezone(F.lit(opts["defaultTimezone"]), F.current_timezone(), wall).cast("timestamp")
    if kind in (ty.FROM_JSON_STRUCT, ty.FROM_JSON_ARRAY):
        return F.from_json(c, plan.final.dtype)
    if kind == ty.PARSE_JSON:
        return F.try_parse_json(c) if lenient else F.parse_json(c)
    if kind == ty.UNBASE64:
        return F.try_to_binary(c, F.lit("base64")) if lenient else F.unbase64(c)
    return c


def convert(df: DataFrame, obj, exclude=SCD2_COLUMNS, mode: str = "strict") -> DataFrame:
    """Replace every string-encoded source column (by its source name) with its parsed value, in one ``select``.

    Excluded columns are never converted; an object without conversions comes back unchanged.
    """
    obj = object_spec(obj)
    conv = {p.source.lower(): p for p in plan_columns(obj, exclude) if p.conversion and not p.excluded}
    if not conv:
        return df
    out = []
    for name in df.columns:
        p = conv.get(name.lower())
        out.append(conversion_expr(col(name), p, mode).alias(name) if p else col(name))
    return df.select(*out)
