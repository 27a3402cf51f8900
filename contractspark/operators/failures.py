"""Values that can't be converted, as data.

A lenient run turns what it can't read into NULL, and ``from_json`` is lenient always. Here each such value is found beside its
conversion, by the source text and a second look at it:

* text that gives NULL although it isn't NULL (dates, timestamps, base64, variants, plain casts),
* JSON that Spark reads only in part: ``from_json`` keeps what is left of it in a corrupt-record field, which is asked for here
  and not kept in the result. A JSON ``null`` is no failure.

``with_failures`` adds them to the rows, ``failure_counts`` counts them in one scan, ``observe_failures`` counts them while the
rows are written, ``rejected`` gives the rows with what was wrong in them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import types as ty
from ..functions.names import col
from ..spec import SCD2_COLUMNS, object_spec
from ..types import ColumnPlan, plan_columns
from .cast import cast_to
from .convert import conversion_expr

_CORRUPT = "_not_json"


def _json_failed(c: Column, dtype: T.DataType) -> Column:
    options = {"columnNameOfCorruptRecord": _CORRUPT}
    kept = T.StructField(_CORRUPT, T.StringType())
    none = F.trim(c) == "null"
    parsed = F.from_json(c, dtype)
    if isinstance(dtype, T.StructType):
        if _CORRUPT in (f.name for f in dtype.fields):
            return c.isNotNull() & parsed.isNull() & ~none
        again = F.from_json(c, T.StructType([*dtype.fields, kept]), options)
        return c.isNotNull() & ~none & (parsed.isNull() | again.getField(_CORRUPT).isNotNull())
    # an array has no place for a corrupt record: look at it as a field of an object
    boxed = F.from_json(F.concat(F.lit('{"v":'), c, F.lit("}")), T.StructType([T.StructField("v", dtype), kept]), options)
    return c.isNotNull() & ~none & (parsed.isNull() | (F.startswith(F.ltrim(c), F.lit("[")) & boxed.getField(_CORRUPT).isNotNull()))


def conversion_failed(c: Column, plan: ColumnPlan, source: T.DataType) -> Column | None:
    """Whether the source value ``c`` of a column can't be read as its final type; None where every value can."""
    if plan.conversion in (ty.FROM_JSON_STRUCT, ty.FROM_JSON_ARRAY):
        return _json_failed(c, plan.final.dtype)
    if plan.conversion:
        return c.isNotNull() & conversion_expr(c, plan, "lenient").isNull()
    target = plan.final.dtype
    if source == target or isinstance(target, (T.StringType, T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return None
    return c.isNotNull() & cast_to(c, source, target, lenient=True).isNull()


def failing(df: DataFrame, obj, exclude=SCD2_COLUMNS) -> dict[str, tuple[str, Column]]:
    """{contract name: (source name, condition)} of the columns in which a value may fail; ``df`` has the source columns."""
    present, out = {f.name.lower(): f for f in df.schema.fields}, {}
    for p in plan_columns(object_spec(obj), exclude):
        f = present.get(p.source.lower())
        if p.excluded or f is None:
            continue
        condition = conversion_failed(col(f.name), p, f.dataType)
        if condition is not None:
            out[p.name] = (f.name, F.coalesce(condition, F.lit(False)))
    return out


def with_failures(df: DataFrame, obj, exclude=SCD2_COLUMNS, column: str = "_failed") -> DataFrame:
    """``df`` (source columns) with an ``array<struct<column, text>>`` of the values that can't be converted."""
    kind = "array<struct<column:string,text:string>>"
    none = F.array().cast(kind)
    found = [F.when(bad, F.array(F.struct(F.lit(name).alias("column"), col(source).cast("string").alias("text"))).cast(kind)).otherwise(none)
             for name, (source, bad) in failing(df, obj, exclude).items()]
    return df.withColumn(column, F.concat(none, *found))


def rejected(df: DataFrame, obj, exclude=SCD2_COLUMNS, column: str = "_failed") -> DataFrame:
    """The rows with a value that can't be converted, source texts as they are: the side output of a lenient run."""
    return with_failures(df, obj, exclude, column).where(F.size(column) > 0)


def _counts(found: dict) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), *[F.coalesce(F.sum(F.when(bad, 1).otherwise(0)), F.lit(0)).cast("long").alias(f"f{i}") for i, (_, bad) in enumerate(found.values())]]


def failure_counts(df: DataFrame, obj, exclude=SCD2_COLUMNS) -> DataFrame:
    """``(column, checked, failed)``, a row per column in which a value may fail; one scan, one sum per column."""
    found = failing(df, obj, exclude)
    if not found:
        return df.sparkSession.createDataFrame([], "column string, checked long, failed long")
    each = F.array(*[F.struct(F.lit(name).alias("column"), F.col("rows").alias("checked"), F.col(f"f{i}").alias("failed")) for i, name in enumerate(found)])
    return df.agg(*_counts(found)).select(F.inline(each))


def observe_failures(df: DataFrame, obj, exclude=SCD2_COLUMNS, name: str = "conversion_failures"):
    """``(df, counts)``: the next action on the returned frame counts failures in flight; ``counts()`` then has {column: failed}."""
    found = failing(df, obj, exclude)
    seen = Observation(name)
    return df.observe(seen, *_counts(found)), lambda: {c: seen.get[f"f{i}"] for i, c in enumerate(found)}
