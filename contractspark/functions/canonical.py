"""A canonical form of nested values that can be compared, grouped and hashed, with Spark's own functions.

Spark compares neither maps nor variants. Here a map is its entries sorted by key, and a variant is its JSON text, in which an
object's keys are in order already, with numbers in one form: ``1``, ``1.0`` and ``1e0`` are equal. Structs and arrays hold the
canonical forms of what is in them. Other types are as they are.

A number of a variant is compared as a decimal if it has up to 18 digits on either side of the point, else as a double.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A JSON string; possessive, so that a long one needs no stack.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
#: Pieces of a JSON text: strings, numbers, and what is between them.
_PIECES = rf'({_STRING}|-?[0-9][0-9.eE+-]*|[^"0-9-]+|-)'
#: A whole number that is written with a point, and texts all of whose numbers have their one form already (in up to 17 digits).
_POINTED = rf'({_STRING})|(?<![0-9.eE+-])(-?[1-9][0-9]{{0,16}}+|0)\.0++(?![0-9eE])'
_IN_FORM = rf'^(?:[^"0-9-]++|{_STRING}|(?:-?[1-9][0-9]{{0,16}}+|0)(?![0-9.eE])|-?(?:0|[1-9][0-9]{{0,16}}+)\.[0-9]{{1,17}}+(?<=[1-9])(?![0-9.eE]))*+$'


def needs_form(dtype: T.DataType | None) -> bool:
    """Whether the type holds something that Spark can't compare."""
    if isinstance(dtype, T.StructType):
        return any(needs_form(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return needs_form(dtype.elementType)
    return isinstance(dtype, (T.MapType, T.VariantType))


def _with(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with ``value`` worked out once, however often ``f`` names it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _number(text: Column) -> Column:
    def form(as_double: Column, as_decimal: Column) -> Column:
        short = (F.length(F.regexp_extract(text, r"\.([0-9]*?)0*$", 1)) <= 18) & (F.abs(as_double) < 1e18)
        plain = F.to_json(as_decimal.cast("variant"))  # without exponent and closing zeros
        return F.when(as_decimal.isNotNull() & short & (as_decimal.cast("double") == as_double), plain).otherwise(as_double.cast("string"))

    return _with(F.struct(text.try_cast("double").alias("f"), text.try_cast("decimal(38,18)").alias("d")), lambda x: form(x["f"], x["d"]))


def _json_form(value: Column) -> Column:
    """The text with its numbers in form; most texts are so when points of whole numbers are gone, others go by pieces."""
    def pieces(text: Column) -> Column:
        found = F.regexp_extract_all(text, F.lit(_PIECES), F.lit(1))
        return F.array_join(F.transform(found, lambda p: F.when(p.rlike("^-?[0-9]"), _number(p)).otherwise(p)), "")

    def short(text: Column) -> Column:
        return _with(F.regexp_replace(text, _POINTED, "$1$2"), lambda x: F.when(x.rlike(_IN_FORM), x).otherwise(pieces(text)))

    return _with(F.to_json(value), lambda x: F.when(x.rlike(_IN_FORM), x).otherwise(short(x)))


def canonical(value: Column, dtype: T.DataType) -> Column:
    """The comparable form of ``value``; NULL stays NULL."""
    if not needs_form(dtype):
        return value
    if isinstance(dtype, T.VariantType):
        return _json_form(value)
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: canonical(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        entries = F.transform(F.map_entries(value), lambda e: F.struct(canonical(e["key"], dtype.keyType).alias("key"), canonical(e["value"], dtype.valueType).alias("value")))
        return F.sort_array(entries)
    fields = [canonical(value.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
    return F.when(value.isNotNull(), F.struct(*fields))
