"""L1-L3: the read schema of a contract object and the load projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions.names import col
from ..operators.cast import cast_to
from ..spec import ContractError, SCD2_COLUMNS, object_spec
from ..types import ColumnPlan, plan_columns

READ_AS = ("final", "physical", "source")


def _comment(plan: ColumnPlan) -> dict:
    return {"comment": plan.spec.description} if plan.spec.has_description else {}


def _load_type(plan: ColumnPlan, read_as: str) -> T.DataType:
    if read_as == "physical":
        phys = plan.physical
        if phys is not None:
            return phys.dtype
    return plan.load.dtype


def read_schema(obj, exclude=SCD2_COLUMNS, read_as: str = "final") -> T.StructType:
    """L1: the schema to hand to ``spark.read.schema(..)`` / ``spark.readStream.schema(..)``.

    Source (physical) names, load types, ``nullable = not required``, the description as column comment. Excluded
    (operational / SCD2) columns are not sourced and are left out. ``read_as="final"`` gives the declared load types
    (a converted column as STRING, any other as its final type); ``read_as="physical"`` reads with the physical type
    where Spark can parse it, so that text such as ``"12"`` in a JSON file is read as text and cast loudly later
    instead of turning into NULL inside the reader.
    """
    if read_as not in READ_AS[:2]:
        raise ValueError(f"read_as must be one of {READ_AS[:2]}")
    obj = object_spec(obj)
    fields = []
    for p in plan_columns(obj, exclude):
        if p.excluded:
            continue
        fields.append(T.StructField(p.source, _load_type(p, read_as), not p.spec.required, _comment(p)))
    return T.StructType(fields)


def load(df: DataFrame, obj, exclude=SCD2_COLUMNS, read_as: str = "physical", mode: str = "strict") -> DataFrame:
    """L2/L3: keep the declared source columns in declared order, each at its load type; drop the rest.

    Exclusion is tested on the logical name; excluded columns that are present (operational metadata added by the
    loader) flow through untouched at their declared position. ``read_as="source"`` keeps the source types (no cast).
    Nested fields are matched by name; ``mode="lenient"`` gives NULL for what cannot be cast. One ``select``: Catalyst
    prunes every other column out of the scan.
    """
    if read_as not in READ_AS:
        raise ValueError(f"read_as must be one of {READ_AS}")
    obj = object_spec(obj)
    present = {c.lower(): c for c in df.columns}
    current = {f.name.lower(): f.dataType for f in df.schema.fields}
    plans = plan_columns(obj, exclude)
    sources = [p.source.lower() for p in plans if not p.excluded]
    twice = sorted({s for s in sources if sources.count(s) > 1})
    if twice:
        raise ContractError("ODCS-COL-003", f"object {obj.name!r}: several columns have the source name {twice}")
    missing = [p.source for p in plans if not p.excluded and p.source.lower() not in present]
    if missing:
        raise ContractError("ODCS-COL-002", f"object {obj.name!r}: source columns not found: {missing}")
    out = []
    for p in plans:
        if p.excluded:
            if p.name.lower() in present:
                out.append(col(present[p.name.lower()]))
            continue
        c = col(present[p.source.lower()])
        if read_as != "source":
            target = _load_type(p, read_as)
            if current[p.source.lower()] != target:
                c = cast_to(c, current[p.source.lower()], target, lenient=mode == "lenient")
        out.append(c.alias(p.source, metadata=_comment(p)) if _comment(p) else c.alias(p.source))
    return df.select(*out)
