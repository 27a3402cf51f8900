"""Classification of Spark type text: is it a complete type, and which family does it belong to?

The same rule is written twice: once over a Python string (one contract, on the driver) and once as ``Column``
expressions (a whole column catalog, on the executors, R1). Both normalise the text, replace every scalar type name
that stands in a type position by ``@`` and then fold the innermost ``ARRAY<@>``, ``MAP<@,@>`` and
``STRUCT<name:@,...>`` to ``@``; the text is a valid, complete type when one ``@`` is left.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scalar type names and the family each belongs to.
SCALAR_FAMILIES = {
    "BYTE": "integer", "TINYINT": "integer", "SHORT": "integer", "SMALLINT": "integer",
    "INT": "integer", "INTEGER": "integer", "LONG": "integer", "BIGINT": "integer",
    "FLOAT": "fractional", "REAL": "fractional", "DOUBLE": "fractional",
    "DECIMAL": "fractional", "DEC": "fractional", "NUMERIC": "fractional",
    "STRING": "string", "CHAR": "string", "VARCHAR": "string",
    "BOOLEAN": "boolean", "BOOL": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp", "TIMESTAMP_NTZ": "timestamp", "TIMESTAMP_LTZ": "timestamp",
    "BINARY": "binary",
    "INTERVAL": "interval", "GEOGRAPHY": "geography", "GEOMETRY": "geometry",
    "VOID": "other", "NULL": "other",
}

_LEAF_NAMES = "|".join(sorted(list(SCALAR_FAMILIES) + ["VARIANT"], key=len, reverse=True))
# A leaf type: a scalar name with optional, unchecked parameters, standing where a type is expected (after the start,
# ``<``, ``,`` or ``:``) and ending where a type ends (``>``, ``,`` or the end). A name followed by ``:`` is a field.
LEAF_PATTERN = rf"(?:^|(?<=[<,:]))(?:{_LEAF_NAMES})(?:\([^()<>]*\))?(?=$|[>,])"
FOLD_PATTERN = r"ARRAY<@>|MAP<@,@>|STRUCT<[A-Z_][A-Z0-9_]*:@(?:,[A-Z_][A-Z0-9_]*:@)*>"
SPACE_PATTERN = r"\s*([<>(),:])\s*"

_leaf_re = re.compile(LEAF_PATTERN)
_fold_re = re.compile(FOLD_PATTERN)
_space_re = re.compile(SPACE_PATTERN)


def normalize(text: str) -> str:
    return _space_re.sub(r"\1", str(text).strip().upper())


def fold(text: str) -> str:
    """Fold a type text until nothing changes; ``'@'`` means valid and complete."""
    cur = _leaf_re.sub("@", normalize(text))
    while True:
        nxt = _fold_re.sub("@", cur)
        if nxt == cur:
            return cur
        cur = nxt


def head_family(normalized: str) -> str:
    for prefix, fam in (("ARRAY<", "array"), ("MAP<", "map"), ("STRUCT<", "struct")):
        if normalized.startswith(prefix):
            return fam
    if normalized == "VARIANT":
        return "variant"
    return SCALAR_FAMILIES.get(normalized.split("(", 1)[0], "other")


def family(text: str | None) -> str | None:
    """Family of a complete type text, or ``None`` when the text is not a valid, complete type."""
    if not text or fold(text) != "@":
        return None
    return head_family(normalize(text))


# ---- the same rule over a column of type texts -------------------------------------------------------------


def normalize_col(c: Column) -> Column:
    return F.regexp_replace(F.upper(F.trim(c)), SPACE_PATTERN, "$1")


def fold_col(normalized: Column) -> Column:
    """The text after as many folds as it can need: one for each ``<`` in it, none for a scalar name."""
    leaves = F.regexp_replace(normalized, LEAF_PATTERN, "@")
    folds = F.length(normalized) - F.length(F.replace(normalized, F.lit("<"), F.lit("")))
    folded = F.aggregate(F.sequence(F.lit(1), folds), leaves, lambda text, _: F.regexp_replace(text, FOLD_PATTERN, "@"))
    return F.when(folds > 0, folded).otherwise(leaves)


def head_family_col(normalized: Column, families_map: Column) -> Column:
    return (
        F.when(normalized.startswith("ARRAY<"), F.lit("array"))
        .when(normalized.startswith("MAP<"), F.lit("map"))
        .when(normalized.startswith("STRUCT<"), F.lit("struct"))
        .when(normalized == "VARIANT", F.lit("variant"))
        .otherwise(F.coalesce(F.element_at(families_map, F.split(normalized, r"\(", 2)[0]), F.lit("other")))
    )


def families_map_col() -> Column:
    """The scalar family table as a literal ``MAP<STRING,STRING>`` (a constant of 30 entries)."""
    return F.create_map(*[x for k, v in SCALAR_FAMILIES.items() for x in (F.lit(k), F.lit(v))])


# ---- type text → Spark DataType ----------------------------------------------------------------------------

# Names Spark's DDL parser does not take that have a Spark spelling with the same meaning.
_SPARK_ALIASES = [
    (rf"(?:^|(?<=[<,:]))BOOL(?=$|[>,])", "BOOLEAN"),
    (rf"(?:^|(?<=[<,:]))(?:CHAR|VARCHAR)(?=$|[>,])", "STRING"),
    (rf"(?:^|(?<=[<,:]))NULL(?=$|[>,])", "VOID"),
]
# Types a table cannot hold (Parquet cannot store them, Python cannot collect them, or the feature is off).
UNSTORABLE_FAMILIES = frozenset({"interval", "geography", "geometry"})
_UNSTORABLE_LEAF = re.compile(r"(?:^|(?<=[<,:]))(?:INTERVAL|GEOGRAPHY|GEOMETRY)(?:\([^()<>]*\))?(?=$|[>,])", re.I)


def to_datatype(text: str):
    """Spark ``DataType`` for a complete type text, or ``None`` when Spark cannot hold it in a table."""
    from pyspark.sql.types import DataType

    t = _space_re.sub(r"\1", str(text).strip())  # keep the case: struct field names are case-sensitive
    if _UNSTORABLE_LEAF.search(t):
        return None
    for pat, rep in _SPARK_ALIASES:
        t = re.sub(pat, rep, t, flags=re.I)
    try:
        return DataType.fromDDL(t)
    except Exception:
        return None
