"""Driver-side contract description.

A contract is configuration, like a ``StructType``: it is read once on the driver and turned into ``Column``
expressions at plan time. Nothing in here touches rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any, Mapping

# The bookkeeping columns of a slowly-changing-dimension (type 2) writer. They are injected at write
# time and never come from the source, so they are always excluded from load and transform.
SCD2_COLUMNS = frozenset({"__START_AT", "__END_AT"})

# Top-level fields every contract must carry.
REQUIRED_CONTRACT_FIELDS = ("version", "kind", "apiVersion", "id", "status")


class ContractError(ValueError):
    """A contract that cannot be turned into a plan. ``code`` names the kind of problem."""

    def __init__(self, code: str, message: str):
        super().__init__(f"[{code}] {message}")
        self.code = code


@dataclass(frozen=True)
class ColumnSpec:
    """One contract property (a column, or a field of a nested column)."""

    name: str
    logical_type: str | None = None
    physical_type: str | None = None
    physical_name: str | None = None
    options: Mapping[str, Any] = field(default_factory=dict)
    required: bool = False
    primary_key: bool = False
    pk_position: int = 0
    critical: bool = False
    description: str | None = None
    has_description: bool = False
    tags: tuple[str, ...] = ()
    properties: tuple["ColumnSpec", ...] = ()
    items: "ColumnSpec | None" = None

    @property
    def source(self) -> str:
        """Name of the column in the source data."""
        return self.physical_name or self.name

    @classmethod
    def from_dict(cls, d: Mapping[str, Any]) -> "ColumnSpec":
        if not isinstance(d, Mapping):
            raise ContractError("ODCS-CFG-062", f"a property must be a mapping, got {type(d).__name__}")
        items = d.get("items")
        return cls(
            name=str(d.get("name", "")),
            logical_type=d.get("logicalType"),
            physical_type=d.get("physicalType"),
            physical_name=d.get("physicalName"),
            options=dict(d.get("logicalTypeOptions") or {}),
            required=bool(d.get("required", False)),
            primary_key=d.get("primaryKey") is True,
            pk_position=int(d.get("primaryKeyPosition", 0) or 0),
            critical=bool(d.get("criticalDataElement")),
            description=d.get("description"),
            has_description="description" in d,
            tags=tuple(str(t) for t in (d.get("tags") or [])),
            properties=tuple(cls.from_dict(p) for p in (d.get("properties") or [])),
            items=cls.from_dict(items) if items else None,
        )


@dataclass(frozen=True)
class ObjectSpec:
    """One schema object of a contract: one table."""

    name: str
    columns: tuple[ColumnSpec, ...]
    description: str | None = None
    has_description: bool = False
    tags: tuple[str, ...] = ()
    contract_tags: tuple[str, ...] = ()
    version: str | None = None

    def column(self, name: str) -> ColumnSpec:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)

    @classmethod
    def from_dict(cls, d: Mapping[str, Any], *, contract_tags=(), version=None) -> "ObjectSpec":
        cols = tuple(ColumnSpec.from_dict(p) for p in (d.get("properties") or []))
        lowered = [c.name.lower() for c in cols]
        dupes = sorted({n for n in lowered if lowered.count(n) > 1})
        if dupes:
            # Spark resolves names case-insensitively by default, so names equal after lower-casing would clash.
            raise ContractError("ODCS-COL-001", f"object {d.get('name')!r}: column names clash: {dupes}")
        return cls(
            name=str(d.get("name", "")),
            columns=cols,
            description=d.get("description"),
            has_description="description" in d,
            tags=tuple(str(t) for t in (d.get("tags") or [])),
            contract_tags=tuple(contract_tags),
            version=version,
        )


@dataclass(frozen=True)
class ContractSpec:
    """A whole contract: top-level fields and its schema objects."""

    id: str | None
    version: str | None
    name: str | None
    status: str | None
    tags: tuple[str, ...]
    objects: tuple[ObjectSpec, ...]

    def object(self, name: str) -> ObjectSpec:
        for o in self.objects:
            if o.name == name:
                return o
        raise KeyError(name)

    @classmethod
    def from_dict(cls, d: Mapping[str, Any], *, check_required: bool = True) -> "ContractSpec":
        if not isinstance(d, Mapping):
            raise ContractError("ODCS-IO-004", f"a contract must be a mapping, not {type(d).__name__}")
        if check_required:
            missing = [k for k in REQUIRED_CONTRACT_FIELDS if k not in d]
            if missing:
                raise ContractError("ODCS-CFG-062", f"contract lacks required fields {missing}")
        tags = tuple(str(t) for t in (d.get("tags") or []))
        version = d.get("version")
        objects = []
        seen = set()
        for o in d.get("schema") or []:
            obj = ObjectSpec.from_dict(o, contract_tags=tags, version=version)
            if obj.name in seen:
                raise ContractError("ODCS-OBJ-001", f"duplicate schema object name {obj.name!r}")
            seen.add(obj.name)
            objects.append(obj)
        return cls(
            id=d.get("id"),
            version=version,
            name=d.get("name"),
            status=d.get("status"),
            tags=tags,
            objects=tuple(objects),
        )

    @classmethod
    def from_yaml(cls, text: str, *, check_required: bool = True) -> "ContractSpec":
        import yaml

        docs = [doc for doc in yaml.safe_load_all(text) if doc is not None]
        if len(docs) != 1:
            raise ContractError("ODCS-IO-003", f"a contract file must hold exactly one document, found {len(docs)}")
        return cls.from_dict(docs[0], check_required=check_required)


def object_spec(obj: "ObjectSpec | Mapping[str, Any]") -> ObjectSpec:
    """Accept either a parsed ``ObjectSpec`` or the plain mapping of one schema object."""
    return obj if isinstance(obj, ObjectSpec) else ObjectSpec.from_dict(obj)


def exclusion_set(operational_columns=()) -> frozenset[str]:
    """Columns that are never sourced from the input: operational metadata plus the SCD2 pair."""
    return frozenset(operational_columns) | SCD2_COLUMNS
