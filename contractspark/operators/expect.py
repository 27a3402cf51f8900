"""Row-level data-quality rules derived from a contract, and the ways to apply them.

A rule is a boolean ``Column`` over the contract (logical) names. A NULL result counts as a pass. All rules of a
table are evaluated in one pass: ``annotate`` adds a violations array, ``summarize`` is a single ``agg`` with one
conditional sum per rule (one scan however many rules), ``observe_rules`` collects the same counts in flight, and
``gate`` aborts the job on a violated ``fail`` rule.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.canonical import canonical, needs_form
from ..functions.names import col, exact_text, number_text, numbered, quote, rule_word, string_text
from ..functions.ruletable import FIELD_TEMPLATE, MOMENTS, OPTION_RULES, REQUIRED_SUFFIX, REQUIRED_TEMPLATE
from ..spec import ContractError, ObjectSpec, object_spec
from ..types import final_type

WARN, FAIL = "warn", "fail"

@dataclass(frozen=True)
class Rule:
    name: str
    column: str
    kind: str
    text: str
    action: str
    predicate: Column = field(compare=False, repr=False)

    @property
    def violated(self) -> Column:
        """True when the row breaks the rule; a NULL predicate is a pass."""
        return ~F.coalesce(self.predicate, F.lit(True))


#: Begins with a year: Spark also takes a time alone, as one of the current day.
_DATED = re.compile(r"\s*[+-]?\d{4,6}(-.*)?\s*")
_ISO_TIME = re.compile(r"\s*\d{1,2}:\d{1,2}(:\d{1,2}(\.\d+)?)?\s*")


def _is_value(constant: Column) -> bool:
    """Whether a constant expression has a value; Spark folds it on the driver, no job runs."""
    return SparkSession.active().sql("SELECT 1").select(constant.isNotNull().alias("ok")).first().ok


def _moment_bound(c, value, dtype: T.DataType | None) -> Column:
    """The bound of a date, timestamp or time column as a value of the column's type.

    A text that is no such value (``2020-02-30``) is refused here, when rules are built, and not by the first row of the job.
    """
    text = str(value)
    if c.logical_type == "time" and isinstance(dtype, T.TimestampType) and isinstance(c.options.get("format"), str):
        # a ``time`` column parsed with its format sits on 1970-01-01; parse the bound the same way (our correction), or as an
        # ISO time where the format doesn't fit
        bound = F.try_to_timestamp(F.lit(text), F.lit(c.options["format"]))
        if _ISO_TIME.fullmatch(text):
            bound = F.coalesce(bound, F.lit(f"1970-01-01 {text.strip()}").try_cast(dtype))
    elif isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        bound = F.lit(text).try_cast(dtype) if _DATED.fullmatch(text) else F.lit(None)
    else:
        return F.lit(text)
    if not _is_value(bound):
        raise ContractError("ODCS-OPT-001", f"column {c.name!r}: bound {value!r} is not a date or timestamp")
    return bound


def _field_present(c, name: str, dtype: T.DataType | None) -> Column:
    """The object is null or its field is not; a VARIANT is asked for the field by path."""
    ref = col(c.name)
    if isinstance(dtype, T.VariantType):
        step = name.replace("\\", "\\\\").replace("'", "\\'")
        found = F.try_variant_get(ref, f"$['{step}']", "variant")
        return ref.isNull() | (found.isNotNull() & ~F.coalesce(F.is_variant_null(found), F.lit(False)))
    return ref.isNull() | ref.getField(name).isNotNull()


def column_rules(c, dtype: T.DataType | None = None) -> list[tuple[str, str, str, Column]]:
    """``(base_name, kind, text, predicate)`` for one property: required first, then its options in the table's order.

    A predicate is its text as Spark parses it, so both say the same, to the last digit of a bound. Some kinds differ: moment
    bounds are cast to the column's type, numbers with an exponent are written out as decimals, a field of a VARIANT is looked up
    by path, and unique items that hold maps or variants are compared in their canonical form.
    """
    q, word = quote(c.name), rule_word(c.name)
    out = []
    if c.required:
        text = REQUIRED_TEMPLATE.format(q=q)
        out.append((f"{word}_{REQUIRED_SUFFIX}", REQUIRED_SUFFIX, text, F.expr(text)))
    for r in OPTION_RULES:
        value = c.options.get(r.option)
        if c.logical_type not in r.types or value is None or (r.literal == "none" and value is not True):
            continue
        text = r.template.format(q=q, v=string_text(value) if r.literal == "string" else number_text(value))
        if c.logical_type in MOMENTS:
            bound = _moment_bound(c, value, dtype)
            ref = col(c.name)
            predicate = {"min": ref >= bound, "max": ref <= bound, "exclusive_min": ref > bound, "exclusive_max": ref < bound}[r.suffix]
        else:
            predicate = F.expr(text if r.literal == "string" else r.template.format(q=q, v=exact_text(value)))
        if r.option == "uniqueItems" and needs_form(dtype):  # maps and variants can't be compared as they are
            predicate = col(c.name).isNull() | (F.size(col(c.name)) == F.size(F.array_distinct(canonical(col(c.name), dtype))))
        out.append((f"{word}_{r.suffix}", r.suffix, text, predicate))
    if c.logical_type == "object":
        for name in map(str, c.options.get("required") or []):
            out.append((f"{word}_{rule_word(name)}_{REQUIRED_SUFFIX}", "field_not_null", FIELD_TEMPLATE.format(q=q, v=quote(name)),
                        _field_present(c, name, dtype)))
    return out


def rules(obj, columns=None) -> list[Rule]:
    """All rules of an object in declared order, names made unique (E18), action ``fail`` for critical columns.

    Rules are made for every property, excluded ones too. With ``columns`` (e.g. ``df.columns``) rules on columns that
    are absent are left out; ``skipped_rules`` lists them.
    """
    obj: ObjectSpec = object_spec(obj)
    present = None if columns is None else {c.lower() for c in columns}
    made = [(c, r) for c in obj.columns for r in column_rules(c, _resolved_dtype(c))]
    names = numbered(base for _, (base, *_) in made)
    return [Rule(name, c.name, kind, text, FAIL if c.critical else WARN, predicate)
            for name, (c, (_, kind, text, predicate)) in zip(names, made)
            if present is None or c.name.lower() in present]


def skipped_rules(obj, columns) -> list[str]:
    kept = {r.name for r in rules(obj, columns)}
    return [r.name for r in rules(obj) if r.name not in kept]


def _resolved_dtype(c):
    """The column's type, or None where it has none (planning reports that; rules can still be listed)."""
    try:
        return final_type(c).dtype
    except ContractError:
        return None


def annotate(df: DataFrame, rule_list, column: str = "_violations") -> DataFrame:
    """Add ``array<string>`` of the names of the rules each row breaks (empty when none). Rows are kept."""
    none = F.array().cast("array<string>")
    broken = [F.when(r.violated, F.array(F.lit(r.name))).otherwise(none) for r in rule_list]  # no lambda: stays in generated code
    return df.withColumn(column, F.concat(none, *broken))


def _long_form(df: DataFrame, rule_list, rows_alias: str, prefix: str) -> DataFrame:
    """One-row wide counts → one row per rule; rule metadata rides along as literals (no join)."""
    entries = [F.struct(F.lit(i).alias("rule_idx"), F.lit(r.name).alias("expectation"),
                        F.lit(r.column).alias("column_name"), F.lit(r.action).alias("action"),
                        F.lit(r.text).alias("expression"),
                        F.coalesce(F.col(f"{prefix}{i}"), F.lit(0)).cast("long").alias("failed"))
               for i, r in enumerate(rule_list)]
    return (df.select(F.col(rows_alias).alias("checked"), F.explode(F.array(*entries)).alias("r"))
            .select("r.rule_idx", "r.expectation", "r.column_name", "r.action", "r.expression", "checked",
                    "r.failed")
            .withColumn("passed", F.col("checked") - F.col("failed")))


def _count_exprs(rule_list, prefix: str):
    return [F.sum(F.when(r.violated, F.lit(1)).otherwise(F.lit(0))).alias(f"{prefix}{i}")
            for i, r in enumerate(rule_list)]


def summarize(df: DataFrame, rule_list) -> DataFrame:
    """``(rule_idx, expectation, column_name, action, expression, checked, failed, passed)``, one row per rule.

    One ``agg`` with one conditional sum per rule: a single scan, partial sums per partition, one tiny final task.
    """
    if not rule_list:
        return df.sparkSession.createDataFrame(
            [], "rule_idx int, expectation string, column_name string, action string, expression string, "
                "checked long, failed long, passed long")
    wide = df.agg(F.count(F.lit(1)).alias("__rows"), *_count_exprs(rule_list, "__r"))
    return _long_form(wide, rule_list, "__rows", "__r")


def observe_rules(df: DataFrame, rule_list, name: str = "contract_rules"):
    """The same counts collected in flight by the next action on the returned DataFrame.

    Returns ``(df, observation)``; after the action ``rule_counts(observation, rules)`` gives the per-rule counts.
    """
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *_count_exprs(rule_list, "r")), obs


def rule_counts(observation: Observation, rule_list) -> list[dict]:
    m = observation.get
    if "rows" not in m:
        raise ContractError("ODCS-RUN-001", "the observed job did not finish: there are no counts to report")
    return [{"expectation": r.name, "column_name": r.column, "action": r.action, "checked": m["rows"],
             "failed": m[f"r{i}"] or 0} for i, r in enumerate(rule_list)]


def gate(df: DataFrame, rule_list, message: str = "contract rule failed") -> DataFrame:
    """Abort the job on the first row that breaks a ``fail`` rule; ``warn`` rules keep the row.

    The check sits in a ``filter`` so that it cannot be pruned away with an unused column.
    """
    fails = [r for r in rule_list if r.action == FAIL]
    if not fails:
        return df
    any_bad = F.lit(False)
    for r in fails:
        any_bad = any_bad | r.violated
    names = F.concat_ws(",", *[F.when(r.violated, F.lit(r.name)) for r in fails])  # leaves nulls out
    return df.filter(F.when(~any_bad, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit(f"{message}: "), names))))


def violation_mask(rule_list) -> Column:
    """True when the row breaks at least one rule."""
    out = F.lit(False)
    for r in rule_list:
        out = out | r.violated
    return out
