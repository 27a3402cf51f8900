"""The rules that options make, as one table: read by the one-spec form (``operators.expect``) and the estate form (``plans.catalog``).

A template's ``{q}`` is the quoted column, ``{v}`` the rendered option value.
"""

from __future__ import annotations

from dataclasses import dataclass

NUMBERS, MOMENTS = ("integer", "number"), ("date", "timestamp", "time")


@dataclass(frozen=True)
class OptionRule:
    types: tuple[str, ...]
    option: str
    suffix: str
    template: str
    literal: str = "number"  # how the value is rendered: number, string, or none where only ``true`` counts


# For each logical type its options, their rule-name suffixes and texts, in the order rules are made.
OPTION_RULES = (
    OptionRule(("string",), "minLength", "min_length", "length({q}) >= {v}"),
    OptionRule(("string",), "maxLength", "max_length", "length({q}) <= {v}"),
    OptionRule(("string",), "pattern", "pattern", "{q} RLIKE {v}", "string"),
    OptionRule(NUMBERS, "minimum", "min", "{q} >= {v}"),
    OptionRule(NUMBERS, "maximum", "max", "{q} <= {v}"),
    OptionRule(NUMBERS, "exclusiveMinimum", "exclusive_min", "{q} > {v}"),
    OptionRule(NUMBERS, "exclusiveMaximum", "exclusive_max", "{q} < {v}"),
    OptionRule(NUMBERS, "multipleOf", "multiple_of", "{q} % {v} = 0"),
    OptionRule(MOMENTS, "minimum", "min", "{q} >= {v}", "string"),
    OptionRule(MOMENTS, "maximum", "max", "{q} <= {v}", "string"),
    OptionRule(MOMENTS, "exclusiveMinimum", "exclusive_min", "{q} > {v}", "string"),
    OptionRule(MOMENTS, "exclusiveMaximum", "exclusive_max", "{q} < {v}", "string"),
    OptionRule(("array",), "minItems", "min_items", "{q} IS NULL OR (size({q}) >= {v})"),
    OptionRule(("array",), "maxItems", "max_items", "{q} IS NULL OR (size({q}) <= {v})"),
    OptionRule(("array",), "uniqueItems", "unique_items", "{q} IS NULL OR (size({q}) = size(array_distinct({q})))", "none"),
)
REQUIRED_SUFFIX, REQUIRED_TEMPLATE = "not_null", "{q} IS NOT NULL"
FIELD_TEMPLATE = "{q} IS NULL OR ({q}.{v} IS NOT NULL)"
