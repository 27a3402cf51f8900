"""Identifiers and literals in rule texts. Rule names are made of them by both the one-spec and the estate form."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable
from decimal import Decimal
from itertools import count

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: what may stand in a rule name.
RULE_NAME_CHARS = "A-Za-z0-9_"
#: Fixed value: what may stand in an output name.
OUTPUT_NAME_CHARS = "A-Za-z0-9_.-"


def quote(name) -> str:
    """An identifier in back-quotes."""
    return "`" + str(name).replace("`", "``") + "`"


def quote_col(name: Column) -> Column:
    """``quote`` over a column of identifiers."""
    return F.concat(F.lit("`"), F.replace(name, F.lit("`"), F.lit("``")), F.lit("`"))


def col(name: str) -> Column:
    """A column reference that survives dots, spaces and back-quotes in the name."""
    return F.col(quote(name))


def rule_word(name) -> str:
    return re.sub(f"[^{RULE_NAME_CHARS}]", "_", f"{name}")


def rule_word_col(name: Column) -> Column:
    return F.regexp_replace(name, f"[^{RULE_NAME_CHARS}]", "_")


def numbered(bases: Iterable[str]) -> list[str]:
    """The n-th use of a base name is ``base_n``, the first is the base itself.

    A base ends in a rule's suffix, never in a number, so a numbered name is no other rule's base.
    """
    uses = defaultdict(lambda: count(1))
    ranked = ((b, next(uses[b])) for b in bases)
    return [b if n == 1 else f"{b}_{n}" for b, n in ranked]


def number_text(value) -> str:
    """A number as rule texts show it: truth values as 0 and 1, whole floats without a fraction."""
    whole = isinstance(value, int) or (isinstance(value, float) and value.is_integer())
    return f"{int(value):d}" if whole else f"{value}"


def exact_text(value) -> str:
    """A number as a literal that Spark reads exactly: small and large floats without an exponent, so that they are decimals.

    The text that rules show (``number_text``) has ``1e-05``, which Spark reads as a double.
    """
    text = number_text(value)
    if isinstance(value, float) and "e" in text:
        plain = format(Decimal(repr(value)), "f")
        return plain if len(plain.strip("-").replace(".", "")) <= 38 else text
    return text


def string_text(value) -> str:
    """A single-quoted literal that Spark's parser reads back as ``value``."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "''") + "'"


def string_text_col(value: Column) -> Column:
    return F.concat(F.lit("'"), F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("''")), F.lit("'"))
