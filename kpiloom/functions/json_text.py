"""Canonical JSON text from a declared contract.

A contract is a tree of records, lists and values: which fields, in which order, of which kind, read from
which column. The writer (``json_text``), the parser's type (``json_type``) and any check are built from the
same contract. The text is the same in every engine and session:

* fields stand in the contract's order; NULL fields, records and lists are left out; empty lists are ``[]``;
* a number has at most ``DIGITS`` significant digits, no exponent, and no zeros at its end (below 1e19;
  larger ones keep an exponent, parts below 1e-18 are dropped); NaN and infinities count as NULL;
* text is escaped as JSON requires and nothing else.

All of it is column expressions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = 12
KINDS = {"text": "string", "whole": "bigint", "number": "double"}


@dataclass(frozen=True)
class Value:
    source: str
    kind: str                   # text, whole or number


@dataclass(frozen=True)
class Record:
    """Fields in order. With a ``source`` they are read from that struct column, and a NULL struct is left out."""

    fields: dict[str, Value | Record | Many]
    source: str | None = None

    def sources(self) -> list[str]:
        return [v.source for v in self.fields.values()]


@dataclass(frozen=True)
class Many:
    source: str                 # an array of structs
    item: Record


def text(source: str) -> Value:
    return Value(source, "text")


def whole(source: str) -> Value:
    return Value(source, "whole")


def number(source: str) -> Value:
    return Value(source, "number")


def number_text(x: Column) -> Column:
    """The shortest plain decimal of ``DIGITS`` significant digits; NULL for NaN and infinities."""
    exact = F.format_string(f"%.{DIGITS - 1}e", x)
    plain = F.call_function("format_number", exact.cast("double"), F.lit("0." + "#" * 18))
    return F.when(F.abs(x) < 1e19, F.regexp_replace(plain, "^-0$", "0")).when(F.abs(x) < float("inf"), exact)


def quoted(x: Column) -> Column:
    """A JSON string."""
    array = F.to_json(F.array(x))
    return F.when(x.isNotNull(), F.substring(array, F.lit(2), F.char_length(array) - F.lit(2)))


_WRITE = {"text": quoted, "whole": lambda x: x.cast("bigint").cast("string"), "number": lambda x: number_text(x.cast("double"))}


def json_text(part: Value | Record | Many, row: Callable[[str], Column] = F.col) -> Column:
    """The part as text, read with ``row(column name)``."""
    if isinstance(part, Value):
        return _WRITE[part.kind](row(part.source))
    if isinstance(part, Many):
        items = F.transform(row(part.source), lambda x: json_text(part.item, lambda c: x[c]))
        return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))
    inner = row if part.source is None else lambda c: row(part.source)[c]
    members = [F.concat(F.lit(f'"{name}":'), json_text(p, inner)) for name, p in part.fields.items()]
    body = F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))
    return body if part.source is None else F.when(row(part.source).isNotNull(), body)


def json_type(part: Value | Record | Many) -> str:
    """DDL type that ``from_json`` needs to read the text back."""
    if isinstance(part, Value):
        return KINDS[part.kind]
    if isinstance(part, Many):
        return f"array<{json_type(part.item)}>"
    return "struct<" + ", ".join(f"{name}: {json_type(p)}" for name, p in part.fields.items()) + ">"
