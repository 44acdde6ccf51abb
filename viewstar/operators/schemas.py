"""A registry of the keys that landed documents have, with a type for each that covers all of them.

Types form a lattice: whole numbers below decimals below doubles, everything else side by side,
and a variant above all. Each batch says which types it saw (``schema_of_variant_agg``, observed
while the rows are written); the registry takes the least type above both. A key never gets a
narrower type, so a column of it reads every document that ever landed.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

MIXED, NONE = "VARIANT", "VOID"
_WHOLE, _DOUBLE = ("BIGINT",), ("FLOAT", "DOUBLE")
_DECIMAL = re.compile(r"DECIMAL\((\d+),\s*(-?\d+)\)")
# Digits that are kept for a BIGINT, and the most a decimal holds.
_BIGINT_DIGITS, _MOST_DIGITS = 20, 38


def observed_schema(document: str | Column) -> Column:
    """An aggregate that tells the types of a batch; nothing is read twice for it."""
    return F.schema_of_variant_agg(document)


def key_types(schema: str | None) -> dict[str, str]:
    """Types by key of an ``OBJECT<key: TYPE, …>``; none for another type."""
    if not schema or not schema.startswith("OBJECT<"):
        return {}
    found, body, at = {}, schema[len("OBJECT<"):-1], 0
    while at < len(body):
        if body[at] == "`":
            # A back quote within a quoted name is doubled.
            end = at + 1
            while body[end] != "`" or body[end:end + 2] == "``":
                end += 2 if body[end:end + 2] == "``" else 1
            name, at = body[at + 1:end].replace("``", "`"), end + 1
        else:
            end = body.index(":", at)
            name, at = body[at:end], end
        at, depth, quoted = body.index(":", at) + 1, 0, False
        start = at
        while at < len(body) and (depth or quoted or body[at] != ","):
            if body[at] == "`":
                quoted = not quoted
            elif not quoted:
                depth += (body[at] in "<(") - (body[at] in ">)")
            at += 1
        found[name] = body[start:at].strip()
        at += 1
        while at < len(body) and body[at] == " ":
            at += 1
    return found


def _digits(type_: str) -> tuple[int, int] | None:
    """Digits before and after the point."""
    if type_ in _WHOLE:
        return _BIGINT_DIGITS, 0
    if found := _DECIMAL.fullmatch(type_):
        precision, scale = int(found[1]), int(found[2])
        return precision - scale, scale
    return None


def above(one: str, other: str) -> str:
    """The least type that covers both."""
    if one == other or other == NONE:
        return one
    if one == NONE:
        return other
    numbers = _digits(one), _digits(other)
    if all(numbers):
        whole, scale = (max(part) for part in zip(*numbers))
        return f"DECIMAL({whole + scale},{scale})" if whole + scale <= _MOST_DIGITS else "DOUBLE"
    if all(n or t in _DOUBLE for n, t in zip(numbers, (one, other))):
        return "DOUBLE"
    return MIXED


def merged(registry: Mapping[str, str], seen: Mapping[str, str]) -> dict[str, str]:
    """The registry after a batch; keys stay in the order of their names."""
    names = sorted({*registry, *seen})
    return {name: above(registry.get(name, NONE), seen.get(name, NONE)) for name in names}


def _path(name: str) -> str | None:
    """The place of a key in a document, whatever its characters; None where no path can say it."""
    for quote in ("'", '"'):
        if quote not in name:
            return f"$[{quote}{name}{quote}]"
    return None


def document_columns(registry: Mapping[str, str], document: str = "document") -> list[Column]:
    """A column per key. A key of one type has it; one of several is a variant, from which each
    value is read as what it is (``try_variant_get``), or as text, whatever it is."""
    out = []
    for name, type_ in registry.items():
        path = _path(name)
        if path is None:
            continue
        scalar = "<" not in type_ and type_ not in (MIXED, NONE)
        out.append(F.try_variant_get(document, path, type_ if scalar else "variant").alias(name))
    return out


def with_document_columns(landing: DataFrame, registry: Mapping[str, str],
                          *kept: str) -> DataFrame:
    """Landing rows as ``kept`` columns and, in a struct ``fields``, the documents' own."""
    columns = document_columns(registry)
    return landing.select(*kept, (F.struct(*columns) if columns else F.lit(None)).alias("fields"))
