"""Scalar extraction from semi-structured JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_payload(col: Column | str) -> Column:
    """JSON text -> VARIANT (NULL for malformed text).  Parse a payload once
    with this and extract several paths with :func:`variant_scalar`."""
    return F.try_parse_json(F.col(col) if isinstance(col, str) else col)


def variant_kind(v: Column | str, path: str) -> Column:
    """Type of the value at ``path`` of a VARIANT (``OBJECT<...>``, ``ARRAY<...>``, a scalar type)."""
    root = F.col(v) if isinstance(v, str) else v
    return F.schema_of_variant(F.try_variant_get(root, path, "variant"))


def json_scalar(col: Column | str, path: str) -> Column:
    """Value at ``path`` as STRING when it is a JSON scalar; NULL for objects,
    arrays, JSON null, a missing path or malformed text.

    The value is the first of a repeated key.  Strings come unescaped and integers of any
    length as written; a number with a fraction or an exponent is printed as the double it
    stands for (``1.50`` gives ``1.5``, ``1e5`` gives ``100000.0``).

    ``get_json_object`` also returns the text of nested values.  Only where a value begins
    like one is the payload parsed a second time, as a VARIANT, whose type tells an object or
    array from a string that looks like it.  A payload that VARIANT rejects (repeated keys)
    has no such type, and there a value that is itself an object or array counts as nested.
    """
    text = F.col(col) if isinstance(col, str) else col
    value = F.get_json_object(text, path)
    parsed = parse_payload(text)
    nested = F.when(parsed.isNotNull(), variant_kind(parsed, path).rlike("^(OBJECT|ARRAY)")) \
        .otherwise(F.try_parse_json(value).isNotNull())
    return (F.when(~F.substring(value, 1, 1).isin("{", "["), value)
            .when(value.isNotNull(), F.when(~F.coalesce(nested, F.lit(False)), value)))
