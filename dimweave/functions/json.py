"""JSON payload extraction with built-in functions (one parse per payload)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def multi_extract(blob: Column | str, *fields: str) -> Column:
    """Parse a JSON object text once into a struct of string fields.

    Each field holds unquoted text for JSON strings, the literal text for
    numbers and null when missing -- one parse for all fields, usable in any
    expression (``F.col('x.id')`` afterwards).
    """
    schema = "struct<" + ",".join(f"`{f}`:string" for f in fields) + ">"
    return F.from_json(_c(blob), schema)


def extract_string(blob: Column | str, path: str) -> Column:
    """``$.path`` as unquoted text (null when missing)."""
    return F.get_json_object(_c(blob), path)


def extract_typed(blob: Column | str, path: str, type_: str, strict: bool = True) -> Column:
    """``$.path`` cast to ``type_``; ``strict=False`` yields null for dirty text."""
    txt = extract_string(blob, path)
    return txt.cast(type_) if strict else txt.try_cast(type_)
