"""String helpers of the session record, as column expressions.

A session record is a ``key=value|key=value`` string; inside the engine the
fields are real columns and the string form only exists at the edge.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIELD_SEP = "|"
KV_SEP = "="


def _lit(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def is_empty(c: Column) -> Column:
    return c.isNull() | (c == F.lit(""))


def is_not_empty(c: Column) -> Column:
    return c.isNotNull() & (c != F.lit(""))


def trim_comma(c: Column) -> Column:
    """Remove at most one comma from each end (``trim`` would strip them all)."""
    return F.regexp_replace(c, r"^,|,\z", "")


def pad_two(c: Column) -> Column:
    """Two-character values pass; anything else gets one leading ``0``.

    Not ``lpad``: ``lpad('123', 2, '0')`` truncates to ``12``.
    """
    return F.when(F.length(c) == 2, c).otherwise(F.concat(F.lit("0"), c))


def kv_get(record: Column, key: str) -> Column:
    """Value of the first field named ``key``; NULL when absent or empty.

    ``a=b=c`` yields ``b`` (the text between the first and second ``=``).
    One anchored regex pass per lookup (codegen-friendly, no lambdas). Not
    ``str_to_map``: that fails on duplicate keys and keeps ``b=c``.
    """
    pattern = r"(?:^|\|)\Q" + key + r"\E=([^|=]*)"
    return F.nullif(F.regexp_extract(record, pattern, 1), F.lit(""))


def kv_set(record: Column, key: str, value) -> Column:
    r"""Replace the value of the first field named ``key``; unchanged if absent.

    One regex pass: the lazy prefix ``((?:[^|]*\|)*?)`` stops at the first
    field whose name is ``key`` (with or without ``=value``), and only that
    field is rewritten. Trailing empty fields are dropped first, as Java's
    ``split`` + join does.
    """
    pattern = r"^((?:[^|]*\|)*?)\Q" + key + r"\E(?:=[^|]*)?(?=\||\z)"
    # ``$`` and ``\`` in the new value must not act as group references.
    safe = F.regexp_replace(_lit(value).cast("string"), r"([\\$])", r"\\$1")
    replacement = F.concat(F.lit("$1" + key + KV_SEP), safe)
    return F.regexp_replace(F.regexp_replace(record, r"\|+\z", ""), F.lit(pattern), replacement)


def kv_record(pairs: list[tuple[str, Column]]) -> Column:
    """Encode ``(name, column)`` pairs as ``name=value|...``; NULL values become empty."""
    parts = [F.concat(F.lit(name + KV_SEP), F.coalesce(c.cast("string"), F.lit(""))) for name, c in pairs]
    return F.concat_ws(FIELD_SEP, *parts)
