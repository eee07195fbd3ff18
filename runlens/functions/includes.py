"""Include statements in configuration text.

A statement is kept through other processing as ``KEY = "escaped statement"``, keyed by
the statement's md5.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Statement forms and the key that stands in for one.
INCLUDE_CALL = r"include\s+(?:required|url|file|classpath)\(.*\)"
INCLUDE_FILE = r'include\s+".*\.(?:conf|hocon)"'
KEY_PREFIX = "HOCONSTRING_INCLUDE_"
WRAPPED = KEY_PREFIX + r'(?:.*)\s*=\s*"(?:.*)"'
WRAPPED_VALUE = KEY_PREFIX + r'(?:.*)\s*=\s*"(.*)"'
FLAGS = "(?dU)"


def _matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(FLAGS + pattern), F.lit(0))


def statements(text: Column, pattern: str) -> Column:
    """Distinct statements of one form that are not already escaped."""
    return F.filter(F.array_distinct(_matches(text, pattern)), lambda s: ~s.contains('\\"'))


def key_of(statement: Column) -> Column:
    return F.concat(F.lit(KEY_PREFIX), F.md5(statement))


def _wrap_form(text: Column, pattern: str) -> Column:
    return F.aggregate(
        statements(text, pattern),
        text,
        lambda acc, s: F.replace(
            acc,
            s,
            F.concat(key_of(s), F.lit(' = "'), F.replace(s, F.lit('"'), F.lit('\\"')), F.lit('"')),
        ),
    )


def wrap_includes(text: Column) -> Column:
    """Text with every include statement turned into a key-value pair."""
    return _wrap_form(_wrap_form(text, INCLUDE_CALL), INCLUDE_FILE)


def all_statements(text: Column) -> Column:
    """Distinct include statements, call forms before file forms."""
    rest = _wrap_form(text, INCLUDE_CALL)
    return F.concat(statements(text, INCLUDE_CALL), statements(rest, INCLUDE_FILE))


def restore_includes(wrapped: Column) -> Column:
    """Inverse of :func:`wrap_includes`."""
    return F.aggregate(
        _matches(wrapped, WRAPPED),
        wrapped,
        lambda acc, pair: F.replace(
            acc,
            pair,
            F.replace(F.regexp_extract(pair, FLAGS + WRAPPED_VALUE, 1), F.lit('\\"'), F.lit('"')),
        ),
    )


def strip_includes(wrapped: Column) -> Column:
    """Wrapped text with the include statements left out."""
    return F.aggregate(
        _matches(wrapped, WRAPPED), wrapped, lambda acc, pair: F.replace(acc, pair, F.lit(""))
    )
