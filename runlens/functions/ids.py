"""Workflow ids and wildcard patterns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

WILDCARDS = "*?"
_GLOB_SPECIAL = set("*?[")


def is_valid_uuid(s: Column) -> Column:
    """Lower-case UUID; hyphens, braces and a ``urn:uuid:`` prefix are optional. NULL is not valid."""
    stripped = F.regexp_replace(s, r"urn:|uuid:", "")
    stripped = F.regexp_replace(stripped, r"^[{}]+|[{}]+\z", "")
    digits = F.regexp_replace(stripped, "-", "")
    ok = digits.rlike(r"^[0-9a-f]{32}\z") & (s == F.lower(s)) & s.rlike("[a-z]")
    return F.coalesce(ok, F.lit(False))


def uuid_ok(value: object) -> bool:
    """Driver-side twin of :func:`is_valid_uuid` for search parameters."""
    if not isinstance(value, str) or not value.islower():
        return False
    digits = value.replace("urn:", "").replace("uuid:", "").strip("{}").replace("-", "")
    return len(digits) == 32 and all(c in "0123456789abcdef" for c in digits)


def has_wildcard(value) -> bool | Column:
    """Whether a parameter (string, possibly nested list, NULL) or a string column holds ``?`` or ``*``."""
    if isinstance(value, Column):
        return F.coalesce(value.rlike(r"[?*]"), F.lit(False))
    if value is None:
        return False
    if isinstance(value, (list, tuple)):
        return any(has_wildcard(v) for v in value)
    return any(w in value for w in WILDCARDS)


def has_wildcard_any(values: Column) -> Column:
    """Array form of :func:`has_wildcard`."""
    return F.coalesce(F.exists(values, lambda v: F.coalesce(v.rlike(r"[?*]"), F.lit(False))), F.lit(False))


def _quote(text: str) -> str:
    return "".join(c if c.isalnum() or c in "_/ " else "\\" + c for c in text)


def _char_class(body: str) -> str:
    negate = body.startswith("!")
    chars = body[1:] if negate else body
    parts, i = [], 0
    while i < len(chars):
        if i + 2 < len(chars) and chars[i + 1] == "-":
            if chars[i] <= chars[i + 2]:
                parts.append(f"{_quote(chars[i])}-{_quote(chars[i + 2])}")
            i += 3
        else:
            parts.append(_quote(chars[i]))
            i += 1
    if not parts:  # only empty ranges: nothing matches, or everything when negated
        return "." if negate else "(?!)"
    return f"[{'^' if negate else ''}{''.join(parts)}]"


def glob_regex(pattern: str) -> str:
    """Anchored, dot-all, case-sensitive Java regex of a ``* ? [seq] [!seq]`` pattern."""
    out, i = [], 0
    while i < len(pattern):
        c = pattern[i]
        if c == "*":
            out.append(".*")
        elif c == "?":
            out.append(".")
        elif c == "[":
            # a bracket directly after the opening (or after "!") belongs to the set
            start = i + 2 if pattern[i + 1 : i + 2] == "!" else i + 1
            end = pattern.find("]", start + 1)
            if end < 0:
                out.append("\\[")
            else:
                out.append(_char_class(pattern[i + 1 : end]))
                i = end
        else:
            out.append(_quote(c))
        i += 1
    return f"^(?s:{''.join(out)})\\z"


def wildcard_match(s: Column, pattern: str) -> Column:
    """Wildcard match that reaches the parquet scan wherever a literal prefix allows it."""
    special = [i for i, c in enumerate(pattern) if c in _GLOB_SPECIAL]
    if not special:
        return s == F.lit(pattern)
    if pattern == "*":
        return s.isNotNull()
    prefix = pattern[: special[0]]
    if special == [len(pattern) - 1] and pattern[-1] == "*":
        return s.startswith(prefix)
    regex = s.rlike(glob_regex(pattern))
    return s.startswith(prefix) & regex if prefix else regex


def any_of(conditions: Sequence[Column]) -> Column:
    """OR of the conditions, NULL counted as false; false when there are none."""
    out = F.lit(False)
    for condition in conditions:
        out = out | F.coalesce(condition, F.lit(False))
    return out
