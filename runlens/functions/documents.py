"""From leaf rows of a document back to JSON text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EMPTY_OBJECT = "{}"


def starts_with(path: Column, prefix: Column) -> Column:
    """Whether ``prefix`` is a proper prefix of ``path`` (both arrays)."""
    return (F.size(path) > F.size(prefix)) & (F.slice(path, F.lit(1), F.size(prefix)) == prefix)


def _shared(a: Column, b: Column) -> Column:
    """Number of leading components that two paths share; 0 when either is NULL."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first_difference = F.array_position(F.concat(same, F.array(F.lit(False))), F.lit(False)) - 1
    return F.coalesce(first_difference, F.lit(0)).cast("int")


def _json_string(s: Column) -> Column:
    # a one-element array is the shortest JSON that quotes and escapes a string
    text = F.to_json(F.array(s))
    return text.substr(F.lit(2), F.length(text) - 2)


def real_leaves(ordered: Column) -> Column:
    """Sorted leaves, one per path, without empty-object markers whose path has members after all.

    Of several values at one path the greatest stays. A leaf without a path has no place.
    """

    def kept(leaf: Column, i: Column) -> Column:
        following = F.get(ordered, i + 1)["path"]
        filled = (leaf["value"] == EMPTY_OBJECT) & starts_with(following, leaf["path"])
        return (F.size(leaf["path"]) > 0) & ~F.coalesce((following == leaf["path"]) | filled, F.lit(False))

    return F.filter(ordered, kept)


def render(leaves: Column) -> Column:
    """JSON object text of sorted ``struct<path array<string>, value string>`` leaves.

    Values are JSON text and paths are unique. Sorted paths keep siblings together, so
    each leaf only has to close the objects it leaves and open those it enters. Pass a
    plain column: the leaf before the current one is looked up by position.
    """

    def piece(leaf: Column, i: Column) -> Column:
        path = leaf["path"]
        before = F.when(i > 0, F.get(leaves, i - 1)["path"])
        shared = _shared(before, path)
        left = F.when(i > 0, F.size(before) - shared - 1).otherwise(0)
        entered = F.slice(path, shared + 1, F.size(path) - shared)
        opened = F.array_join(F.transform(entered, lambda k: F.concat(_json_string(k), F.lit(":"))), "{")
        start = F.when(i > 0, F.lit(",")).otherwise(F.lit("{"))
        return F.concat(F.repeat(F.lit("}"), left), start, opened, leaf["value"])

    closing = F.repeat(F.lit("}"), F.size(F.get(leaves, F.size(leaves) - 1)["path"]))
    text = F.concat(F.array_join(F.transform(leaves, piece), ""), closing)
    return F.when(F.size(leaves) > 0, text).otherwise(EMPTY_OBJECT)
