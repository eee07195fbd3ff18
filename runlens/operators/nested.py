"""Leaf walk, flatten, unflatten, merge and split of nested documents.

Nesting is unrolled as a chain of lateral ``variant_explode_outer`` steps, so a walk is
one scan without a shuffle. A step passes finished rows through. ``levels`` steps are
unrolled; an expression over the value opens what nests deeper, to any depth.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from runlens.functions import documents as D
from runlens.session import stage

LEVELS = 8
#: Leaves that a task merges, but for a single key with more: some 0.75 KB of memory each.
MERGED_ROWS = 250_000


class Written(str):
    """A number as its JSON text writes it."""


def _refused(constant: str):
    raise ValueError(f"{constant} is no JSON value")


def parsed(text: str):
    """A JSON text's value for a walk in Python: numbers stay :class:`Written`."""
    return json.loads(text, parse_int=Written, parse_float=Written, parse_constant=_refused)


def utf8(text: str | None) -> str | None:
    """A text that can be stored: a half of a surrogate pair is a question mark, as in the JVM."""
    return text if text is None or text.isascii() else text.encode("utf-8", "replace").decode()


_ITEMS = "array<struct<_path:array<string>,_pos:array<int>,_v:variant>>"


def _descend(rows: DataFrame, keep: Sequence[str], into: Column) -> DataFrame:
    """Replace each value that ``into`` gives by its members; a row without members stays."""
    members = rows.sparkSession.tvf.variant_explode_outer(into.outer()).toDF("_i", "_k", "_x")
    return rows.lateralJoin(members).select(
        *keep,
        F.when(F.col("_x").isNull(), F.col("_path"))
        .otherwise(F.concat("_path", F.array(F.coalesce("_k", F.col("_i").cast("string")))))
        .alias("_path"),
        F.when(F.col("_x").isNull(), F.col("_pos")).otherwise(F.concat("_pos", F.array("_i"))).alias("_pos"),
        F.coalesce("_x", "_v").alias("_v"),
    )


def _members(value: Column, lists: bool) -> Column:
    """``(k, x)`` of an object's or a list's members in walk order; NULL for other values."""
    fields = F.transform(
        F.map_entries(F.try_variant_get(value, "$", "map<string,variant>")),
        lambda e: F.struct(e["key"].alias("k"), e["value"].alias("x")),
    )
    if not lists:
        return fields
    elements = F.transform(
        F.try_variant_get(value, "$", "array<variant>"), lambda x, i: F.struct(i.cast("string").alias("k"), x.alias("x"))
    )
    return F.coalesce(fields, elements)


def _container(text: Column) -> Column:
    return text.startswith("{") | text.startswith("[")


def _unroll(path: Column, pos: Column, value: Column, text: Column, lists: bool) -> Column:
    """Array with an item per leaf below a value, whose JSON text is given.

    A step opens the items found last, once each. A value can't nest deeper than its text
    has opening brackets, and a step without open items costs nothing.
    """
    empty = F.array().cast(_ITEMS)
    item = F.struct(path.alias("_path"), pos.alias("_pos"), value.alias("_v"))
    depth = F.length(text) - F.length(F.translate(text, "{[", ""))

    def opened(x: Column) -> Column:
        return F.coalesce(F.size(_members(x["_v"], lists)) > 0, F.lit(False))

    def children(x: Column) -> Column:
        return F.transform(
            _members(x["_v"], lists),
            lambda m, i: F.struct(
                F.concat(x["_path"], F.array(m["k"])).alias("_path"),
                F.concat(x["_pos"], F.array(i)).alias("_pos"),
                m["x"].alias("_v"),
            ),
        )

    def step(found: Column, _: Column) -> Column:
        return F.struct(
            F.concat(found["done"], F.filter(found["todo"], lambda x: ~opened(x))).alias("done"),
            F.flatten(F.transform(F.filter(found["todo"], opened), lambda x: F.coalesce(children(x), empty))).alias("todo"),
        )

    start = F.struct(empty.alias("done"), F.array(item).cast(_ITEMS).alias("todo"))
    leaves = F.aggregate(F.sequence(F.lit(0), depth), start, step, lambda found: F.concat(found["done"], found["todo"]))
    return F.when(_container(text), leaves).otherwise(F.array(item).cast(_ITEMS))


def _walk(df: DataFrame, doc: str, keep: Sequence[str], levels: int, lists: bool, drop: Sequence[str]) -> DataFrame:
    """Leaves ``(*keep, path, pos, value, json)``; texts in ``drop`` are empty containers to leave out."""
    rows = df.where(F.col(doc).isNotNull()).select(
        *keep,
        F.array().cast("array<string>").alias("_path"),
        F.array().cast("array<int>").alias("_pos"),
        F.col(doc).alias("_v"),
    )
    first_element = F.try_variant_get("_v", "$[0]", "variant")
    into = F.col("_v") if lists else F.when(first_element.isNull(), F.col("_v"))
    rows = rows.withColumn("_into", into)
    for _ in range(levels):
        rows = _descend(rows, keep, F.col("_into")).withColumn("_into", into)
    # nearly all are scalars by now: their text is made once
    rows = rows.withColumn("_text", F.to_json("_v"))
    leaves = rows.select(*keep, "_text", F.inline(_unroll(F.col("_path"), F.col("_pos"), F.col("_v"), F.col("_text"), lists))).select(
        *keep,
        F.col("_path").alias("path"),
        F.col("_pos").alias("pos"),
        F.try_variant_get("_v", "$", "string").alias("value"),
        F.when(_container(F.col("_text")), F.to_json("_v")).otherwise(F.col("_text")).alias("json"),
    )
    return leaves.where(~F.col("json").isin(*drop)) if drop else leaves


def leaf_values(df: DataFrame, doc: str = "doc", keep: Sequence[str] = (), levels: int = LEVELS) -> DataFrame:
    """Every scalar at any depth, through objects and lists.

    Columns: ``keep``, ``path`` (list positions are path components), ``pos`` (walk
    order), ``value`` (text; NULL for JSON null) and ``json`` (JSON text).
    """
    return _walk(df, doc, keep, levels, lists=True, drop=("{}", "[]"))


def flatten_doc(
    df: DataFrame,
    doc: str = "doc",
    keep: Sequence[str] = (),
    levels: int = LEVELS,
    keep_empty: bool = False,
) -> DataFrame:
    """``(path, value)`` per leaf, where lists are leaves and values are JSON text.

    Empty objects vanish unless ``keep_empty`` marks them with a ``{}`` row.
    """
    drop = () if keep_empty else (D.EMPTY_OBJECT,)
    return _walk(df, doc, keep, levels, lists=False, drop=drop).select(*keep, "path", F.col("json").alias("value"))


def dot_key(path: Column) -> Column:
    return F.array_join(path, ".")


def unflatten_doc(leaves: DataFrame, keys: Sequence[str], member: Column | None = None) -> DataFrame:
    """Inverse of :func:`flatten_doc`: ``(*keys, doc)`` with ``doc`` as JSON text.

    A group is the set of leaves of one output document, which is one output value.
    ``member`` is an array of leaves, made from the keys, to add to each document.
    """
    collected = F.collect_set(F.struct("path", "value"))
    grouped = leaves.groupBy(*keys).agg(collected.alias("_set"))
    whole = F.col("_set") if member is None else F.concat("_set", member)
    return (
        grouped.withColumn("_sorted", F.sort_array(whole))
        .withColumn("_leaves", D.real_leaves(F.col("_sorted")))
        .select(*keys, D.render(F.col("_leaves")).alias("doc"))
    )


def merged_leaves(layers: DataFrame, key: str, layer: str, doc: str = "doc", levels: int = LEVELS) -> DataFrame:
    """Leaves of the deep merge of all layers of a key; higher layers win.

    Objects merge member by member; any other meeting of two values replaces the lower
    one. So a leaf stays unless a higher layer sets its path, sets a non-object at one
    of its ancestors, or (for a scalar) an object at its own path.
    """
    leaves = flatten_doc(layers, doc, [key, layer], levels, keep_empty=True).where(F.size("path") > 0)
    # at one path only the highest value and the highest empty object can matter, to the
    # result or to other paths: this bounds a key by its paths, however many layers it has
    empty = F.col("value") == D.EMPTY_OBJECT
    tops = leaves.groupBy(key, "path", empty.alias("_empty")).agg(
        F.max_by("value", layer).alias("value"), F.max(layer).alias(layer)
    )
    # what is left of a key becomes one document: all further groups lie within this exchange, whose tasks sort
    # their rows more than once and so get a bounded number of them
    tops = stage(tops)
    tops = tops.repartition(max(tops.sparkSession.sparkContext.defaultParallelism, -(-tops.count() // MERGED_ROWS)), key)
    steps = tops.select("*", F.explode(F.sequence(F.lit(1), F.size("path"))).alias("_n"))
    here = F.col("_n") == F.size("path")
    steps = steps.withColumn("_at", F.slice("path", F.lit(1), F.col("_n"))).withColumn("_here", here)
    at = Window.partitionBy(key, "_at")
    top_value = F.max(F.when(F.col("_here") & ~F.col("_empty"), F.col(layer))).over(at)
    top_empty = F.max(F.when(F.col("_here") & F.col("_empty"), F.col(layer))).over(at)
    top_below = F.max(F.when(~F.col("_here"), F.col(layer))).over(at)
    lost_here = F.greatest(top_value, F.when(~F.col("_empty"), F.greatest(top_empty, top_below)))
    lost = F.when(F.col("_here"), lost_here).otherwise(top_value)
    return (
        steps.withColumn("_lost", F.coalesce(lost > F.col(layer), F.lit(False)))
        .groupBy(key, layer, "path", "value")
        .agg(F.max("_lost").alias("_lost"))
        .where(~F.col("_lost"))
        .select(key, "path", "value")
    )


def merge_docs(layers: DataFrame, key: str, layer: str, doc: str = "doc", levels: int = LEVELS) -> DataFrame:
    """Deep merge of all layers of a key into one JSON document."""
    return unflatten_doc(merged_leaves(layers, key, layer, doc, levels), [key])


def split_leaves(
    df: DataFrame,
    rules: Sequence[tuple[str, str]],
    doc: str = "doc",
    keep: Sequence[str] = (),
    levels: int = LEVELS,
) -> DataFrame:
    """Leaves sorted into output rows: ``(*keep, rule, key, path, value)``.

    For each rule, a leaf with matching path components goes to the row of its last
    matching component and loses all matching ones. Leaves that no rule matches keep
    their path, with NULL ``rule`` and ``key``. The rule name itself becomes a member.
    """
    leaves = flatten_doc(df, doc, keep, levels)
    routes = []
    for name, regex in rules:
        hits = F.filter("path", lambda k: k.rlike(regex))
        rest = F.filter("path", lambda k: ~k.rlike(regex))
        routes.append(
            F.when(
                F.size(hits) > 0,
                F.struct(F.lit(name).alias("rule"), F.element_at(hits, -1).alias("key"), rest.alias("_rest")),
            )
        )
    matched = F.array_compact(F.array(*routes))
    unmatched = F.array(
        F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("key"), F.col("path").alias("_rest"))
    )
    routed = leaves.select(
        *keep,
        F.inline(F.when(F.size(matched) > 0, matched).otherwise(unmatched)),
        "value",
    )
    return routed.select(*keep, "rule", "key", "_rest", "value").withColumnRenamed("_rest", "path")


def split_docs(
    df: DataFrame,
    rules: Sequence[tuple[str, str]],
    doc: str = "doc",
    keep: Sequence[str] = (),
    levels: int = LEVELS,
) -> DataFrame:
    """One document per distinct matched key, plus the rest: ``(*keep, rule, key, doc)``."""
    leaves = split_leaves(df, rules, doc, keep, levels)
    # the rule's own member replaces whatever else the document has under that name; leaves
    # that lost their whole path have no place but must not make their document disappear
    own = F.coalesce(F.get("path", F.lit(0)) == F.col("rule"), F.lit(False))
    placed = leaves.withColumn("path", F.when(own, F.array().cast("array<string>")).otherwise(F.col("path")))
    name = F.to_json(F.array("key"))
    member = F.when(
        F.col("rule").isNotNull(),
        F.array(F.struct(F.array("rule").alias("path"), name.substr(F.lit(2), F.length(name) - 2).alias("value"))),
    ).otherwise(F.array().cast("array<struct<path:array<string>,value:string>>"))
    return unflatten_doc(placed, [*keep, "rule", "key"], member)
