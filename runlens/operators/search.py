"""Search and listing of workflows by id and label, and label maintenance.

A workflow listing has the columns ``id, name, status, submission, start, end,
parentWorkflowId, labels MAP<STRING,STRING>`` (a listing may have more or fewer).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from runlens.functions import ids as I, uris
from runlens.functions.labels import DEFAULT_NAMING, Naming, clean_label

Label = tuple[str, str]
DEFAULT_FORMAT = ("id", "status", "name", "str_label", "user", "parent", "submission")


def exclude_subworkflows(wf: DataFrame, exclude: bool = True) -> DataFrame:
    return wf.where("parentWorkflowId IS NULL") if exclude else wf


def label_matches(key: str, value: str) -> Column:
    """Wildcard match of one label; an empty or absent label never matches."""
    actual = F.col("labels")[key]
    return (actual != "") & I.wildcard_match(actual, value)


def find_with_wildcard(
    wf: DataFrame,
    ids: Sequence[str] | None = None,
    labels: Sequence[Label] | None = None,
    exclude_subworkflow: bool = True,
) -> DataFrame:
    """Workflows whose id matches any pattern or whose label matches any (key, pattern)."""
    found = [I.wildcard_match(F.col("id"), p) for p in ids or ()]
    found += [label_matches(k, v) for k, v in labels or ()]
    return exclude_subworkflows(wf, exclude_subworkflow).where(I.any_of(found))


def find_by_ids(wf: DataFrame, ids: Sequence[str] | None = None, exclude_subworkflow: bool = True) -> DataFrame:
    """Exact id search. Invalid ids are ignored; with no valid id nothing is found."""
    if I.has_wildcard(ids):
        raise ValueError(f"wildcards are not allowed in ids: {ids}")
    valid = sorted({i for i in ids or () if I.uuid_ok(i)})
    rows = exclude_subworkflows(wf, exclude_subworkflow)
    if not valid:
        return rows.where(F.lit(False))
    return rows.where(F.col("id").isin(*valid))


def find_by_labels(
    wf: DataFrame, labels: Sequence[Label] | None = None, exclude_subworkflow: bool = True
) -> DataFrame:
    """Exact (key, value) search, any pair; pairs with an empty value are ignored."""
    if I.has_wildcard([part for pair in labels or () for part in pair]):
        raise ValueError(f"wildcards are not allowed in labels: {labels}")
    wanted: dict[str, list[str]] = {}
    for key, value in labels or ():
        if value:
            wanted.setdefault(key, []).append(value)
    found = [F.col("labels")[key].isin(*values) for key, values in wanted.items()]
    return exclude_subworkflows(wf, exclude_subworkflow).where(I.any_of(found))


def find(
    wf: DataFrame,
    ids: Sequence[str] | None = None,
    labels: Sequence[Label] | None = None,
    exclude_subworkflow: bool = True,
) -> DataFrame:
    """Label matches, and id matches that are not among them; each workflow once.

    A ``?`` or ``*`` in any id or label value makes all of them patterns; ``[seq]``
    alone does not. Any number of ids is one predicate, so the outcome never depends on it.
    """
    if I.has_wildcard(ids) or I.has_wildcard([v for _, v in labels or ()]):
        return find_with_wildcard(wf, ids, labels, exclude_subworkflow)
    # one scan: a row is kept when either exact search would keep it
    valid = sorted({i for i in ids or () if I.uuid_ok(i)})
    found = [F.col("labels")[key] == value for key, value in labels or () if value]
    if valid:
        found.append(F.col("id").isin(*valid))
    return exclude_subworkflows(wf, exclude_subworkflow).where(I.any_of(found))


def get_metadata(found: DataFrame, docs: DataFrame) -> DataFrame:
    """Documents of found ids; ids without a document are skipped and duplicates kept."""
    return found.select("id").join(docs, "id", "inner")


def hide_before(wf: DataFrame, cutoff: str | None) -> DataFrame:
    """Drop workflows submitted at or before the cut-off, compared as text; keep undated ones."""
    if cutoff is None:
        return wf
    undated = F.col("submission").isNull() | (F.col("submission") == "")
    return wf.where(undated | (F.col("submission") > cutoff))


def list_workflows(
    wf: DataFrame, format: Sequence[str] = DEFAULT_FORMAT, naming: Naming = DEFAULT_NAMING
) -> DataFrame:
    """Chosen columns in order, all text; whatever is missing reads ``None``."""
    special = {
        "workflow_id": F.col("id"),
        "str_label": F.col("labels")[naming.str_label],
        "user": F.col("labels")[naming.user],
        "parent": F.col("parentWorkflowId"),
    }
    columns = []
    for name in format:
        value = special.get(name, F.col(name) if name in wf.columns else F.lit(None))
        columns.append(F.coalesce(value.cast("string"), F.lit("None")).alias(name))
    return wf.select(*columns)


def build_labels(
    df: DataFrame,
    custom: str = "custom",
    backend: str = "backend",
    str_label: str = "str_label",
    user: str = "user",
    inputs: str | None = None,
    naming: Naming = DEFAULT_NAMING,
) -> DataFrame:
    """Add ``labels``: custom labels (JSON text), then backend, clean string label and user.

    Empty backend and label are left out. ``inputs`` names a column with the input
    file's URI, whose base name is the label where none is given. A nested custom label
    stays JSON text; a custom text that is no JSON object fails the query.
    """
    label = F.col(str_label)
    if inputs is not None:
        label = F.coalesce(label, uris.basename_wo_ext(F.col(inputs)))
    reserved = F.map_filter(
        F.create_map(
            F.lit(naming.backend), F.nullif(F.col(backend), F.lit("")),
            F.lit(naming.str_label), F.nullif(clean_label(label), F.lit("")),
            F.lit(naming.user), F.col(user),
        ),
        lambda _, v: v.isNotNull(),
    )
    given = F.coalesce(F.from_json(custom, "map<string,string>", {"mode": "FAILFAST"}), F.create_map().cast("map<string,string>"))
    kept = F.map_filter(given, lambda k, _: ~F.array_contains(F.map_keys(reserved), k))
    return df.withColumn("labels", F.map_concat(kept, reserved))


def get_labels(wf: DataFrame, workflow_id: str | None) -> DataFrame:
    """Labels of one workflow; no row for an invalid id."""
    if not I.uuid_ok(workflow_id):
        return wf.where(F.lit(False)).select("id", "labels")
    return wf.where(F.col("id") == workflow_id).select("id", "labels")


def get_label(wf: DataFrame, workflow_id: str | None, key: str) -> DataFrame:
    return get_labels(wf, workflow_id).select("id", F.col("labels")[key].alias("value"))


def update_labels(wf: DataFrame, updates: DataFrame) -> DataFrame:
    """Upsert labels from ``(id, key, val, seq)``; the update with the highest ``seq`` wins.

    Updates are first reduced to one value per (id, key), which combines map-side, so an
    id with very many updates stays one label map.
    """
    latest = updates.groupBy("id", "key").agg(F.max_by("val", "seq").alias("val"))
    maps = latest.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("key", "val"))).alias("_new"))
    joined = wf.join(maps, "id", "left")
    none = F.create_map().cast("map<string,string>")
    old, new = F.coalesce("labels", none), F.coalesce("_new", none)
    kept = F.map_filter(old, lambda k, _: ~F.coalesce(F.map_contains_key(new, k), F.lit(False)))
    return joined.withColumn("labels", F.map_concat(kept, new)).select(wf.columns)
