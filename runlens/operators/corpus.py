"""Source corpora: imports, their closure, directives and configuration includes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from runlens.functions import includes, uris
from runlens.functions.labels import DEFAULT_NAMING, Naming
from runlens.session import cut_lineage

# An import line, and the depth at which an import chain counts as endless.
IMPORT_LINE = r"^\s*import\s+[\"\'](.+)[\"\']\s*"
MAX_DEPTH = 20
FLAGS = "(?dU)"

ABSOLUTE, MISSING, OUTSIDE = "absolute_path", "missing", "outside_root"


def matched_lines(lines: DataFrame, regex: str, strip: bool = True) -> DataFrame:
    """``(path, line_no, value)``: first group of every matching line."""
    value = F.regexp_extract("line", FLAGS + regex, 1)
    if strip:
        value = F.regexp_replace(value, r"(?U)^\s+|\s+\z", "")
    return lines.where(F.col("line").rlike(FLAGS + regex)).select("path", "line_no", value.alias("value"))


def first_match(lines: DataFrame, regex: str) -> DataFrame:
    """``(path, value)`` of each file's first matching line."""
    return matched_lines(lines, regex).groupBy("path").agg(F.min_by("value", "line_no").alias("value"))


def import_edges(lines: DataFrame) -> DataFrame:
    """``(src, target, line_no)`` per import line; ``target`` as written."""
    return matched_lines(lines, IMPORT_LINE).select(F.col("path").alias("src"), F.col("value").alias("target"), "line_no")


def resolve_imports(edges: DataFrame, files: DataFrame, root_dir: str | None = None) -> DataFrame:
    """Add ``dst, kind, exists``: relative targets resolved against the importing file's directory.

    ``files`` is ``(path)``. URLs stay as they are. What a file imported by URL names
    relatively lies in ``root_dir``, the directory of the root file.
    """
    kind = _kind(F.col("target"))
    base = F.when(uris.uri_scheme(F.col("src")) == "http", F.lit(root_dir)).otherwise(uris.path_dirname(F.col("src")))
    relative = uris.normalise_path(F.concat(base, F.lit("/"), "target"))
    placed = edges.withColumn("kind", kind).withColumn(
        "dst", F.when(F.col("kind") == "relative", relative).otherwise(F.col("target"))
    )
    known = files.select(F.col("path").alias("dst"), F.lit(True).alias("exists")).distinct()
    return placed.join(known, "dst", "left").withColumn("exists", F.coalesce("exists", F.lit(False)))


def _kind(target: Column) -> Column:
    scheme = uris.uri_scheme(target)
    return F.when(scheme == "http", "url").when(scheme == "local", "absolute").otherwise("relative")


def import_closure(
    edges: DataFrame, files: DataFrame, roots: DataFrame | None = None, max_depth: int = MAX_DEPTH, strict: bool = False
) -> DataFrame:
    """Everything reachable by imports from each root: ``(root, file, depth, kind, violation)``.

    Relative imports resolve against the importing file's directory; those of a file
    imported by URL resolve against the root's. ``violation`` marks an import by
    absolute path, of a missing file, or outside the root's directory; such imports and
    missing ones are not followed. Rows at ``max_depth + 1`` mean an endless import;
    with ``strict`` they fail the query.

    Where a file's imports lead depends on the file alone, so they are resolved and looked up once; only those of
    a file imported by URL depend on the root and are looked up in the round that meets them. One round per
    import level joins the new files, each once per root, with the resolved lines, and checkpoints its result.
    All joins are by sorting: a broadcast in every round would add up at the driver.
    """
    known = files.select(F.col("path").alias("dst")).distinct().withColumn("present", F.lit(True)).hint("merge")
    written = edges.select("src", "target").distinct().withColumn("kind", _kind(F.col("target")))
    by_url = (uris.uri_scheme(F.col("src")) == "http") & (F.col("kind") == "relative")
    relative = lambda base: uris.normalise_path(F.concat_ws("/", base, "target"))
    placed = written.withColumns(
        {"by_root": F.coalesce(by_url, F.lit(False)), "dst": F.when(F.col("kind") == "relative", relative(uris.path_dirname(F.col("src")))).otherwise(F.col("target"))}
    )
    lines = cut_lineage(placed.join(known, "dst", "left").select("src", "target", "kind", "by_root", "dst", F.coalesce("present", F.lit(False)).alias("present")))
    from_urls = not lines.where("by_root").isEmpty()
    start = (roots or files).select(F.col("path").alias("root")).distinct()
    frontier = start.select("root", uris.path_dirname(F.col("root")).alias("root_dir"), F.col("root").alias("file"))
    levels = []
    for depth in range(1, max_depth + 2):
        steps = frontier.join(lines.hint("merge"), F.col("file") == F.col("src")).select("root", "root_dir", "target", "kind", "by_root", "dst", "present")
        if from_urls:
            own = steps.where("by_root").withColumn("dst", relative(F.col("root_dir"))).drop("present")
            looked = own.join(known, "dst", "left").withColumn("present", F.coalesce("present", F.lit(False)))
            steps = steps.where("NOT by_root").unionByName(looked)
        reached = steps.select("root", "root_dir", F.col("dst").alias("file"), "kind", "present").distinct()
        checked = reached.withColumn(
            "violation",
            F.when(F.col("kind") == "absolute", ABSOLUTE)
            .when(F.col("kind") == "url", None)
            .when(~F.col("present"), MISSING)
            .when(~F.col("file").startswith(F.col("root_dir")), OUTSIDE),
        )
        level = cut_lineage(checked.withColumn("depth", F.lit(depth)))
        frontier = level.where("violation IS NULL AND present").select("root", "root_dir", "file")
        levels.append(level.select("root", "file", "depth", "kind", "violation"))
        if level.isEmpty():
            break
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    if strict:
        message = F.concat(F.lit(f"imports nest deeper than {max_depth}, maybe a cycle, from "), F.col("root"))
        endless = F.when(F.col("depth") > max_depth, F.raise_error(message).cast("int")).otherwise(F.col("depth"))
        out = out.withColumn("depth", endless)
    return out


def import_violations(closure: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """``(root, file, depth, violation)`` for every broken import, too deep ones included."""
    too_deep = F.when(F.col("depth") > max_depth, "too_deep")
    out = closure.withColumn("violation", F.coalesce("violation", too_deep))
    return out.where("violation IS NOT NULL").select("root", "file", "depth", "violation")


def packaged_imports(closure: DataFrame) -> DataFrame:
    """``(root, n_files)``: files packaged with a root. Roots without any do not appear.

    URL imports are followed but not packaged.
    """
    packed = closure.where("kind = 'relative' AND violation IS NULL")
    return packed.select("root", "file").distinct().groupBy("root").agg(F.count("*").alias("n_files"))


def default_image(
    lines: DataFrame, meta: DataFrame | None, kind: str, naming: Naming = DEFAULT_NAMING, files: DataFrame | None = None
) -> DataFrame:
    """``(path, image)``: first present meta key of the workflow, else the first directive line.

    ``meta`` is ``(path, meta MAP<STRING,STRING>)``. A conda environment has no directive.
    """
    keys: Sequence[str] = naming.image_keys(kind)
    none = F.create_map().cast("map<string,string>")
    if meta is None:
        meta = lines.select("path").distinct().withColumn("meta", none)
    from_meta = meta.select("path", F.coalesce(*[F.col("meta")[k] for k in keys]).alias("_meta"))
    if kind == "conda":
        return from_meta.where("_meta IS NOT NULL").select("path", F.col("_meta").alias("image"))
    directive = first_match(lines, naming.directive(kind)).select(
        "path", F.regexp_replace("value", r"^[\"']+|[\"']+\z", "").alias("_line")
    )
    joined = from_meta.join(directive, "path", "full")
    return joined.select("path", F.coalesce("_meta", "_line").alias("image")).where("image IS NOT NULL")


def config_includes(files: DataFrame) -> DataFrame:
    """``(path, key, statement)`` per distinct include statement of a configuration text."""
    found = files.select("path", F.explode(includes.all_statements(F.col("text"))).alias("statement"))
    return found.select("path", includes.key_of(F.col("statement")).alias("key"), "statement")
