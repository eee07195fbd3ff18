"""URIs and paths."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


#: What a URI starts with; these are the texts to which :func:`uri_scheme` gives a scheme.
STARTS = ("gs://", "s3://", "http://", "https://", "/")


def uri_scheme(s: Column) -> Column:
    """``gs``, ``s3``, ``http``, ``local`` (absolute path) or NULL."""
    return (
        F.when(s.startswith("gs://"), "gs")
        .when(s.startswith("s3://"), "s3")
        .when(s.startswith("http://") | s.startswith("https://"), "http")
        .when(s.startswith("/"), "local")
    )


def basename(uri: Column) -> Column:
    return F.substring_index(uri, "/", -1)


def dirname(uri: Column) -> Column:
    """Everything before the last ``/``; empty when there is none."""
    return F.regexp_replace(uri, r"(?s)(?:/|^)[^/]*\z", "")


def path_dirname(path: Column) -> Column:
    """Directory of a path: trailing slashes removed, ``/`` for a file in the root."""
    head = F.regexp_replace(path, r"(?s)[^/]*\z", "")
    trimmed = F.rtrim(head, F.lit("/"))
    return F.when((trimmed == "") & (head != ""), head).otherwise(trimmed)


def basename_wo_ext(uri: Column) -> Column:
    """Last component without its last extension (leading dots are part of the name)."""
    return F.regexp_replace(basename(uri), r"(?s)^(\.*[^.].*)\.[^.]*\z", "$1")


def extension(uri: Column) -> Column:
    return F.regexp_extract(basename(uri), r"(?s)^\.*[^.].*(\.[^.]*)\z", 1)


def bucket_of(uri: Column) -> Column:
    """Bucket of an ``s3://`` URI; the text up to the first slash otherwise."""
    return F.substring_index(F.regexp_replace(uri, r"^s3://", ""), "/", 1)


def workflow_root_of_call(call_root: Column) -> Column:
    return F.when(call_root != "", dirname(call_root))


def workflow_id_of_root(root: Column) -> Column:
    return F.when(root != "", basename(root))


def ancestors(path: Column, first_level: int = 1) -> Column:
    """Proper ancestor directories that have at least ``first_level`` components.

    The empty component before the leading slash counts, as in ``split``.
    """
    parts = F.split(path, "/")
    n = F.size(parts)
    return F.when(
        n > first_level,
        F.transform(
            F.sequence(F.lit(first_level), n - 1),
            lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"),
        ),
    ).otherwise(F.array().cast("array<string>"))


def normalise_path(path: Column) -> Column:
    """Absolute path with ``.``, ``..`` and repeated slashes resolved."""
    empty = F.array().cast("array<string>")
    parts = F.aggregate(
        F.split(path, "/"),
        empty,
        lambda acc, part: F.when(part.isin("", "."), acc)
        .when(part == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(part))),
    )
    return F.concat(F.lit("/"), F.array_join(parts, "/"))


def common_prefix(a: Column, b: Column) -> Column:
    """Longest common character prefix of two strings."""
    shorter = F.least(F.length(a), F.length(b))
    # the first differing position is found by halving, so long paths cost log(length) comparisons
    bounds = F.struct(F.lit(0).alias("lo"), shorter.alias("hi"))
    found = F.aggregate(
        F.sequence(F.lit(1), F.lit(32)),
        bounds,
        lambda acc, _: F.when(acc["lo"] >= acc["hi"], acc).otherwise(
            F.when(
                a.substr(F.lit(1), _mid(acc)) == b.substr(F.lit(1), _mid(acc)),
                F.struct(_mid(acc).alias("lo"), acc["hi"].alias("hi")),
            ).otherwise(F.struct(acc["lo"].alias("lo"), (_mid(acc) - 1).alias("hi")))
        ),
    )
    return a.substr(F.lit(1), found["lo"])


def _mid(bounds: Column) -> Column:
    return F.floor((bounds["lo"] + bounds["hi"] + 1) / 2).cast("int")
