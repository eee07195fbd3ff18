"""Resource monitoring: statistics of sampled series and sizes of input files."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from runlens.functions import sizes, uris
from runlens.operators import nested
from runlens.session import stage

DEFAULT_STATS = ("mean", "std", "max", "min", "last")


def _bias_corrected_skew(val: str) -> Column:
    n = F.count(val)
    return F.when(n > 2, F.skewness(val) * F.sqrt(n * (n - 1)) / (n - 2))


def _bias_corrected_kurt(val: str) -> Column:
    n = F.count(val)
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(val) + 6))


# name -> aggregate over the series. All are combined map-side.
STATS: dict[str, Callable[[str, str], Column]] = {
    "mean": lambda val, row: F.avg(val),
    "std": lambda val, row: F.stddev_samp(val),
    "var": lambda val, row: F.var_samp(val),
    "max": lambda val, row: F.max(val),
    "min": lambda val, row: F.min(val),
    "sum": lambda val, row: F.sum(val),
    "count": lambda val, row: F.count(val).cast("double"),
    "last": lambda val, row: F.max_by(val, row),
    "sem": lambda val, row: F.stddev_samp(val) / F.sqrt(F.count(val)),
    "skew": lambda val, row: _bias_corrected_skew(val),
    "kurt": lambda val, row: _bias_corrected_kurt(val),
}
# statistics by rank, besides any ``quantile(q)``
RANKED = {"median": 0.5}
#: Distinct values of a series that a task ranks at most, but for what sampled borders miss.
ROWS_PER_TASK = 1_000_000
#: Statistics that are integers where all values of a series are; a count always is.
WHOLE = ("max", "min", "last", "sum")
# sample statistics that have no value for a single row
_NEEDS_TWO = ("std", "var", "sem")


def register_stat(name: str, build: Callable[[str, str], Column]) -> None:
    """Add a named statistic: ``build(value_column, row_number_column)`` gives an aggregate."""
    STATS[name] = build


def drop_columns_at(long: DataFrame, positions: Sequence[int] = (0,)) -> DataFrame:
    """Leave out series columns by 0-based position (the time column by default)."""
    return long.where(~F.col("col_no").isin(*positions)) if positions else long


def resource_stats(
    long: DataFrame, stats: Sequence[str] = DEFAULT_STATS, excluded_cols: Sequence[int] = (0,)
) -> DataFrame:
    """``(log, col, n_rows, <one column per statistic>)``.

    ``long`` is ``(log, row_no, col_no, col, val)``. A log with a header only (``row_no``
    NULL) keeps its rows, with NULL statistics. A statistic is a name of ``STATS``, ``median`` or
    ``quantile(q)``; the last two are exact, see :func:`series_quantiles`.
    """
    ranked = {s: q for s in stats if (q := _rank_of(s)) is not None}
    plain = [STATS[s]("val", "row_no").alias(s) for s in stats if s not in ranked]
    out = drop_columns_at(long, excluded_cols).groupBy("log", "col").agg(F.count("row_no").alias("n_rows"), *plain)
    if ranked:
        found = series_quantiles(long, list(ranked.values()), excluded_cols)
        named = found.select("log", "col", *[F.get("quantiles", F.lit(i)).alias(s) for i, s in enumerate(ranked)])
        out = out.join(named, ["log", "col"], "left")
    return out.select("log", "col", "n_rows", *[f"`{s}`" for s in stats])


def whole_columns(long: DataFrame, excluded_cols: Sequence[int] = (0,)) -> DataFrame:
    """``(log, col, n_rows, whole)``: whether every row of a series has an integer; without the flag in ``long``, a whole number."""
    flag = F.col("whole") if "whole" in long.columns else (F.col("val") == F.floor("val"))
    flag = F.coalesce(flag, F.lit(False)) | F.col("row_no").isNull()
    return drop_columns_at(long, excluded_cols).groupBy("log", "col").agg(F.count("row_no").alias("n_rows"), F.min(flag).alias("whole"))


def _rank_of(stat: str) -> float | None:
    """The share of ranks below a statistic's value; None for one that is an aggregate."""
    if stat in RANKED and stat not in STATS:
        return RANKED[stat]
    found = re.fullmatch(r"quantile\((0(?:\.[0-9]+)?|1(?:\.0+)?|\.[0-9]+)\)", stat)
    return float(found[1]) if found else None


def by_rank(counts: DataFrame, keys: Sequence[str], value: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Rows ``(*keys, value, ...)`` in parts of about ``rows_per_task``, with ``_part``; written once.

    Parts are ranges of (keys, value) between sampled borders, so neither a key with most rows nor values
    that lie close together fill a part. Parts are numbered in the order of their ranges.
    """
    rows = stage(counts)
    parts = max(1, -(-rows.count() // rows_per_task))
    return stage(rows.repartitionByRange(parts, *keys, value).withColumn("_part", F.spark_partition_id()))


def series_quantiles(
    long: DataFrame, qs: Sequence[float], excluded_cols: Sequence[int] = (0,), rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """``(log, col, quantiles ARRAY<DOUBLE>)``: exact quantiles with linear interpolation, one for each of ``qs``.

    Equal values are counted first and dealt to ranges between sampled borders. Counts per range tell which
    ranges hold the wanted ranks, and only those are ranked within: no task sorts more than a range.
    """
    keys = ["log", "col"]
    counts = drop_columns_at(long, excluded_cols).where("val IS NOT NULL").groupBy(*keys, "val").agg(
        F.count("*").alias("n")
    )
    placed = by_rank(counts, keys, "val", rows_per_task)
    sums = placed.groupBy(*keys, "_part").agg(F.sum("n").alias("held"))
    # one row per key and range that holds values of it
    of_key = Window.partitionBy(*keys)
    before = of_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = sums.select(*keys, "_part", "held", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"), F.sum("held").over(of_key).alias("total"))

    def ends(i: int, q: float) -> list[Column]:
        at = (F.col("total") - 1) * F.lit(float(q))
        return [
            F.struct(F.lit(i).alias("q"), F.lit(side).alias("side"), rank.cast("bigint").alias("rank"), (at - F.floor(at)).alias("w"))
            for side, rank in enumerate((F.floor(at), F.ceil(at)))
        ]

    wanted = F.array(*[e for i, q in enumerate(qs) for e in ends(i, q)])
    here = F.filter(wanted, lambda e: (e["rank"] >= F.col("before")) & (e["rank"] < F.col("before") + F.col("held")))
    looked = ranges.select(*keys, "_part", "before", here.alias("wanted")).where(F.size("wanted") > 0)
    within = Window.partitionBy("_part", *keys).orderBy("val").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = placed.join(looked, [*keys, "_part"]).withColumn("upto", F.col("before") + F.sum("n").over(within))
    hits = F.filter("wanted", lambda e: (e["rank"] < F.col("upto")) & (e["rank"] >= F.col("upto") - F.col("n")))
    found = ranked.select(*keys, "val", F.inline(hits))
    side = lambda k: F.max(F.when(F.col("side") == k, F.col("val")))
    pairs = found.groupBy(*keys, "q").agg(side(0).alias("a"), side(1).alias("b"), F.max("w").alias("w"))
    each = pairs.select(*keys, "q", (F.col("a") + (F.col("b") - F.col("a")) * F.col("w")).alias("value"))
    return each.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("q", "value"))), lambda e: e["value"]).alias("quantiles"))


def series_quantile(
    long: DataFrame, q: float = 0.5, excluded_cols: Sequence[int] = (0,), rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """``(log, col, quantile)``: one exact quantile; see :func:`series_quantiles`."""
    return series_quantiles(long, [q], excluded_cols, rows_per_task).select("log", "col", F.get("quantiles", F.lit(0)).alias("quantile"))


def stat_metrics(stats: DataFrame) -> DataFrame:
    """Long form ``(log, metric, val)`` with dot keys such as ``stats.max.mem``.

    A sample deviation of one row is NaN here, so that a fit on it fails as a whole
    rather than using the other rows.
    """
    names = [c for c in stats.columns if c not in ("log", "col", "n_rows")]

    def value(name: str) -> Column:
        if name in _NEEDS_TWO:
            return F.when(F.col("n_rows") == 1, F.lit(float("nan"))).otherwise(F.col(name))
        return F.col(f"`{name}`").cast("double")

    pairs = [F.struct(F.lit(n).alias("stat"), value(n).alias("val")) for n in names]
    rows = stats.select("log", "col", F.inline(F.array(*pairs)))
    return rows.select("log", F.concat_ws(".", F.lit("stats"), "stat", "col").alias("metric"), "val")


def stats_map(stats: DataFrame) -> DataFrame:
    """``(log, stats MAP<stat, MAP<col, value>>)``; a log has few columns, so groups are small."""
    names = [c for c in stats.columns if c not in ("log", "col", "n_rows")]
    by_stat = [
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("col", F.col(f"`{n}`").cast("double"))))).alias(n)
        for n in names
    ]
    maps = stats.groupBy("log").agg(*by_stat)
    entries = [x for n in names for x in (F.lit(n), F.col(f"`{n}`"))]
    return maps.select("log", F.create_map(*entries).alias("stats"))


def instance(calls: DataFrame) -> DataFrame:
    """Add ``cpu`` (count), ``disk`` and ``mem`` (bytes) from the runtime attributes."""
    attrs = F.col("runtimeAttributes")
    return calls.withColumns(
        {
            "cpu": attrs["cpu"].try_cast("int"),
            "disk": sizes.parse_disk(attrs["disks"]),
            "mem": sizes.parse_size(attrs["memory"]),
        }
    )


def filter_task(df: DataFrame, name: str | None, wildcard: bool = False, col: str = "call_name") -> DataFrame:
    """One task, by exact name (monitoring) or wildcard (analysis)."""
    from runlens.functions.ids import wildcard_match

    if not name:
        return df
    return df.where(wildcard_match(F.col(col), name) if wildcard else F.col(col) == name)


def with_monitor_log(calls: DataFrame, logs: DataFrame, scheme: str = "gs") -> DataFrame:
    """Calls whose monitoring log is a bucket URI that exists in ``logs(log, ...)``."""
    usable = calls.where(F.col("monitoringLog").isNotNull() & (uris.uri_scheme(F.col("monitoringLog")) == scheme))
    present = logs.select(F.col("log").alias("monitoringLog")).distinct()
    return usable.join(present, "monitoringLog", "left_semi")


def attach_metrics(calls: DataFrame, stats: DataFrame) -> DataFrame:
    """Calls with ``metrics ARRAY<STRUCT<metric, val>>`` of their log; calls without a log are dropped.

    A log has one metric per column and statistic, so the arrays are short.
    """
    metrics = stat_metrics(stats).groupBy("log").agg(F.collect_list(F.struct("metric", "val")).alias("metrics"))
    return attach_stats(calls, metrics)


def attach_stats(calls: DataFrame, stats: DataFrame) -> DataFrame:
    """Calls with their log's statistics; calls without a log are dropped."""
    return calls.join(stats, F.col("monitoringLog") == F.col("log"), "inner").drop("log")


_SCALAR = T.StructType().add("var", T.StringType()).add("pos", T.ArrayType(T.IntegerType())).add("text", T.StringType()).add("quoted", T.BooleanType())


@F.arrow_udf(T.ArrayType(_SCALAR))
def _scalars(texts: pa.Array) -> pa.Array:
    """Scalars of JSON texts in document order, but for nulls; those that are not ``quoted`` as the text writes them."""
    starts, ends, names, at, values, quoted = [0], [0], [], [], [], []
    for text in texts:
        # what is still to be looked at, the next one last
        todo = [(None, [], nested.parsed(text.as_py()))] if text.is_valid else []
        while todo:
            name, pos, value = todo.pop()
            if isinstance(value, (dict, list)):
                members = value.items() if isinstance(value, dict) else enumerate(value)
                todo += [(name if pos else str(k), [*pos, i], x) for i, (k, x) in enumerate(members)][::-1]
            elif value is not None:
                names.append(name)
                at += pos
                ends.append(len(at))
                plain = isinstance(value, str) and not isinstance(value, nested.Written)
                values.append(nested.utf8(value) if plain else str(value).lower() if isinstance(value, bool) else value)
                quoted.append(plain)
        starts.append(len(names))
    places = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(at, pa.int32()))
    scalars = pa.StructArray.from_arrays([pa.array(map(nested.utf8, names), pa.string()), places, pa.array(values, pa.string()), pa.array(quoted, pa.bool_())], ["var", "pos", "text", "quoted"])
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), scalars)


def input_leaves(calls: DataFrame, keys: Sequence[str], inputs: str = "inputs") -> DataFrame:
    """``(*keys, var, pos, value)`` for every scalar in the calls' inputs; ``pos`` is its order in the document.

    Inputs are walked once, in the order of the document, at any depth; of members with one name the last counts.
    """
    # a number's text is a parsed number's, whichever way the document writes it
    value = lambda x: F.when(x["quoted"], x["text"]).otherwise(F.try_variant_get(F.parse_json(x["text"]), "$", "string"))
    scalars = F.transform(_scalars(F.col(inputs)), lambda x: F.struct(x["var"].alias("var"), x["pos"].alias("pos"), value(x).alias("value")))
    return calls.select(*keys, F.inline(scalars))


def file_leaves(leaves: DataFrame, scheme: str | None = "gs") -> DataFrame:
    """Leaves that are URIs of a storage class (of any class for ``scheme=None``)."""
    found = uris.uri_scheme(F.col("value"))
    return leaves.where(found.isNotNull() if scheme is None else found == scheme)


def attach_sizes(leaves: DataFrame, catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(sized, missing)``: leaves with the catalogue's size, and leaves it does not know.

    The catalogue ``(path, length)`` has one row per file; a file read by many calls
    makes only the leaf side skewed, which adaptive execution splits.
    """
    sides = leaves.join(
        catalog.select(F.col("path").alias("value"), F.col("length").alias("size")), "value", "left"
    )
    return sides.where("size IS NOT NULL"), sides.where("size IS NULL").drop("size")


def input_sizes(sized: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(*keys, input_file_sizes MAP<var, ARRAY<size>>)`` with variables in name order.

    A group holds the files named in one call's input document, which was one row. Rows are dealt by call, so both
    groupings lie within one exchange.
    """
    per_var = sized.repartition(*keys).groupBy(*keys, "var").agg(F.sort_array(F.collect_list(F.struct("pos", "size"))).alias("_s"))
    return (
        per_var.select(*keys, "var", F.transform("_s", lambda s: s["size"]).alias("sizes"))
        .groupBy(*keys)
        .agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("var", "sizes")))).alias("input_file_sizes"))
    )


def record_metrics(records: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Dot-keyed numbers of the call record itself: shard, attempt and instance shape."""
    fields = {
        "shard_idx": "shardIndex",
        "attempt": "attempt",
        "instance.cpu": "cpu",
        "instance.disk": "disk",
        "instance.mem": "mem",
    }
    pairs = [
        F.struct(F.lit(name).alias("metric"), F.col(col).cast("double").alias("val")) for name, col in fields.items()
    ]
    return records.select(*keys, F.inline(F.array(*pairs)))


def monitor_records(
    calls: DataFrame,
    long: DataFrame,
    catalog: DataFrame,
    keys: Sequence[str] = ("id", "ord"),
    stats: Sequence[str] = DEFAULT_STATS,
    excluded_cols: Sequence[int] = (0,),
    task_name: str | None = None,
) -> DataFrame:
    """One nested resource record per call that has a monitoring log.

    ``series`` tells for each column of the log how many rows it has and whether all are integers.
    """
    shapes = whole_columns(long, excluded_cols).groupBy("log").agg(
        F.map_from_entries(F.collect_list(F.struct("col", F.struct("n_rows", "whole")))).alias("series")
    )
    summary = stats_map(resource_stats(long, stats, excluded_cols)).join(shapes, "log")
    # read by two branches, and made from whole documents
    attached = attach_stats(instance(filter_task(calls, task_name)), summary)
    monitored = stage(attached.select(*keys, "call_name", "shardIndex", "executionStatus", "attempt", "cpu", "disk", "mem", "inputs", "stats", "series"))
    sized, _ = attach_sizes(file_leaves(input_leaves(monitored, keys)), catalog)
    joined = monitored.join(input_sizes(sized, keys), list(keys), "left")
    return joined.select(
        *keys,
        F.col("call_name").alias("task_name"),
        F.col("shardIndex").alias("shard_idx"),
        F.col("executionStatus").alias("status"),
        "attempt",
        F.struct("cpu", "disk", "mem").alias("instance"),
        "stats",
        "series",
        F.coalesce("input_file_sizes", F.create_map().cast("map<string,array<bigint>>")).alias("input_file_sizes"),
    )


def size_pairs(input_file_sizes: Column) -> Column:
    """Flat array ``[var, size, var[0], size, ...]`` of a record's input sizes."""
    return F.flatten(
        F.flatten(
            F.transform(
                F.map_entries(input_file_sizes),
                lambda e: F.transform(
                    e["value"],
                    lambda s, i: F.array(
                        F.when(F.size(e["value"]) == 1, e["key"]).otherwise(F.format_string("%s[%d]", e["key"], i)),
                        s.cast("string"),
                    ),
                ),
            )
        )
    )
