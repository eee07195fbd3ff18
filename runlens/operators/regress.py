"""Resource regression: resource use of a task as a linear function of its input sizes.

Fits are aggregations of co-moments, which combine map-side: a task that holds most of
the calls costs no more than any other. Only one small row per (task, metric) ever
reaches a solver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from runlens.functions.ids import glob_regex, wildcard_match
from runlens.session import stage

DEFAULT_TARGETS = ("stats.max.mem", "stats.max.disk")

# Reduction of a call's per-variable size sums to one number.
REDUCTIONS = {
    "sum": lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x),
    "max": lambda xs: F.array_max(xs),
    "min": lambda xs: F.array_min(xs),
}
NO_INPUTS, LENGTH_MISMATCH, NOT_A_NUMBER, NOT_SOLVED = "no_inputs", "length_mismatch", "not_a_number", "not_solved"

#: Rules ``{task pattern: input variables}``, as a dictionary or as a table ``(pattern, vars)``; no variables means all.
Rules = dict[str, Sequence[str]] | DataFrame | None


def register_reduction(name: str, build: Callable[[Column], Column]) -> None:
    """Add a named reduction: ``build(array_of_sizes)`` gives a number; ``reduce=name`` then uses it."""
    REDUCTIONS[name] = build


def task_scope(records: DataFrame, col: str = "task_name") -> DataFrame:
    """Distinct task names: what is analysed when no rules are given."""
    return records.select(F.col(col).alias("task")).distinct()


def match_rules(df: DataFrame, rules: Rules, col: str = "task_name") -> DataFrame:
    """Add ``task``: one row per rule pattern that a record's task name matches.

    A dictionary's rules are a few literals, so matching is an expression and needs no join; a table's
    are found by :func:`rule_matches`. Without rules every task is matched by its own name.
    """
    if isinstance(rules, DataFrame):
        return df.join(rule_matches(df.select(col).distinct(), rules, col).drop("rule_vars"), col)
    if not rules:
        return df.withColumn("task", F.col(col))
    hits = [F.when(wildcard_match(F.col(col), p), F.lit(p)) for p in rules]
    return df.withColumn("task", F.explode(F.array_compact(F.array(*hits))))


# a wildcard of a pattern; a bracket without an end is an ordinary character
_WILD = r"(?s)\*|\?|\[!?+.[^\]]*\]"


@F.pandas_udf(T.StringType())
def _regex(patterns: pd.Series) -> pd.Series:
    return patterns.map(glob_regex)


def rule_matches(names: DataFrame, rules: DataFrame, col: str = "task_name") -> DataFrame:
    """``(name, task, rule_vars)``: the patterns of a rule table that each distinct name matches.

    A pattern is indexed by its longest text without wildcards and where that stands: whole name, start, end or
    anywhere. A name is looked up by its own starts, ends and substrings of the lengths that occur, joined
    on equality; what is found is then matched in full. A pattern given twice has the variables of
    both rows, and all if one row has none.
    """
    given = rules.where("pattern IS NOT NULL").select("pattern", F.coalesce("vars", F.array().cast("array<string>")).alias("vars"))
    one = given.groupBy("pattern").agg(F.flatten(F.collect_set("vars")).alias("some"), F.min(F.size("vars")).alias("least"))
    texts = F.split("pattern", _WILD)
    placed = F.transform(texts, lambda t, i: F.struct(F.length(t).alias("n"), F.when(F.size(texts) == 1, "=").when(i == 0, "^").when(i == F.size(texts) - 1, "$").otherwise("~").alias("where"), t.alias("text")))
    best = F.array_max(placed)
    index = one.select(
        F.col("pattern").alias("task"),
        F.when(F.col("least") > 0, F.array_sort(F.array_distinct("some"))).otherwise(F.array().cast("array<string>")).alias("rule_vars"),
        _regex("pattern").alias("_regex"),
        F.when(best["n"] == 0, "*").otherwise(best["where"]).alias("_where"),
        best["text"].alias("_text"),
        best["n"].alias("_n"),
    )
    index = stage(index)  # read for its lengths, then joined
    lengths = index.agg(*[F.collect_set(F.when(F.col("_where") == w, F.col("_n"))).alias(n) for w, n in (("^", "starts"), ("$", "ends"), ("~", "inner"))])
    of = lambda kind: lengths.select(kind).scalar()
    name = F.col(col)
    key = lambda where, text: F.struct(F.lit(where).alias("_where"), text.alias("_text"))
    fitting = lambda ns: F.filter(ns, lambda n: n <= F.length(name))
    whole = F.array(key("=", name), key("*", F.lit("")))
    starts = F.transform(fitting(F.col("_starts")), lambda n: key("^", name.substr(F.lit(1), n)))
    ends = F.transform(fitting(F.col("_ends")), lambda n: key("$", name.substr(F.length(name) - n + 1, n)))
    inner = F.flatten(
        F.transform(fitting(F.col("_inner")), lambda n: F.transform(F.sequence(F.lit(1), F.length(name) - n + 1), lambda i: key("~", name.substr(i, n))))
    )
    sides = names.where(name.isNotNull()).withColumns({"_starts": of("starts"), "_ends": of("ends"), "_inner": of("inner")})
    looked = sides.select(col, F.inline(F.array_distinct(F.concat(whole, starts, ends, inner))))
    return looked.join(index, ["_where", "_text"]).where(F.expr(f"`{col}` RLIKE _regex")).select(col, "task", "rule_vars")


def _allowed(rules: dict[str, Sequence[str]] | None, task: Column, var: Column) -> Column:
    """Whether a rule uses the variable; a rule without variables uses all."""
    ok = F.lit(True)
    for pattern, names in (rules or {}).items():
        if names:
            ok = ok & ((task != pattern) | var.isin(*names))
    return ok


def variable_sums(sized: DataFrame, key: str = "call_id") -> DataFrame:
    """``(call, task_name, var, size)``: total bytes per input variable of a call."""
    return sized.groupBy(key, "task_name", "var").agg(F.sum("size").cast("double").alias("size"))


def variable_maps(sized: DataFrame, key: str = "call_id") -> DataFrame:
    """``(call, task_name, sizes MAP<var, total>)``; one entry per input variable of the task.

    Two steps keep a call with very many files out of one task: files are summed
    map-side before a call's variables are put together.
    """
    sums = variable_sums(sized.where(F.col(key).isNotNull()), key)
    return sums.groupBy(key, "task_name").agg(
        F.map_from_entries(F.collect_list(F.struct("var", "size"))).alias("sizes")
    )


def found_vars(maps: DataFrame, rules: Rules = None) -> DataFrame:
    """``(task, vars)``: sorted file variables seen in any matched call."""
    seen = maps.select("task_name", F.explode(F.map_keys("sizes")).alias("var")).distinct()
    if isinstance(rules, DataFrame):
        pairs = seen.join(rule_matches(seen.select("task_name").distinct(), rules), "task_name")
        used = pairs.where((F.size("rule_vars") == 0) | F.array_contains("rule_vars", F.col("var")))
        return used.groupBy("task").agg(F.array_sort(F.collect_set("var")).alias("vars"))
    names = match_rules(seen, rules)
    return (
        names.where(_allowed(rules, F.col("task"), F.col("var")))
        .groupBy("task")
        .agg(F.array_sort(F.collect_set("var")).alias("vars"))
    )


def fit_input(
    sized: DataFrame,
    targets: DataFrame,
    rules: Rules = None,
    metrics: Sequence[str] = DEFAULT_TARGETS,
    key: str = "call_id",
) -> DataFrame:
    """One row per (task pattern, call): ``vars``, ``xs`` (aligned sizes) and a column per metric.

    ``sized`` is ``(call, task_name, var, size)`` per file, ``targets`` is ``(call,
    task_name, metric, val)``. A call counts once it has any wanted metric that is
    neither NULL nor zero; a variable it lacks is 0.
    """
    wanted = targets.where(F.col("metric").isin(*metrics) & F.col("val").isNotNull() & (F.col("val") != 0))
    values = [F.max(F.when(F.col("metric") == m, F.col("val"))).alias(f"y{i}") for i, m in enumerate(metrics)]
    ys = wanted.groupBy(key, "task_name").agg(*values)
    xs = stage(variable_maps(sized, key))  # read for its names, then joined; made from whole input documents
    calls = match_rules(ys.join(xs.drop("task_name"), key, "left"), rules)
    return calls.join(found_vars(xs, rules), "task", "left").select(
        "task",
        key,
        F.coalesce("vars", F.array().cast("array<string>")).alias("vars"),
        F.coalesce(
            F.transform("vars", lambda v: F.coalesce(F.try_element_at("sizes", v), F.lit(0.0))),
            F.array().cast("array<double>"),
        ).alias("xs"),
        *[f"y{i}" for i in range(len(metrics))],
    )


def x_cells(sized: DataFrame, rules: Rules = None, key: str = "call_id") -> DataFrame:
    """``(task, call, var, x)``: the size matrix in long form, absent variables as 0."""
    maps = stage(variable_maps(sized, key))
    rows = match_rules(maps, rules).join(found_vars(maps, rules), "task")
    rows = rows.select("task", key, "sizes", F.explode("vars").alias("var"))
    return rows.select("task", key, "var", F.coalesce(F.try_element_at("sizes", F.col("var")), F.lit(0.0)).alias("x"))


def _x_name(reduce: str, names: Column) -> Column:
    return F.concat(F.lit(f"{reduce}("), F.array_join(names, ","), F.lit(")"))


def _reason(n_vars: Column, n_x: Column, n_y: Column, has_nan: Column, pairwise: bool) -> Column:
    reason = F.when(n_vars == 0, NO_INPUTS)
    if not pairwise:
        reason = reason.when(n_y != n_x, LENGTH_MISMATCH)
    return reason.when(has_nan, NOT_A_NUMBER)


def analyze(
    sized: DataFrame,
    targets: DataFrame,
    rules: Rules = None,
    reduce: str = "sum",
    metrics: Sequence[str] = DEFAULT_TARGETS,
    pairwise: bool = False,
    key: str = "call_id",
) -> DataFrame:
    """Simple fit per (task pattern, metric): ``task, metric, x_name, n, slope, intercept, reason``.

    A metric that some counted call lacks has no coefficients (``length_mismatch``),
    unless ``pairwise`` fits the complete pairs. A constant x gives slope 0.
    """
    rows = fit_input(sized, targets, rules, metrics, key).withColumn("x", REDUCTIONS[reduce](F.col("xs")))
    return simple_fit(rows, metrics, _x_name(reduce, F.col("vars")), pairwise)


def simple_fit(rows: DataFrame, metrics: Sequence[str], x_name: Column, pairwise: bool = False) -> DataFrame:
    aggregates = [F.count("*").alias("n_x"), F.max("vars").alias("vars")]
    for i in range(len(metrics)):
        y = F.col(f"y{i}")
        x = F.when(y.isNotNull(), F.col("x"))
        aggregates += [
            F.count(y).alias(f"n{i}"),
            F.coalesce(F.max(F.isnan(y)), F.lit(False)).alias(f"nan{i}"),
            F.var_pop(x).alias(f"vx{i}"),
            F.covar_pop(y, x).alias(f"cxy{i}"),
            F.avg(x).alias(f"mx{i}"),
            F.avg(y).alias(f"my{i}"),
        ]
    parts = [
        F.struct(
            F.lit(m).alias("metric"),
            *[F.col(f"{c}{i}").alias(c) for c in ("n", "nan", "vx", "cxy", "mx", "my")],
        )
        for i, m in enumerate(metrics)
    ]
    fits = rows.groupBy("task").agg(*aggregates).select("task", "n_x", "vars", F.inline(F.array(*parts)))
    fits = fits.where("n > 0")
    reason = _reason(F.size("vars"), F.col("n_x"), F.col("n"), F.col("nan"), pairwise)
    slope = F.when(F.col("vx") == 0, F.lit(0.0)).otherwise(F.col("cxy") / F.col("vx"))
    return (
        fits.withColumns({"reason": reason, "_slope": slope})
        .withColumn("slope", F.when(F.col("reason").isNull(), F.col("_slope")))
        .select(
            "task",
            "metric",
            x_name.alias("x_name"),
            "n",
            "slope",
            (F.col("my") - F.col("slope") * F.col("mx")).alias("intercept"),
            "reason",
        )
    )


def fit_points(
    sized: DataFrame,
    targets: DataFrame,
    rules: Rules = None,
    reduce: str = "sum",
    metrics: Sequence[str] = DEFAULT_TARGETS,
    key: str = "call_id",
) -> DataFrame:
    """Scatter points with the fitted value: ``task, metric, call, x, y, y_fit``."""
    rows = fit_input(sized, targets, rules, metrics, key).withColumn("x", REDUCTIONS[reduce](F.col("xs")))
    fits = simple_fit(rows, metrics, _x_name(reduce, F.col("vars"))).select("task", "metric", "slope", "intercept")
    pairs = [F.struct(F.lit(m).alias("metric"), F.col(f"y{i}").alias("y")) for i, m in enumerate(metrics)]
    points = rows.select("task", key, "x", F.inline(F.array(*pairs)))
    joined = points.where("y IS NOT NULL").join(fits, ["task", "metric"])
    return joined.select("task", "metric", key, "x", "y", (F.col("slope") * F.col("x") + F.col("intercept")).alias("y_fit"))


_SOLUTION = "task string, metric string, vars array<string>, n bigint, coeffs array<double>, intercept double, reason string"


class Moments(NamedTuple):
    """What a fit is made from: means and co-moments (over n) of k variables and the resource."""

    n: int
    names: list[str]
    mean: np.ndarray
    mean_y: float
    cov: np.ndarray
    cov_y: np.ndarray
    var_y: float


#: From the moments of a fit to coefficients and intercept; None where there is no solution.
Solver = Callable[[Moments], tuple[Sequence[float], float] | None]


def least_squares(m: Moments) -> tuple[Sequence[float], float]:
    """Minimum-norm least squares."""
    # one scale for all variables: scaling them apart would change the minimum norm
    scale = np.sqrt(m.cov.diagonal().max(initial=0.0)) or 1.0
    inverse = np.linalg.pinv(m.cov / scale**2, rcond=1e-10, hermitian=True)
    beta = inverse @ (m.cov_y / scale) / scale
    return beta.tolist(), float(m.mean_y - beta @ m.mean)


def ridge(penalty: float) -> Solver:
    """Least squares with ``penalty`` times the squared coefficients added to the mean squared error."""

    def solve(m: Moments) -> tuple[Sequence[float], float]:
        beta = np.linalg.solve(m.cov + penalty * np.eye(len(m.names)), m.cov_y)
        return beta.tolist(), float(m.mean_y - beta @ m.mean)

    return solve


def _moments(row) -> Moments:
    k = len(row.vars)
    gram, mean = np.zeros((k + 1, k + 1)), np.zeros(k + 1)
    for cell in row.cells:
        i, j = cell["i"], cell["j"]
        gram[i, j] = gram[j, i] = cell["cov"]
        mean[i], mean[j] = cell["mi"], cell["mj"]
    return Moments(int(row.n), list(row.vars), mean[:k], float(mean[k]), gram[:k, :k], gram[:k, k], float(gram[k, k]))


def _solved_by(solver: Solver):
    def solve(batches):
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                found, reason = (solver(_moments(row)), row.reason) if row.reason is None else (None, row.reason)
                coeffs, intercept = found or (None, None)
                reason = NOT_SOLVED if reason is None and found is None else reason
                out.append((row.task, row.metric, list(row.vars), int(row.n), coeffs, intercept, reason))
            yield pd.DataFrame(out, columns=["task", "metric", "vars", "n", "coeffs", "intercept", "reason"])

    return solve


def analyze_multi(
    sized: DataFrame,
    targets: DataFrame,
    rules: Rules = None,
    metrics: Sequence[str] = DEFAULT_TARGETS,
    pairwise: bool = False,
    key: str = "call_id",
    solver: Solver = least_squares,
) -> DataFrame:
    """Fit with one coefficient per input variable: ``task, metric, vars, n, coeffs, intercept, reason``.

    The co-moments of all variable pairs are one aggregation; ``solver`` gets the aggregated
    row of a fit. One that finds no solution leaves the reason ``not_solved``.
    """
    rows = fit_input(sized, targets, rules, metrics, key)
    return multi_fit(rows, metrics, pairwise, solver)


def multi_fit(rows: DataFrame, metrics: Sequence[str], pairwise: bool = False, solver: Solver = least_squares) -> DataFrame:
    pairs = [F.struct(F.lit(m).alias("metric"), F.col(f"y{i}").alias("y")) for i, m in enumerate(metrics)]
    long = rows.select("task", "vars", "xs", F.inline(F.array(*pairs)))
    counts = (
        long.groupBy("task", "metric")
        .agg(
            F.count("*").alias("n_x"),
            F.count("y").alias("n"),
            F.max("vars").alias("vars"),
            F.coalesce(F.max(F.isnan("y")), F.lit(False)).alias("nan"),
        )
        .where("n > 0")
    )
    k = F.size("xs")
    z = F.concat("xs", F.array("y"))
    cells = F.flatten(
        F.transform(
            F.sequence(F.lit(0), k),
            lambda i: F.transform(F.sequence(i, k), lambda j: F.struct(i.alias("i"), j.alias("j"))),
        )
    )
    products = (
        long.where("y IS NOT NULL")
        .select("task", "metric", z.alias("z"), F.inline(cells))
        .select("task", "metric", "i", "j", F.get("z", F.col("i")).alias("zi"), F.get("z", F.col("j")).alias("zj"))
        .groupBy("task", "metric", "i", "j")
        .agg(F.covar_pop("zi", "zj").alias("cov"), F.avg("zi").alias("mi"), F.avg("zj").alias("mj"))
    )
    # (k+1)(k+2)/2 cells per fit, k being the number of input variables of a task
    grams = products.groupBy("task", "metric").agg(F.collect_list(F.struct("i", "j", "cov", "mi", "mj")).alias("cells"))
    systems = counts.join(grams, ["task", "metric"]).select(
        "task",
        "metric",
        "vars",
        "n",
        "cells",
        _reason(F.size("vars"), F.col("n_x"), F.col("n"), F.col("nan"), pairwise).alias("reason"),
    )
    return systems.mapInPandas(_solved_by(solver), _SOLUTION)
