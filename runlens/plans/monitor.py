"""Monitoring statistics, input sizes and resource regression."""

from __future__ import annotations

from pyspark.sql import functions as F

from runlens.operators import calls as C, monitor as M, regress as G
from runlens.plans import relations as R
from runlens.plans.calls import _calls, _dotted
from runlens.session import shared_place, stage
from runlens.sources import readers, sinks

TARGETS = ("stats.max.mem", "stats.mean.cpu_pct")
RULES = {"main.a*": ["fastqs", "ref"], "main.*": [], "*.prep": ["fastqs"]}
DIGITS = 6


def _r(col, digits=DIGITS):
    return F.round(col, digits).alias(col)


def _significant(name, digits=6):
    """Value as text with a number of significant digits: fitted numbers differ widely in magnitude."""
    value = F.when(F.abs(F.col(name)) < 1e-12, 0.0).otherwise(F.col(name))
    return F.when(value.isNotNull(), F.format_string(f"%.{digits - 1}e", value)).alias(name)


def _significant_sql(expr: str, name: str, digits: int = 6) -> str:
    value = f"CAST(CASE WHEN abs({expr}) < 1e-12 THEN 0.0 ELSE ({expr}) END AS DOUBLE)"
    return f"printf('%.{digits - 1}e', {value}) AS {name}"


def monitor_stats(spark, sf_dir):
    stats = M.resource_stats(R.series(spark, sf_dir))
    return stats.select("log", "col", "n_rows", _r("mean"), _r("std"), _r("max"), _r("min"))


def monitor_last(spark, sf_dir):
    return M.resource_stats(R.series(spark, sf_dir), ["last"]).select("log", "col", "last")


def monitor_more_stats(spark, sf_dir):
    stats = M.resource_stats(R.series(spark, sf_dir), ["sum", "count", "var", "sem", "skew", "kurt"])
    return stats.select(
        "log", "col", _significant("sum"), "count", _significant("var"), _significant("sem"), _r("skew", 4), _r("kurt", 4)
    )


def monitor_median(spark, sf_dir):
    return M.series_quantile(R.series(spark, sf_dir)).select("log", "col", _r("quantile"))


def monitor_quantiles(spark, sf_dir):
    stats = M.resource_stats(R.series(spark, sf_dir), ["max", "quantile(0.05)", "median", "quantile(0.99)"])
    return stats.select("log", "col", _r("max"), F.round("`quantile(0.05)`", DIGITS).alias("q05"), _r("median"), F.round("`quantile(0.99)`", DIGITS).alias("q99"))


def monitor_scan(spark, sf_dir):
    """Logs as text, one per event, with 0 to 3 samples; the text is split and typed again."""
    e = F.col("event_id")
    sample = F.transform(
        F.sequence(F.lit(0), e % 4),
        lambda i: F.when(i == 0, F.lit("time\tmem\tcpu_pct")).otherwise(
            F.concat_ws("\t", (e + i).cast("string"), (e * i).cast("string"), F.col("value").cast("string"))
        ),
    )
    files = R.table(spark, sf_dir, "events").select(
        F.concat(F.lit("log"), e.cast("string")).alias("path"),
        F.concat(F.array_join(sample, "\n"), F.lit("\n")).alias("text"),
    )
    stats = M.resource_stats(readers.monitor_long(files), ["max", "last", "std"])
    return stats.select("log", "col", "n_rows", _r("max"), _r("last"), _r("std"))


def _monitored(spark, sf_dir):
    stats = M.resource_stats(R.series(spark, sf_dir), ["mean", "max"])
    return M.with_monitor_log(_calls(spark, sf_dir, ["monitoringLog"]), stats), stats


def _sized(spark, sf_dir):
    calls = _calls(spark, sf_dir, ("monitoringLog", "inputs")).where("monitoringLog IS NOT NULL")
    leaves = M.file_leaves(M.input_leaves(calls, ["id", "ord", "call_name", "monitoringLog"]))
    return M.attach_sizes(leaves, R.catalog(spark, sf_dir))


def with_monitor_log(spark, sf_dir):
    calls, _ = _monitored(spark, sf_dir)
    return calls.select("id", "call_name", _dotted("ord").alias("ord"), "monitoringLog")


def input_sizes(spark, sf_dir):
    sized, _ = _sized(spark, sf_dir)
    maps = M.input_sizes(sized, ["id", "ord"])
    pairs = F.transform(
        F.map_entries("input_file_sizes"),
        lambda e: F.concat(e["key"], F.lit("="), F.array_join(F.transform(e["value"], lambda s: s.cast("string")), "+")),
    )
    return maps.select("id", _dotted("ord").alias("ord"), F.array_join(pairs, ";").alias("sizes"))


def missing_files(spark, sf_dir):
    _, missing = _sized(spark, sf_dir)
    return missing.groupBy("var").agg(F.count("*").alias("n"), F.countDistinct("value").alias("files"))


def instance_shape_all(spark, sf_dir):
    """Every call, those of sub-workflows too."""
    return M.instance(_calls(spark, sf_dir, ["runtimeAttributes"])).select("id", _dotted("ord").alias("ord"), "cpu", "disk", "mem")


def record_metrics_all(spark, sf_dir):
    """Every call, those of sub-workflows too."""
    calls = M.instance(_calls(spark, sf_dir, ("shardIndex", "attempt", "runtimeAttributes"))).withColumn("ord", _dotted("ord"))
    return M.record_metrics(calls, ["id", "ord"]).where("val IS NOT NULL")


SERIES = ("mem", "disk", "cpu_pct")


def ragged_tsv(spark, sf_dir):
    """All series and statistics; numbers that are no integers are compared to ten digits."""
    members = ("executionStatus", "shardIndex", "attempt", "monitoringLog", "runtimeAttributes", "inputs")
    records = M.monitor_records(_calls(spark, sf_dir, members), R.series(spark, sf_dir), R.catalog(spark, sf_dir))
    _, lines = sinks.monitor_lines(records, SERIES, ["id", "ord"])
    near = lambda c: F.when(c.rlike(r"^-?[0-9]+\.[0-9]+$|e[+-][0-9]+$"), F.format_string("%.9e", c.try_cast("double"))).otherwise(c)
    return lines.select("id", _dotted("ord").alias("ord"), F.array_join(F.transform(F.split("line", "\t"), near), "\t").alias("line"))


def _fit_tables(spark, sf_dir):
    """File sizes and metrics per monitored call."""
    series = R.series(spark, sf_dir)
    stats = M.resource_stats(series, ["mean", "max"])
    calls = _calls(spark, sf_dir, ("monitoringLog", "inputs")).where(F.col("monitoringLog").startswith("gs://")).select(
        F.concat_ws("/", "id", _dotted("ord")).alias("call_id"), F.col("call_name").alias("task_name"), "monitoringLog", "inputs"
    )
    monitored = stage(M.attach_metrics(calls, stats).select("call_id", "task_name", "inputs", "metrics"))
    targets = monitored.select("call_id", "task_name", F.inline("metrics"))
    leaves = M.file_leaves(M.input_leaves(monitored, ["call_id", "task_name"]))
    sized, _ = M.attach_sizes(leaves, R.catalog(spark, sf_dir))
    return sized.select("call_id", "task_name", "var", "size"), targets


def _fit(reduce, rules=None):
    def query(spark, sf_dir):
        sized, targets = _fit_tables(spark, sf_dir)
        fits = G.analyze(sized, targets, rules, reduce, TARGETS)
        return fits.select("task", "metric", "x_name", "n", _significant("slope"), _significant("intercept"), "reason")

    return query


def ols_points(spark, sf_dir):
    sized, targets = _fit_tables(spark, sf_dir)
    points = G.fit_points(sized, targets, None, "sum", TARGETS)
    return points.select("task", "metric", "call_id", "x", _significant("y"), _significant("y_fit", 5))


def ols_multi(spark, sf_dir):
    sized, targets = _fit_tables(spark, sf_dir)
    fits = G.analyze_multi(sized, targets, {"main.*": ["fastqs", "ref"]}, TARGETS)
    named = fits.select("task", "metric", "n", "intercept", F.get("coeffs", F.lit(0)).alias("b_fastqs"), F.get("coeffs", F.lit(1)).alias("b_ref"))
    return named.select("task", "metric", "n", _significant("b_fastqs"), _significant("b_ref"), _significant("intercept"))


def rule_table(spark, sf_dir):
    """The rules of RULES and others that match no task, as many rows as there are parts."""
    k = F.col("p_partkey") % 4
    rules = list(RULES.items())
    pattern, names = F.concat("p_brand", F.lit("["), F.col("p_partkey").cast("string"), F.lit("]*.prep")), F.array(F.lit("ref"))
    for i, (text, variables) in enumerate(rules):
        pattern = F.when(k == i, text).otherwise(pattern)
        names = F.when(k == i, F.array(*[F.lit(v) for v in variables]).cast("array<string>")).otherwise(names)
    return R.table(spark, sf_dir, "part").select(pattern.alias("pattern"), names.alias("vars"))


def ols_rule_table(spark, sf_dir):
    sized, targets = _fit_tables(spark, sf_dir)
    fits = G.analyze(sized, targets, rule_table(spark, sf_dir), "sum", TARGETS)
    return fits.select("task", "metric", "x_name", "n", _significant("slope"), _significant("intercept"), "reason")


RIDGE = 1e12


def ols_ridge(spark, sf_dir):
    sized, targets = _fit_tables(spark, sf_dir)
    fits = G.analyze_multi(sized, targets, {"main.*": ["fastqs", "ref"]}, TARGETS, solver=G.ridge(RIDGE))
    named = fits.select("task", "metric", "n", "intercept", F.get("coeffs", F.lit(0)).alias("b_fastqs"), F.get("coeffs", F.lit(1)).alias("b_ref"))
    return named.select("task", "metric", "n", _significant("b_fastqs"), _significant("b_ref"), _significant("intercept"))


def analysis_documents(spark, sf_dir):
    """A document per task with all its values, written from sorted rows and read again."""
    sized, targets = _fit_tables(spark, sf_dir)
    rows = stage(G.fit_input(sized, targets, None, TARGETS))
    fits = G.simple_fit(rows.withColumn("x", G.REDUCTIONS["sum"](F.col("xs"))), TARGETS, G._x_name("sum", F.col("vars")))
    place = shared_place(spark, "analysis")
    sinks.write_documents(sinks.analysis_parts(rows, fits, TARGETS, "sum"), place)
    schema = "task string, x map<string,array<double>>, y map<string,array<double>>, coeffs map<string,struct<coeffs:array<double>,intercept:double>>"
    docs = readers.read_files(spark, place).select(F.inline(F.array(F.from_json("text", schema, {"mode": "FAILFAST"}))))
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)
    x = F.get(F.map_values("x"), F.lit(0))
    each = docs.select("task", F.get(F.map_keys("x"), F.lit(0)).alias("x_name"), F.size(x).alias("n_x"), total(x).alias("sum_x"), "coeffs", F.explode("y").alias("metric", "ys"))
    fit = F.try_element_at("coeffs", F.col("metric"))
    told = each.select("task", "x_name", "n_x", "sum_x", "metric", F.size("ys").alias("n"), total(F.col("ys")).alias("sum_y"), F.get(fit["coeffs"], F.lit(0)).alias("slope"), fit["intercept"].alias("intercept"))
    return told.select("task", "x_name", "n_x", _significant("sum_x"), "metric", "n", _significant("sum_y"), _significant("slope"), _significant("intercept"))


def x_cells(spark, sf_dir):
    sized, _ = _fit_tables(spark, sf_dir)
    return G.x_cells(sized)


def found_vars(spark, sf_dir):
    sized, _ = _fit_tables(spark, sf_dir)
    found = G.found_vars(G.variable_maps(sized), RULES)
    return found.select("task", F.array_join("vars", ",").alias("vars"))


def task_scope(spark, sf_dir):
    return G.task_scope(_calls(spark, sf_dir, ()).withColumnRenamed("call_name", "task_name"))


def parse_disk(spark, sf_dir):
    from runlens.functions.sizes import parse_disk as fn

    p = F.col("p_partkey")
    text = F.when(p % 5 == 0, "HDD").when(p % 5 == 1, None).otherwise(
        F.concat(F.lit("local-disk "), F.col("p_size").cast("string"), F.lit(" SSD 7"))
    )
    return R.table(spark, sf_dir, "part").select("p_partkey", fn(text).alias("bytes"))


def parse_size(spark, sf_dir):
    from runlens.functions.sizes import parse_size as fn

    p, n = F.col("p_partkey"), F.col("p_size").cast("string")
    units = [" GB", " GiB", "MB", ".5 kB", "", " bytes", " parsecs x", "k", " mebibytes", " xx"]
    text = F.lit(None).cast("string")
    for i, unit in enumerate(units):
        text = F.when(p % len(units) == i, F.concat(n, F.lit(unit))).otherwise(text)
    return R.table(spark, sf_dir, "part").select("p_partkey", fn(text).alias("bytes"))


QUERIES = {
    "monitor_stats": monitor_stats,
    "monitor_last": monitor_last,
    "monitor_more_stats": monitor_more_stats,
    "monitor_median": monitor_median,
    "monitor_quantiles": monitor_quantiles,
    "monitor_scan": monitor_scan,
    "with_monitor_log": with_monitor_log,
    "input_sizes": input_sizes,
    "missing_files": missing_files,
    "instance_shape": instance_shape_all,
    "record_metrics": record_metrics_all,
    "instance_shape_all": instance_shape_all,
    "record_metrics_all": record_metrics_all,
    "ragged_tsv": ragged_tsv,
    "ols_sum": _fit("sum"),
    "ols_max": _fit("max"),
    "ols_min": _fit("min"),
    "ols_rules": _fit("sum", RULES),
    "ols_multi": ols_multi,
    "analysis_documents": analysis_documents,
    "ols_rule_table": ols_rule_table,
    "ols_ridge": ols_ridge,
    "ols_points": ols_points,
    "x_cells": x_cells,
    "found_vars": found_vars,
    "task_scope": task_scope,
    "parse_disk": parse_disk,
    "parse_size": parse_size,
}

_STATS = f"""
{R.SIZES_SQL},
{R.SERIES_SQL},
stat AS (SELECT log, max(mem) AS mem, avg(cpu_pct) AS cpu FROM sample GROUP BY log),
sums AS (SELECT id, ord, call_name, mon, var, CAST(sum(size) AS DOUBLE) AS size
         FROM sized WHERE mon IN (SELECT log FROM stat) GROUP BY ALL),
monitored AS (SELECT id || '/' || ord AS call_id, * FROM calls WHERE mon IN (SELECT log FROM stat)),
ys AS (
  SELECT call_id, call_name, 'stats.max.mem' AS metric, mem AS y FROM monitored JOIN stat ON log = mon WHERE mem <> 0
  UNION ALL
  SELECT call_id, call_name, 'stats.mean.cpu_pct', cpu FROM monitored JOIN stat ON log = mon WHERE cpu <> 0
)"""


def _fit_sql(reduce: str, rules: str, allowed: str = "TRUE") -> str:
    """Fit over rules ``(task, call_name)`` by the textbook sums."""
    return f"""
{_STATS},
rules AS ({rules}),
found AS (SELECT DISTINCT task, var FROM sums JOIN rules USING (call_name) WHERE {allowed}),
names AS (SELECT task, '{reduce}(' || string_agg(var, ',' ORDER BY var) || ')' AS x_name FROM found GROUP BY task),
xs AS (
  SELECT task, call_id, {reduce}(coalesce(size, 0)) AS x
  FROM monitored JOIN rules USING (call_name) JOIN found USING (task)
       LEFT JOIN sums ON sums.id = monitored.id AND sums.ord = monitored.ord AND sums.var = found.var
  GROUP BY ALL
),
xy AS (SELECT task, metric, call_id, x, y FROM ys JOIN rules USING (call_name) JOIN xs USING (task, call_id)),
centred AS (
  SELECT *, x - avg(x) OVER w AS dx, y - avg(y) OVER w AS dy, avg(x) OVER w AS mx, avg(y) OVER w AS my
  FROM xy WINDOW w AS (PARTITION BY task, metric)
),
fit AS (
  SELECT task, metric, count(*) AS n, max(mx) AS mx, max(my) AS my,
         CASE WHEN sum(dx * dx) = 0 THEN 0 ELSE sum(dx * dy) / sum(dx * dx) END AS slope
  FROM centred GROUP BY ALL
)"""


_BY_NAME = "SELECT DISTINCT call_name AS task, call_name FROM monitored"
_BY_RULE = """SELECT * FROM (VALUES ('main.a*', 'main.align'), ('main.*', 'main.align'), ('main.*', 'main.prep'),
              ('*.prep', 'main.prep')) AS t(task, call_name)"""
_RULE_VARS = "(task = 'main.*' OR (task = 'main.a*' AND var IN ('fastqs', 'ref')) OR (task = '*.prep' AND var = 'fastqs'))"


def _fit_oracle(reduce: str, rules: str = _BY_NAME, allowed: str = "TRUE") -> str:
    return f"""WITH {_fit_sql(reduce, rules, allowed)}
        SELECT task, metric, x_name, n, {_significant_sql('slope', 'slope')},
               {_significant_sql('my - slope * mx', 'intercept')}, CAST(NULL AS VARCHAR) AS reason
        FROM fit JOIN names USING (task)"""


def _rounded(expr: str, name: str, digits: int = DIGITS) -> str:
    return f"round({expr}, {digits}) AS {name}"


def _stat_cell(stat: str, col: str) -> str:
    """Text of a statistic: integers of the integer series, other numbers to ten digits."""
    value = {"mean": f"avg({col})", "std": f"stddev_samp({col})", "last": f"arg_max({col}, row_no)"}.get(stat, f"{stat}({col})")
    if col != "cpu_pct" and stat in M.WHOLE:
        return f"CAST(CAST({value} AS BIGINT) AS VARCHAR)"
    return f"coalesce(printf('%.9e', {value}), 'nan')"


ORACLES = {
    "monitor_stats": f"""
        WITH {R.SERIES_SQL}
        SELECT log, col, count(*) AS n_rows, {_rounded('avg(val)', 'mean')}, {_rounded('stddev_samp(val)', 'std')},
               {_rounded('max(val)', 'max')}, {_rounded('min(val)', 'min')} FROM series GROUP BY log, col""",
    "monitor_last": f"""
        WITH {R.SERIES_SQL}
        SELECT log, col, val AS last FROM series s
        WHERE row_no = (SELECT max(row_no) FROM series t WHERE t.log = s.log)""",
    "monitor_more_stats": f"""
        WITH {R.SERIES_SQL}
        SELECT log, col, {_significant_sql('sum(val)', 'sum')}, CAST(count(*) AS DOUBLE) AS count,
               {_significant_sql('var_samp(val)', 'var')}, {_significant_sql('sem(val) * sqrt(count(*) / (count(*) - 1))', 'sem')},
               {_rounded('skewness(val)', 'skew', 4)}, {_rounded('kurtosis(val)', 'kurt', 4)}
        FROM series GROUP BY log, col""",
    "monitor_median": f"""
        WITH {R.SERIES_SQL}
        SELECT log, col, {_rounded('median(val)', 'quantile')} FROM series GROUP BY log, col""",
    "monitor_quantiles": f"""
        WITH {R.SERIES_SQL}
        SELECT log, col, {_rounded('max(val)', 'max')}, {_rounded('quantile_cont(val, 0.05)', 'q05')}, {_rounded('median(val)', 'median')},
               {_rounded('quantile_cont(val, 0.99)', 'q99')} FROM series GROUP BY log, col""",
    "monitor_scan": """
        WITH s AS (SELECT event_id AS e, value, i FROM events LEFT JOIN UNNEST(range(1, 4)) AS u(i) ON i <= event_id % 4),
        v AS (SELECT e, i, 'mem' AS col, CAST(e * i AS DOUBLE) AS val FROM s
              UNION ALL SELECT e, i, 'cpu_pct', CASE WHEN i IS NOT NULL THEN value END FROM s)
        SELECT 'log' || CAST(e AS VARCHAR) AS log, col, count(i) AS n_rows, round(max(val), 6) AS max,
               round(arg_max(val, i), 6) AS last, round(stddev_samp(val), 6) AS std
        FROM v GROUP BY e, col""",
    "with_monitor_log": f"""
        WITH {R.CALLS_SQL}
        SELECT id, call_name, ord, mon AS "monitoringLog" FROM calls WHERE cust IN (SELECT user_id FROM events) AND mon IS NOT NULL""",
    "input_sizes": f"""
        WITH {R.SIZES_SQL},
        kept AS (SELECT sized.* FROM sized JOIN calls USING (id, ord) WHERE k % 6 <> 2),
        vars AS (SELECT id, ord, var, var || '=' || string_agg(CAST(size AS VARCHAR), '+' ORDER BY idx) AS t FROM kept GROUP BY id, ord, var)
        SELECT id, ord, string_agg(t, ';' ORDER BY var) AS sizes FROM vars GROUP BY id, ord""",
    "missing_files": f"""
        WITH {R.SIZES_SQL}
        SELECT var, count(*) AS n, count(DISTINCT part) AS files FROM named JOIN calls USING (id, ord)
        WHERE k % 6 <> 2 AND part NOT IN (SELECT p_partkey FROM part) GROUP BY var""",
    "instance_shape_all": f"""
        WITH {R.CALLS_SQL}
        SELECT id, ord, CASE WHEN call_name <> 'main.sub' THEN CAST(k % 4 + 1 AS INTEGER) END AS cpu,
               CASE WHEN call_name <> 'main.sub' THEN (k % 90 + 10) * 1073741824 END AS disk,
               CASE WHEN call_name <> 'main.sub' THEN (k % 7 + 1) * CASE WHEN k % 2 = 0 THEN 1000000000 ELSE 1073741824 END END AS mem
        FROM calls""",
    "record_metrics_all": f"""
        WITH {R.CALLS_SQL},
        vals AS (
          SELECT id, ord, 'shard_idx' AS metric, CAST(shard AS DOUBLE) AS val FROM calls
          UNION ALL SELECT id, ord, 'attempt', attempt FROM calls
          UNION ALL SELECT id, ord, 'instance.cpu', k % 4 + 1 FROM calls WHERE call_name <> 'main.sub'
          UNION ALL SELECT id, ord, 'instance.disk', (k % 90 + 10) * 1073741824 FROM calls WHERE call_name <> 'main.sub'
          UNION ALL SELECT id, ord, 'instance.mem', (k % 7 + 1) * CASE WHEN k % 2 = 0 THEN 1000000000 ELSE 1073741824 END
          FROM calls WHERE call_name <> 'main.sub'
        )
        SELECT * FROM vals WHERE val IS NOT NULL""",
    "ragged_tsv": f"""
        WITH {R.SIZES_SQL},
        {R.SERIES_SQL},
        stat AS (SELECT log, concat_ws(chr(9), {', '.join(_stat_cell(s, c) for s in M.DEFAULT_STATS for c in SERIES)}) AS cells FROM sample GROUP BY log),
        counted AS (SELECT *, row_number() OVER (PARTITION BY id, ord, var ORDER BY idx) - 1 AS i,
                           count(*) OVER (PARTITION BY id, ord, var) AS c FROM sized),
        pairs AS (
          SELECT id, ord, string_agg(chr(9) || var || CASE WHEN c > 1 THEN '[' || CAST(i AS VARCHAR) || ']' ELSE '' END || chr(9) ||
                                     CAST(size AS VARCHAR), '' ORDER BY var, i) AS p
          FROM counted GROUP BY id, ord
        )
        SELECT calls.id, calls.ord, concat_ws(chr(9), calls.id, call_name, CAST(shard AS VARCHAR), coalesce(status, 'None'), CAST(attempt AS VARCHAR),
                 CAST(k % 4 + 1 AS VARCHAR), CAST((k % 90 + 10) * 1073741824 AS VARCHAR),
                 CAST((k % 7 + 1) * CASE WHEN k % 2 = 0 THEN 1000000000 ELSE 1073741824 END AS VARCHAR), cells) || coalesce(p, '') AS line
        FROM calls JOIN stat ON stat.log = calls.mon LEFT JOIN pairs ON pairs.id = calls.id AND pairs.ord = calls.ord""",
    "ols_sum": _fit_oracle("sum"),
    "ols_max": _fit_oracle("max"),
    "ols_min": _fit_oracle("min"),
    "ols_rules": _fit_oracle("sum", _BY_RULE, _RULE_VARS),
    "ols_multi": f"""
        WITH {_STATS},
        wide AS (
          SELECT metric, y, coalesce(f.size, 0) AS a, coalesce(r.size, 0) AS b
          FROM ys LEFT JOIN sums f ON f.id || '/' || f.ord = call_id AND f.var = 'fastqs'
                  LEFT JOIN sums r ON r.id || '/' || r.ord = call_id AND r.var = 'ref'
          WHERE ys.call_name LIKE 'main.%'
        ),
        m AS (
          SELECT metric, count(*) AS n, var_pop(a) AS saa, var_pop(b) AS sbb, covar_pop(a, b) AS sab,
                 covar_pop(a, y) AS say, covar_pop(b, y) AS sby, avg(a) AS ma, avg(b) AS mb, avg(y) AS my
          FROM wide GROUP BY metric
        ),
        s AS (SELECT *, (say * sbb - sby * sab) / (saa * sbb - sab * sab) AS ba,
                        (sby * saa - say * sab) / (saa * sbb - sab * sab) AS bb FROM m)
        SELECT 'main.*' AS task, metric, n, {_significant_sql('ba', 'b_fastqs')}, {_significant_sql('bb', 'b_ref')},
               {_significant_sql('my - ba * ma - bb * mb', 'intercept')} FROM s""",
    "ols_ridge": f"""
        WITH {_STATS},
        wide AS (
          SELECT metric, y, coalesce(f.size, 0) AS a, coalesce(r.size, 0) AS b
          FROM ys LEFT JOIN sums f ON f.id || '/' || f.ord = call_id AND f.var = 'fastqs'
                  LEFT JOIN sums r ON r.id || '/' || r.ord = call_id AND r.var = 'ref'
          WHERE ys.call_name LIKE 'main.%'
        ),
        m AS (
          SELECT metric, count(*) AS n, var_pop(a) + {RIDGE} AS saa, var_pop(b) + {RIDGE} AS sbb, covar_pop(a, b) AS sab,
                 covar_pop(a, y) AS say, covar_pop(b, y) AS sby, avg(a) AS ma, avg(b) AS mb, avg(y) AS my
          FROM wide GROUP BY metric
        ),
        s AS (SELECT *, (say * sbb - sby * sab) / (saa * sbb - sab * sab) AS ba,
                        (sby * saa - say * sab) / (saa * sbb - sab * sab) AS bb FROM m)
        SELECT 'main.*' AS task, metric, n, {_significant_sql('ba', 'b_fastqs')}, {_significant_sql('bb', 'b_ref')},
               {_significant_sql('my - ba * ma - bb * mb', 'intercept')} FROM s""",
    "ols_rule_table": _fit_oracle("sum", _BY_RULE, _RULE_VARS),
    "analysis_documents": f"""
        WITH {_fit_sql('sum', _BY_NAME)},
        x AS (SELECT task, count(*) AS n_x, sum(x) AS sum_x FROM (SELECT DISTINCT task, call_id, x FROM xy) GROUP BY task),
        y AS (SELECT task, metric, sum(y) AS sum_y FROM xy GROUP BY ALL)
        SELECT task, x_name, CAST(n_x AS INTEGER) AS n_x, {_significant_sql('sum_x', 'sum_x')}, metric, CAST(n AS INTEGER) AS n, {_significant_sql('sum_y', 'sum_y')},
               {_significant_sql('slope', 'slope')}, {_significant_sql('my - slope * mx', 'intercept')}
        FROM fit JOIN names USING (task) JOIN x USING (task) JOIN y USING (task, metric)""",
    "ols_points": f"""
        WITH {_fit_sql('sum', _BY_NAME)}
        SELECT task, metric, call_id, x, {_significant_sql('y', 'y')}, {_significant_sql('my - slope * mx + slope * x', 'y_fit', 5)}
        FROM xy JOIN fit USING (task, metric)""",
    "x_cells": f"""
        WITH {_STATS},
        has AS (SELECT DISTINCT id, ord, call_name FROM sums), found AS (SELECT DISTINCT call_name, var FROM sums)
        SELECT call_name AS task, has.id || '/' || has.ord AS call_id, found.var, coalesce(size, 0) AS x
        FROM has JOIN found USING (call_name)
             LEFT JOIN sums ON sums.id = has.id AND sums.ord = has.ord AND sums.var = found.var""",
    "found_vars": f"""
        WITH {_fit_sql('sum', _BY_RULE, _RULE_VARS)}
        SELECT task, string_agg(var, ',' ORDER BY var) AS vars FROM found GROUP BY task""",
    "task_scope": f"WITH {R.CALLS_SQL} SELECT DISTINCT call_name AS task FROM calls",
    "parse_disk": """
        SELECT p_partkey, CASE WHEN p_partkey % 5 > 1 THEN CAST(p_size AS BIGINT) * 1073741824 END AS bytes FROM part""",
    "parse_size": """
        SELECT p_partkey, CAST(CASE p_partkey % 10 WHEN 0 THEN p_size * 1e9 WHEN 1 THEN p_size * 1073741824.0 WHEN 2 THEN p_size * 1e6
               WHEN 3 THEN p_size * 1e3 + 500 WHEN 4 THEN p_size WHEN 5 THEN p_size WHEN 6 THEN p_size * 1e15 WHEN 7 THEN p_size * 1e3
               WHEN 8 THEN p_size * 1048576.0 END AS BIGINT) AS bytes
        FROM part""",
}
# every call, under the names that these two had first
ORACLES |= {name: ORACLES[f"{name}_all"] for name in ("instance_shape", "record_metrics")}
