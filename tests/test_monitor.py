from __future__ import annotations

import fnmatch
import json
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from runlens.functions import numbers
from runlens.operators import calls as C, monitor as M, regress as G
from runlens.sources import readers, sinks

TEXTS = [
    ("gs://l/many", "time\tmem\tcpu_pct\n1\t10\t1.5\n2\t30\t2.5\n\n3\t20\t\n"),
    ("gs://l/one", "time\tmem\tcpu_pct\n1\t10\t1.5\n"),
    ("gs://l/header", "time\tmem\tcpu_pct\n"),
]


def _long(spark):
    return readers.monitor_long(spark.createDataFrame(TEXTS, "path string, text string"))


def test_stats_like_pandas(spark):
    got = {(r.log, r.col): r for r in M.resource_stats(_long(spark)).collect()}
    assert set(got) == {(p, c) for p, _ in TEXTS for c in ("mem", "cpu_pct")}
    many = got["gs://l/many", "mem"]
    assert (many.n_rows, many.mean, many.std, many.max, many.min, many["last"]) == (3, 20, 10, 30, 10, 20)
    assert got["gs://l/many", "cpu_pct"]["last"] is None and got["gs://l/many", "cpu_pct"].mean == 2.0
    assert got["gs://l/one", "mem"].std is None and got["gs://l/one", "mem"].mean == 10
    empty = got["gs://l/header", "mem"]
    assert empty.n_rows == 0 and empty.mean is None and empty["last"] is None


def test_sizes_come_in_document_order(spark):
    inputs = '{"z": {"b": "gs://f/2", "a": ["gs://f/1", {"y": "gs://f/3", "x": {"q": "gs://f/1"}}], "0": "gs://f/2"}, "a": {"only": "gs://f/3"}, "n": null}'
    catalog = spark.createDataFrame([("gs://f/1", 1), ("gs://f/2", 2), ("gs://f/3", 3)], "path string, length bigint")
    calls = spark.createDataFrame([("w", inputs), ("v", '{"l": ["gs://f/3", "gs://f/1"]}'), ("e", "{}"), ("none", None)], "id string, inputs string")
    sized, _ = M.attach_sizes(M.file_leaves(M.input_leaves(calls, ["id"])), catalog)
    got = {r.id: r.input_file_sizes for r in M.input_sizes(sized, ["id"]).collect()}
    assert got == {"w": {"a": [3], "z": [2, 1, 3, 1, 2]}, "v": {"l": [3, 1]}} and list(got["w"]) == ["a", "z"]


def test_sizes_are_grouped_within_one_exchange(spark):
    sized = spark.createDataFrame([("w", [i % 3], v, [i], i) for i in range(30) for v in ("b", "a")], "id string, ord array<int>, var string, pos array<int>, size long")
    grouped = M.input_sizes(sized.repartition(4), ["id", "ord"])
    assert {r.ord[0]: r.input_file_sizes for r in grouped.collect()} == {k: {v: [*range(k, 30, 3)] for v in ("a", "b")} for k in range(3)}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = M.input_sizes(sized, ["id", "ord"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 1


def test_inputs_are_walked_in_one_step(spark):
    """Leaves in document order from one generator, however deep; of members with one name the last counts."""
    deep = "[" * 300 + '"gs://f/1"' + "]" * 300
    texts = ['{"z": {"b": "gs://f/2", "a": [1, true, null, 1.50, "\\ud83e\\udd80\\ud800"]}, "a": {}, "": "4"}', '{"a": "gs://f/1", "a": "gs://f/2"}', '{"d": ' + deep + "}", '["gs://f/1", {"x": -2e3}]', "7", None]
    calls = spark.createDataFrame(list(enumerate(texts)), "i int, inputs string")
    leaves = M.input_leaves(calls, ["i"])
    got = [[(r.var, r.pos, r.value) for r in leaves.collect() if r.i == i] for i in range(len(texts))]
    assert got[0] == [("z", [0, 0], "gs://f/2"), ("z", [0, 1, 0], "1"), ("z", [0, 1, 1], "true"), ("z", [0, 1, 3], "1.5"), ("z", [0, 1, 4], "\U0001f980?"), ("", [2], "4")]
    assert got[1:] == [[("a", [0], "gs://f/2")], [("d", [0] * 301, "gs://f/1")], [("0", [0], "gs://f/1"), ("1", [1, 0], "-2000.0")], [(None, [], "7")], []]
    plan = leaves._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate ") == 1 and "variant_explode" not in plan
    with pytest.raises(Exception, match="NaN is no JSON value"):
        M.input_leaves(spark.createDataFrame([('{"a": NaN}',)], "inputs string"), []).collect()


def test_numbers_are_printed_like_python(spark):
    rng = random.Random(1)
    values = [0.0, -0.0, 1.0, -2.5, 30.0, 1e7, 37580963840.0, 1.5e15, 1e16, 1.25e16, 9999999999999998.0, 1e22, 1e100, 1e-3, 1e-4, 1.5e-4, 1e-5, -2.5e-7, 123456789.125, float("nan"), float("inf"), float("-inf")]
    values += [round(rng.uniform(-1, 1) * 10 ** rng.randint(-8, 18), 3) for _ in range(300)] + [rng.uniform(-1, 1) * 10 ** rng.randint(-8, 20) for _ in range(300)]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate([*values, None])], "i int, v double").select("i", numbers.float_text(F.col("v")).alias("t"))
    got = {r.i: r.t for r in rows.collect()}
    assert got[len(values)] is None
    assert all(float(got[i]) == v or v != v for i, v in enumerate(values))
    assert [(repr(v), got[i]) for i, v in enumerate(values) if got[i] != repr(v)] == []
    whole = spark.createDataFrame([(9007199254740992.0, True), (-3.0, True), (-3.0, False), (math.nan, True), (None, True)], "v double, w boolean")
    assert [r.t for r in whole.select(numbers.number_text(F.col("v"), F.col("w")).alias("t")).collect()] == ["9007199254740992", "-3", "-3.0", "nan", None]


def test_table_text(spark):
    texts = [*TEXTS, ("gs://l/mixed", "time\tmem\tcpu_pct\n1\t10000000\t1\n2\t20000000\t2.0\n"), ("gs://l/gap", "time\tmem\tcpu_pct\n1\t5\t\n2\t\t\n")]
    long = readers.monitor_long(spark.createDataFrame(texts, "path string, text string"))
    call = lambda log: {"executionStatus": 'a"b', "shardIndex": -1, "monitoringLog": log, "inputs": {}, "runtimeAttributes": {}}
    doc = {"id": "w\tx", "calls": {"t": [call(f"gs://l/{n}") for n in ("many", "one", "header", "mixed", "gap")]}}
    calls = C.flatten_calls(C.workflow_header(spark.createDataFrame([(json.dumps(doc),)], "doc string")))
    records = M.monitor_records(calls, long, spark.createDataFrame(CATALOG, "path string, length bigint"), stats=["max", "std", "count", "last", "mean"])
    _, lines = sinks.monitor_lines(records, ["mem", "cpu_pct"], ["ord"], ["max", "std", "count", "last", "mean"])
    got = {r.ord[1]: r.line.split("\t") for r in lines.collect()}
    assert ["\t".join(got[0][:2]), got[0][4]] == ['"w\tx"', '"a""b"']
    cells = {k: v[9:] for k, v in got.items()}
    assert cells[0][:8] == ["30", "2.5", "10.0", "0.7071067811865476", "3", "2", "20", "nan"] and cells[0][8:] == ["20.0", "2.0"]
    assert cells[1] == ["10", "1.5", "nan", "nan", "1", "1", "10", "1.5", "10.0", "1.5"]
    assert cells[2] == ["None"] * 4 + ["0", "0"] + ["None"] * 4
    assert cells[3] == ["20000000", "2.0", "7071067.811865475", "0.7071067811865476", "2", "2", "20000000", "2.0", "15000000.0", "1.5"]
    assert cells[4] == ["5.0", "nan", "nan", "nan", "1", "0", "nan", "nan", "5.0", "nan"]


def test_more_stats_and_quantiles(spark):
    rng = random.Random(2)
    rows = [("a", i, 1, "x", rng.choice([rng.gauss(0, 1e6), 5.0])) for i in range(400)] + [("b", 0, 1, "x", 3.0)]
    long = spark.createDataFrame(rows, "log string, row_no int, col_no int, col string, val double")
    series = pd.Series([r[4] for r in rows[:-1]])
    row = M.resource_stats(long, ["sum", "var", "sem", "skew", "kurt", "count"]).where("log = 'a'").first()
    for name in ("sum", "var", "sem", "skew", "kurt", "count"):
        assert row[name] == pytest.approx(getattr(series, name)(), rel=1e-9), name
    for q in (0.0, 0.25, 0.5, 0.9, 1.0):
        got = {r.log: r.quantile for r in M.series_quantile(long, q).collect()}
        assert got == {"a": pytest.approx(series.quantile(q)), "b": 3.0}


def test_quantiles_among_statistics(spark):
    rng = random.Random(3)
    rows = [(f"l{i % 3}", i, c, f"c{c}", rng.choice([rng.random(), 0.5, None, -1e9])) for i in range(300) for c in (1, 2)] + [("void", None, 1, "c1", None), ("null", 0, 1, "c1", None)]
    long = spark.createDataFrame(rows, "log string, row_no int, col_no int, col string, val double")
    names = ["max", "quantile(0.1)", "median", "quantile(1)"]
    for size in (7, 10**6):
        plain = M.resource_stats(long, ["count"])
        got = {(r.log, r.col): list(r.quantiles) for r in M.series_quantiles(long, [0.1, 0.5, 1.0], rows_per_task=size).collect()}
        for key in {(r.log, r.col) for r in plain.collect()} - {("void", "c1"), ("null", "c1")}:
            series = pd.Series([r[4] for r in rows if (r[0], r[3]) == key])
            assert got[key] == pytest.approx([series.quantile(q) for q in (0.1, 0.5, 1.0)]), (size, key)
        assert len(got) == 6
    table = {(r.log, r.col): r for r in M.resource_stats(long, names).collect()}
    assert len(table) == 8 and table["void", "c1"]["quantile(0.1)"] is None and table["l0", "c1"]["quantile(1)"] == table["l0", "c1"]["max"]
    metrics = {r.metric for r in M.stat_metrics(M.resource_stats(long, names)).collect()}
    assert "stats.quantile(0.1).c1" in metrics and M.stats_map(M.resource_stats(long, names)).count() == 5


def test_no_task_ranks_a_whole_series_of_close_values(spark):
    n, size = 1_000_000, 50_000
    values = spark.range(n).select(F.lit("hot").alias("log"), F.col("id").alias("row_no"), F.lit(1).alias("col_no"), F.lit("mem").alias("col"), (1e9 + F.col("id")).alias("val"))
    counts = values.groupBy("log", "col", "val").agg(F.count("*").alias("n"))
    held = [r["count"] for r in M.by_rank(counts, ["log", "col"], "val", size).groupBy("_part").count().collect()]
    assert sum(held) == n and max(held) <= 2 * size
    got = M.series_quantiles(values, [0.25, 0.999], rows_per_task=size).first().quantiles
    assert got == [1e9 + 0.25 * (n - 1), pytest.approx(1e9 + 0.999 * (n - 1))]


def _calls(spark):
    def call(log, cpu="2", **inputs):
        return {
            "executionStatus": "Done", "shardIndex": -1, "attempt": 1, "monitoringLog": log, "inputs": inputs,
            "runtimeAttributes": {"cpu": cpu, "disks": "local-disk 10 HDD", "memory": "4 GB"},
        }

    doc = {
        "id": "w",
        "calls": {
            "t.a": [call("gs://l/many", z="gs://f/2", b=["gs://f/1", {"x": "gs://f/2"}, "gs://f/none", 7, "text"])],
            "t.b": [call("gs://l/header"), call("gs://l/absent"), call("/l/local"), call(None)],
        },
    }
    return C.flatten_calls(C.workflow_header(spark.createDataFrame([(json.dumps(doc),)], "doc string")))


CATALOG = [("gs://f/1", 100), ("gs://f/2", 200)]


def test_records(spark, tmp_path):
    catalog = spark.createDataFrame(CATALOG, "path string, length bigint")
    records = M.monitor_records(_calls(spark), _long(spark), catalog)
    got = {r.task_name: r for r in records.collect()}
    assert set(got) == {"t.a", "t.b"}
    assert got["t.a"].input_file_sizes == {"b": [100, 200], "z": [200]}
    assert got["t.a"].instance.asDict() == {"cpu": 2, "disk": 10 << 30, "mem": 4 * 10**9}
    assert got["t.a"].stats["max"]["mem"] == 30 and got["t.b"].stats["max"]["mem"] is None
    header, lines = sinks.monitor_lines(records, ["mem"], ["id"], ["max"])
    assert header.split("\t")[-2:] == ["stats.max.mem", "input_file_var_size_pairs"]
    texts = sorted(r.line for r in lines.collect())
    assert texts[0].split("\t")[8:] == ["30", "b[0]", "100", "b[1]", "200", "z", "200"]
    assert texts[1].split("\t")[8:] == ["None"]
    sinks.write_monitor_tsv(records, str(tmp_path / "t"), ["mem"], ["max"])
    sinks.write_records_json(records, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    assert header in {r.value for r in spark.read.text(str(tmp_path / "t")).collect()}
    leaves = M.file_leaves(M.input_leaves(_calls(spark), ["id"]))
    _, missing = M.attach_sizes(leaves, catalog)
    assert [r.value for r in missing.collect()] == ["gs://f/none"]
    assert M.with_monitor_log(_calls(spark), _long(spark)).count() == 2


def test_records_keep_what_they_tell(spark, monkeypatch):
    """What is written between the two passes over the calls has no texts that a record doesn't show."""
    from runlens.plans import monitor as plan

    written = []
    monkeypatch.setattr(M, "stage", lambda df: written.append(set(df.columns)) or df)
    monkeypatch.setattr(plan, "_calls", lambda *args, calls=plan._calls: written.append(set(args[2])) or calls(*args))
    lines = plan.ragged_tsv(spark, "/root/testdata/sf0.001")
    assert lines.count() > 0 and len(written) == 2
    assert not {"stdout", "stderr", "callRoot", "executionEvents"} & set.union(*written)


def _fit_tables(spark, calls):
    """``calls``: (call_id, task, {var: [sizes]}, {metric: value})."""
    sized = [(c, t, v, s) for c, t, vars_, _ in calls for v, sizes in vars_.items() for s in sizes]
    targets = [(c, t, m, float(y) if y is not None else None) for c, t, _, ys in calls for m, y in ys.items()]
    return (
        spark.createDataFrame(sized, "call_id string, task_name string, var string, size bigint"),
        spark.createDataFrame(targets, "call_id string, task_name string, metric string, val double"),
    )


X1, X2 = [15643136, 18963919], [16495088, 20184668]
MEM, CPU = (48.91222341236991, 124314029.09791338), (1.6844513715565233e-06, 42.28561239506905)


def _golden_calls():
    out = []
    for i in range(2):
        ys = {"stats.max.mem": MEM[0] * X1[i] + MEM[1], "stats.mean.cpu_pct": CPU[0] * X1[i] + CPU[1], "stats.max.disk": 5}
        out.append((f"a{i}", "atac.align", {"fastqs_R1": [X1[i]], "fastqs_R2": [X2[i]]}, ys))
        out.append((f"m{i}", "atac.align_mito", {"fastqs_R1": [X1[i]], "fastqs_R2": [X2[i]], "idx_tar": [3749246230]}, ys))
        out.append((f"f{i}", "atac.filter", {"bam": [61315022 + i]}, ys))
    return out


def test_regression_goldens(spark):
    sized, targets = _fit_tables(spark, _golden_calls())
    metrics = ("stats.max.mem", "stats.mean.cpu_pct")
    fits = G.analyze_multi(sized, targets, {"atac.align": ["fastqs_R1"]}, metrics)
    got = {r.metric: r for r in fits.collect()}
    assert list(got["stats.max.mem"].vars) == ["fastqs_R1"]
    for metric, (slope, intercept) in (("stats.max.mem", MEM), ("stats.mean.cpu_pct", CPU)):
        assert got[metric].coeffs[0] == pytest.approx(slope, rel=1e-9)
        assert got[metric].intercept == pytest.approx(intercept, rel=1e-9)
    one = G.analyze(sized, targets, {"atac.align": ["fastqs_R2"]}).collect()
    assert {(r.metric, r.x_name, r.n) for r in one} == {("stats.max.mem", "sum(fastqs_R2)", 2), ("stats.max.disk", "sum(fastqs_R2)", 2)}
    points = G.fit_points(sized, targets, {"atac.align": ["fastqs_R2"]}, metrics=("stats.max.mem",)).collect()
    assert sorted(r.x for r in points) == X2
    rules = {"atac.align*": ["fastqs_R1", "fastqs_R2"], "atac.filter*": ["bam"]}
    points = G.fit_points(sized, targets, rules, metrics=("stats.max.mem",)).collect()
    assert sorted(r.x for r in points if r.task == "atac.align*") == [32138224, 32138224, 39148587, 39148587]
    names = {r.task: r.x_name for r in G.analyze(sized, targets, rules).collect()}
    assert names == {"atac.align*": "sum(fastqs_R1,fastqs_R2)", "atac.filter*": "sum(bam)"}
    largest = G.fit_points(sized, targets, {"atac.align*": []}, "max", ("stats.max.mem",)).collect()
    assert sorted(r.x for r in largest) == [16495088, 20184668, 3749246230, 3749246230]
    assert {r.task for r in G.analyze(sized, targets).collect()} == {"atac.align", "atac.align_mito", "atac.filter"}


def test_regression_edge_cases(spark):
    sized, targets = _fit_tables(
        spark,
        [
            ("1", "one", {"v": [5]}, {"stats.max.mem": 7}),
            ("2", "constant", {"v": [5]}, {"stats.max.mem": 7}),
            ("3", "constant", {"v": [5]}, {"stats.max.mem": 9}),
            ("4", "short", {"v": [1]}, {"stats.max.mem": 1, "stats.max.disk": 1}),
            ("5", "short", {"v": [2]}, {"stats.max.mem": 2, "stats.max.disk": 0}),
            ("6", "nan", {"v": [1]}, {"stats.max.mem": math.nan}),
            ("7", "nan", {"v": [2]}, {"stats.max.mem": 1}),
            ("8", "bare", {}, {"stats.max.mem": 1}),
            ("9", "nothing", {"v": [1]}, {"stats.max.mem": 0, "stats.max.disk": None}),
            ("10", "min", {"v": [4], "w": [3]}, {"stats.max.mem": 1}),
            ("11", "min", {"v": [8]}, {"stats.max.mem": 2}),
        ],
    )
    got = {(r.task, r.metric): r for r in G.analyze(sized, targets).collect()}
    mem = {t: (r.slope, r.intercept, r.reason) for (t, m), r in got.items() if m == "stats.max.mem"}
    assert mem["one"] == (0, 7, None) and mem["constant"] == (0, 8, None) and mem["short"] == (1, 0, None)
    assert mem["nan"] == (None, None, "not_a_number") and mem["bare"] == (None, None, "no_inputs")
    assert got["short", "stats.max.disk"].reason == "length_mismatch" and "nothing" not in mem
    paired = {(r.task, r.metric): r for r in G.analyze(sized, targets, pairwise=True).collect()}
    assert paired["short", "stats.max.disk"].slope == 0 and paired["short", "stats.max.disk"].intercept == 1
    least = {r.call_id: r.x for r in G.fit_points(sized, targets, {"min": []}, "min").collect()}
    assert least == {"10": 3, "11": 0}
    multi = {(r.task, r.metric): r for r in G.analyze_multi(sized, targets).collect()}
    assert multi["one", "stats.max.mem"].coeffs == [0.0] and multi["bare", "stats.max.mem"].reason == "no_inputs"


def test_multiple_regression_is_least_squares(spark):
    rng = np.random.default_rng(4)
    for n, k in ((30, 3), (2, 3)):
        x = rng.integers(10**6, 10**10, (n, k))
        y = x @ rng.random(k) + 1e9
        calls = [(str(i), "t", {f"v{j}": [int(x[i, j])] for j in range(k)}, {"m": y[i]}) for i in range(n)]
        row = G.analyze_multi(*_fit_tables(spark, calls), None, ("m",)).first()
        want, *_ = np.linalg.lstsq(x - x.mean(0), y - y.mean(), rcond=None)
        assert row.coeffs == pytest.approx(want, rel=1e-6)
        assert row.intercept == pytest.approx(y.mean() - x.mean(0) @ want, rel=1e-6)


def test_a_task_with_most_calls_is_fitted_exactly(spark):
    rng = random.Random(9)
    calls = [(str(i), "hot" if i % 3 else f"t{i % 30}", {"v": [rng.randint(1, 10**9)], "w": [1]}, {"m": rng.random() + 1}) for i in range(600)]
    fits = G.analyze(*_fit_tables(spark, calls), None, "sum", ("m",)).collect()
    for fit in fits:
        xs = [sum(map(sum, c[2].values())) for c in calls if c[1] == fit.task]
        ys = [c[3]["m"] for c in calls if c[1] == fit.task]
        slope, intercept = np.polyfit(xs, ys, 1)
        assert fit.n == len(xs) and fit.intercept == pytest.approx(intercept, rel=1e-6)
        assert fit.slope == pytest.approx(slope, rel=1e-6, abs=1e-15)


def test_analysis_json(spark, tmp_path):
    sized, targets = _fit_tables(spark, _golden_calls())
    fits = G.analyze(sized, targets, {"atac.align": ["fastqs_R1"]}, metrics=("stats.max.mem",))
    points = G.fit_points(sized, targets, {"atac.align": ["fastqs_R1"]}, metrics=("stats.max.mem",))
    sinks.write_analysis_json(fits, points, str(tmp_path / "a"))
    doc = json.loads(spark.read.text(str(tmp_path / "a" / "coeffs")).first().value)
    assert doc["task"] == "atac.align" and doc["x"] == "sum(fastqs_R1)"
    assert doc["coeffs"]["stats.max.mem"]["coeffs"][0] == pytest.approx(MEM[0])
    assert spark.read.json(str(tmp_path / "a" / "points")).count() == 2


def test_documents_are_written_from_sorted_rows(spark, tmp_path):
    rng = random.Random(4)
    rows = [("a/x.json", [1, i], f"{i:05d}", f"{i}", True) for i in range(3000)] + [("a/x.json", [0], "", "[", False), ("a/x.json", [2], "", "]", False), ("b.txt", [0], "", None, False)]
    rows = [("a/x.json", [1], f"{i:05d}", f"{i}", True) if r[1][0] == 1 else r for i, r in enumerate(rows)]
    rng.shuffle(rows)
    schema = "path string, section array<int>, ord string, text string, listed boolean"
    parts = spark.createDataFrame(rows, schema).repartition(7)
    for _ in range(2):
        made = {r.path: (r.n_rows, r.n_bytes) for r in sinks.write_documents(parts, str(tmp_path / "d")).collect()}
    assert json.loads((tmp_path / "d" / "a" / "x.json").read_text()) == list(range(3000))
    assert made == {"a/x.json": (3002, (tmp_path / "d" / "a" / "x.json").stat().st_size), "b.txt": (1, 0)}
    assert sorted(p.name for p in (tmp_path / "d").rglob("*") if p.is_file() and not p.name.endswith(".crc")) == ["b.txt", "x.json"]
    assert sinks.write_documents(parts.limit(0), str(tmp_path / "e")).count() == 0


def test_a_document_of_very_many_parts(spark, tmp_path):
    n = 1_000_000
    rows = spark.range(n).select(F.lit("big.json").alias("path"), F.lit(1).alias("section"), F.col("id").alias("ord"), F.col("id").cast("string").alias("text"), F.lit(True).alias("listed"))
    frame = spark.createDataFrame([("big.json", 0, 0, "[", False), ("big.json", 2, 0, "]", False)], "path string, section int, ord long, text string, listed boolean")
    sinks.write_documents(rows.unionByName(frame), str(tmp_path), ",")
    assert json.loads((tmp_path / "big.json").read_text()) == list(range(n))


def test_analysis_documents(spark, tmp_path):
    calls = [*_golden_calls(), ("z", "atac.align", {"fastqs_R1": [5]}, {"stats.max.mem": 0.5}), ("y", "od/d *", {}, {"stats.max.mem": 2.0})]
    sized, targets = _fit_tables(spark, calls)
    metrics = ("stats.max.mem", "stats.max.disk", "none")
    rows = G.fit_input(sized, targets, None, metrics)
    for reduce, place in (("sum", "r"), (None, "m")):
        fits = G.analyze(sized, targets, None, "sum", metrics) if reduce else G.analyze_multi(sized, targets, None, metrics)
        sinks.write_documents(sinks.analysis_parts(rows, fits, metrics, reduce), str(tmp_path / place))
        docs = {d["task"]: d for d in (json.loads(p.read_text()) for p in (tmp_path / place).glob("*.json"))}
        assert set(docs) == {c[1] for c in calls} and list(docs["od/d *"]["y"]) == ["stats.max.mem"] and "none" not in docs["atac.align"]["y"]
        align = docs["atac.align"]
        if reduce:
            assert align["x"] == {"sum(fastqs_R1,fastqs_R2)": [X1[0] + X2[0], X1[1] + X2[1], 5]}
            assert align["coeffs"]["stats.max.disk"] is None and docs["od/d *"]["x"] == {"sum()": [0]}
        else:
            assert align["x"] == {"fastqs_R1": [*X1, 5], "fastqs_R2": [*X2, 0]} and docs["od/d *"]["x"] == {}
        assert align["y"]["stats.max.disk"] == [5, 5] and align["y"]["stats.max.mem"][2] == 0.5


def test_named_stat_and_task_filter(spark):
    M.register_stat("range", lambda val, row: F.max(val) - F.min(val))
    row = M.resource_stats(_long(spark), ["range"]).where("log = 'gs://l/many' AND col = 'mem'").first()
    assert row.range == 20
    assert M.filter_task(_calls(spark), "t.*").count() == 0
    assert M.filter_task(_calls(spark), "t.*", wildcard=True).count() == 5
    metrics = {r.metric: r.val for r in M.stat_metrics(M.resource_stats(_long(spark))).where("log = 'gs://l/one'").collect()}
    assert metrics["stats.max.mem"] == 10 and math.isnan(metrics["stats.std.mem"])


def test_rule_table_equals_literal_rules(spark):
    rng = random.Random(6)
    pieces = ["main.", "sub", "align", "a", "b", ".", "*", "?", "[ab]", "[!a]", "[", "]", "[]a]", "[a-c]", "qc", "ü", "\\"]
    patterns = {"".join(rng.choices(pieces, k=rng.randint(1, 6))) for _ in range(1500)} | {"", "*", "??", "main.align"}
    names = sorted({"".join(rng.choices([p for p in pieces if p[0] not in "*?["] + ["[", "c"], k=rng.randint(1, 6))) for _ in range(150)})
    df = spark.createDataFrame([(n, i) for i, n in enumerate([*names, names[0], None])], "task_name string, i int")
    more = [(f"main.x{i}*", ["v"]) for i in range(10_000)]
    rules = spark.createDataFrame([(p, None) for p in sorted(patterns)] + more, "pattern string, vars array<string>")
    matched = G.match_rules(df, rules)
    want = {(n, i, p) for i, n in enumerate([*names, names[0]]) for p in patterns if fnmatch.fnmatchcase(n, p)}
    got = matched.collect()
    assert {(r.task_name, r.i, r.task) for r in got} == want and len(got) == len(want) > 300
    plan = matched._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_rule_table_with_variables(spark):
    rules = {"atac.align*": ["fastqs_R1", "fastqs_R2"], "*filter": ["bam"], "atac.*": [], "none": ["x"]}
    sized, targets = _fit_tables(spark, _golden_calls())
    rows = [(p, v[:1]) for p, v in rules.items()] + [(p, v[1:]) for p, v in rules.items() if v[1:]] + [(None, ["x"])]
    table = spark.createDataFrame(rows, "pattern string, vars array<string>")
    key = lambda rows: sorted((r.task, r.metric, r.x_name, r.n, f"{r.slope:.6e}", f"{r.intercept:.6e}") for r in rows.collect())
    assert key(G.analyze(sized, targets, table)) == key(G.analyze(sized, targets, rules)) != []
    assert G.analyze(sized, targets, table.limit(0)).count() == 0


def test_another_solver(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(10**6, 10**7, (40, 2)).astype(float)
    y = x @ [2.0, -1.0] + 5e6 + rng.normal(0, 1e5, 40)
    calls = [(str(i), "t", {"a": [int(x[i, 0])], "b": [int(x[i, 1])]}, {"m": y[i]}) for i in range(40)]
    tables = _fit_tables(spark, calls)
    penalty = 1e12
    row = G.analyze_multi(*tables, None, ("m",), solver=G.ridge(penalty)).first()
    centred = x - x.mean(0)
    want = np.linalg.solve(centred.T @ centred / 40 + penalty * np.eye(2), centred.T @ (y - y.mean()) / 40)
    assert row.coeffs == pytest.approx(want, rel=1e-6) and row.intercept == pytest.approx(y.mean() - x.mean(0) @ want, rel=1e-6)
    none = G.analyze_multi(*tables, None, ("m",), solver=lambda m: None if m.n == 40 and m.names == ["a", "b"] else ([], 0.0)).first()
    assert (none.coeffs, none.intercept, none.reason) == (None, None, "not_solved")


def test_named_reduction(spark):
    G.register_reduction("spread", lambda xs: F.array_max(xs) - F.array_min(xs))
    sized, targets = _fit_tables(spark, [("1", "t", {"a": [1], "b": [5]}, {"m": 1}), ("2", "t", {"a": [7], "b": [2]}, {"m": 3})])
    fit = G.analyze(sized, targets, None, "spread", ("m",)).first()
    assert fit.x_name == "spread(a,b)" and fit.slope == pytest.approx(2.0)


def test_a_fit_reads_its_inputs_once(spark):
    read = spark.sparkContext.accumulator(0)

    def told(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    schema = "call_id string, task_name string, var string, size long"
    sized = spark.createDataFrame([(f"c{i}", f"t{i % 2}", "a", i) for i in range(20)], schema).mapInArrow(told, schema)
    targets = spark.createDataFrame([(f"c{i}", f"t{i % 2}", "m", 2.0 * i + 1) for i in range(20)], "call_id string, task_name string, metric string, val double")
    assert len(G.fit_input(sized, targets, None, ["m"]).collect()) == 20 and read.value == 20
    assert len(G.x_cells(sized).collect()) == 20 and read.value == 40
