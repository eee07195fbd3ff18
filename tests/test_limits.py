"""Outcomes that must not depend on how many, how deep or how often."""

from __future__ import annotations

import json
import random
from pathlib import Path

import pytest

from runlens.operators import closure, monitor, search
from runlens.session import shared_dir
from runlens.sources import readers, sinks

LISTING = "id string, parentWorkflowId string, labels map<string,string>, submission string"


def _uuid(i: int) -> str:
    return f"{i:08x}-0000-4000-a000-{i:012x}"


@pytest.mark.parametrize("n", [999, 1001])
def test_find_is_the_same_for_any_number_of_ids(spark, n):
    wf = spark.createDataFrame([(_uuid(5), None, {"k*": "v"}, None), (_uuid(5000), None, {"k*": "v"}, None), (_uuid(6000), None, {}, None)], LISTING)
    ids = [_uuid(i) for i in range(n)]
    assert sorted(r.id for r in search.find(wf, ids, [("k*", "v")]).collect()) == [_uuid(5), _uuid(5000)]
    assert [r.id for r in search.find_by_ids(wf, ids).collect()] == [_uuid(5)]


def test_repeated_listing_rows_and_long_chains(spark):
    rows = [(str(i), str(i - 1) if i else None) for i in range(40)] * 2
    tree = closure.expand_subworkflows(spark.createDataFrame(rows, "id string, parentWorkflowId string")).collect()
    assert sorted((r.root_id, int(r.descendant_id), r.depth) for r in tree) == [("0", i, i) for i in range(1, 40)]


def test_two_parents_of_an_id_fail_and_are_listed(spark):
    wf = spark.createDataFrame([("a", "r"), ("a", "r"), ("b", "a"), ("b", "q"), ("c", None)], "id string, parentWorkflowId string")
    assert [(r.id, r.parents) for r in closure.parent_conflicts(wf).collect()] == [("b", ["a", "q"])]
    with pytest.raises(Exception, match="two parents of b"):
        closure.expand_subworkflows(wf)


def _naming(name, subs, **more):
    return json.dumps({"id": name, **more, "calls": {"m.s": [{"shardIndex": i, "subWorkflowId": s} for i, s in enumerate(subs)]}}, indent=1)


def _embedded(name, docs):
    def fill(value):
        if isinstance(value, dict):
            return {"subWorkflowMetadata" if k == "subWorkflowId" and v in docs else k: _embedded(v, docs) if k == "subWorkflowId" and v in docs else fill(v) for k, v in value.items()}
        return [fill(v) for v in value] if isinstance(value, list) else value

    return fill(json.loads(docs[name]))


def test_embedding_puts_documents_together_from_the_leaves(spark):
    docs = {
        "root": _naming("root", ["a", "gone", "b", "a"], note='"subWorkflowId": "b" and $1 \\ ü'),
        "a": _naming("a", ["c"]), "b": _naming("b", ["c", "d"]), "c": _naming("c", []), "d": _naming("d", ["e"]), "e": "{}", "alone": _naming("alone", ["gone"]),
    }
    docs |= {f"n{i}": _naming(f"n{i}", [f"n{i + 1}"]) for i in range(12)}
    rows = [*docs.items(), (None, _naming("x", ["e"])), ("nothing", None), ("e", "")]
    got = closure.embed_subworkflows(spark.createDataFrame(rows, "id string, doc string").repartition(3)).collect()
    by = {r.id: r for r in got}
    assert set(by) == {"root", "alone", "n0", None, "nothing"} and len(got) == 5
    assert all(json.loads(by[i].doc) == _embedded(i, docs) for i in ("root", "alone", "n0")) and by["nothing"].doc is None
    assert json.loads(by[None].doc)["calls"]["m.s"][0]["subWorkflowMetadata"] == {}
    assert {i: r.levels for i, r in by.items()} == {"root": 3, "alone": 0, "n0": 11, None: 1, "nothing": 0}
    assert by["alone"].doc == docs["alone"]


def test_embedding_writes_each_text_once_however_deep(spark):
    noise, depth = random.Random(3), 10
    docs = {f"n{i}": _naming(f"n{i}", [f"n{i + 1}"], note=noise.randbytes(60_000).hex()) for i in range(depth)}
    written = lambda: sum(f.stat().st_size for f in Path(shared_dir(spark).removeprefix("file:")).rglob("part-*"))
    before = written()
    got = closure.embed_subworkflows(spark.createDataFrame(list(docs.items()), "id string, doc string")).collect()
    assert [(r.id, r.levels, json.loads(r.doc)) for r in got] == [("n0", depth - 1, _embedded("n0", docs))]
    assert written() - before < 2 * sum(map(len, docs.values()))


def test_embedding_keeps_slots_between_held_ones_and_pieces_over_batches(spark):
    names = [f"d{i}" if i % 3 == 1 or i in (5, 6, 59) else f"gone{i}" for i in range(60)]
    docs = {"root": _naming("root", names, note="ü▁")} | {n: _naming(n, ["gone"]) for n in names if n.startswith("d")} | {"other": _naming("other", ["d1", "d1"])}
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(rows)
    spark.conf.set(rows, "7")
    try:
        got = {r.id: r.doc for r in closure.embed_subworkflows(spark.createDataFrame([*docs.items(), ("empty", ""), ("nothing", None)], "id string, doc string")).collect()}
    finally:
        spark.conf.set(rows, was)
    assert {i: json.loads(t) for i, t in got.items() if t} == {i: _embedded(i, docs) for i in ("root", "other")}
    assert (got["empty"], got["nothing"], len(got)) == ("", None, 4)


def test_embedding_of_nothing_and_of_a_cycle(spark):
    schema = "id string, doc string"
    assert closure.embed_subworkflows(spark.createDataFrame([], schema)).count() == 0
    with pytest.raises(ValueError, match="cycle"):
        closure.embed_subworkflows(spark.createDataFrame([("a", _naming("a", ["b"])), ("b", _naming("b", ["a"])), ("r", _naming("r", ["a"]))], schema))


@pytest.mark.parametrize("rows", [[("a", "a")], [("a", "c"), ("b", "a"), ("c", "b"), ("d", "c")]])
def test_cycle_of_parents_fails(spark, rows):
    with pytest.raises(ValueError, match="cycle"):
        closure.expand_subworkflows(spark.createDataFrame(rows, "id string, parentWorkflowId string"))


def test_list_files_that_nest_and_name_each_other(spark):
    texts = [(f"gs://b/l{i}.tsv", f"gs://b/l{i + 1}.tsv\tgs://b/f{i}") for i in range(4)] + [("gs://b/l4.tsv", "gs://b/l0.tsv")]
    docs = spark.createDataFrame([("d", '{"x": "gs://b/l0.tsv"}'), ("e", '{"x": "gs://b/l3.tsv"}')], "doc string, text string")
    got = {(r.doc, r.path) for r in readers.input_files(docs, spark.createDataFrame(texts, "path string, text string")).collect()}
    every = {f"gs://b/l{i}.tsv" for i in range(5)} | {f"gs://b/f{i}" for i in range(4)}
    assert got == {(d, p) for d in "de" for p in every}


def test_list_tsv_keeps_blanks_quotes_and_empty_values(spark, tmp_path):
    listing = spark.createDataFrame([("  lead ", 'a"b', ""), ("x", "y", "z")], "a string, b string, c string").coalesce(1)
    sinks.write_list_tsv(listing, str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("part-*")).read_text()
    assert text.splitlines() == ["a\tb\tc", '  lead \t"a""b"\t', "x\ty\tz"]


def test_malformed_custom_labels_fail(spark):
    columns = "custom string, backend string, str_label string, user string"
    with pytest.raises(Exception, match="(?i)malformed"):
        search.build_labels(spark.createDataFrame([("{bad", "gcp", "l", "u")], columns)).collect()
    assert search.build_labels(spark.createDataFrame([(None, "gcp", "l", "u")], columns)).count() == 1


def test_median_is_a_named_statistic(spark):
    long = spark.createDataFrame([("l", i, 1, "mem", float(v)) for i, v in enumerate([5, 1, 3, 8])], "log string, row_no long, col_no int, col string, val double")
    assert monitor.resource_stats(long, ["median"]).first()["median"] == 4.0


def test_plan_of_the_ragged_table_stays_small(spark):
    from pyspark.sql import functions as F

    from runlens.sources import sinks

    stats, series = "map('max', map('mem', 1e16D, 'x', 2.5D)) AS stats", "map('mem', named_struct('n_rows', 1L, 'whole', true), 'x', named_struct('n_rows', 1L, 'whole', false)) AS series"
    record = spark.range(1).selectExpr("'w' AS id", "'t' AS task_name", "1 AS shard_idx", "'Done' AS status", "1 AS attempt", "named_struct('cpu', 1, 'disk', 2L, 'mem', 3L) AS instance", stats, series, "map('v', array(5L)) AS input_file_sizes")
    header, lines = sinks.monitor_lines(record, ("mem", "x"), ["id"], ["max", "count"])
    assert header.split("\t")[8:] == ["stats.max.mem", "stats.max.x", "stats.count.mem", "stats.count.x", "input_file_var_size_pairs"]
    assert lines.first().line.split("\t")[8:] == ["10000000000000000", "2.5", "nan", "nan", "v", "5"]
    wide = sinks.monitor_lines(record, [f"c{i}" for i in range(20)], ["id"])[1].select(F.length("line"))
    assert len(wide._jdf.queryExecution().optimizedPlan().toString()) < 100_000


def test_expanded_rows_are_dealt_to_tasks_of_bounded_rows(spark, tmp_path):
    from pyspark.sql import functions as F

    from runlens.plans import relations

    # more splits than cores, but all rows in the row group of one of them
    spark.range(5000).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    for i in range(20):
        spark.range(1).where("id > 0").coalesce(1).write.mode("append").parquet(f"{tmp_path}/orders.parquet")
    dealt = relations.spread(spark, str(tmp_path), "orders", rows=100).groupBy(F.spark_partition_id()).count()
    assert dealt.agg(F.max("count"), F.sum("count")).first()[:] == (100, 5000)


def test_merged_leaves_are_dealt_to_tasks_of_bounded_rows(spark, monkeypatch):
    from pyspark.sql import functions as F

    from runlens.operators import nested

    monkeypatch.setattr(nested, "MERGED_ROWS", 100)
    rows = spark.range(2000).select("id", F.explode(F.array(F.lit(0), F.lit(1))).alias("layer"))
    layers = rows.withColumn("doc", F.parse_json(F.concat(F.lit('{"a":'), F.col("layer").cast("string"), F.lit(',"b":{"c":2}}'))))
    merged = nested.merge_docs(layers, "id", "layer").select("*", F.spark_partition_id().alias("task"))
    assert {r.doc for r in merged.select("doc").distinct().collect()} == {'{"a":1,"b":{"c":2}}'} and merged.count() == 2000
    assert merged.groupBy("task").count().agg(F.max("count")).first()[0] <= 100


def test_directories_are_dealt_to_tasks_of_bounded_rows(spark, monkeypatch):
    from pyspark.sql import functions as F

    from runlens.operators import files

    monkeypatch.setattr(files, "COVERED_ROWS", 100)
    dirs = spark.range(2000).select(F.col("id").cast("string").alias("doc"), F.explode(F.array(F.lit("/a/b"), F.lit("/a"))).alias("dir"))
    least = files.drop_covered(dirs).select("*", F.spark_partition_id().alias("task"))
    assert {r.dir for r in least.select("dir").distinct().collect()} == {"/a"} and least.count() == 2000
    assert least.groupBy("task").count().agg(F.max("count")).first()[0] <= 100
