from __future__ import annotations

import json
import os
import random

import pytest

from runlens.functions.labels import Naming
from runlens.operators import corpus as O, files as B, monitor as M, search as S
from runlens.session import shared_dir
from runlens.sources import readers as R, sinks

FILES = ["/a/b/c/d.txt", "/a/b/e.txt", "/f/g/h.txt", "/s/x/y/s/d/e/s/.txt", "/1/2/3/4.txt", "/1/5/6/7.txt", "/a/t/c.txt"]


@pytest.mark.parametrize(
    "level, want", [(5, "/1/2/3,/1/5/6,/a/b,/a/t,/f/g,/s/x/y/s"), (2, "/1,/a,/f,/s")]
)
def test_bind_path_goldens(spark, level, want):
    df = spark.createDataFrame([("d", p) for p in [*FILES, "relative/x", "gs://b/c"]], "doc string, path string")
    assert B.bind_string(B.bind_paths(df, level)).first().bindpath == want


def test_bind_paths_like_all_pairs(spark):
    rng = random.Random(6)
    rows = [(str(d), "/" + "/".join(rng.choice(["a", "b", "ab", "abc"]) for _ in range(rng.randint(1, 9)))) for d in range(40) for _ in range(rng.randint(1, 30))]
    for level in (1, 3, 5):
        want = set()
        for doc in {d for d, _ in rows}:
            dirs = {os.path.dirname(p) for d, p in rows if d == doc}
            for d in list(dirs):
                parts = d.split("/")
                dirs |= {"/".join(parts[:i]) for i in range(level, len(parts))}
            want |= {(doc, d) for d in dirs if not any(d != e and d.startswith(e) for e in dirs)}
        got = B.bind_paths(spark.createDataFrame(rows, "doc string, path string"), level)
        assert {(r.doc, r.dir) for r in got.collect()} == want


def test_real_paths_and_raw_prefixes(spark):
    df = spark.createDataFrame([("d", "/a/b/x"), ("d", "/a/bc/y")], "doc string, path string")
    real = spark.createDataFrame([("/a/b/x", "/real/z/x")], "path string, realpath string")
    assert {r.dir for r in B.bind_paths(df, realpaths=real).collect()} == {"/a/b", "/real/z"}


def test_cleanup_plan(spark):
    files = spark.createDataFrame([("/o/w1/a/f", 1), ("/o/w1/g", 2), ("/o/w10/h", 3)], "path string, length bigint")
    roots = spark.createDataFrame([("1", "/o/w1/"), ("2", None), ("3", "/o/w1/a")], "id string, root string")
    got = {(r.id, r.path) for r in B.cleanup_plan(roots, files).collect()}
    assert got == {("1", "/o/w1/a/f"), ("1", "/o/w1/g"), ("3", "/o/w1/a/f")}


def test_localize_plan(spark):
    leaves = spark.createDataFrame(
        [("/w/in.json", "a", "/x/y.txt"), ("/w/in.json", "b", "gs://b/c"), ("/w/other.json", "a", "gs://b/c"), ("/w/in.json", "c", "text")],
        "doc string, var string, value string",
    )
    plan = B.localize_plan(leaves, "gcp", "gs://cache/")
    assert {(r.src, r.dst, r.needs_copy) for r in plan.collect()} == {
        ("/x/y.txt", "gs://cache/x/y.txt", True),
        ("gs://b/c", "gs://b/c", False),
    }
    assert {r.doc: r.name for r in B.rewritten_docs(plan, "gcp").collect()} == {"/w/in.json": "in.gcs.json", "/w/other.json": "other.json"}
    assert {r.dst for r in B.localize_plan(leaves, "slurm", "/cache").collect()} == {"/x/y.txt", "/cache/b/c"}


def test_localize_through_nested_lists(spark):
    docs = [("/w/in.json", '{"a": "gs://l/one.json", "k": ["gs://l/one.json", 7], "t": "text"}'), ("/w/other.json", '{"a": "gs://l/same.tsv", "b": "gs://b/c"}'), ("/w/direct.json", '{"a": "/x/y.bam"}')]
    texts = [
        ("gs://l/one.json", '{"gs://l/two.tsv": "gs://l/two.tsv", "n": null}'), ("gs://l/two.tsv", "h\t/l/three.csv\r\n\tgs://b/c"), ("/l/three.csv", "/x/y.bam,gs://b/c\n"),
        ("gs://l/same.tsv", "gs://b/c\tgs://l/leaf.csv"), ("gs://l/leaf.csv", "plain,gs://b/d"), ("gs://l/unread.csv", "/never"),
    ]
    plan, new = B.localize_inputs(spark.createDataFrame(docs, "doc string, text string"), spark.createDataFrame(texts, "path string, text string"), "gcp", "gs://cache/")
    moved = {(r.node, r.src): (r.dst, r.action) for r in plan.collect()}
    assert moved["/w/in.json", "gs://l/one.json"] == ("gs://cache/l/one.gcs.json", "rewrite")
    assert moved["gs://l/one.json", "gs://l/two.tsv"] == ("gs://cache/l/two.gcs.tsv", "rewrite")
    assert moved["gs://l/two.tsv", "/l/three.csv"] == ("gs://cache/l/three.gcs.csv", "rewrite")
    assert moved["/l/three.csv", "/x/y.bam"] == moved["/w/direct.json", "/x/y.bam"] == ("gs://cache/x/y.bam", "copy")
    assert {a for (n, _), (_, a) in moved.items() if n in ("/w/other.json", "gs://l/same.tsv", "gs://l/leaf.csv")} == {"keep"} and "gs://l/unread.csv" not in {n for n, _ in moved}
    got = {r.node: r for r in new.collect()}
    assert set(got) == {"/w/in.json", "/w/direct.json", "gs://l/one.json", "gs://l/two.tsv", "/l/three.csv"}
    assert json.loads(got["/w/in.json"].text) == {"a": "gs://cache/l/one.gcs.json", "k": ["gs://cache/l/one.gcs.json", 7], "t": "text"}
    assert json.loads(got["gs://l/one.json"].text) == {"gs://l/two.tsv": "gs://cache/l/two.gcs.tsv", "n": None}
    assert got["gs://l/two.tsv"].text == "h\tgs://cache/l/three.gcs.csv\r\n\tgs://b/c" and got["/l/three.csv"].text == "gs://cache/x/y.bam,gs://b/c\n"
    assert [got[n].level for n in ("/l/three.csv", "gs://l/two.tsv", "gs://l/one.json")] == [0, 1, 2] and got["/w/in.json"].dst == "gs://cache/w/in.gcs.json"


def test_rounds_from_list_to_list_join_names_alone(spark, monkeypatch):
    rounds, cut = [], R.cut_lineage
    monkeypatch.setattr(R, "cut_lineage", lambda df: rounds.append(df._jdf.queryExecution().optimizedPlan().toString()) or cut(df))
    docs = spark.createDataFrame([("/w/in/", '{"a": "/l/1.tsv", "a": "/l/2.tsv", "n": [1e400, "rel"]}'), ("/w/bad", "{")], "doc string, text string")
    texts = [("/l/1.tsv", "/no"), ("/l/2.tsv", "/l/3.json\t/x,y\t/x,y\rgs://b"), ("/l/3.json", '["/l/2.tsv", {"k": "/l/4.csv"}, null]'), ("/l/4.csv", "s3://q\t/r,/l/none.csv\nhttp:/s"), ("/l/5", "/t")]
    edges = R.input_edges(docs, spark.createDataFrame(texts, "path string, text string"))
    want = {
        ("/w/in/", True, "/l/2.tsv", True), ("/l/2.tsv", False, "/l/3.json", True), ("/l/2.tsv", False, "/x,y", False), ("/l/2.tsv", False, "gs://b", False), ("/l/3.json", False, "/l/2.tsv", True),
        ("/l/3.json", False, "/l/4.csv", True), ("/l/4.csv", False, "s3://q\t/r", False), ("/l/4.csv", False, "/l/none.csv", True),
    }
    assert sorted(tuple(r) for r in edges.collect()) == sorted(want)
    assert len(rounds) == 5 and not [plan for plan in rounds if "text#" in plan]


def test_localize_names_lists_that_name_each_other(spark):
    docs = spark.createDataFrame([("/w/in.json", '{"a": "/l/top.tsv"}')], "doc string, text string")
    texts = [("/l/top.tsv", "/l/a.tsv"), ("/l/a.tsv", "/l/b.tsv\t/x"), ("/l/b.tsv", "/l/a.tsv\t/l/end.tsv"), ("/l/end.tsv", "/y")]
    with pytest.raises(ValueError, match="list files form a cycle: /l/a.tsv, /l/b.tsv$"):
        B.localize_inputs(docs, spark.createDataFrame(texts, "path string, text string"), "gcp", "gs://c")


def _corpus(spark, files):
    return spark.createDataFrame(list(files.items()), "path string, text string")


def _closure(spark, files, **more):
    df = _corpus(spark, files)
    return O.import_closure(O.import_edges(R.corpus_lines(df)), df.select("path"), **more)


def test_import_closure_golden(spark):
    files = {
        "/w/main.wdl": 'version 1.0\nimport "sub/sub.wdl" as sub\n# import "no.wdl"\nworkflow main {}',
        "/w/sub/sub.wdl": "import 'sub/sub_sub.wdl' as s",
        "/w/sub/sub/sub_sub.wdl": "workflow sub_sub {}",
    }
    closure = _closure(spark, files)
    assert {(r.root, r.file, r.depth) for r in closure.collect()} == {
        ("/w/main.wdl", "/w/sub/sub.wdl", 1),
        ("/w/main.wdl", "/w/sub/sub/sub_sub.wdl", 2),
        ("/w/sub/sub.wdl", "/w/sub/sub/sub_sub.wdl", 1),
    }
    assert {r.root: r.n_files for r in O.packaged_imports(closure).collect()} == {"/w/main.wdl": 2, "/w/sub/sub.wdl": 1}
    assert O.import_violations(closure).count() == 0


def test_import_closure_broadcasts_nothing(spark, monkeypatch):
    plans, cut = [], O.cut_lineage
    monkeypatch.setattr(O, "cut_lineage", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or cut(df))
    files = {"/w/main.wdl": 'import "sub.wdl"', "/w/sub.wdl": 'import "https://e.org/u.wdl"', "https://e.org/u.wdl": 'import "sub.wdl"'}
    rows = [(path, text + "\n") for path, text in files.items()]
    df = spark.createDataFrame(rows, "path string, text string")
    O.import_closure(O.import_edges(R.corpus_lines(df)), df.select("path")).collect()
    joins = [line for plan in plans for line in plan.splitlines() if " Join " in line or line.startswith("Join ")]
    assert joins and all("strategy=merge" in line for line in joins)


def test_import_violations(spark):
    files = {
        "/w/a/main.wdl": 'import "/abs.wdl"\nimport "gone.wdl"\nimport "../out.wdl"\nimport "https://e.org/u.wdl"',
        "/w/out.wdl": "",
        "https://e.org/u.wdl": 'import "b.wdl"',
        "/w/a/b.wdl": "",
    }
    roots = spark.createDataFrame([("/w/a/main.wdl",)], "path string")
    closure = _closure(spark, files, roots=roots)
    assert {(r.file, r.violation) for r in O.import_violations(closure).collect()} == {
        ("/abs.wdl", "absolute_path"),
        ("/w/a/gone.wdl", "missing"),
        ("/w/out.wdl", "outside_root"),
    }
    assert {r.file for r in closure.where("violation IS NULL").collect()} == {"https://e.org/u.wdl", "/w/a/b.wdl"}


def test_import_cycle_is_reported_and_fails_when_strict(spark):
    files = {"/w/a.wdl": 'import "b.wdl"', "/w/b.wdl": 'import "a.wdl"'}
    assert {r.root for r in O.import_violations(_closure(spark, files, max_depth=4), 4).collect()} == {"/w/a.wdl", "/w/b.wdl"}
    with pytest.raises(Exception, match="cycle"):
        _closure(spark, files, max_depth=4, strict=True).collect()


def test_default_images(spark):
    lines = R.corpus_lines(
        _corpus(spark, {"/m": 'x\n#ACME docker "ubuntu:latest"\n# ACME docker "late"\n#ACME singularity "docker://ubuntu:latest"', "/n": "x"})
    )
    naming = Naming("acme")
    meta = spark.createDataFrame([("/n", {"acme_docker": "img", "default_conda_env": "env"})], "path string, meta map<string,string>")
    assert {r.path: r.image for r in O.default_image(lines, meta, "docker", naming).collect()} == {"/m": "ubuntu:latest", "/n": "img"}
    assert [r.image for r in O.default_image(lines, None, "singularity", naming).collect()] == ["docker://ubuntu:latest"]
    assert [r.image for r in O.default_image(lines, meta, "conda", naming).collect()] == ["env"]


def test_readers(spark, tmp_path):
    def put(name, text):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
        return str(path)

    one = put("meta/a b+c.json", '{"id":\n "1"}')
    put("meta/d.json", '{"id": "2"}')
    got = R.read_metadata(spark, [str(tmp_path / "meta")]).collect()
    assert {r.file for r in got} == {one, str(tmp_path / "meta" / "d.json")}
    assert json.loads([r.doc for r in got if r.file == one][0]) == {"id": "1"}
    put("lines/x.jsonl", '{"id":"1"}\n\n{"id":"2"}\n')
    assert R.read_metadata(spark, str(tmp_path / "lines"), lines=True).count() == 2
    assert R.read_labels(spark, one).selectExpr("variant_get(doc, '$.id', 'string') v").first().v == "1"

    log = put("mon/m.log", "time\tmem\tdisk\tcpu_pct\n1\t5\t6\t7.5\n2\t8\t9\t1.5\n")
    long = R.read_monitor_logs(spark, str(tmp_path / "mon"))
    wide = R.wide_to_long(R.read_monitor_table(spark, str(tmp_path / "mon")))
    cells = lambda df: sorted((r.log, r.col_no, r.col, r.val) for r in df.collect())
    assert cells(long) == cells(wide) and cells(long)[0] == (log, 0, "time", 1.0)

    put("mon2/m.log", "time\tmem\tdisk\tcpu_pct\n1\t5\t6\t7.5\n2\t8\tx\t\n")
    put("mon2/bare.log", "time\tmem\tdisk\tcpu_pct\n\n\n")
    put("mon2/none.log", "time\tmem\tdisk\tcpu_pct")
    both = [R.read_monitor_logs(spark, str(tmp_path / "mon2")), R.wide_to_long(R.read_monitor_table(spark, str(tmp_path / "mon2")))]
    nulls = lambda df: sorted(((r.log, r.col_no, r.row_no is None, r.val) for r in df.collect()), key=str)
    assert nulls(both[0]) == nulls(both[1])
    stats = {(os.path.basename(r.log), r.col): (r.n_rows, r.max) for r in M.resource_stats(both[1]).collect()}
    assert stats["bare.log", "mem"] == stats["none.log", "mem"] == (0, None) and stats["m.log", "disk"] == (2, 6) and len(stats) == 9

    put("list/w.json", '{"id":"a","labels":{"k":"v"},"parentWorkflowId":null}\n{"id":"b","parentWorkflowId":"a"}\n')
    wf = R.read_workflows(spark, str(tmp_path / "list"))
    assert S.exclude_subworkflows(wf).first().labels == {"k": "v"}
    sinks.write_list_tsv(S.list_workflows(wf, ["workflow_id", "parent"]), str(tmp_path / "tsv"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "tsv")).collect()) == ["a\tNone", "b\ta", "workflow_id\tparent"]
    sinks.write_list_tsv(S.list_workflows(wf.where("false"), ["id"]), str(tmp_path / "empty"))
    assert [r.value for r in spark.read.text(str(tmp_path / "empty")).collect()] == ["id"]

    catalog = {r.path: r.length for r in R.read_file_catalog(spark, str(tmp_path / "meta")).collect()}
    assert catalog[one] == os.path.getsize(one)
    put("run/call/stderr", "oops\nKilled\n")
    put("run/call/stderr.background", "bg")
    put("run/call/script", "no")
    logs = {os.path.basename(r.path): r.contents for r in R.read_task_logs(spark, str(tmp_path / "run")).collect()}
    assert logs == {"stderr": "oops\nKilled\n", "stderr.background": "bg"}
    put("src/a.wdl", 'l0\nimport "b.wdl"')
    assert [(r.line_no, r.line) for r in R.read_corpus(spark, str(tmp_path / "src")).collect()] == [(0, "l0"), (1, 'import "b.wdl"')]
    put("jobs/q.txt", "HEAD\n1 RUN_a\n")
    assert R.read_job_listing(spark, str(tmp_path / "jobs")).where("line_no = 0").first().line == "HEAD"
    beat = put("hb/server1", "node:8000")
    row = R.read_heartbeats(spark, str(tmp_path / "hb")).first()
    assert (row.server, row.text) == (beat, "node:8000") and abs(row.ts.timestamp() - os.path.getmtime(beat)) < 2


def test_log_lines_are_numbered_over_splits_and_files(spark, tmp_path):
    want = []
    for i in range(3):
        lines = [f"{i}-{j}-{'x' * (j % 50)}" for j in range(4000 if i == 1 else 10)]
        path = tmp_path / f"{9 - i}.log"
        path.write_text("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
        want += lines
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        handed = R.read_log(spark, str(tmp_path))
        rows = handed.orderBy("seq").collect()
        joined = R.read_log(spark, str(tmp_path), handed_splits=0).orderBy("seq").collect()
        plan = handed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [(r.seq, r.line) for r in rows] == [(r.seq, r.line) for r in joined] == list(enumerate(want))
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanges and all("BroadcastExchange" in line for line in exchanges)


def test_input_files_through_lists(spark):
    docs = spark.createDataFrame([("d", '{"a":"/x.json","b":["/y.tsv",3],"c":"rel"}')], "doc string, text string")
    texts = spark.createDataFrame(
        [("/x.json", '["/y.tsv", {"k": "gs://b/c"}]'), ("/y.tsv", "n\t/z.csv\n/p q\tx"), ("/z.csv", "a,/last,/x.json")], "path string, text string"
    )
    assert {r.path for r in R.input_files(docs, texts).collect()} == {"/x.json", "/y.tsv", "gs://b/c", "/z.csv", "/p q", "/last"}


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured
    else:
        assert shared_dir(spark) == spark.sparkContext.getCheckpointDir()
