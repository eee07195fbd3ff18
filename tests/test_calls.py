from __future__ import annotations

import json

import pytest

from runlens.operators import calls as C, closure, search as S
from runlens.sources import sinks

W = "00000001-0000-4000-a000-000000000001"


def _call(root, status="Done", **more):
    return {"executionStatus": status, "shardIndex": -1, "attempt": 1, "callRoot": root, **more}


def _three_levels(status="Succeeded", t2="sub.t2", t2_status="Done", **top):
    root = f"gs://out/main/{W}"
    subsub = {"id": "z", "calls": {"sub_sub.t3": [_call(f"{root}/call-sub/sub/y/call-sub_sub/z/call-t3")]}}
    sub = {
        "id": "y",
        "calls": {
            t2: [_call(f"{root}/call-sub/sub/y/call-t2", t2_status, stderr="/logs/t2/stderr", stdout="/logs/t2/stdout")],
            "sub.sub_sub": [{"subWorkflowMetadata": subsub}],
        },
    }
    calls = {"main.t1": [_call(f"{root}/call-t1")], "main.sub": [{"subWorkflowMetadata": sub}]}
    return {"id": W, "status": status, "calls": calls, **top}


def _workflows(spark, *docs):
    rows = [(json.dumps(d),) for d in docs]
    return C.workflow_header(spark.createDataFrame(rows, "doc string"))


def test_three_level_golden(spark):
    wf = _workflows(spark, _three_levels())
    assert wf.first().failures is None
    rows = C.flatten_calls(wf).orderBy("ord").collect()
    assert [(r.call_name, list(r.parent_call_names), r.executionStatus) for r in rows] == [
        ("main.t1", [], "Done"),
        ("sub.t2", ["main.sub"], "Done"),
        ("sub_sub.t3", ["main.sub", "sub.sub_sub"], "Done"),
    ]


def test_every_single_column_survives_pruning(spark):
    flat = C.flatten_calls(_workflows(spark, _three_levels()))
    whole = {c: sorted(map(str, (r[c] for r in flat.collect()))) for c in flat.columns}
    for column in flat.columns:
        assert sorted(str(r[0]) for r in flat.select(column).collect()) == whole[column], column


def test_call_without_embedded_document_is_a_call_and_empty_ones_give_nothing(spark):
    doc = {"id": W, "calls": {"main.sub": [{"executionStatus": "Failed"}], "main.e": [{"subWorkflowMetadata": {"id": "x"}}]}}
    assert [r.call_name for r in C.flatten_calls(_workflows(spark, doc, {"id": "none"})).collect()] == ["main.sub"]


def test_calls_at_any_depth_whatever_is_unrolled(spark):
    deep = {"id": "bottom", "calls": {"t.last": [_call("/x/d/call-last")]}}
    for i in range(30):
        deep = {"id": f"d{i}", "calls": {f"s{i}.sub": [{"subWorkflowMetadata": deep}], f"s{i}.own": [_call(f"/x/d/call-{i}")]}}
    wf = _workflows(spark, _three_levels(), deep)
    rows = [sorted((r.id, r.call_name, tuple(r.parent_call_names), tuple(r.ord), r.callRoot) for r in C.flatten_calls(wf, levels=n).collect()) for n in (0, 2, 8, 31)]
    assert rows[0] == rows[1] == rows[2] == rows[3]
    assert len(rows[0]) == 3 + 31 and max(len(r[2]) for r in rows[0]) == 30


def test_workflow_root(spark):
    given = {"id": "g", "workflowRoot": "/given", "calls": {}}
    wrong = {"id": "w", "calls": {"a": [_call("/x/other/call-a")]}}
    empty = {"id": "e", "calls": {}}
    wf = _workflows(spark, _three_levels(), given, wrong, empty)
    assert {r.id: r.workflow_root for r in C.workflow_root(wf).collect()} == {
        W: f"gs://out/main/{W}",
        "g": "/given",
        "w": None,
        "e": None,
    }


def test_report(spark):
    doc = _three_levels("Failed", "sub.t2_failing", "Failed", failures=[{"message": "m é {x}", "causedBy": []}])
    logs = spark.createDataFrame(
        [("/logs/t2/stderr", "INTENTED_ERROR: command not found"), ("/logs/t2/stderr.background", "bg"), ("/logs/t2/stdout", "out")],
        "path string, contents string",
    )
    wf = _workflows(spark, doc, {**_three_levels(), "id": "ok"})
    reports = {r.id: r.report for r in C.troubleshoot(wf, logs).collect()}
    assert reports["ok"] == (
        "* Started troubleshooting workflow: id=ok, status=Succeeded\n* Workflow ran Successfully.\n"
    )
    assert reports[W] == (
        f"* Started troubleshooting workflow: id={W}, status=Failed\n"
        "* Found failures JSON object.\n" + json.dumps(doc["failures"], indent=4) + "\n"
        "* Recursively finding failures in calls (tasks)...\n"
        "\n==== NAME=sub.t2_failing, STATUS=Failed, PARENT=main.sub\n"
        "SHARD_IDX=-1, RC=None, JOB_ID=None\nSTART=None, END=None\n"
        "STDOUT=/logs/t2/stdout\nSTDERR=/logs/t2/stderr\n"
        "STDERR_CONTENTS=\nINTENTED_ERROR: command not found\n"
        "STDERR_BACKGROUND_CONTENTS=\nbg\n"
    )
    full = {r.id: r.report for r in C.troubleshoot(wf, logs, show_completed=True, show_stdout=True).collect()}
    assert full[W].count("==== NAME=") == 3
    assert "STDOUT_CONTENTS=\nout\n" in full[W]


def test_attach_task_logs(spark):
    wf = _workflows(spark, _three_levels("Failed", t2_status="Failed"))
    logs = spark.createDataFrame([("/logs/t2/stderr", "Killed")], "path string, contents string")
    rows = C.attach_task_logs(C.not_completed(C.call_details(C.flatten_calls(wf))), logs).collect()
    assert [(r.call_name, r.stderr_contents, r.background_contents, r.stdout_contents) for r in rows] == [
        ("sub.t2", "Killed", None, None)
    ]


def test_failure_class(spark):
    df = spark.createDataFrame([("x Killed",), ("OutOfMemoryError",), ("fine",), (None,)], "contents string")
    assert [r.failure_class for r in C.failure_class(df).collect()] == ["out_of_memory", "out_of_memory", "other", "other"]
    assert [r.failure_class for r in C.failure_class(df, "fine, zzz").collect()] == ["other", "other", "out_of_memory", "other"]


def test_common_prefix(spark):
    rows = [(1, "/a/b"), (1, "/a/bc"), (1, "/a/b"), (2, "x"), (2, "y"), (3, "same"), (4, None)]
    got = C.longest_common_prefix(spark.createDataFrame(rows, "k int, s string"), ["k"], "s").collect()
    assert {r.k: r.lcp for r in got} == {1: "/a/b", 2: "", 3: "same", 4: None}


def test_subworkflow_closure_and_cycle(spark):
    chain = [(str(i), str(i - 1) if i else None) for i in range(40)] + [("x", None), ("y", "x")]
    wf = spark.createDataFrame(chain, "id string, parentWorkflowId string")
    got = {(r.root_id, r.descendant_id, r.depth) for r in closure.expand_subworkflows(wf).collect()}
    assert got == {("0", str(i), i) for i in range(1, 40)} | {("x", "y", 1)}
    loop = spark.createDataFrame([("a", "b"), ("b", "a")], "id string, parentWorkflowId string")
    with pytest.raises(ValueError, match="cycle"):
        closure.expand_subworkflows(loop)


LISTING = "id string, name string, status string, submission string, parentWorkflowId string, labels map<string,string>"


def _listing(spark):
    rows = [
        (W, "main", "Succeeded", "2020-01-02", None, {"run-str-label": "test_label", "run-user": "u"}),
        ("00000002-0000-4000-a000-000000000002", "sub", "Failed", None, W, {"run-str-label": "test_label"}),
        ("00000003-0000-4000-a000-000000000003", "main", "Running", "2020-01-01", None, {"run-str-label": ""}),
        ("00000004-0000-4000-a000-000000000004", "main", "Running", "", None, None),
    ]
    return spark.createDataFrame(rows, LISTING)


def test_search_goldens(spark):
    wf = _listing(spark)
    for ids, labels in [
        ([W], None),
        (None, [("run-str-label", "test_label")]),
        ([W[:-10] + "*"], None),
        (None, [("run-str-label", "test_labe?")]),
        ([W], [("run-str-label", "test_label")]),
    ]:
        assert [r.id for r in S.find(wf, ids, labels).collect()] == [W], (ids, labels)
    assert S.find(wf, None, [("run-str-label", "test_label")], exclude_subworkflow=False).count() == 2
    assert S.find(wf, None, [("run-str-label", "*")], exclude_subworkflow=False).count() == 2
    assert S.find(wf).count() == 0
    assert S.find_by_ids(wf, ["nonsense", W.upper()]).count() == 0
    assert S.find(wf, None, [("run-str-label", "test_labe[l]")]).count() == 0
    with pytest.raises(ValueError):
        S.find_by_ids(wf, ["a*"])
    with pytest.raises(ValueError):
        S.find_by_labels(wf, [("k", "a?")])
    many = [f"{i:08x}-0000-4000-a000-{i:012x}" for i in range(1, 1500)]
    assert S.find(wf, many, [("run-user", "u")]).count() == 3


def test_listing_and_labels(spark):
    wf = _listing(spark)
    assert {r.id[7] for r in S.hide_before(wf, "2020-01-01").collect()} == {"1", "2", "4"}
    first = S.list_workflows(wf).collect()[3]
    assert tuple(first) == (first.id, "Running", "main", "None", "None", "None", "")
    df = spark.createDataFrame(
        [('{"hello":"world","good":{"bye":"bro"}}', "my_backend", "my:str?label*", "my_user")],
        "custom string, backend string, str_label string, user string",
    )
    assert S.build_labels(df).first().labels == {
        "hello": "world",
        "good": '{"bye":"bro"}',
        "run-backend": "my_backend",
        "run-str-label": "my_str_label_",
        "run-user": "my_user",
    }
    updates = spark.createDataFrame([(W, "run-user", "a", 1), (W, "run-user", "b", 2), (W, "n", "1", 0)], "id string, key string, val string, seq int")
    assert S.update_labels(wf, updates).where(f"id = '{W}'").first().labels == {"run-str-label": "test_label", "run-user": "b", "n": "1"}
    assert S.get_labels(wf, "bad").count() == 0
    assert S.get_label(wf, W, "run-user").first().value == "u"
    docs = spark.createDataFrame([(W, "doc")], "id string, doc string")
    assert S.get_metadata(S.find(wf, ["*"]), docs).collect()[0].doc == "doc"


def test_each_document_has_its_own_root_and_report(spark, tmp_path):
    def doc(name, root, status="Failed"):
        calls = {"m.a": [{"callRoot": f"{root}/call-a", "executionStatus": status}], "m.b": [{"callRoot": f"{root}/call-b", "executionStatus": status}]}
        return json.dumps({"status": "Failed", "calls": calls} | ({"id": name} if name else {}))

    docs = [doc("w1", "gs://o/m/w1"), doc("w1", "gs://p/m/w1", "Aborted"), doc(None, "gs://o/m/x"), doc(None, "gs://o/m/y", "Running"), json.dumps({"id": "w2"})]
    workflows = C.workflow_header(spark.createDataFrame([(d,) for d in docs], "doc string").repartition(3))
    roots = sorted(((r.id, r.workflow_root) for r in C.workflow_root(workflows).collect()), key=str)
    assert roots == sorted([("w1", "gs://o/m/w1"), ("w1", "gs://p/m/w1"), (None, None), (None, None), ("w2", None)], key=str)
    logs = spark.createDataFrame([], "path string, contents string")
    reports = C.troubleshoot(workflows, logs).collect()
    assert len(reports) == 5 and sorted(r.report.count("==== NAME=") for r in reports) == [0, 2, 2, 2, 2]
    assert sum("STATUS=Aborted" in r.report for r in reports) == sum("STATUS=Running" in r.report for r in reports) == 1
    written = sinks.write_report_documents(C.report_parts(workflows, logs), str(tmp_path / "r"))
    assert written.count() == 5 and sorted(p.read_text() for p in (tmp_path / "r").glob("*.txt")) == sorted(r.report for r in reports)


def test_members_of_calls(spark):
    doc = _three_levels()
    wanted = ["callRoot", "shardIndex"]
    key = ["id", "call_name", "parent_call_names", "ord"]
    read = lambda members: C.flatten_calls(C.workflow_header(spark.createDataFrame([(json.dumps(doc),)], "doc string"), members=members))
    some = read(wanted)
    assert sorted(some.columns) == sorted([*key, *wanted])
    assert sorted(some.select(*key, *wanted).collect()) == sorted(read(None).select(*key, *wanted).collect())
