from __future__ import annotations

import random

from pyspark.sql import functions as F

from runlens.operators import logs as G
from runlens.operators.running import running
from runlens.sources import sinks
from runlens.streaming import logs as S

U = "f9c26f2e-f550-4748-a650-5d0d4cab9f3a"
V = "f9c26f2e-0000-4748-a650-5d0d4cab9f3a"
LINES = {
    "Submitted": f"x workflow {U} submitted",
    "Running": f"y started WorkflowActor-{U}",
    "Failed": f"Workflow {U} failed (during x)",
    "Aborting": f"Abort requested for workflow {U}.",
    "TERM": f"WorkflowActor-{U} is in a terminal state: z",
    "TERM2": f"Workflow actor for {U} completed with status 'Failed'",
}


def _lines(spark, lines, start=0):
    return spark.createDataFrame([(i + start, line) for i, line in enumerate(lines)], "seq bigint, line string")


def _statuses(df):
    return [r.status for r in df.orderBy("seq", "pattern").collect()]


def test_sequences(spark):
    cases = [
        (["Submitted", "Running", "TERM"], ["Submitted", "Running", "Succeeded"]),
        (["Submitted", "Failed", "TERM"], ["Submitted", "Failed"]),
        (["Running", "Aborting", "TERM"], ["Running", "Aborting", "Aborted"]),
        (["Aborting", "TERM", "TERM2"], ["Aborting", "Aborted", "Succeeded"]),
        (["TERM"], ["Succeeded"]),
        (["TERM", "TERM"], ["Succeeded", "Succeeded"]),
    ]
    for given, want in cases:
        events = G.log_events(_lines(spark, [LINES[g] for g in given]))
        assert _statuses(G.status_transitions(events)) == want
    events = G.log_events(_lines(spark, [LINES["Aborting"], LINES["TERM"], LINES["TERM2"]]))
    assert _statuses(G.status_transitions(events, collapse_terminal=True)) == ["Aborting", "Aborted"]


def test_one_line_with_several_events_keeps_pattern_order(spark):
    events = G.log_events(_lines(spark, [f"{LINES['Aborting']} {LINES['TERM']} {LINES['Submitted']}"]))
    assert _statuses(G.status_transitions(events)) == ["Submitted", "Aborting", "Aborted"]


def test_task_events(spark):
    lines = [
        "[UUID(f9c26f2e)main.t1:NA:1]: job id: 55",
        "[UUID(f9c26f2e)main.t1:3:2]: Status change from - to Running",
        "[UUID(f9c26f2e)]: Job results retrieved (CallCached): 'main.t1' (scatter index: None, attempt 1)",
        "[UUID(F9C26F2E)main.t1:3:2]: Status change from - to Running",
        "nothing",
        "Cromwell 82 service started on 0:0",
        f"a {U}-SubWorkflowActor-SubWorkflow-b",
    ]
    events = G.log_events(_lines(spark, lines))
    got = [tuple(r) for r in G.task_events(events).orderBy("seq").collect()]
    assert got == [
        (0, "f9c26f2e", "main.t1", -1, 0, "Started", "55"),
        (1, "f9c26f2e", "main.t1", 3, 1, "Running", None),
        (2, "f9c26f2e", "main.t1", -1, 0, "CallCached", None),
    ]
    assert G.server_start(events).first().first_seq == 5
    assert [tuple(r) for r in G.subworkflows(events).collect()] == [(U, 6)]


def test_short_ids_resolve_to_the_least_id_known_by_then(spark):
    lines = [
        "[UUID(f9c26f2e)main.t1:NA:1]: job id: 1",
        LINES["Submitted"],
        "[UUID(f9c26f2e)main.t1:NA:1]: job id: 2",
        f"a {V}-SubWorkflowActor-SubWorkflow-b",
        "[UUID(f9c26f2e)main.t1:NA:1]: job id: 3",
    ]
    events = G.log_events(_lines(spark, lines))
    for span in (1, 2, 1000):
        out = G.resolve_short_ids(G.task_events(events), G.known_ids(events), span).orderBy("seq").collect()
        assert [r.workflow_id for r in out] == [None, U, V], span


def _simulate(events):
    """Direct replay of the rules, one line at a time."""
    status, out = {}, []
    for seq, key, event in events:
        new = S.next_status(status.get(key), event)
        if new is not None:
            status[key] = new
            out.append((key, seq, new, event == "TERM"))
    return sorted(out)


def test_status_machine_equals_a_replay_with_a_hot_workflow(spark):
    rng = random.Random(3)
    rows = []
    for seq in range(6000):
        key = "hot" if rng.random() < 0.4 else f"w{rng.randint(0, 300)}"
        rows.append((seq * 3, key, rng.choice(["Submitted", "Running", "Failed", "Aborting", "TERM", "TERM", "TERM"])))
    events = spark.createDataFrame(
        [("workflow", 0, e, k, s) for s, k, e in rows], "kind string, pattern int, event string, workflow_id string, seq bigint"
    )
    want = _simulate(rows)
    for span in (1, 7, 500, 10**6):
        got = sorted(
            (r.workflow_id, r.seq, r.status, r.write_metadata) for r in G.status_transitions(events, span=span).collect()
        )
        assert got == want, span
    latest = {k: s for k, _, s, _ in sorted(want, key=lambda w: w[1])}
    assert {r.workflow_id: r.status for r in G.current_status(G.status_transitions(events)).collect()} == latest


def test_running_aggregates(spark):
    rng = random.Random(5)
    rows = [("k" if rng.random() < 0.5 else "l", rng.randint(-50, 50), i, rng.choice([None, rng.randint(0, 99)])) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, seq bigint, tie int, v int")
    kinds = {"a": ("min", F.col("v")), "b": ("max", F.col("v")), "c": ("sum", F.col("v")), "d": ("last", F.col("v"))}
    functions = {"a": min, "b": max, "c": sum, "d": lambda vs: vs[-1]}
    for inclusive in (True, False):
        for span in (1, 9, 1000):
            out = running(df, ["k"], "seq", ["tie"], kinds, inclusive, span).collect()
            assert len(out) == len(rows)
            for r in out:
                before = sorted((s, t, v) for k, s, t, v in rows if k == r.k and ((s, t) < (r.seq, r.tie) or (inclusive and t == r.tie)))
                values = [v for _, _, v in before if v is not None]
                for name, fn in functions.items():
                    assert r[name] == (fn(values) if values else None), (name, span)


def test_streams_keep_state_over_batches(spark, tmp_path):
    source, table, state, docs = (str(tmp_path / n) for n in ("in", "out", "state", "docs"))
    batches = [["Submitted", "Running"], ["Aborting", "TERM"], ["TERM2"]]
    seen = []
    for i, names in enumerate(batches):
        path = tmp_path / "in"
        path.mkdir(exist_ok=True)
        (path / f"{i}.log").write_text("\n".join(["noise", *[LINES[n] for n in names]]) + "\n")
        stream = S.status_stream(S.log_event_stream(S.read_log_stream(spark, source)))
        fetch = lambda ended: ended.withColumn("doc", F.concat(F.lit("doc of "), "workflow_id"))
        write = S.on_terminal(fetch, docs, callback=lambda d, b: seen.append((b, d.count())))

        def both(batch, batch_id, write=write):
            batch.write.mode("append").parquet(table)
            write(batch, batch_id)

        stream.writeStream.foreachBatch(both).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    got = [(r.status, r.write_metadata) for r in spark.read.parquet(table).orderBy("seq").collect()]
    assert got == [("Submitted", False), ("Running", False), ("Aborting", False), ("Aborted", True), ("Succeeded", True)]
    assert [n for _, n in seen] == [0, 1, 1]
    latest = sinks.latest_metadata(spark.read.parquet(docs)).collect()
    assert [tuple(r) for r in latest] == [(U, f"doc of {U}")]


def test_metadata_of_a_repeated_batch_is_replaced_and_subworkflows_skipped(spark, tmp_path):
    ended = spark.createDataFrame([(U, True), (V, True), ("w", False)], "workflow_id string, write_metadata boolean")
    fetch = lambda df: df.withColumn("doc", F.lit("d"))
    skip = lambda: spark.createDataFrame([(V,)], "workflow_id string")
    write = S.on_terminal(fetch, str(tmp_path / "m"), subworkflows=skip)
    write(ended, 7)
    write(ended, 7)
    rows = spark.read.parquet(str(tmp_path / "m")).collect()
    assert [(r.workflow_id, r.batch_id) for r in rows] == [(U, 7)]


def test_subworkflow_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    line = f"{V}-SubWorkflowActor-SubWorkflow"
    (tmp_path / "in" / "a.log").write_text(f"{line}\n{line}\n{line.replace('f9', 'a9')}\n")
    found = S.subworkflow_stream(S.log_event_stream(S.read_log_stream(spark, str(tmp_path / "in"))))
    query = (
        found.writeStream.format("parquet").option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "s"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "o")).count() == 2
