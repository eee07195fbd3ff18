"""Streams over several micro-batches: current status, silence, documents under workflow roots."""

from __future__ import annotations

import datetime as dt
import json
import random
import time

import pytest
from pyspark.sql import functions as F

from runlens.operators import jobs
from runlens.sources import sinks
from runlens.streaming import logs as S

EVENTS = "seq bigint, kind string, pattern int, event string, workflow_id string"


def _arrive(spark, rows, schema, folder, k):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/part={k}")


def _run(stream, place, mode, **writer):
    out = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{place}/state").trigger(availableNow=True)
    (out.foreachBatch(writer["each"]) if "each" in writer else out.format("parquet").option("path", f"{place}/table")).start().awaitTermination()


def test_current_status_over_batches(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, "workflow", 0, rng.choice(["Submitted", "Running", "Failed", "Aborting", "TERM", "TERM"]), f"w{rng.randint(0, 9)}") for i in range(200)]
    place, changed = str(tmp_path), []
    (tmp_path / "in").mkdir()
    for k, (a, b) in enumerate([(0, 80), (80, 80), (80, 90), (90, 200)]):
        _arrive(spark, rows[a:b], EVENTS, f"{place}/in", k)
        stream = S.current_status_stream(spark.readStream.schema(EVENTS).parquet(f"{place}/in/part=*"))
        keep = S.keep_newest(f"{place}/table")

        def each(batch, batch_id, keep=keep):
            changed.append({r.workflow_id for r in batch.collect()})
            keep(batch, batch_id)

        _run(stream, place, "update", each=each)
        status, at = {}, {}
        for seq, _, _, event, key in rows[:b]:
            new = S.next_status(status.get(key), event)
            if new is not None:
                status[key], at[key] = new, seq
        got = sinks.newest(spark.read.parquet(f"{place}/table"), ["workflow_id"]).collect()
        assert {r.workflow_id: (r.status, r.seq) for r in got} == {w: (status[w], at[w]) for w in status}
    # a batch writes only what it touched
    assert changed[-2] <= {r[4] for r in rows[80:90]} and len(changed) >= 3


def test_backlog_equals_a_replay(spark, tmp_path):
    rng = random.Random(18)
    rows = [(i, "workflow", i % 3, rng.choice(["Submitted", "Running", "Failed", "Aborting", "TERM", "TERM"]), "hot" if i % 2 else f"w{rng.randint(0, 4)}") for i in range(400)]
    write = S.status_batches(str(tmp_path))
    for batch_id, (a, b) in enumerate([(0, 150), (150, 151), (151, 260), (260, 400)]):
        batch = spark.createDataFrame(rows[a:b], EVENTS)
        for _ in range(2):  # a repeated batch changes nothing
            write(batch, batch_id)
    status, want = {}, []
    for seq, _, _, event, key in rows:
        new = S.next_status(status.get(key), event)
        if new is not None:
            status[key] = new
            want.append((key, seq, new, event == "TERM"))
    got = spark.read.parquet(f"{tmp_path}/transitions").collect()
    assert sorted((r.workflow_id, r.seq, r.status, r.write_metadata) for r in got) == sorted(want)
    last = sinks.newest(spark.read.parquet(f"{tmp_path}/statuses"), ["workflow_id"]).collect()
    assert {r.workflow_id: r.status for r in last} == status


BEATS = "server string, text string, ts timestamp"
START = dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)


def _silences(beats, timeout, upto):
    out = []
    for server in {b[0] for b in beats}:
        times = sorted({b[2] for b in beats if b[0] == server})
        out += [(server, a) for a, b in zip(times, times[1:]) if (b - a).total_seconds() > timeout]
        if times[-1] + dt.timedelta(seconds=timeout, milliseconds=1) < upto:
            out.append((server, times[-1]))
    return sorted(out)


@pytest.mark.parametrize("cuts", [(0, 300), (0, 100, 101, 220, 300)])
def test_silences_do_not_depend_on_batches(spark, tmp_path, cuts):
    rng = random.Random(9)
    beats = sorted(((f"s{rng.randint(0, 6)}", "h:1\n", START + dt.timedelta(seconds=rng.randint(0, 4000))) for _ in range(300)), key=lambda b: b[2])
    place = str(tmp_path)
    (tmp_path / "in").mkdir()
    # rows of one instant come together, else the watermark of a batch would make the rest of them late
    cuts = [next((i for i in range(c, 300) if beats[i][2] != beats[i - 1][2]), 300) if c else 0 for c in cuts]
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        _arrive(spark, beats[a:b], BEATS, f"{place}/in", k)
        _run(S.silence_stream(spark.readStream.schema(BEATS).parquet(f"{place}/in/part=*"), 60_000), place, "append")
    got = spark.read.parquet(f"{place}/table").collect()
    assert sorted((r.server, r.ts.astimezone(dt.timezone.utc)) for r in got) == _silences(beats, 60, beats[-1][2])
    assert {(r.host, r.port, r.alive) for r in got} == {("h", 1, False)}


def test_silent_server_expires_without_input(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    count = iter(range(10**6))

    def beat(*servers):
        now = dt.datetime.now(dt.timezone.utc)
        k = next(count)
        spark.createDataFrame([(s, "broken" if s == "bad" else f"{s}:80\n", now) for s in servers], BEATS).coalesce(1).write.parquet(str(source / f"part={k}"))

    beat("a", "b", "bad")
    spark.createDataFrame([("old", "old:80", START)], BEATS).write.parquet(str(source / "part=old"))
    stream = S.liveness_stream(spark.readStream.schema(BEATS).parquet(str(source / "part=*")), 6000)
    query = stream.writeStream.outputMode("append").format("memory").queryName("liveness").trigger(processingTime="500 milliseconds").start()
    try:
        def rows():
            return [(r.server, r.alive) for r in spark.table("liveness").collect()]

        def wait(wanted, beating=()):
            until = time.time() + 90
            while time.time() < until and rows().count(wanted[0]) < wanted[1]:
                if beating:
                    beat(*beating)
                time.sleep(0.5)
            assert rows().count(wanted[0]) == wanted[1], rows()

        wait((("a", True), 1))
        wait((("b", False), 1), beating=("a",))
        assert ("a", False) not in rows()
        wait((("a", False), 1))
        beat("b")
        wait((("b", True), 2))
        wait((("b", False), 2))
        assert rows().count(("old", False)) == rows().count(("bad", False)) == 1 and len(rows()) == 8
        assert len({p["batchId"] for p in query.recentProgress}) >= 3
    finally:
        query.stop()


def test_host_port_texts_are_judged_alike(spark):
    texts = ["h:1", "h:1\n", "\nh:1", "h: 12 ", "h:x", "h", "a:b:1", ":1", "h:", "h:99999999999", "h:+5", "h:-1", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", jobs.parse_host_port(F.col("t")).isNotNull().alias("ok")).collect()
    assert all(r.ok == jobs.is_host_port(r.t) for r in rows)


def _doc(wid, root, n):
    return json.dumps({"id": wid, "workflowRoot": root, "n": n, "calls": {}})


def test_documents_under_workflow_roots(spark, tmp_path):
    good, other, blocked, ledger = (str(tmp_path / x) for x in ("good/w", "other", "blocked", "ledger"))
    (tmp_path / "blocked").write_text("a file where a folder should be")
    schema = "workflow_id string, workflow_root string, doc string"

    def write(batch_id, n):
        rows = [("g", good, _doc("g", good, n)), ("o", f"file://{other}", _doc("o", other, n)), ("x", blocked, _doc("x", blocked, n)), ("broken", other, "{"), ("none", None, "{}"), ("empty", other, None)]
        sinks.write_on_roots(spark.createDataFrame(rows, schema), batch_id, ledger, pause=0.0)
        return {r.workflow_id: r for r in spark.read.parquet(f"{ledger}/batch_id={batch_id}").collect()}

    for batch_id, n in ((1, "one"), (2, "two"), (2, "two"), (1, "one")):
        by = write(batch_id, n)
        assert by["x"].attempts == 4 and not by["x"].written and by["x"].error
        assert by["broken"].attempts == 4 and by["none"].attempts == by["empty"].attempts == 0
    assert by["g"].attempts == 0 and by["g"].error == "batch 2 is newer"
    assert [p.name for p in (tmp_path / "good" / "w").iterdir() if not p.name.endswith(".crc")] == ["metadata.json"]
    text = (tmp_path / "good" / "w" / "metadata.json").read_text()
    assert json.loads(text)["n"] == "two" and text == json.dumps(json.loads(_doc("g", good, "two")), indent=4) + "\n"
    assert spark.read.parquet(ledger).count() == 12
    sinks.write_on_roots(spark.createDataFrame([], schema), 9, ledger)
    assert spark.read.parquet(ledger).count() == 12


def test_terminal_batch_writes_under_the_guessed_root(spark, tmp_path):
    wid, root = "f9c26f2e-0000-4000-a000-000000000001", f"{tmp_path}/out/main/f9c26f2e-0000-4000-a000-000000000001"
    doc = json.dumps({"id": wid, "calls": {"main.a": [{"callRoot": f"{root}/call-a"}], "main.b": [{"callRoot": f"{root}/call-b"}]}})
    ended = spark.createDataFrame([(wid, True), ("w", False)], "workflow_id string, write_metadata boolean")
    seen = []
    write = S.on_terminal(lambda e: e.withColumn("doc", F.lit(doc)), f"{tmp_path}/m", callback=lambda d, b: seen.append(d.count()), ledger=f"{tmp_path}/l", pause=0.0)
    write(ended, 0)
    assert json.loads(open(f"{root}/metadata.json").read()) == json.loads(doc) and seen == [1]


def test_server_start_is_called_back_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    calls, place = [], str(tmp_path)
    for k, kinds in enumerate([["workflow"], ["server", "server"], ["server"]]):
        _arrive(spark, [(k, kind, 0, "x", "w") for kind in kinds], EVENTS, f"{place}/in", k)
        _run(S.server_start_stream(spark.readStream.schema(EVENTS).parquet(f"{place}/in/part=*")), place, "append", each=S.on_server_start(lambda: calls.append(1)))
    assert calls == [1]
