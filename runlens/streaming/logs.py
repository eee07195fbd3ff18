"""Log streams: events, status machine, current status, sub-workflows, metadata on completion, liveness."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from runlens.functions import loglines
from runlens.operators import calls, jobs, logs
from runlens.session import stage
from runlens.sources import sinks


def read_log_stream(
    spark: SparkSession,
    path: str,
    wanted: Callable[[Column], Column] | None = loglines.may_hold_event,
    **options: str,
) -> DataFrame:
    """``(seq, line)`` of log files as they arrive; ``seq`` is a text that sorts by file, then line.

    Only ``wanted`` lines are kept (by default those that can hold an event). Lines keep
    the order of their split, so counting them per task orders them; large files may
    still be read in several splits.
    """
    rows = spark.readStream.options(**options).text(path)
    if wanted is not None:
        rows = rows.where(wanted(F.col("value")))
    place = F.concat_ws(
        "|",
        F.lpad(F.unix_micros("_metadata.file_modification_time").cast("string"), 20, "0"),
        F.col("_metadata.file_path"),
        F.lpad(F.col("_metadata.file_block_start").cast("string"), 20, "0"),
    )

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = 0
        for batch in batches:
            numbers = pd.Series(range(count, count + len(batch)), index=batch.index)
            count += len(batch)
            yield pd.DataFrame({"seq": batch["place"] + "|" + numbers.map("{:020d}".format), "line": batch["line"]})

    return rows.select(place.alias("place"), F.col("value").alias("line")).mapInPandas(number, "seq string, line string")


def log_event_stream(lines: DataFrame) -> DataFrame:
    """Events of a line stream; the batch operator is stateless and serves as is."""
    return logs.log_events(lines)


def next_status(previous: str | None, event: str) -> str | None:
    """Status that an event sets, or None when it changes nothing."""
    if event != "TERM":
        return event
    if previous == "Failed":
        return None
    return "Aborted" if previous == "Aborting" else "Succeeded"


def status_stream(events: DataFrame) -> DataFrame:
    """Status changes ``(workflow_id, seq, pattern, status, write_metadata)`` of an event stream.

    State is one status per workflow. Only status lines reach it, and those of one
    workflow in one micro-batch are ordered by ``(seq, pattern)`` first; the source's rate
    options (``maxFilesPerTrigger``, ``maxBytesPerTrigger``) bound that set. For a backlog
    use the batch operator, which splits a workflow's events over tasks.
    """
    seq_type = dict(events.dtypes)["seq"]
    schema = f"workflow_id string, seq {seq_type}, pattern int, status string, write_metadata boolean"

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values(["seq", "pattern"], kind="stable")
        status = state.get[0] if state.exists else None
        out = []
        for seq, pattern, event in zip(rows["seq"], rows["pattern"], rows["event"]):
            new = next_status(status, event)
            if new is not None:
                status = new
                out.append((key[0], seq, pattern, new, event == "TERM"))
        if status is not None:
            state.update((status,))
        yield pd.DataFrame(out, columns=["workflow_id", "seq", "pattern", "status", "write_metadata"])

    return (
        logs.workflow_events(events)
        .groupBy("workflow_id")
        .applyInPandasWithState(advance, schema, "status string", "append", GroupStateTimeout.NoTimeout)
    )


# pattern number of a status that a workflow had before a batch: it comes after all events of its line
_SEED = 2**31 - 1


def status_batches(root: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for a stream of events with integral ``seq``: the status machine over any backlog.

    :func:`status_stream` orders all of a workflow's events of a micro-batch in one task. Here the batch
    operator works on them, which splits a workflow over tasks; the status that a workflow had is put before its
    events. Transitions go to ``root/transitions``, statuses to ``root/statuses``, both by batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        events = stage(logs.workflow_events(batch))
        had = sinks.read_before(spark, f"{root.rstrip('/')}/statuses", batch_id, "workflow_id string, status string, seq long")
        earlier = sinks.newest(had, ["workflow_id"]).join(events.select("workflow_id").distinct(), "workflow_id", "left_semi")
        # after a terminal status, the next terminal line is like one after running
        known = F.when(F.col("status").isin("Aborted", "Succeeded"), "Running").otherwise(F.col("status"))
        seeds = earlier.select("workflow_id", "seq", F.lit(_SEED).alias("pattern"), known.alias("event"))
        both = events.unionByName(seeds).withColumn("kind", F.lit("workflow"))
        told = logs.status_transitions(both)
        out = stage(told.where(F.col("pattern") != _SEED))
        sinks.write_batch(out, batch_id, f"{root.rstrip('/')}/transitions")
        sinks.write_batch(logs.current_status(out), batch_id, f"{root.rstrip('/')}/statuses")

    return write


def subworkflow_stream(events: DataFrame) -> DataFrame:
    """Each sub-workflow once, when it is first seen."""
    return events.where("kind = 'subworkflow'").select("workflow_id", "seq").dropDuplicates(["workflow_id"])


def current_status_stream(events: DataFrame) -> DataFrame:
    """Status of each workflow that a micro-batch changed: ``(workflow_id, status, seq)``, output mode ``update``.

    The state is the status and its line, so only the workflows of a batch give rows. Write
    them with :func:`keep_newest` to have the table of all.
    """
    seq_type = dict(events.dtypes)["seq"]
    schema = f"workflow_id string, status string, seq {seq_type}"

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values(["seq", "pattern"], kind="stable")
        status, at = state.get if state.exists else (None, None)
        for seq, event in zip(rows["seq"], rows["event"]):
            new = next_status(status, event)
            if new is not None:
                status, at = new, seq
        if status is None:
            return
        at = at if isinstance(at, str) else int(at)
        state.update((status, at))
        yield pd.DataFrame([(key[0], status, at)], columns=["workflow_id", "status", "seq"])

    return (
        logs.workflow_events(events)
        .groupBy("workflow_id")
        .applyInPandasWithState(advance, schema, f"status string, seq {seq_type}", "update", GroupStateTimeout.NoTimeout)
    )


def keep_newest(root: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function of a keyed table: read it with :func:`runlens.sources.sinks.newest`."""
    return lambda batch, batch_id: sinks.write_batch(batch, batch_id, root)


def on_terminal(
    fetch: Callable[[DataFrame], DataFrame],
    root: str,
    subworkflows: Callable[[], DataFrame] | None = None,
    callback: Callable[[DataFrame, int], None] | None = None,
    ledger: str | None = None,
    pause: float = sinks.PAUSE,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: store the documents of workflows that just ended.

    ``fetch`` maps ``(workflow_id)`` rows to ``(workflow_id, doc)``. ``subworkflows``
    gives the ids to skip when sub-workflows are embedded in their parent's document.
    With ``ledger`` each document is also written under its workflow's own root, and the
    attempts are recorded there. ``callback`` gets the documents of a batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        ended = batch.where("write_metadata").select("workflow_id").distinct()
        if subworkflows is not None:
            ended = ended.join(subworkflows(), "workflow_id", "left_anti")
        docs = fetch(ended)
        sinks.write_metadata(docs, batch_id, root)
        stored = docs.sparkSession.read.schema(docs.schema).parquet(sinks.batch_folder(root, batch_id))
        if ledger is not None:
            headers = calls.workflow_header(stored.withColumn("text", F.col("doc")), mode="PERMISSIVE").withColumn("id", F.col("workflow_id"))
            roots = calls.workflow_root(headers).withColumnRenamed("id", "workflow_id")
            sinks.write_on_roots(stored.join(roots, "workflow_id", "left"), batch_id, ledger, pause=pause)
        if callback is not None:
            callback(stored, batch_id)

    return write


def server_start_stream(events: DataFrame) -> DataFrame:
    """``(seq)`` of the line by which the server is first seen to be up; one row in all."""
    return events.where("kind = 'server'").select("kind", "seq").dropDuplicates(["kind"]).select("seq")


def on_server_start(callback: Callable[[], None]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for :func:`server_start_stream`: calls back once, when the server is up."""

    def call(batch: DataFrame, batch_id: int) -> None:
        if batch.count():  # the whole batch, as its state has to be written
            callback()

    return call


def alive_stream(heartbeats: DataFrame) -> DataFrame:
    """Last write per server of a heartbeat stream, for output mode ``complete`` or ``update``.

    Compare its ``ts`` with the clock when it is read, as :func:`runlens.operators.jobs.alive` does.
    """
    return jobs.latest_heartbeats(heartbeats)


def silence_stream(heartbeats: DataFrame, timeout_ms: int = jobs.HEARTBEAT_TIMEOUT_MS, delay: str = "0 seconds") -> DataFrame:
    """``(server, host, port, ts, alive)`` each time a server falls silent, by the heartbeats' own clock.

    A heartbeat expires when the next of its server comes more than the timeout later, or when the
    watermark (greatest ``ts`` less ``delay``) passes it without one. So the rows don't depend on how
    heartbeats are dealt to micro-batches, as long as none comes later than ``delay``.
    """
    late = heartbeats.withWatermark("ts", delay)

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        at, text, pending = state.get if state.exists else (None, None, False)
        expired = []
        if not state.hasTimedOut:
            beats = pd.concat(list(batches))
            micros = beats["ts"].astype("datetime64[us, UTC]").astype("int64") if beats["ts"].dt.tz is not None else beats["ts"].astype("datetime64[us]").astype("int64")
            for new, said in sorted(zip(micros.tolist(), beats["text"].tolist()), key=lambda b: (b[0], b[1] or "")):
                if at is not None and new <= at:
                    continue
                if pending and new - at > timeout_ms * 1000:
                    expired.append((key[0], text, at))
                at, text, pending = new, said, True
        due = at // 1000 + timeout_ms + 1
        if pending and (state.hasTimedOut or due <= state.getCurrentWatermarkMs()):
            expired.append((key[0], text, at))
            pending = False
        state.update((at, text, pending))
        if pending:
            state.setTimeoutTimestamp(due)
        yield pd.DataFrame(expired, columns=["server", "text", "at"])

    server = dict(heartbeats.dtypes)["server"]
    found = late.groupBy("server").applyInPandasWithState(
        step, f"server {server}, text string, at long", "at long, text string, pending boolean", "append", GroupStateTimeout.EventTimeTimeout
    )
    return _told(found.withColumn("alive", F.lit(False)))


def liveness_stream(heartbeats: DataFrame, timeout_ms: int = jobs.HEARTBEAT_TIMEOUT_MS) -> DataFrame:
    """``(server, host, port, ts, alive)`` when a server comes up, falls silent or comes back, by the clock.

    A timer per server fires without any input, so a server that stops writing gives one row when
    its last heartbeat expires. A text that is no ``host:port`` is not alive.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        at, text, was = state.get if state.exists else (None, None, None)
        if not state.hasTimedOut:
            beats = pd.concat(list(batches))
            last = beats.loc[beats["ts"].idxmax()]
            new = int(last["ts"].timestamp() * 1_000_000)
            if at is None or new >= at:
                at, text = new, last["text"]
        left = at // 1000 + timeout_ms - state.getCurrentProcessingTimeMs()
        alive = not state.hasTimedOut and left >= 0 and jobs.is_host_port(text)
        state.update((at, text, alive))
        if alive:
            state.setTimeoutDuration(left + 1)
        changed = [(key[0], text, at, alive)] if alive != was else []
        yield pd.DataFrame(changed, columns=["server", "text", "at", "alive"])

    server = dict(heartbeats.dtypes)["server"]
    found = heartbeats.groupBy("server").applyInPandasWithState(
        step, f"server {server}, text string, at long, alive boolean", "at long, text string, alive boolean", "append", GroupStateTimeout.ProcessingTimeTimeout
    )
    return _told(found)


def _told(found: DataFrame) -> DataFrame:
    parsed = found.withColumn("_hp", jobs.parse_host_port(F.col("text")))
    return parsed.select("server", F.col("_hp.host").alias("host"), F.col("_hp.port").alias("port"), F.timestamp_micros("at").alias("ts"), "alive")
