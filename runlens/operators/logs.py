"""Workflow and task events from server logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from runlens.functions import loglines
from runlens.operators.running import SPAN, running
from runlens.session import stage


def log_events(lines: DataFrame) -> DataFrame:
    """Events of ``(seq, line)``; stateless, so it serves batch and streaming alike.

    Columns: ``seq, kind, pattern, event, workflow_id, short_id, task_name, shard_idx,
    retry, job_id``. ``(seq, pattern)`` orders events.
    """
    return lines.where(loglines.may_hold_event(F.col("line"))).select(
        "seq", F.inline(loglines.parse_log(F.col("line")))
    )


def workflow_events(events: DataFrame) -> DataFrame:
    return events.where("kind = 'workflow'").select("workflow_id", "seq", "pattern", "event")


def task_events(events: DataFrame) -> DataFrame:
    return events.where("kind = 'task'").select(
        "seq", "short_id", "task_name", "shard_idx", "retry", F.col("event").alias("status"), "job_id"
    )


def status_transitions(events: DataFrame, collapse_terminal: bool = False, span: int = SPAN) -> DataFrame:
    """Status changes ``(workflow_id, seq, pattern, status, write_metadata)``.

    Every line but a terminal one sets its own status. A terminal line gives nothing
    after a failure, ``Aborted`` directly after an abort request, else ``Succeeded``. So
    two facts about earlier lines of the workflow decide: the last non-terminal event
    and the last event of any kind. ``collapse_terminal`` keeps only the first of
    several terminal lines in a row. The events are written once and read twice, so lines are parsed once.
    """
    flow = stage(workflow_events(events))
    terminal = F.col("event") == "TERM"
    seen = running(
        flow,
        ["workflow_id"],
        "seq",
        ["pattern"],
        {"_base": ("last", F.when(~terminal, F.col("event"))), "_prev": ("last", F.col("event"))},
        inclusive=False,
        span=span,
    )
    directly_after = F.coalesce(F.col("_prev") != "TERM", F.lit(False))
    status = (
        F.when(~terminal, F.col("event"))
        .when(F.col("_base") == "Failed", None)
        .when((F.col("_base") == "Aborting") & directly_after, "Aborted")
        .otherwise("Succeeded")
    )
    out = seen.withColumn("status", status).where("status IS NOT NULL")
    if collapse_terminal:
        out = out.where(~terminal | F.coalesce(F.col("_prev") != "TERM", F.lit(True)))
    return out.select("workflow_id", "seq", "pattern", "status", terminal.alias("write_metadata"))


def current_status(transitions: DataFrame) -> DataFrame:
    """Latest status per workflow."""
    return transitions.groupBy("workflow_id").agg(
        F.max_by("status", F.struct("seq", "pattern")).alias("status"), F.max("seq").alias("seq")
    )


def subworkflows(events: DataFrame) -> DataFrame:
    """Distinct sub-workflows with the line of their first sighting."""
    found = events.where("kind = 'subworkflow'")
    return found.groupBy("workflow_id").agg(F.min("seq").alias("first_seq"))


def known_ids(events: DataFrame) -> DataFrame:
    """Workflows and sub-workflows with the line that first names them."""
    named = events.where("kind IN ('workflow', 'subworkflow')")
    return named.groupBy("workflow_id").agg(F.min("seq").alias("first_seq"))


def resolve_short_ids(tasks: DataFrame, known: DataFrame, span: int = SPAN) -> DataFrame:
    """Add ``workflow_id``: the least id known by then that starts with the task's short id.

    The answer only ever changes when a smaller id appears, so it is a running minimum
    over known ids and task lines of one short id; no task meets every known id. Both are written
    once, as they are read twice; give them from staged events so that lines are parsed once.
    """
    rows = tasks.withColumn("_known", F.lit(None).cast("string")).withColumn("_kind", F.lit(1))
    ids = known.select(
        F.substring("workflow_id", 1, 8).alias("short_id"),
        F.col("first_seq").alias("seq"),
        F.col("workflow_id").alias("_known"),
        F.lit(0).alias("_kind"),
    )
    both = stage(rows.unionByName(ids, allowMissingColumns=True))
    resolved = running(
        both, ["short_id"], "seq", ["_kind"], {"workflow_id": ("min", F.col("_known"))}, inclusive=True, span=span
    )
    return resolved.where("_kind = 1").drop("_kind", "_known")


def server_start(events: DataFrame) -> DataFrame:
    """First line at which the server reported to be up; one row, NULL if never."""
    return events.where("kind = 'server'").agg(F.min("seq").alias("first_seq"))
