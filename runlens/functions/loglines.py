"""Events in the lines of a workflow server's log.

Every line is tried against every pattern, so one line can carry several events. A
cheap ``contains`` on a literal of the pattern guards each regular expression: most
lines of a server log match none, and then no expression is evaluated.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Only "\n" ends a line, and classes are Unicode-aware.
FLAGS = "(?dU)"

# Log line patterns.
UUID = r"(\b[0-9a-f]{8}\b-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-\b[0-9a-f]{12}\b)"
TASK = r"\[UUID\((\b[0-9a-f]{8})\)(.+):(.+):(\d+)\]: "
WORKFLOW_PATTERNS = [  # (event, literal that must occur, pattern)
    ("Submitted", "workflow ", rf"workflow {UUID} submitted"),
    ("Running", "started WorkflowActor-", rf"started WorkflowActor-{UUID}"),
    ("Failed", "Workflow ", rf"Workflow {UUID} failed"),
    ("Aborting", "Abort requested for workflow ", rf"Abort requested for workflow {UUID}\."),
    ("TERM", "is in a terminal state", rf"WorkflowActor-{UUID} is in a terminal state"),
    ("TERM", "Workflow actor for ", rf"Workflow actor for {UUID} completed with status"),
]
TASK_START = TASK + r"job id: (.+)"
TASK_STATUS_CHANGE = TASK + r"Status change from (.+) to (.+)"
TASK_CALL_CACHED = (
    r"\[UUID\((\b[0-9a-f]{8})\)\]: Job results retrieved \(CallCached\): "
    r"\'(.+)\' \(scatter index: (.+), attempt (\d+)\)"
)
SUBWORKFLOW = rf"{UUID}-SubWorkflowActor-SubWorkflow"
SERVER_START = r"Cromwell \d+ service started on"

EVENT_TYPE = (
    "struct<kind:string,pattern:int,event:string,workflow_id:string,short_id:string,"
    "task_name:string,shard_idx:int,retry:int,job_id:string>"
)


def _group(line: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(line, FLAGS + pattern, group)


def _event(kind: str, pattern: int, event: Column, **fields: Column) -> Column:
    def text(name: str) -> Column:
        return fields.get(name, F.lit(None)).cast("string").alias(name)

    return F.struct(
        F.lit(kind).alias("kind"),
        F.lit(pattern).alias("pattern"),
        event.alias("event"),
        text("workflow_id"),
        text("short_id"),
        text("task_name"),
        fields.get("shard_idx", F.lit(None)).cast("int").alias("shard_idx"),
        fields.get("retry", F.lit(None)).cast("int").alias("retry"),
        text("job_id"),
    )


def _when_found(line: Column, literal: str, pattern: str, event: Column) -> Column:
    return F.when(line.contains(literal), F.when(line.rlike(FLAGS + pattern), event))


def task_event(line: Column) -> Column:
    """Task event of a line: a status change wins over a call-cache hit, which wins over a start.

    A scatter index that is no integer means "not scattered" (-1); the retry count is
    the attempt minus one; only a start carries a job id.
    """
    def fields(pattern: str, name: int, shard: int, attempt: int) -> dict[str, Column]:
        return {
            "short_id": _group(line, pattern, 1),
            "task_name": _group(line, pattern, name),
            "shard_idx": F.coalesce(F.trim(_group(line, pattern, shard)).try_cast("int"), F.lit(-1)),
            "retry": _group(line, pattern, attempt).try_cast("int") - 1,
        }

    changed = _event(
        "task", 20, _group(line, TASK_STATUS_CHANGE, 6), **fields(TASK_STATUS_CHANGE, 2, 3, 4)
    )
    cached = _event("task", 21, F.lit("CallCached"), **fields(TASK_CALL_CACHED, 2, 3, 4))
    started = _event(
        "task", 22, F.lit("Started"), **fields(TASK_START, 2, 3, 4), job_id=_group(line, TASK_START, 5)
    )
    return F.when(
        line.contains("[UUID("),
        F.coalesce(
            _when_found(line, "]: Status change from ", TASK_STATUS_CHANGE, changed),
            _when_found(line, "]: Job results retrieved (CallCached)", TASK_CALL_CACHED, cached),
            _when_found(line, "]: job id: ", TASK_START, started),
        ),
    )


def parse_log(line: Column) -> Column:
    """All events of a line, in pattern order, as an array of :data:`EVENT_TYPE`."""
    found = [
        _when_found(
            line, literal, pattern, _event("workflow", i, F.lit(event), workflow_id=_group(line, pattern, 1))
        )
        for i, (event, literal, pattern) in enumerate(WORKFLOW_PATTERNS)
    ]
    found.append(
        _when_found(
            line,
            "-SubWorkflowActor-SubWorkflow",
            SUBWORKFLOW,
            _event("subworkflow", 10, F.lit("Found"), workflow_id=_group(line, SUBWORKFLOW, 1)),
        )
    )
    found.append(task_event(line))
    found.append(
        _when_found(line, "service started on", SERVER_START, _event("server", 30, F.lit("ServerStarted")))
    )
    return F.array_compact(F.array(*found))


def may_hold_event(line: Column) -> Column:
    """Literal pre-filter: false only for lines that no pattern can match."""
    literals = [literal for _, literal, _ in WORKFLOW_PATTERNS]
    literals += ["[UUID(", "-SubWorkflowActor-SubWorkflow", "service started on"]
    out = F.lit(False)
    for literal in dict.fromkeys(literals):
        out = out | line.contains(literal)
    return out
