"""Workflow documents: headers, leaf calls at any sub-workflow depth, failure reports."""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from runlens.functions import uris

# Members of a workflow document and of a call.
CALL_SCHEMA = (
    "executionStatus STRING, shardIndex INT, attempt INT, returnCode INT, jobId STRING, "
    "stdout STRING, stderr STRING, callRoot STRING, monitoringLog STRING, "
    "runtimeAttributes MAP<STRING,STRING>, inputs STRING, "
    "executionEvents ARRAY<STRUCT<description:STRING,startTime:STRING,endTime:STRING>>, "
    "subWorkflowMetadata STRING"
)
CALLS_TYPE = f"MAP<STRING,ARRAY<STRUCT<{CALL_SCHEMA}>>>"
DOC_SCHEMA = f"id STRING, status STRING, workflowRoot STRING, failures STRING, calls {CALLS_TYPE}"
_SUB = "subWorkflowMetadata"
COMPLETED = ("Done", "Succeeded")
#: Unrolled sub-workflow levels; what nests deeper takes an expression. A level copies every row found so far.
LEVELS = 0


def _calls_type(members: Sequence[str] | None) -> str:
    """Type of a document's calls with these members only; a text that is not asked for is not made."""
    if members is None:
        return CALLS_TYPE
    fields = [f for f in T.StructType.fromDDL(CALL_SCHEMA) if f.name in (*members, _SUB)]
    return f"MAP<STRING,ARRAY<{T.StructType(fields).simpleString()}>>"


def workflow_header(docs: DataFrame, doc: str = "doc", mode: str = "FAILFAST", members: Sequence[str] | None = None) -> DataFrame:
    """Add ``id, status, workflowRoot, failures, calls`` from JSON text and drop the text.

    Object members keep their order. ``mode="PERMISSIVE"`` turns a broken document into
    NULLs instead of failing. ``members`` names the members of a call that are wanted, all by
    default; the calls of sub-workflows follow.
    """
    keep = [c for c in docs.columns if c != doc]
    schema = DOC_SCHEMA.replace(CALLS_TYPE, _calls_type(members))
    # a generator: a later filter on a member must not parse the text a second time
    return docs.select(*keep, F.inline(F.array(F.from_json(doc, schema, {"mode": mode}))))


def _item(parents: Column, ord_: Column, name: Column, call: Column) -> Column:
    return F.struct(parents.alias("_parents"), ord_.alias("_ord"), name.alias("_name"), call.alias("_call"))


def _items(calls: Column, parents: Column, ord_: Column) -> Column:
    """Array with an item per call of one document."""
    return F.flatten(
        F.transform(
            F.map_entries(calls),
            lambda entry, i: F.transform(
                entry["value"], lambda call, j: _item(parents, F.concat(ord_, F.array(i, j)), entry["key"], call)
            ),
        )
    )


def _children(item: Column, calls_type: str) -> Column:
    """Items of the calls embedded in an item."""
    nested = F.from_json(item["_call"][_SUB], f"calls {calls_type}", {"mode": "FAILFAST"})["calls"]
    return _items(nested, F.concat(item["_parents"], F.array(item["_name"])), item["_ord"])


def _unroll(item: Column, calls_type: str) -> Column:
    """All leaf items below one item, at any depth.

    A step opens the items found last, once each. The text can't nest deeper than the
    member's name occurs in it, and a step without open items costs nothing.
    """
    call = calls_type.removeprefix("MAP<STRING,ARRAY<").removesuffix(">>")
    empty_type = f"ARRAY<STRUCT<_parents:ARRAY<STRING>,_ord:ARRAY<INT>,_name:STRING,_call:{call}>>"
    empty = F.array().cast(empty_type)
    sub = lambda x: x["_call"][_SUB]
    steps = F.sequence(F.lit(0), F.size(F.split(sub(item), '"subWorkflowMetadata"')))

    def step(found: Column, _: Column) -> Column:
        return F.struct(
            F.concat(found["done"], F.filter(found["todo"], lambda x: sub(x).isNull())).alias("done"),
            F.flatten(F.transform(F.filter(found["todo"], lambda x: sub(x).isNotNull()), lambda x: F.coalesce(_children(x, calls_type), empty))).alias("todo"),
        )

    start = F.struct(empty.alias("done"), F.array(item).cast(empty_type).alias("todo"))
    return F.aggregate(steps, start, step, lambda found: F.concat(found["done"], found["todo"]))


def flatten_calls(
    workflows: DataFrame, keep: tuple[str, ...] = ("id",), levels: int = LEVELS, marker: bool = False
) -> DataFrame:
    """Leaf calls at any sub-workflow depth, one row each.

    A call with an embedded sub-workflow is replaced by that workflow's calls and a
    document without calls gives no row. All is row-local: one scan, no shuffle. An expression opens
    the calls that hold sub-workflows; ``levels`` of them can be unrolled as an ``explode`` each instead.
    ``marker`` adds one row per document with NULL ``call_name`` and empty ``ord``.

    Columns: ``keep``, ``parent_call_names``, ``call_name``, ``ord`` (document order)
    and the members of the call.
    """
    no_names, no_ord = F.array().cast("array<string>"), F.array().cast("array<int>")
    calls_type = f"MAP<STRING,ARRAY<{workflows.schema['calls'].dataType.valueType.elementType.simpleString()}>>"
    items = _items(F.col("calls"), no_names, no_ord)
    if marker:
        none = F.lit(None)
        document = _item(no_names, no_ord, none.cast("string"), none.cast(workflows.schema["calls"].dataType.valueType.elementType))
        items = F.concat(F.array(document), F.coalesce(items, F.slice(F.array(document), 1, 0)))
    # ``inline`` and not ``explode``: the optimizer prunes a chain of exploded structs wrongly,
    # losing members that only a later step uses
    rows = workflows.select(*keep, F.inline(items))
    itself = F.array(_item(F.col("_parents"), F.col("_ord"), F.col("_name"), F.col("_call")))
    sub = F.col(f"_call.{_SUB}")
    for _ in range(levels):
        nested = F.from_json(sub, f"calls {calls_type}", {"mode": "FAILFAST"})["calls"]
        children = _items(nested, F.concat("_parents", F.array("_name")), F.col("_ord"))
        rows = rows.select(*keep, F.inline(F.when(sub.isNull(), itself).otherwise(children)))
    rows = rows.select(*keep, F.inline(F.when(sub.isNull(), itself).otherwise(_unroll(itself[0], calls_type))))
    return rows.select(
        *keep,
        F.col("_parents").alias("parent_call_names"),
        F.col("_name").alias("call_name"),
        F.col("_ord").alias("ord"),
        "_call.*",
    ).drop(_SUB)


def _running_event() -> Column:
    """First execution event whose description starts with ``Running``."""
    return F.get(F.filter("executionEvents", lambda e: e["description"].startswith("Running")), F.lit(0))


def call_details(calls: DataFrame) -> DataFrame:
    """Status, shard, return code, job, log paths and the first ``Running...`` event."""
    running = _running_event()
    extra = [c for c in calls.columns if c in ("id", "call_name", "parent_call_names", "ord")]
    return calls.select(
        *extra,
        F.col("executionStatus").alias("status"),
        F.col("shardIndex").alias("shard_idx"),
        F.col("returnCode").alias("rc"),
        F.col("jobId").alias("job_id"),
        "stdout",
        "stderr",
        F.concat("stderr", F.lit(".background")).alias("stderr_background"),
        running["startTime"].alias("run_start"),
        running["endTime"].alias("run_end"),
    )


def not_completed(details: DataFrame, show_completed: bool = False) -> DataFrame:
    """Calls that did not complete; a call without status counts as not completed."""
    if show_completed:
        return details
    return details.where(F.col("status").isNull() | ~F.col("status").isin(*COMPLETED))


#: Number of a document among those that a query reads; ids may be missing or repeated.
DOC_NO = "doc_no"


def numbered(workflows: DataFrame) -> DataFrame:
    """Add ``doc_no``, a number that no other document has; one that is there stays."""
    return workflows if DOC_NO in workflows.columns else workflows.withColumn(DOC_NO, F.monotonically_increasing_id())


def workflow_root(workflows: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``(id, workflow_root)`` of each document: the given root, else one guessed from the calls' directories.

    Documents are told apart by themselves, not by their id, which may be missing or repeated. The guess is the longest common character prefix of all call roots' parents, taken
    only when its last component is the workflow id. The prefix of a set of strings is
    the prefix of its least and greatest member, so a map-side combined min/max does.
    """
    # calls of workflows with a given root need no look
    unknown = numbered(workflows).withColumn("calls", F.when(F.col("workflowRoot").isNull(), F.col("calls")))
    rows = flatten_calls(unknown, (DOC_NO, "id", "workflowRoot"), levels, marker=True)
    root = uris.workflow_root_of_call(F.col("callRoot"))
    bounds = rows.groupBy(DOC_NO).agg(
        F.max("id").alias("id"), F.max("workflowRoot").alias("_given"), F.min(root).alias("_lo"), F.max(root).alias("_hi")
    )
    guess = bounds.withColumn("_guess", uris.common_prefix(F.col("_lo"), F.col("_hi")))
    accepted = F.when(uris.workflow_id_of_root(F.col("_guess")) == F.col("id"), F.col("_guess"))
    return guess.select("id", F.coalesce("_given", accepted).alias("workflow_root"))


def longest_common_prefix(df: DataFrame, keys: list[str], col: str, name: str = "lcp") -> DataFrame:
    """Longest common character prefix of a string column per group."""
    bounds = df.groupBy(*keys).agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    return bounds.select(*keys, uris.common_prefix(F.col("_lo"), F.col("_hi")).alias(name))


def attach_task_logs(details: DataFrame, logs: DataFrame, show_stdout: bool = False) -> DataFrame:
    """Left-join the contents of stderr, its background twin and (on request) stdout.

    ``logs`` holds ``(path, contents)``, one row per path.
    """
    out = details
    wanted = [("stderr", "stderr_contents"), ("stderr_background", "background_contents")]
    if show_stdout:
        wanted.append(("stdout", "stdout_contents"))
    for path, contents in wanted:
        side = logs.select(F.col("path").alias(path), F.col("contents").alias(contents))
        out = out.join(side, path, "left")
    if not show_stdout:
        out = out.withColumn("stdout_contents", F.lit(None).cast("string"))
    return out


# Default markers of a task killed for lack of memory.
OUT_OF_MEMORY_KEYS = ("OutOfMemory", "Killed")


def failure_class(task_logs: DataFrame, keys=OUT_OF_MEMORY_KEYS, contents: str = "contents") -> DataFrame:
    """Add ``failure_class``: ``out_of_memory`` where the text holds one of the markers."""
    if isinstance(keys, str):
        keys = [k for k in keys.replace(",", " ").split() if k]
    found = F.lit(False)
    for key in keys:
        found = found | F.coalesce(F.col(contents).contains(key), F.lit(False))
    return task_logs.withColumn("failure_class", F.when(found, "out_of_memory").otherwise("other"))


@F.pandas_udf(T.StringType())
def _indented(values: pd.Series) -> pd.Series:
    return values.map(lambda s: None if s is None else json.dumps(json.loads(s), indent=4))


def _text(col: Column | str) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("None"))


# Fixed values below: sentences of a report's header.
def report_parts(
    workflows: DataFrame,
    logs: DataFrame,
    show_completed: bool = False,
    show_stdout: bool = False,
    levels: int = LEVELS,
) -> DataFrame:
    """Failure report as ordered pieces of text: ``(doc_no, id, ord, part, text)``, one report per document.

    The header has an empty ``ord``; each inspected call adds a block and the contents of
    its log files, in document order. One pass over the documents and one join with
    ``logs(path, contents)``. Calls of succeeded workflows are never unfolded.
    """
    succeeded = F.coalesce(F.col("status") == "Succeeded", F.lit(False))
    # the values below count as "no failures"
    has_failures = F.coalesce(~F.col("failures").isin("", "[]", "{}", "null", "0", "false"), F.lit(False))
    header = F.concat(
        F.lit("* Started troubleshooting workflow: id="), _text("id"), F.lit(", status="), _text("status"), F.lit("\n"),
        F.when(succeeded, "* Workflow ran Successfully.\n").otherwise(
            F.concat(
                F.when(
                    has_failures, F.concat(F.lit("* Found failures JSON object.\n"), F.col("_failures"), F.lit("\n"))
                ).otherwise(""),
                F.lit("* Recursively finding failures in calls (tasks)...\n"),
            )
        ),
    )
    prepared = numbered(workflows).withColumn("_failures", _indented(F.when(has_failures & ~succeeded, F.col("failures"))))
    prepared = prepared.withColumn("_header", header).withColumn("calls", F.when(~succeeded, F.col("calls")))
    rows = flatten_calls(prepared, (DOC_NO, "id", "_header"), levels, marker=True)
    return _with_contents(rows, F.col("call_name").isNull(), logs, show_completed, show_stdout)


def _call_block() -> Column:
    running = _running_event()
    # Layout of a call's block.
    parts: list[Column] = []
    for label, value in [
        ("\n==== NAME=", F.col("call_name")),
        (", STATUS=", F.col("executionStatus")),
        (", PARENT=", F.array_join("parent_call_names", ",")),
        ("\nSHARD_IDX=", F.col("shardIndex").cast("string")),
        (", RC=", F.col("returnCode").cast("string")),
        (", JOB_ID=", F.col("jobId")),
        ("\nSTART=", running["startTime"]),
        (", END=", running["endTime"]),
        ("\nSTDOUT=", F.col("stdout")),
        ("\nSTDERR=", F.col("stderr")),
    ]:
        parts += [F.lit(label), _text(value)]
    return F.concat(*parts, F.lit("\n"))


def _with_contents(
    rows: DataFrame, is_header: Column, logs: DataFrame, show_completed: bool, show_stdout: bool
) -> DataFrame:
    inspected = F.lit(True) if show_completed else ~F.coalesce(F.col("executionStatus").isin(*COMPLETED), F.lit(False))

    def piece(part: int, label: str, path: Column, text: Column | None = None) -> Column:
        return F.struct(
            F.lit(part).alias("part"),
            F.lit(label).alias("label"),
            path.cast("string").alias("path"),
            (F.lit(None) if text is None else text).cast("string").alias("text"),
        )

    header = piece(0, "", F.lit(None), F.col("_header"))
    pieces = [piece(0, "", F.lit(None), _call_block()), piece(1, "STDERR", F.col("stderr"))]
    if show_stdout:
        pieces.append(piece(2, "STDOUT", F.col("stdout")))
    pieces.append(piece(3, "STDERR_BACKGROUND", F.concat("stderr", F.lit(".background"))))
    wanted = F.when(is_header, F.array(header)).when(inspected, F.array(*pieces))
    long = rows.select(DOC_NO, "id", "ord", F.inline(wanted)).where("text IS NOT NULL OR path IS NOT NULL")
    # finished pieces get a key of their own, so that they do not meet in one partition
    key = F.coalesce("path", F.concat_ws("\0", F.lit(""), F.col(DOC_NO).cast("string"), F.array_join(F.transform("ord", lambda i: i.cast("string")), ".")))
    contents = logs.select(F.col("path").alias("_key"), "contents")
    joined = long.withColumn("_key", key).join(contents, "_key", "left")
    read = F.concat("label", F.lit("_CONTENTS=\n"), "contents", F.lit("\n"))
    return joined.select(DOC_NO, "id", "ord", "part", F.coalesce("text", read).alias("text")).where("text IS NOT NULL")


def troubleshoot(
    workflows: DataFrame,
    logs: DataFrame,
    show_completed: bool = False,
    show_stdout: bool = False,
    levels: int = LEVELS,
) -> DataFrame:
    """``(id, report)``: the whole report of each document as one text value.

    A report that is too long for one value is written by :func:`runlens.sources.sinks.write_report_documents`.
    """
    parts = report_parts(workflows, logs, show_completed, show_stdout, levels)
    ordered = F.sort_array(F.collect_list(F.struct("ord", "part", "text")))
    whole = F.array_join(F.transform(ordered, lambda p: p["text"]), "").alias("report")
    return parts.groupBy(DOC_NO).agg(F.max("id").alias("id"), whole).drop(DOC_NO)
