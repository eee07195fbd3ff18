"""Documents to calls, failure reports and workflow roots."""

from __future__ import annotations

from pyspark.sql import functions as F

from runlens.operators import calls as C
from runlens.plans import relations as R
from runlens.session import shared_place
from runlens.sources import readers, sinks


#: Members of a call that a report shows.
_REPORTED = ("executionStatus", "shardIndex", "returnCode", "jobId", "stdout", "stderr", "executionEvents")


def _workflows(spark, sf_dir, members=None):
    return C.workflow_header(R.documents(spark, sf_dir), members=members)


def _calls(spark, sf_dir, members=None):
    return C.flatten_calls(_workflows(spark, sf_dir, members))


def _dotted(col):
    return F.array_join(F.transform(col, lambda i: i.cast("string")), ".")


def flatten_calls(spark, sf_dir):
    return _calls(spark, sf_dir).select(
        "id",
        "call_name",
        F.array_join("parent_call_names", ",").alias("parents"),
        _dotted("ord").alias("ord"),
        F.col("executionStatus").alias("status"),
        F.col("callRoot").alias("call_root"),
    )


def workflow_header(spark, sf_dir):
    return _workflows(spark, sf_dir).select(
        "id", "status", "workflowRoot", "failures", F.size("calls").alias("n_names")
    )


def workflow_root(spark, sf_dir):
    return C.workflow_root(_workflows(spark, sf_dir, ["callRoot"]))


def call_details(spark, sf_dir):
    details = C.call_details(_calls(spark, sf_dir))
    return details.select(
        "id", "call_name", _dotted("ord").alias("ord"), "status", "shard_idx", "rc", "job_id",
        "stdout", "stderr", "stderr_background", "run_start", "run_end",
    )


def not_completed(spark, sf_dir):
    details = C.not_completed(C.call_details(_calls(spark, sf_dir)))
    return details.select("id", "call_name", _dotted("ord").alias("ord"), "status")


def task_logs(spark, sf_dir):
    """One log per order, at the path of its prep call or first align shard."""
    k = F.col("o_orderkey")
    root = F.concat(F.lit("gs://out/main/"), F.when(k % 4 == 1, "x").otherwise(""), R.uuid_of(k))
    orders = R.table(spark, sf_dir, "orders")
    return orders.select(
        F.inline(
            F.array(
                F.struct(F.concat(root, F.lit("/call-align/shard-0/stderr")).alias("path"), F.concat(F.lit("err "), "o_orderpriority").alias("contents")),
                F.struct(F.concat(root, F.lit("/call-align/shard-0/stdout")).alias("path"), F.lit("out").alias("contents")),
                F.struct(F.concat(root, F.lit("/call-sub/sub/s/call-qc/stderr.background")).alias("path"), F.lit("bg").alias("contents")),
            )
        )
    )


def troubleshoot_report(spark, sf_dir):
    return C.troubleshoot(_workflows(spark, sf_dir, _REPORTED), task_logs(spark, sf_dir), show_stdout=True)


def report_documents(spark, sf_dir):
    """Each report as a file of its own, written from sorted rows and read again."""
    place = shared_place(spark, "reports")
    workflows = _workflows(spark, sf_dir, _REPORTED).withColumn("doc_no", F.col("k"))
    sinks.write_report_documents(C.report_parts(workflows, task_logs(spark, sf_dir), show_stdout=True), place)
    files = readers.read_files(spark, place)
    return files.select(F.regexp_extract("path", r"([0-9]+)\.txt$", 1).cast("bigint").alias("k"), F.col("text").alias("report"))


def _unnamed(spark, sf_dir, members=None):
    """Documents of which some have no id and others all the same."""
    k, opening = F.col("k"), r'^\{"id":"[^"]*",'
    text = F.when(k % 7 == 0, F.regexp_replace("doc", opening, "{")).when(k % 7 == 1, F.regexp_replace("doc", opening, '{"id":"same",')).otherwise(F.col("doc"))
    return C.workflow_header(R.documents(spark, sf_dir).select(text.alias("doc")), members=members)


def unnamed_roots(spark, sf_dir):
    return C.workflow_root(_unnamed(spark, sf_dir, ["callRoot"]))


def unnamed_reports(spark, sf_dir):
    return C.troubleshoot(_unnamed(spark, sf_dir, _REPORTED), task_logs(spark, sf_dir), show_stdout=True)


def failure_class(spark, sf_dir):
    """Whole document texts as stderr; some carry a marker at the end."""
    d = F.col("doc_id")
    logs = R.table(spark, sf_dir, "documents").select(
        "doc_id", F.concat("text", F.when(d % 5 == 0, "\nKilled").when(d % 7 == 0, "\njava.lang.OutOfMemoryError").otherwise("")).alias("contents")
    )
    return C.failure_class(logs).select("doc_id", "failure_class", F.length("contents").alias("n"))


def lcp(spark, sf_dir):
    paths = R.table(spark, sf_dir, "part").select(
        "p_size", "p_type", F.concat(F.lit("/data/"), "p_type", F.lit("/"), "p_brand", F.lit("/"), "p_name").alias("path")
    )
    return C.longest_common_prefix(paths, ["p_size", "p_type"], "path")


QUERIES = {
    "flatten_calls": flatten_calls,
    "workflow_header": workflow_header,
    "workflow_root": workflow_root,
    "call_details": call_details,
    "failed_calls": not_completed,
    "troubleshoot_report": troubleshoot_report,
    "report_documents": report_documents,
    "unnamed_roots": unnamed_roots,
    "unnamed_reports": unnamed_reports,
    "failure_class": failure_class,
    "lcp": lcp,
}

_BLOCK = """
  chr(10) || '==== NAME=' || call_name || ', STATUS=' || coalesce(status, 'None') || ', PARENT=' || parents || chr(10) ||
  'SHARD_IDX=' || CAST(shard AS VARCHAR) || ', RC=' || coalesce(CAST(rc AS VARCHAR), 'None') || ', JOB_ID=' || job || chr(10) ||
  'START=' || started || ', END=9' || chr(10) ||
  'STDOUT=' || stdout || chr(10) || 'STDERR=' || coalesce(stderr, 'None') || chr(10) ||
  CASE WHEN stderr IS NOT NULL AND call_name = 'main.align' AND shard = 0
       THEN 'STDERR_CONTENTS=' || chr(10) || 'err ' || prio || chr(10) ELSE '' END ||
  CASE WHEN call_name = 'main.align' AND shard = 0 THEN 'STDOUT_CONTENTS=' || chr(10) || 'out' || chr(10) ELSE '' END ||
  CASE WHEN stderr IS NOT NULL AND call_name = 'sub.qc' THEN 'STDERR_BACKGROUND_CONTENTS=' || chr(10) || 'bg' || chr(10) ELSE '' END
"""

_UNNAMED = "CASE base.k % 7 WHEN 0 THEN NULL WHEN 1 THEN 'same' ELSE base.id END"


def _report_sql(columns: str, name: str) -> str:
    return f"""
        WITH {R.CALLS_SQL},
        bad AS (
          SELECT calls.*, o_orderpriority AS prio FROM calls JOIN orders ON o_orderkey = k
          WHERE wf_status <> 'Succeeded' AND (status IS NULL OR status NOT IN ('Done', 'Succeeded'))
        ),
        blocks AS (SELECT k, string_agg({_BLOCK}, '' ORDER BY ord) AS body FROM bad GROUP BY k)
        SELECT {columns}, '* Started troubleshooting workflow: id=' || {name} || ', status=' || wf_status || chr(10) ||
               CASE WHEN wf_status = 'Succeeded' THEN '* Workflow ran Successfully.' || chr(10)
                    ELSE CASE WHEN failed THEN '* Found failures JSON object.' || chr(10) || '[' || chr(10) || '    {{' || chr(10) ||
                                   '        "message": "boom ' || CAST(base.k AS VARCHAR) || '",' || chr(10) ||
                                   '        "causedBy": []' || chr(10) || '    }}' || chr(10) || ']' || chr(10) ELSE '' END ||
                         '* Recursively finding failures in calls (tasks)...' || chr(10) || coalesce(body, '') END AS report
        FROM base LEFT JOIN blocks ON blocks.k = base.k"""


ORACLES = {
    "flatten_calls": f"WITH {R.CALLS_SQL} SELECT id, call_name, parents, ord, status, call_root FROM calls",
    "workflow_header": f"""
        WITH {R.CALLS_SQL}
        SELECT id, wf_status AS status, CASE WHEN k % 4 = 0 THEN root END AS "workflowRoot",
               CASE WHEN failed THEN '[{{"message":"boom ' || CAST(k AS VARCHAR) || '","causedBy":[]}}]' END AS failures,
               3 AS n_names
        FROM base""",
    "workflow_root": f"""
        WITH {R.CALLS_SQL}
        SELECT id, CASE WHEN k % 4 <> 1 THEN root END AS workflow_root FROM base""",
    "call_details": f"""
        WITH {R.CALLS_SQL}
        SELECT id, call_name, ord, status, CAST(shard AS INTEGER) AS shard_idx, rc, job AS job_id, stdout, stderr,
               stderr || '.background' AS stderr_background,
               CASE WHEN job IS NOT NULL THEN started END AS run_start, CASE WHEN job IS NOT NULL THEN '9' END AS run_end
        FROM (SELECT * REPLACE (CASE WHEN call_name <> 'main.sub' THEN stderr END AS stderr) FROM calls)""",
    "failed_calls": f"""
        WITH {R.CALLS_SQL}
        SELECT id, call_name, ord, status FROM calls WHERE status IS NULL OR status NOT IN ('Done', 'Succeeded')""",
    "troubleshoot_report": _report_sql("base.id", "base.id"),
    "report_documents": _report_sql("base.k", "base.id"),
    "unnamed_reports": _report_sql(f"{_UNNAMED} AS id", f"coalesce({_UNNAMED}, 'None')"),
    "unnamed_roots": f"""
        WITH {R.CALLS_SQL}
        SELECT {_UNNAMED} AS id, CASE WHEN k % 4 = 0 OR (k % 4 <> 1 AND k % 7 > 1) THEN root END AS workflow_root FROM base""",
    "failure_class": """
        SELECT doc_id, CASE WHEN doc_id % 5 = 0 OR doc_id % 7 = 0 OR contains(text, 'Killed') OR contains(text, 'OutOfMemory')
                            THEN 'out_of_memory' ELSE 'other' END AS failure_class,
               CAST(length(text) + CASE WHEN doc_id % 5 = 0 THEN 7 WHEN doc_id % 7 = 0 THEN 27 ELSE 0 END AS INTEGER) AS n
        FROM documents""",
    "lcp": """
        WITH paths AS (SELECT p_size, p_type, '/data/' || p_type || '/' || p_brand || '/' || p_name AS path FROM part),
        cuts AS (SELECT p_size, p_type, n, count(DISTINCT left(path, n)) AS kinds, min(left(path, n)) AS pre, min(length(path)) AS short
                 FROM paths, UNNEST(range(0, 80)) AS u(n) GROUP BY ALL)
        SELECT p_size, p_type, arg_max(pre, n) AS lcp FROM cuts WHERE kinds = 1 AND n <= short GROUP BY ALL""",
}
