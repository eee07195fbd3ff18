"""Events, status machine and id resolution over server logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from runlens.operators import logs as G
from runlens.plans import relations as R
from runlens.session import stage


def _events(spark, sf_dir):
    return G.log_events(R.log_lines(spark, sf_dir))


def log_events(spark, sf_dir):
    return G.workflow_events(_events(spark, sf_dir)).select("workflow_id", "seq", "event")


def status_transitions(spark, sf_dir):
    return G.status_transitions(_events(spark, sf_dir)).select("workflow_id", "seq", "status", "write_metadata")


def status_collapsed(spark, sf_dir):
    out = G.status_transitions(_events(spark, sf_dir), collapse_terminal=True)
    return out.select("workflow_id", "seq", "status")


def current_status(spark, sf_dir):
    return G.current_status(G.status_transitions(_events(spark, sf_dir))).select("workflow_id", "status", "seq")


def task_events(spark, sf_dir):
    return G.task_events(_events(spark, sf_dir))


def shortid_resolve(spark, sf_dir):
    events = stage(_events(spark, sf_dir).where("kind <> 'server'"))
    resolved = G.resolve_short_ids(G.task_events(events), G.known_ids(events))
    return resolved.select("seq", "short_id", "task_name", "workflow_id")


def subworkflow_first_seen(spark, sf_dir):
    return G.subworkflows(_events(spark, sf_dir))


def known_ids(spark, sf_dir):
    return G.known_ids(_events(spark, sf_dir))


def server_start(spark, sf_dir):
    return G.server_start(_events(spark, sf_dir))


def event_counts(spark, sf_dir):
    """Events of all kinds over the whole texts of documents and conversations, which hold none, and the log."""
    texts = R.table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("line"))
    turns = R.table(spark, sf_dir, "conversations").select(F.explode(F.split("text", "\n")).alias("line"))
    noise = texts.unionByName(turns).select(F.lit(-1).cast("bigint").alias("seq"), "line")
    events = G.log_events(R.log_lines(spark, sf_dir).unionByName(noise))
    return events.groupBy("kind").agg(F.count("*").alias("n"))


QUERIES = {
    "log_events": log_events,
    "status_transitions": status_transitions,
    "status_collapsed": status_collapsed,
    "current_status": current_status,
    "task_events": task_events,
    "shortid_resolve": shortid_resolve,
    "subworkflow_first_seen": subworkflow_first_seen,
    "known_ids": known_ids,
    "server_start": server_start,
    "event_counts": event_counts,
}

_KNOWN = """known AS (
  SELECT workflow_id, min(seq) AS first_seq FROM (
    SELECT workflow_id, seq FROM flow UNION ALL SELECT workflow_id, first_seq FROM subs) GROUP BY 1)"""

ORACLES = {
    "log_events": f"WITH {R.EVENTS_SQL} SELECT workflow_id, seq, event FROM flow",
    "status_transitions": f"WITH {R.EVENTS_SQL} SELECT workflow_id, seq, status, write_metadata FROM transitions",
    "status_collapsed": f"""
        WITH {R.EVENTS_SQL}
        SELECT workflow_id, seq, status FROM transitions WHERE NOT (write_metadata AND nth > 1)""",
    "current_status": f"""
        WITH {R.EVENTS_SQL}
        SELECT workflow_id, status, seq FROM transitions t
        WHERE seq = (SELECT max(seq) FROM transitions u WHERE u.workflow_id = t.workflow_id)""",
    "task_events": f"WITH {R.EVENTS_SQL} SELECT seq, short_id, task_name, shard_idx, retry, status, job_id FROM tasks",
    "shortid_resolve": f"""
        WITH {R.EVENTS_SQL}, {_KNOWN}
        SELECT seq, short_id, task_name, min(workflow_id) AS workflow_id
        FROM tasks LEFT JOIN known ON starts_with(workflow_id, short_id) AND first_seq <= seq GROUP BY ALL""",
    "subworkflow_first_seen": f"WITH {R.EVENTS_SQL} SELECT workflow_id, first_seq FROM subs",
    "known_ids": f"WITH {R.EVENTS_SQL}, {_KNOWN} SELECT workflow_id, first_seq FROM known",
    "server_start": "SELECT min(event_id * 2 + 1) AS first_seq FROM events WHERE event_id % 6 = 4",
    "event_counts": """
        SELECT 'workflow' AS kind, count(*) AS n FROM events
        UNION ALL SELECT 'task', count(*) FROM events WHERE event_id % 6 IN (0, 1, 2)
        UNION ALL SELECT 'subworkflow', count(*) FROM events WHERE event_id % 6 = 3
        UNION ALL SELECT 'server', count(*) FROM events WHERE event_id % 6 = 4""",
}
