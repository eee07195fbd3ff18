"""Scheduler listings and heartbeats."""

from __future__ import annotations

from pyspark.sql import functions as F

from runlens.operators import jobs as O
from runlens.plans import relations as R

TIMEOUT_MS = 6 * 3600 * 1000


def job_filter(spark, sf_dir):
    """Each conversation as a listing whose first turn is the header."""
    turn = F.col("turn")
    lines = R.table(spark, sf_dir, "conversations").select(
        "conv_id",
        turn.alias("line_no"),
        F.concat("role", F.lit(" "), "text", F.when((turn + F.col("conv_id")) % 3 == 1, " RUN_job").otherwise("")).alias("line"),
    )
    return O.leader_jobs(lines)


def heartbeats(spark, sf_dir):
    e, user = F.col("event_id"), F.col("user_id").cast("string")
    text = F.when(e % 10 == 9, "broken").otherwise(F.concat(F.lit("node"), user, F.lit(":"), (8000 + e % 100).cast("string"), F.lit("\n")))
    return R.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("server"), text.alias("text"), F.col("ts").cast("timestamp").alias("ts")
    )


def heartbeat_alive(spark, sf_dir):
    beats = heartbeats(spark, sf_dir)
    now = beats.agg(F.max("ts")).scalar()
    out = O.alive(beats, now, TIMEOUT_MS)
    return out.select("server", "host", "port", F.unix_micros("ts").alias("micros"), "alive")


QUERIES = {"job_filter": job_filter, "heartbeat_alive": heartbeat_alive}

ORACLES = {
    "job_filter": """
        WITH l AS (SELECT conv_id, turn AS line_no, role || ' ' || text || CASE WHEN (turn + conv_id) % 3 = 1 THEN ' RUN_job' ELSE '' END AS line
                   FROM conversations)
        SELECT * FROM l WHERE line_no = 0 OR line LIKE '%RUN\\_%' ESCAPE '\\'""",
    "heartbeat_alive": f"""
        WITH last AS (SELECT * FROM events e WHERE ts = (SELECT max(ts) FROM events f WHERE f.user_id = e.user_id)),
        p AS (SELECT *, event_id % 10 <> 9 AS ok FROM last)
        SELECT user_id AS server, CASE WHEN ok THEN 'node' || CAST(user_id AS VARCHAR) END AS host,
               CASE WHEN ok THEN CAST(8000 + event_id % 100 AS INTEGER) END AS port, epoch_us(ts) AS micros,
               ok AND epoch_us((SELECT max(ts) FROM events)) - epoch_us(ts) <= CAST({TIMEOUT_MS} AS BIGINT) * 1000 AS alive
        FROM p""",
}
