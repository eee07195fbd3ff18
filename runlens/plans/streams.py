"""Structured Streaming twins, run over the event table as a file stream until it is used up."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from runlens.operators import logs as G
from runlens.plans import jobs as J, logs as batch, relations as R
from runlens.session import shared_place
from runlens.sources import sinks
from runlens.streaming import logs as S


def _event_stream(spark, sf_dir) -> DataFrame:
    schema = R.table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return S.log_event_stream(R.log_lines_of(events))


def _drain(stream: DataFrame) -> DataFrame:
    """Run a stream into a table in the shared folder and read the table."""
    place = shared_place(stream.sparkSession, "stream")
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{place}/table")
        .option("checkpointLocation", f"{place}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{place}/table")


def stream_log_events(spark, sf_dir):
    return _drain(G.workflow_events(_event_stream(spark, sf_dir))).select("workflow_id", "seq", "event")


def stream_status(spark, sf_dir):
    out = _drain(S.status_stream(_event_stream(spark, sf_dir)))
    return out.select("workflow_id", "seq", "status", "write_metadata")


def stream_subworkflows(spark, sf_dir):
    """Distinct ids only: which sighting comes first within a micro-batch is not fixed."""
    return _drain(S.subworkflow_stream(_event_stream(spark, sf_dir))).select("workflow_id")


PARTS = 3


def _in_parts(spark, rows: DataFrame, order: str, run) -> None:
    """Let rows arrive in PARTS folders of one growing table, in the order of a column, and call ``run`` after each."""
    source = shared_place(spark, "arriving")
    low, high = rows.agg(F.min(order), F.max(order)).first()
    low, high = low or 0, high or 0
    part = F.least(F.floor((F.col(order) - low) * PARTS / (high - low + 1)), F.lit(PARTS - 1))
    for k in range(PARTS):
        rows.where(part == k).write.parquet(f"{source}/part={k}")
        run(source)


def _status_table(spark, events: DataFrame) -> DataFrame:
    """The table of current statuses after the events arrived in parts, each a micro-batch of its own."""
    place = shared_place(spark, "status")

    def run(source: str) -> None:
        arrived = spark.readStream.schema(events.schema).parquet(f"{source}/part=*")
        stream = S.current_status_stream(S.log_event_stream(R.log_lines_of(arrived)))
        writer = stream.writeStream.outputMode("update").foreachBatch(S.keep_newest(f"{place}/table"))
        writer.option("checkpointLocation", f"{place}/state").trigger(availableNow=True).start().awaitTermination()

    _in_parts(spark, events, "event_id", run)
    return sinks.newest(spark.read.parquet(f"{place}/table"), ["workflow_id"])


def stream_current_status(spark, sf_dir):
    """Statuses kept up to date over several micro-batches."""
    return _status_table(spark, R.table(spark, sf_dir, "events")).select("workflow_id", "status", "seq")


def stream_status_backlog(spark, sf_dir):
    """The status machine by the batch operator, over several micro-batches."""
    events = R.table(spark, sf_dir, "events")
    place = shared_place(spark, "backlog")

    def run(source: str) -> None:
        arrived = spark.readStream.schema(events.schema).parquet(f"{source}/part=*")
        writer = S.log_event_stream(R.log_lines_of(arrived)).writeStream.foreachBatch(S.status_batches(place))
        writer.option("checkpointLocation", f"{place}/state").trigger(availableNow=True).start().awaitTermination()

    _in_parts(spark, events, "event_id", run)
    return spark.read.parquet(f"{place}/transitions").select("workflow_id", "seq", "status", "write_metadata")


def stream_silences(spark, sf_dir):
    """Every time a server was silent for longer than the timeout, found over several micro-batches."""
    beats = J.heartbeats(spark, sf_dir).withColumn("micros", F.unix_micros("ts"))
    place = shared_place(spark, "silences")

    def run(source: str) -> None:
        arrived = spark.readStream.schema(beats.schema).parquet(f"{source}/part=*").drop("micros")
        writer = S.silence_stream(arrived, J.TIMEOUT_MS).writeStream.format("parquet").option("path", f"{place}/table")
        writer.option("checkpointLocation", f"{place}/state").trigger(availableNow=True).start().awaitTermination()

    _in_parts(spark, beats, "micros", run)
    rows = spark.read.schema("server long, host string, port int, ts timestamp, alive boolean").parquet(f"{place}/table")
    return rows.select("server", "host", "port", F.unix_micros("ts").alias("micros"))


QUERIES = {
    "stream_log_events": stream_log_events,
    "stream_status": stream_status,
    "stream_subworkflows": stream_subworkflows,
    "stream_current_status": stream_current_status,
    "stream_status_backlog": stream_status_backlog,
    "stream_silences": stream_silences,
}

ORACLES = {
    "stream_log_events": batch.ORACLES["log_events"],
    "stream_status": batch.ORACLES["status_transitions"],
    "stream_status_backlog": batch.ORACLES["status_transitions"],
    "stream_subworkflows": f"WITH {R.EVENTS_SQL} SELECT workflow_id FROM subs",
    "stream_current_status": batch.ORACLES["current_status"],
    "stream_silences": f"""
        WITH d AS (
          SELECT user_id AS server, epoch_us(ts) AS micros, min(CASE WHEN event_id % 10 = 9 THEN 'broken' ELSE 'node' || CAST(user_id AS VARCHAR) || ':' || CAST(8000 + event_id % 100 AS VARCHAR) END) AS text
          FROM events GROUP BY ALL),
        n AS (SELECT *, lead(micros) OVER (PARTITION BY server ORDER BY micros) AS following FROM d),
        w AS (SELECT max(micros) // 1000 AS upto FROM d)
        SELECT server, CASE WHEN text <> 'broken' THEN split_part(text, ':', 1) END AS host, CASE WHEN text <> 'broken' THEN CAST(split_part(text, ':', 2) AS INTEGER) END AS port, micros FROM n, w
        WHERE following - micros > CAST({J.TIMEOUT_MS} AS BIGINT) * 1000 OR (following IS NULL AND micros // 1000 + {J.TIMEOUT_MS} + 1 < upto)""",
}
