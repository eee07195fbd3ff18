"""Scheduler job listings and server heartbeats."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from runlens.functions.labels import DEFAULT_NAMING, Naming

# Fixed value: age in milliseconds beyond which a heartbeat has expired.
HEARTBEAT_TIMEOUT_MS = 120_000


def leader_jobs(lines: DataFrame, naming: Naming = DEFAULT_NAMING) -> DataFrame:
    """Header (line 0) and the lines that mention a leader job."""
    return lines.where((F.col("line_no") == 0) | F.col("line").contains(naming.job_prefix))


def parse_host_port(text: Column) -> Column:
    """``struct<host, port>`` of ``host:port``; NULL when malformed."""
    parts = F.split(F.regexp_replace(text, r"^\n+|\n+\z", ""), ":")
    port = F.trim(F.get(parts, F.lit(1))).try_cast("int")
    return F.when(
        (F.size(parts) == 2) & port.isNotNull(), F.struct(F.get(parts, F.lit(0)).alias("host"), port.alias("port"))
    )


def is_host_port(text: str | None) -> bool:
    """Whether :func:`parse_host_port` gives a value; for per-server state functions."""
    parts = re.sub(r"^\n+|\n+\Z", "", text).split(":") if text is not None else []
    return len(parts) == 2 and re.fullmatch(r" *[+-]?[0-9]+ *", parts[1]) is not None and -(2**31) <= int(parts[1]) < 2**31


def latest_heartbeats(heartbeats: DataFrame) -> DataFrame:
    """``(server, text, ts)`` of each server's last write."""
    return heartbeats.groupBy("server").agg(F.max_by("text", "ts").alias("text"), F.max("ts").alias("ts"))


def alive(heartbeats: DataFrame, now: Column, timeout_ms: int = HEARTBEAT_TIMEOUT_MS) -> DataFrame:
    """``(server, host, port, ts, alive)``; a heartbeat is alive up to and including the timeout."""
    age_ms = (F.unix_micros(now) - F.unix_micros("ts")) / 1000
    latest = latest_heartbeats(heartbeats).withColumn("_hp", parse_host_port(F.col("text")))
    fresh = (age_ms <= timeout_ms) & F.col("_hp").isNotNull()
    return latest.select(
        "server", F.col("_hp.host").alias("host"), F.col("_hp.port").alias("port"), "ts", fresh.alias("alive")
    )
