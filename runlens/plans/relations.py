"""Workflow archives derived from the given tables.

Each relation is one row-local expression per table row (a document, a listing row, log
lines, ...), so archives grow with the tables and keep their skew. ``*_SQL`` holds the
same derivation for the SQL side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from runlens.sources.readers import corpus_lines, wide_to_long


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a table that a task expands at most: a document of an order takes some 0.5 ms.
SPREAD_ROWS = 20_000


def spread(spark: SparkSession, sf_dir: str, name: str, rows: int = SPREAD_ROWS) -> DataFrame:
    """A table whose rows are about to be expanded, dealt to tasks of at most ``rows`` rows, and to all cores.

    Splits of files don't tell how long a task takes: a few row groups hold millions of rows.
    The count reads the files' footers only.
    """
    df = table(spark, sf_dir, name)
    return df.repartition(max(spark.sparkContext.defaultParallelism, -(-df.count() // rows)))


def stored(value: Column) -> Column:
    """A derived value that behaves like a stored column: made once per row, however often it is used."""
    return F.explode(F.array(value))


def uuid_of(k: Column) -> Column:
    return F.format_string("%08x-0000-4000-a000-%012x", k, k)


def uuid_sql(k: str) -> str:
    return f"printf('%08x-0000-4000-a000-%012x', {k}, {k})"


# --- workflow listing: one row per order -------------------------------------------

STATUS_SQL = "CASE o_orderstatus WHEN 'F' THEN 'Failed' WHEN 'O' THEN 'Running' ELSE 'Succeeded' END"


def _status() -> Column:
    code = F.col("o_orderstatus")
    return F.when(code == "F", "Failed").when(code == "O", "Running").otherwise("Succeeded")


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    label = F.concat("o_orderpriority", F.lit("-"), (F.col("o_custkey") % 100).cast("string"))
    user = F.concat(F.lit("user"), F.col("o_custkey").cast("string"))
    labels = F.when(k % 13 == 5, F.create_map(F.lit("run-user"), user)).otherwise(
        F.create_map(F.lit("run-str-label"), label, F.lit("run-user"), user)
    )
    return table(spark, sf_dir, "orders").select(
        uuid_of(k).alias("id"),
        F.col("o_orderpriority").alias("name"),
        _status().alias("status"),
        F.when(k % 50 != 7, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")).alias("submission"),
        F.when(k % 10 == 3, uuid_of(F.floor(k / 10))).alias("parentWorkflowId"),
        labels.alias("labels"),
    )


LISTING_SQL = f"""
wf AS (
  SELECT o_orderkey AS k, {uuid_sql('o_orderkey')} AS id, o_orderpriority AS name, {STATUS_SQL} AS status,
         CASE WHEN o_orderkey % 50 <> 7 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS submission,
         CASE WHEN o_orderkey % 10 = 3 THEN {uuid_sql('o_orderkey // 10')} END AS parent,
         CASE WHEN o_orderkey % 13 <> 5
              THEN o_orderpriority || '-' || CAST(o_custkey % 100 AS VARCHAR) END AS str_label,
         'user' || CAST(o_custkey AS VARCHAR) AS usr
  FROM orders
)"""


# --- workflow documents: one JSON document per order --------------------------------
# main.prep, 1 to 3 shards of main.align, and main.sub, whose document holds sub.qc and
# sub.deep, whose document holds deep.report. Some orders have main.sub without an
# embedded document, some with an empty one.


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(k, doc)`` with ``doc`` as JSON text.

    Put together from pieces that are made once per order. A member whose value is NULL is left out.
    Values are numbers, dates and words given here: none needs an escape.
    """
    k, cust, when = F.col("k"), F.col("cust"), F.col("started")

    def text(*parts: Column | str) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    def optional(*parts: Column | str) -> Column:
        return F.coalesce(text(*parts), F.lit(""))

    def file(part: Column) -> Column:
        return F.coalesce(text('"gs://data/p', part, '"'), F.lit("null"))

    def made(rows: DataFrame, values: dict[str, Column]) -> DataFrame:
        """Values that later pieces use more than once."""
        return rows.select("*", F.inline(F.array(F.struct(*[v.alias(n) for n, v in values.items()]))))

    orders = spread(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.col("o_custkey").alias("cust"),
        F.coalesce(F.col("o_orderstatus") == "F", F.lit(False)).alias("failed"),
        _status().alias("status"),
        "o_orderdate",
    )
    rows = made(orders, {"wid": uuid_of(k), "started": F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")})
    log = F.when(k % 6 == 2, None).when(k % 6 == 3, text("/mon/", cust)).otherwise(text("gs://mon/", cust, "/monitoring.log"))
    shape = text(
        '"runtimeAttributes":{"cpu":"', k % 4 + 1, '","disks":"local-disk ', k % 90 + 10, ' HDD","memory":"',
        k % 7 + 1, F.when(k % 2 == 0, " GB").otherwise(" GiB"), '"},"inputs":',
    )
    events = text(
        ',"executionEvents":[{"description":"Pending","startTime":"0"', optional(',"endTime":"', when, '"'),
        '},{"description":"RunningJob",', optional('"startTime":"', when, '",'), '"endTime":"9"}]}',
    )
    files = text(
        "],", optional('"ref":"gs://data/p', F.when(k % 3 != 1, cust * 2), '",'),
        '"threads":4,"idx":{"a":[{"l":"/local/x","g":"gs://data/p0"}]}}',
    )
    rows = made(rows, {
        "base": text("gs://out/main/", F.when(k % 4 == 1, "x").otherwise(""), F.col("wid")),
        "job": text('"jobId":"job', k, '","stdout":"'),
        "monitor": text(optional('"monitoringLog":"', log, '",'), shape, '{"fastqs":[', file(cust), ","),
        "shape": shape,
        "files_events": text(files, events),
        "events": events,
    })

    def call(directory: str, status: Column, shard: int = -1, monitored: bool = False) -> Column:
        """``status`` is a call's ``executionStatus``."""
        root = text(F.col("base"), directory, f"/shard-{shard}" if shard >= 0 else "")
        inputs = text(F.col("monitor"), file(cust + (shard + 1)), F.col("files_events")) if monitored else text(F.col("shape"), '{"threads":4}', F.col("events"))
        return text(
            "{", optional('"executionStatus":"', status, '",'), f'"shardIndex":{shard},"attempt":', k % 2 + 1, ",",
            F.when(status == "Failed", '"returnCode":1,').when(status == "Done", '"returnCode":0,').otherwise(""),
            F.col("job"), root, '/stdout",', F.when(k % 9 != 4, text('"stderr":"', root, '/stderr",')).otherwise(""),
            '"callRoot":"', root, '",', inputs,
        )

    done, sub = F.lit("Done"), "/call-sub/sub/s/call-"
    ended = F.when(F.col("failed"), "Failed").otherwise(done)
    align = F.when(k % 11 == 6, None).otherwise(ended)
    shards = [call("/call-align", align, i, monitored=True) for i in range(3)]
    # deep calls read no files
    inner = text(
        ',"calls":{"sub.qc":[', call(f"{sub}qc", ended, monitored=True),
        '],"sub.deep":[{"subWorkflowMetadata":{"calls":{"deep.report":[', call(f"{sub}report", done), "]}}}]}",
    )
    rows = made(rows, {
        "prep": call("/call-prep", done, monitored=True),
        "aligned": text(shards[0], *[F.when(k % 3 >= i, text(",", shards[i])).otherwise("") for i in (1, 2)]),
        "embedded": F.when(k % 5 == 1, "").otherwise(text(',"subWorkflowMetadata":{"id":"s"', F.when(k % 5 == 2, "").otherwise(inner), "}")),
    })
    doc = text(
        '{"id":"', F.col("wid"), '","status":"', F.col("status"), '",',
        F.when(k % 4 == 0, text('"workflowRoot":"', F.col("base"), '",')).otherwise(""),
        F.when(F.col("failed"), text('"failures":[{"message":"boom ', k, '","causedBy":[]}],')).otherwise(""),
        '"calls":{"main.prep":[', F.col("prep"), '],"main.align":[', F.col("aligned"),
        '],"main.sub":[{"executionStatus":"Done"', F.col("embedded"), "}]}}",
    )
    return rows.select("k", stored(doc).alias("doc"))


# Leaf calls of the documents, stated without any document.
CALLS_SQL = f"""
base AS (
  SELECT o_orderkey AS k, o_custkey AS cust, {uuid_sql('o_orderkey')} AS id, o_orderstatus = 'F' AS failed,
         {STATUS_SQL} AS wf_status, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS started,
         'gs://out/main/' || CASE WHEN o_orderkey % 4 = 1 THEN 'x' ELSE '' END || {uuid_sql('o_orderkey')} AS root
  FROM orders
),
leaf AS (
  SELECT *, 'main.prep' AS call_name, '' AS parents, '0.0' AS ord, 'Done' AS status, -1 AS shard,
         root || '/call-prep' AS call_root, TRUE AS monitored FROM base
  UNION ALL
  SELECT base.*, 'main.align', '', '1.' || CAST(i AS VARCHAR),
         CASE WHEN k % 11 = 6 THEN NULL WHEN failed THEN 'Failed' ELSE 'Done' END, i,
         root || '/call-align/shard-' || CAST(i AS VARCHAR), TRUE
  FROM base, UNNEST(range(0, k % 3 + 1)) AS u(i)
  UNION ALL
  SELECT *, 'main.sub', '', '2.0', 'Done', NULL, NULL, FALSE FROM base WHERE k % 5 = 1
  UNION ALL
  SELECT *, 'sub.qc', 'main.sub', '2.0.0.0', CASE WHEN failed THEN 'Failed' ELSE 'Done' END, -1,
         root || '/call-sub/sub/s/call-qc', TRUE FROM base WHERE k % 5 NOT IN (1, 2)
  UNION ALL
  SELECT *, 'deep.report', 'main.sub,sub.deep', '2.0.1.0.0.0', 'Done', -1,
         root || '/call-sub/sub/s/call-report', FALSE FROM base WHERE k % 5 NOT IN (1, 2)
),
calls AS (
  SELECT *, call_root || '/stdout' AS stdout,
         CASE WHEN k % 9 <> 4 THEN call_root || '/stderr' END AS stderr,
         CASE WHEN monitored AND k % 6 NOT IN (2, 3)
              THEN 'gs://mon/' || CAST(cust AS VARCHAR) || '/monitoring.log' END AS mon,
         CASE WHEN call_name <> 'main.sub' THEN CASE status WHEN 'Failed' THEN 1 WHEN 'Done' THEN 0 END END AS rc,
         CASE WHEN call_name <> 'main.sub' THEN 'job' || CAST(k AS VARCHAR) END AS job,
         CASE WHEN call_name <> 'main.sub' THEN k % 2 + 1 END AS attempt
  FROM leaf
)"""


# --- documents that name their sub-workflows: those of order k name orders 10k + 1 to 10k + 7 --


def naming_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, doc)``; not every sub-workflow that a document names has a document."""
    k = F.col("o_orderkey")
    sub = lambda i: F.struct(F.lit("Done").alias("executionStatus"), uuid_of(k * 10 + i).alias("subWorkflowId"))
    calls = F.struct(
        F.array(F.struct(F.col("o_custkey").alias("shardIndex"))).alias("main.run"),
        F.transform(F.sequence(F.lit(1), F.lit(7)), sub).alias("main.sub"),
    )
    doc = F.to_json(F.struct(uuid_of(k).alias("id"), _status().alias("status"), calls.alias("calls")))
    return spread(spark, sf_dir, "orders").select(uuid_of(k).alias("id"), doc.alias("doc"))


# The same with all sub-workflows inside: keys of d digits are named by keys of d - 1 digits.
_DIGITS = 9
NAMING_SQL = f"""
own AS (
  SELECT o_orderkey AS k, CASE WHEN o_orderkey = 0 THEN 0 ELSE length(CAST(o_orderkey AS VARCHAR)) END AS digits, {uuid_sql('o_orderkey')} AS id, {STATUS_SQL} AS status, o_custkey AS cust FROM orders
),
e{_DIGITS + 1} AS (SELECT CAST(0 AS BIGINT) AS k, '' AS doc, 0 AS levels WHERE FALSE),
""" + ",".join(
    f"""
e{d} AS (
  SELECT own.k, '{{"id":"' || any_value(id) || '","status":"' || any_value(status) || '","calls":{{"main.run":[{{"shardIndex":' || CAST(any_value(cust) AS VARCHAR) || '}}],"main.sub":[' ||
         string_agg('{{"executionStatus":"Done",' || CASE WHEN e.k IS NULL THEN '"subWorkflowId":"' || {uuid_sql('(own.k * 10 + j)')} || '"' ELSE '"subWorkflowMetadata":' || e.doc END || '}}', ',' ORDER BY j) || ']}}}}' AS doc,
         coalesce(max(e.levels) + 1, 0) AS levels
  FROM own CROSS JOIN range(1, 8) AS u(j) LEFT JOIN e{d + 1} AS e ON e.k = own.k * 10 + j WHERE digits = {d} GROUP BY own.k
)"""
    for d in range(_DIGITS, -1, -1)
)


# --- file catalogue: one file per part -----------------------------------------------


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(path, length)`` of the files that calls read."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("gs://data/p"), key.cast("string")).alias("path"),
        (F.col("p_size").cast("bigint") * 1048576 + key).alias("length"),
    )


# Files named in the inputs of the monitored calls, stated without any document.
SIZES_SQL = f"""
{CALLS_SQL},
named AS (
  SELECT id, ord, call_name, mon, 'fastqs' AS var, 0 AS idx, cust AS part FROM calls WHERE monitored
  UNION ALL SELECT id, ord, call_name, mon, 'fastqs', 1, cust + shard + 1 FROM calls WHERE monitored
  UNION ALL SELECT id, ord, call_name, mon, 'ref', 0, cust * 2 FROM calls WHERE monitored AND k % 3 <> 1
  UNION ALL SELECT id, ord, call_name, mon, 'idx', 0, 0 FROM calls WHERE monitored
),
sized AS (
  SELECT named.*, p_size * 1048576 + p_partkey AS size FROM named JOIN part ON p_partkey = part
)"""


# --- monitoring series: one sample per event ------------------------------------------


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(log, row_no, time, mem, disk, cpu_pct)``: a user's events are one log."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("gs://mon/"), F.col("user_id").cast("string"), F.lit("/monitoring.log")).alias("log"),
        F.col("event_id").alias("row_no"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("time"),
        F.round(F.col("value") * 1000000).cast("bigint").alias("mem"),
        (F.col("event_id") % 1000 * 1024).alias("disk"),
        F.col("value").alias("cpu_pct"),
    )


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_to_long(samples(spark, sf_dir))


SERIES_SQL = """
sample AS (
  SELECT 'gs://mon/' || CAST(user_id AS VARCHAR) || '/monitoring.log' AS log, event_id AS row_no,
         round(value * 1000000) AS mem, CAST(event_id % 1000 * 1024 AS DOUBLE) AS disk, value AS cpu_pct
  FROM events
),
series AS (
  SELECT log, row_no, 'mem' AS col, mem AS val FROM sample
  UNION ALL SELECT log, row_no, 'disk', disk FROM sample
  UNION ALL SELECT log, row_no, 'cpu_pct', cpu_pct FROM sample
)"""


# --- server log: two lines per event ----------------------------------------------------


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(seq, line)``."""
    return log_lines_of(spread(spark, sf_dir, "events"))


def log_lines_of(events: DataFrame) -> DataFrame:
    e, kind = F.col("event_id"), F.col("event_type")
    wid, sub = uuid_of(F.col("user_id")), uuid_of(F.col("user_id") + 1000000)
    short = F.substring(F.when(e % 7 == 0, sub).otherwise(wid), 1, 8)

    def text(*parts: Column | str) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    status_line = (
        F.when(kind == "signup", text("[info] workflow ", wid, " submitted"))
        .when(kind == "view", text("[info] started WorkflowActor-", wid))
        .when(kind == "error", text("[error] Workflow ", wid, " failed (during ExecutingWorkflowState)"))
        .when(kind == "click", text("[info] Abort requested for workflow ", wid, "."))
        .when(e % 2 == 0, text("[info] WorkflowActor-", wid, " is in a terminal state: done"))
        .otherwise(text("[info] Workflow actor for ", wid, " completed with status 'Done'"))
    )
    task_line = (
        F.when(e % 6 == 0, text("[UUID(", short, ")main.t1:NA:1]: job id: ", e.cast("string")))
        .when(e % 6 == 1, text("[UUID(", short, ")main.t2:3:2]: Status change from - to Running"))
        .when(
            e % 6 == 2,
            text("[UUID(", short, ")]: Job results retrieved (CallCached): 'main.t3' (scatter index: None, attempt 1)"),
        )
        .when(e % 6 == 3, text("x ", sub, "-SubWorkflowActor-SubWorkflow-y"))
        .when(e % 6 == 4, text("Cromwell 82 service started on 0:0:", e.cast("string")))
        .otherwise(text("[info] ", F.col("props")))
    )
    both = F.array(
        F.struct((e * 2).alias("seq"), status_line.alias("line")),
        F.struct((e * 2 + 1).alias("seq"), task_line.alias("line")),
    )
    return events.select(F.inline(both))


# Events that those lines must give, stated without any line.
EVENTS_SQL = f"""
ev AS (
  SELECT event_id AS e, event_type, {uuid_sql('user_id')} AS wid, {uuid_sql('(user_id + 1000000)')} AS sub FROM events
),
flow AS (
  SELECT wid AS workflow_id, e * 2 AS seq,
         CASE event_type WHEN 'signup' THEN 'Submitted' WHEN 'view' THEN 'Running' WHEN 'error' THEN 'Failed'
              WHEN 'click' THEN 'Aborting' ELSE 'TERM' END AS event
  FROM ev
),
tasks AS (
  SELECT e * 2 + 1 AS seq, substr(CASE WHEN e % 7 = 0 THEN sub ELSE wid END, 1, 8) AS short_id,
         CASE e % 6 WHEN 0 THEN 'main.t1' WHEN 1 THEN 'main.t2' ELSE 'main.t3' END AS task_name,
         CASE e % 6 WHEN 1 THEN 3 ELSE -1 END AS shard_idx, CASE e % 6 WHEN 1 THEN 1 ELSE 0 END AS retry,
         CASE e % 6 WHEN 0 THEN 'Started' WHEN 1 THEN 'Running' ELSE 'CallCached' END AS status,
         CASE WHEN e % 6 = 0 THEN CAST(e AS VARCHAR) END AS job_id
  FROM ev WHERE e % 6 IN (0, 1, 2)
),
subs AS (SELECT sub AS workflow_id, min(e * 2 + 1) AS first_seq FROM ev WHERE e % 6 = 3 GROUP BY 1),
grouped AS (
  SELECT *, sum(CASE WHEN event <> 'TERM' THEN 1 ELSE 0 END) OVER (PARTITION BY workflow_id ORDER BY seq) AS grp FROM flow
),
ranked AS (
  SELECT *, first_value(event) OVER w AS base, row_number() OVER w - CASE WHEN grp > 0 THEN 1 ELSE 0 END AS nth
  FROM grouped WINDOW w AS (PARTITION BY workflow_id, grp ORDER BY seq)
),
transitions AS (
  SELECT workflow_id, seq, CASE WHEN event <> 'TERM' THEN event
              WHEN base = 'Aborting' AND nth = 1 THEN 'Aborted' ELSE 'Succeeded' END AS status,
         event = 'TERM' AS write_metadata, nth
  FROM ranked WHERE NOT (event = 'TERM' AND base = 'Failed')
)"""


# --- nested documents: one per event -----------------------------------------------------


def nested_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id, doc VARIANT)``."""
    e = F.col("event_id")

    def replicate(n: int) -> Column:
        return F.struct((e + n).alias("read1"), (e * n).alias("read2"))

    doc = F.struct(
        F.struct(replicate(1).alias("rep1"), replicate(2).alias("rep2")).alias("flagstat"),
        F.array(F.col("value"), F.col("value") + 1).alias("list"),
        F.struct(F.col("event_type").alias("kind"), F.from_json("props", "k INT").alias("props")).alias("meta"),
        F.col("user_id").alias("user"),
    )
    return spread(spark, sf_dir, "events").select("event_id", stored(F.parse_json(F.to_json(doc))).alias("doc"))


# --- input documents with file paths: one per order --------------------------------------


def input_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc, text)`` with JSON text naming local, bucket and web files."""
    k, cust = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    year = F.year("o_orderdate").cast("string")
    text = F.struct(
        F.concat(F.lit("/data/"), F.col("o_orderstatus"), F.lit("/"), year, F.lit("/"), cust, F.lit("/r1.fastq.gz")).alias("a"),
        F.array(
            F.concat(F.lit("/data/"), F.col("o_orderstatus"), F.lit("/"), year, F.lit("/x"), cust, F.lit("/r2.fq")),
            F.concat(F.lit("/ref/v/w/x/y/"), (k % 7).cast("string"), F.lit("/z/genome.fa")),
            F.lit("/ref/v/w/x/y/z/genome.fa.fai"),
        ).alias("b"),
        F.struct(
            F.concat(F.lit("gs://bkt"), (k % 3).cast("string"), F.lit("/in/"), cust, F.lit(".bam")).alias("d"),
            F.concat(F.lit("https://example.org/"), cust, F.lit("/idx.tar")).alias("e"),
            F.concat(F.lit("s3://bkt/"), cust, F.lit(".txt")).alias("f"),
        ).alias("c"),
        k.alias("n"),
        F.lit("plain text").alias("t"),
    )
    doc = F.concat(F.lit("/in/doc"), k.cast("string"), F.lit(".json"))
    return spread(spark, sf_dir, "orders").select(doc.alias("doc"), stored(F.to_json(text)).alias("text"))


INPUT_FILES_SQL = """
o AS (
  SELECT o_orderkey AS k, CAST(o_custkey AS VARCHAR) AS cust, o_orderstatus AS st, CAST(year(o_orderdate) AS VARCHAR) AS yr,
         '/in/doc' || CAST(o_orderkey AS VARCHAR) || '.json' AS doc
  FROM orders
),
leaf AS (
  SELECT doc, 'a' AS var, '/data/' || st || '/' || yr || '/' || cust || '/r1.fastq.gz' AS path FROM o
  UNION ALL SELECT doc, 'b', '/data/' || st || '/' || yr || '/x' || cust || '/r2.fq' FROM o
  UNION ALL SELECT doc, 'b', '/ref/v/w/x/y/' || CAST(k % 7 AS VARCHAR) || '/z/genome.fa' FROM o
  UNION ALL SELECT doc, 'b', '/ref/v/w/x/y/z/genome.fa.fai' FROM o
  UNION ALL SELECT doc, 'c', 'gs://bkt' || CAST(k % 3 AS VARCHAR) || '/in/' || cust || '.bam' FROM o
  UNION ALL SELECT doc, 'c', 'https://example.org/' || cust || '/idx.tar' FROM o
  UNION ALL SELECT doc, 'c', 's3://bkt/' || cust || '.txt' FROM o
)"""


# --- source corpus: one file per part, plus files by region and supplier ------------------


def corpus_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(path, text)``."""
    k = F.col("p_partkey")

    def line(condition: Column, *parts: Column | str) -> Column:
        text = F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
        return F.when(condition, text).otherwise("")

    parts = table(spark, sf_dir, "part").select(
        F.concat(F.lit("/src/pkg/m"), k.cast("string"), F.lit(".wdl")).alias("path"),
        F.concat(
            F.lit("version 1.0\n"),
            line(k > 0, 'import "m', F.floor(k / 7), '.wdl" as lib\n'),
            line(k % 11 == 3, "  import '../pkg/m", F.floor(k / 5), ".wdl' as b\n"),
            line(k % 13 == 4, 'import "https://example.org/u', F.floor(k / 40), '.wdl"\n'),
            line(k % 17 == 5, 'import "/abs/x.wdl"\n'),
            line(k % 19 == 6, 'import "missing', k, '.wdl"\n'),
            line(k % 23 == 7, 'import "../other/o', k % 5, '.wdl" as o\n'),
            line(k % 2 == 0, '#  RUN docker "img:', k % 5, '"\n# RUN docker "late"\n'),
            F.lit("task t { command { echo "),
            F.col("p_name"),
            F.lit(" } }\n"),
        ).alias("text"),
    )
    others = table(spark, sf_dir, "region").select(
        F.concat(F.lit("/src/other/o"), F.col("r_regionkey").cast("string"), F.lit(".wdl")).alias("path"),
        F.lit("version 1.0\n").alias("text"),
    )
    s = F.col("s_suppkey").cast("string")
    web = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("https://example.org/u"), s, F.lit(".wdl")).alias("path"),
        F.concat(F.lit('import "m'), s, F.lit('.wdl"\n')).alias("text"),
    )
    return parts.unionByName(others).unionByName(web)


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(path, line_no, line)``."""
    return corpus_lines(corpus_files(spark, sf_dir))


CORPUS_SQL = """
p AS (SELECT p_partkey AS k, '/src/pkg/m' || CAST(p_partkey AS VARCHAR) || '.wdl' AS src FROM part),
edges AS (
  SELECT src, 'm' || CAST(k // 7 AS VARCHAR) || '.wdl' AS target FROM p WHERE k > 0
  UNION ALL SELECT src, '../pkg/m' || CAST(k // 5 AS VARCHAR) || '.wdl' FROM p WHERE k % 11 = 3
  UNION ALL SELECT src, 'https://example.org/u' || CAST(k // 40 AS VARCHAR) || '.wdl' FROM p WHERE k % 13 = 4
  UNION ALL SELECT src, '/abs/x.wdl' FROM p WHERE k % 17 = 5
  UNION ALL SELECT src, 'missing' || CAST(k AS VARCHAR) || '.wdl' FROM p WHERE k % 19 = 6
  UNION ALL SELECT src, '../other/o' || CAST(k % 5 AS VARCHAR) || '.wdl' FROM p WHERE k % 23 = 7
  UNION ALL SELECT 'https://example.org/u' || CAST(s_suppkey AS VARCHAR) || '.wdl',
                   'm' || CAST(s_suppkey AS VARCHAR) || '.wdl' FROM supplier
),
files AS (
  SELECT src AS path FROM p
  UNION ALL SELECT '/src/other/o' || CAST(r_regionkey AS VARCHAR) || '.wdl' FROM region
  UNION ALL SELECT 'https://example.org/u' || CAST(s_suppkey AS VARCHAR) || '.wdl' FROM supplier
)"""
