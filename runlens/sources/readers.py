"""Readers. They name the file each row came from; all but ``read_log`` and ``input_files`` are lazy.

An archive has one small file per run or task; copy it once into a parquet table of
``(file, doc)`` or ``(log, ...)`` rows and read that on later runs.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.types import IntegralType, StringType, StructField, StructType, _parse_datatype_string

from runlens.functions import uris
from runlens.operators import nested
from runlens.session import cut_lineage, stage

Paths = str | Sequence[str]


def _paths(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _file_path() -> Column:
    """Path of the scanned file; a local file's URI is turned into an absolute path."""
    return F.regexp_replace(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), "^file:/+", "/")


def read_files(spark: SparkSession, paths: Paths) -> DataFrame:
    """``(path, text)``: whole text files."""
    return spark.read.text(_paths(paths), wholetext=True).select(_file_path().alias("path"), F.col("value").alias("text"))


def read_metadata(spark: SparkSession, paths: Paths, lines: bool = False) -> DataFrame:
    """``(file, doc)``: workflow documents as JSON text, one per file or (``lines``) one per line."""
    rows = spark.read.text(_paths(paths), wholetext=not lines)
    return rows.select(_file_path().alias("file"), F.col("value").alias("doc")).where("trim(doc) <> ''")


def read_labels(spark: SparkSession, paths: Paths) -> DataFrame:
    """``(file, doc VARIANT)``: label and option documents."""
    return read_metadata(spark, paths).withColumn("doc", F.parse_json("doc"))


def monitor_long(files: DataFrame) -> DataFrame:
    """``(log, row_no, col_no, col, val, whole)`` from ``(path, text)`` of tab-separated logs.

    The first line names the columns. Blank lines do not count as rows; a text that is
    no number is NULL, and ``whole`` tells whether it is an integer. A log with a header only gives its
    columns with NULL ``row_no``.
    """
    lines = F.filter(F.split("text", r"\r?\n"), lambda s: F.trim(s) != "")
    logs = files.select(F.col("path").alias("log"), lines.alias("_lines")).where(F.size("_lines") > 0)
    rows = logs.select(
        "log",
        F.split(F.get("_lines", F.lit(0)), "\t").alias("_header"),
        F.posexplode_outer(F.slice("_lines", F.lit(2), F.size("_lines"))).alias("row_no", "_line"),
    )
    cells = rows.select("log", "row_no", F.split("_line", "\t").alias("_cells"), F.posexplode("_header").alias("col_no", "col"))
    number = F.get("_cells", F.col("col_no")).try_cast("double")
    whole = F.coalesce(F.get("_cells", F.col("col_no")).rlike(r"^\s*[+-]?[0-9]+\s*$"), F.lit(False))
    return cells.select("log", "row_no", "col_no", "col", F.when(~F.isnan(number), number).alias("val"), whole.alias("whole"))


def read_monitor_logs(spark: SparkSession, paths: Paths) -> DataFrame:
    """Monitoring logs with any columns, in long form; see :func:`monitor_long`."""
    return monitor_long(read_files(spark, paths))


MONITOR_SCHEMA = "time BIGINT, mem BIGINT, disk BIGINT, cpu_pct DOUBLE"


def read_monitor_table(spark: SparkSession, paths: Paths, schema: str = MONITOR_SCHEMA) -> DataFrame:
    """Monitoring logs with known columns, one row per sample, plus ``log`` and ``row_no``.

    ``row_no`` orders the rows of a log but is not dense. A log with a header only gives one row with NULL
    ``row_no`` and values, as in :func:`monitor_long`; to find them, names of logs are compared, not samples.
    """
    types = _parse_datatype_string(schema)
    first = f"`{types.fieldNames()[0]}`"
    texts = StructType([StructField(f.name, StringType()) for f in types])
    rows = spark.read.csv(_paths(paths), sep="\t", header=False, schema=texts)
    is_header = (F.trim(first) == types.fieldNames()[0]) & (F.col("_metadata.file_block_start") == 0)
    place = F.struct("_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    cells = [F.trim(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in types]
    named = rows.select(_file_path().alias("log"), place.alias("row_no"), F.coalesce(is_header, F.lit(False)).alias("_header"), *cells)
    samples = named.where("NOT _header").drop("_header")
    bare = named.where("_header").select("log").distinct().join(samples.select("log").distinct(), "log", "left_anti")
    return samples.unionByName(bare, allowMissingColumns=True)


def wide_to_long(table: DataFrame) -> DataFrame:
    """Long form ``(log, row_no, col_no, col, val, whole)`` of a table of samples; integer columns hold whole values."""
    fields = [f for f in table.schema.fields if f.name not in ("log", "row_no")]
    cells = [
        F.struct(
            F.lit(i).alias("col_no"),
            F.lit(f.name).alias("col"),
            F.col(f"`{f.name}`").cast("double").alias("val"),
            (F.col(f"`{f.name}`").isNotNull() if isinstance(f.dataType, IntegralType) else F.lit(False)).alias("whole"),
        )
        for i, f in enumerate(fields)
    ]
    return table.select("log", "row_no", F.inline(F.array(*cells)))


#: Splits whose offsets are handed to all tasks: a row of some hundred bytes each. More are joined by shuffles.
HANDED_SPLITS = 50_000


def read_log(spark: SparkSession, paths: Paths, handed_splits: int = HANDED_SPLITS) -> DataFrame:
    """``(seq, line)``: server log lines numbered from 0 over all files, oldest file first.

    Files are read in splits. Lines per split are counted first, when this is called, and give each split
    its offset. The offsets are then handed to the tasks that scan, so lines stay where they
    are read; only beyond ``handed_splits`` splits are lines and offsets joined by a shuffle.
    """
    lines = spark.read.text(_paths(paths)).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_modification_time").alias("_time"),
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"),
    )
    splits = lines.groupBy("_time", "_path", "_start").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    # one row per split
    before = Window.orderBy("_time", "_path", "_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut_lineage(splits.select("_path", "_start", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    side = F.broadcast(offsets) if offsets.count() <= handed_splits else offsets
    return lines.join(side, ["_path", "_start"]).select((F.col("_offset") + F.col("_id") - F.col("_first")).alias("seq"), "line")


LISTING_SCHEMA = (
    "id STRING, name STRING, status STRING, submission STRING, start STRING, end STRING, "
    "parentWorkflowId STRING, labels MAP<STRING,STRING>"
)


def read_workflows(spark: SparkSession, paths: Paths, format: str = "json", schema: str = LISTING_SCHEMA) -> DataFrame:
    """Workflow listing exports (JSON lines, parquet, ...)."""
    return spark.read.schema(schema).format(format).load(_paths(paths))


def read_file_catalog(spark: SparkSession, roots: Paths) -> DataFrame:
    """``(path, length, mtime)`` of every file below the roots; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(_paths(roots))
    return files.select(
        F.regexp_replace("path", "^file:/+", "/").alias("path"), "length", F.col("modificationTime").alias("mtime")
    )


def read_task_logs(spark: SparkSession, roots: Paths, pattern: str = "std*") -> DataFrame:
    """``(path, contents)`` of stdout, stderr and background stderr files."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    return files.text(_paths(roots), wholetext=True).select(_file_path().alias("path"), F.col("value").alias("contents"))


def read_corpus(spark: SparkSession, paths: Paths) -> DataFrame:
    """``(path, line_no, line)`` of source files, lines counted from 0."""
    return corpus_lines(read_files(spark, paths))


def corpus_lines(files: DataFrame) -> DataFrame:
    return files.select("path", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def read_job_listing(spark: SparkSession, paths: Paths) -> DataFrame:
    """``(path, line_no, line)`` of scheduler listings; line 0 is the header."""
    return corpus_lines(read_files(spark, paths))


def read_heartbeats(spark: SparkSession, paths: Paths) -> DataFrame:
    """``(server, text, ts)``: heartbeat files with their write time."""
    rows = spark.read.text(_paths(paths), wholetext=True)
    return rows.select(
        _file_path().alias("server"), F.col("value").alias("text"), F.col("_metadata.file_modification_time").alias("ts")
    )


# List files that may be named in an input document and name files themselves.
LIST_EXTENSIONS = (".json", ".tsv", ".csv")


def input_files(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """``(doc, path)``: every file URI in input documents, through nested list files.

    ``docs`` is ``(doc, text)`` with JSON text; ``texts`` is ``(path, text)`` with the
    contents of list files. Each round parses every list file found last once, however
    many documents name it, and joins its entries to those documents. A round that finds
    nothing new ends the loop, which lists that name each other reach too.
    """
    found = cut_lineage(named_files(docs.select("doc", F.lit(".json").alias("kind"), "text")).distinct())
    seen = found
    while True:
        lists = found.where(uris.extension(F.col("path")).isin(*LIST_EXTENSIONS))
        opened = texts.join(lists.select("path").distinct(), "path").select(F.col("path").alias("doc"), uris.extension(F.col("path")).alias("kind"), "text")
        entries = named_files(opened).distinct().select(F.col("doc").alias("_list"), F.col("path").alias("_entry"))
        named = lists.join(entries, F.col("path") == F.col("_list")).select("doc", F.col("_entry").alias("path")).distinct()
        found = cut_lineage(named.join(seen, ["doc", "path"], "left_anti"))
        if found.isEmpty():
            return seen
        seen = seen.unionByName(found)


def input_edges(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """``(node, is_doc, path, is_list)``: each file URI with the document or list file that names it.

    As :func:`input_files`, but a list file's entries stay its own, once each: what all documents
    reach through it is not spelled out per document. ``is_list`` tells whether the URI is one of a list file.

    Documents and list files are parsed in one pass each, list files that no document reaches too, which then drop
    out. The rounds from list to list join names alone.
    """

    def named(rows: DataFrame, is_doc: bool) -> DataFrame:
        listed = uris.extension(F.col("path")).isin(*LIST_EXTENSIONS)
        # dealt before repeats are looked for: few tasks that read texts would hold all their names
        return stage(named_files(rows).repartition("doc").distinct().select(F.col("doc").alias("node"), F.lit(is_doc).alias("is_doc"), "path", listed.alias("is_list")))

    kinds = texts.select(F.col("path").alias("doc"), "text", F.explode(F.array(uris.extension(F.col("path")))).alias("kind"))
    own, entries = named(docs.select("doc", F.lit(".json").alias("kind"), "text"), True), named(kinds.where(F.col("kind").isin(*LIST_EXTENSIONS)), False)
    links = entries.where("is_list").select("node", "path")
    new = cut_lineage(own.where("is_list").select("path").distinct())
    seen = new
    while True:
        reached = links.join(new.withColumnRenamed("path", "node"), "node", "left_semi").select("path").distinct()
        new = cut_lineage(reached.join(seen, "path", "left_anti"))
        if new.isEmpty():
            return own.unionByName(entries.join(seen.withColumnRenamed("path", "node"), "node", "left_semi").select(own.columns))
        seen = seen.unionByName(new)


_CELLS = {".tsv": re.compile(r"[\t\r\n]")}
_CSV_CELLS = re.compile(r"[,\r\n]")


@F.arrow_udf(T.ArrayType(T.StringType()))
def _uris(kinds: pa.Array, texts: pa.Array) -> pa.Array:
    """URIs among the strings of each JSON text, or the cells of separated values, once each; a broken JSON text has none."""
    found, ends = [], [0]
    for kind, text in zip(kinds.to_pylist(), texts.to_pylist(), strict=True):
        cells = []
        if text is not None and kind == ".json":
            try:
                todo = [nested.parsed(text)]
            except (ValueError, RecursionError):
                todo = []
            while todo:
                value = todo.pop()
                if isinstance(value, (dict, list)):
                    todo += value.values() if isinstance(value, dict) else value
                elif isinstance(value, str):
                    cells.append(value)
        elif text is not None:
            cells = _CELLS.get(kind, _CSV_CELLS).split(text)
        found += {nested.utf8(c): None for c in cells if c.startswith(uris.STARTS)}
        ends.append(len(found))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found, pa.string()))


def named_files(rows: DataFrame) -> DataFrame:
    """``(doc, path)``: URIs in texts ``(doc, kind, text)``, read as JSON or as separated values by ``kind``, their extension."""
    return rows.select("doc", F.explode(_uris("kind", "text")).alias("path"))
