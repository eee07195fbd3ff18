"""Flatten, unflatten, merge, split and leaf walk of nested documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from runlens.operators import nested as N
from runlens.plans import relations as R


def flatten_doc(spark, sf_dir):
    flat = N.flatten_doc(R.nested_docs(spark, sf_dir), keep=["event_id"])
    return flat.select("event_id", N.dot_key(F.col("path")).alias("path"), "value")


def leaf_values(spark, sf_dir):
    leaves = N.leaf_values(R.nested_docs(spark, sf_dir), keep=["event_id"])
    return leaves.select("event_id", N.dot_key(F.col("path")).alias("path"), "value")


def unflatten_doc(spark, sf_dir):
    return N.unflatten_doc(N.flatten_doc(R.nested_docs(spark, sf_dir), keep=["event_id"]), ["event_id"])


def merge_docs(spark, sf_dir):
    """Three layers per event: nested, overriding a scalar by an object, and back."""
    e = F.col("event_id")
    first = F.to_json(F.struct(F.struct(e.alias("p"), F.lit(2).alias("q")).alias("a"), F.struct(e.alias("x")).alias("b"), F.lit(7).alias("c")))
    second = F.to_json(F.struct(F.struct(F.lit("new").alias("q"), F.array(e).alias("r")).alias("a"), F.col("event_type").alias("b")))
    third = F.to_json(F.struct(F.when(e % 2 == 0, F.struct(e.alias("z"))).alias("c"), F.struct(F.lit(1).alias("k")).alias("d")))
    layers = F.posexplode(F.array(first, second, third)).alias("layer", "text")
    rows = R.spread(spark, sf_dir, "events").select("event_id", layers)
    return N.merge_docs(rows.select("event_id", "layer", F.parse_json("text").alias("doc")), "event_id", "layer")


def split_doc(spark, sf_dir):
    return N.split_docs(R.nested_docs(spark, sf_dir), [("replicate", r"^rep\d+$")], keep=["event_id"])


def split_leaves(spark, sf_dir):
    rules = [("replicate", r"^rep\d+$"), ("reads", "^read")]
    leaves = N.split_leaves(R.nested_docs(spark, sf_dir), rules, keep=["event_id"])
    return leaves.select("event_id", "rule", "key", N.dot_key(F.col("path")).alias("path"), "value")


QUERIES = {
    "flatten_doc": flatten_doc,
    "leaf_values": leaf_values,
    "unflatten_doc": unflatten_doc,
    "merge_docs": merge_docs,
    "split_doc": split_doc,
    "split_leaves": split_leaves,
}

# numbers as the JSON text of a double
_V = "CASE WHEN {0} = floor({0}) THEN CAST(CAST({0} AS BIGINT) AS VARCHAR) ELSE CAST({0} AS VARCHAR) END"
_BASE = f"""
ev AS (
  SELECT event_id AS e, {_V.format('value')} AS v0, {_V.format('(value + 1)')} AS v1, event_type AS kind,
         CAST(json_extract(props, '$.k') AS VARCHAR) AS k, CAST(user_id AS VARCHAR) AS usr
  FROM events
)"""

ORACLES = {
    "split_leaves": """
        WITH f AS (
          SELECT event_id, 'rep1' AS rep, 'read1' AS rd, event_id + 1 AS n FROM events
          UNION ALL SELECT event_id, 'rep1', 'read2', event_id FROM events
          UNION ALL SELECT event_id, 'rep2', 'read1', event_id + 2 FROM events
          UNION ALL SELECT event_id, 'rep2', 'read2', event_id * 2 FROM events)
        SELECT event_id, 'replicate' AS rule, rep AS key, 'flagstat.' || rd AS path, CAST(n AS VARCHAR) AS value FROM f
        UNION ALL SELECT event_id, 'reads', rd, 'flagstat.' || rep, CAST(n AS VARCHAR) FROM f
        UNION ALL SELECT event_id, NULL, NULL, 'list', list_v FROM (SELECT event_id, '[' || a || ',' || b || ']' AS list_v FROM (
            SELECT event_id, {a} AS a, {b} AS b FROM events))
        UNION ALL SELECT event_id, NULL, NULL, 'meta.kind', '"' || event_type || '"' FROM events
        UNION ALL SELECT event_id, NULL, NULL, 'meta.props.k', CAST(json_extract(props, '$.k') AS VARCHAR) FROM events
        UNION ALL SELECT event_id, NULL, NULL, 'user', CAST(user_id AS VARCHAR) FROM events""".format(
        a=_V.format("value"), b=_V.format("(value + 1)")
    ),
    "flatten_doc": f"""
        WITH {_BASE}
        SELECT e AS event_id, 'flagstat.rep1.read1' AS path, CAST(e + 1 AS VARCHAR) AS value FROM ev
        UNION ALL SELECT e, 'flagstat.rep1.read2', CAST(e AS VARCHAR) FROM ev
        UNION ALL SELECT e, 'flagstat.rep2.read1', CAST(e + 2 AS VARCHAR) FROM ev
        UNION ALL SELECT e, 'flagstat.rep2.read2', CAST(e * 2 AS VARCHAR) FROM ev
        UNION ALL SELECT e, 'list', '[' || v0 || ',' || v1 || ']' FROM ev
        UNION ALL SELECT e, 'meta.kind', '"' || kind || '"' FROM ev
        UNION ALL SELECT e, 'meta.props.k', k FROM ev
        UNION ALL SELECT e, 'user', usr FROM ev""",
    "leaf_values": f"""
        WITH {_BASE}
        SELECT e AS event_id, 'flagstat.rep1.read1' AS path, CAST(e + 1 AS VARCHAR) AS value FROM ev
        UNION ALL SELECT e, 'flagstat.rep1.read2', CAST(e AS VARCHAR) FROM ev
        UNION ALL SELECT e, 'flagstat.rep2.read1', CAST(e + 2 AS VARCHAR) FROM ev
        UNION ALL SELECT e, 'flagstat.rep2.read2', CAST(e * 2 AS VARCHAR) FROM ev
        UNION ALL SELECT e, 'list.0', v0 FROM ev
        UNION ALL SELECT e, 'list.1', v1 FROM ev
        UNION ALL SELECT e, 'meta.kind', kind FROM ev
        UNION ALL SELECT e, 'meta.props.k', k FROM ev
        UNION ALL SELECT e, 'user', usr FROM ev""",
    "unflatten_doc": f"""
        WITH {_BASE}
        SELECT e AS event_id, '{{"flagstat":{{"rep1":{{"read1":' || CAST(e + 1 AS VARCHAR) || ',"read2":' || CAST(e AS VARCHAR) ||
               '}},"rep2":{{"read1":' || CAST(e + 2 AS VARCHAR) || ',"read2":' || CAST(e * 2 AS VARCHAR) || '}}}},"list":[' || v0 || ',' || v1 ||
               '],"meta":{{"kind":"' || kind || '","props":{{"k":' || k || '}}}},"user":' || usr || '}}' AS doc
        FROM ev""",
    "merge_docs": """
        WITH ev AS (SELECT event_id, event_type, CAST(event_id AS VARCHAR) AS e FROM events)
        SELECT event_id, '{"a":{"p":' || e || ',"q":"new","r":[' || e || ']},"b":"' || event_type || '","c":' ||
               CASE WHEN event_id % 2 = 0 THEN '{"z":' || e || '}' ELSE '7' END || ',"d":{"k":1}}' AS doc
        FROM ev""",
    "split_doc": f"""
        WITH {_BASE}
        SELECT e AS event_id, 'replicate' AS rule, 'rep1' AS key, '{{"flagstat":{{"read1":' || CAST(e + 1 AS VARCHAR) || ',"read2":' ||
               CAST(e AS VARCHAR) || '}},"replicate":"rep1"}}' AS doc FROM ev
        UNION ALL
        SELECT e, 'replicate', 'rep2', '{{"flagstat":{{"read1":' || CAST(e + 2 AS VARCHAR) || ',"read2":' || CAST(e * 2 AS VARCHAR) ||
               '}},"replicate":"rep2"}}' FROM ev
        UNION ALL
        SELECT e, NULL, NULL, '{{"list":[' || v0 || ',' || v1 || '],"meta":{{"kind":"' || kind || '","props":{{"k":' || k || '}}}},"user":' || usr || '}}' FROM ev""",
}
