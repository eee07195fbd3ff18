"""Search, listing, labels and id predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from runlens.functions import ids as I, labels as L, uris as U
from runlens.operators import calls as C, closure, search as S
from runlens.plans import relations as R

# search parameters
ID_PATTERNS = ["000000?a-*", "*f[0-3]"]
LABEL_PATTERNS = [("run-str-label", "1-URG*-[!0-4]?"), ("run-user", "user7")]
EXACT_IDS = [f"{k:08x}-0000-4000-a000-{k:012x}" for k in (1, 2, 33, 77, 999)] + ["not-an-id", "0000000A"]
EXACT_LABELS = [("run-str-label", "5-LOW-7"), ("run-user", "user11"), ("run-user", "")]


def _ids_and_labels(df):
    return df.select("id", "status", F.col("labels")["run-str-label"].alias("str_label"))


def list_workflows(spark, sf_dir):
    return S.list_workflows(S.hide_before(R.listing(spark, sf_dir), "1997-06-01"), (*S.DEFAULT_FORMAT, "backend"))


def find_wildcard(spark, sf_dir):
    return _ids_and_labels(S.find_with_wildcard(R.listing(spark, sf_dir), ID_PATTERNS, LABEL_PATTERNS))


def find_ids(spark, sf_dir):
    return _ids_and_labels(S.find_by_ids(R.listing(spark, sf_dir), EXACT_IDS, exclude_subworkflow=False))


def find_labels(spark, sf_dir):
    return _ids_and_labels(S.find_by_labels(R.listing(spark, sf_dir), EXACT_LABELS))


def find_union(spark, sf_dir):
    return _ids_and_labels(S.find(R.listing(spark, sf_dir), EXACT_IDS, EXACT_LABELS))


def get_metadata(spark, sf_dir):
    found = S.find(R.listing(spark, sf_dir), None, [("run-str-label", "?-*-1?")])
    docs = C.workflow_header(R.documents(spark, sf_dir)).select("id", "failures")
    return S.get_metadata(found, docs)


def exclude_subworkflows(spark, sf_dir):
    return S.exclude_subworkflows(R.listing(spark, sf_dir)).select("id")


def hide_before(spark, sf_dir):
    return S.hide_before(R.listing(spark, sf_dir), "1998-03-01T00:00:00").select("id", "submission")


def get_label(spark, sf_dir):
    return S.get_label(R.listing(spark, sf_dir), EXACT_IDS[1], "run-user")


def _label_map(col):
    entries = F.array_sort(F.map_entries(col))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")


def labels_build(spark, sf_dir):
    """Labels for every document, with its whole text as the string label."""
    d = F.col("doc_id")
    text = F.concat(F.col("source"), F.lit(":"), F.when(d % 3 == 0, "a?b*").otherwise(""), F.col("text"))
    custom = F.to_json(
        F.struct(F.col("lang").alias("hello"), F.struct(d.alias("bye")).alias("good"), F.lit("x").alias("run-user"))
    )
    docs = R.table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(d % 4 != 1, custom).alias("custom"),
        F.when(d % 5 == 2, "gcp").when(d % 5 == 3, "").alias("backend"),
        F.when(d % 7 != 6, text).alias("str_label"),
        F.lit("me").alias("user"),
        F.concat(F.lit("gs://b/in."), d.cast("string"), F.lit(".json")).alias("inputs"),
    )
    return S.build_labels(docs, inputs="inputs").select("doc_id", _label_map(F.col("labels")).alias("labels"))


def labels_update(spark, sf_dir):
    """Updates from line items: the highest sequence number wins per key."""
    updates = R.table(spark, sf_dir, "lineitem").select(
        R.uuid_of(F.col("l_orderkey")).alias("id"),
        F.when(F.col("l_returnflag") == "R", "run-str-label").otherwise(F.concat(F.lit("flag-"), "l_returnflag")).alias("key"),
        F.concat_ws("-", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("val"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("seq"),
    )
    updated = S.update_labels(R.listing(spark, sf_dir), updates)
    return updated.select("id", _label_map(F.col("labels")).alias("labels"))


def label_clean(spark, sf_dir):
    return R.table(spark, sf_dir, "documents").select(
        "doc_id", L.clean_label(F.col("text")).alias("label"), L.label_changed(F.col("text")).alias("changed")
    )


def uuid_valid(spark, sf_dir):
    """Valid ids and the ways in which they can be malformed."""
    k = F.col("o_orderkey")
    u = R.uuid_of(k)
    forms = [
        u,
        F.upper(u),
        F.substring(u, 1, 30),
        F.replace(u, F.lit("-"), F.lit("")),
        F.concat(F.lit("{"), u, F.lit("}")),
        F.concat(F.lit("wf-"), u),
        F.concat(F.lit("urn:uuid:"), u),
        F.translate(u, "abcdef", "123456"),
        F.lit(None).cast("string"),
    ]
    value = F.get(F.array(*forms), (k % len(forms)).cast("int"))
    orders = R.table(spark, sf_dir, "orders").select("o_orderkey", value.alias("value"))
    return orders.select("o_orderkey", "value", I.is_valid_uuid(F.col("value")).alias("valid"))


def has_wildcard(spark, sf_dir):
    return R.table(spark, sf_dir, "documents").select(
        "doc_id",
        I.has_wildcard(F.col("text")).alias("in_text"),
        I.has_wildcard_any(F.split("text", " ")).alias("in_words"),
        I.wildcard_match(F.col("text"), "[!A-M]*[aeiou]?.").alias("matches"),
    )


def subworkflow_closure(spark, sf_dir):
    return closure.expand_subworkflows(R.listing(spark, sf_dir))


def embedded_documents(spark, sf_dir):
    return closure.embed_subworkflows(R.naming_documents(spark, sf_dir))


def uri_parts(spark, sf_dir):
    """Parts of web addresses, and of the same addresses as bucket and local paths."""
    pages = R.table(spark, sf_dir, "pages").select("page_id", "url")
    bare = F.regexp_replace("url", "^https?://", "")
    forms = F.array("url", F.concat(F.lit("gs://"), bare), F.concat(F.lit("s3://"), bare), F.concat(F.lit("/"), bare), bare)
    rows = pages.select("page_id", F.posexplode(forms).alias("form", "uri"))
    u = F.col("uri")
    return rows.select(
        "page_id", "form", "uri",
        U.uri_scheme(u).alias("scheme"),
        U.basename(u).alias("base"),
        U.basename_wo_ext(u).alias("stem"),
        U.dirname(u).alias("dir"),
        U.bucket_of(u).alias("bucket"),
    )


QUERIES = {
    "list_workflows": list_workflows,
    "find_wildcard": find_wildcard,
    "find_ids": find_ids,
    "find_labels": find_labels,
    "find_union": find_union,
    "get_metadata": get_metadata,
    "exclude_subworkflows": exclude_subworkflows,
    "hide_before": hide_before,
    "get_label": get_label,
    "labels_build": labels_build,
    "labels_update": labels_update,
    "label_clean": label_clean,
    "uuid_valid": uuid_valid,
    "has_wildcard": has_wildcard,
    "subworkflow_closure": subworkflow_closure,
    "embedded_documents": embedded_documents,
    "uri_parts": uri_parts,
}

_ROWS = "SELECT id, status, str_label FROM wf"
_IDS = ", ".join(f"'{i}'" for i in EXACT_IDS)

ORACLES = {
    "list_workflows": f"""
        WITH {R.LISTING_SQL}
        SELECT id, status, name, coalesce(str_label, 'None') AS str_label, usr AS "user", coalesce(parent, 'None') AS parent,
               coalesce(submission, 'None') AS submission, 'None' AS backend
        FROM wf WHERE submission IS NULL OR submission > '1997-06-01'""",
    "find_wildcard": f"""
        WITH {R.LISTING_SQL} {_ROWS}
        WHERE parent IS NULL AND (id GLOB '000000?a-*' OR id GLOB '*f[0-3]' OR str_label GLOB '1-URG*-[!0-4]?' OR usr = 'user7')""",
    "find_ids": f"WITH {R.LISTING_SQL} {_ROWS} WHERE id IN ({_IDS})",
    "find_labels": f"""
        WITH {R.LISTING_SQL} {_ROWS} WHERE parent IS NULL AND (str_label = '5-LOW-7' OR usr = 'user11')""",
    "find_union": f"""
        WITH {R.LISTING_SQL}, byl AS ({_ROWS} WHERE parent IS NULL AND (str_label = '5-LOW-7' OR usr = 'user11'))
        SELECT * FROM byl UNION ALL {_ROWS} WHERE parent IS NULL AND id IN ({_IDS}) AND id NOT IN (SELECT id FROM byl)""",
    "get_metadata": f"""
        WITH {R.LISTING_SQL}
        SELECT id, CASE WHEN status = 'Failed' THEN '[{{"message":"boom ' || CAST(k AS VARCHAR) || '","causedBy":[]}}]' END AS failures
        FROM wf WHERE parent IS NULL AND str_label GLOB '?-*-1?'""",
    "exclude_subworkflows": f"WITH {R.LISTING_SQL} SELECT id FROM wf WHERE parent IS NULL",
    "hide_before": f"""
        WITH {R.LISTING_SQL}
        SELECT id, submission FROM wf WHERE NOT coalesce(submission <= '1998-03-01T00:00:00', FALSE)""",
    "get_label": f"WITH {R.LISTING_SQL} SELECT id, usr AS value FROM wf WHERE id = '{EXACT_IDS[1]}'",
    "labels_build": r"""
        WITH d AS (
          SELECT doc_id, CASE WHEN doc_id % 4 <> 1 THEN lang END AS hello,
                 CASE WHEN doc_id % 4 <> 1 THEN '{"bye":' || CAST(doc_id AS VARCHAR) || '}' END AS good,
                 CASE WHEN doc_id % 7 <> 6 THEN regexp_replace(source || ':' || CASE WHEN doc_id % 3 = 0 THEN 'a?b*' ELSE '' END || text, '[:?*]', '_', 'g')
                      ELSE 'in.' || CAST(doc_id AS VARCHAR) END AS lbl
          FROM documents)
        SELECT doc_id, CASE WHEN good IS NULL THEN '' ELSE 'good=' || good || ';' || 'hello=' || hello || ';' END ||
               CASE WHEN doc_id % 5 = 2 THEN 'run-backend=gcp;' ELSE '' END || 'run-str-label=' || lbl || ';run-user=me' AS labels
        FROM d""",
    "labels_update": f"""
        WITH {R.LISTING_SQL},
        upd AS (SELECT {R.uuid_sql('l_orderkey')} AS id, CASE WHEN l_returnflag = 'R' THEN 'run-str-label' ELSE 'flag-' || l_returnflag END AS key,
                       CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS val, l_linenumber, l_partkey, l_suppkey FROM lineitem),
        last AS (SELECT id, key, val FROM upd
                 QUALIFY row_number() OVER (PARTITION BY id, key ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC) = 1),
        allp AS (SELECT id, key, val FROM last
                 UNION ALL SELECT id, 'run-user', usr FROM wf
                 UNION ALL SELECT id, 'run-str-label', str_label FROM wf
                   WHERE str_label IS NOT NULL AND id NOT IN (SELECT id FROM last WHERE key = 'run-str-label'))
        SELECT id, string_agg(key || '=' || val, ';' ORDER BY key) AS labels FROM allp GROUP BY id""",
    "label_clean": """
        SELECT doc_id, replace(replace(replace(text, ':', '_'), '?', '_'), '*', '_') AS label,
               contains(text, ':') OR contains(text, '?') OR contains(text, '*') AS changed
        FROM documents""",
    "uuid_valid": f"""
        WITH u AS (SELECT o_orderkey, o_orderkey % 9 AS f, {R.uuid_sql('o_orderkey')} AS u FROM orders)
        SELECT o_orderkey, CASE f WHEN 0 THEN u WHEN 1 THEN upper(u) WHEN 2 THEN substr(u, 1, 30) WHEN 3 THEN replace(u, '-', '')
                 WHEN 4 THEN '{{' || u || '}}' WHEN 5 THEN 'wf-' || u WHEN 6 THEN 'urn:uuid:' || u WHEN 7 THEN translate(u, 'abcdef', '123456') END AS value,
               f IN (0, 3, 4, 6) AS valid
        FROM u""",
    "has_wildcard": """
        SELECT doc_id, contains(text, '?') OR contains(text, '*') AS in_text, contains(text, '?') OR contains(text, '*') AS in_words,
               regexp_full_match(text, '(?s)[^A-M].*[aeiou].[.]') AS matches
        FROM documents""",
    "subworkflow_closure": f"""
        WITH RECURSIVE {R.LISTING_SQL.strip()},
        tree AS (
          SELECT id AS root_id, id AS descendant_id, 0 AS depth FROM wf WHERE parent IS NULL
          UNION ALL
          SELECT root_id, wf.id, depth + 1 FROM tree JOIN wf ON wf.parent = descendant_id
        )
        SELECT root_id, descendant_id, depth FROM tree WHERE depth > 0""",
    "embedded_documents": f"""
        WITH {R.NAMING_SQL},
        every AS ({' UNION ALL '.join(f'SELECT * FROM e{d}' for d in range(R._DIGITS + 1))})
        SELECT own.id, doc, CAST(levels AS INTEGER) AS levels FROM every JOIN own ON own.k = every.k
        WHERE NOT (own.k % 10 BETWEEN 1 AND 7 AND own.k // 10 IN (SELECT k FROM own))""",
    "uri_parts": r"""
        WITH b AS (SELECT page_id, url, regexp_replace(url, '^https?://', '') AS bare FROM pages),
        f AS (SELECT page_id, 0 AS form, url AS uri FROM b UNION ALL SELECT page_id, 1, 'gs://' || bare FROM b
              UNION ALL SELECT page_id, 2, 's3://' || bare FROM b UNION ALL SELECT page_id, 3, '/' || bare FROM b
              UNION ALL SELECT page_id, 4, bare FROM b),
        p AS (SELECT *, string_split(uri, '/')[-1] AS base FROM f),
        q AS (SELECT *, length(base) - length(string_split(base, '.')[-1]) - 1 AS cut FROM p)
        SELECT page_id, form, uri, CASE WHEN form = 0 THEN 'http' WHEN form = 1 THEN 'gs' WHEN form = 2 THEN 's3' WHEN form = 3 THEN 'local' END AS scheme,
               base, CASE WHEN length(ltrim(left(base, greatest(cut, 0)), '.')) > 0 THEN left(base, cut) ELSE base END AS stem,
               left(uri, greatest(length(uri) - length(base) - 1, 0)) AS dir,
               string_split(regexp_replace(uri, '^s3://', ''), '/')[1] AS bucket
        FROM q""",
}
