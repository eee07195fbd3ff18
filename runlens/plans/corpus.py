"""Imports, directives and configuration includes of source corpora."""

from __future__ import annotations

from pyspark.sql import functions as F

from runlens.functions import includes as I
from runlens.operators import corpus as O
from runlens.plans import relations as R

_LOCAL = "path LIKE '/%'"


def import_edges(spark, sf_dir):
    return O.import_edges(R.corpus(spark, sf_dir)).select("src", "target")


def resolve_imports(spark, sf_dir):
    lines, files = R.corpus(spark, sf_dir), R.corpus_files(spark, sf_dir).select("path")
    return O.resolve_imports(O.import_edges(lines), files, root_dir="/src/pkg").select("src", "target", "dst", "kind", "exists")


def _closure(spark, sf_dir):
    files = R.corpus_files(spark, sf_dir).select("path")
    return O.import_closure(O.import_edges(R.corpus(spark, sf_dir)), files, files.where(_LOCAL))


def import_closure(spark, sf_dir):
    return _closure(spark, sf_dir)


def import_violations(spark, sf_dir):
    return O.import_violations(_closure(spark, sf_dir))


def packaged_imports(spark, sf_dir):
    return O.packaged_imports(_closure(spark, sf_dir))


def default_images(spark, sf_dir):
    k = F.col("p_partkey")
    image = F.concat(F.lit("meta:"), k.cast("string"))
    meta = R.table(spark, sf_dir, "part").select(
        F.concat(F.lit("/src/pkg/m"), k.cast("string"), F.lit(".wdl")).alias("path"),
        F.when(k % 3 == 0, F.create_map(F.lit("default_docker"), image, F.lit("run_docker"), F.lit("old")))
        .when(k % 3 == 1, F.create_map(F.lit("run_docker"), image))
        .alias("meta"),
    )
    return O.default_image(R.corpus(spark, sf_dir), meta, "docker")


def default_conda(spark, sf_dir):
    k = F.col("p_partkey")
    meta = R.table(spark, sf_dir, "part").select(
        F.concat(F.lit("/src/pkg/m"), k.cast("string"), F.lit(".wdl")).alias("path"),
        F.create_map(F.when(k % 2 == 0, "run_conda_env").otherwise("other"), F.col("p_name")).alias("meta"),
    )
    return O.default_image(R.corpus(spark, sf_dir), meta, "conda")


def first_match(spark, sf_dir):
    """First line of each whole document that starts with a capital vowel and holds a comma."""
    lines = R.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("path"), F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    )
    return O.first_match(lines, r"^([AEIOU][a-z]*) .*,")


def _configs(spark, sf_dir):
    """Whole document texts followed by include statements."""
    d = F.col("doc_id").cast("string")
    tail = F.concat(
        F.lit('\ninclude required(classpath("app'), d, F.lit('"))\n  include "conf'), (F.col("doc_id") % 7).cast("string"),
        F.lit('.conf"\n include file("/srv/x.hocon") # note\ninclude "z.hocon"\n'),
        F.when(F.col("doc_id") % 2 == 0, 'include "conf1.conf"\nkey = "include \\"no.conf\\""\n').otherwise(""),
    )
    return R.table(spark, sf_dir, "documents").select(d.alias("path"), F.concat("text", tail).alias("text"))


def conf_includes(spark, sf_dir):
    return O.config_includes(_configs(spark, sf_dir))


def conf_wrapped(spark, sf_dir):
    """Wrapped text, what is left without includes, and the restored text."""
    wrapped = _configs(spark, sf_dir).select("path", "text", I.wrap_includes(F.col("text")).alias("wrapped"))
    return wrapped.select(
        "path", "wrapped", I.strip_includes(F.col("wrapped")).alias("stripped"), I.restore_includes(F.col("wrapped")).alias("restored")
    )


QUERIES = {
    "import_edges": import_edges,
    "resolve_imports": resolve_imports,
    "import_closure": import_closure,
    "import_violations": import_violations,
    "packaged_imports": packaged_imports,
    "default_images": default_images,
    "default_conda": default_conda,
    "first_match": first_match,
    "conf_includes": conf_includes,
    "conf_wrapped": conf_wrapped,
}

_DST = """CASE WHEN target LIKE 'http%' OR target LIKE '/%' THEN target WHEN target LIKE '../%' THEN '/src/' || substr(target, 4)
     WHEN {src} LIKE 'http%' THEN '/src/pkg/' || target
     ELSE regexp_replace({src}, '/[^/]*$', '') || '/' || target END"""
_KIND = "CASE WHEN target LIKE 'http%' THEN 'url' WHEN target LIKE '/%' THEN 'absolute' ELSE 'relative' END"
# every local root lies in /src/pkg or /src/other; files imported by URL resolve against the root's directory
_CLOSURE = f"""RECURSIVE {R.CORPUS_SQL.strip()},
reach AS (
  SELECT path AS root, regexp_replace(path, '/[^/]*$', '') AS root_dir, path AS file, 0 AS depth, '' AS kind, CAST(NULL AS VARCHAR) AS violation, TRUE AS here
  FROM files WHERE path LIKE '/%'
  UNION
  SELECT root, root_dir, file, depth, kind,
         CASE WHEN kind = 'absolute' THEN 'absolute_path' WHEN kind = 'url' THEN NULL WHEN NOT here THEN 'missing'
              WHEN NOT starts_with(file, root_dir) THEN 'outside_root' END, here
  FROM (
    SELECT root, root_dir, dst AS file, depth + 1 AS depth, k2 AS kind, dst IN (SELECT path FROM files) AS here
    FROM (SELECT reach.*, {_KIND} AS k2,
                 CASE WHEN target LIKE 'http%' OR target LIKE '/%' THEN target
                      WHEN target LIKE '../%' THEN '/src/' || substr(target, 4)
                      ELSE CASE WHEN reach.kind = 'url' THEN root_dir ELSE regexp_replace(src, '/[^/]*$', '') END || '/' || target END AS dst
          FROM reach JOIN edges ON src = file WHERE violation IS NULL AND here AND depth < 21) AS s
  ) AS t
),
closure AS (SELECT root, file, depth, kind, violation FROM reach WHERE depth > 0)"""

_CONF = r"""conf AS (
  SELECT CAST(doc_id AS VARCHAR) AS path, text || chr(10) || 'include required(classpath("app' || CAST(doc_id AS VARCHAR) || '"))' || chr(10) ||
         '  include "conf' || CAST(doc_id % 7 AS VARCHAR) || '.conf"' || chr(10) || ' include file("/srv/x.hocon") # note' || chr(10) || 'include "z.hocon"' || chr(10) ||
         CASE WHEN doc_id % 2 = 0 THEN 'include "conf1.conf"' || chr(10) || 'key = "include \"no.conf\""' || chr(10) ELSE '' END AS text
  FROM documents)"""


def _replaced(kind: str) -> str:
    """Each statement replaced in turn, longest file form first, without any fold."""
    statements = [
        """'include required(classpath("app' || path || '"))'""",
        """'include file("/srv/x.hocon")'""",
        """'include "conf' || CAST(CAST(path AS BIGINT) % 7 AS VARCHAR) || '.conf"'""",
        """'include "z.hocon"'""",
        """'include "conf1.conf"'""",
    ]
    out = "text"
    for s in statements:
        new = "''" if kind == "strip" else f"""'HOCONSTRING_INCLUDE_' || md5({s}) || ' = "' || replace({s}, '"', '\\"') || '"'"""
        out = f"replace({out}, {s}, {new})"
    return out


ORACLES = {
    "import_edges": f"WITH {R.CORPUS_SQL} SELECT src, target FROM edges",
    "resolve_imports": f"""
        WITH {R.CORPUS_SQL}, r AS (SELECT src, target, {_DST.format(src='src')} AS dst, {_KIND} AS kind FROM edges)
        SELECT *, dst IN (SELECT path FROM files) AS exists FROM r""",
    "import_closure": f"WITH {_CLOSURE} SELECT * FROM closure",
    "import_violations": f"""
        WITH {_CLOSURE}
        SELECT root, file, depth, coalesce(violation, 'too_deep') AS violation FROM closure WHERE violation IS NOT NULL OR depth > 20""",
    "packaged_imports": f"""
        WITH {_CLOSURE}
        SELECT root, count(DISTINCT file) AS n_files FROM closure WHERE kind = 'relative' AND violation IS NULL GROUP BY root""",
    "default_images": """
        SELECT '/src/pkg/m' || CAST(p_partkey AS VARCHAR) || '.wdl' AS path,
               CASE WHEN p_partkey % 3 < 2 THEN 'meta:' || CAST(p_partkey AS VARCHAR) ELSE 'img:' || CAST(p_partkey % 5 AS VARCHAR) END AS image
        FROM part WHERE p_partkey % 3 < 2 OR p_partkey % 2 = 0""",
    "default_conda": """
        SELECT '/src/pkg/m' || CAST(p_partkey AS VARCHAR) || '.wdl' AS path, p_name AS image FROM part WHERE p_partkey % 2 = 0""",
    "first_match": r"""
        WITH l AS (SELECT doc_id AS path, generate_subscripts(string_split(text, chr(10)), 1) AS n, unnest(string_split(text, chr(10))) AS line FROM documents)
        SELECT path, arg_min(regexp_extract(line, '^([AEIOU][a-z]*) .*,', 1), n) AS value
        FROM l WHERE regexp_matches(line, '^([AEIOU][a-z]*) .*,') GROUP BY path""",
    "conf_includes": rf"""
        WITH {_CONF},
        s AS (
          SELECT path, unnest(regexp_extract_all(text, 'include\s+(?:required|url|file|classpath)\(.*\)')) AS statement FROM conf
          UNION SELECT path, unnest(regexp_extract_all(text, 'include\s+".*\.(?:conf|hocon)"')) FROM conf)
        SELECT path, 'HOCONSTRING_INCLUDE_' || md5(statement) AS key, statement FROM (SELECT DISTINCT * FROM s) WHERE NOT contains(statement, '\"')""",
    "conf_wrapped": f"""
        WITH {_CONF} SELECT path, {_replaced('wrap')} AS wrapped, {_replaced('strip')} AS stripped, text AS restored FROM conf""",
}
