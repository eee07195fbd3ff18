"""The registered queries of this subpackage, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm import collocations, infill, langid, licenses, near_dedup, packing, pieces, pii, quality, suffix_dedup, topk, url_templates, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP1_WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS payload_digest FROM p),
g AS (SELECT payload_digest, max(page_id) AS first FROM d WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, d.payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM d LEFT JOIN g ON d.payload_digest = g.payload_digest AND payload_bytes >= 1000
"""


URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op2_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    cut = packing.pieces(table(spark, sf_dir, "documents"), str(public_tokenizers.path("word_bpe_49k.json")), keep=["doc_id"])
    return packing.pack(cut).select("row.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.col("quality") == 1)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return left.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select(
        "row.doc_id",
        *[pii.count(F.col("spans"), k).alias(f"n_{k}") for k in pii.BASE],
        F.sha2(pii.joined(F.col("spans"), True).cast("binary"), 256).alias("base_sha256"),
        pii.joined(F.col("spans"), False).alias("spans"),
    )


def _pieces(spark: SparkSession, sf_dir: str, fold: str) -> DataFrame:
    import public_tokenizers
    import sentencepiece

    file = str(public_tokenizers.path("piece_bpe_32k.model"))
    model = sentencepiece.SentencePieceProcessor(model_file=file)
    ids = F.array_join("ids", ",")
    encoded = pieces.encode(table(spark, sf_dir, "documents"), pieces.piece_table(spark, file), fold=fold).withColumns({"n_pieces": F.size("ids").cast("long"), "ids_crc32": F.crc32(ids.cast("binary"))})
    back = pieces.decode(encoded, [model.id_to_piece(i) for i in range(model.vocab_size())], keep=["doc_id", "n_pieces", "ids_crc32"])
    return back.select("row.*", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: number and checksum of its piece ids, and the digest of the text that they decode to."""
    return _pieces(spark, sf_dir, "merge")


def op7_pieces_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from the best path through the lattice, folded by ``aggregate``."""
    return _pieces(spark, sf_dir, "viterbi")


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(topk.quantised(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0)


OP8_TOPK = """
WITH v AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = langid.fit(docs.where(~langid.held_out()))
    found = langid.predict(docs, learned, keep=["doc_id"])
    return found.select("row.doc_id", F.col("row.doc_id").alias("id"), "lang_pred", "score", "rejected").select("doc_id", langid.held_out("id").alias("held_out"), "lang_pred", "score", "rejected")


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


OP10_NEAR_DEDUP = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' ')))) AS s
  FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_n FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * both_n >= 85 * (x.n + y.n - both_n)),
r AS (SELECT doc_id AS node, doc_id AS root FROM w UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.node)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.root AS component_id, w.doc_id = c.root AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT node, min(root) AS root FROM r GROUP BY 1) c ON c.node = w.doc_id
"""


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    made = infill.fill_in_middle(table(spark, sf_dir, "documents"), keep=["doc_id"])
    back = infill.restore(F.col("output"), F.col("form"))
    return made.select("row.doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(back).alias("restored_sha256"))


OP11_INFILL = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
d AS (
  SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS x, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS y,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM t),
p AS (
  SELECT *, array_to_string(u[1:least(x, y)], '') AS pre, array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS mid, array_to_string(u[greatest(x, y) + 1:], '') AS suf FROM d)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"), keep=["doc_id"])
    joined = lambda c: F.array_join(c, ",").alias(c)
    return found.select("row.doc_id", "n_words", "n_base", "first_word", "last_word", joined("base_labels"), joined("labels"), "score")


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


OP12_LICENSES = f"""
WITH t(t, label, notice) AS (VALUES {_values([(k, t.label, t.notice) for k, t in enumerate(licenses.TEMPLATES)])}),
k(t, key) AS (VALUES {_values([(k, key) for k, t in enumerate(licenses.TEMPLATES) for key in t.keys])}),
b(phrase, label) AS (VALUES {_values(list(licenses.PHRASES.items()))}),
w AS MATERIALIZED (
  SELECT row_number() OVER () AS id, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM documents),
x AS MATERIALIZED (SELECT id, unnest(w) AS w, unnest(range(len(w))) AS i FROM w),
tw AS (SELECT t, unnest(string_split(notice, ' ')) AS w, unnest(range(len(string_split(notice, ' ')))) AS p FROM t),
n AS (SELECT v.w, count(DISTINCT id) AS n FROM (SELECT DISTINCT w FROM tw) v LEFT JOIN x ON x.w = v.w GROUP BY 1),
ix AS (SELECT t, w FROM (SELECT DISTINCT t, tw.w, n FROM tw JOIN n ON n.w = tw.w) QUALIFY row_number() OVER (PARTITION BY t ORDER BY n, w) <= {licenses.INDEX_WORDS}),
c AS (SELECT id, tw.t, i - p AS pos FROM x JOIN ix ON ix.w = x.w JOIN tw ON tw.t = ix.t AND tw.w = ix.w GROUP BY ALL HAVING count(*) >= {licenses.MIN_AGREEING}),
m AS (SELECT c.id, c.t, c.pos, count(x.w) / count(*) AS share FROM c JOIN tw ON tw.t = c.t LEFT JOIN x ON x.id = c.id AND x.i = c.pos + tw.p AND x.w = tw.w GROUP BY ALL),
s AS (
  SELECT m.id, label, share FROM m JOIN t ON t.t = m.t JOIN w ON w.id = m.id
  WHERE share >= {licenses.MIN_SHARE} AND NOT EXISTS (SELECT 1 FROM k WHERE k.t = m.t AND NOT contains(
    ' ' || array_to_string(w.w[greatest(pos - {licenses.SLACK}, 0) + 1:pos + len(string_split(notice, ' ')) + {licenses.SLACK}], ' ') || ' ', ' ' || key || ' '))),
p AS (SELECT x.id, b.label, x.i FROM b JOIN x ON x.w = string_split(phrase, ' ')[1] JOIN w ON w.id = x.id AND array_to_string(w.w[x.i + 1:x.i + len(string_split(phrase, ' '))], ' ') = phrase),
f AS (SELECT id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM p GROUP BY 1),
l AS (SELECT id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM (SELECT id, label, share FROM s UNION ALL SELECT id, label, 1.0 FROM p) GROUP BY 1)
SELECT doc_id, len(w.w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM w LEFT JOIN f ON f.id = w.id LEFT JOIN l ON l.id = w.id
"""


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


OP13_COLLOCATIONS = """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM p),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM w, range(1, 6) r(k) WHERE len(w) >= k),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY 1),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND a >= 100),
o AS (
  SELECT lang, phrase, max(outer_a) AS outer_a FROM (
    SELECT lang, array_to_string(w[1:k - 1], ' ') AS phrase, a AS outer_a FROM c UNION ALL SELECT lang, array_to_string(w[2:k], ' '), a FROM c) GROUP BY ALL),
s AS (
  SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, n.n, (1000::HUGEINT * c.a * n.n) // (x.a::HUGEINT * y.a) AS score, cut.k
  FROM c JOIN range(1, 5) cut(k) ON cut.k < c.k JOIN n ON n.lang = c.lang
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:cut.k], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut.k + 1:c.k], ' ')
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, cut.k) = 1),
t AS (
  SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank, s.phrase, a, l, r, n, score
  FROM s LEFT JOIN o ON o.lang = s.lang AND o.phrase = s.phrase WHERE outer_a IS NULL OR outer_a < a)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM t WHERE rank <= 2000
"""


QUERIES = {"op1_warc": op1_warc, "op2_url_templates": op2_url_templates, "op3_packing": op3_packing, "op4_quality": op4_quality, "op5_suffix_dedup": op5_suffix_dedup, "op6_pii": op6_pii, "op7_pieces": op7_pieces, "op7_pieces_viterbi": op7_pieces_viterbi, "op8_topk": op8_topk, "op9_langid": op9_langid, "op10_near_dedup": op10_near_dedup, "op11_infill": op11_infill, "op12_licenses": op12_licenses, "op13_collocations": op13_collocations}
ORACLES = {"op1_warc": OP1_WARC, "op8_topk": OP8_TOPK, "op10_near_dedup": OP10_NEAR_DEDUP, "op11_infill": OP11_INFILL, "op12_licenses": OP12_LICENSES, "op13_collocations": OP13_COLLOCATIONS}
