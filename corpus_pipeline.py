"""From raw documents to packed training sequences, in stages.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and returns the
columns of documents; the last returns the pieces of sequences.

Defined cases: a null or empty text, and one without a letter, has no language and goes in the first stage. A
row without id is no duplicate, keeps its passages and takes nobody else's. Rows that repeat an id and its
text are folded to one in the near-duplicate stage; rows of one id with different texts are one document there,
and stay or go together. Of documents that are equal or near, the smallest id stays. Very long texts are
worked on whole; in packing they are cut into pieces. Other columns of documents are carried along, whatever their
names; n_chars follows the text where it is there. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm import langid, near_dedup, packing, pii, suffix_dedup
from runlens.session import stage

#: Share of common word shingles from which documents are near-duplicates here; op10 has its own contract's 85.
NEAR_PERCENT = 80


def _with_text(rows: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """``row`` with its text and n_chars replaced; a null text stays null."""
    changed = {"text": F.when(F.col("row.text").isNotNull(), F.col(text))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("row.text").isNotNull(), F.length(text)).otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType)
    return rows.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a margin; the others go."""
    learned = langid.fit(docs.where(~langid.held_out()))
    return langid.predict(docs, learned).where("not rejected").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near-duplicates; one row of those that repeat its id and text."""
    gone = near_dedup.near_duplicates(docs, percent=NEAR_PERCENT).where("not kept").select(F.col("id").alias("gone_id")).distinct()
    left = docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
    # ids alone tell which rows repeat; the others' texts aren't compared
    many = docs.where("doc_id is not null").groupBy(F.col("doc_id").alias("many_id")).count().where("count > 1").select("many_id")
    folded = left.join(many, left["doc_id"] == many["many_id"], "left_semi").dropDuplicates(["doc_id", "text"])
    return left.join(many, left["doc_id"] == many["many_id"], "left_anti").unionByName(folded)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has."""
    return _with_text(suffix_dedup.remove_repeats(docs), docs, "kept_text")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return _with_text(pii.find_pii(docs), docs, "clean")


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences."""
    import public_tokenizers

    cut = packing.pieces(docs, str(public_tokenizers.path("word_bpe_49k.json")), keep=["doc_id"])
    return packing.pack(cut).select("row.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language ID", language),
    ("MinHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("PII", personal_data),
    ("best-fit packing", sequences),
]

#: Compression, MinHash and the tokenizer have no SQL; tests/llm hold every stage's decisions against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
