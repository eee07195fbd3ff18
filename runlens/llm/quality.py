"""Quality rules: counts per text, and a hashed n-gram log-likelihood ratio.

Single words and word pairs are hashed to BUCKETS buckets. Two multinomials over the buckets are counted
on all documents: the raw corpus, and the documents that are labelled good. A document's score is the sum
of its n-grams' log ratios, good over raw, divided by their number; it is kept from THRESHOLD on. Ratios
are whole numbers of millionths, so that sums don't depend on their order and the verdict is exact.

DataFrame functions only. Texts stay in their rows: repeated word windows are found by sorting hashes
within the row. One shuffle moves texts to their labels; counting combines to BUCKETS rows per task, and
the ratios (BUCKETS numbers, one row) reach the scoring pass as a scalar subquery.

Defined cases: a null text has no words and fails the base rules; n_words, the counts and the score are
then 0. Labels of a document that appears several times in ``labels`` count once; it is good if any
row says so. Documents without label or id belong to the raw corpus alone. Without any good document, or
any document, all ratios are 0. Repeated rows count as often as they come. Very long texts are scored whole,
within their row. Columns other than id and text are not read, so their names can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 14
#: Millionths of a log ratio per n-gram.
THRESHOLD = -60_000
SCALE = 1_000_000
WINDOW = 8
MIN_WORDS, MAX_REPEATED_PERCENT = 20, 30

_BLANK = r"[\x20\x09-\x0D]+"
_BLANKS = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Words of a text in order; none for null."""
    inner = F.btrim(text, F.lit(_BLANKS))
    return F.when(F.coalesce(inner, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(inner, _BLANK))


def with_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``words`` and the base counts: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    n = F.size("words")
    windows = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))
    step1 = df.withColumns({"words": words(F.col(text)), "lines": lines}).withColumn("windows", windows)
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    step2 = step1.withColumn("sorted", F.when(repeats, F.array_sort(placed)).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    same = lambda x, k: F.coalesce(F.get("sorted", k)["h"] == x["h"], F.lit(False))
    again = F.filter("sorted", lambda x, k: same(x, k - 1) | same(x, k + 1))
    step3 = step2.withColumn("places", F.array_sort(F.transform(again, lambda x: x["i"])))
    covered = F.transform("places", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("places", k + 1) - p, F.lit(WINDOW))).cast("long"))
    return step3.withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "word_chars": F.length(F.array_join("words", "")).cast("long"),
            "n_symbols": F.regexp_count(body, F.lit(r"[#*$%&|<>]")).cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "n_repeat_words": F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x),
        }
    ).drop("lines", "windows", "sorted", "places")


def grams(buckets: int = BUCKETS) -> Column:
    """Buckets of the single words and pairs of column ``words``."""
    place = lambda h: F.pmod(h, F.lit(buckets)).cast("int")
    single = F.transform("words", lambda w: place(F.xxhash64(w)))
    pairs = F.when(F.size("words") > 1, F.transform(F.sequence(F.lit(0), F.size("words") - 2), lambda i: place(F.xxhash64(F.get("words", i), F.get("words", i + 1)))))
    return F.concat(single, F.coalesce(pairs, F.array().cast("array<int>")))


def ratios(docs: DataFrame, labels: DataFrame, good: Column, doc_id: str = "doc_id", text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """One row, ``ratios``: millionths of the log ratio of each bucket, with one added to each count.

    Labels grow with the documents, so they are never broadcast.
    """
    trusted = labels.where(good & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("good_id")).distinct()
    told = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(trusted.hint("merge"), F.col("id") == F.col("good_id"), "left")
    each = told.select(F.col("good_id").isNotNull().cast("long").alias("good"), words(F.col("text")).alias("words")).select("good", F.explode(grams(buckets)).alias("bucket"))
    counted = each.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("good").alias("good"))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"), F.lit(0).cast("long").alias("raw"), F.lit(0).cast("long").alias("good"))
    whole = counted.union(every).groupBy("bucket").agg((F.sum("raw") + 1).alias("raw"), (F.sum("good") + 1).alias("good"))
    listed = whole.agg(F.array_sort(F.collect_list(F.struct("bucket", "raw", "good"))).alias("all"), F.sum("raw").alias("raws"), F.sum("good").alias("goods"))
    ratio = lambda x: F.round((F.log(x["good"]) - F.log("goods") - F.log(x["raw"]) + F.log("raws")) * SCALE).cast("long")
    return listed.select(F.when(F.col("goods") > buckets, F.transform("all", ratio)).otherwise(F.transform("all", lambda x: F.lit(0).cast("long"))).alias("ratios"))


def judge(docs: DataFrame, labels: DataFrame, good: Column, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """Per row: ``doc_id``, the base counts, ``base_failed``, ``score`` (mean log ratio), ``kept``."""
    learned = ratios(docs, labels, good, doc_id, text)
    rows = with_counts(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    total = F.aggregate(grams(), F.lit(0).cast("long"), lambda a, b: a + F.get("ratios", b))
    scored = rows.withColumn("ratios", learned.scalar()).withColumns({"total": total, "n_grams": F.greatest(2 * F.col("n_words") - 1, F.lit(0))})
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    score = F.when(F.col("n_grams") > 0, F.col("total") / (F.col("n_grams") * SCALE)).otherwise(0.0)
    return scored.select("doc_id", *counts, failed.alias("base_failed"), score.alias("score"), (~failed & (F.col("total") >= threshold * F.col("n_grams"))).alias("kept"))
