"""Language identification by compression.

A language is a zstandard raw-content dictionary: text of that language. A document belongs to the
language whose dictionary makes it smallest. Learning looks at a bounded sample of labelled documents: of each
language DOCS_PER_LANGUAGE different texts, chosen by hash, and of each of them one slice from a place chosen by
hash, so that all slices fill DICTIONARY_BYTES. Every document is then compressed whole, in blocks, with every
dictionary.

Defined cases: a null text, or one without a letter (a character that is alphabetic; digits, fractions and
raised numbers are not), is ``und`` with score 0 and is rejected. Rows
without a label, or without text, teach nothing. Without any learned language every document is
``und``. Equal sizes go to the first language by name, with score 0. With one learned language the
score is 1. Repeated rows give repeated results; other columns are carried along untouched.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.llm.rows import map_rows

UNKNOWN = "und"
DOCS_PER_LANGUAGE = 400
DICTIONARY_BYTES = 64 << 10
#: A text is compressed in blocks of so many bytes: farther into a longer block a text is described by itself and no more by the dictionary.
BLOCK_BYTES = 4096
#: Shorter matches than the level's own: a dictionary then helps texts of a few words too.
LEVEL, MIN_MATCH = 12, 3
#: Share by which the best dictionary must beat the second one.
MIN_MARGIN = 0.01

_OTHER = re.compile(r"[\W\d_]+")
_BLANKS = re.compile("  +")
#: Smallest hashes of a language that reach its choice, in multiples of what is chosen.
SPARE = 10


def letters(text: str) -> bytes:
    """Lower-case words, single spaces between: what is compressed."""
    plain = _OTHER.sub(" ", text.lower())
    if not plain.isascii():
        # fractions, raised and Roman numbers count as word signs, but not as letters
        for c in {c for c in set(plain) if not c.isalpha()} - {" "}:
            plain = plain.replace(c, " ")
        plain = _BLANKS.sub(" ", plain)
    return plain.strip().encode()


def fit(docs: DataFrame, text: str = "text", label: str = "lang", docs_per_language: int = DOCS_PER_LANGUAGE, dictionary_bytes: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Dictionaries by language from at most ``docs_per_language`` different texts of each.

    The sample is the texts with the smallest hashes. Texts are counted by language first, and only hashes under a
    bound that leaves some SPARE times the sample are ordered, so a language with a third of all rows
    is no burden. What reaches the driver is bounded by the parameters and the number of languages.
    """
    known = docs.where(F.col(text).isNotNull() & F.col(label).isNotNull()).select(F.col(label).alias("label"), F.col(text).alias("text")).withColumn("hash", F.xxhash64("text"))
    sizes = {r.label: r.n for r in known.groupBy("label").agg(F.approx_count_distinct("hash").alias("n")).collect()}
    if not sizes:
        return {}
    # the least 64-bit number and what to add to it for the wanted share of all hashes
    bound = {name: -(2**63) + min(2**64 - 1, int(SPARE * docs_per_language / max(1, n) * 2**64)) for name, n in sizes.items()}
    limit = F.coalesce(*[F.when(F.col("label") == name, F.lit(b)) for name, b in bound.items()])
    first = F.row_number().over(Window.partitionBy("label").orderBy("hash"))
    picked = known.where(F.col("hash") <= limit).select("label", "hash").distinct().withColumn("n", first).where(F.col("n") <= docs_per_language).collect()
    share = max(1, dictionary_bytes // docs_per_language)
    # twice the bytes in characters: what is no letter goes
    start = 1 + F.pmod("hash", F.greatest(F.length("text") - 2 * share + 1, F.lit(1)))
    texts = known.where(F.col("hash").isin([r.hash for r in picked])).groupBy("label", "hash").agg(F.min(F.substr("text", start.cast("int"), F.lit(2 * share))).alias("text"))
    wanted = {(r.label, r.hash) for r in picked}
    found: dict[str, list[bytes]] = {}
    for r in sorted(r for r in texts.collect() if (r.label, r.hash) in wanted):
        found.setdefault(r.label, []).append(letters(r.text)[:share])
    return {k: b" ".join(v)[:dictionary_bytes] for k, v in sorted(found.items())}


def predict(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text", min_margin: float = MIN_MARGIN, keep: list[str] | None = None) -> DataFrame:
    """``row``, ``lang_pred``, ``score`` (share by which the best size is under the second), ``rejected``."""

    def make():
        import zstandard

        names = sorted(dictionaries)
        tools = []
        for name in names:
            content = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            set_up = zstandard.ZstdCompressionParameters.from_level(LEVEL, source_size=BLOCK_BYTES, dict_size=len(dictionaries[name]), min_match=MIN_MATCH, write_content_size=False, write_dict_id=False)
            content.precompute_compress(compression_params=set_up)
            tools.append(zstandard.ZstdCompressor(dict_data=content, compression_params=set_up))

        def one(value: str | None) -> tuple[str, float, bool]:
            plain = letters(value) if value is not None else b""
            if not plain or not names:
                return UNKNOWN, 0.0, True
            blocks = [plain[i : i + BLOCK_BYTES] for i in range(0, len(plain), BLOCK_BYTES)]
            sizes = sorted((sum(len(tool.compress(b)) for b in blocks), name) for tool, name in zip(tools, names, strict=True))
            score = 1 - sizes[0][0] / sizes[1][0] if len(sizes) > 1 else 1.0
            return sizes[0][1], score, score < min_margin

        def work(columns: dict) -> dict:
            got = [one(t) for t in columns["text"]]
            return {n: [g[i] for g in got] for i, n in enumerate(("lang_pred", "score", "rejected"))}

        return work

    return map_rows(docs, {"text": text}, "lang_pred string, score double, rejected boolean", make, keep)


def held_out(doc_id: str = "doc_id") -> Column:
    """Every fourth document by checksum of its id is kept from learning; one without id is too."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(True))
