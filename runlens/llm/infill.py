"""Fill-in-the-middle: a text cut into prefix, middle and suffix by one regular expression with counted quantifiers.

A text is n units, matched left to right; ``regexp_count`` gives n. Two cut points a <= b come from a digest
of the id. The row's own pattern ``(unit{a}+)(unit{b-a}+)(rest)`` captures the three parts in one match, and
the replacement puts them in their new order. Counted possessive quantifiers are loops without backtracking
and without recursion, so texts of any length work. Row-local: no shuffle, no Python.

Defined cases: a null text counts as empty; an empty text, or one that holds a marker already, stays plain. A
row without id draws its numbers from the seed alone. Repeated rows give equal outputs. The columns of the
input are kept in the struct ``row``, so their names never clash with the results'.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = "[A-Za-z]+|[^A-Za-z]"
#: Markers before prefix, suffix and middle. No marker starts with the end of another, so they can't arise by joining.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_PERCENT, SPM_PERCENT = 10, 20

_POSSESSIVE = "(?:[A-Za-z]++|[^A-Za-z])"


def draws(doc_id: Column, seed: int, n: int = 4) -> list[Column]:
    """``n`` numbers of 32 bits from the digest of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(n)]


def cut_pattern(first: Column, second: Column) -> Column:
    """Pattern of a text whose first group holds ``first`` units and whose second holds the units up to ``second``."""
    unit = lambda n: F.concat(F.lit(f"({_POSSESSIVE}{{"), n.cast("string"), F.lit("}+)"))
    return F.concat(F.lit(r"(?s)\A"), unit(first), unit(second - first), F.lit(r"(.*)\z"))


def restore(output: Column, form: Column) -> Column:
    """The text that ``fill_in_middle`` made an output from."""
    pattern = {"psm": rf"(?s)\A{PREFIX}(.*){SUFFIX}(.*){MIDDLE}(.*)\z", "spm": rf"(?s)\A{SUFFIX}(.*){PREFIX}(.*){MIDDLE}(.*)\z"}
    order = {"psm": "$1$3$2", "spm": "$2$3$1"}
    found = F.when(form == "psm", F.regexp_replace(output, pattern["psm"], order["psm"]))
    return found.when(form == "spm", F.regexp_replace(output, pattern["spm"], order["spm"])).otherwise(output)


def fill_in_middle(
    df: DataFrame, text: str = "text", doc_id: str = "doc_id", seed: int = 1, plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT, keep: list[str] | None = None
) -> DataFrame:
    """``row``, ``n`` (units), ``form`` (plain, psm or spm), ``output``, ``prefix_chars`` and ``middle_chars`` (null if plain)."""
    kept = df.columns if keep is None else keep
    body = F.coalesce(df[f"`{text}`"], F.lit(""))
    marked = F.contains(body, F.lit(PREFIX)) | F.contains(body, F.lit(SUFFIX)) | F.contains(body, F.lit(MIDDLE))
    h1, h2, h3, h4 = draws(df[f"`{doc_id}`"], seed)
    form = F.when((body == "") | marked | (h3 % 100 >= 100 - plain_percent), "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm")
    counted = df.select(F.struct(*[df[f"`{c}`"] for c in kept]).alias("row"), body.alias("body"), F.regexp_count(body, F.lit(UNIT)).cast("long").alias("n"), h1.alias("h1"), h2.alias("h2"), form.alias("form"))
    a, b = F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)
    order = F.when(F.col("form") == "spm", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    cut = F.regexp_replace("body", cut_pattern(F.least(a, b), F.greatest(a, b)), order)
    made = counted.select("row", "n", "form", F.when(F.col("form") == "plain", F.col("body")).otherwise(cut).alias("output"))
    place = lambda marker: F.locate(marker, F.col("output"))
    ends = F.when(F.col("form") == "psm", place(SUFFIX) - len(PREFIX) - 1).when(F.col("form") == "spm", place(MIDDLE) - place(PREFIX) - len(PREFIX))
    rest = F.when(F.col("form") != "plain", F.length("output") - place(MIDDLE) - len(MIDDLE) + 1)
    return made.select("row", "n", "form", "output", ends.cast("long").alias("prefix_chars"), rest.cast("long").alias("middle_chars"))
