"""Url filter by rules, and by path templates learned from urls whose verdict is known.

Per host a path is a list of segments. Level by level, a segment becomes a wildcard if it looks like an
id (digits, or a long token with a digit in it), or if its parent has at least MANY children and it
holds less than one MANY-th of the parent's urls: what is rare among many is a variable. Every segment is
decided, however deep: a round per level for templates that several paths share; a path alone under its
template has no siblings to be rare among, so the rest of it is decided within its row.

Templates of one host with the same shape (literals blanked) whose shares of bad urls can't be told
apart (a two-sided test at Z_SQUARED against their pooled share) are merged. A template with too few known
urls for that joins them if neither they nor the urls themselves speak against it: lengths and digits of
what its wildcards stand for have the group's means, by the same test.

Evidence flows down the tree. Start with the overall share; at the host and at every prefix of the
template, the known urls below it that are not below the next one are smoothed by WEIGHT urls of the share
so far; the template's own come last. So each known url counts once, where its path parts from the
template's, and a branch without any has the share of its surroundings. A merged group is smoothed by the
rest of its host. What reaches REJECT_PERCENT is rejected. A host without known urls has the overall share.

DataFrame functions only. Urls are folded to distinct (host, path) with counts before anything else,
and every further step aggregates with map-side sums; a host with a third of all urls is a skewed join
key that adaptive execution splits, and no window holds a host.

Defined cases: a null url, or one without ``://``, has an empty host and path; these share one template.
Rows of equal urls get equal verdicts, each its own row, rows without id too. An empty table gives no
rows. Without any known url nothing is rejected. Very long and very deep paths are told apart whole; they take a
round per level only as long as another path shares their template. Columns other than page_id and url are not
read, so their names can't clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.session import stage

MANY = 8
Z_SQUARED = 3.84
LEAST_KNOWN = 5
WEIGHT = 8
REJECT_PERCENT = 90

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
_ID = r"\A(?:[0-9]+(?:\.[A-Za-z]+)?|(?=.*[0-9])[0-9a-fA-F-]{8,}|(?=.*[0-9]).{24,})\z"


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def by_rules(of_host: Column, of_path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Rule text and action of the longest rule (host, path, action) that fits, else null."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, a in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((of_host == h) | of_host.endswith("." + h)) & of_path.startswith(p)
        rule, action = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(a)).otherwise(action)
    return rule, action


def _level(state: DataFrame, level: int) -> DataFrame:
    """Decide the segment at ``level`` under every template prefix; adds it to ``template`` and ``shape``."""
    here = F.get("segments", F.lit(level - 1))
    own = state.withColumn("seg", here)
    children = own.where("seg IS NOT NULL").groupBy("host", "template", "seg").agg(F.sum("n").alias("n"))
    parents = children.groupBy("host", "template").agg(F.count("*").alias("children"), F.sum("n").alias("total"))
    rare = (F.col("children") >= MANY) & (F.col("n") * MANY < F.col("total"))
    wild = children.join(parents, ["host", "template"]).where(F.col("seg").rlike(_ID) | rare).select("host", "template", "seg", F.lit(True).alias("wild"))
    told = own.join(wild, ["host", "template", "seg"], "left")
    part = F.when(F.col("seg").isNull(), "").when(F.col("wild"), "/*").otherwise(F.concat(F.lit("/"), F.col("seg")))
    blank = F.when(F.col("seg").isNull(), "").when(F.col("wild"), "/*").otherwise("/+")
    parts = F.when(F.col("seg").isNull(), F.col("parts")).otherwise(F.array_append("parts", part))
    return told.withColumns({"template": F.concat("template", part), "shape": F.concat("shape", blank), "parts": parts}).drop("seg", "wild")


def _alone(state: DataFrame, level: int) -> DataFrame:
    """Decide all segments from ``level`` on of paths that share their template with no other."""
    rest = F.slice("segments", level, F.greatest(F.size("segments") - level + 1, F.lit(0)))
    parts = F.transform(rest, lambda x: F.when(x.rlike(_ID), "/*").otherwise(F.concat(F.lit("/"), x)))
    blanks = F.transform(rest, lambda x: F.when(x.rlike(_ID), "/*").otherwise("/+"))
    return state.withColumns({"template": F.concat("template", F.array_join(parts, "")), "shape": F.concat("shape", F.array_join(blanks, "")), "parts": F.concat("parts", parts)})


def templates(urls: DataFrame) -> DataFrame:
    """``urls`` (host, path, n, bad, good; distinct) with ``template``, its ``parts``, and ``shape``. Each level is staged: the next reads it twice."""
    parts = F.filter(F.split("path", "/"), lambda x: x != "")
    state = stage(urls.withColumns({"segments": parts, "template": F.lit(""), "shape": F.lit(""), "parts": F.array().cast("array<string>")}))
    done, level = [], 1
    while True:
        # templates with a segment left and more than one path go on
        left = F.size("segments") >= level
        shared = state.where(left).groupBy("host", "template").agg(F.count("*").alias("paths")).where("paths > 1").select("host", "template", F.lit(True).alias("shared"))
        told = stage(state.join(shared, ["host", "template"], "left").withColumn("open", left & F.coalesce("shared", F.lit(False))).drop("shared"))
        done.append(_alone(told.where("NOT open"), level).drop("open", "segments"))
        state = told.where("open").drop("open")
        if state.isEmpty():
            return reduce(DataFrame.unionByName, done)
        state = stage(_level(state, level))
        level += 1


def _same_mean(stat: str) -> Column:
    """Whether a template's mean of a statistic of its paths can't be told from that of its group's (``g_``)."""
    n, s, q, gn, gs, gq = (F.col(c).cast("double") for c in ("paths", stat, f"{stat}_2", "g_paths", f"g_{stat}", f"g_{stat}_2"))
    off, within = s / n - gs / gn, (q - s * s / n + gq - gs * gs / gn) / (n + gn)
    return off * off <= Z_SQUARED * within * (1 / n + 1 / gn) + 1e-9


def _groups(each: DataFrame) -> DataFrame:
    """``each`` (one row per host and template) with ``group``."""
    sums = ["paths", "wild_length", "wild_length_2", "wild_digits", "wild_digits_2"]
    many = F.col("known") >= LEAST_KNOWN
    pools = each.where(many).groupBy("host", "shape").agg(F.sum("bad").alias("pool_bad"), F.sum("known").alias("pool"))
    share = F.col("pool_bad") / F.col("pool")
    off = F.col("bad") - F.col("known") * share
    told = each.join(pools, ["host", "shape"], "left").withColumn("alike", F.coalesce(off * off <= Z_SQUARED * F.col("known") * share * (1 - share), F.lit(False)))
    cores = told.where(many & F.col("alike")).groupBy("host", "shape").agg(*[F.sum(c).alias(f"g_{c}") for c in sums])
    joins = F.col("alike") & F.col("g_paths").isNotNull() & (many | (_same_mean("wild_length") & _same_mean("wild_digits")))
    named = told.join(cores, ["host", "shape"], "left").withColumn("group", F.when(joins, F.concat(F.lit("="), F.col("shape"))).otherwise(F.col("template")))
    return named.select("host", "template", "group", "parts", "bad", "known")


def purity(found: DataFrame) -> DataFrame:
    """``host``, ``template``, ``group`` (template, or shape where merged), ``purity``, ``rejected``."""
    digits = lambda c: F.length(c) - F.length(F.translate(c, "0123456789", ""))
    sized = found.withColumns({"wild_length": (F.length("path") - F.length("template")).cast("long"), "wild_digits": (digits("path") - digits("template")).cast("long")})
    sums = [F.sum(x).alias(c) for c in ("wild_length", "wild_digits") for c, x in ((c, F.col(c)), (f"{c}_2", F.col(c) * F.col(c)))]
    each = sized.groupBy("host", "shape", "template").agg(F.first("parts").alias("parts"), F.sum("bad").alias("bad"), F.sum(F.col("bad") + F.col("good")).alias("known"), F.count("*").alias("paths"), *sums)
    named = stage(_groups(each))

    # known urls at and below every prefix of a template, the host's first, the template's own last
    prefixes = F.transform(F.sequence(F.lit(0), F.size("parts")), lambda i: F.array_join(F.slice("parts", F.lit(1), i), ""))
    places = named.select("host", "template", "group", "bad", "known", F.posexplode(prefixes).alias("depth", "prefix"))
    nodes = places.groupBy("host", "prefix").agg(F.sum("bad").alias("b"), F.sum("known").alias("k"))
    step = F.struct("depth", F.col("b").alias("bad"), F.col("k").alias("known"))
    chains = places.join(nodes, ["host", "prefix"]).groupBy("host", "template").agg(F.first("group").alias("group"), F.first("bad").alias("bad"), F.first("known").alias("known"), F.array_sort(F.collect_list(step)).alias("chain"))
    groups = named.groupBy("host", "group").agg(F.count("*").alias("members"), F.sum("bad").alias("group_bad"), F.sum("known").alias("group_known"))

    pair = lambda bad, known: F.struct(bad.alias("bad"), known.alias("known"))
    alone = F.array_append(F.transform("chain", lambda x: pair(x["bad"], x["known"])), pair(F.col("bad"), F.col("known")))
    host = F.get("chain", F.lit(0))
    merged = F.array(pair(host["bad"], host["known"]), pair(F.col("group_bad"), F.col("group_known")))
    held = chains.join(groups, ["host", "group"]).withColumn("held", F.when(F.col("members") > 1, merged).otherwise(alone))
    # what is below one and not below the next
    below = lambda x, i, c: x[c] - F.coalesce(F.get("held", i + 1)[c], F.lit(0))
    parted = held.withColumn("parted", F.transform("held", lambda x, i: pair(below(x, i, "bad"), below(x, i, "known"))))
    overall = named.agg(F.coalesce(F.sum("bad") / F.sum("known"), F.lit(0.0)).alias("p"))
    smooth = F.aggregate("parted", F.col("p"), lambda s, x: (x["bad"] + WEIGHT * s) / (x["known"] + WEIGHT))
    judged = parted.withColumn("p", overall.scalar()).withColumn("purity", smooth)
    return judged.select("host", "template", "group", "purity", (F.col("purity") * 100 >= REJECT_PERCENT).alias("rejected"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``template``, ``purity`` per row.

    Urls that a rule decides are the known ones: blocked ones are bad, allowed ones good.
    """
    split = pages.select(F.col(page_id).alias("page_id"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    rule, action = by_rules(F.col("host"), F.col("path"), rules)
    ruled = split.withColumns({"rule": rule, "action": action})
    one = lambda a: F.count(F.when(F.col("action") == a, 1))
    urls = ruled.groupBy("host", "path").agg(F.count("*").alias("n"), one("block").alias("bad"), one("allow").alias("good"))
    found = templates(urls)
    verdicts = found.select("host", "path", "template").join(purity(found), ["host", "template"]).select("host", "path", "template", "purity", "rejected")
    joined = ruled.join(verdicts, ["host", "path"])
    return joined.select("page_id", "host", "path", "rule", F.coalesce("action", F.when(F.col("rejected"), "block").otherwise("allow")).alias("verdict"), "template", "purity")
