"""Near-duplicates by MinHash with tensored tables, every link confirmed on full shingle sets.

A document's set holds the hashes of its distinct five-word shingles; sets are similar from ``percent`` of
their union on. Two small collections of h bands, each of BAND minhashes, are computed; a table key joins
band i of the first with band j of the second. So h squared tables come from 2 * h * BAND minhashes rather
than from 2 * h ** 2 * BAND, and two documents of similarity s meet unless all bands of one collection
differ. The least h is taken with which that happens to at most MISS of the pairs that are just similar: 10
at 85 percent, 14 at 80.

What moves through the cluster:

- equal sets fold to the smallest id first (an aggregate of digests), so copies cost one row each;
- bands that no other set shares are dropped before pairs of bands are formed;
- a set is compared with one leader at first, the smallest id in any of its tables, then with one by
  another order. Texts travel to (leader, part), and a leader with many members is given to many parts;
- components of the confirmed links are formed. Sets in tables that still hold several components are
  looked at again: a prefix join on their rarest shingles gives every pair across components that can
  be similar. So no pair that shares a table and could join two components stays unseen, and texts that
  share no more than a frequent passage are not paired.

Defined cases: a null text, or one without words, has an empty set and is linked with nothing. Rows
that share an id are one document: the links of any of them count. Rows without id are linked with
nothing, have no component, and are kept. Repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.llm.components import components
from runlens.llm.rows import map_rows
from runlens.session import stage

WORDS = 5
SIMILARITY = 85
BAND, MISS = 3, 0.00015
#: Members, and bytes of their texts, that one task compares with a leader.
PART_MEMBERS, PART_BYTES = 256, 4 << 20
#: Bytes of text that are shingled at once.
CHUNK_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _rng(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = _rng(256, 1)
_PLACE = _rng(WORDS + 1, 2)
_STEP = np.uint64(0x9E3779B97F4A7C15)


@cache
def halves(percent: int) -> int:
    """Bands of each collection."""
    if not 0 < percent <= 100:
        raise ValueError(f"percent is from 1 to 100, not {percent}")
    n = 1
    while 2 * (1 - (percent / 100) ** BAND) ** n > MISS:
        n += 1
    return n


@cache
def _minhash(n: int) -> np.ndarray:
    return _rng(n, 3)


def word_hashes(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of a byte buffer."""
    low = _LOWER[buffer]
    space = _SPACE[low]
    inside = ~space
    starts = np.flatnonzero(inside & np.concatenate(([True], space[:-1]))) if len(low) else np.zeros(0, dtype=np.int64)
    if not len(starts):
        return starts, np.zeros(0, dtype=np.uint64)
    lengths = np.diff(np.append(starts, len(low)))
    place = np.arange(starts[0], len(low)) - np.repeat(starts, lengths)
    power = np.cumprod(np.full(int(lengths.max()), _STEP, dtype=np.uint64))
    values = _mix(_BYTE[low[starts[0] :]] + power[place])
    values[space[starts[0] :]] = 0
    return starts, _mix(np.add.reduceat(values, starts - starts[0]))


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    raw = [(t or "").encode() for t in texts]
    out: list[np.ndarray] = []
    at = 0
    while at < len(raw):
        stop, held = at + 1, len(raw[at])
        while stop < len(raw) and held + len(raw[stop]) <= CHUNK_BYTES:
            held += len(raw[stop])
            stop += 1
        part = raw[at:stop]
        starts, words = word_hashes(np.frombuffer(b"\n".join(part), dtype=np.uint8))
        borders = np.searchsorted(starts, np.cumsum([0, *[len(p) + 1 for p in part]]))
        every = np.zeros(0, dtype=np.uint64)
        if len(words) >= WORDS:
            n = len(words) - WORDS + 1
            every = _mix(sum((words[k : n + k] * _PLACE[k] for k in range(1, WORDS)), words[:n] * _PLACE[0]))
        for a, b in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
            if b - a >= WORDS:
                out.append(np.unique(every[a : b - WORDS + 1]))
            elif b > a:
                own = (words[a:b] * _PLACE[: b - a]).sum(keepdims=True) + _PLACE[WORDS:] * np.uint64(b - a)
                out.append(_mix(own))
            else:
                out.append(every[:0])
        at = stop
    return out


def minhashes(shingles: np.ndarray, n: int) -> np.ndarray:
    factors = _minhash(n)
    least = np.full(n, np.iinfo(np.uint64).max, dtype=np.uint64)
    for a in range(0, len(shingles), 2048):
        part = shingles[a : a + 2048, None] * factors
        np.minimum(least, (part ^ (part >> np.uint64(32))).min(axis=0), out=least)
    return least


def bands(shingles: np.ndarray, percent: int = SIMILARITY) -> list[int] | None:
    """The bands of both collections, as signed 64-bit numbers; none for an empty set."""
    if not len(shingles):
        return None
    n = 2 * halves(percent)
    rows = minhashes(shingles, n * BAND).reshape(n, BAND)
    own = _mix((_mix(rows) * _PLACE[:BAND]).sum(axis=1, dtype=np.uint64) + np.arange(n, dtype=np.uint64))
    return own.view(np.int64).tolist()


def similar(a: np.ndarray, b: np.ndarray, percent: int = SIMILARITY) -> bool:
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def sets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = SIMILARITY) -> DataFrame:
    """``id``, ``n_bytes``, ``n_shingles``, ``digest``, ``bands`` of every row."""

    def make():
        def work(columns: dict) -> dict:
            found = shingle_sets(columns["text"])
            return {
                "n_bytes": [len((t or "").encode()) for t in columns["text"]],
                "n_shingles": [len(s) for s in found],
                "digest": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in found],
                "bands": [bands(s, percent) for s in found],
            }

        return work

    made = map_rows(docs, {"text": text}, "n_bytes long, n_shingles long, digest binary, bands array<long>", make, [doc_id])
    return made.select(F.col("row")[doc_id].cast("long").alias("id"), "n_bytes", "n_shingles", "digest", "bands")


def tables(heads: DataFrame, percent: int = SIMILARITY) -> DataFrame:
    """``key``, ``id``, ``n_shingles``, ``n_bytes``: table entries of the sets that share both a first and a second band with others."""
    listed = heads.select("id", "n_shingles", "n_bytes", F.posexplode("bands").alias("i", "band"))
    shared = listed.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    first = F.col("i") < halves(percent)
    left = listed.join(shared, "band").groupBy("id", "n_shingles", "n_bytes").agg(F.collect_list(F.when(first, F.col("band"))).alias("a"), F.collect_list(F.when(~first, F.col("band"))).alias("b"))
    pairs = left.select("id", "n_shingles", "n_bytes", F.explode("a").alias("a"), "b").select("id", "n_shingles", "n_bytes", "a", F.explode("b").alias("b"))
    return pairs.select(F.xxhash64("a", "b").alias("key"), "id", "n_shingles", "n_bytes")


def _fits(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def confirm(pairs: DataFrame, texts: DataFrame, percent: int = SIMILARITY) -> DataFrame:
    """The pairs (``u``, ``v``, and ``n_bytes`` of u) whose full sets are similar, as ``u``, ``v``.

    u's are dealt to parts of their v by bytes and number, and v's text goes to each of its parts.
    ``texts`` has ``id`` and ``text``.
    """
    parts = F.greatest(F.ceil(F.count("*") / PART_MEMBERS), F.ceil(F.sum("n_bytes") / PART_BYTES)).cast("int")
    leaders = pairs.groupBy("v").agg(parts.alias("parts"))
    members = pairs.join(leaders, "v").select(F.col("v").alias("leader"), F.pmod(F.xxhash64("u"), "parts").cast("int").alias("part"), F.col("u").alias("id"))
    lead = leaders.select(F.col("v").alias("leader"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("v").alias("id"))
    asked = members.union(lead).join(texts, "id")

    def work(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        own = group["id"] == key[0]
        heads = shingle_sets(group.loc[own, "text"].tolist())
        rest = group[~own]
        linked = [i for i, s in zip(rest["id"].tolist(), shingle_sets(rest["text"].tolist()), strict=True) if any(similar(s, h, percent) for h in heads)]
        return pd.DataFrame({"u": pd.Series(linked, dtype="int64"), "v": pd.Series([key[0]] * len(linked), dtype="int64")})

    return asked.groupBy("leader", "part").applyInPandas(work, "u long, v long").distinct()


def _open(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """Entries, with their component, of the tables that hold several components."""
    tagged = entries.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    parted = tagged.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b").select("key")
    return tagged.join(parted, "key", "left_semi")


def _one_leader(entries: DataFrame, order: Column, percent: int) -> DataFrame:
    """For each id, the first in ``order`` of the leaders of its tables that may be similar and is no part of its component yet."""
    lead = entries.groupBy("key").agg(F.min_by(F.struct("id", "n_shingles", "component"), order).alias("lead"))
    near = entries.join(lead, "key").where((F.col("component") != F.col("lead.component")) & _fits(F.col("n_shingles"), F.col("lead.n_shingles"), percent))
    return near.groupBy("id").agg(F.min("lead.id").alias("v"), F.first("n_bytes").alias("n_bytes")).select(F.col("id").alias("u"), "v", "n_bytes")


def _by_prefix(members: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Every pair across components that can be similar: sets share one of the rarest shingles of each.

    Of n shingles in any fixed order, two sets of similarity s share one of the first n - ceil(s n) + 1. In
    order of rarity those are what sets a text apart, and not a passage that many texts have. Where the
    first shared one stands bounds what both can share at all: from there on, s / (1 + s) of both sets.
    """
    found = map_rows(members.join(texts, "id"), {"text": F.col("text")}, "shingles array<long>", lambda: lambda c: {"shingles": [s.view(np.int64).tolist() for s in shingle_sets(c["text"])]}, ["id", "component", "n_bytes"])
    each = stage(found.select("row.*", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle")))
    rarity = each.groupBy("shingle").agg(F.count("*").alias("rarity")).where("rarity > 1")
    ranked = each.join(rarity, "shingle", "left").groupBy("id", "component", "n_bytes", "n").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("rarity", F.lit(1)).alias("rarity"), "shingle"))).alias("all"))
    first = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    prefix = ranked.select("id", "component", "n_bytes", "n", F.posexplode(F.slice("all", F.lit(1), first.cast("int"))).alias("at", "x")).where("x.rarity > 1")
    x = prefix.select("x.shingle", F.col("id").alias("u"), F.col("component").alias("cu"), F.col("n").alias("nu"), F.col("at").alias("au"), "n_bytes")
    y = prefix.select("x.shingle", F.col("id").alias("v"), F.col("component").alias("cv"), F.col("n").alias("nv"), F.col("at").alias("av"))
    enough = F.least(F.col("nu") - F.col("au"), F.col("nv") - F.col("av")) * (100 + percent) >= (F.col("nu") + F.col("nv")) * percent
    return x.join(y, "shingle").where((F.col("cu") > F.col("cv")) & enough).select("u", "v", "n_bytes").distinct()


def links(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = SIMILARITY) -> DataFrame:
    """Links between ids that span every component: ``u``, ``v``. ``found``: staged ``sets`` of ``docs`` for the same percent."""
    whole = found.where(F.col("id").isNotNull() & F.col("digest").isNotNull())
    heads = whole.groupBy("digest").agg(F.min("id").alias("id"), F.max("n_shingles").alias("n_shingles"), F.max("n_bytes").alias("n_bytes"), F.min("bands").alias("bands"))
    made = stage(tables(heads, percent))
    entries = stage(made.join(made.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a <> b").select("key"), "key", "left_semi"))
    members = stage(entries.select("id").distinct())
    texts = stage(docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).join(members, "id", "left_semi"))

    # ids with several sets
    several = whole.groupBy("id").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).where("a <> b").select("id")
    known = stage(whole.join(several, "id", "left_semi").select(F.col("id").alias("u"), "digest").join(heads.select("digest", F.col("id").alias("v")), "digest").select("u", "v"))

    labels = None
    for order in (F.col("id"), F.xxhash64("id")):
        left = entries.withColumn("component", F.col("id")) if labels is None else _open(entries, labels)
        known = stage(known.union(confirm(stage(_one_leader(left, order, percent)), texts, percent)))
        labels = stage(components(known))
    left = stage(_open(entries, labels).select("id", "component", "n_bytes").distinct())
    if left.isEmpty():
        return known
    return stage(known.union(confirm(stage(_by_prefix(left, texts, percent)), texts, percent)))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = SIMILARITY) -> DataFrame:
    """``id``, ``n_shingles``, ``component_id``, ``kept`` per row of ``docs``."""
    found = stage(sets(docs, doc_id, text, percent))
    whole = found.where(F.col("id").isNotNull() & F.col("digest").isNotNull())
    labels = components(links(docs, found, doc_id, text, percent))
    heads = whole.groupBy("digest").agg(F.min("id").alias("head")).join(labels.withColumnRenamed("node", "head"), "head", "left").select("digest", F.coalesce("component", "head").alias("component_id"))
    return found.join(heads, "digest", "left").select(
        "id",
        "n_shingles",
        F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
        (F.col("id").isNull() | (F.col("id") == F.coalesce("component_id", "id"))).alias("kept"),
    )
