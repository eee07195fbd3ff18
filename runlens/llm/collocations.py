"""Collocations: phrases whose words come together more often than their parts would by chance.

Texts are cut into pieces at punctuation and dealt to shards of bounded bytes, one language each. A shard is
an FM-index over word ids: the Burrows-Wheeler transform of its words and that of the reversed words, both
sorted as deep as phrases are extended. A phrase is an interval in either; extending it by one word to
the right (in the reversed index) or to the left (in the other) keeps both intervals in step.

Phrases grow level by level, and counts are summed across shards at each. Only phrases frequent over all
shards go on, and an extension is made only if both its parents (without the last word, without the first) are
frequent, so rare n-grams are never listed twice. A phrase is the pair of its parents' numbers, and gets a number
itself once it is known to be frequent: numbers are exact, no hashes. So counts of all parts of a phrase are found
by joins on numbers.

What is shuffled: the distinct words of each shard, each level's distinct extensions, and the transform that a
level needs. Extensions travel as sorted, packed arrays, by bucket: a bucket gets all shards' counts of its
phrases, adds them up and sends the frequent ones' numbers back. The number of buckets follows the number of
occurrences, so a bucket is bounded, and so is a phrase in it: it has at most one entry per shard. Nothing but the
plan and some totals pass the driver.

Defined cases: a null or empty text has no words; a null language is ``und``. Repeated rows count as often as
they come. Ties in score and count are ordered by the phrase. Very long texts are cut between pieces, so that
a shard is longer than its bound only by one piece. Columns other than text and language are not read.
"""

from __future__ import annotations

import itertools
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.session import stage

MAX_WORDS, LEAST, TOP = 5, 100, 2000
#: Bytes of text in a shard.
SHARD_BYTES = 16 << 20
#: Shards that a task may make, occurrences per bucket, lists that the last ranking is dealt to.
TASK_SHARDS, BUCKET, DEALS = 4096, 1 << 20, 64

_ENDS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + _ENDS, b"abcdefghijklmnopqrstuvwxyz " + b"\n" * len(_ENDS))
_END = re.compile(rb"[.,;:!?\n\x0b\x0c\r]")


# ---- a shard's words


def numbered(texts: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Word numbers from 1 in order of appearance, with a 0 between pieces; and the words."""
    number: dict[bytes, int] = defaultdict(itertools.count(1).__next__)
    number[b"\n"], number[b""] = 0, -1
    found = b"\n".join(texts).translate(_PLAIN).replace(b"\n", b" \n ").split(b" ")
    ids = np.fromiter(map(number.__getitem__, found), dtype=np.int32, count=len(found))
    ids = ids[ids >= 0]
    del number[b"\n"], number[b""]
    ends = ids == 0
    return ids[~(ends & np.append(True, ends[:-1]))] if len(ids) else ids, list(number)


def _cuts(text: bytes, size: int) -> Iterator[bytes]:
    """A text in parts of at least ``size`` bytes, cut between pieces."""
    at = 0
    while at < len(text):
        end = _END.search(text, at + size) if at + size < len(text) else None
        stop = end.end() if end else len(text)
        yield text[at:stop]
        at = stop


def _shards(batches: Iterator[pa.RecordBatch], size: int, first: int) -> Iterator[tuple[int, str, list[bytes]]]:
    held: dict[str, list[bytes]] = {}
    bytes_of: dict[str, int] = {}
    made = itertools.count(first)
    for batch in batches:
        for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
            name = lang.as_py()
            for part in _cuts(text.as_buffer().to_pybytes(), size):
                held.setdefault(name, []).append(part)
                bytes_of[name] = bytes_of.get(name, 0) + len(part)
                if sum(bytes_of.values()) >= size:
                    most = max(bytes_of, key=bytes_of.__getitem__)
                    del bytes_of[most]
                    yield next(made), most, held.pop(most)
    for name, texts in held.items():
        yield next(made), name, texts


def pack(columns: list[np.ndarray], steps: bool = True) -> bytes:
    """Integers of equally long columns, or their steps from row to row, in as few bytes as the greatest needs, byte by byte."""
    import zstandard

    out = [len(columns[0]).to_bytes(8, "little")]
    for column in columns:
        x = column.astype(np.int64)
        x = np.diff(x, prepend=0) if steps else x
        folded = ((x << 1) ^ (x >> 63)).view(np.uint64)  # small numbers of both signs
        width = max(1, (int(folded.max(initial=0)).bit_length() + 7) // 8)
        out += [bytes([width]), folded.view(np.uint8).reshape(-1, 8).T[:width].tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpack(blob: bytes, n: int = 1, steps: bool = True) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    rows, at, out = int.from_bytes(raw[:8], "little"), 8, []
    for _ in range(n):
        width = raw[at]
        planes = np.zeros((rows, 8), dtype=np.uint8)
        planes[:, :width] = np.frombuffer(raw, dtype=np.uint8, count=width * rows, offset=at + 1).reshape(width, rows).T
        folded = planes.view(np.uint64).ravel()
        x = (folded >> np.uint64(1)).view(np.int64) ^ -(folded & np.uint64(1)).view(np.int64)
        out.append(np.cumsum(x) if steps else x)
        at += 1 + width * rows
    return out


def cut(df: DataFrame, text: str, lang: str, shard_bytes: int) -> DataFrame:
    """One row per shard: shard, lang, its word numbers, its words and their counts."""
    schema = pa.schema([("shard", pa.int64()), ("lang", pa.string()), ("ids", pa.binary()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() * TASK_SHARDS
        for shard, name, texts in _shards(batches, shard_bytes, first):
            if shard >= first + TASK_SHARDS:
                raise ValueError("one task reads too much text: use smaller input splits or larger shards")
            ids, found = numbered(texts)
            counts = np.bincount(ids, minlength=len(found) + 1)[1:]
            yield pa.RecordBatch.from_pydict({"shard": [shard], "lang": [name], "ids": [pack([ids], steps=False)], "words": [[w.decode() for w in found]], "counts": [counts]}, schema=schema)

    read = df.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text")).where("text <> ''")
    return read.mapInArrow(run, "shard long, lang string, ids binary, words array<string>, counts array<long>")


# ---- a shard's index


def suffix_order(seq: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` symbols at least, by doubling."""
    rank, size = seq.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while size < depth:
        after = np.zeros_like(rank)
        after[:-size] = rank[size:]
        key = rank * (int(rank.max(initial=0)) + 1) + after
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        rank[order] = np.cumsum(np.append(0, ranked[1:] != ranked[:-1]))
        size *= 2
    return order


def transform(seq: np.ndarray, depth: int) -> np.ndarray:
    """Symbol before each suffix, in the order of suffixes."""
    return seq[suffix_order(seq, depth) - 1]


def frequent_sequence(ids: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Numbers from 1 for the words at ``places`` (sorted), 0 for all others and for runs of a single word."""
    number = np.zeros(int(max(ids.max(initial=0), places.max(initial=0))) + 1, dtype=np.int32)
    number[places] = np.arange(1, len(places) + 1)
    seq = np.concatenate(([0], number[ids], [0])).astype(np.int32)
    inner = seq[1:-1]
    inner[(seq[:-2] == 0) & (seq[2:] == 0)] = 0
    none = seq == 0
    return seq[~(none & np.append(False, none[:-1]))]


class Side:
    """One direction of the index: extends intervals by the symbols before them."""

    def __init__(self, bwt: np.ndarray):
        self.bwt = bwt
        self.back = np.empty(len(bwt), dtype=np.int32)
        self.back[np.argsort(bwt, kind="stable")] = np.arange(len(bwt), dtype=np.int32)

    def extend(self, here: np.ndarray, there: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """Each interval's extensions: its number, the new start here and in the other direction, and the count.

        Within an interval of the other direction, suffixes are sorted by their next symbol, so a new start
        there lies as many rows on as smaller symbols come here. The 0 between pieces extends nothing.
        """
        first = np.cumsum(n) - n
        owner = np.repeat(np.arange(len(n)), n)
        rows = np.arange(len(owner)) + (here - first)[owner]
        symbol = self.bwt[rows]
        key = owner * (int(self.bwt.max(initial=0)) + 1) + symbol
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        head = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(ranked) else np.empty(0, dtype=np.int64)
        count = np.diff(np.append(head, len(ranked)))
        at = order[head]
        real = symbol[at] > 0
        head, count, at = head[real], count[real], at[real]
        return owner[at], self.back[rows[at]], there[owner[at]] + head - first[owner[at]], count


def within(starts: np.ndarray, n: np.ndarray, names: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the disjoint intervals that hold the places, and whether one does."""
    order = np.argsort(starts)
    at = np.searchsorted(starts[order], places, side="right") - 1
    held = order[np.maximum(at, 0)]
    return names[held], (at >= 0) & (places < (starts + n)[held])


def grow(bwt: np.ndarray, depth: int, names: np.ndarray, lo: np.ndarray, rlo: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
    """Phrases of ``depth`` words from frequent ones of a word less, whose other parent is frequent too.

    Even depths grow to the right and need the transform of the reversed words, odd ones to the left.
    """
    if depth % 2 == 0:  # the phrase is its first parent's extension
        owner, new_rlo, new_lo, count = Side(bwt).extend(rlo, lo, n)
        other, known = within(rlo, n, names, new_rlo)
        left, right = names[owner], other
    else:
        owner, new_lo, new_rlo, count = Side(bwt).extend(lo, rlo, n)
        other, known = within(lo, n, names, new_lo)
        left, right = other, names[owner]
    return {k: v[known] for k, v in (("l", left), ("r", right), ("lo", new_lo), ("rlo", new_rlo), ("n", count))}


# ---- across shards

_SENT = "bucket int, shard long, sent binary"
_LEVEL = "shard long, found binary, named binary"
_INDEX = "shard long, length long, bwt binary, rbwt binary, names binary"


def frequent_words(words: DataFrame, least: int, buckets: int) -> DataFrame:
    """Rows ``(shard, lang, lo, word, n)`` of words with ``least`` occurrences over all shards, with number ``id`` and count ``a``.

    Words are dealt to buckets by a hash and numbered within; a bucket's numbers are its own.
    """
    dealt = words.withColumn("bucket", F.pmod(F.xxhash64("lang", "word"), F.lit(buckets))).repartition("bucket")
    known = dealt.withColumn("a", F.sum("n").over(Window.partitionBy("bucket", "lang", "word"))).where(F.col("a") >= least)
    place = F.dense_rank().over(Window.partitionBy("bucket").orderBy("lang", "word"))
    return known.withColumn("id", (place - 1) * buckets + F.col("bucket")).drop("bucket")


def build(shards: DataFrame, words: DataFrame, max_words: int) -> DataFrame:
    """Each shard's two transforms over its frequent words, and those words' numbers."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        kinds = {"shard": pa.int64(), "length": pa.int64(), "bwt": pa.binary(), "rbwt": pa.binary(), "names": pa.binary()}
        if not left.num_rows or not right.num_rows:
            return pa.table({k: pa.array([], t) for k, t in kinds.items()})
        place, name = right["lo"].to_numpy(), right["id"].to_numpy()
        order = np.argsort(place)
        seq = frequent_sequence(unpack(left["ids"][0].as_py(), steps=False)[0], place[order])
        sides = [pack([transform(s, max_words - 1)], steps=False) for s in (seq, seq[::-1].copy())]
        row = {"shard": left["shard"][0].as_py(), "length": len(seq), "bwt": sides[0], "rbwt": sides[1], "names": pack([name[order]], steps=False)}
        return pa.table({k: pa.array([row[k]], t) for k, t in kinds.items()})

    return shards.select("shard", "ids").groupBy("shard").cogroup(words.select("shard", "id", "lo").groupBy("shard")).applyInArrow(run, _INDEX)


def _runs(keys: np.ndarray) -> list[tuple[int, int]]:
    """Borders of the runs of equal keys."""
    cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
    return list(zip(cuts, cuts[1:], strict=False)) if len(keys) else []


def _sent(shard: int, found: dict[str, np.ndarray], buckets: int) -> pa.RecordBatch:
    """A shard's extensions by bucket, in the order of their intervals."""
    mixed = found["l"].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + found["r"].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    bucket = ((mixed ^ (mixed >> np.uint64(29))) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((found["lo"], bucket))
    bucket = bucket[order]
    runs = _runs(bucket)
    columns = [found[k][order] for k in ("l", "r", "lo", "rlo", "n")]
    blobs = [pack([c[a:b] for c in columns]) for a, b in runs]
    return pa.RecordBatch.from_pydict({"bucket": pa.array([int(bucket[a]) for a, _ in runs], pa.int32()), "shard": pa.array([shard] * len(blobs), pa.int64()), "sent": pa.array(blobs, pa.binary())})


def pairs(indexes: DataFrame, buckets: int) -> DataFrame:
    """Phrases of two words of each shard, by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                rbwt, names = (unpack(batch.column(k)[row].as_py(), steps=False)[0] for k in ("rbwt", "names"))
                n = np.bincount(rbwt, minlength=len(names) + 1)
                start = (np.cumsum(n) - n)[1:]
                yield _sent(batch.column("shard")[row].as_py(), grow(rbwt, 2, names, start, start, n[1:]), buckets)

    return indexes.select("shard", "rbwt", "names").mapInArrow(run, _SENT)


def longer(indexes: DataFrame, level: DataFrame, depth: int, buckets: int) -> DataFrame:
    """Phrases of ``depth`` words of each shard, by bucket, from the frequent ones of a word less."""
    side = "rbwt" if depth % 2 == 0 else "bwt"

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"bucket": pa.array([], pa.int32()), "shard": pa.array([], pa.int64()), "sent": pa.array([], pa.binary())})
        parts = [unpack(b, 4) for b in right["found"].to_pylist()]
        names, lo, rlo, n = (np.concatenate(c) for c in zip(*parts, strict=True))
        found = grow(unpack(left[side][0].as_py(), steps=False)[0], depth, names, lo, rlo, n)
        return pa.Table.from_batches([_sent(left["shard"][0].as_py(), found, buckets)])

    known = level.where("found IS NOT NULL").select("shard", "found")
    return indexes.select("shard", side).groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(run, _SENT)


def summed(sent: DataFrame, least: int, buckets: int) -> DataFrame:
    """Frequent phrases of each bucket: per shard their numbers and intervals, and per bucket numbers, parents and counts."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        parts = [unpack(b, 5) for b in table["sent"].to_pylist()]
        shard = np.repeat(table["shard"].to_numpy(), [len(p[0]) for p in parts])
        l, r, lo, rlo, n = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((r, l))
        l, r, lo, rlo, n, shard = (x[order] for x in (l, r, lo, rlo, n, shard))
        starts = np.flatnonzero(np.append(True, (l[1:] != l[:-1]) | (r[1:] != r[:-1])))
        total = np.add.reduceat(n, starts)
        good = total >= least
        number = np.full(len(starts), -1)
        number[good] = key[0].as_py() + buckets * np.arange(good.sum())
        name = np.repeat(number, np.diff(np.append(starts, len(l))))
        kept = np.flatnonzero(name >= 0)
        kept = kept[np.lexsort((lo[kept], shard[kept]))]
        rows = [(int(shard[kept[a]]), pack([x[kept[a:b]] for x in (name, lo, rlo, n)]), None) for a, b in _runs(shard[kept])]
        heads = starts[good]
        rows.append((None, None, pack([number[good], l[heads], r[heads], total[good]])))
        return pa.table({"shard": pa.array([x[0] for x in rows], pa.int64()), "found": pa.array([x[1] for x in rows], pa.binary()), "named": pa.array([x[2] for x in rows], pa.binary())})

    return sent.groupBy("bucket").applyInArrow(run, _LEVEL)


def named(level: DataFrame) -> DataFrame:
    """``(id, l, r, a)``: number, parents and count of each frequent phrase."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("named").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in unpack(blob, 4)], names=["id", "l", "r", "a"])

    return level.where("named IS NOT NULL").select("named").mapInArrow(run, "id long, l long, r long, a long")


def _score(depth: int, n: Column) -> Column:
    """The lowest-scoring cut: score, words before it, counts of both sides."""
    wide = lambda c: c.cast("decimal(19,0)")
    options = []
    for k in range(1, depth):
        left, right = F.get("firsts", F.lit(k - 1)), F.get("lasts", F.lit(depth - k - 1))
        top, under = F.lit(1000).cast("decimal(4,0)") * (wide(F.col("a")) * wide(n)), wide(left) * wide(right)
        options.append(F.struct(F.call_function("div", top, under).alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")))
    return F.array_min(F.array(*options))


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", max_words: int = MAX_WORDS, least: int = LEAST, top: int = TOP, absorb_percent: int = 100, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a (its count), l, r (its parts' counts), n (all words), score.

    A phrase goes if one that holds it has ``absorb_percent`` of its count or more. It is enough to look
    one word further: what lies between two phrases has a count between theirs.
    """
    shards = stage(cut(df, text, lang, shard_bytes))
    words = shards.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "x")).select("shard", "lang", (F.col("at") + 1).alias("lo"), F.col("x.words").alias("word"), F.col("x.counts").alias("n"))
    every = stage(words.groupBy("lang").agg(F.sum("n").alias("every")))
    buckets = lambda total: max(1, -(-(total or 0) // BUCKET))
    level = stage(frequent_words(words, least, buckets(every.agg(F.sum("every")).first()[0])))
    indexes = stage(build(shards, level, max_words))
    word = level.groupBy("id").agg(F.min("lang").alias("lang"), F.min("word").alias("phrase"), F.min("a").alias("a"))
    known = stage(word.select("id", "lang", "phrase", F.col("phrase").alias("last"), F.array("a").alias("firsts"), F.array("a").alias("lasts"), "a"))
    occurrences = indexes.agg(F.sum("length")).first()[0]
    counted, absorbed = [], []
    for depth in range(2, max_words + 1):
        n = buckets(occurrences)
        level = stage(summed(pairs(indexes, n) if depth == 2 else longer(indexes, level, depth, n), least, n))
        found = stage(named(level))
        occurrences = found.agg(F.sum("a")).first()[0]
        x, y = known.alias("x"), known.alias("y")
        joined = found.alias("p").join(x, F.col("p.l") == F.col("x.id")).join(y, F.col("p.r") == F.col("y.id"))
        known = stage(
            joined.select(
                "p.id", "p.l", "p.r", "x.lang", F.concat_ws(" ", "x.phrase", "y.last").alias("phrase"), "y.last",
                F.concat("x.firsts", F.array("p.a")).alias("firsts"), F.concat("y.lasts", F.array("p.a")).alias("lasts"), "p.a",
            )
        )
        counted.append((depth, known))
        absorbed.append(found.select(F.explode(F.array("l", "r")).alias("inner"), "a").groupBy("inner").agg(F.max("a").alias("outer")))
    scored = None
    for k, (depth, rows) in enumerate(counted):
        if k + 1 < len(counted):
            rows = rows.join(absorbed[k + 1], F.col("id") == F.col("inner"), "left").where(F.coalesce(100 * F.col("outer") < absorb_percent * F.col("a"), F.lit(True)))
        rows = rows.join(every.withColumnRenamed("lang", "of"), F.col("lang") == F.col("of")).withColumn("cut", _score(depth, F.col("every")))
        rows = rows.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("every").alias("n"), F.col("cut.score").alias("score"))
        scored = rows if scored is None else scored.unionByName(rows)
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    dealt = scored.withColumn("deal", F.pmod(F.xxhash64("phrase"), F.lit(DEALS)))
    first = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "deal").orderBy(*best))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
