"""SentencePiece encoding and decoding as a relational lattice.

A text is normalised as the model does it: blanks become the blank mark, one is put in front. No piece
has the mark after another character (a table that has one is refused), so a word is a run of marks and
what follows up to the next mark, and words are independent. Words are cut once more at ``seams``, places
that no piece of the table spans, such as those between letters and full stops. The distinct segments of
a part of the documents are exploded to their substrings of at most the longest piece's length,
equi-joined to the piece table (a vocabulary of at most MAX_PIECES rows, so it is broadcast), and the
edges come together by segment again. A fold over a segment's edges then gives its segmentation:

- ``viterbi``: the best sum of scores, for unigram models, by Spark's higher-order ``aggregate``;
- ``merge``: the best adjacent merge, again and again, the leftmost of equals, for BPE models. A Viterbi
  path over BPE scores is another segmentation than SentencePiece's own, so BPE models need this one. It
  runs where the part's documents take up the ids, on edges as they come from the join, in numpy for some
  thousand segments at once; a long segment has a queue of its own.

Characters without a piece become byte pieces. Documents are dealt to parts by a hash and shuffled once;
distinct segments, edges and documents are all grouped under that partitioning. A part is sized by bytes
of text, so a task's memory doesn't grow with the input.

Defined cases: a null text counts as empty and has no pieces. Repeated rows give repeated results. A
word without any piece is all byte pieces. Long words fold in n log n steps by merges, and by Viterbi in
the square of their length. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

MARK = "▁"
MAX_PIECES = 1 << 18
PART_BYTES = 8 << 20
_WORD = f"(?=[ {MARK}])(?<![ {MARK}])"
#: What every seam has on one side; few words have it, and looking for it is cheaper than looking for seams.
_SIGN = r"[\x00-\x40\x5b-\x60\x7b-\x7f]"
_LETTER = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]"
#: Segments merged at once; one longer than LONG characters is merged alone.
MERGED_AT_ONCE, LONG = 4096, 64
#: Shares of a part's segments whose edges are taken up one after the other.
SHARES = 8


def piece_table(spark: SparkSession, model_file: str) -> DataFrame:
    """``piece``, ``piece_id``, ``score`` of the ordinary pieces of a model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    n = model.vocab_size()
    if n > MAX_PIECES:
        raise ValueError(f"{n} pieces: the table is broadcast and may have {MAX_PIECES}")
    rows = [(model.id_to_piece(i), i, float(model.get_score(i))) for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    return spark.createDataFrame(rows, "piece string, piece_id int, score double")


def words(text: Column) -> Column:
    """Words of a text that has some, with blanks as they are; null for an empty one."""
    return F.filter(F.split(F.when(text != "", F.concat(F.lit(" "), text)), _WORD), lambda w: w != "")


def seams(known: Iterable[str]) -> str:
    """Pattern of places in a word that no piece spans, as far as letters and ASCII signs tell.

    Signs that no piece has after (before) any character, and those that no piece has after (before) a
    letter. Neither a merge nor a path's edge can cross such a place, so the sides are independent.
    """
    letter = re.compile(_LETTER)
    follow, lead, after_letter, before_letter = set(), set(), set(), set()
    for piece in known:
        for a, b in zip(piece, piece[1:], strict=False):
            if b == MARK and a != MARK:
                raise ValueError(f"piece {piece!r} has the blank mark after another character")
            follow.add(b)
            lead.add(a)
            if letter.match(a):
                after_letter.add(b)
            if letter.match(b):
                before_letter.add(a)
    signs = [c for c in map(chr, range(128)) if not letter.match(c)]
    free = lambda used: "[" + "".join(f"\\x{ord(c):02x}" for c in signs if c not in used) + "]"
    patterns = [(follow, "(?={})"), (lead, "(?<={})"), (after_letter, f"(?<={_LETTER})(?={{}})"), (before_letter, f"(?<={{}})(?={_LETTER})")]
    return "|".join(p.format(free(used)) for used, p in patterns if set(signs) - used)


def edges(distinct: DataFrame, pieces: DataFrame, keys: list[str], longest: int, shortest: int = 1) -> DataFrame:
    """Substrings of each word (column ``word`` under ``keys``) that are pieces: (s, e, score, id).

    With ``shortest`` 1, a character without a piece has an edge too, its id null.
    """
    long_enough = distinct.where(F.length("word") >= shortest)
    starts = long_enough.select(*keys, "word", F.explode(F.sequence(F.lit(1), F.length("word") - (shortest - 1))).alias("a"))
    sizes = F.sequence(F.lit(shortest), F.least(F.lit(max(longest, shortest)), F.length("word") - F.col("a") + 1))
    spans = starts.select(*keys, "word", "a", F.explode(sizes).alias("k"))
    exploded = spans.select(*keys, "word", (F.col("a") - 1).alias("s"), (F.col("a") + F.col("k") - 1).alias("e"), F.substring("word", F.col("a"), F.col("k")).alias("text"))
    joined = exploded.join(F.broadcast(pieces), F.col("text") == F.col("piece"), "left" if shortest == 1 else "inner")
    found = joined.where(F.col("piece_id").isNotNull() | (F.col("e") - F.col("s") == 1)) if shortest == 1 else joined
    return found.select(*keys, "word", "s", "e", "score", F.col("piece_id").alias("id"))


def lattice(distinct: DataFrame, pieces: DataFrame, keys: list[str], longest: int) -> DataFrame:
    """Edges of each word as one array ``edges`` of (s, e, score, id)."""
    found = edges(distinct, pieces, keys, longest)
    return found.groupBy(*keys, "word").agg(F.collect_list(F.struct("s", "e", "score", "id")).alias("edges"))


def _bytes(character: Column, first_byte: int) -> Column:
    code = F.hex(F.encode(character, "UTF-8"))
    return F.transform(F.sequence(F.lit(0), (F.length(code) / 2 - 1).cast("int")), lambda i: (F.conv(F.substring(code, 2 * i + 1, 2), 16, 10).cast("int") + first_byte))


def _ids(cuts: Column, first_byte: int) -> Column:
    """Piece ids of the segments between cuts; a character without a piece gives its bytes."""
    segments = F.transform(F.sequence(F.lit(0), F.size(cuts) - 2), lambda j: F.struct(F.get(cuts, j).alias("s"), F.get(cuts, j + 1).alias("e")))
    found = lambda x: F.filter("edges", lambda d: (d["s"] == x["s"]) & (d["e"] == x["e"]))[0]["id"]
    return F.flatten(F.transform(segments, lambda x: F.when(found(x).isNotNull(), F.array(found(x))).otherwise(_bytes(F.substring("word", x["s"] + 1, F.lit(1)), first_byte))))


def merge_cuts(n: int, edges: dict[tuple[int, int], float]) -> list[int]:
    """Cuts of a word of n characters after all merges: the best-scored edge over two neighbours first, the leftmost of equals."""
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the segment that begins at a place
    live = [True] * n
    todo = [(-edges[i, i + 2], i, i + 1, i + 2) for i in range(n - 1) if (i, i + 2) in edges]
    heapq.heapify(todo)
    while todo:
        _, a, middle, stop = heapq.heappop(todo)
        if not (live[a] and end[a] == middle and middle < n and live[middle] and end[middle] == stop):
            continue
        live[middle], end[a] = False, stop
        if stop < n:
            before[stop] = a
            if (a, end[stop]) in edges:
                heapq.heappush(todo, (-edges[a, end[stop]], a, stop, end[stop]))
        if a and (before[a], stop) in edges:
            heapq.heappush(todo, (-edges[before[a], stop], before[a], a, stop))
    return [i for i in range(n) if live[i]] + [n]


class Merging:
    """Piece ids of words from the places of the longer pieces in them."""

    def __init__(self, rows: list, first_byte: int):
        self.first_byte = first_byte
        self.of_character = {r.piece: r.piece_id for r in rows if len(r.piece) == 1}
        self.piece = {r.piece_id: r.piece for r in rows}
        self.size = {r.piece_id: len(r.piece) for r in rows}
        self.score = {r.piece_id: r.score for r in rows}
        self.ids = np.array(sorted(self.size), np.int64)
        self.sizes = np.array([self.size[i] for i in self.ids.tolist()], np.int64)
        _, rank = np.unique([self.score[i] for i in self.ids.tolist()], return_inverse=True)
        self.rank = np.concatenate([[0], rank + 1]).astype(np.int32)  # by number of the piece from 1; 0 is none, higher is better

    def character(self, c: str) -> list[int]:
        known = self.of_character.get(c)
        return [known] if known is not None else [self.first_byte + b for b in c.encode()]

    def word(self, word: str, places: Iterable[tuple[int, int]] = ()) -> list[int]:
        ids = {(s, s + self.size[i]): i for s, i in places}
        cuts = merge_cuts(len(word), {x: self.score[i] for x, i in ids.items()}) if ids else range(len(word) + 1)
        out: list[int] = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            out += [ids[a, b]] if b - a > 1 else self.character(word[a])
        return out

    def words(self, words: list[str], word: np.ndarray, starts: np.ndarray, ids: np.ndarray) -> Iterator[tuple[str, array]]:
        """Words with their ids, from the longer pieces in them: number of the word, place and id, in any order."""
        order = np.argsort(word, kind="stable")
        starts, ids = starts[order], ids[order]
        bounds = np.searchsorted(word[order], np.arange(len(words) + 1, dtype=word.dtype))
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for i in np.flatnonzero(lengths > LONG).tolist():
            mine = slice(bounds[i], bounds[i + 1])
            yield words[i], array("i", self.word(words[i], zip(starts[mine].tolist(), ids[mine].tolist(), strict=True)))
        short = np.flatnonzero(lengths <= LONG)
        for at in range(0, len(short), MERGED_AT_ONCE):
            some = short[at : at + MERGED_AT_ONCE]
            rows, ends = _joined(np.arange(len(ids)), bounds, some)
            yield from self._at_once([words[i] for i in some.tolist()], lengths[some], np.repeat(np.arange(len(some)), np.diff(ends)), starts[rows], ids[rows])

    def _at_once(self, words: list[str], lengths: np.ndarray, word: np.ndarray, starts: np.ndarray, ids: np.ndarray) -> Iterator[tuple[str, array]]:
        """One merge per word and round, the best pair's, until no word has a pair that is a piece."""
        number = np.searchsorted(self.ids, ids)
        longest = int(self.sizes[number].max(initial=1))
        known = np.zeros((int(lengths.sum()), longest + 1), np.int32)  # piece by first character and length
        known[(np.cumsum(lengths) - lengths)[word] + starts, self.sizes[number]] = number + 1
        of = np.repeat(np.arange(len(words)), lengths)
        begin, owner, size, done = np.arange(len(of)), of, np.ones(len(of), np.int64), []
        while len(begin):
            score = np.zeros(len(begin), np.int32)
            pair = np.flatnonzero((owner[1:] == owner[:-1]) & (size[1:] + size[:-1] <= longest))
            score[pair] = self.rank[known[begin[pair], size[pair] + size[pair + 1]]]
            heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            counts = np.diff(np.append(heads, len(begin)))
            best = np.repeat(np.maximum.reduceat(score, heads), counts)
            going = best > 0
            done.append((begin[~going], size[~going]))
            begin, owner, size, score, best = (x[going] for x in (begin, owner, size, score, best))
            hit = np.flatnonzero(score == best)
            hit = hit[np.concatenate([[True], owner[hit][1:] != owner[hit][:-1]])] if len(hit) else hit
            size[hit] += size[hit + 1]
            begin, owner, size = (np.delete(x, hit + 1) for x in (begin, owner, size))
        begin, size = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(begin)
        begin, size = begin[order], size[order]
        # pieces of one character, and the bytes of characters without a piece
        alone = size == 1
        codes, inverse = np.unique(np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)[begin[alone]], return_inverse=True)
        texts = [self.character(chr(c)) for c in codes.tolist()]
        width = np.fromiter(map(len, texts), np.int64, len(texts))
        flat = np.array([i for x in texts for i in x], np.int32)
        counts = np.ones(len(begin), np.int64)
        counts[alone] = width[inverse]
        single = np.repeat(alone, counts)
        values = np.empty(len(single), np.int32)
        values[~single] = self.ids[known[begin[~alone], size[~alone]] - 1]
        values[single], _ = _joined(flat, np.concatenate([[0], np.cumsum(width)]), inverse)
        ends = np.cumsum(np.bincount(of[begin], counts, len(words)).astype(np.int64)).tolist()
        for w, a, b in zip(words, [0, *ends], ends, strict=False):
            yield w, array("i", values[a:b].tobytes())

    def table(self, words: Iterable[str], known: pa.Table) -> Iterator[tuple[str, array]]:
        """Words with their ids, from a row for each longer piece: ``crc`` of its word, ``place`` with its start and id.

        Rows are taken up a share of the words at a time, so that what numpy holds is small beside the table.
        """
        shares: list[list[str]] = [[] for _ in range(SHARES)]
        for w in words:
            shares[zlib.crc32(w.encode()) % SHARES].append(w)
        chunks = [(b.column("crc").to_numpy(), b.column("place").to_numpy()) for b in known.to_batches()]
        for k, mine in enumerate(shares):
            rows = [(crc[here], place[here]) for crc, place in chunks for here in [crc % SHARES == k]]
            yield from self.placed(mine, *(np.concatenate([np.empty(0, np.int64), *x]) for x in (zip(*rows, strict=True) if rows else ((), ()))))

    def placed(self, words: list[str], crc: np.ndarray, place: np.ndarray) -> Iterator[tuple[str, array]]:
        """Words with their ids; a place has the start in its upper and the id in its lower 32 bits.

        Where words share a checksum, a row goes to those that have the piece there.
        """
        own = np.fromiter((zlib.crc32(w.encode()) for w in words), np.int64, len(words))
        order = np.argsort(own, kind="stable").astype(np.int32)
        own = own[order]
        at = np.searchsorted(own, crc).astype(np.int32)
        if len(at) and (int(at.max()) == len(own) or (own[at] != crc).any()):
            raise ValueError("an edge of a word that is in no text")
        starts, ids = (place >> 32).astype(np.int32), place.astype(np.int32)
        word, alone = order[at], np.ones(len(at), bool)
        shared, more = set(own[1:][own[1:] == own[:-1]].tolist()), []
        if shared:
            alone = ~np.isin(crc, list(shared))
            for i in np.flatnonzero(~alone).tolist():
                same = order[np.searchsorted(own, crc[i]) : np.searchsorted(own, crc[i], "right")].tolist()
                more += [(w, starts[i], ids[i]) for w in same if words[w].startswith(self.piece[int(ids[i])], int(starts[i]))]
            word, starts, ids = (np.concatenate([x[alone], np.array(y, np.int32)]) for x, y in zip((word, starts, ids), zip(*more, strict=True) if more else ([], [], []), strict=True))
        return self.words(words, word, starts, ids)


def viterbi_fold(unknown: float = -1e6) -> Column:
    """Cuts of the path with the best sum of scores; of equals, the one whose last piece is longest."""
    start = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(-1).alias("back")))
    n = F.length("word")

    def step(best: Column, e: Column) -> Column:
        into = F.filter("edges", lambda d: d["e"] == e)
        options = F.transform(into, lambda d: F.struct((F.get(best, d["s"])["score"] + F.coalesce(d["score"], F.lit(unknown))).alias("score"), (-d["s"]).alias("back")))
        top = F.array_max(options)
        return F.concat(best, F.array(F.struct(top["score"].alias("score"), (-top["back"]).alias("back"))))

    def walk(best: Column) -> Column:
        go = lambda cuts, _: F.when(cuts[0] == 0, cuts).otherwise(F.concat(F.array(F.get(best, cuts[0])["back"]), cuts))
        return F.aggregate(F.sequence(F.lit(1), n), F.array(n), go)

    return F.aggregate(F.sequence(F.lit(1), n), start, step, walk)


def folded(distinct: DataFrame, pieces: DataFrame, keys: list[str], longest: int, fold: str, first_byte: int) -> DataFrame:
    """``keys``, ``word`` and ``ids`` (Viterbi), or the word's checksum and a row for the place of each longer piece, which ``Merging`` folds."""
    if fold == "merge":
        place = F.shiftleft(F.col("s").cast("long"), 32).bitwiseOR(F.col("id").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
        marked = distinct.withColumn("crc", F.crc32(F.col("word").cast("binary")))
        return edges(marked, pieces, [*keys, "crc"], longest, shortest=2).select(*keys, "crc", place.alias("place"))
    if fold != "viterbi":
        raise ValueError(f"no fold {fold}")
    found = lattice(distinct, pieces, keys, longest)
    return found.withColumn("cuts", viterbi_fold()).select(*keys, "word", _ids(F.col("cuts"), first_byte).alias("ids"))


def _by_word(segments: dict[str, array], cut: str, plain: Callable[[str], list[int]]) -> Callable[[str], array]:
    """Ids of a word from those of its segments, each word put together once; ``plain`` is for segments without an edge.

    Ids are kept as machine integers: as lists of Python integers they took most of a task's memory. A word of one
    segment shares its ids.
    """
    split = re.compile(cut).split if cut else lambda w: [w]
    made: dict[str, array] = {}

    def ids(word: str) -> array:
        got = segments.get(word) or made.get(word)
        if got is None:
            got = made[word] = array("i")
            for x in split(word):
                if x:
                    got.extend(segments.get(x) or plain(x))
        return got

    return ids


class _Numbers(dict):
    """Words by the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def _joined(flat: np.ndarray, bounds: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbered lists (those of ``flat`` between ``bounds``) one after the other, and where each begins and the last ends."""
    counts = np.diff(bounds)[lists]
    ends = np.concatenate([[0], np.cumsum(counts)])
    small = np.int32 if max(len(flat), int(ends[-1])) < 1 << 31 else np.int64
    at = np.repeat((bounds[:-1][lists] - ends[:-1]).astype(small), counts)
    at += np.arange(ends[-1], dtype=small)
    return flat[at], ends


def encode(docs: DataFrame, pieces: DataFrame, doc_id: str = "doc_id", text: str = "text", fold: str = "merge", first_byte: int = 3, part_bytes: int = PART_BYTES) -> DataFrame:
    """``doc_id`` and ``ids`` of every row."""
    known = pieces.select("piece", "piece_id", "score").take(MAX_PIECES + 1)
    if len(known) > MAX_PIECES:
        raise ValueError(f"the table is broadcast and may have {MAX_PIECES} pieces")
    cut, longest, merging = seams(r.piece for r in known), max((len(r.piece) for r in known), default=1), Merging(known, first_byte)
    body = F.coalesce(F.col(text), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(body))).first()[0] or 0
    parts = max(1, -(-total // part_bytes))
    dealt = docs.select(F.pmod(F.xxhash64(F.col(doc_id), body), F.lit(parts)).cast("int").alias("part"), F.col(doc_id).alias("doc_id"), body.alias("text")).repartition(2 * parts, "part")
    # reading doc_id here makes both branches need the same columns, so they share one exchange of texts
    nothing = F.coalesce(F.repeat(F.col("doc_id").cast("string"), F.lit(0)), F.lit(""))
    distinct = dealt.select("part", F.explode(words(F.concat("text", nothing))).alias("word")).distinct()
    distinct = distinct.withColumn("word", F.translate("word", " ", MARK))
    if cut:
        # a pattern to split by is compiled for every row, one to extract by is not
        split = F.regexp_extract_all("word", F.lit(f"(?s).+?(?:{cut}|\\z)"), F.lit(0))
        distinct = distinct.select("part", F.explode(F.when(F.col("word").rlike(_SIGN), split).otherwise(F.array("word"))).alias("word"))
    distinct = distinct.distinct()
    encoded = folded(distinct, pieces, ["part"], longest, fold, first_byte).withColumn("part", F.col("part").alias("part"))  # a name of its own for the cogroup
    schema = StructType([StructField("doc_id", dealt.schema["doc_id"].dataType), StructField("ids", ArrayType(IntegerType()))])

    def attach(own: pa.Table, known: pa.Table) -> pa.Table:
        numbers, places, ends, split = _Numbers(), array("i"), [0], re.compile(f"{MARK}+[^{MARK}]*").findall
        for chunk in own.column("text").chunks:
            for t in chunk:
                whole = t.as_py()
                if whole:
                    places.extend(map(numbers.__getitem__, split(MARK + whole.replace(" ", MARK))))
                ends.append(len(places))
        if fold == "merge":
            parts = re.compile(cut).split if cut else lambda w: [w]
            segments = dict(merging.table({x for w in numbers for x in parts(w) if x}, known))
        else:
            segments = {word.as_py(): array("i", ids.as_py()) for word, ids in zip(known.column("word"), known.column("ids"), strict=True)}
        ids = _by_word(segments, cut, merging.word)
        flat, bounds = array("i"), [0]
        for w in numbers:
            flat.extend(ids(w))
            bounds.append(len(flat))
        del numbers, ids, segments
        values, bounds = _joined(np.frombuffer(flat, np.int32), np.array(bounds), np.frombuffer(places, np.int32))
        lists = pa.ListArray.from_arrays(pa.array(bounds[ends], pa.int32()), pa.array(values))
        return pa.table({"doc_id": own.column("doc_id"), "ids": lists})

    return dealt.groupBy("part").cogroup(encoded.groupBy("part")).applyInArrow(attach, schema)


def decode(encoded: DataFrame, model_pieces: list[str], first_byte: int = 3, keep: list[str] | None = None) -> DataFrame:
    """``row`` (the kept columns) and ``text``: pieces and byte pieces joined, marks as blanks, without the one in front; null ids give an empty text."""
    raw = [bytes([i - first_byte]) if first_byte <= i < first_byte + 256 else p.encode() for i, p in enumerate(model_pieces)]
    known = F.split(F.lit(",".join(b.hex() for b in raw)), ",")  # becomes one literal of the plan
    joined = F.unhex(F.array_join(F.transform(F.coalesce("ids", F.array().cast("array<int>")), lambda i: F.element_at(known, i + 1)), ""))
    text = F.replace(F.make_valid_utf8(joined.cast("string")), F.lit(MARK), F.lit(" "))
    row = F.struct(*[F.col(f"`{c}`") for c in (encoded.columns if keep is None else keep)])
    return encoded.select(row.alias("row"), F.substring(text, 2, 2**31 - 1).alias("text"))
