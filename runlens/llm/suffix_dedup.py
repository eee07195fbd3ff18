"""Removal of byte strings that an earlier document has, by suffix arrays.

Every byte covered by a DEPTH-byte string that also starts in a document with a smaller id goes. All
strings are judged on the input. Suffix arrays of arbitrary shards would have to be merged all with all;
here a shard holds what can be equal, so shards need no merging among each other:

1. ``windows``: each DEPTH-byte window is named after its minimizer, the smallest hash of the GRAM-byte
   strings in it. Equal windows have equal minimizers. Documents are dealt to parts by a hash; a part
   reports each minimizer once, with a flag if several of its documents hold it, however many do.
2. Minimizers held by more than one document go back to the parts that reported them.
3. A part cuts its documents at runs of windows with such a minimizer and sends each different piece of
   text once, with its smallest owner, to the minimizer's shard; further owners in the part are known to
   lose it without being sent. So a passage in a third of all documents is one piece per part.
4. A shard builds suffix arrays of bounded blocks, finds classes of equal windows by common prefixes,
   and merges its blocks by binary search. Windows that a smaller owner has go back to the parts.
5. Parts remove the covered bytes.

Texts are shuffled once, by part; the three steps that need them read the same exchange. Exact copies
are found by digest first and take no part: all they hold is in a smaller document.

Defined cases: a null text is empty. Rows without id are nobody's predecessor and keep all. Rows that
share an id are not predecessors of each other, so repeated rows get the same result. Texts shorter
than DEPTH bytes keep all. Very long texts are read in chunks that overlap by DEPTH - 1 bytes. Removal
can split a character: the text given back leaves out what is no longer UTF-8, counts and digest don't.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from runlens.llm.suffix_array import BLOCK, DEPTH, Block, merge
from runlens.session import stage

#: Bytes of text per part.
PART_BYTES = 4 << 20
#: Bytes of text per bucket of minimizers, of which there is one of some 5 bytes for every 14 of text.
BUCKET_BYTES = 24 << 20
#: Bytes of text that a task hashes at once: some ten arrays of 8 bytes for each of them are alive.
CHUNK = 1 << 19
GRAM = 24

_BASE = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE_BITS = np.uint64(22)  # a chunk and its overlap are shorter


def _pow(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 1 << 64))


def gram_hashes(buffer: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position on, by doubling: 24 is 8 and 16."""
    h = _BYTE[buffer]
    for size in (1, 2, 4):
        h = h[:-size] * _pow(size) + h[size:]
    double = h[:-8] * _pow(8) + h[8:]
    x = h[: len(h) - 16] * _pow(16) + double[8:]
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if size < width else x


def windows(texts: list[tuple[int, int, bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]]:
    """Runs of windows with one minimizer, chunk by chunk of (ordinal, start in document, bytes).

    Per run: minimizer, index of the text in the chunk, first window in the chunk's buffer, number of windows.
    """
    at = 0
    while at < len(texts):
        stop, held = at, 0
        while stop < len(texts) and (stop == at or held + len(texts[stop][2]) <= CHUNK + DEPTH):
            held += len(texts[stop][2])
            stop += 1
        chunk = [t[2] for t in texts[at:stop]]
        joined = b"".join(chunk)
        buffer = np.frombuffer(joined, dtype=np.uint8)
        lengths = np.array([len(c) for c in chunk])
        hashes = gram_hashes(buffer)
        best = _sliding_min(((hashes >> _PLACE_BITS) << _PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64), DEPTH - GRAM + 1)
        owner = np.repeat(np.arange(len(chunk)), lengths)[: len(best)]
        place = np.flatnonzero(np.arange(len(best)) + DEPTH <= np.cumsum(lengths)[owner])
        own = best[place]
        first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        yield own[first] >> _PLACE_BITS, owner[place[first]] + at, place[first], np.diff(np.append(first, len(own))), joined
        at = stop


def _chunks(ordinal: int, text: bytes) -> Iterator[tuple[int, int, bytes]]:
    for a in range(0, max(1, len(text) - DEPTH + 1), CHUNK):
        yield ordinal, a, text[a : a + CHUNK + DEPTH - 1]


# ---- what travels: arrays in compressed bytes


def _pack(**arrays: np.ndarray) -> bytes:
    import zstandard

    head = ";".join(f"{k},{v.dtype.str},{len(v)}" for k, v in arrays.items()).encode()
    return zstandard.ZstdCompressor(level=1).compress(len(head).to_bytes(4, "little") + head + b"".join(v.tobytes() for v in arrays.values()))


def _unpack(blob: bytes) -> dict[str, np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    at = 4 + int.from_bytes(raw[:4], "little")
    out = {}
    for name, kind, n in (x.split(",") for x in raw[4:at].decode().split(";")):
        out[name] = np.frombuffer(raw, dtype=kind, count=int(n), offset=at)
        at += out[name].nbytes
    return out


def _split(values: np.ndarray, keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Positions of each key, by a stable sort."""
    if not len(keys):
        return
    order = np.argsort(keys, kind="stable")
    cuts = np.flatnonzero(np.concatenate(([True], keys[order][1:] != keys[order][:-1])))
    for a, b in zip(cuts, [*cuts[1:], len(keys)], strict=True):
        yield int(keys[order[a]]), values[order[a:b]]


class _Part:
    """Documents of a part in a fixed order; ordinals name them between steps."""

    def __init__(self, docs: pa.Table, more: pa.Table):
        rows = sorted(zip(docs.column("id").to_pylist(), [(t or "").encode() for t in docs.column("text").to_pylist()], range(docs.num_rows), strict=True), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        copies = {(i, d) for i, d in zip(more.column("id").to_pylist(), more.column("digest").to_pylist(), strict=True) if i is not None}
        named = {i for i, _ in copies}
        self.ids = [r[0] for r in rows]
        self.texts = [r[1] for r in rows]
        self.row = [r[2] for r in rows]
        self.copy = [i in named and (i, hashlib.md5(t).hexdigest()) in copies for i, t in zip(self.ids, self.texts, strict=True)]
        self.blobs = [b for b in more.column("blob").to_pylist() if b is not None]

    def heads(self) -> list[tuple[int, int, bytes]]:
        return [c for n, (i, t, copy) in enumerate(zip(self.ids, self.texts, self.copy, strict=True)) if i is not None and not copy and len(t) >= DEPTH for c in _chunks(n, t)]


def _table(schema: pa.Schema, **columns) -> pa.Table:
    return pa.table({k: pa.array(v, type=schema.field(k).type) for k, v in columns.items()}, schema=schema)


_ROUTED = pa.schema([("to", pa.int32()), ("part", pa.int32()), ("blob", pa.binary())])
_BACK = pa.schema([("part", pa.int32()), ("blob", pa.binary())])


def _report(buckets: int):
    """Step 1: the part's minimizers, each once, by bucket."""

    def work(key: tuple, docs: pa.Table, more: pa.Table) -> pa.Table:
        me = _Part(docs, more)
        texts = me.heads()
        ids = np.array([me.ids[n] for n, _, _ in texts], dtype=np.int64)
        names, owners = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
        for name, owner, _, _, _ in windows(texts):
            names.append(name), owners.append(ids[owner])
        name, owner = np.concatenate(names), np.concatenate(owners)
        order = np.argsort(name, kind="stable")
        name, owner = name[order], owner[order]
        starts = np.flatnonzero(np.concatenate(([True], name[1:] != name[:-1]))) if len(name) else np.zeros(0, dtype=np.int64)
        several = np.minimum.reduceat(owner, starts) != np.maximum.reduceat(owner, starts) if len(name) else np.zeros(0, dtype=bool)
        name = name[starts]
        out = [(b, _pack(name=(name[p] // np.uint64(buckets)).astype(np.uint32), several=several[p].astype(np.uint8))) for b, p in _split(np.arange(len(name)), name % np.uint64(buckets))]
        return _table(_ROUTED, to=[b for b, _ in out], part=[key[0].as_py()] * len(out), blob=[x for _, x in out])

    return work


def _shared(table: pa.Table) -> pa.Table:
    """Step 2: of the names in a bucket, those held by more than one document, to each part that holds them."""
    found = [_unpack(b) for b in table.column("blob").to_pylist()]
    name = np.concatenate([f["name"] for f in found])
    several = np.concatenate([f["several"] for f in found]).astype(bool)
    source = np.repeat(np.arange(len(found)), [len(f["name"]) for f in found])
    values, group, counts = np.unique(name, return_inverse=True, return_counts=True)
    good = counts > 1
    good[group[several]] = True
    parts, bucket = table.column("part").to_pylist(), table.column("to")[0].as_py()
    kept = np.flatnonzero(good[group])
    out = [(parts[s], _pack(bucket=np.array([bucket], dtype=np.uint32), name=name[p])) for s, p in _split(kept, source[kept])]
    return _table(_BACK, part=[s for s, _ in out], blob=[b for _, b in out])


def _pieces(buckets: int, shards: int):
    """Step 3: pieces of text that another document may have, to the shards of their minimizers."""

    def work(key: tuple, docs: pa.Table, more: pa.Table) -> pa.Table:
        me, part = _Part(docs, more), key[0].as_py()
        marks = [_unpack(b) for b in me.blobs]
        known = np.sort(np.concatenate([np.zeros(0, dtype=np.uint64), *[(m["bucket"].astype(np.uint64) << np.uint64(32)) | m["name"] for m in marks]]))
        texts = me.heads() if len(known) else []
        first_owner: dict[bytes, int] = {}
        sent: dict[int, list] = {}
        local: list[tuple[int, int, int]] = []
        for name, owner, place, count, joined in windows(texts):
            wanted = ((name % np.uint64(buckets)) << np.uint64(32)) | ((name // np.uint64(buckets)) & np.uint64(0xFFFFFFFF))
            at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
            hit = np.flatnonzero(known[at] == wanted)
            begins = dict(zip(range(owner[0], owner[-1] + 1), np.cumsum([0, *[len(texts[o][2]) for o in range(owner[0], owner[-1])]]).tolist(), strict=True)) if len(owner) else {}
            for n, o, p, c, shard in zip(name[hit].tolist(), owner[hit].tolist(), place[hit].tolist(), count[hit].tolist(), (name[hit] % np.uint64(shards)).tolist(), strict=True):
                piece = joined[p : p + c + DEPTH - 1]
                ordinal, base, _ = texts[o]
                start, own = base + p - begins[o], me.ids[ordinal]
                if first_owner.setdefault(piece, own) == own:
                    sent.setdefault(shard, []).append((ordinal, own, start, piece))
                else:
                    local.append((ordinal, start, c))
        out = [
            (
                shard,
                _pack(
                    ordinal=np.array([x[0] for x in rows], dtype=np.uint32),
                    id=np.array([x[1] for x in rows], dtype=np.int64),
                    start=np.array([x[2] for x in rows], dtype=np.uint32),
                    length=np.array([len(x[3]) for x in rows], dtype=np.uint16),
                    text=np.frombuffer(b"".join(x[3] for x in rows), dtype=np.uint8),
                ),
            )
            for shard, rows in sent.items()
        ]
        if local:
            out.append((part % shards, _spans(*(np.array(x) for x in zip(*local, strict=True)))))
        return _table(_ROUTED, to=[s for s, _ in out], part=[part] * len(out), blob=[b for _, b in out])

    return work


def _spans(ordinal: np.ndarray, start: np.ndarray, count: np.ndarray) -> bytes:
    return _pack(ordinal=ordinal.astype(np.uint32), start=start.astype(np.uint32), count=count.astype(np.uint32))


def _later_copies(owner: np.ndarray, length: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Pieces of which a smaller owner has an equal one: all their windows go, and nobody is judged by them."""
    raw, ends = text.tobytes(), np.cumsum(length).tolist()
    pieces = [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]
    least: dict[bytes, int] = {}
    for piece, own in zip(pieces, owner.tolist(), strict=True):
        if least.setdefault(piece, own) > own:
            least[piece] = own
    return owner > np.array([least[p] for p in pieces], dtype=np.int64)


def _judge(table: pa.Table) -> pa.Table:
    """Step 4: runs of windows in a shard's pieces that a smaller owner has too; known runs pass through.

    Equal pieces are told first: of a passage that many parts have, only one piece enters the suffix arrays.
    """
    out: list[tuple[int, bytes]] = []
    found, parts = [], []
    for part, blob in zip(table.column("part").to_pylist(), table.column("blob").to_pylist(), strict=True):
        got = _unpack(blob)
        if "text" in got:
            found.append(got), parts.append(part)
        else:
            out.append((part, blob))
    if found:
        column = lambda k: np.concatenate([f[k] for f in found])
        part = np.repeat(parts, [len(f["id"]) for f in found])
        ordinal, owner, start, length, text = column("ordinal"), column("id"), column("start"), column("length").astype(np.int64), column("text")
        later = _later_copies(owner, length, text)
        out += [(p, _spans(ordinal[i], start[i], length[i] - DEPTH + 1)) for p, i in _split(np.flatnonzero(later), part[later])]
        text = text[np.repeat(~later, length)]
        part, ordinal, owner, start, length = (x[~later] for x in (part, ordinal, owner, start, length))
        ends = np.cumsum(length)
        blocks, cuts, a = [], [], 0
        while a < len(ends):
            base = int(ends[a] - length[a])
            b = max(a + 1, int(np.searchsorted(ends, base + BLOCK, side="right")))
            blocks.append(Block(text[base : int(ends[b - 1])], ends[a:b] - length[a:b] - base, length[a:b] - DEPTH + 1, owner[a:b]))
            cuts.append(a)
            a = b
        merge(blocks)
        hit = np.concatenate([b.covered() for b in blocks])
        segment = np.concatenate([b.segment + c for b, c in zip(blocks, cuts, strict=True)])
        step = np.concatenate([b.step for b in blocks])
        at = np.flatnonzero(hit)
        segment, step = segment[at], step[at]
        begins = np.flatnonzero(np.concatenate(([True], (segment[1:] != segment[:-1]) | (step[1:] != step[:-1] + 1)))) if len(at) else np.zeros(0, dtype=np.int64)
        count = np.diff(np.append(begins, len(at)))
        s = segment[begins]
        where = start[s] + step[begins]
        out += [(p, _spans(ordinal[s[i]], where[i], count[i])) for p, i in _split(np.arange(len(s)), part[s])]
    return _table(_BACK, part=[p for p, _ in out], blob=[b for _, b in out])


def _remove(schema: StructType):
    """Step 5: what is left of each document of a part."""

    def work(docs: pa.Table, more: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        me = _Part(docs, more)
        got = [_unpack(b) for b in me.blobs]
        column = lambda k: np.concatenate([np.zeros(0, dtype=np.int64), *[g[k].astype(np.int64) for g in got]])
        ordinal, start, count = column("ordinal"), column("start"), column("count")
        order = np.lexsort((start, ordinal))
        ordinal, start, count = ordinal[order], start[order], count[order]
        borders = np.searchsorted(ordinal, np.arange(len(me.ids) + 1))
        out: list[tuple] = [()] * len(me.ids)
        for n, text in enumerate(me.texts):
            kept, spans = [], 0
            if me.copy[n] and len(text) >= DEPTH:
                spans, left = 1, b""
            else:
                at = 0
                a, b = borders[n], borders[n + 1]
                for s, c in zip(start[a:b].tolist(), count[a:b].tolist(), strict=True):
                    if s > at or not spans:
                        kept.append(text[at:s])
                        spans += 1
                    at = max(at, s + c + DEPTH - 1)
                left = b"".join([*kept, text[at:]])
            out[me.row[n]] = (len(text), len(text) - len(left), spans, hashlib.sha256(left).hexdigest(), left.decode("utf-8", "ignore"))
        target = to_arrow_schema(schema)
        added = {f.name: pa.array([o[i] for o in out], type=f.type) for i, f in enumerate(list(target)[1:])}
        return pa.table({"row": docs.column("row"), **added}, schema=target)

    return work


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None, part_bytes: int = PART_BYTES) -> DataFrame:
    """``row`` (kept columns), ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, ``kept_text`` per row."""
    body = F.coalesce(F.col(text), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(body))).first()[0] or 0
    parts = max(1, -(-total // part_bytes))
    shards = parts
    buckets = max(1, -(-total * PART_BYTES // (BUCKET_BYTES * part_bytes)))
    kept = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)])
    dealt = docs.select(F.pmod(F.xxhash64(F.col(doc_id), body), F.lit(parts)).cast("int").alias("part"), F.col(doc_id).cast("long").alias("id"), body.alias("text"), kept.alias("row"))

    digests = stage(dealt.where(F.col("id").isNotNull()).select("part", "id", F.md5(F.col("text").cast("binary")).alias("digest")))
    first = digests.groupBy("digest").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    copies = stage(digests.join(first, "digest").where("id > least").select("part", "id", "digest", F.lit(None).cast("binary").alias("blob")))
    found = lambda df: df.select("part", F.lit(None).cast("long").alias("id"), F.lit(None).cast("string").alias("digest"), "blob").union(copies)

    routed = StructType([StructField("to", IntegerType()), StructField("part", IntegerType()), StructField("blob", BinaryType())])
    back = StructType([StructField("part", IntegerType()), StructField("blob", BinaryType())])
    result = StructType([StructField("row", dealt.schema["row"].dataType), StructField("n_bytes", LongType()), StructField("n_removed", LongType()), StructField("n_spans", LongType()), StructField("kept_sha256", StringType()), StructField("kept_text", StringType())])

    with_docs = lambda more: dealt.groupBy("part").cogroup(more.groupBy("part"))
    reported = with_docs(copies).applyInArrow(_report(buckets), routed)
    shared = reported.groupBy("to").applyInArrow(_shared, back)
    pieces = with_docs(found(shared)).applyInArrow(_pieces(buckets, shards), routed)
    judged = pieces.groupBy("to").applyInArrow(_judge, back)
    return with_docs(found(judged)).applyInArrow(_remove(result), result)
