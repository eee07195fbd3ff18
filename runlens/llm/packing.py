"""Sum-of-squares packing of tokenised documents into sequences of a fixed length.

A document's ids are cut into pieces only where it is longer than a sequence. Pieces are dealt by a
hash to shards of about SHARD_PIECES pieces, so that work and memory of a task stay the same at any
size. Within a shard a piece goes where the sum over gaps of the squared number of open bins with that
gap becomes smallest; the state is one counter per gap. Pieces come in hash order, the shortest last,
which leaves few open bins; what a shard wastes is a few bins in many thousand.

Defined cases: a null text counts as empty and has the end id alone. Repeated rows are pieces of
their own. An empty table gives an empty result. Piece, start, length and checksum come from the
whole text.
"""

from __future__ import annotations

import functools
import re
import struct
import unicodedata
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm.rows import map_rows
from runlens.session import stage

SEQUENCE = 4096
END_ID = 1
SHARD_PIECES = 1 << 16
#: Pieces up to this length are placed last, the longest first.
SHORT = 256
#: Words whose ids a Python worker remembers.
REMEMBERED = 250_000

# The pre-tokenizer splits these texts at the same places as this pattern; any text with another
# character goes to the tokenizer whole.
_PLAIN = re.compile("[\\t\\n\\r\\x20-\\x7eÀ-ÖØ-öø-įĴ-ňŊ-ž]*")
_WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-įĴ-ňŊ-ž]+|[0-9]|[^\\sa-zß-öø-įĴ-ňŊ-ž0-9]+")


class Encoder:
    """Ids of texts as little-endian 32-bit bytes. Words of plain texts are encoded once and remembered.

    New words are encoded in one call, blanks between; an id whose entry ends a word, as every word's last
    one does, cuts the result apart again.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for word, i in vocabulary.items() if word.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, new: list[str]) -> None:
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(new)], add_special_tokens=False)[0].ids, dtype="<u4")
        stops = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        if len(stops) == len(new):
            raw = ids.tobytes()
            self.known.update(zip(new, [raw[a:b] for a, b in zip([0, *stops], stops, strict=False)], strict=True))
        else:
            self.known.update((p, self._whole(p)) for p in new)

    def __call__(self, texts: list[str]) -> list[bytes]:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        parts = [_WORD.findall(unicodedata.normalize("NFC", t).lower()) if _PLAIN.fullmatch(t) and "<|" not in t else None for t in texts]
        if new := list(set().union(*[p for p in parts if p]).difference(known)):
            self._learn(new)
        return [self._whole(t) if p is None else b"".join([known[x] for x in p]) for t, p in zip(texts, parts, strict=True)]


@functools.cache
def encoder(path: str) -> Encoder:
    """One per Python worker, which serves many tasks."""
    return Encoder(path)


def cut(ids: bytes, length: int = SEQUENCE) -> list[dict]:
    """Pieces of a document's ids: number, start, length, checksum."""
    step = 4 * length
    return [{"piece": i, "start": i * length, "length": len(p := ids[a : a + step]) // 4, "ids_crc32": zlib.crc32(p)} for i, a in enumerate(range(0, len(ids), step))]


def pieces(docs: DataFrame, tokenizer: str, text: str = "text", length: int = SEQUENCE, keep: list[str] | None = None) -> DataFrame:
    """``row`` and, per piece, ``piece``, ``start``, ``length``, ``ids_crc32``. ``tokenizer``: path of its file on every worker."""

    def make():
        encode, end = encoder(tokenizer), struct.pack("<I", END_ID)
        return lambda columns: {"pieces": [cut(ids + end, length) for ids in encode([t or "" for t in columns["text"]])]}

    found = map_rows(docs, {"text": text}, "pieces array<struct<piece:int,start:long,length:long,ids_crc32:long>>", make, keep)
    return found.select("row", F.inline("pieces"))


def place(lengths: np.ndarray, size: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, in the given order, by the sum-of-squares rule.

    Moving a bin from gap g to gap g - s changes the sum by 2 (N[g - s] - N[g] + 1), a full bin no longer
    counts, and a new bin changes it by 2 N[size - s] + 1. Ties go to the smaller gap.
    """
    count = np.zeros(size + 1, dtype=np.int64)
    open_bins: list[list[int]] = [[] for _ in range(size + 1)]
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    made, never = 0, np.int64(1) << 40
    for i, s in enumerate(lengths.tolist()):
        here, best = count[s:size], size
        if s < size:
            change = 2 * (count[: size - s] - here) + 2
            change[0] = 1 - 2 * here[0]
            change[here == 0] = never
            j = int(change.argmin())
            if change[j] <= 2 * count[size - s] + 1:
                best = s + j
        if best == size:
            bins[i], made = made, made + 1
        else:
            bins[i] = open_bins[best].pop()
            count[best] -= 1
        offsets[i] = size - best
        if best > s:
            open_bins[best - s].append(bins[i])
            count[best - s] += 1
    return bins, offsets


def pack(cut_pieces: DataFrame, length: int = SEQUENCE, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``.

    ``sequence_id`` is the shard and the bin in it. The pieces are staged once, since their number
    decides the number of shards and tokenising twice would cost more than reading them.
    """
    held = stage(cut_pieces)
    shards = max(1, -(-held.count() // shard_pieces))
    order = F.xxhash64("row", "piece", "ids_crc32")
    dealt = held.withColumn("order", order).withColumn("shard", F.pmod(F.xxhash64("order"), F.lit(shards)))

    def work(key: tuple, shard: pd.DataFrame) -> pd.DataFrame:
        # hash order, then the short ones from the longest on
        late = np.where(shard["length"] <= SHORT, SHORT - shard["length"] + 1, 0)
        shard = shard.iloc[np.lexsort((shard["order"], late))]
        bins, offsets = place(shard["length"].to_numpy(), length)
        return shard.drop(columns=["order", "shard"]).assign(sequence_id=bins + (int(key[0]) << 32), offset=offsets)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema)
    return dealt.groupBy("shard").applyInPandas(work, f"{fields}, sequence_id long, offset long")
