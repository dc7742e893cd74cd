"""Benchmark decontamination: q-gram lemma filter and banded alignment.

Texts are compared in lower case with every run of other characters than
letters and digits as one blank.  A benchmark item is cut into overlapping
segments of ``SEGMENT`` bytes (a shorter item is one segment).  A document
holds a segment if some region of it aligns with the whole segment within
``floor(RATE * length)`` edits.  By the q-gram lemma such a region shares at
least ``length - Q + 1 - Q * edits`` q-grams with the segment, on diagonals
that differ by no more than the edits.  So hits are counted in overlapping
bands of diagonals, bands below the bound are left out, and the rest is
verified by a banded alignment.

The benchmark is taken in blocks of at most ``BLOCK_BYTES`` of text; the
index of a block is broadcast and all documents are read against it, so
what is broadcast does not grow with either table.

Cases: null or blank texts and items never match; items of less than Q bytes
after normalising have no q-gram and are not searched; null ids are
returned as null; repeated rows each give their own result rows; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import passes, text_of

Q = 8
SEGMENT, STRIDE = 96, 48
#: Edits for each byte of a segment.
RATE = 0.08
BLOCK_BYTES = 4 << 20
#: Segments are indexed by length class, as short ones have low bounds.
CLASSES = (16, 32, 64, SEGMENT + STRIDE)
#: Slots of the first, inexact look-up.
FILTER_BITS = 21
#: Candidate regions aligned in one numpy step.
ALIGNED = 4096
#: Edits that a region pays for reaching into another text; beyond any budget.
WALL = 1000

_FOLD = np.full(256, 32, np.uint8)
_FOLD[48:58] = np.arange(48, 58)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def folded(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalised bytes of lower-cased texts, each between blanks and
    followed by a byte 0, and the offsets of the texts in them."""
    n = len(offs) - 1
    wide = np.zeros(len(data) + 3 * n, np.uint8)
    begin = offs + 3 * np.arange(n + 1)
    wide[np.arange(len(data)) + 1 + 3 * np.repeat(np.arange(n), np.diff(offs))] = _FOLD[data]
    wide[begin[:-1]] = wide[begin[1:] - 2] = 32
    keep = (wide != 32) | np.r_[True, wide[:-1] != 32]
    return wide[keep], np.r_[0, np.cumsum(keep)][begin]


def segments(text: bytes) -> list[bytes]:
    """Overlapping parts that a folded item is searched by."""
    if len(text) <= SEGMENT + STRIDE // 2:
        return [text] if len(text) >= Q else []
    starts = [*range(0, len(text) - SEGMENT, STRIDE), len(text) - SEGMENT]
    return [text[s: s + SEGMENT] for s in starts]


def budget(length: int) -> int:
    """Edits allowed; as many as leave the lemma a bound of 1."""
    return max(0, min(int(RATE * length), (length - Q) // Q))


def bound(length: int) -> int:
    return length - Q + 1 - Q * budget(length)


def _grams(data: np.ndarray) -> np.ndarray:
    return np.ndarray((len(data),), "<u8", np.r_[data, np.zeros(Q, np.uint8)].tobytes(), 0, (1,))


def _slot(grams: np.ndarray) -> np.ndarray:
    return (grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - FILTER_BITS)


class Index:
    """q-grams of the segments of one length class."""

    def __init__(self, parts: list[tuple[int, bytes]]):
        """parts: (item, segment)."""
        self.item = np.array([i for i, _ in parts], np.int64)
        self.length = np.array([len(s) for _, s in parts], np.int64)
        self.edits = np.array([budget(len(s)) for _, s in parts], np.int64)
        self.bound = np.array([bound(len(s)) for _, s in parts], np.int64)
        self.text = np.zeros((len(parts), int(self.length.max())), np.uint8)
        grams, where = [], []
        for k, (_, s) in enumerate(parts):
            raw = np.frombuffer(s, np.uint8)
            self.text[k, : len(s)] = raw
            grams.append(_grams(raw)[: len(s) - Q + 1])
            where.append(np.stack([np.full(len(s) - Q + 1, k), np.arange(len(s) - Q + 1)], 1))
        grams, where = np.concatenate(grams), np.concatenate(where)
        order = np.argsort(grams, kind="stable")
        self.segment, self.at = where[order].T
        self.keys, first = np.unique(grams[order], return_index=True)
        self.first = np.r_[first, len(grams)]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[_slot(self.keys)] = True
        self.span = int((self.length + self.edits).max())
        self.least = int(self.bound.min())

    def candidates(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(segment, first diagonal) of the bands that reach the bound; a band
        covers ``2 * (edits + 1)`` diagonals."""
        grams = _grams(data)
        maybe = self.filter[_slot(grams)]
        # a region within the budget has its hits within the longest span
        upto = np.r_[0, np.cumsum(maybe, dtype=np.int32)]
        ahead = upto[np.minimum(np.arange(len(data)) + self.span, len(data))] - upto[:-1]
        mark = np.zeros(len(data) + self.span + 1, np.int32)
        dense = np.flatnonzero(ahead >= self.least)
        np.add.at(mark, dense, 1)
        np.add.at(mark, dense + self.span, -1)
        pos = np.flatnonzero(maybe & (np.cumsum(mark)[: len(data)] > 0))
        key = np.searchsorted(self.keys, grams[pos])
        key[key == len(self.keys)] = 0
        true = self.keys[key] == grams[pos]
        pos, key = pos[true], key[true]
        n = self.first[key + 1] - self.first[key]
        entry = np.repeat(self.first[key] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum()) if len(n) else np.zeros(0, np.int64)
        seg = self.segment[entry]
        diagonal = np.repeat(pos, n) - self.at[entry] + SEGMENT + STRIDE  # never negative
        step = self.edits[seg] + 1
        band = diagonal // step
        width = len(data) + 2 * (SEGMENT + STRIDE)
        both = np.concatenate([seg * width + band, (seg * width + band - 1)[band > 0]])
        found, count = np.unique(both, return_counts=True)
        seg, band = found // width, found % width
        ok = count >= self.bound[seg]
        return seg[ok], (band * (self.edits[seg] + 1))[ok] - SEGMENT - STRIDE

    def align(self, data: np.ndarray, seg: np.ndarray, diagonal: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Least edits of the whole segment against any region on the band's
        diagonals, give or take the edits, and the region's start and end.  A
        region never holds the byte 0 that follows each text."""
        edits = int(self.edits[seg].max())
        width = 4 * (edits + 1)
        low = diagonal - edits - 1
        pad = np.zeros(len(data) + 2 * width + 4 * (SEGMENT + STRIDE), np.uint8)
        lead = width + SEGMENT + STRIDE
        pad[lead: lead + len(data)] = data
        k = np.arange(width)
        # edits times width, plus the columns from the region's start to the last: of equal edits the latest start wins
        cost = np.repeat((width - 1 - k).astype(np.int32)[None], len(seg), 0)
        best, start, end = np.full(len(seg), 10**6), np.zeros(len(seg), np.int64), np.zeros(len(seg), np.int64)
        for i in range(int(self.length[seg].max())):
            symbol = pad[lead + low[:, None] + i + k]
            wall = np.where(symbol == 0, np.int32(WALL * width), np.int32(0))
            new = cost + (symbol != self.text[seg, i][:, None]) * np.int32(width) + wall
            new[:, :-1] = np.minimum(new[:, :-1], cost[:, 1:] + width)
            into = np.cumsum(wall + np.int32(width), axis=1, dtype=np.int32)
            cost = np.minimum.accumulate(new - into, axis=1) + into
            done = self.length[seg] == i + 1
            if done.any():
                at = (cost[done] // width).argmin(1)
                value = cost[done, at]
                best[done], end[done] = value // width, low[done] + i + 1 + at
                start[done] = low[done] + width - 1 - value % width
        return best, start, end

    def hits(self, data: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(segment, edits, start, end) of regions in the folded texts."""
        seg, diagonal = self.candidates(data)
        out = []
        for at in range(0, len(seg), ALIGNED):
            s, d = seg[at: at + ALIGNED], diagonal[at: at + ALIGNED]
            edits, start, end = self.align(data, s, d)
            ok = edits <= self.edits[s]
            out += zip(s[ok].tolist(), edits[ok].tolist(), start[ok].tolist(), end[ok].tolist())
        return out


def build_indexes(items: list[tuple[int, str]]) -> list[Index]:
    by: dict[int, list[tuple[int, bytes]]] = {}
    for i, (_, text) in enumerate(items):
        raw = np.frombuffer((text or "").lower().encode(), np.uint8)
        body = folded(raw, np.array([0, len(raw)]))[0].tobytes().strip(b" \0")
        for s in segments(body):
            by.setdefault(int(np.searchsorted(CLASSES, len(s), "right")), []).append((i, s))
    return [Index(parts) for _, parts in sorted(by.items())]


def _search(items, indexes):
    """items, indexes: broadcasts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = items.value
        for rows, data, offs in passes(batches, "text"):
            text, begin = folded(data, offs)
            found: dict[tuple[int, int], list] = {}
            for c, index in enumerate(indexes.value):
                for seg, edits, start, end in index.hits(text):
                    doc = int(np.searchsorted(begin, start, "right")) - 1
                    key = (doc, int(index.item[seg]))
                    place = (start - int(begin[doc]), end - int(begin[doc]))
                    one = found.setdefault(key, [set(), edits, *place])
                    one[0].add((c, seg))
                    one[1:] = [min(one[1], edits), min(one[2], place[0]), max(one[3], place[1])]
            if found:
                pairs = sorted(found)
                docs = rows.column(0).take(pa.array([d for d, _ in pairs]))
                rest = [[found[p][0].__len__() for p in pairs], *[[found[p][j] for p in pairs] for j in (1, 2, 3)]]
                yield pa.RecordBatch.from_arrays(
                    [docs, pa.array([ids[i] for _, i in pairs], pa.int64()), *[pa.array(x, pa.int64()) for x in rest]],
                    ["doc_id", "item_id", "n_segments", "edits", "first_byte", "last_byte"],
                )

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """A row for each document and benchmark item found in it: doc_id,
    item_id, n_segments (of the item, found), edits (least of them),
    first_byte and last_byte (reach in the folded text)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.lower(text_of(text)).alias("text"))
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), text_of(item_text).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES) or 1
    schema = "doc_id long, item_id long, n_segments long, edits long, first_byte long, last_byte long"
    out = spark.createDataFrame([], schema)
    for b in range(blocks):
        # about BLOCK_BYTES of text, as items are dealt by hash
        block = [tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()]
        indexes = build_indexes(block)
        if indexes:
            shared = spark.sparkContext.broadcast([i for i, _ in block]), spark.sparkContext.broadcast(indexes)
            out = out.unionByName(rows.mapInArrow(_search(*shared), schema))
    return out
