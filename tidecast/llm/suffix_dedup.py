"""Suffix-array dedup of repeated byte strings across documents.

Removes every byte covered by a string of ``LENGTH`` bytes that also starts
in a document with a smaller doc_id.  No suffix array of a whole corpus fits
one machine, so equal strings are first brought together:

1. Each string of ``LENGTH`` bytes has an anchor, its gram of ``GRAM`` bytes with the least
   hash.  Equal strings have equal anchors, and neighbouring strings share
   theirs, so a text has about one anchor in 16 bytes.  Documents go in chunks
   (by hash of their id); a chunk sends the hashes of its anchors, and an
   anchor that occurs in several of its documents only once, with its number.
2. Anchors found in more than one document go back to their chunks, which
   cut out the strings around them: a segment of at most
   ``2 * LENGTH - GRAM`` bytes, sent to the place of its anchor.  Of equal segments in a chunk
   only that of the smallest doc_id is sent; the others are repeats.
3. The strings of a place form a suffix array: bottom-up mergesort, where
   two suffixes are compared by their longest common extension, found by
   binary search over prefix polynomial hashes.  Strings that the hashes
   call equal are verified byte by byte; on a collision the place is sorted
   again with another base.  Strings equal to one of a smaller doc_id are repeats.
4. Chunks gather the spans of their documents and take them out.

A document whose whole text stands in one with a smaller doc_id repeats as
a whole and takes no part in 1 to 3.  An anchor that occurs more than ``hot``
times could fill a task with segments that all differ around it, so each
string around it goes to a place of its own instead.  The bound does not depend on
the input, and each chunk learns of the hot anchors that it holds in the same way as of
the shared ones.  Occurrences are counted by document, and in full within a document
that has over ``FEW`` of them.

Cases: null texts count as empty; a row with a null doc_id keeps its text
and takes none from others; rows that share a doc_id are one document, take
nothing from each other, and each gets its own result row; texts shorter
than ``LENGTH`` bytes keep all; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import partitions, text_of, written

LENGTH, GRAM = 50, 20
#: Bytes of text in a chunk of documents, on average.
CHUNK_BYTES = 2 << 20
#: Bytes of text for each partition that anchors and segments are dealt to, at most.
PLACE_BYTES = 32 << 20
#: Segments sorted together.
SORTED = 20_000
#: Occurrences from which an anchor is hot; those in one document that count as one.
HOT, FEW = 20_000, 3
MIX = np.uint64(0x9E3779B97F4A7C15)
LOW48 = np.uint64((1 << 48) - 1)


def _eights(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on, as a number; zeros follow the data."""
    raw = np.concatenate([data, np.zeros(LENGTH + 8, np.uint8)])
    return np.ndarray((len(raw) - 7,), "<u8", raw.tobytes(), 0, (1,))


def anchors(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all strings of LENGTH bytes within one text: the runs of starts with
    the same anchor.  (text, hash, position of the anchor, first and last start)."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none.astype(np.uint64), none, none, none
    v = _eights(data)
    h = v[:n] * MIX
    h ^= h >> np.uint64(32)
    h = (h + v[8: n + 8]) * MIX
    h ^= h >> np.uint64(29)
    h = (h + v[GRAM - 8: n + GRAM - 8]) * MIX
    h ^= h >> np.uint64(32)
    least = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)  # of equal hashes the leftmost
    width, w = 1, LENGTH - GRAM + 1
    while 2 * width <= w:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < w:
        least = np.minimum(least[: len(least) - (w - width)], least[w - width:])
    start = np.flatnonzero((np.repeat(offs[1:], np.diff(offs)) - np.arange(n))[: n - LENGTH + 1] >= LENGTH)
    at = (least[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else none
    last = np.r_[first[1:], len(at)] - 1 if len(at) else none
    at = at[first]
    return np.searchsorted(offs, at, "right") - 1, h[at], at, start[first], start[last]


class Hashes:
    """Polynomial hashes of all substrings, modulo 2^64."""

    def __init__(self, body: np.ndarray, base: int):
        up = np.full(len(body) + 1, base | 1, np.uint64)
        down = np.full(len(body) + 1, pow(base | 1, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        self.down = np.cumprod(down)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((body.astype(np.uint64) + np.uint64(1)) * np.cumprod(up)[:-1])])

    def of(self, at: np.ndarray, n) -> np.ndarray:
        return (self.sums[at + n] - self.sums[at]) * self.down[at]

    def common(self, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
        """Longest common extension of two suffixes, up to ``limit``."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), limit)
        while (low < high).any():
            mid = (low + high + 1) >> 1
            same = self.of(a, mid) == self.of(b, mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low


def suffix_sort(body: np.ndarray, start: np.ndarray, group: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``body`` in order of their group and first LENGTH bytes:
    (order, whether each has the same group and bytes as the one before it)."""
    hashes = Hashes(body, base)
    order = np.argsort(group, kind="stable")
    at, group = start[order], group[order]
    whole = hashes.of(at, LENGTH)
    head = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[head, len(at)])
    within = np.arange(len(at)) - np.repeat(head, size)
    size = np.repeat(size, size)

    def not_above(a, b):  # the suffix at place a is not above that at place b
        out = whole[a] == whole[b]
        differ = np.flatnonzero(~out)
        x, y = at[a[differ]], at[b[differ]]
        n = hashes.common(x, y, LENGTH - 1)
        out[differ] = body[x + n] <= body[y + n]
        return out

    width = 1
    while len(size) and width < size.max():
        part = within % (2 * width)
        paired = (within - part + width) < size  # a right run follows
        right = np.flatnonzero(paired & (part >= width))
        left = np.flatnonzero(paired & (part < width))
        begin = right - part[right]
        low, high = np.zeros(len(right), np.int64), np.full(len(right), width)
        open_ = np.arange(len(right))
        while len(open_):
            mid = (low[open_] + high[open_]) >> 1
            ok = not_above(begin[open_] + mid, right[open_])
            low[open_[ok]], high[open_[~ok]] = mid[ok] + 1, mid[~ok]
            open_ = open_[low[open_] < high[open_]]
        to = right - width + low
        free = paired.copy()
        free[to] = False
        free = np.flatnonzero(free)
        for x in (at, whole, order):
            a, b = x[right], x[left]
            x[to], x[free] = a, b
        width *= 2
    same = np.r_[False, (group[1:] == group[:-1]) & (whole[1:] == whole[:-1])] if len(at) else np.zeros(0, bool)
    # verify what the hashes call equal
    v, pairs = _eights(body), np.flatnonzero(same)
    for step in (*range(0, LENGTH - 8, 8), LENGTH - 8):
        if (v[at[pairs] + step] != v[at[pairs - 1] + step]).any():
            given = np.empty_like(group)
            given[order] = group
            return suffix_sort(body, start, given, (base * 6364136223846793005 + 1442695040888963407) % (1 << 64))
    return order, same


def repeats(body: np.ndarray, first: np.ndarray, size: np.ndarray, place: np.ndarray, shift: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Segments ``body[first: first + size]``: for each string in them, in
    order, whether an equal one at the same place belongs to a smaller doc."""
    n = size - LENGTH + 1
    row = np.repeat(np.arange(len(first)), n)
    i = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    _, place = np.unique(place, return_inverse=True)
    # strings can only be equal if they lie alike around the anchor
    order, same = suffix_sort(body, first[row] + i, place[row] * 64 + shift[row] + i, 0x5DEECE66D)
    head = np.flatnonzero(~same)
    least = np.minimum.reduceat(doc[row][order], head) if len(head) else np.zeros(0, np.int64)
    out = np.empty(len(row), bool)
    out[order] = doc[row][order] > np.repeat(least, np.diff(np.r_[head, len(order)]))
    return out


# --- chunks -------------------------------------------------------------------

def _texts(t: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]:
    """Documents of a chunk in a fixed order: (rows, bytes, offsets, doc_id)."""
    t = t.sort_by([("doc_id", "ascending"), ("tag", "ascending")]).combine_chunks()
    text = t["text"].combine_chunks() if isinstance(t["text"], pa.ChunkedArray) else t["text"]
    lengths = pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
    raw = b"".join(x.as_buffer() for x in text) if len(text) else b""
    return t, np.frombuffer(raw, np.uint8), np.r_[0, np.cumsum(lengths)], t["doc_id"].fill_null(0).to_numpy()


def _whole_copies(t: pa.Table, copies: pa.Table) -> np.ndarray:
    """Rows of ``t`` whose text stands in a document with a smaller doc_id."""
    known = set(zip(copies["doc_id"].to_pylist(), copies["tag"].to_pylist()))
    if not known:
        return np.zeros(t.num_rows, bool)
    return np.array([x in known for x in zip(t["doc_id"].to_pylist(), t["tag"].to_pylist())], bool)


def _split(h48: np.ndarray) -> tuple[bytes, bytes]:
    return (h48 >> np.uint64(16)).astype(np.uint32).tobytes(), h48.astype(np.uint16).tobytes()


def _joined(high: bytes, low: bytes) -> np.ndarray:
    return (np.frombuffer(high, np.uint32).astype(np.uint64) << np.uint64(16)) | np.frombuffer(low, np.uint16)


SOLO, SEVERAL, KNOWN, OFTEN = 0, 1, 2, 3
ANCHOR_ROWS = "place int, chunk int, kind int, high binary, low binary, ref binary"


def _send_anchors(places: int):
    def run(docs: pa.Table, copies: pa.Table) -> pa.Table:
        chunk = docs["chunk"][0].as_py() if docs.num_rows else 0
        t, data, offs, _ = _texts(docs)
        out: list[tuple] = []
        if t.num_rows:
            idle = _whole_copies(t, copies) | t["doc_id"].is_null().to_numpy()
            doc, h, *_ = anchors(data, offs)
            h, doc = (h & LOW48)[~idle[doc]], doc[~idle[doc]]
            order = np.lexsort((doc, h))
            h, doc = h[order], doc[order]
            times = np.diff(np.r_[np.flatnonzero(np.r_[True, h[1:] != h[:-1]]), len(h)]) if len(h) else np.zeros(0, np.int64)
            fresh = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])] if len(h) else np.zeros(0, bool)
            h, doc = h[fresh], doc[fresh]
            head = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
            count = np.diff(np.r_[head, len(h)])
            many = np.repeat(count > 1, count)
            if many.any():
                out.append((chunk % places, chunk, KNOWN, *_split(h[many]), doc[many].astype(np.uint32).tobytes()))
            often = (count == 1) & (times > FEW)
            for kind, hs, ref in ((SOLO, h[~many], doc[~many]), (SEVERAL, h[head[count > 1]], times[count > 1]), (OFTEN, h[head[often]], times[often] - 1)):
                place = (hs % np.uint64(places)).astype(np.int64)
                order = np.argsort(place, kind="stable")
                hs, ref, place = hs[order], ref[order].astype(np.uint32), place[order]
                keys, starts = np.unique(place, return_index=True)
                for k, a, b in zip(keys.tolist(), starts, np.r_[starts[1:], len(place)]):
                    r = ref[a:b].astype(np.uint16) if ref[a:b].max() < 65536 else ref[a:b]
                    out.append((k, chunk, kind, *_split(hs[a:b]), r.tobytes()))
        return _table(out, ANCHOR_ROWS)

    return run


_ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}


def _table(rows: list[tuple], schema: str) -> pa.Table:
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [[]] * len(fields)
    return pa.table([pa.array(c, _ARROW[kind]) for c, (_, kind) in zip(columns, fields)], names=[n for n, _ in fields])


def _refs(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, np.uint16 if len(raw) == 2 * n else np.uint32).astype(np.int64)


FOUND_ROWS = "chunk int, kind int, high binary, low binary, ref binary"


def _shared_anchors(hot: int):
    """All anchors of a place: those of more than one document, and of these
    the hot ones, for each chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, chunk, ref, kinds = [], [], [], []
        for b in batches:
            known = b.filter(pc.equal(b.column(2), KNOWN))
            if known.num_rows:
                yield known.drop_columns(["place"])
            for _, c, kind, high, low, r in zip(*[x.to_pylist() for x in b.columns]):
                if kind != KNOWN:
                    h.append(_joined(high, low))
                    ref.append(_refs(r, len(h[-1])))
                    chunk.append(np.full(len(h[-1]), c))
                    kinds.append(np.full(len(h[-1]), kind))
        if not h:
            return
        h, chunk, ref, kinds = map(np.concatenate, (h, chunk, ref, kinds))
        order = np.argsort(h, kind="stable")
        h, chunk, ref, kinds = h[order], chunk[order], ref[order], kinds[order]
        head = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        size = np.diff(np.r_[head, len(h)])
        chunks = np.repeat(np.add.reduceat((kinds != OFTEN).astype(np.int64), head), size)
        times = np.repeat(np.add.reduceat(np.where(kinds == SOLO, 1, ref), head), size)
        shared = (chunks > 1) | (kinds == SEVERAL)
        rows = []
        for kind, own in ((SOLO, (kinds == SOLO) & shared), (OFTEN, (kinds != OFTEN) & shared & (times > hot))):
            own = np.flatnonzero(own)
            own = own[np.argsort(chunk[own], kind="stable")]
            keys, starts = np.unique(chunk[own], return_index=True)
            for c, x in zip(keys.tolist(), np.split(own, starts[1:])):
                rows.append((c, kind, *_split(h[x]), ref[x].astype(np.uint32).tobytes() if kind == SOLO else b""))
        if rows:
            yield _table(rows, FOUND_ROWS).to_batches()[0]

    return run


SEGMENT_ROWS = "place int, chunk int, anchor binary, doc binary, ref binary, start binary, stop binary, shift binary, size binary, body binary"


def _send_segments(places: int):
    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        hot, found = (found.filter(op(found["kind"], OFTEN)) for op in (pc.equal, pc.not_equal))
        if not docs.num_rows or not found.num_rows:
            return _table([], SEGMENT_ROWS)
        chunk = docs["chunk"][0].as_py()
        t, data, offs, ids = _texts(docs)
        doc, h, at, lo, hi = anchors(data, offs)
        known_h = np.concatenate([_joined(a, b) for a, b in zip(found["high"].to_pylist(), found["low"].to_pylist())])
        known_d = np.concatenate([np.frombuffer(r, np.uint32) for r in found["ref"].to_pylist()])
        wanted = np.isin((h & LOW48) ^ (doc.astype(np.uint64) << np.uint64(48)), known_h ^ (known_d.astype(np.uint64) << np.uint64(48)))
        doc, h, at, lo, hi = doc[wanted], h[wanted], at[wanted], lo[wanted], hi[wanted]
        hashes = Hashes(data, 0x2545F4914F6CDD1D)
        shift = lo - at + LENGTH - GRAM
        hot = [_joined(a, b) for a, b in zip(hot["high"].to_pylist(), hot["low"].to_pylist())]
        single = np.isin(h & LOW48, np.concatenate(hot)) if hot else np.zeros(len(h), bool)
        if single.any():  # a place for each string around a frequent anchor
            n = (hi - lo + 1)[single]
            each = np.repeat(lo[single], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            doc, h = np.r_[doc[~single], np.repeat(doc[single], n)], np.r_[h[~single], hashes.of(each, LENGTH)]
            lo, hi, shift = np.r_[lo[~single], each], np.r_[hi[~single], each], np.r_[shift[~single], np.zeros(len(each), np.int64)]
        size = hi - lo + LENGTH
        # equal segments: all but those of the smallest doc_id are repeats here already
        key = (hashes.of(lo, size) + shift.astype(np.uint64)) * MIX ^ h ^ size.astype(np.uint64)
        order = np.lexsort((ids[doc], key))
        head = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]]) if len(order) else np.zeros(0, np.int64)
        model = np.empty(len(order), np.int64)
        model[order] = np.repeat(order[head], np.diff(np.r_[head, len(order)]))
        later = ids[doc] > ids[doc[model]]
        later &= (size == size[model]) & (shift == shift[model]) & (h == h[model]) & _equal(data, lo, lo[model], size)
        out = []
        if later.any():
            gone = [x.astype(np.uint32).tobytes() for x in (doc[later], (lo - offs[doc])[later], (hi + LENGTH - offs[doc])[later])]
            out.append((chunk % places, chunk, b"", b"", *gone, b"", b"", b""))
        left = np.flatnonzero(~later)
        place = (h[left] % np.uint64(places)).astype(np.int64)
        left = left[np.argsort(place, kind="stable")]
        keys, starts = np.unique(np.sort(place), return_index=True)
        for k, a, b in zip(keys.tolist(), starts, np.r_[starts[1:], len(left)]):
            own = left[a:b]
            body = data[np.repeat(lo[own] - np.r_[0, np.cumsum(size[own])[:-1]], size[own]) + np.arange(size[own].sum())]
            out.append((
                k, chunk, h[own].tobytes(), ids[doc[own]].tobytes(), doc[own].astype(np.uint32).tobytes(),
                (lo - offs[doc])[own].astype(np.uint32).tobytes(), b"", shift[own].astype(np.uint8).tobytes(), size[own].astype(np.uint8).tobytes(), body.tobytes(),
            ))
        return _table(out, SEGMENT_ROWS)

    return run


def _equal(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    v, out = _eights(data), np.ones(len(a), bool)
    for step in range(0, 2 * LENGTH - GRAM, 8):
        # the last 8 bytes of a segment are compared last, whatever its size
        s = np.minimum(step, size - 8)
        out &= v[a + s] == v[b + s]
    return out


SPAN_ROWS = "chunk int, ref binary, start binary, stop binary"


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of a place to the spans that repeat, for each chunk."""
    found, parts = [], []
    for b in batches:
        for _, chunk, anchor, doc, ref, start, stop, shift, size, body in zip(*[x.to_pylist() for x in b.columns]):
            u32 = [np.frombuffer(x, np.uint32).astype(np.int64) for x in (ref, start, stop)]
            if stop:
                found.append((np.full(len(u32[0]), chunk), *u32))
                continue
            parts.append((
                np.frombuffer(anchor, np.uint64), np.frombuffer(doc, np.int64), np.full(len(u32[0]), chunk), u32[0], u32[1],
                np.frombuffer(shift, np.uint8).astype(np.int64), np.frombuffer(size, np.uint8).astype(np.int64), np.frombuffer(body, np.uint8),
            ))
    if parts:
        anchor, doc, chunk, ref, start, shift, size, body = map(np.concatenate, zip(*parts))
        parts.clear()
        first = np.cumsum(size) - size
        order = np.argsort(anchor, kind="stable")
        cut = np.flatnonzero(np.r_[True, anchor[order][1:] != anchor[order][:-1]])
        # whole anchors, SORTED segments at a time
        cut = np.r_[cut[np.r_[True, cut[1:] // SORTED != cut[:-1] // SORTED]], len(order)]
        for a, b in zip(cut[:-1], cut[1:]):
            own = order[a:b]
            n = size[own]
            text = body[np.repeat(first[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            gone = repeats(text, np.cumsum(n) - n, n, anchor[own], shift[own], doc[own])
            n = n - LENGTH + 1
            row = np.repeat(own, n)
            i = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            last = np.r_[row[1:] != row[:-1], True]
            begin = gone & (np.r_[True, last[:-1]] | ~np.r_[False, gone[:-1]])
            end = gone & (last | ~np.r_[gone[1:], False])
            begin, end = np.flatnonzero(begin), np.flatnonzero(end)
            r = row[begin]
            found.append((chunk[r], ref[r], start[r] + i[begin], start[r] + i[end] + LENGTH))
    if found:
        chunk, ref, start, stop = map(np.concatenate, zip(*found))
        order = np.argsort(chunk, kind="stable")
        keys, starts = np.unique(chunk[order], return_index=True)
        rows = []
        for k, a, b in zip(keys.tolist(), starts, np.r_[starts[1:], len(order)]):
            rows.append((k, *[x[order[a:b]].astype(np.uint32).tobytes() for x in (ref, start, stop)]))
        if rows:
            yield _table(rows, SPAN_ROWS).to_batches()[0]


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _take_out(docs: pa.Table, marks: pa.Table) -> pa.Table:
    """The documents of a chunk without their repeated spans."""
    if not docs.num_rows:
        return _table([], RESULT)
    t, data, offs, _ = _texts(docs)
    n = np.diff(offs)
    whole = _whole_copies(t, marks.filter(marks["ref"].is_null())) & (n >= LENGTH)
    marks = marks.filter(marks["ref"].is_valid())
    step = np.zeros(len(data) + 1, np.int32)
    for ref, start, stop in zip(*[marks[c].to_pylist() for c in ("ref", "start", "stop")]):
        base = offs[np.frombuffer(ref, np.uint32)]
        np.add.at(step, base + np.frombuffer(start, np.uint32), 1)
        np.add.at(step, base + np.frombuffer(stop, np.uint32), -1)
    gone = (np.cumsum(step)[:-1] > 0) | np.repeat(whole, n)
    edge = gone & ~np.r_[False, gone[:-1]]
    edge[offs[:-1][n > 0]] |= gone[offs[:-1][n > 0]]
    removed, spans = (np.r_[0, np.cumsum(x)] for x in (gone, edge))
    kept = [hashlib.sha256(data[a:b][~gone[a:b]].tobytes()).hexdigest() for a, b in zip(offs[:-1], offs[1:])]
    return pa.table([
        t["doc_id"], pa.array(n, pa.int64()), pa.array(removed[offs[1:]] - removed[offs[:-1]], pa.int64()),
        pa.array(spans[offs[1:]] - spans[offs[:-1]], pa.int64()), pa.array(kept, pa.string()),
    ], names=[f.split()[0] for f in RESULT.split(", ")])


def suffix_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", hot: int | None = None) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    spark = docs.sparkSession
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text")).withColumn("tag", F.xxhash64("text"))
    slim = written(base.select("doc_id", "tag", F.unhex(F.sha2("text", 256)).alias("sha"), F.octet_length("text").alias("n")))
    total = slim.agg(F.sum("n")).first()[0] or 0
    chunks, places = max(1, total // CHUNK_BYTES), max(partitions(spark), total // PLACE_BYTES)
    chunk = F.pmod(F.xxhash64(F.coalesce("doc_id", "tag")), F.lit(chunks)).cast("int").alias("chunk")
    texts = base.select(chunk, "doc_id", "tag", "text")
    least = slim.where("doc_id is not null").groupBy("sha").agg(F.min("doc_id").alias("least"))
    copies = written(slim.join(least, "sha").where("doc_id > least").select(chunk, "doc_id", "tag").distinct())
    together = texts.groupBy("chunk")

    sent = together.cogroup(copies.groupBy("chunk")).applyInArrow(_send_anchors(places), ANCHOR_ROWS)
    found = sent.repartitionById(places, F.col("place")).mapInArrow(_shared_anchors(HOT if hot is None else hot), FOUND_ROWS)
    segments = together.cogroup(found.groupBy("chunk")).applyInArrow(_send_segments(places), SEGMENT_ROWS)
    spans = segments.repartitionById(places, F.col("place")).mapInArrow(_spans, SPAN_ROWS)
    none = F.lit(None)
    marks = spans.select("*", none.cast("long").alias("doc_id"), none.cast("long").alias("tag")).unionByName(
        copies.select("chunk", *[none.cast("binary").alias(c) for c in ("ref", "start", "stop")], "doc_id", "tag")
    )
    return together.cogroup(marks.groupBy("chunk")).applyInArrow(_take_out, RESULT)
