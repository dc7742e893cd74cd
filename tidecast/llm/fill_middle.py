"""Fill-in-the-middle transformation with Fenwick-tree cuts.

A text is a row of units (lines or code points).  Two cuts drawn from the
hash of its id split it into prefix, middle and suffix, which are written in
the order that the form asks for, each behind its sentinel.

The text's UTF-8 bytes are divided into blocks of ``BLOCK`` bytes.  A Fenwick
tree over the blocks holds the numbers of unit ends and of code points.  A
cut after ``k`` units is found by binary lifting: the descent stops at the
block that holds the k-th unit end, and only that block is searched for it.
Code points before the cut are the tree's prefix sum and a count within the
block.  Bytes are never decoded, so the cost of a text is one pass over it.

Cases: a null text counts as empty; an empty text, and one that contains a
sentinel, is plain (output equal to the text, no prefix or middle); both cuts
may fall together, before the first or after the last unit, which leaves
parts empty; a null id is hashed as an empty decimal; repeated rows are
transformed alike and returned as often as they occur; texts of any length
(up to Arrow's 2 GB for a value) are cut whole; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import passes, text_of

#: Bytes of a leaf of the tree.
BLOCK = 4096
#: Sentinels before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINELS = tuple(s.encode() for s in (PREFIX, SUFFIX, MIDDLE))
UNITS = ("line", "char")
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def unit_ends(data: np.ndarray, unit: str) -> np.ndarray:
    """True at the last byte of every unit; the last byte of a text ends one."""
    if unit == "line":
        ends = data == 0x0A
    else:
        ends = np.ones(len(data), bool)
        ends[:-1] = (data[1:] & 0xC0) != 0x80
    if len(data):
        ends[-1] = True
    return ends


class BlockTree:
    """Fenwick tree of (unit ends, code points) over a text's blocks."""

    def __init__(self, data: np.ndarray, unit: str):
        self.ends = unit_ends(data, unit)
        self.heads = (data & 0xC0) != 0x80  # first bytes of code points
        starts = np.arange(0, len(data), BLOCK)
        self.blocks = len(starts)
        self.tree = np.zeros((self.blocks + 1, 2), np.int64)
        if self.blocks:
            self.tree[1:, 0] = np.add.reduceat(self.ends, starts, dtype=np.int64)
            self.tree[1:, 1] = np.add.reduceat(self.heads, starts, dtype=np.int64)
        self.units = int(self.tree[:, 0].sum())
        # node i covers the blocks (i - lowbit(i), i]: each width is filled from the one before
        step = 1
        while step <= self.blocks // 2:
            nodes = np.arange(2 * step, self.blocks + 1, 2 * step)
            self.tree[nodes] += self.tree[nodes - step]
            step *= 2

    def cut(self, k: int) -> tuple[int, int]:
        """(bytes, code points) before the cut after ``k`` units."""
        if not k:
            return 0, 0
        at, units, chars = 0, 0, 0
        step = 1 << self.blocks.bit_length()
        while step:  # descend to the last block boundary with fewer than k units before it
            to = at + step
            if to <= self.blocks and units + self.tree[to, 0] < k:
                at, units, chars = to, units + int(self.tree[to, 0]), chars + int(self.tree[to, 1])
            step >>= 1
        first = at * BLOCK
        inside = np.flatnonzero(self.ends[first: first + BLOCK])
        end = first + int(inside[k - units - 1]) + 1
        return end, chars + int(np.count_nonzero(self.heads[first:end]))


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """Four unsigned 32-bit numbers from the hash of seed and id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i: i + 4], "big") for i in (0, 4, 8, 12))


def transform(data: np.ndarray, doc_id: int | None, unit: str, seed: int, rate: int, spm: int) -> tuple:
    """(n, form, prefix_chars, middle_chars, output bytes) of one text."""
    tree, raw = BlockTree(data, unit), data.tobytes()
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not raw or h3 % 100 >= rate or any(s in raw for s in SENTINELS):
        return tree.units, "plain", None, None, raw
    a, b = sorted((h1 % (tree.units + 1), h2 % (tree.units + 1)))
    (i, before), (j, upto) = tree.cut(a), tree.cut(b)
    p, s, m = SENTINELS
    if h4 % 100 < spm:
        form, out = "spm", b"".join((s, raw[j:], p, raw[:i], m, raw[i:j]))
    else:
        form, out = "psm", b"".join((p, raw[:i], s, raw[j:], m, raw[i:j]))
    return tree.units, form, before, upto - before, out


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", unit: str = "line", seed: int = 7, rate: int = 100, spm: int = 50) -> DataFrame:
    """One row per document: doc_id, n (units), form (plain, psm or spm),
    prefix_chars, middle_chars, output.  ``rate`` percent of the texts are
    transformed, ``spm`` percent of these with the suffix first."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}: {unit}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offs in passes(batches, "text"):
            ids = rows.column(0).to_pylist()
            done = [transform(data[a:b], i, unit, seed, rate, spm) for i, a, b in zip(ids, offs[:-1].tolist(), offs[1:].tolist())]
            n, form, prefix, middle, out = zip(*done)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(out, pa.binary()).cast(pa.string(), safe=False)],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def restored(form: str = "form", output: str = "output") -> Column:
    """The exact text, rebuilt from output and form.  No part holds a
    sentinel, and none can arise where a part meets one: a sentinel has
    its only ``<`` first and its only ``>`` last."""
    out = F.col(output)

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        rest = F.substring_index(out, second, -1)
        head = F.substring(F.substring_index(out, second, 1), len(first) + 1, 2**31 - 1)
        return head, F.substring_index(rest, MIDDLE, 1), F.substring_index(rest, MIDDLE, -1)

    prefix, suffix, middle = parts(PREFIX, SUFFIX)
    suffix_first, prefix_second, middle_last = parts(SUFFIX, PREFIX)
    return (
        F.when(F.col(form) == "psm", F.concat(prefix, middle, suffix))
        .when(F.col(form) == "spm", F.concat(prefix_second, middle_last, suffix_first))
        .otherwise(out)
    )
