"""Exact dedup: counting quotient filters select the texts to verify.

Each partition folds the 64-bit fingerprints of its texts into counting
quotient filters: a fingerprint is split into a quotient (the slot) and a
remainder, remainders of a slot are kept sorted, and each has a counter.
Filters of the same fingerprint range merge losslessly, two of about equal
size at a time, by merging their sorted remainders and adding the counters.  Fingerprints whose merged count
exceeds one go on to byte verification, which groups the whole normalised
texts; all other documents are unique without a look at their bytes.

Cases: a null text counts as empty; a null doc_id never wins against
another id (it is the keeper only if the whole group has none); rows that repeat a
doc_id are one document and are kept or dropped together, each counting in
``group_size``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import column, partitions, small_side, text_of, written

#: Bits of the quotient inside one filter.
QUOTIENT_BITS = 16
#: Fingerprints that a partition holds before it emits its filters.
FLUSH = 1 << 20


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(text_of(text), r"[\x20\x09-\x0D]+", " ")


class QuotientFilter:
    """Counting quotient filter over fingerprints of one range.

    ``runs[s]`` is the number of remainders of slot ``s``; ``remainders``
    holds the runs one after the other, each sorted; ``counts`` goes with it.
    """

    def __init__(self, runs: np.ndarray, remainders: np.ndarray, counts: np.ndarray, bits: int):
        self.runs, self.remainders, self.counts, self.bits = runs, remainders, counts, bits

    @classmethod
    def build(cls, fps: np.ndarray, counts: np.ndarray, skip: int, quotient: int = QUOTIENT_BITS) -> QuotientFilter:
        """``fps`` share their top ``skip`` bits; equal ones are counted up."""
        bits = 64 - skip - quotient
        order = np.argsort(fps, kind="stable")
        fps, counts = fps[order], counts[order]
        first = np.flatnonzero(np.r_[True, fps[1:] != fps[:-1]]) if len(fps) else np.zeros(0, np.int64)
        counts = np.add.reduceat(counts, first) if len(first) else counts
        fps = fps[first]
        slots = ((fps >> np.uint64(bits)) & np.uint64((1 << quotient) - 1)).astype(np.int64)
        return cls(np.bincount(slots, minlength=1 << quotient).astype(np.uint32), fps & np.uint64((1 << bits) - 1), counts, bits)

    def fingerprints(self, high: int, skip: int) -> np.ndarray:
        slots = np.repeat(np.arange(len(self.runs), dtype=np.uint64), self.runs)
        top = np.uint64((high << (64 - skip)) & (2**64 - 1) if skip else 0)
        return top | (slots << np.uint64(self.bits)) | self.remainders

    def merge(self, other: QuotientFilter) -> QuotientFilter:
        """Slot by slot, the sorted remainders of both; equal ones add up."""
        n = len(self.runs)
        slots = np.r_[np.repeat(np.arange(n), self.runs), np.repeat(np.arange(n), other.runs)]
        rem, cnt = np.r_[self.remainders, other.remainders], np.r_[self.counts, other.counts]
        order = np.lexsort((rem, slots))
        slots, rem, cnt = slots[order], rem[order], cnt[order]
        first = np.flatnonzero(np.r_[True, (rem[1:] != rem[:-1]) | (slots[1:] != slots[:-1])]) if len(rem) else np.zeros(0, np.int64)
        cnt = np.add.reduceat(cnt, first) if len(first) else cnt
        return QuotientFilter(np.bincount(slots[first], minlength=n).astype(np.uint32), rem[first], cnt, self.bits)

    def pack(self) -> bytes:
        used = np.flatnonzero(self.runs).astype(np.uint32)
        head = np.array([len(self.runs), self.bits, len(used), len(self.remainders)], np.int64)
        return b"".join(x.tobytes() for x in (head, used, self.runs[used], self.remainders, self.counts.astype(np.int64)))

    @classmethod
    def unpack(cls, raw: bytes) -> QuotientFilter:
        slots, bits, used, n = np.frombuffer(raw, np.int64, 4).tolist()
        at = 32
        where = np.frombuffer(raw, np.uint32, used, at)
        runs = np.zeros(slots, np.uint32)
        runs[where] = np.frombuffer(raw, np.uint32, used, at + 4 * used)
        at += 8 * used
        return cls(runs, np.frombuffer(raw, np.uint64, n, at), np.frombuffer(raw, np.int64, n, at + 8 * n), bits)


def _partition_filters(range_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(held):
            fps = np.concatenate(held).view(np.uint64)
            ranges = (fps >> np.uint64(64 - range_bits)).astype(np.int64)
            order = np.argsort(ranges, kind="stable")
            fps, ranges = fps[order], ranges[order]
            keys, starts = np.unique(ranges, return_index=True)
            parts = [QuotientFilter.build(x, np.ones(len(x), np.int64), range_bits).pack() for x in np.split(fps, starts[1:])]
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(parts, pa.binary())], ["fp_range", "filter"])

        held, n = [], 0
        for b in batches:
            held.append(column(b, "fp").astype(np.int64))
            n += len(held[-1])
            if n >= FLUSH:
                yield emit(held)
                held, n = [], 0
        if n:
            yield emit(held)

    return run


def _merged(range_bits: int):
    def run(key, rows):
        held: list[tuple[int, QuotientFilter]] = []  # filters and how many went into each, fewer to the right
        for raw in rows["filter"]:
            n, one = 1, QuotientFilter.unpack(raw.as_py())
            while held and held[-1][0] <= n:
                more, other = held.pop()
                n, one = n + more, other.merge(one)
            held.append((n, one))
        total = reduce(lambda a, b: b.merge(a), [one for _, one in reversed(held)])
        many = total.counts > 1
        fps = total.fingerprints(int(key[0].as_py()), range_bits)[many]
        return pa.table({"fp": pa.array(fps.view(np.int64), pa.int64()), "n": pa.array(total.counts[many], pa.int64())})

    return run


def repeated_fingerprints(fps: DataFrame) -> DataFrame:
    """(fp, n) of the fingerprints that occur more than once in column ``fp``."""
    bits = max(4, (partitions(fps.sparkSession) - 1).bit_length())
    filters = fps.select("fp").mapInArrow(_partition_filters(bits), "fp_range long, filter binary")
    return filters.groupBy("fp_range").applyInArrow(_merged(bits), "fp long, n long")


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), normalised(text).alias("norm")).withColumn("fp", F.xxhash64("norm"))
    slim = written(base.select("doc_id", "fp", F.unhex(F.sha2("norm", 256)).alias("sha")))
    many = written(repeated_fingerprints(slim).select("fp"))
    suspects = base.join(small_side(many), "fp", "left_semi")
    groups = (
        suspects.groupBy("norm")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"), F.first("fp").alias("fp"))
        .where(F.col("group_size") > 1)
        .select("fp", F.unhex(F.sha2("norm", 256)).alias("sha"), "keep_id", "group_size", F.lit(True).alias("copy"))
    )
    rows = slim.join(groups, ["fp", "sha"], "left")
    keep = F.when(F.col("copy"), F.col("keep_id")).otherwise(F.col("doc_id"))
    return rows.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm)
"""
