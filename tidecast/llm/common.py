"""Shared helpers of the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.session import ensure_checkpoint_dir

#: Rows of two longs that a broadcast may hold (64 MB); larger sides are joined by shuffle.
BROADCAST_ROWS = 4_000_000
#: Bytes of text that one numpy pass works on; longer single texts form a pass of their own.
PASS_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts
    the lineage, and a lost executor costs no more than a reread."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (already written) with a broadcast hint where its counted rows
    stay within the bound; unhinted, and so joined by shuffle, beyond it."""
    return F.broadcast(df) if df.count() <= rows else df


def passes(batches: Iterator[pa.RecordBatch], text: str, limit: int = PASS_BYTES) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Arrow batches cut into runs of rows with about ``limit`` bytes of text:
    (rows, bytes of all texts, offsets).  Rows are never split or dropped."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text))
        if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type):
            kind = np.int64
        else:
            kind = np.int32
        if not len(col):
            continue
        offs = np.frombuffer(col.buffers()[1], kind)[col.offset: col.offset + len(col) + 1].astype(np.int64)
        data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
        start = 0
        while start < len(col):
            end = int(np.searchsorted(offs, offs[start] + limit, "right")) - 1
            end = min(max(end, start + 1), len(col))
            own = offs[start: end + 1]
            yield batch.slice(start, end - start), data[own[0]: own[-1]], own - own[0]
            start = end


def column(batch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)
