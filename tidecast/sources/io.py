"""File sinks and scans.

Feature sets and predictions are Parquet datasets partitioned by their
selector columns, so a read of one version/horizon/model prunes partitions
at planning time instead of listing every file.  Paths are expected on the
shared cluster storage; :func:`scratch_path` derives one from the session's
checkpoint folder.
"""

from __future__ import annotations

import csv
import io
import uuid
import zipfile
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidecast.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def read_csv(spark: SparkSession, path: str, schema: StructType | str, null_value: str = "NA") -> DataFrame:
    """Header CSV (plain or gzip) with an explicit schema; ``null_value``
    strings become NULL (S2).  Zip archives: :func:`read_csv_zip`."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("nullValue", null_value)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def write_csv(df: DataFrame, path: str, null_value: str = "NA") -> None:
    df.write.mode("overwrite").option("header", True).option("nullValue", null_value).csv(path)


#: Compressed bytes of a member that one row carries.
MEMBER_PART = 8 << 20


def read_csv_zip(spark: SparkSession, path: str, schema: StructType | str, null_value: str = "NA", member: str = ".csv") -> DataFrame:
    """Header CSV files within zip archives, with an explicit schema.

    Archives are read as binary files, so from any store that Spark reads
    (2 GB for an archive at most).  Each member's compressed bytes become rows of
    their own and go to a task of their own, which inflates and parses them
    as a stream; archives with many members are thus read by many tasks.  Columns
    are matched by their header names; a value that does not fit its
    type, or a member without a column, is an error.
    """
    kinds = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = kinds.names

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for where, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = content.as_buffer().to_pybytes()
                for info in zipfile.ZipFile(io.BytesIO(raw)).infolist():
                    if info.is_dir() or not info.filename.lower().endswith(member):
                        continue
                    if info.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED) or info.flag_bits & 1:
                        raise ValueError(f"{where}: {info.filename} is encrypted or not deflated")
                    # the local header has 30 bytes, then name and extra field of its own lengths
                    head = info.header_offset
                    start = head + 30 + int.from_bytes(raw[head + 26: head + 28], "little") + int.from_bytes(raw[head + 28: head + 30], "little")
                    for part, at in enumerate(range(0, max(info.compress_size, 1), MEMBER_PART)):
                        data = raw[start + at: start + min(at + MEMBER_PART, info.compress_size)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([where]), pa.array([info.filename]), pa.array([part], pa.int32()), pa.array([info.compress_type == zipfile.ZIP_DEFLATED]), pa.array([data], pa.binary())],
                            ["archive", "member", "part", "deflated", "data"],
                        )

    def lines(rows: Iterator[tuple[bool, bytes]]) -> Iterator[str]:
        inflate, rest = None, b""
        for deflated, data in rows:
            if deflated:
                inflate = inflate or zlib.decompressobj(-15)
                data = inflate.decompress(data)
            *whole, rest = (rest + data).split(b"\n")
            for line in whole:
                yield line.decode() + "\n"
        if rest:
            yield rest.decode()

    def records(where: str, rows: Iterator[tuple[bool, bytes]]) -> Iterator[pa.RecordBatch]:
        reader = csv.reader(lines(rows))
        header = next(reader, None)
        if header is None:
            return
        missing = [c for c in names if c not in header]
        if missing:
            raise ValueError(f"{where} has no column {missing}")
        at, held = [header.index(c) for c in names], []
        for record in reader:
            if record:
                if len(record) != len(header):
                    raise ValueError(f"{where}: a line of {len(record)} fields, the header has {len(header)}")
                held.append([None if record[i] in ("", null_value) else record[i] for i in at])
            if len(held) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*held)], names)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*held)], names)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The parts of a member lie one after the other."""
        parts = ((b.column(0)[i].as_py(), b.column(1)[i].as_py(), b.column(3)[i].as_py(), b.column(4)[i].as_py()) for b in batches for i in range(b.num_rows))
        ahead = next(parts, None)
        while ahead is not None:
            key = ahead[:2]

            def own() -> Iterator[tuple[bool, bytes]]:
                nonlocal ahead
                while ahead is not None and ahead[:2] == key:
                    yield ahead[2:]
                    ahead = next(parts, None)

            rows = own()
            yield from records("/".join(key), rows)
            for _ in rows:
                pass

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    found = files.mapInArrow(members, "archive string, member string, part int, deflated boolean, data binary")
    # a fixed number of tasks: compressed sizes say little about the work, so adaptive execution shall not join them
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = found.repartition(tasks, "archive", "member").sortWithinPartitions("archive", "member", "part")
    text = dealt.mapInArrow(parse, ", ".join(f"`{c}` string" for c in names))
    return text.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in kinds.fields])


def clustered(df: DataFrame, by: list[str]) -> DataFrame:
    """``df`` dealt by its partition columns: adaptive execution splits what is
    too large for a task and joins what is small, so the number of writers of a
    partition follows its size."""
    return df.hint("rebalance", *by)


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, sort: Sequence[str] = (), path: str | None = None) -> DataFrame:
    """``df`` as a table bucketed by ``keys`` and sorted within buckets: windows,
    aggregations and joins by the keys need no shuffle when they read it (S3, S4)."""
    writer = df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys, *[c for c in sort if c not in keys])
    writer.option("path", path or scratch_path(df.sparkSession, table)).saveAsTable(table)
    return df.sparkSession.table(table)


def write_features(df: DataFrame, path: str) -> None:
    """Feature sets partitioned by (version, horizon) (S3).  Each version is a
    folder of its own, replaced as a whole when its job commits."""
    df = clustered(df, ["version", "horizon"])
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version", "horizon").parquet(path)


def read_features(spark: SparkSession, path: str, version: int, horizon: int) -> DataFrame:
    """One feature set (S4).  Only the version's folder is listed, so its own
    schema applies (versions differ in columns); the horizon predicate
    prunes partitions inside it."""
    return (
        spark.read.option("basePath", path)
        .parquet(f"{path}/version={version}")
        .where((F.col("version") == version) & (F.col("horizon") == horizon))
        .drop("version", "horizon")
    )


def write_predictions(df: DataFrame, path: str) -> None:
    """Long predictions partitioned by (model, horizon, split), test rows
    with the column pred, training rows with one for each fold (S5)."""
    df = clustered(df, ["model", "horizon", "split"])
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model", "horizon", "split").parquet(path)


def read_predictions(spark: SparkSession, path: str, model: str, split: str = "test") -> DataFrame:
    """All horizons of one model in a single scan (S6).  Only the model's folders
    of that split are listed, so their own schema applies."""
    return spark.read.option("basePath", path).parquet(f"{path}/model={model}/horizon=*/split={split}").drop("model", "split")


def write_submission(df: DataFrame, path: str, value: str = "pred") -> None:
    """(id, value) CSV with a header."""
    df.select("id", F.col(value).alias("sales")).write.mode("overwrite").option("header", True).csv(path)


def read_submission(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, "id string, sales double")


def write_importance(df: DataFrame, path: str) -> None:
    """Feature importance table as CSV."""
    df.write.mode("overwrite").option("header", True).csv(path)
