"""What Parquet footers say, read in executors: rows, bytes, ranges and bloom filters of row groups, without their data."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import shared
from tidemark.operators import cdc

SCHEMA = "path string, bytes long, row_group int, rows long, position int, column string, compressed long, uncompressed long, low string, high string, bloom boolean"


class _Compact:
    """Structs of Thrift's compact protocol as {field: value}; what the footer's own reader doesn't tell is looked up there."""

    def __init__(self, raw: bytes):
        self.raw, self.at = raw, 0

    def byte(self) -> int:
        self.at += 1
        return self.raw[self.at - 1]

    def number(self) -> int:
        out = shift = 0
        while True:
            b = self.byte()
            out |= (b & 127) << shift
            if b < 128:
                return out
            shift += 7

    def signed(self) -> int:
        n = self.number()
        return (n >> 1) ^ -(n & 1)

    def value(self, kind: int):
        if kind in (1, 2):
            return kind == 1
        if kind == 3:
            return self.byte()
        if kind in (4, 5, 6):
            return self.signed()
        if kind == 7:
            self.at += 8
            return None
        if kind == 8:
            n = self.number()
            self.at += n
            return self.raw[self.at - n : self.at]
        if kind in (9, 10):
            head = self.byte()
            n = head >> 4 if head >> 4 < 15 else self.number()
            return [self.byte() == 1 if head & 15 in (1, 2) else self.value(head & 15) for _ in range(n)]
        if kind == 12:
            return self.struct()
        raise ValueError(f"a footer has no value of kind {kind}")

    def struct(self) -> dict:
        out, field = {}, 0
        while head := self.byte():
            field = field + (head >> 4) if head >> 4 else self.signed()
            out[field] = self.value(head & 15)
        return out


#: Fields of the format's file metadata, row group, column chunk and column metadata.
_ROW_GROUPS, _COLUMNS, _META_DATA, _BLOOM_OFFSET = 4, 1, 3, 14


def _blooms(file, size: int) -> list[list[bool]]:
    """For each row group and column, whether it has a bloom filter."""
    file.seek(size - 8)
    length = int.from_bytes(file.read(4), "little")
    file.seek(size - 8 - length)
    groups = _Compact(file.read(length)).struct().get(_ROW_GROUPS, [])
    return [[_BLOOM_OFFSET in c.get(_META_DATA, {}) for c in g[_COLUMNS]] for g in groups]


def _said(x) -> str | None:
    return None if x is None else x.decode("utf-8", "replace") if isinstance(x, bytes) else str(x)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    types = [{"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}[x.split()[1]] for x in SCHEMA.split(", ")]
    for b in batches:
        for path in b.column("path").to_pylist():
            fs, at = pafs.FileSystem.from_uri(path)
            size = fs.get_file_info(at).size
            with fs.open_input_file(at) as file:
                meta, blooms, rows = pq.ParquetFile(file).metadata, _blooms(file, size), []
            for g in range(meta.num_row_groups):
                group = meta.row_group(g)
                for k in range(group.num_columns):
                    c = group.column(k)
                    s = c.statistics if c.is_stats_set and c.statistics.has_min_max else None
                    rows.append((path, size, g, group.num_rows, k, c.path_in_schema, c.total_compressed_size, c.total_uncompressed_size, _said(s and s.min), _said(s and s.max), blooms[g][k]))
            if not rows:
                rows.append((path, size, None, 0, 0, None, 0, 0, None, None, False))  # a file without rows
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def column_chunks(df: DataFrame) -> DataFrame:
    """A row for each row group and column of the files that a Parquet frame reads: path, bytes of the file, row_group, rows,
    position and name of the column, its compressed and uncompressed bytes, low and high (as text; NULL if unknown), bloom."""
    spark = df.sparkSession
    shared.importable(spark)
    files = spark.createDataFrame([(f,) for f in df.inputFiles()], "path string")
    return files.repartition(max(1, min(files.count(), 4 * spark.sparkContext.defaultParallelism))).mapInArrow(_read, SCHEMA)


def statistics(tables: dict[str, DataFrame]) -> DataFrame:
    """files, rows, size_mb, uncompressed_mb and compression_ratio of each table, most files first."""

    def one(df: DataFrame) -> DataFrame:
        first = F.col("position") == 0
        by_file = column_chunks(df).groupBy("path", "bytes").agg(F.sum(F.when(first, F.col("rows")).otherwise(0)).alias("rows"), F.sum("compressed").alias("compressed"), F.sum("uncompressed").alias("uncompressed"))
        mb = lambda c: F.round(F.sum(c) / 1048576, 2)
        return by_file.agg(F.count("*").alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), mb("bytes").alias("size_mb"), mb("uncompressed").alias("uncompressed_mb"), F.round(F.try_divide(F.sum("uncompressed"), F.sum("compressed")), 4).alias("compression_ratio"))

    return cdc.surrogate_union({k: one(df) for k, df in tables.items()}, "table_name").orderBy(F.col("files").desc(), "table_name")


def skipped(df: DataFrame, column: str, value) -> DataFrame:
    """For each row group: rows, whether the column's range shows that the value isn't there (`by_range`), and whether a bloom
    filter can (`bloom`)."""
    kind = df.schema[column].dataType
    bound: dict[str, Column] = {n: F.col(n).cast(kind) for n in ("low", "high")}
    outside = F.coalesce((F.lit(value).cast(kind) < bound["low"]) | (F.lit(value).cast(kind) > bound["high"]), F.lit(False))
    return column_chunks(df).where(F.col("column") == column).select("path", "row_group", "rows", outside.alias("by_range"), "bloom")
