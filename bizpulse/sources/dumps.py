"""Dumps of a document store as a Spark data source: extended JSON, one document a line, a file or a folder per collection.

Files are cut into ranges of bytes, and a range holds the lines that begin in it, so every document is read once, by one task,
wherever the cuts fall. Of files compressed by gzip (`.gz`) the ranges are of the unpacked bytes; as a task unpacks all before its range
too, there are at most PACKED_RANGES of a file. Only fields of the given schema are taken out of a document.
"""

from __future__ import annotations

import gzip
import io
import json
import os
import re
import sys
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SHORT_NAME = "store_dump"
RANGE_BYTES, BATCH_ROWS = 64 << 20, 4096
PACKED_RANGES, FILE_ROWS = 8, 100_000
# How extended JSON wraps values of types that JSON lacks.
WRAPPED = ("$oid", "$numberInt", "$numberLong", "$numberDouble", "$numberDecimal", "$date", "$symbol", "$uuid")


def _filesystem(address: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(address if re.match(r"[a-z0-9+.-]+:", address) else os.path.abspath(address))


def plain(value):
    """A value out of its extended JSON wrapping."""
    while isinstance(value, dict) and len(value) == 1 and next(iter(value)) in WRAPPED:
        value = next(iter(value.values()))
    return value


def _text(value) -> str | None:
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def _whole(bits: int) -> Callable:
    def read(value) -> int | None:
        if isinstance(value, bool) or value is None:
            return None
        try:
            number = float(value) if not isinstance(value, (int, str)) else int(value)
        except (TypeError, ValueError):
            return None
        return int(number) if number == int(number) and -(1 << bits - 1) <= number < 1 << bits - 1 else None

    return read


def _double(value) -> float | None:
    if isinstance(value, bool) or value is None:
        return None
    try:
        return float(value)
    except (TypeError, ValueError):
        return None


#: How a field of each type is read; a value of another type is null, as when Spark reads JSON.
READ: dict[type, Callable] = {
    T.StringType: _text, T.IntegerType: _whole(32), T.LongType: _whole(64), T.DoubleType: _double,
    T.BooleanType: lambda value: value if isinstance(value, bool) else None,
}
ARROW = {T.StringType: pa.string(), T.IntegerType: pa.int32(), T.LongType: pa.int64(), T.DoubleType: pa.float64(), T.BooleanType: pa.bool_()}


class Lines(InputPartition):
    """The lines of a file that begin at `start` or later, before `end`."""

    def __init__(self, file: str, start: int, end: int):
        self.file, self.start, self.end = file, start, end


def lines_of(stream, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Places and contents of the lines that begin in the range. A line begins at 0 or after a line feed, so the byte before the
    range tells whether one begins with it."""
    at = start
    if start:
        stream.seek(start - 1)
        at = start - 1 + len(stream.readline())
    while at < end:
        line = stream.readline()
        if not line:
            return
        yield at, line
        at += len(line)


class DumpReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.schema = schema
        if not options.get("path", "").strip():
            raise ValueError("path must not be blank")
        self.path, self.range_bytes = options["path"].rstrip("/"), int(options.get("rangebytes", RANGE_BYTES))
        unknown = [f.name for f in schema.fields if type(f.dataType) not in READ]
        if unknown:
            raise ValueError(f"no way to read the types of {unknown}")

    def partitions(self) -> Sequence[Lines]:
        """Ranges of the collection's files; names with a dot or an underscore in front are not data."""
        from pyarrow import fs

        system, root = _filesystem(self.path)
        info = system.get_file_info(root)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(f"no dump at {self.path}")
        files = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(root))
        files = [f for f in files if f.type == fs.FileType.File and (f is info or f.base_name[:1] not in "._")]
        cut = [part for f in sorted(files, key=lambda f: f.path) for part in (self._packed(system, f) if f.path.endswith(".gz") else self._plain(f))]
        return cut or [Lines("", 0, 0)]

    def _plain(self, file) -> list[Lines]:
        return [Lines(file.path, at, min(at + self.range_bytes, file.size)) for at in range(0, file.size, self.range_bytes)]

    def _packed(self, system, file) -> list[Lines]:
        """The size unpacked stands in the last four bytes, of files of 4 GB or several parts not all of it, so the last range has no
        end."""
        if not file.size:
            return []
        with system.open_input_file(file.path) as stream:
            stream.seek(max(0, file.size - 4))
            size = int.from_bytes(stream.read(4), "little")
        step = max(self.range_bytes, -(-size // PACKED_RANGES))
        starts = range(0, max(size, 1), step)
        return [Lines(file.path, at, at + step if at + step < size else sys.maxsize) for at in starts]

    def read(self, partition: Lines) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        names = [f.name for f in self.schema.fields]
        kinds = [type(f.dataType) for f in self.schema.fields]
        arrow = pa.schema([pa.field(n, ARROW[k]) for n, k in zip(names, kinds)])
        readers = [READ[k] for k in kinds]
        columns: list[list] = [[] for _ in names]
        rows = 0
        with _filesystem(self.path)[0].open_input_file(partition.file) as stream:
            told = io.BufferedReader(stream, 1 << 20)
            told = gzip.GzipFile(fileobj=told) if partition.file.endswith(".gz") else told
            for at, line in lines_of(told, partition.start, partition.end):
                if line.isspace():
                    continue
                try:
                    document = json.loads(line)
                    if not isinstance(document, dict):
                        raise ValueError("not a document")
                except ValueError as error:
                    raise ValueError(f"{partition.file}, byte {at}: {error}") from error
                for column, name, read in zip(columns, names, readers):
                    column.append(read(plain(document.get(name))))
                rows += 1
                if rows == BATCH_ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow.types)], schema=arrow)
                    columns, rows = [[] for _ in names], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow.types)], schema=arrow)


class StoreDump(DataSource):
    """`spark.read.format("store_dump").schema(...).load(path)`; option `rangebytes`: bytes a task reads at least."""

    @classmethod
    def name(cls) -> str:
        return SHORT_NAME

    def reader(self, schema: T.StructType) -> DumpReader:
        return DumpReader(schema, self.options)


def read_dump(spark: SparkSession, path: str, schema: T.StructType | str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """A collection's dump, a file or a folder of files. Fields outside the schema are not read out of their documents. Every field
    may be null, as when files are read: a dump does not keep its documents to a schema."""
    spark.dataSource.register(StoreDump)
    told = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    loose = T.StructType([T.StructField(f.name, f.dataType) for f in told.fields])
    return spark.read.format(SHORT_NAME).schema(loose).option("rangebytes", range_bytes).load(path)


def dump_documents(df: DataFrame) -> Column:
    """Each row as a document in canonical extended JSON; nulls are left out."""
    wrap = {"int": "$numberInt", "bigint": "$numberLong", "double": "$numberDouble"}

    def value(name: str, kind: str) -> Column:
        plain_ = F.col(name)
        if kind not in wrap:
            return plain_.alias(name)
        return F.when(plain_.isNotNull(), F.struct(plain_.cast("string").alias(wrap[kind]))).alias(name)

    return F.to_json(F.struct(*[value(n, k) for n, k in df.dtypes]))


def write_dump(df: DataFrame, path: str) -> None:
    """Write rows as a dump of a collection: a folder of compressed files of at most FILE_ROWS documents, one a line."""
    df.select(dump_documents(df).alias("value")).write.option("maxRecordsPerFile", FILE_ROWS).text(path, compression="gzip")
