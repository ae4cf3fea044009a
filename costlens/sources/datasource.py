"""A tenant's cost store as a Spark data source: ``spark.read.format("costs").options(path=base, tenant=t).load()``.

Batch and stream. A file is a partition; filters on year, month and day drop files before they are read. Columns are the
specification's, or those of a schema that the reader is given. Files are opened in any store that pyarrow has a file
system for, which a path's scheme names; ``stores`` registers others. Spark's own reader (``ingest.read_days``) serves any store that Hadoop knows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import DataType, DecimalType, StructType

from .ingest import DATASET, dataset_path
from .spec import PARTITIONS, SCHEMA

NAME = "costs"
PLACE = re.compile(r"year=(\d+)/month=(\d+)/day=(\d+)/[^/]+\.parquet$")
#: File systems by scheme, beside those that pyarrow knows: a function of a path gives the system and the path in it.
stores: dict[str, Callable[[str], tuple[fs.FileSystem, str]]] = {}


class UnknownStore(ValueError):
    """No file system is registered for a path's scheme."""


def opened(path: str) -> tuple[fs.FileSystem, str]:
    scheme = path.split("://", 1)[0] if "://" in path else ""
    if scheme in stores:
        return stores[scheme](path)
    if not scheme:
        return fs.LocalFileSystem(), path.removeprefix("file:")
    try:
        return fs.FileSystem.from_uri(path)
    except (pa.ArrowInvalid, NotImplementedError) as error:
        raise UnknownStore(f"no file system for {scheme}: register one in stores") from error


@dataclass
class File(InputPartition):
    path: str
    year: int
    month: str
    day: str
    at: int


def files_of(place: str) -> list[File]:
    """The store's files, in the order of writing."""
    system, root = opened(place)
    found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    listed = [(f, m) for f in found if f.type == fs.FileType.File and (m := PLACE.search(f.path))]
    out = [File(f.path, int(m[1]), m[2], m[3], f.mtime_ns or 0) for f, m in listed if not re.search(r"/[._]", f.path.removeprefix(root))]
    return sorted(out, key=lambda f: (f.at, f.path))


TESTS = {EqualTo: lambda a, b: a == b, EqualNullSafe: lambda a, b: a == b, GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b, In: lambda a, b: a in b}


def on_partition(item: Filter) -> bool:
    return type(item) in TESTS and item.attribute in [(c,) for c in PARTITIONS]


def holds(file: File, item: Filter) -> bool:
    return TESTS[type(item)](getattr(file, item.attribute[0]), item.value)


def arrow_type(kind: DataType) -> pa.DataType:
    """Of the specification's types."""
    if isinstance(kind, DecimalType):
        return pa.decimal128(kind.precision, kind.scale)
    return {"string": pa.string(), "bigint": pa.int64(), "timestamp": pa.timestamp("us", "UTC")}[kind.simpleString()]


def batches(place: str, file: File, schema: StructType) -> Iterator[pa.RecordBatch]:
    wanted = pa.schema([(f.name, arrow_type(f.dataType)) for f in schema])
    system, _ = opened(place)
    with system.open_input_file(file.path) as source:
        held = pq.ParquetFile(source)
        own = [n for n in wanted.names if n not in PARTITIONS and n in held.schema_arrow.names]
        for batch in held.iter_batches(columns=own):
            columns = []
            for f in wanted:
                if f.name in PARTITIONS:
                    columns.append(pa.repeat(pa.scalar(getattr(file, f.name), f.type), batch.num_rows))
                elif f.name not in own:
                    columns.append(pa.nulls(batch.num_rows, f.type))
                elif pa.types.is_timestamp(f.type):  # instants in UTC, whatever unit and zone the file says
                    columns.append(pc.cast(pc.cast(batch[f.name], pa.timestamp("us"), safe=False), f.type))
                else:
                    columns.append(pc.cast(batch[f.name], f.type))
            yield pa.RecordBatch.from_arrays(columns, schema=wanted)


class CostReader(DataSourceReader):
    def __init__(self, place: str, schema: StructType) -> None:
        self.place, self.schema, self.filters = place, schema, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for item in filters:
            if on_partition(item):
                self.filters.append(item)
            else:
                yield item

    def partitions(self) -> list[File]:
        return [f for f in files_of(self.place) if all(holds(f, item) for item in self.filters)]

    def read(self, partition: File | None) -> Iterator[pa.RecordBatch]:
        if partition is not None:  # a store without files is read once, as nothing
            yield from batches(self.place, partition, self.schema)


class CostStream(DataSourceStreamReader):
    """New files by their time of writing. A file must not appear with a time that an earlier batch has passed."""

    def __init__(self, place: str, schema: StructType) -> None:
        self.place, self.schema = place, schema

    def initialOffset(self) -> dict:
        return {"at": -1}

    def latestOffset(self) -> dict:
        return {"at": max((f.at for f in files_of(self.place)), default=-1)}

    def partitions(self, start: dict, end: dict) -> list[File]:
        return [f for f in files_of(self.place) if start["at"] < f.at <= end["at"]]

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        yield from batches(self.place, partition, self.schema)

    def commit(self, end: dict) -> None:
        """Nothing is held between batches."""


class CostStore(DataSource):
    """Options: path (the base folder), tenant, dataset."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        return SCHEMA

    def _place(self) -> str:
        if not self.options.get("path") or not self.options.get("tenant"):
            raise ValueError("the options path and tenant are needed")
        return dataset_path(self.options["path"], self.options["tenant"], self.options.get("dataset", DATASET))

    def reader(self, schema: StructType) -> CostReader:
        return CostReader(self._place(), schema)

    def streamReader(self, schema: StructType) -> CostStream:
        return CostStream(self._place(), schema)


def register(spark: SparkSession) -> None:
    """Makes the format known to a session, with filters pushed to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(CostStore)
