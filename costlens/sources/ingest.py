"""Cost files to day-partitioned Parquet, and reading them back.

Files are read as text and cast once, so that costs keep their digits. Columns outside the specification are dropped,
absent optional ones are typed nulls, absent mandatory ones fail the file.

A run lands in one pass over its files: what they hold is staged as typed rows, each with its file and, if the line has
more or fewer fields than the header, with the line as it stands. From the stage come the days, a table of refused lines
and a ledger by file. All files of a run bear its name, and a run that is repeated first removes those that it left, so
that a crash between writing and committing costs nothing and doubles nothing.
"""

from __future__ import annotations

import csv
import re
import uuid
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import to_cost, to_time
from . import store
from .spec import KINDS, MANDATORY, PARTITIONS, SCHEMA, SPEC

DATASET, REFUSED, LEDGER = "costs_raw", "costs_refused", "ingest_ledger"
LEDGER_SCHEMA = "run string, file string, rows long, refused long, rejected_cells long, error string"
#: Columns that a read frame has beside the file's own: the line if it was refused, why, and the file.
LINE, REASON, FILE = "_corrupt_record", "_reason", "_file"
#: Files whose headers are read at a time.
OPENED = 16


class MissingColumns(ValueError):
    """A file lacks mandatory columns."""


@dataclass
class IngestResult:
    """Files taken and refused, rows written, lines refused, cells that could not be read, rows by day."""

    run: str = ""
    files_processed: int = 0
    files_failed: dict[str, str] = field(default_factory=dict)
    rows_processed: int = 0
    refused_lines: int = 0
    rejected_cells: int = 0
    partitions_written: int = 0
    rows_by_day: dict[str, int] = field(default_factory=dict)


def dataset_path(base: str, tenant: str, dataset: str = DATASET) -> str:
    return f"{base.rstrip('/')}/{tenant}/parquet/{dataset}"


def partition_path(base: str, tenant: str, year: int, month: int, day: int, dataset: str = DATASET) -> str:
    return f"{dataset_path(base, tenant, dataset)}/year={int(year)}/month={int(month):02d}/day={int(day):02d}"


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file, from its first line, which the driver reads without a job; by its suffix a file may be
    compressed."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(conf).open(place)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
    try:
        first = reader.readLine()
    finally:
        reader.close()
    return next(csv.reader([first.lstrip("\ufeff")])) if first else []


def check_columns(names: list[str], path: str = "") -> None:
    missing = [c for c in MANDATORY if c not in names]
    if missing:
        raise MissingColumns(f"{path} lacks {', '.join(missing)}")


def text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in [*names, LINE]])


#: Quotes are doubled inside quoted fields; without column pruning every line's fields are counted.
CSV = {"header": True, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "enforceSchema": False, "columnNameOfCorruptRecord": LINE, "columnPruning": False}


def marked(rows: DataFrame, names: list[str]) -> DataFrame:
    """Adds to rows that were read with ``text_schema`` their file, and why a line was refused."""
    fields = F.size(F.split(F.regexp_replace(LINE, '"(?:[^"]|"")*"', ""), ","))
    why = F.concat(fields.cast("string"), F.lit(f" fields for {len(names)} columns"))
    return rows.withColumns({REASON: F.when(F.col(LINE).isNotNull(), F.when(fields == len(names), "unreadable").otherwise(why)), FILE: F.col("_metadata.file_path")})


def read_csv(spark: SparkSession, paths: list[str], names: list[str], multi_line: bool = True) -> DataFrame:
    """Files of one header, all columns as text, ``marked``; quoted fields may span lines if ``multi_line``. Without it,
    large files are split among tasks."""
    return marked(spark.read.schema(text_schema(names)).options(**CSV, multiLine=multi_line).csv(paths), names)


def _typed(name: str, kind: str, present: bool) -> Column:
    if not present:
        return F.lit(None).cast(KINDS[kind]).alias(name)
    value = F.col(f"`{name}`")
    return {"decimal": to_cost, "time": to_time}.get(kind, lambda c: c)(value).alias(name)


def with_rejects(rows: DataFrame) -> DataFrame:
    """Rows of text columns in the specification's schema, with the partition columns of the charge's start, in _rejected
    how many cells of a row were no decimals, and what ``marked`` added, if it did."""
    start = F.coalesce("ChargePeriodStart", F.lit("1970-01-01").cast("timestamp"))
    more = [c for c in (LINE, REASON, FILE) if c in rows.columns]
    costs = [n for n, k, _ in SPEC if k == "decimal" and n in rows.columns]
    # a cell is cast once: of the cells that hold something those are rejected that gave no decimal
    typed = rows.select(*(_typed(n, k, n in rows.columns) for n, k, _ in SPEC), _count(F.trim(F.col(f"`{n}`")) != "" for n in costs).alias("_cells"), *more)
    rejected = F.col("_cells") - _count(F.col(n).isNotNull() for n in costs)
    return typed.select(*(n for n, _, _ in SPEC), rejected.alias("_rejected"), *more, F.year(start).cast("long").alias("year"), F.date_format(start, "MM").alias("month"), F.date_format(start, "dd").alias("day"))


def conform(rows: DataFrame) -> DataFrame:
    """``with_rejects`` without the count."""
    return with_rejects(rows).drop("_rejected")


def _count(tests: Iterable[Column]) -> Column:
    return sum((F.coalesce(t, F.lit(False)).cast("int") for t in tests), F.lit(0))


#: The JVM interprets methods of more bytes than this, and the generated code of so many columns is longer.
COMPILED = 8000


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """While a query is run: Spark splits generated code that the JVM would not compile."""
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, COMPILED)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def write_days(rows: DataFrame, path: str, overwrite: bool = True, compression: str = "snappy", run: str = "part") -> None:
    """Writes rows by day: with ``overwrite`` the days that occur are replaced, else added to. A day's rows meet in a
    few tasks, so that it has few files; a large day is split. Names of files begin with ``run``."""
    mode = "overwrite" if overwrite else "append"
    dealt = rows.hint("rebalance", *[F.col(c) for c in PARTITIONS])
    named(dealt, run).mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", compression).partitionBy(*PARTITIONS).parquet(path)


def named(rows: DataFrame, run: str):
    """A writer whose files' names begin with ``run``."""
    return rows.write.option("mapreduce.output.basename", run)


def read_days(spark: SparkSession, path: str) -> DataFrame:
    """The dataset; month and day stay text with their zero, since the schema is given."""
    return spark.read.schema(SCHEMA).parquet(path)


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Files that a path or glob names, in any store that Hadoop knows."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = store.globStatus(path) or []
    return sorted(f.getPath().toString() for s in found for f in (store.listStatus(s.getPath()) if s.isDirectory() else [s]) if f.isFile())


def forget(spark: SparkSession, folders: list[str], run: str) -> None:
    """Removes what a run of that name left in some folders."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def one(folder: str) -> None:
        place = jvm.org.apache.hadoop.fs.Path(f"{folder}/{run}-*")
        files = place.getFileSystem(conf)
        for found in files.globStatus(place) or []:
            files.delete(found.getPath(), False)

    with ThreadPoolExecutor(OPENED) as pool:
        list(pool.map(one, folders))


def land(rows: DataFrame, base: str, tenant: str, run: str, overwrite: bool = True, compression: str = "snappy") -> IngestResult:
    """Lands ``marked`` text rows as one run: days, refused lines and ledger. The same run may land again: it replaces what
    it left. Driver and ledger hold a row for each day and file of the run."""
    spark, out = rows.sparkSession, IngestResult(run=re.sub(r"[^A-Za-z0-9_.]", "_", run))
    path, refused, ledger = (dataset_path(base, tenant, d) for d in (DATASET, REFUSED, LEDGER))
    with compiled(spark):
        stage = store.held(with_rejects(rows), "staged")
    good, day = F.col(LINE).isNull(), F.struct(*PARTITIONS)
    by_file = stage.groupBy(F.col(FILE).alias("file")).agg(F.count_if(good).alias("rows"), F.count_if(~good).alias("refused"), F.sum(F.when(good, F.col("_rejected")).otherwise(0)).alias("rejected_cells"))
    days = {"-".join(map(str, r["d"])): r["n"] for r in stage.where(good).groupBy(day.alias("d")).agg(F.count("*").alias("n")).orderBy("d").collect()}
    forget(spark, [refused, ledger], out.run)
    if not overwrite:
        forget(spark, [f"{path}/year={y}/month={m}/day={d}" for y, m, d in (k.split("-") for k in days)], out.run)
    with compiled(spark):
        write_days(stage.where(good).select(*SCHEMA.names), path, overwrite, compression, out.run)
    lines = stage.where(~good).select(F.lit(out.run).alias("run"), F.col(FILE).alias("file"), F.col(REASON).alias("reason"), F.col(LINE).alias("line"))
    named(lines, out.run).mode("append").parquet(refused)
    named(by_file.select(F.lit(out.run).alias("run"), "*", F.lit(None).cast("string").alias("error")), out.run).mode("append").parquet(ledger)
    own = store.read_table(spark, f"{ledger}/{out.run}-*", LEDGER_SCHEMA)  # this run's files alone
    total = own.agg(F.count("*"), F.sum("rows"), F.sum("refused"), F.sum("rejected_cells")).first()
    out.files_processed, out.rows_processed, out.refused_lines, out.rejected_cells = (v or 0 for v in total)
    out.rows_by_day, out.partitions_written = days, len(days)
    store.discard(stage)
    return out


def read_refused(spark: SparkSession, base: str, tenant: str) -> DataFrame:
    """Lines that no run could read: run, file, reason, line."""
    return store.read_table(spark, dataset_path(base, tenant, REFUSED), "run string, file string, reason string, line string")


def read_ledger(spark: SparkSession, base: str, tenant: str) -> DataFrame:
    """What became of each file: run, file, rows, refused, rejected_cells, and the error of one that was not read."""
    return store.read_table(spark, dataset_path(base, tenant, LEDGER), LEDGER_SCHEMA)


@dataclass
class IngestionService:
    """Reads cost files that a pattern names into a tenant's dataset."""

    spark: SparkSession
    output_base: str
    tenant: str
    compression: str = "snappy"
    overwrite: bool = True
    multi_line: bool = True

    def headers(self, paths: list[str]) -> list[tuple[str, list[str] | str]]:
        """Of each file its column names, or why it is refused."""

        def one(path: str) -> tuple[str, list[str] | str]:
            try:
                names = header_of(self.spark, path)
                check_columns(names, path)
            except Exception as error:  # noqa: BLE001  one bad file must not stop the others
                return path, str(error)
            return path, names

        with ThreadPoolExecutor(OPENED) as pool:
            return list(pool.map(one, paths))

    def _record(self, failed: dict[str, str], name: str) -> None:
        ledger = dataset_path(self.output_base, self.tenant, LEDGER)
        forget(self.spark, [ledger], name)
        if failed:
            rows = self.spark.createDataFrame([(name.removesuffix("_failed"), f, 0, 0, 0, e) for f, e in failed.items()], LEDGER_SCHEMA)
            named(rows, name).mode("append").parquet(ledger)

    def ingest(self, pattern: str, run: str | None = None) -> IngestResult:
        """Lands the files as a run; name it to be able to repeat it after a crash without doubling what it appended."""
        failed: dict[str, str] = {}
        by_header: dict[tuple[str, ...], list[str]] = {}
        for path, names in self.headers(list_files(self.spark, pattern)):
            if isinstance(names, str):
                failed[path] = names
            else:
                by_header.setdefault(tuple(names), []).append(path)
        rows = None
        for names, paths in by_header.items():
            typed = read_csv(self.spark, paths, list(names), self.multi_line)
            rows = typed if rows is None else rows.unionByName(typed, allowMissingColumns=True)
        run = re.sub(r"[^A-Za-z0-9_.]", "_", run or uuid.uuid4().hex)
        out = IngestResult(run=run) if rows is None else land(rows, self.output_base, self.tenant, run, self.overwrite, self.compression)
        self._record(failed, f"{run}_failed")
        out.files_failed, out.files_processed = failed, sum(map(len, by_header.values()))
        return out
