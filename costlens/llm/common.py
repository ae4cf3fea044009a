"""What the operators share: the shared folder, tables cut from their lineage, words, row order."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.store import scratch


#: The folder that driver and executors share.
shared_dir = scratch


#: Held while a table is written: a finished query deletes its own shuffle files, and batches for Python are small, since
#: rows carry packed arrays of up to megabytes.
HELD = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in HELD}
    for k, v in HELD.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def cut(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: executors lost later do not cost what it took to make it. Its
    shuffle files go when it is written; nothing reads them again."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with cleaned(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Deletes the files of a table that ``cut`` wrote and that no later result reads."""
    spark = df.sparkSession
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut_by(df: DataFrame, key: str, parts: int, name: str) -> DataFrame:
    """Like ``cut``, bucketed by a column: joins on it to small tables leave this one where it is."""
    spark = df.sparkSession
    path, table_name = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", f"costlens_{uuid.uuid4().hex}"
    with cleaned(spark):
        df.repartition(parts, key).write.format("parquet").bucketBy(parts, key).option("path", path).saveAsTable(table_name)
    out = spark.table(table_name)
    out.schema
    spark.sql(f"DROP TABLE {table_name}")  # only its entry: the files are where the path says
    return out


#: Bytes of text for each partition of blocks, at most.
BLOCK_BYTES = 32_000_000


def blocks(docs: DataFrame) -> int:
    """Partitions for what is held in Python a partition at a time: by the bytes of column text, and the session's at least."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(partitions(docs.sparkSession), -(-size // BLOCK_BYTES))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8; bytes.split() parts at just these characters."""
    return text.encode("utf-8", "surrogatepass").split()


def lower_words(text: str) -> list[bytes]:
    """Words with A-Z in lower case; bytes.lower() changes no other character."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def unused(name: str, names: list[str]) -> str:
    """``name``, with lines under it until no column has it."""
    while name in names:
        name += "_"
    return name


def keyed(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` in one column d, so that no name clashes, with what tells them apart: none (doc_id is null), doc,
    row (a hash of the text)."""
    text = F.coalesce(F.col("d.text").cast("string"), F.lit(""))
    doc = F.coalesce(F.col("d.doc_id").cast("long"), F.lit(0))
    return docs.select(F.struct("*").alias("d")).select("d", F.col("d.doc_id").isNull().alias("none"), doc.alias("doc"), F.xxhash64(text).alias("row"))


def chosen_rows(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """One row of ``docs`` for each of ``chosen`` (none, doc_id, row)."""
    ids = chosen.select("none", F.coalesce("doc_id", F.lit(0)).alias("doc"), "row")
    return keyed(docs).join(ids, ["none", "doc", "row"], "left_semi").dropDuplicates(["none", "doc", "row"]).select("d.*")
