"""Cost files as a stream: new files of a folder are landed by day, each batch once."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.ingest import CSV, check_columns, land, marked, text_schema


def run_of(checkpoint: str, batch: int) -> str:
    """Name of a batch's run: the same whenever the stream of that checkpoint replays the batch."""
    return f"stream{hashlib.md5(checkpoint.encode()).hexdigest()[:12]}_{batch}"


def land_batch(rows: DataFrame, batch: int, base: str, tenant: str, checkpoint: str) -> None:
    """Lands a batch. Spark replays a batch of which it does not know that it ended; then it replaces its own files."""
    if not rows.isEmpty():
        land(rows, base, tenant, run_of(checkpoint, batch), overwrite=False)


def stream_costs(spark: SparkSession, folder: str, names: list[str], base: str, tenant: str, checkpoint: str, files: int = 1000) -> StreamingQuery:
    """Takes all files that are there, at most ``files`` a batch, then ends. Batches append: replacing days would erase
    what earlier batches of the same day wrote."""
    check_columns(names, folder)
    options = {**CSV, "enforceSchema": True, "multiLine": True, "maxFilesPerTrigger": files}  # headers are the caller's
    rows = marked(spark.readStream.schema(text_schema(names)).options(**options).csv(folder), names)
    write = lambda batch, number: land_batch(batch, number, base, tenant, checkpoint)
    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
