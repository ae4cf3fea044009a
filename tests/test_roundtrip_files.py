"""The cost files that the round trip writes are compressed and bounded."""

from __future__ import annotations

import os

from costlens.plans.catalogue import QUERIES
from costlens.sources import ingest


def test_round_trip_writes_compressed_bounded_files(spark, sf_dir, monkeypatch):
    from costlens.plans import catalogue

    found = []
    whole = ingest.IngestionService.ingest
    monkeypatch.setattr(catalogue, "FILE_ROWS", 1000)
    monkeypatch.setattr(ingest.IngestionService, "ingest", lambda self, pattern: found.append(ingest.list_files(spark, pattern)) or whole(self, pattern))
    days = QUERIES["csv_roundtrip"](spark, sf_dir)
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    assert days.selectExpr("sum(n)").first()[0] == rows
    size = sum(os.path.getsize(f.removeprefix("file:")) for f in found[0])
    assert len(found[0]) >= rows / 1000 and size < 100 * rows  # as plain text: some 560 bytes a row
