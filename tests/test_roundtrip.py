"""csv_roundtrip puts every row of the tables through CSV and ingest."""

from __future__ import annotations

from costlens.plans.catalogue import QUERIES
from costlens.sources import ingest


def test_every_row_is_ingested(spark, sf_dir, monkeypatch):
    results = []
    whole = ingest.IngestionService.ingest
    monkeypatch.setattr(ingest.IngestionService, "ingest", lambda self, pattern: results.append(whole(self, pattern)) or results[-1])
    days = QUERIES["csv_roundtrip"](spark, sf_dir)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    assert results[0].rows_processed == lines.count()
    assert results[0].partitions_written == lines.selectExpr("to_date(l_shipdate)").distinct().count() == days.count()
