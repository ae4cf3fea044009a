"""The registered source, and kept views after overlapping ingests."""

from __future__ import annotations

import csv
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from costlens import cli
from costlens.operators import incremental, views
from costlens.sources import datasource, ingest
from costlens.sources.spec import SCHEMA, SPEC


def cost_row(day, resource, cost):
    row = {n: {"decimal": "1.5", "time": f"2025-01-{day:02d}T00:00:00Z", "json": "{}"}.get(k, "x") for n, k, level in SPEC if level == "mandatory"}
    return row | {"ResourceId": f"/s/resourcegroups/g/{resource}", "EffectiveCost": cost}


def ingested(spark, base, name, rows, overwrite=False):
    path = f"{base}/{name}.csv"
    with open(path, "w", newline="") as f:
        w = csv.DictWriter(f, list(rows[0]))
        w.writeheader()
        w.writerows(rows)
    return ingest.IngestionService(spark, str(base), "t", overwrite=overwrite).ingest(path)


@pytest.fixture
def base(spark, tmp_path):
    ingested(spark, tmp_path, "a", [cost_row(d, f"r{k}", f"{d}.{k}") for d in (1, 2, 3) for k in range(4)])
    return tmp_path


def test_format_reads_as_spark_does(spark, base):
    with pytest.raises(Exception, match="DATA_SOURCE_NOT_FOUND"):
        spark.read.format("no_such_costs").load()
    datasource.register(spark)
    read = lambda **o: spark.read.format("costs").options(path=str(base), **o)
    got, want = read(tenant="t").load(), ingest.read_days(spark, ingest.dataset_path(str(base), "t"))
    assert got.schema == SCHEMA and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert {r["ChargePeriodStart"] for r in got.collect()} == {dt.datetime(2025, 1, d) for d in (1, 2, 3)}
    assert got.where("day = '02' AND EffectiveCost > 2.1").count() == 2
    assert read(tenant="nobody").load().count() == 0
    assert read(tenant="t").schema("ResourceId string, day string").load().distinct().count() == 12
    with pytest.raises(Exception, match="path and tenant"):
        read().load().count()
    with pytest.raises(datasource.UnknownStore):
        datasource.opened("nowhere://x/y")


def test_filters_drop_files(base):
    place = ingest.dataset_path(str(base), "t")
    reader = datasource.CostReader(place, SCHEMA)
    left = list(reader.pushFilters([datasource.EqualTo(("day",), "02"), datasource.In(("year",), (2025, 2026)), datasource.EqualTo(("ResourceId",), "x")]))
    assert len(left) == 1 and {f.day for f in reader.partitions()} == {"02"}
    assert {f.day for f in datasource.CostReader(place, SCHEMA).partitions()} == {"01", "02", "03"}


def test_stream(spark, base, tmp_path):
    datasource.register(spark)
    out, state = str(tmp_path / "copy"), str(tmp_path / "state")

    def run():
        rows = spark.readStream.format("costs").options(path=str(base), tenant="t").load().select("ResourceId", "day")
        rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
        return spark.read.parquet(out).count()

    assert run() == run() == 12
    ingested(spark, base, "b", [cost_row(4, "r9", "1")])
    assert run() == 13


def test_kept_views_equal_the_full_ones(spark, base, monkeypatch):
    days = lambda: ingest.read_days(spark, ingest.dataset_path(str(base), "t"))
    incremental.refresh(spark, str(base), "t", ["2025-01-01", "2025-01-02", "2025-01-03"])
    for name, rows, overwrite in (("b", [cost_row(2, "r1", "100"), cost_row(4, "r8", "7")], False), ("c", [cost_row(3, "r5", "9")], True), ("d", [cost_row(31, "r5", "900000"), cost_row(31, "r5", "900000")], False)):
        result = ingested(spark, base, name, rows, overwrite)
        files = [f for f in incremental.touched(days(), result.rows_by_day).select("ResourceId").inputFiles()]
        read = incremental.touched(days(), result.rows_by_day).select(F.input_file_name()).distinct().collect()
        assert files and {os.path.basename(os.path.dirname(r[0])) for r in read} == {f"day={d[-2:]}" for d in result.rows_by_day}
        incremental.refresh(spark, str(base), "t", result.rows_by_day)
        full = views.resources_per_day_json(views.resources_per_day(days()))
        kept = incremental.per_day(spark, str(base), "t")
        assert kept.columns == full.columns and sorted(map(str, kept.collect())) == sorted(map(str, full.collect()))
        month = incremental.per_month(spark, str(base), "t").drop("year", "month")
        assert sorted(map(str, month.collect())) == sorted(map(str, views.monthly(full, 2025, "01").collect()))
    incremental.refresh(spark, str(base), "t", [])
    assert incremental.per_day(spark, str(base), "other").count() == incremental.per_month(spark, str(base), "other").count() == 0


def test_command_line_keeps_views(spark, base, caplog):
    rows = [cost_row(7, "r1", "5"), cost_row(8, "r1", "6")]
    ingested(spark, base, "e", rows)
    path = base / "e.csv"
    path.write_text(path.read_text() + "broken,line\n")
    for _ in range(2):
        cli.main(["ingest", "--tenant", "u", "--output-base", str(base), "--input", str(path), "--no-overwrite", "--run", "once", "--keep-views"])
    got = {(r["day"], str(r["TotalEffectiveCost"])) for r in incremental.per_day(spark, str(base), "u").collect()}
    assert got == {("07", "5.0000"), ("08", "6.0000")} and ingest.read_refused(spark, str(base), "u").count() == 1
