"""Ingest, scalar rules, scans of glued names and the whole flow of a tenant's month."""

from __future__ import annotations

import csv
import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from costlens import cli
from costlens.functions import json_text, scalars
from costlens.functions.masks import Terms
from costlens.operators import audit, entities, extraction, views
from costlens.sources import ingest, store
from costlens.sources.spec import MANDATORY, SCHEMA, SPEC
from costlens.streaming import files


def values(spark, kind, column, rows):
    frame = spark.createDataFrame([(k, v) for k, v in enumerate(rows)], f"k int, v {kind}")
    return [r[0] for r in frame.select(column(F.col("v")).alias("x"), "k").orderBy("k").select("x").collect()]


def test_decimals(spark):
    got = values(spark, "string", scalars.to_cost, ["123.45", "0.00000000001", "-123.45", None, "not a number", "123.45.67", "$1,234.5", "1000000", ""])
    assert got == [Decimal("123.45"), Decimal("0.00000000001"), Decimal("-123.45"), None, None, None, Decimal("1234.5"), None, None]


def test_times(spark):
    day = dt.datetime(2025, 1, 1)
    got = values(spark, "string", scalars.to_time, ["2025-01-01T00:00:00Z", "2025-01-01", "2025-01-01T00:00:00.123Z", "2025-01-01 02:00:00+02:00", "2025-01-01 00:00:00 UTC", None, " ", "not a date", "12:30:00"])
    assert got == [day] * 5 + [None, None, dt.datetime(1970, 1, 1), dt.datetime(1970, 1, 1)]


def test_periods_and_names(spark):
    rows = [("2025-01-01", "2025-01-02"), ("2025-01-01", "2025-01-03"), ("2025-01-01", "2025-01-01"), (None, "2025-01-02")]
    frame = spark.createDataFrame(rows, "a string, b string")
    assert [r[0] for r in frame.select(scalars.is_daily_period(F.col("a"), F.col("b"))).collect()] == [True, False, False, False]
    assert [scalars.is_cost_field(n) for n in ("Cost", "ResourceCost", "Price", "ResourceId", "CostCenter", "PriceList")] == [True] * 3 + [False] * 3


def test_tags(spark):
    pairs = lambda c: F.transform(json_text.tag_pairs(c), lambda p: F.concat_ws("=", p["key"], p["value"]))
    got = values(spark, "string", pairs, ['{"a":"1","b":"2"}', "{}", "[]", None, "not a json", '{"key": "value"', '[{"key":"a","value":"b"}]', '[{"x":"1"},3]', "null", "7", '[1,"{}",null,{"a":null},[2],{"b":"2","c":"3"}]', '{"a":null}'])
    assert got == [["a=1", "b=2"], [], [], [], [], [], ["a=b", "a=b"], ["x=1"], [], [], ["a=None", "b=2", "c=3"], ["a=None"]]
    text = values(spark, "string", json_text.tag_string, ['[{"Key":"a","Value":"b"},{"Key":"a"},{"Key":"0","Value":5},{"Value":"z"}]', '{"env":"prod"}', "[]", None])
    assert text == ["0=5;a=b;a=", None, None, None]


def test_nfkc(spark):
    assert values(spark, "string", scalars.normalized, ["ﬁLE", "ABC", None]) == ["file", "abc", None]


def brute_masks(name, terms):
    hits = {}
    for kind, p in terms.mask_patterns():
        name, hits[kind] = re.subn(p, f"⟂{kind}⟂", name)
    return name, hits


def test_masks_follow_the_patterns(spark):
    terms = Terms.of(["sql", "vm", "pre-prod"], ["prod", "dev"], ["weu"])
    names = ["app-prod-weu-sql2019-01", "0a1b2c3d4e5f60718293a4b5c6d7e8f9", "x-deadbeef-12ab", "VM_dev", None, "", "12345678-1234-1234-1234-123456789abc-a", "pre-prod-x", "facade-42a", "-_-"]
    frame = spark.createDataFrame([(str(k), n, "t") for k, n in enumerate(names)], "ResourceId string, ResourceName string, ResourceType string")
    for r in audit.report(frame, terms).collect():
        want, hits = brute_masks(r["ResourceName"] or "", terms)
        assert r["MaskedName"] == want
        assert {k: r[f"MaskHits{k.title()}"] for k in hits} == hits
        assert r["RemovedChars"] <= r["OriginalLength"]


def test_similarity_keeps_every_pair(spark):
    frame = spark.createDataFrame([(k, n) for k, n in enumerate(["alpha beta", "alpha  betas", "alphabeta", "gamma", "gamma ray", "ab", "delta one two", "delta one too"])], "index long, name string")
    weights = entities.gram_weights(frame).persist()
    vectors = {}
    for r in weights.collect():
        vectors.setdefault(r["index"], {})[r["gram"]] = r["weight"]
    for least in (0.3, 0.6, 0.8):
        want = {(i, j) for i in vectors for j in vectors if i < j and sum(w * vectors[j].get(g, 0) for g, w in vectors[i].items()) >= least}
        assert {(r["i"], r["j"]) for r in entities.similar_pairs(weights, least).collect()} == want


def test_extraction(spark):
    residues = spark.createDataFrame([("payroll-x",), ("boom",), ("a1",)], "residue string")

    def model(batch):
        if "boom" in batch:
            raise RuntimeError("down")
        return extraction.offline_model(batch)

    asked = spark.sparkContext.accumulator(0)
    got = {r["residue"]: [e["entity_name"] for e in r["entities"]] for r in extraction.extract(residues.coalesce(1), model, 1, asked).collect()}
    assert asked.value >= 3 and cli.model_named("offline", 0.5) is extraction.offline_model
    assert got == {"payroll-x": ["payroll"], "boom": [], "a1": []}
    assert extraction.validated("nonsense") == {} and extraction.validated({"results": [{"chunk": "a", "entities": [{"entity_name": 3}]}]}) == {"a": []}
    assert [extraction.batch_size(*v) for v in extraction.LIMITS.values()] == [2475, 1475, 275]


def test_model_is_asked_again_and_remembered(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def model(batch):
        place = calls / re.sub("[^a-z]", "", "".join(sorted(batch)))
        with open(place, "a") as f:
            f.write("x")
        if "never" in batch or place.stat().st_size <= 2:
            raise TimeoutError("busy")
        return extraction.offline_model(batch)

    asked = lambda: sum(f.stat().st_size for f in calls.iterdir())
    words = ["payroll", "ledger", "core"]
    residues = spark.createDataFrame([(w,) for w in [*words, *words, "never"]], "residue string")
    path, retry, failures = str(tmp_path / "answers"), extraction.Retry(0.01, 2, 0.1, 1.0), spark.sparkContext.accumulator(0)
    run = lambda name, again=retry: {r["residue"]: r["entities"] for r in extraction.remembered(residues, model, name, path, 1, again, 2, failures).collect()}
    got = run("m")
    assert [got[w][0]["entity_name"] for w in words] == words and got["never"] is None and failures.value == 1
    before = asked()
    assert run("m", extraction.NO_RETRY) == got and asked() == before + 1  # only what failed is asked for
    run("other")
    assert asked() > before + 4  # another model has answers of its own
    once = extraction.Retry(0.01, 2, 0.1, 5.0, lambda error: not isinstance(error, TimeoutError))
    with pytest.raises(TimeoutError):
        once.call(model, ["never"])


def cost_row(day, resource, cost, tags="{}"):
    row = {n: "x" for n, _, level in SPEC if level == "mandatory"}
    row |= {n: "1.5" for n, k, _ in SPEC if k == "decimal" and n in row}
    row |= {n: f"2025-01-{day:02d}T00:00:00Z" for n, k, _ in SPEC if k == "time"}
    return row | {"ResourceId": f"/s/1/resourcegroups/g/{resource}", "ResourceName": resource, "EffectiveCost": cost, "Tags": tags, "x_Extra": "gone"}


@pytest.fixture
def cost_files(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    names = ["payroll-prod-vm", "payroll-dev-vm", "payroll-app-01", "payrollapp", "ledger-prod-weu", "ledger-prod-eus", "ledger-app-7", "ledgerapp12"]
    rows = [cost_row(d, n, f"{d}.25", '[{"Key":"a","Value":"b, ""c"""}]'.replace('""', '\\"')) for d in (1, 2) for n in names]
    with open(folder / "good.csv", "w", newline="") as f:
        w = csv.DictWriter(f, list(rows[0]))
        w.writeheader()
        w.writerows([*rows, cost_row(3, "odd-name", "no cost")])
    (folder / "bad.csv").write_text("Column1,Column2\n1,2\n")
    return folder


def test_ingest_and_month(spark, tmp_path, cost_files):
    base = str(tmp_path / "out")
    result = ingest.IngestionService(spark, base, "t").ingest(f"{cost_files}/*.csv")
    assert (result.files_processed, len(result.files_failed), result.rows_processed, result.rejected_cells, result.partitions_written) == (1, 1, 17, 1, 3)
    assert result.rows_by_day == {"2025-01-01": 8, "2025-01-02": 8, "2025-01-03": 1}
    more = ingest.IngestionService(spark, str(tmp_path / "more"), "t", overwrite=False, multi_line=False)
    assert more.ingest(f"{cost_files}/good.csv").rows_by_day == more.ingest(f"{cost_files}/good.csv").rows_by_day == result.rows_by_day
    days = ingest.read_days(spark, ingest.dataset_path(base, "t"))
    assert days.columns == SCHEMA.names and {r["month"] for r in days.select("month").distinct().collect()} == {"01"}
    ingest.IngestionService(spark, base, "t").ingest(f"{cost_files}/good.csv")
    assert ingest.read_days(spark, ingest.dataset_path(base, "t")).count() == 17  # the days were replaced
    assert ingest.partition_path("b", "t", 2025, 1, 1) == "b/t/parquet/costs_raw/year=2025/month=01/day=01"
    with pytest.raises(ingest.MissingColumns):
        ingest.check_columns(MANDATORY[1:])
    with pytest.raises(views.EmptyMonth):
        cli.month_frame(spark, base, "t", 2024, "01")
    cli.run_audit(spark, base, "t", 2025, "01")
    cli.run_agent(spark, base, "t", 2025, "01")
    document = cli.run_merge(spark, base, "t", 2025, "01")
    assert {"payroll", "ledger"} <= {e["entity_name"] for e in document["distinct_entities"]} | {g["canonical"] for g in document["groups"]}
    report = cli.run_report(spark, base, "t", 2025, "01")
    assert report["scorecard"].first()["num_groups"] == len(document["groups"]) and report["entity_costs"].count() > 0
    assert spark.read.parquet(store.month_path(base, "t", "report/scorecard", 2025, "01", "p5", "parquet")).count() == 1
    assert views.describe(spark, "resources_per_day")[0]["column_name"] == "ResourceId"


def test_bad_lines_are_kept_apart(spark, tmp_path, cost_files):
    base, good = str(tmp_path / "out"), (cost_files / "good.csv").read_text()
    extra = good.splitlines()[1] + ",more"
    quoted = '"a, ""b""\nc",short'
    (cost_files / "good.csv").write_text(good + f"broken,line\n{extra}\n{quoted}\n")
    result = ingest.IngestionService(spark, base, "t").ingest(f"{cost_files}/good.csv", "first run")
    assert (result.run, result.rows_processed, result.refused_lines, result.rejected_cells) == ("first_run", 17, 3, 1)
    days = ingest.read_days(spark, ingest.dataset_path(base, "t"))
    assert days.count() == 17 and not days.where("year = 1970").count()  # no row of nulls
    width = len(next(csv.reader(good.splitlines())))
    refused = {(r["line"], r["reason"], r["file"].rsplit("/", 1)[1]) for r in ingest.read_refused(spark, base, "t").collect()}
    assert refused == {("broken,line", f"2 fields for {width} columns", "good.csv"), (extra, f"{width + 1} fields for {width} columns", "good.csv"), (quoted, f"2 fields for {width} columns", "good.csv")}
    for _ in range(2):
        ingest.IngestionService(spark, base, "u").ingest(f"{cost_files}/bad.csv", "only bad")
    failed = ingest.read_ledger(spark, base, "u").collect()
    assert [(r["run"], r["rows"]) for r in failed] == [("only_bad", 0)] and "lacks BilledCost" in failed[0]["error"]
    ledger = [tuple(r) for r in ingest.read_ledger(spark, base, "t").select("run", "rows", "refused", "rejected_cells").collect()]
    assert ledger == [("first_run", 17, 3, 1)]
    assert ingest.read_ledger(spark, base, "nobody").count() == ingest.read_refused(spark, base, "nobody").count() == 0


def test_a_repeated_run_replaces_what_it_left(spark, tmp_path, cost_files):
    base = str(tmp_path / "out")
    service = ingest.IngestionService(spark, base, "t", overwrite=False)
    for run in ("a", "a", "b", "a"):
        service.ingest(f"{cost_files}/*.csv", run)
    assert ingest.read_days(spark, ingest.dataset_path(base, "t")).count() == 2 * 17
    ledger = ingest.read_ledger(spark, base, "t").collect()  # of each run the file that was read and the one that was not
    assert sorted((r["run"], r["rows"], r["error"] is None) for r in ledger) == [("a", 0, False), ("a", 17, True), ("b", 0, False), ("b", 17, True)]


def test_stream_lands_each_batch_once(spark, tmp_path, cost_files, monkeypatch):
    """A stream that stops after a batch is written and before Spark knows of it writes no row twice."""
    base, state = str(tmp_path / "out"), str(tmp_path / "state")
    good = (cost_files / "good.csv").read_text().splitlines()
    (cost_files / "bad.csv").unlink()
    for k in range(3):
        (cost_files / f"more{k}.csv").write_text("\n".join([good[0], *good[1 + k :], "broken,line"]) + "\n")
    (cost_files / "good.csv").unlink()
    names, written, whole = next(csv.reader(good)), [], files.land_batch

    def stops(rows, batch, *rest):
        whole(rows, batch, *rest)
        written.append(batch)
        if len(written) == 2:
            raise RuntimeError("lost before the commit")

    monkeypatch.setattr(files, "land_batch", stops)
    with pytest.raises(Exception, match="lost before the commit"):
        files.stream_costs(spark, str(cost_files), names, base, "t", state, files=1).awaitTermination()
    for _ in range(2):
        files.stream_costs(spark, str(cost_files), names, base, "t", state, files=1).awaitTermination()
    assert written == [0, 1, 1, 2]  # the second batch ran twice
    assert ingest.read_days(spark, ingest.dataset_path(base, "t")).count() == 17 + 16 + 15
    assert ingest.read_refused(spark, base, "t").count() == 3 and ingest.read_ledger(spark, base, "t").count() == 3


def test_tables_of_an_application_are_swept(spark):
    place = store.scratch(spark)
    rows = store.held(spark.range(3), "some")
    assert rows.count() == 3 and all(place.rsplit("/", 1)[1] in f for f in rows.inputFiles())
    other = store.held(spark.range(4), "other")
    store.discard(rows)
    assert other.count() == 4 and not any(store.exists(spark, f) for f in rows.inputFiles())


def test_store_documents(spark, tmp_path):
    path = str(tmp_path / "t" / "known.yaml")
    assert store.read_yaml(spark, path) == {} and not store.exists(spark, path)
    store.write_yaml(spark, {"known_entities": [{"entity_name": "a"}, 3]}, path)
    assert store.known_entities(spark, path) == [{"entity_name": "a"}] and store.known_entities(spark, path + "x") == []
    store.copy(spark, path, str(tmp_path / "copy.yaml"))
    assert store.remove(spark, path) and not store.remove(spark, path) and store.exists(spark, str(tmp_path / "copy.yaml"))
    store.write_text(spark, "a: [", path)
    assert store.read_yaml(spark, path) == {}
    store.write_header(spark, ["a", "b,c"], str(tmp_path / "empty.csv"))
    assert spark.read.csv(str(tmp_path / "empty.csv"), header=True).columns == ["a", "b,c"]
    store.make_dirs(spark, str(tmp_path / "new" / "folder"))
    assert store.exists(spark, str(tmp_path / "new" / "folder"))
    assert store.all_terms(["Payroll", "sql"], Terms.of(["SQL"], ["dev"], ["weu"])) == ["payroll", "dev", "sql", "weu"]
