"""Command line: ingest, audit, agent, merge and report for one tenant."""

from __future__ import annotations

import argparse
import datetime as dt
import importlib
import logging
import os
from logging.handlers import RotatingFileHandler

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions.scalars import normalized
from .operators import audit, entities, extraction, incremental, reports, views
from .sources import ingest, store

log = logging.getLogger("costlens")
ENTITY = "entity_name string, abbreviations array<string>, found_in_chunks array<string>"


def set_up_logging(level: str = "INFO", path: str | None = None, most_bytes: int = 10_000_000, keep: int = 5) -> None:
    handlers: list[logging.Handler] = [logging.StreamHandler()]
    if path:
        handlers.append(RotatingFileHandler(path, maxBytes=most_bytes, backupCount=keep))
    logging.basicConfig(level=level, handlers=handlers, format="%(asctime)s %(levelname)s %(name)s: %(message)s")


def month_frame(spark: SparkSession, base: str, tenant: str, year: int, month: str) -> DataFrame:
    """The audited month: costs by resource with normalised texts. Raises EmptyMonth if there are none."""
    views.create_views(spark, ingest.read_days(spark, ingest.dataset_path(base, tenant)))
    rows = views.monthly(spark.table("resources_per_day_json"), year, month)
    text = ["ResourceId", "ResourceName", "BillingAccountName", "SubAccountName", "Tags", "ResourceGroup"]
    return views.require_rows(rows.withColumns({c: normalized(F.col(c)) for c in text}), f"{year}-{month}")


def run_audit(spark: SparkSession, base: str, tenant: str, year: int, month: str) -> None:
    place = lambda stem, phase, kind="parquet": store.month_path(base, tenant, stem, year, month, phase, kind)
    folder = f"{base.rstrip('/')}/{tenant}/config"
    store.init_tenant(spark, folder)
    terms = store.load_terms(spark, folder)
    report = audit.report(month_frame(spark, base, tenant, year, month), terms)
    store.write_table(report, place("audit_readiness", "p1"))
    report = spark.read.parquet(place("audit_readiness", "p1"))
    for name, frame in (("protect_set", audit.protect_by_frequency(report, terms)), ("protect_set_cost", audit.protect_by_cost(report, terms))):
        store.write_table(frame, place(name, "p2"))
    frequent, costly = (spark.read.parquet(place(n, "p2")) for n in ("protect_set", "protect_set_cost"))
    store.write_table(reports.protect_categories(audit.protect_combined(frequent, costly)), place("protect_set_combined", "p2"))
    chunks = [r[0] for r in frequent.select("Chunk").collect()]
    store.write_table(audit.glued_coverage(report, chunks, terms), place("glued_phase2_results", "p2"))
    glued = spark.read.parquet(place("glued_phase2_results", "p2")).select("ResourceId", "GluedExplained")
    rollup = audit.corpus_rollup(report.join(glued, "ResourceId", "left")).join(audit.top_tokens(report, terms), ["ScopeType", "ScopeValue"], "left")
    store.write_table(rollup, place("corpus_readiness_summary", "p2"))
    found = audit.suggested_entities(report, frequent.select("Chunk")).withColumn("abbreviations", F.array().cast("array<string>"))
    store.write_table(found, place("suggested_entities", "p2"))


def model_named(name: str, temperature: float) -> extraction.Model:
    """A model by ``module:function``; the function is called with the temperature and gives the model. ``offline`` is the
    stand-in, which has no temperature."""
    if name == "offline":
        return extraction.offline_model
    module, _, made = name.partition(":")
    return getattr(importlib.import_module(module), made)(temperature)


def run_report(spark: SparkSession, base: str, tenant: str, year: int, month: str) -> dict[str, DataFrame]:
    """What a dashboard shows of a month, as tables in audit/report.<year>_<month>: distributions, scopes, protected chunks,
    groups and what they cost. Parts whose inputs are not there yet are left out."""
    place = lambda stem, phase, kind="parquet": store.month_path(base, tenant, stem, year, month, phase, kind)
    rows = spark.read.parquet(place("audit_readiness", "p1"))
    out = {
        "residual_length": reports.histogram(rows, "ResidualLength", 50), "lengths": reports.density(rows, "OriginalLength", "ResidualLength"),
        "removed_by_account": reports.box(rows, "SubAccountName", "RemovedChars"),
        "scopes": reports.extremes(spark.read.parquet(place("corpus_readiness_summary", "p2")), "SubAccountName", "PctRemovedMean"),
        "protected": spark.read.parquet(place("protect_set_combined", "p2")),
    }
    document = store.read_document(spark, place("master_suggested_entities", "p4", "json"))
    if document:
        member = "array<struct<entity_name:string,similarity:double,link_type:string>>"
        grouped = spark.createDataFrame([(g["canonical"], g["found_in_chunks"], g["members"]) for g in document["groups"]], f"canonical string, found_in_chunks array<string>, members {member}")
        distinct = spark.createDataFrame([(e["entity_name"], e["found_in_chunks"]) for e in document["distinct_entities"]], "entity_name string, found_in_chunks array<string>")
        every = grouped.select(F.col("canonical").alias("entity_name"), "found_in_chunks", F.size("members").alias("num_members")).unionByName(distinct.withColumn("num_members", F.lit(0)))
        costs = store.held(entities.entity_costs(every, rows), "costs")
        members = grouped.select("canonical", F.explode("members").alias("m")).select("canonical", "m.*")
        out |= {"entity_costs": costs, "groups": reports.costliest_groups(costs), "coverage": entities.top_coverage(costs, 10), "scorecard": entities.scorecard(members, distinct, costs)}
    for name, frame in out.items():
        store.write_table(frame, place(f"report/{name}", "p5"))
    return out


def run_agent(spark: SparkSession, base: str, tenant: str, year: int, month: str, model: extraction.Model = extraction.offline_model, size: str = "small", name: str = "offline", retry: extraction.Retry = extraction.Retry()) -> int:
    """Writes the entities that a model finds in a month's residues; gives how many residues it failed on. Answers are kept
    by the model's name in the tenant's folder, and asked for once."""
    place = lambda stem, phase: store.month_path(base, tenant, stem, year, month, phase, "parquet")
    residues = extraction.clean_residues(spark.read.parquet(place("audit_readiness", "p1")), spark.read.parquet(place("protect_set", "p2")).select("Chunk"))
    found = store.held(extraction.remembered(residues, model, name, f"{base.rstrip('/')}/{tenant}/audit/answers", extraction.batch_size(*extraction.LIMITS[size]), retry), "found")
    failed = found.where("entities IS NULL").count()
    if failed:
        log.warning("the model failed on %d residues; another run asks for them", failed)
    store.write_table(extraction.by_entity(found), place("suggested_entities", "p3"))
    return failed


def run_merge(spark: SparkSession, base: str, tenant: str, year: int, month: str) -> dict:
    place = lambda stem, phase: store.month_path(base, tenant, stem, year, month, phase, "parquet")
    merged = store.held(entities.merge(*(store.read_table(spark, place("suggested_entities", p), ENTITY) for p in ("p2", "p3"))), "merged")
    names = merged.select(F.col("entity_name").alias("name"), (F.row_number().over(Window.orderBy(F.col("validation_source")[0].desc(), "entity_name")) - 1).cast("long").alias("index"))
    names = store.held(names, "names")
    members = entities.groups(names, store.held(entities.links(entities.first_neighbours(store.held(entities.gram_weights(names), "weights"))), "links"))
    grouped, distinct = entities.master(merged, store.held(members, "members"))
    document = store.master_document(grouped, distinct, year, month, dt.datetime.now().isoformat())
    store.write_document(spark, document, store.month_path(base, tenant, "master_suggested_entities", year, month, "p4", "json"))
    return document


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="costlens", description=__doc__)
    kinds = out.add_subparsers(dest="command", required=True)
    for name in ("ingest", "audit", "agent", "merge", "report"):
        p = kinds.add_parser(name)
        p.add_argument("--tenant", required=True)
        p.add_argument("--output-base", required=True)
        p.add_argument("--log-level", default="INFO")
        p.add_argument("--log-file")
        p.add_argument("--log-dir", help="folder of a log file named after the command")
        if name == "ingest":
            p.add_argument("--input", required=True)
            p.add_argument("--fs", default="", help="scheme and authority of paths without one, as in hdfs://host")
            p.add_argument("--batch-size", type=int, default=100_000, help="KiB of a file that a task reads at a time")
            p.add_argument("--multi-line", action=argparse.BooleanOptionalAction, default=True)
            p.add_argument("--compression", default="snappy")
            p.add_argument("--overwrite", action=argparse.BooleanOptionalAction, default=True)
            p.add_argument("--run", help="name of the run; a run of the same name replaces what it left")
            p.add_argument("--keep-views", action="store_true", help="bring the kept resource-day view up to date")
        else:
            p.add_argument("--year", type=int, required=True)
            p.add_argument("--month", required=True)
        if name == "agent":
            p.add_argument("--llm-model", default="offline", help="offline, or module:function that makes a model of a temperature")
            p.add_argument("--temperature", type=float, default=0.0)
            p.add_argument("--model-size", choices=sorted(extraction.LIMITS), default="small")
    return out


def main(args: list[str] | None = None) -> None:
    a = parser().parse_args(args)
    set_up_logging(a.log_level, a.log_file or (os.path.join(a.log_dir, f"{a.command}.log") if a.log_dir else None))
    spark = SparkSession.builder.appName("costlens").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.command == "ingest":
        at = lambda path: path if "://" in path or not a.fs else a.fs.rstrip("/") + "/" + path.lstrip("/")
        spark.conf.set("spark.sql.files.maxPartitionBytes", a.batch_size * 1024)
        result = ingest.IngestionService(spark, at(a.output_base), a.tenant, a.compression, a.overwrite, a.multi_line).ingest(at(a.input), a.run)
        log.info("%s", result)
        if result.refused_lines:
            log.warning("%d lines refused, see %s", result.refused_lines, ingest.dataset_path(at(a.output_base), a.tenant, ingest.REFUSED))
        if a.keep_views:
            incremental.refresh(spark, at(a.output_base), a.tenant, result.rows_by_day)
        return
    month = f"{int(a.month):02d}"
    if a.command == "audit":
        run_audit(spark, a.output_base, a.tenant, a.year, month)
    elif a.command == "agent":
        run_agent(spark, a.output_base, a.tenant, a.year, month, model_named(a.llm_model, a.temperature), a.model_size, f"{a.llm_model} at {a.temperature:g}")
    elif a.command == "report":
        run_report(spark, a.output_base, a.tenant, a.year, month)
    else:
        run_merge(spark, a.output_base, a.tenant, a.year, month)


if __name__ == "__main__":
    main()
