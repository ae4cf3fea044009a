"""The registered queries: operators on frames made from the provided tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import json_text, scalars
from ..functions.masks import Terms
from ..operators import audit, entities, extraction, incremental, reports, views
from ..sources import datasource, ingest, store
from ..sources.spec import SPEC
from ..sources.tables import ENV_TERMS, REG_TERMS, TECH_TERMS, entity_names, named_resources, order_files, rollup_costs, table
from ..streaming import files
from .oracles import ORACLE_SQL as ORACLE_SQL

TERMS = Terms.of(TECH_TERMS, ENV_TERMS, REG_TERMS)
#: The audited month.
YEAR, MONTH = 1996, "12"


def _rounded(frame: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to ``digits`` places, so that engines that add in another order agree."""
    return frame.select(*(F.round(c, digits).alias(c) if k == "double" else F.col(c) for c, k in frame.dtypes))


def resources_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.resources_per_day(rollup_costs(spark, sf_dir))


def resources_per_day_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.resources_per_day_json(resources_per_day(spark, sf_dir))


def state_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.resource_daily_aggregated_state(resources_per_day_json(spark, sf_dir))


def monthly_resource_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.monthly(resources_per_day_json(spark, sf_dir), YEAR, MONTH)


def tags_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = named_resources(spark, sf_dir)
    return views.tags_index(rows, ["ResourceId", "BillingAccountName", "SubAccountName"])


def tag_json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = json_text.tag_pairs(F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", F.size(pairs).cast("long").alias("n_pairs"), F.array_join(F.transform(pairs, lambda p: F.concat(p["key"], F.lit("="), p["value"])), ";").alias("pairs"))


def resource_group_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = rollup_costs(spark, sf_dir).select("ResourceId").distinct()
    return ids.select("ResourceId", views.day_resource_group(F.col("ResourceId")).alias("day_group"), views.month_resource_group(F.col("ResourceId")).alias("month_group"))


def date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, k = table(spark, sf_dir, "orders"), F.col("o_orderkey") % 6
    day, iso = F.date_format("o_orderdate", "yyyy-MM-dd"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    text = F.when(k == 0, day).when(k == 1, F.concat(iso, F.lit("Z"))).when(k == 2, F.concat(iso, F.lit("+02:00"))).when(k == 3, F.lit(" ")).when(k == 4, F.concat(F.lit("not "), day)).otherwise(F.concat(F.replace(iso, F.lit("T"), F.lit(" ")), F.lit(" UTC")))
    return orders.select("o_orderkey", F.to_timestamp_ntz(F.date_format(scalars.to_time(text), "yyyy-MM-dd HH:mm:ss")).alias("parsed"))


def decimal_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, k = table(spark, sf_dir, "orders"), F.col("o_orderkey") % 5
    cents = (F.col("o_totalprice") * 100).cast("long")
    plain = F.concat((cents / 100).cast("long").cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))
    text = F.when(k == 0, F.concat(F.lit("$"), plain)).when(k == 1, F.concat(F.lit("1,"), F.lpad((cents % 1000).cast("string"), 3, "0"))).when(k == 2, "no number").when(k == 3, "1000000").otherwise(plain)
    return orders.select("o_orderkey", scalars.to_cost(text).cast("decimal(18,4)").alias("cost"))


def charge_period_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    end = F.when(F.col("l_linenumber") == 4, None).otherwise(F.col("l_shipdate") + F.make_dt_interval(days=F.col("l_linenumber") % 3))
    return lines.select(scalars.is_daily_period(F.col("l_shipdate"), end).alias("daily"), "l_linenumber").groupBy("l_linenumber", "daily").agg(F.count("*").alias("n"))


def null_safe_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = audit.without_excluded(named_resources(spark, sf_dir))
    return kept.groupBy("ResourceType").agg(F.count("*").alias("n"))


def entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(table(spark, sf_dir, "pages").select("page_id", scalars.entropy(F.col("url")).alias("entropy")))


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.report(named_resources(spark, sf_dir), TERMS)


def mask_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["ResourceId", "MaskedName", "ResidualPreview", "OriginalLength", "RemovedChars", "PercentRemoved", "ResidualLength", "EntropyOriginal", "EntropyResidual", "MaskHitsTotal", "MaskHitsGuid", "MaskHitsHex", "MaskHitsTech", "MaskHitsEnv", "MaskHitsReg", "MaskHitsNum"]
    rows = report(spark, sf_dir).select(*names)
    return _rounded(rows.select(*(F.col(c).cast("long").alias(c) if k == "int" else F.col(c) for c, k in rows.dtypes)))


def phase1_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(spark, sf_dir).select("ResourceId", "OverstripFlag", "AcronymOnlyResidual", "HeavyScaffold", "IsGlued", "EnvConflict")


def embedded_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(spark, sf_dir).where("IsGlued").select("ResourceId", F.array_join("EmbeddedEnvList", "|").alias("env"), F.array_join("EmbeddedTechList", "|").alias("tech"))


def protect_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = audit.protect_by_frequency(report(spark, sf_dir), TERMS)
    return found.select("Chunk", "DisplayForm", F.col("Length").cast("long").alias("Length"), "SupportNames", "SpreadSubAccounts", "SpreadResourceGroups", "SampleName1", "SampleName2")


def _cost_set(rows: DataFrame) -> DataFrame:
    return audit.protect_by_cost(rows, TERMS)


def protect_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _cost_set(store.held(report(spark, sf_dir), "report"))
    return _rounded(found.select("Chunk", "DisplayForm", "SupportNames", F.col("TotalCost").cast("decimal(38,4)").alias("TotalCost"), "CostPercentOfTotal"))


def protect_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = store.held(report(spark, sf_dir), "report")
    both = reports.protect_categories(audit.protect_combined(audit.protect_by_frequency(rows, TERMS), _cost_set(rows)), 1)
    return _rounded(both.select("Chunk", "SupportNames", F.col("TotalCost").cast("decimal(38,4)").alias("TotalCost"), "InFrequencySet", "InCostSet", "category", "log_support", F.round("log_cost", 4).alias("log_cost"), F.col("scaled_spread").cast("long").alias("scaled_spread")))


def suggested_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = store.held(report(spark, sf_dir), "report")
    found = audit.suggested_entities(rows, audit.protect_by_frequency(rows, TERMS).select("Chunk"))
    return found.select("entity_name", F.size("found_in_chunks").cast("long").alias("n_names"), F.md5(F.array_join("found_in_chunks", "|")).alias("names_md5"))


def _covered(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = store.held(report(spark, sf_dir), "report")
    chunks = [r[0] for r in audit.protect_by_frequency(rows, TERMS).select("Chunk").collect()]  # capped at 500
    return rows, audit.glued_coverage(rows, chunks, TERMS)


def glued_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = F.from_json("ProtectedHits", "array<struct<Chunk:string,start:long,end:long>>")
    covered = F.aggregate(hits, F.lit(0).cast("long"), lambda n, h: n + h["end"] - h["start"])
    return _covered(spark, sf_dir)[1].select("ResourceId", covered.alias("CoveredChars"), "GluedExplained", F.col("CoverageFailOffset").cast("long").alias("CoverageFailOffset"), "GluedMaskedString")


def hit_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Protected chunks and classes that were found in each glued name, with their places."""
    rows = _covered(spark, sf_dir)[1]
    place = "start:long,end:long"
    hits = F.transform(F.from_json("ProtectedHits", f"array<struct<Chunk:string,{place}>>"), lambda h: F.struct(F.lit("chunk").alias("kind"), h["Chunk"].alias("found"), h["start"].alias("start"), h["end"].alias("end")))
    classes = F.transform(F.from_json("CoverageSequence", f"array<struct<class:string,{place}>>"), lambda h: F.struct(F.lit("class").alias("kind"), h["class"].alias("found"), h["start"].alias("start"), h["end"].alias("end")))
    return rows.select("ResourceId", F.explode(F.concat(hits, classes)).alias("h")).select("ResourceId", "h.*")


def corpus_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, covered = _covered(spark, sf_dir)
    return _rounded(audit.corpus_rollup(rows.join(covered.select("ResourceId", "GluedExplained"), "ResourceId", "left")))


def topn_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = audit.corpus_rollup(report(spark, sf_dir).withColumn("GluedExplained", F.lit(None).cast("boolean")))
    return _rounded(reports.extremes(rows, "BillingAccountName", "PctRemovedMean", 15))


def top_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.top_tokens(report(spark, sf_dir), TERMS)


def _residues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Residues that contain no protected chunk."""
    rows = store.held(report(spark, sf_dir), "report")
    return extraction.clean_residues(rows, audit.protect_by_frequency(rows, TERMS).select("Chunk"))


def residue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _residues(spark, sf_dir).groupBy("residue").agg(F.count("*").alias("n"))


def extracted_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = f"{store.scratch(spark)}/answers-{uuid.uuid4().hex}"
    found = extraction.by_entity(extraction.remembered(_residues(spark, sf_dir), extraction.offline_model, "offline", answers))
    return found.select("entity_name", F.size("found_in_chunks").cast("long").alias("n_residues"))


def tfidf_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(entities.similar_pairs(entities.gram_weights(entity_names(spark, sf_dir)), most=None))  # the tables may have more names than the bound


def _edges(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    names = store.held(entity_names(spark, sf_dir), "names")
    weights = store.held(entities.gram_weights(names), "weights")
    return names, store.held(entities.links(entities.first_neighbours(weights)), "links")


def entity_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_edges(spark, sf_dir)[1])


def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.components(_edges(spark, sf_dir)[1])


def entity_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(entities.groups(*_edges(spark, sf_dir)), 3)


def _suggestions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two lists over the entity names: every name with its first word, and every third with its last."""
    names = entity_names(spark, sf_dir)
    words = F.split("name", " ")
    none = F.array().cast("array<string>")
    p2 = names.select(F.col("name").alias("entity_name"), none.alias("abbreviations"), F.array(words[0]).alias("found_in_chunks"))
    p3 = names.where(F.col("index") % 3 == 0).select(F.col("name").alias("entity_name"), F.array(F.substring("name", 1, 3)).alias("abbreviations"), F.array(F.element_at(words, -1)).alias("found_in_chunks"))
    return p2, p3


def entity_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = entities.merge(*_suggestions(spark, sf_dir))
    return merged.select("entity_name", *(F.array_join(c, "|").alias(c) for c in ("abbreviations", "found_in_chunks", "validation_source")))


def _master(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    members = store.held(entities.groups(*_edges(spark, sf_dir)), "members")
    merged = store.held(entities.merge(*_suggestions(spark, sf_dir)), "merged")
    return members, *(store.held(f, "master") for f in entities.master(merged, members))


def master_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = _master(spark, sf_dir)[1]
    return grouped.select("canonical", F.array_join("abbreviations", "|").alias("abbreviations"), F.array_join("found_in_chunks", "|").alias("found_in_chunks"), "status", F.size("members").cast("long").alias("n_members"))


def _costs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    members, grouped, distinct = _master(spark, sf_dir)
    every = grouped.select(F.col("canonical").alias("entity_name"), "found_in_chunks", F.size("members").alias("num_members")).unionByName(distinct.select("entity_name", "found_in_chunks", F.lit(0).alias("num_members")))
    return members, distinct, store.held(entities.entity_costs(every, store.held(named_resources(spark, sf_dir), "resources")), "costs")


def entity_cost_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    costs = _costs(spark, sf_dir)[2]
    return _rounded(costs.select("entity_name", F.col("num_members").cast("long").alias("num_members"), F.col("cost").cast("decimal(38,4)").alias("cost"), "cost_pct_of_total", "cumulative_cost_pct"), 4)


def top_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(entities.top_coverage(_costs(spark, sf_dir)[2], 10), 4)


def top_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reports.costliest_groups(_costs(spark, sf_dir)[2])
    return found.select("entity_name", F.col("num_members").cast("long").alias("num_members"), F.col("cost").cast("decimal(38,4)").alias("cost"))


def scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(entities.scorecard(*_costs(spark, sf_dir)))


def violin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Density of removed characters by a flag, as the fitness page draws it."""
    return _rounded(reports.violin(report(spark, sf_dir), "HeavyScaffold", "RemovedChars"), 7)


def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.histogram(report(spark, sf_dir), "ResidualLength", 50)


def density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.density(report(spark, sf_dir), "OriginalLength", "ResidualLength")


def box(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(reports.box(report(spark, sf_dir).withColumn("RemovedChars", F.col("RemovedChars").cast("double")), "SubAccountName", "RemovedChars"))


#: Rows of one compressed cost file.
FILE_ROWS = 200_000


def _roundtrip(spark: SparkSession, sf_dir: str, multi_line: bool) -> DataFrame:
    base = f"{store.scratch(spark)}/roundtrip-{uuid.uuid4().hex}"
    rows = rollup_costs(spark, sf_dir)
    start = F.concat_ws("-", F.col("year").cast("string"), "month", "day")
    made = {"time": F.concat(start, F.lit("T00:00:00Z")), "decimal": F.lit("0.5"), "string": F.lit("a, \"b\""), "json": F.lit("{}")}
    columns = [F.col(n).cast("string").alias(n) if n in rows.columns else made[k].alias(n) for n, k, _ in SPEC]
    # a compressed file is a task's, so its rows have a bound
    rows.select(*columns).write.option("maxRecordsPerFile", FILE_ROWS).csv(f"{base}/in", header=True, escape='"', compression="gzip")
    ingest.IngestionService(spark, base, "t", multi_line=multi_line).ingest(f"{base}/in/*.csv.gz")
    days = ingest.read_days(spark, ingest.dataset_path(base, "t"))
    cost = F.sum(F.col("EffectiveCost").cast("decimal(18,4)")).cast("decimal(38,4)")
    return days.groupBy("year", "month", "day").agg(F.count("*").alias("n"), cost.alias("cost"), F.count("ResourceId").alias("with_id"), F.max("ServiceName").alias("service"))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All costs as CSV, ingested line by line, and read back by day."""
    return _roundtrip(spark, sf_dir, multi_line=False)


def csv_roundtrip_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with quoted fields that may span lines."""
    return _roundtrip(spark, sf_dir, multi_line=True)


def _landed(spark: SparkSession, sf_dir: str) -> str:
    base = f"{store.scratch(spark)}/orders-{uuid.uuid4().hex}"
    order_files(spark, sf_dir, f"{base}/in")
    # files of another kind, which lack the mandatory columns
    table(spark, sf_dir, "nation").repartition(2, "n_regionkey").write.csv(f"{base}/in/folder=9", header=True)
    ingest.IngestionService(spark, base, "t", multi_line=False).ingest(f"{base}/in/*/*.csv")
    return base


def _folder() -> Column:
    return F.regexp_extract("file", "folder=([0-9]+)", 1).cast("long").alias("folder")


def ingest_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of each folder's files."""
    ledger = ingest.read_ledger(spark, _landed(spark, sf_dir), "t")
    return ledger.groupBy(_folder()).agg(F.sum("rows").alias("n_rows"), F.sum("refused").alias("refused"), F.sum("rejected_cells").alias("rejected_cells"), F.max(F.col("error").startswith("file") & F.col("error").contains(" lacks BilledCost")).alias("failed"))


def refused_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with more or fewer fields than the header, with file and reason."""
    lines = ingest.read_refused(spark, _landed(spark, sf_dir), "t")
    return lines.select(_folder(), F.substring_index("line", ",", 1).cast("long").alias("key"), "reason")


def replayed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days after a stream's batches, each a folder of files, of which one is replayed."""
    base = f"{store.scratch(spark)}/stream-{uuid.uuid4().hex}"
    folders, names = order_files(spark, sf_dir, f"{base}/in"), [n for n, _, _ in SPEC]
    for batch in (0, 1, 1, *range(2, len(folders))):
        files.land_batch(ingest.read_csv(spark, [folders[batch]], names, multi_line=False), batch, base, "t", f"{base}/state")
    days = ingest.read_days(spark, ingest.dataset_path(base, "t"))
    return days.groupBy("year", "month", "day").agg(F.count("*").alias("n"), F.sum(F.col("EffectiveCost").cast("decimal(18,2)")).cast("decimal(38,2)").alias("cost"))


def _kept(spark: SparkSession, sf_dir: str) -> str:
    """Three ingests of overlapping days, each followed by a refresh of what it touched."""
    base = f"{store.scratch(spark)}/kept-{uuid.uuid4().hex}"
    folders = order_files(spark, sf_dir, f"{base}/in")
    service = ingest.IngestionService(spark, base, "t", overwrite=False, multi_line=False)
    for pattern in (f"{folders[0]}/*.csv", f"{folders[1]}/*.csv", f"{base}/in/folder=[23]/*.csv"):
        incremental.refresh(spark, base, "t", service.ingest(pattern).rows_by_day)
    return base


def incremental_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = incremental.per_day(spark, _kept(spark, sf_dir), "t")
    return days.select("ResourceId", "ResourceGroup", "ProviderName", "TotalEffectiveCost", "year", "month", "day")


def incremental_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.per_month(spark, _kept(spark, sf_dir), "t").select("ResourceId", "ResourceGroup", "Cost", "Tags", "year", "month")


def ordered_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots and states by day, read from the last of the views that build on each other."""
    last = views.create_views(spark, rollup_costs(spark, sf_dir))[-1]
    return spark.table(last).groupBy("SnapshotDate").agg(F.count("*").alias("n"), F.count_distinct("state_hash").alias("states"))


def guid_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masks of names with identifiers: with and without dashes, beside delimiters, and glued to letters."""
    key, md5 = F.col("o_orderkey"), F.md5(F.col("o_orderkey").cast("string"))
    dashed = F.regexp_replace(md5, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-")
    kind = key % 4
    name = F.when(kind == 0, F.concat(F.lit("app-"), dashed, F.lit("-prod"))).when(kind == 1, F.concat(F.lit("app_"), F.upper(md5))).when(kind == 2, F.concat(F.lit("zz"), md5, F.lit("zz"))).otherwise(F.concat(F.lit("/"), dashed, F.lit("."), md5, F.lit(":")))
    rows = table(spark, sf_dir, "orders").select(key.cast("string").alias("ResourceId"), name.alias("ResourceName"), F.lit("t").alias("ResourceType"))
    found = audit.masked(rows, TERMS)
    return found.select("ResourceId", "MaskedName", F.col("MaskHitsGuid").cast("long").alias("MaskHitsGuid"), F.col("RemovedChars").cast("long").alias("RemovedChars"), F.col("ResidualLength").cast("long").alias("ResidualLength"))


#: Letters that NFKC changes; their forms are in the SQL.
ODD = ["\ufb01", "\uff21\uff42", "e\u0301", "\u2460", "\u212b", "plain"]


def nfkc_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in their normal form and lower case, from ligatures, wide letters, marks, circled numbers and signs."""
    odd = F.element_at(F.array(*map(F.lit, ODD)), (F.col("p_partkey") % len(ODD) + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", scalars.normalized(F.concat(F.col("p_brand"), odd)).alias("name"))


def ingest_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ingest itself counted by day."""
    base = f"{store.scratch(spark)}/orders-{uuid.uuid4().hex}"
    order_files(spark, sf_dir, f"{base}/in")
    result = ingest.IngestionService(spark, base, "t", multi_line=False).ingest(f"{base}/in/*/*.csv")
    return spark.createDataFrame(list(result.rows_by_day.items()), "day string, n long")  # a row for each day


def registered_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days read through the registered format."""
    base = _landed(spark, sf_dir)
    datasource.register(spark)
    days = spark.read.format(datasource.NAME).options(path=base, tenant="t").load().where("year >= 1995")
    return days.groupBy("year", "month", "day").agg(F.count("*").alias("n"), F.sum(F.col("EffectiveCost").cast("decimal(18,2)")).cast("decimal(38,2)").alias("cost"))


def merged_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two suggestion lists, written as a month's files, read back and merged."""
    base, kind = f"{store.scratch(spark)}/lists-{uuid.uuid4().hex}", "entity_name string, abbreviations array<string>, found_in_chunks array<string>"
    places = [store.month_path(base, "t", "suggested_entities", YEAR, MONTH, p, "parquet") for p in ("p2", "p3", "p9")]
    for frame, place in zip(_suggestions(spark, sf_dir), places):
        store.write_table(frame, place)
    lists = [store.read_table(spark, place, kind) for place in places]
    merged = entities.merge(lists[0], lists[1].unionByName(lists[2]))  # the third file is absent
    return merged.select("entity_name", *(F.array_join(c, "|").alias(c) for c in ("abbreviations", "found_in_chunks", "validation_source")))


def acronyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each part's words and codes those that may be acronyms."""
    listed = F.concat(F.split("p_name", " "), F.split("p_type", " "), F.split("p_brand", "#"))
    rows = table(spark, sf_dir, "part").select("p_partkey", listed.alias("abbreviations"))
    return extraction.known_acronyms(rows).select("p_partkey", F.array_join("abbreviations", "|").alias("abbreviations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        resources_per_day, resources_per_day_json, state_hashes, monthly_resource_cost, tags_index, tag_json_parse, resource_group_extract, date_parse, decimal_parse,
        charge_period_check, null_safe_filter, entropy, mask_report, phase1_flags, embedded_terms, protect_freq, protect_cost, protect_combined, suggested_entities,
        glued_coverage, hit_lists, corpus_rollup, topn_scopes, top_tokens, residue, extracted_entities, tfidf_pairs, entity_links, components, entity_groups, entity_merge,
        master_groups, entity_cost_coverage, top_coverage, top_groups, scorecard, histogram, density, box, violin, csv_roundtrip, csv_roundtrip_days,
        ordered_views, guid_masks, nfkc_names, ingest_days, registered_source, merged_lists, acronyms, ingest_ledger, refused_lines, replayed_batches, incremental_days, incremental_months,
    )
}
