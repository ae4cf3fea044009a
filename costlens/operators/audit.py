"""The audit of resource names: masks and flags, protect sets, glued names, roll-ups by scope, suggested entities."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.automaton import Automaton, apart, folded
from ..functions.masks import CLASSES, DELIMITERS, LETTERS, Terms, alternation, placeholder
from ..functions.scalars import entropy
from ..sources.store import held
from .quantiles import quantiles, wide

OVERSTRIP, LEAST_RESIDUAL = 0.8, 3
ACRONYM = (3, 4)
SCAFFOLD, SCAFFOLD_HITS = 0.5, 3
CONFLICT = 2
EXCLUDED_TYPE = "Metric alert rule"
LEAST_SUPPORT, MOST_CHUNKS, LEAST_SHARE = 3, 500, 0.01
TOP_TOKENS = 5
MOST_CANDIDATES = 5000
SCOPES = ["SubAccountName", "ResourceGroup", "BillingAccountName"]


def without_excluded(resources: DataFrame, kind: str = EXCLUDED_TYPE) -> DataFrame:
    """Rows of other resource types; rows without a type stay."""
    return resources.where(~F.col("ResourceType").eqNullSafe(F.lit(kind)))


def masked(resources: DataFrame, terms: Terms) -> DataFrame:
    """Adds the masked name, its residual, lengths, hits by class and entropies. A null name counts as empty."""
    name = F.coalesce("ResourceName", F.lit(""))
    out = resources.withColumn("_m", name)
    hits, removed = {}, F.lit(0)
    for kind, pattern in terms.mask_patterns():
        before, mark = f"_{kind}", placeholder(kind)
        out = out.withColumn(before, F.col("_m")).withColumn("_m", F.regexp_replace("_m", pattern, mark))
        out = out.withColumn(f"MaskHits{kind.title()}", F.regexp_count(F.col(before), F.lit(pattern)))
        hits[kind] = F.col(f"MaskHits{kind.title()}")
    for kind, after in zip(CLASSES, [*(f"_{k}" for k in CLASSES[1:]), "_m"]):
        removed = removed + F.length(f"_{kind}") - F.length(after) + hits[kind] * len(placeholder(kind))
    residual = F.regexp_replace("_m", "|".join(placeholder(k) for k in CLASSES), "")
    residual = F.expr("trim(BOTH '-_' FROM _r)"), F.regexp_replace(residual, DELIMITERS, "-")
    out = out.withColumn("_r", residual[1]).withColumn("ResidualPreview", residual[0])
    total = sum((hits[k] for k in CLASSES), F.lit(0))
    out = out.withColumns({"MaskedName": F.col("_m"), "OriginalLength": F.length(name), "RemovedChars": removed, "ResidualLength": F.length("ResidualPreview"), "MaskHitsTotal": total})
    out = out.withColumns({"PercentRemoved": F.col("RemovedChars") / F.greatest(F.col("OriginalLength"), F.lit(1)), "EntropyOriginal": entropy(name), "EntropyResidual": entropy(F.col("ResidualPreview"))})
    return out.drop("_m", "_r", *(f"_{k}" for k in CLASSES))


def flagged(rows: DataFrame, terms: Terms) -> DataFrame:
    """Adds the quality flags of ``masked`` rows, and what terms glued names embed."""
    name = F.coalesce("ResourceName", F.lit(""))
    lower, none = F.lower(name), F.array().cast("array<string>")
    runs = F.regexp_extract_all("ResidualPreview", F.lit(LETTERS), 0)
    glued = ~name.contains("-") & ~name.contains("_")
    known = F.array(*map(F.lit, sorted(terms.env))) if terms.env else none
    env = F.when(glued, F.filter(known, lambda t: F.contains(lower, t))).otherwise(none)
    found = F.array_sort(F.array_distinct(F.regexp_extract_all(lower, F.lit(f"({alternation(terms.tech)})[0-9]+"), 1))) if terms.tech else none
    return rows.withColumns({
        "OverstripFlag": (F.col("PercentRemoved") > OVERSTRIP) | (F.col("ResidualLength") < LEAST_RESIDUAL),
        "AcronymOnlyResidual": (F.size(runs) > 0) & F.forall(runs, lambda r: F.length(r).between(*ACRONYM)),
        "HeavyScaffold": (F.col("PercentRemoved") >= SCAFFOLD) | (F.col("MaskHitsTotal") >= SCAFFOLD_HITS),
        "IsGlued": glued, "EmbeddedEnvList": env, "EmbeddedTechList": F.when(glued, found).otherwise(none),
    }).withColumn("EnvConflict", F.size("EmbeddedEnvList") >= CONFLICT)


def report(resources: DataFrame, terms: Terms) -> DataFrame:
    """The first phase's report."""
    return flagged(masked(without_excluded(resources), terms), terms)


def spans(resources: DataFrame, terms: Terms) -> DataFrame:
    """Runs of letters in delimited names, one row for each occurrence: the resource's columns, Variant and Chunk."""
    delimited = resources.where(F.coalesce(F.col("ResourceName").rlike(DELIMITERS), F.lit(False)))
    each = delimited.withColumn("Variant", F.explode(F.regexp_extract_all("ResourceName", F.lit(LETTERS), 0))).withColumn("Chunk", F.lower("Variant"))
    known = terms.everything()
    return each.where(~F.col("Chunk").isin(known)) if known else each


def display_forms(occurrences: DataFrame) -> DataFrame:
    """The variant of each chunk that occurs most; of equal ones a lower-case, else a title-case, else the least."""
    kind = F.when(F.col("Variant") == F.lower("Variant"), 0).when(F.col("Variant") == F.initcap("Variant"), 1).otherwise(2)
    counted = occurrences.groupBy("Chunk", "Variant").agg(F.count("*").alias("n"))
    return counted.groupBy("Chunk").agg(F.min_by("Variant", F.struct(-F.col("n"), kind, "Variant")).alias("DisplayForm"))


def numbered(values: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column, null being one, numbered from 0 without gaps: value, number."""
    made = held(values.select(F.col(column).alias("value")).distinct().withColumn("id", F.monotonically_increasing_id()), "numbers")
    part = F.shiftright("id", 33)
    sizes = made.groupBy(part.alias("part")).agg(F.count("*").alias("size"))  # a row for each partition
    before = F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = F.broadcast(sizes.select("part", before.alias("before")))
    return made.withColumn("part", part).join(starts, "part").select("value", (F.col("before") + F.col("id") - F.shiftleft("part", 33)).alias("number"))


def spreads(occurrences: DataFrame, columns: dict[str, str]) -> DataFrame:
    """How many distinct values each chunk has in some columns, null being one: Chunk and the names that ``columns`` gives.

    Values are bits of their numbers: a task adds a chunk's occurrences up to a few bitmaps, and these meet, not the values.
    """
    rows, buckets = occurrences.select("Chunk", *columns), []
    for c in columns:
        known = numbered(occurrences, c)
        rows = rows.join(known, rows[c].eqNullSafe(known["value"])).drop("value")
        rows = rows.withColumns({f"{c}_bucket": F.bitmap_bucket_number("number"), f"{c}_bit": F.bitmap_bit_position("number")}).drop("number", c)
        buckets.append(f"{c}_bucket")
    bits = rows.groupBy("Chunk", *buckets).agg(*(F.bitmap_construct_agg(f"{c}_bit").alias(f"{c}_bits") for c in columns))
    out = None
    for c, name in columns.items():
        met = bits.groupBy("Chunk", f"{c}_bucket").agg(F.bitmap_or_agg(f"{c}_bits").alias("bits"))
        counted = met.groupBy("Chunk").agg(F.sum(F.bitmap_count("bits")).alias(name))
        out = counted if out is None else out.join(counted, "Chunk")
    return out


def _support(occurrences: DataFrame) -> DataFrame:
    """Per chunk its length, support (distinct resources, null being one), spreads, cost, two sample names and form."""
    ends = lambda f, c, by, n: f(c, by).alias(n)
    by_name = occurrences.groupBy("Chunk", "ResourceId").agg(F.sum("Cost").alias("cost"), F.min("ResourceName").alias("low"), F.max("ResourceName").alias("high"))
    support = by_name.groupBy("Chunk").agg(
        F.length("Chunk").alias("Length"), F.count("*").alias("SupportNames"), F.sum("cost").alias("TotalCost"),
        ends(F.min_by, "low", "ResourceId", "SampleName1"), ends(F.max_by, "high", "ResourceId", "SampleName2"),
    )
    spread = spreads(occurrences, {"SubAccountName": "SpreadSubAccounts", "ResourceGroup": "SpreadResourceGroups"})
    return support.join(spread, "Chunk").join(display_forms(occurrences), "Chunk")


def protect_by_frequency(resources: DataFrame, terms: Terms, least: int = LEAST_SUPPORT, most: int = MOST_CHUNKS) -> DataFrame:
    """Chunks of ``least`` resources or more, the longest and most supported ``most`` of them, with two sample names."""
    sets = _support(spans(resources, terms)).drop("TotalCost").where(F.col("SupportNames") >= least)
    return sets.orderBy(F.desc("Length"), F.desc("SupportNames"), "Chunk").limit(most)


def protect_by_cost(resources: DataFrame, terms: Terms, least: float = LEAST_SHARE) -> DataFrame:
    """Chunks whose occurrences carry ``least`` of the total cost or more; none if the total is zero."""
    total = F.nullif(resources.agg(F.sum("Cost")).scalar().cast("double"), F.lit(0.0))
    sets = _support(spans(resources, terms)).drop("SampleName1", "SampleName2")
    share = F.col("TotalCost").cast("double") / total
    return sets.withColumn("CostPercentOfTotal", share).where(F.col("CostPercentOfTotal") >= least)


def protect_combined(by_frequency: DataFrame, by_cost: DataFrame) -> DataFrame:
    """Chunks of either set; shared columns come from the frequency side first."""
    shared = ["DisplayForm", "Length", "SupportNames", "SpreadSubAccounts", "SpreadResourceGroups"]
    f = by_frequency.select("Chunk", *shared, F.lit(True).alias("in")).alias("f")
    c = by_cost.select("Chunk", *shared, "TotalCost", "CostPercentOfTotal", F.lit(True).alias("in")).alias("c")
    both = f.join(c, "Chunk", "full_outer")
    return both.select("Chunk", *(F.coalesce(f"f.{k}", f"c.{k}").alias(k) for k in shared), F.coalesce("TotalCost", F.lit(0)).alias("TotalCost"), F.coalesce("CostPercentOfTotal", F.lit(0.0)).alias("CostPercentOfTotal"), F.coalesce("f.in", F.lit(False)).alias("InFrequencySet"), F.coalesce("c.in", F.lit(False)).alias("InCostSet"))


class Coverer:
    """Tells whether protected chunks and known classes explain names. One automaton finds chunks and terms at once."""

    def __init__(self, chunks: list[str], terms: Terms, without_hits: bool = True) -> None:
        self.chunks = sorted(set(chunks), key=lambda c: (-len(c), c))
        self.without_hits = without_hits
        patterns = terms.scan_patterns()
        self.rank = {k: i for i, (k, _) in enumerate(patterns)}
        words = {"TECH": terms.tech, "ENV": terms.env, "REG": terms.reg}
        self.patterns = [(k, re.compile(p)) for k, p in patterns if k not in words]
        listed = [(k, w) for k, known in words.items() for w in sorted(known) if w]
        self.kinds = [k for k, _ in listed]
        self.automaton = Automaton([*self.chunks, *(w for _, w in listed)])

    def cover(self, name: str) -> tuple[bool, list[dict], list[dict], int, str | None]:
        """Whether a name is explained, hits, sequence, first offset that fails, masked name. Of chunks the longest go first
        and none overlap; then at each place left to right the class that reaches farthest is taken."""
        name = unicodedata.normalize("NFKC", name)
        of_chunks, of_terms = [], {}
        for i, start, end in self.automaton.find(folded(name)):
            if i < len(self.chunks):
                of_chunks.append((i, start, end))
            elif apart(name, start, end):
                of_terms.setdefault(start, []).append((end, -self.rank[self.kinds[i - len(self.chunks)]]))
        covered, hits, last = bytearray(len(name)), [], (-1, 0)
        for i, start, end in sorted(of_chunks):
            if i == last[0] and start < last[1]:  # within the chunk's own occurrence before
                continue
            last = i, end
            if not any(covered[start:end]):
                covered[start:end] = b"\1" * (end - start)
                hits.append({"Chunk": self.chunks[i], "start": start, "end": end})
        if not hits and not self.without_hits:
            return False, hits, [], -1, None
        at, sequence = 0, []
        classes = {-rank: k for k, rank in self.rank.items()}
        while at < len(name):
            if covered[at] or name[at].isspace():
                at += 1
                continue
            found = [(m.end(), -self.rank[k]) for k, p in self.patterns if (m := p.match(name, at))] + of_terms.get(at, [])
            if not found:
                return False, hits, sequence, at, None
            end, rank = max(found)
            sequence.append({"class": classes[rank], "start": at, "end": end})
            covered[at:end] = b"\1" * (end - at)
            at = end
        pieces, done = [], 0
        for s in sequence:
            pieces += [name[done : s["start"]], placeholder(s["class"])]
            done = s["end"]
        return True, hits, sequence, -1, "".join(pieces) + name[done:]


COVERAGE = T.StructType([T.StructField("ResourceId", T.StringType()), T.StructField("GluedExplained", T.BooleanType()), T.StructField("ProtectedHits", T.StringType()), T.StructField("CoverageSequence", T.StringType()), T.StructField("CoverageFailOffset", T.IntegerType()), T.StructField("GluedMaskedString", T.StringType())])


def glued_coverage(rows: DataFrame, chunks: list[str], terms: Terms, without_hits: bool = True) -> DataFrame:
    """Coverage of each glued name of ``flagged`` rows. ``chunks`` is a protect set, whose size is capped."""

    def cover(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coverer = Coverer(chunks, terms, without_hits)
        for b in batches:
            out = [coverer.cover(n or "") for n in b["ResourceName"]]
            yield pd.DataFrame({"ResourceId": b["ResourceId"], "GluedExplained": [o[0] for o in out], "ProtectedHits": [json.dumps(o[1]) for o in out], "CoverageSequence": [json.dumps(o[2]) for o in out], "CoverageFailOffset": [o[3] for o in out], "GluedMaskedString": [o[4] for o in out]})

    return rows.where("IsGlued").select("ResourceId", "ResourceName").mapInPandas(cover, COVERAGE)


def _scope(frame: DataFrame) -> tuple[Column, Column]:
    """Type and value of the scope of a grouping set; bits of the id say which columns are left out."""
    which = F.col("gid")
    kind = F.when(which == 7, "overall").when(which == 3, SCOPES[0]).when(which == 5, SCOPES[1]).otherwise(SCOPES[2])
    value = F.when(which == 7, F.lit("overall")).otherwise(F.coalesce(*SCOPES))
    return kind, F.when(value == "", "overall").otherwise(value)


def _by_scope(frame: DataFrame, keys: list[str], aggregates: list[Column]) -> DataFrame:
    """Groups by the four scopes and ``keys`` in one pass; rows without a scope's value are in none of its groups."""
    sets = [[], *([s] for s in SCOPES)]
    grouped = frame.groupingSets([[*s, *keys] for s in sets], *SCOPES, *keys).agg(F.grouping_id(*SCOPES, *keys).alias("full"), *aggregates)
    grouped = grouped.withColumn("gid", F.shiftright("full", len(keys)))
    kind, value = _scope(grouped)
    return grouped.select(kind.alias("ScopeType"), value.alias("ScopeValue"), *keys, *(c for c in grouped.columns if c not in (*SCOPES, *keys, "gid", "full"))).where(F.col("ScopeValue").isNotNull())


#: Quantiles of the roll-up: column, measure and share.
QUANTILES = [("PctRemovedMedian", "PercentRemoved", 0.5), ("PctRemovedP90", "PercentRemoved", 0.9), ("ResidualLenMedian", "ResidualLength", 0.5), ("ResidualLenP10", "ResidualLength", 0.1), ("EntropyOrigMedian", "EntropyOriginal", 0.5), ("EntropyResidMedian", "EntropyResidual", 0.5)]


def corpus_rollup(rows: DataFrame) -> DataFrame:
    """Means, medians, quantiles and flag rates of ``flagged`` rows (with GluedExplained) by scope."""
    rate = lambda c: F.avg(F.col(c).cast("double")).alias(f"{c}Rate")
    glued = lambda c, n: F.avg(F.when(F.col("IsGlued"), c.cast("double"))).alias(n)
    scope = ["ScopeType", "ScopeValue"]
    means = _by_scope(rows, [], [
        F.count("*").alias("ResourceCount"), F.avg("PercentRemoved").alias("PctRemovedMean"), F.avg("ResidualLength").alias("ResidualLenMean"),
        F.avg("EntropyOriginal").alias("EntropyOrigMean"), F.avg("EntropyResidual").alias("EntropyResidMean"),
        rate("OverstripFlag"), rate("IsGlued"), rate("AcronymOnlyResidual"), rate("HeavyScaffold"), rate("EnvConflict"),
        glued(F.col("GluedExplained"), "GluedExplainedRate"), glued(F.size("EmbeddedEnvList") > 0, "EmbeddedEnvRate"),
    ])
    measures = sorted({m for _, m, _ in QUANTILES})
    each = rows.select(*SCOPES, F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures))).alias("m")).select(*SCOPES, "m.measure", "m.value")
    counts = _by_scope(each, ["measure", "value"], [F.count("*").alias("n")])
    found = quantiles(counts, [*scope, "measure"], sorted({q for _, _, q in QUANTILES}))
    return means.join(wide(found, scope, {n: (F.col("measure") == m) & (F.col("share") == q) for n, m, q in QUANTILES}), scope, "left")


def top_tokens(rows: DataFrame, terms: Terms, most: int = TOP_TOKENS) -> DataFrame:
    """Of each scope and class, the ``most`` frequent terms in names as ``term:count`` joined by bars."""
    lower = F.lower("ResourceName")
    patterns = {k: p for k, p in terms.scan_patterns() if k in ("TECH", "ENV", "REG")}

    def found_of(kind: str, pattern: str) -> Column:
        return F.transform(F.regexp_extract_all(lower, F.lit(pattern), 0), lambda t: F.struct(F.lit(kind).alias("Class"), t.alias("Token")))

    found = F.flatten(F.array(*(found_of(k, p) for k, p in patterns.items())))
    each = rows.where(F.col("ResourceName").isNotNull()).select(*SCOPES, F.explode(found).alias("t")).select(*SCOPES, "t.Class", "t.Token")
    counted = _by_scope(each, ["Class", "Token"], [F.count("*").alias("n")])
    w = Window.partitionBy("ScopeType", "ScopeValue", "Class").orderBy(F.desc("n"), F.desc(F.length("Token")), "Token")
    ranked = counted.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)
    text = F.concat("Token", F.lit(":"), F.col("n").cast("string"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", text.alias("t")))), lambda s: s["t"]), "|")
    wide = ranked.groupBy("ScopeType", "ScopeValue", "Class").agg(joined.alias("Top"))
    pick = lambda k: F.coalesce(F.max(F.when(F.col("Class") == k, F.col("Top"))), F.lit("")).alias(f"Top{k.title()}Tokens")
    return wide.groupBy("ScopeType", "ScopeValue").agg(pick("TECH"), pick("ENV"), pick("REG"))


class TooManyCandidates(ValueError):
    """More entity candidates than the cap."""


def suggested_entities(resources: DataFrame, chunks: DataFrame, most: int = MOST_CANDIDATES) -> DataFrame:
    """Chunks with the distinct names that contain them, ignoring case: entity_name, found_in_chunks.

    Chunks are runs of letters, and a run of a name is found by its own substrings: each name posts the parts of its
    letter runs whose lengths chunks have, and chunks meet them by equality, so that no join goes over all pairs.
    """
    if chunks.limit(most + 1).count() > most:
        raise TooManyCandidates(f"more than {most} candidates")
    names = resources.where(F.col("ResourceName").isNotNull()).select("ResourceName").distinct()
    lengths = sorted(r[0] for r in chunks.select(F.length("Chunk")).distinct().collect())  # bounded by the cap
    runs = names.select("ResourceName", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("ResourceName"), F.lit("[a-z]{3,}"), 0))).alias("run"))
    pieces = runs.select("ResourceName", "run", F.explode(F.array(*map(F.lit, lengths or [0]))).alias("n")).where(F.length("run") >= F.col("n"))
    posted = pieces.select("ResourceName", F.explode(F.transform(F.sequence(F.lit(1), F.length("run") - F.col("n") + 1), lambda i: F.substring("run", i, F.col("n")))).alias("Chunk"))
    return posted.join(chunks.select("Chunk").distinct(), "Chunk").groupBy(F.col("Chunk").alias("entity_name")).agg(F.array_sort(F.collect_set("ResourceName")).alias("found_in_chunks"))
