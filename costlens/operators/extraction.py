"""Entities from the unexplained residue of names, through a model that the caller gives.

The model is a callable from a list of residues to a JSON text (or a list of objects); the default one works offline.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark import Accumulator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.masks import CLASSES, placeholder
from ..sources import store

ENTITY = "array<struct<entity_name:string,abbreviations:array<string>>>"
LEAST_LENGTH = 3
#: Tokens that a request may hold, those that the prompt takes, and those that an item takes, by kind of model.
LIMITS = {"large": (100_000, 1_000, 40), "medium": (60_000, 1_000, 40), "small": (12_000, 1_000, 40)}

Model = Callable[[list[str]], "str | list"]


def batch_size(most: int, overhead: int, per_item: int) -> int:
    return max(1, (most - overhead) // per_item)


def clean_residues(report: DataFrame, chunks: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """Residues of ``report`` without placeholders, of ``least`` characters or more, that contain no protected chunk
    (case counts): ResourceName, residue. Chunks meet a residue's parts of their lengths by equality."""
    text = F.coalesce("MaskedName", F.lit(""))
    for kind in CLASSES:
        text = F.replace(text, F.lit(placeholder(kind)), F.lit(""))
    rows = report.select("ResourceName", text.alias("residue")).where(F.length("residue") >= least)
    lengths = sorted(r[0] for r in chunks.select(F.length("Chunk")).distinct().collect())
    parts = rows.select("residue").distinct().select("residue", F.explode(F.array(*map(F.lit, lengths or [0])).cast("array<int>")).alias("n")).where((F.col("n") > 0) & (F.length("residue") >= F.col("n")))
    posted = parts.select("residue", F.explode(F.transform(F.sequence(F.lit(1), F.length("residue") - F.col("n") + 1), lambda i: F.substring("residue", i, F.col("n")))).alias("Chunk"))
    hit = posted.join(chunks.select("Chunk"), "Chunk", "left_semi").select("residue").distinct()
    return rows.join(hit, "residue", "left_anti")


def offline_model(residues: list[str]) -> str:
    """A stand-in: the longest run of letters of each residue is its entity."""
    out = []
    for r in residues:
        runs = re.findall(r"[A-Za-z]{3,}", r)
        best = max(runs, key=lambda w: (len(w), w), default=None)
        out.append({"chunk": r, "entities": [{"entity_name": best.lower(), "abbreviations": []}] if best else []})
    return json.dumps(out)


def validated(response) -> dict[str, list[dict]]:
    """Entities by residue of a response: a list, a JSON text, or an object with one key that holds the list. Whatever
    has another shape is dropped."""
    if isinstance(response, (str, bytes)):
        try:
            response = json.loads(response)
        except ValueError:
            return {}
    if isinstance(response, dict) and len(response) == 1:
        response = next(iter(response.values()))
    out: dict[str, list[dict]] = {}
    for item in response if isinstance(response, list) else []:
        if not isinstance(item, dict) or not isinstance(item.get("chunk"), str) or not isinstance(item.get("entities"), list):
            continue
        good = [e for e in item["entities"] if isinstance(e, dict) and isinstance(e.get("entity_name"), str) and e["entity_name"] and isinstance(e.get("abbreviations", []), list)]
        out[item["chunk"]] = [{"entity_name": e["entity_name"], "abbreviations": [a for a in e.get("abbreviations", []) if isinstance(a, str)]} for e in good]
    return out


@dataclass(frozen=True)
class Retry:
    """How long a batch is asked for again: seconds before the second time, by what they grow, at most, and in all. Which
    errors are worth it is told by ``transient``."""

    first: float = 1.0
    factor: float = 2.0
    most: float = 60.0
    deadline: float = 300.0
    transient: Callable[[Exception], bool] = lambda error: True

    def call(self, model: Model, batch: list[str]):
        """The model's response; raises its last error once the deadline would pass."""
        began, wait = time.monotonic(), self.first
        while True:
            try:
                return model(batch)
            except Exception as error:  # noqa: BLE001  the model is foreign code
                if not self.transient(error) or time.monotonic() - began + wait > self.deadline:
                    raise
            time.sleep(wait)
            wait = min(wait * self.factor, self.most)


NO_RETRY = Retry(deadline=0.0)


def asked(residues: DataFrame, model: Model = offline_model, size: int = 275, retry: Retry = NO_RETRY, progress: Accumulator | None = None, failures: Accumulator | None = None) -> DataFrame:
    """Each distinct residue with its entities, asking the model for ``size`` at a time; null where the model failed.

    ``progress`` counts the batches that were asked, ``failures`` those that failed; the driver may read them while tasks
    run. A task that runs again counts again."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), size):
                listed = b["residue"].iloc[at : at + size].tolist()
                try:
                    found = validated(retry.call(model, listed))
                    entities = [found.get(r, []) for r in listed]
                except Exception:  # noqa: BLE001
                    entities = [None] * len(listed)
                    if failures is not None:
                        failures.add(1)
                if progress is not None:
                    progress.add(1)
                yield pd.DataFrame({"residue": listed, "entities": entities})

    return residues.select("residue").distinct().mapInPandas(ask, f"residue string, entities {ENTITY}")


def extract(residues: DataFrame, model: Model = offline_model, size: int = 275, progress: Accumulator | None = None) -> DataFrame:
    """``asked`` once; a batch that fails has no entities."""
    found = asked(residues, model, size, progress=progress)
    return found.withColumn("entities", F.coalesce("entities", F.array().cast(ENTITY)))


#: Residues that are asked for before their answers are written.
WAVE = 50_000
ANSWERS = f"model string, residue string, entities {ENTITY}"


def remembered(residues: DataFrame, model: Model, name: str, path: str, size: int = 275, retry: Retry = Retry(), wave: int = WAVE, failures: Accumulator | None = None) -> DataFrame:
    """Each distinct residue with its entities, null where the model failed, from a table of answers by model and residue.

    The model is asked only for what the table lacks, in waves of about ``wave`` residues whose answers are added to the
    table before the next: a run that is lost, or run again, asks for no more than a wave twice. Failures are not kept."""
    spark = residues.sparkSession
    known = lambda: store.read_table(spark, path, ANSWERS).where(F.col("model") == name).dropDuplicates(["residue"])
    listed = store.held(residues.select("residue").distinct(), "residues")
    absent = store.held(listed.join(known().select("residue"), "residue", "left_anti"), "absent")
    waves = -(-absent.count() // wave)
    for k in range(waves):
        part = absent.where(F.pmod(F.xxhash64("residue"), F.lit(waves)) == k)
        found = asked(part, model, size, retry, failures=failures).where("entities IS NOT NULL")
        store.write_table(found.select(F.lit(name).alias("model"), "residue", "entities"), path, mode="append")
    store.discard(absent)
    return listed.join(known().select("residue", "entities"), "residue", "left")


def by_entity(extracted: DataFrame) -> DataFrame:
    """Extracted entities as a suggestion list: entity_name, abbreviations, found_in_chunks."""
    each = extracted.select("residue", F.explode("entities").alias("e"))
    return each.groupBy(F.col("e.entity_name").alias("entity_name")).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("e.abbreviations")))).alias("abbreviations"), F.array_sort(F.collect_set("residue")).alias("found_in_chunks"))


def known_acronyms(entities: DataFrame, shortest: int = 3, longest: int = 5) -> DataFrame:
    """Keeps of each abbreviation list what is an acronym by length and letters."""
    return entities.withColumn("abbreviations", F.filter("abbreviations", lambda a: a.rlike(f"^[A-Za-z]{{{shortest},{longest}}}$")))
