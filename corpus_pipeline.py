"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup, benchmark decontamination, best-fit packing.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it kept and returns the columns of
``documents``; the last returns the packing plan. ``run`` writes each stage's result as Parquet in the shared folder and
reads it again. Null and repeated rows, ties and very long texts are handled as the operators state; without labels the base
rules alone decide, without a benchmark no document goes for it; column n_chars is counted anew where a stage
changes a text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costlens.llm import decontamination, line_dedup, near_copies, packing, quality
from costlens.llm.bpe import default_vocabulary
from costlens.llm.common import cut, table

#: SQL has no form for learned rules and packing; the tests hold each stage against a plain version.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned decision list keep."""
    kept = quality.apply_to(docs, table(spark, sf_dir, "labels"))
    return kept.select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line matches; those that lose every word go."""
    out = line_dedup.apply(docs)
    out = out.where(F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component, the one of least doc_id: SimHash fingerprints (op7's) link at 2 or fewer differing
    bits, and an exact join adds the near copies that these do not see (five-word shingles, Jaccard 0.8)."""
    return near_copies.one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that match no item of the benchmark."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The plan that packs all that is left."""
    return packing.digest(packing.pack(docs, default_vocabulary())[0])


STAGES = [("quality rules", quality_rules), ("line dedup", lines), ("SimHash near-dedup", near_duplicates), ("benchmark decontamination", benchmark), ("best-fit packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
