r"""Operator 4: decision lists learned from labelled statistics.

Text statistics are computed for every document; labelled documents, up to ``LABELLED`` of them chosen by a hash of
their id, teach an ordered list of rules by sequential covering. A rule is a conjunction of thresholds on statistics:
it is grown on two thirds of the rows by information gain, pruned on the rest, and kept while it is precise enough on
both. The list is emitted as one ordered conditional Spark expression.

Labels are ``quality`` (0 is bad) and, where the table has it, ``toxic`` (1 is bad). Rules for the first come first; they
compare statistics of form. Rules for the second compare the words of a lexicon too (``lexicon.py``), which is learned from
the same documents.

Nulls: a null text has no words. Labels without a document, or with two nulls, teach nothing; a null in one of the two
teaches the other. Repeated rows are documents of their own and get equal verdicts; one text of an id teaches, the greatest.
Without labels of both kinds every document is kept that the base rules keep. A very long text is measured whole. Other columns are kept by ``apply``, but for those with the name of a result, and all
by ``apply_to``; the query ignores them. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import blobs, lexicon
from .common import cut, drop, table, text_or_empty, unused

#: Labelled documents that teach at most.
LABELLED = 20_000
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\r\x0b\x0c"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_upper", "n_marks", "n_digits", "n_distinct", "n_adjacent"]
MARKED = ["n_marked", "n_tinged"]


def repeated_words(listed: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more in the list."""
    n = len(listed) - window + 1
    if n < 2:
        return 0
    if n <= 4000:
        windows = list(zip(*(listed[i:] for i in range(window))))
        if len(set(windows)) == n:
            return 0
        count = Counter(windows)
        hit = np.fromiter((count[w] > 1 for w in windows), bool, n)
    else:
        number: dict[bytes, int] = {}
        code = np.fromiter((number.setdefault(w, len(number)) for w in listed), np.int64, len(listed))
        half = 1
        while half < window:  # names of windows of twice the length
            code = np.unique(code[:-half] * (int(code.max()) + 1) + code[half:], return_inverse=True)[1].reshape(-1)
            half *= 2
        hit = np.bincount(code)[code] > 1
    edge = np.zeros(len(listed) + 1, np.int64)
    at = np.flatnonzero(hit)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def text_statistics(text: str) -> tuple[int, ...]:
    data = text.encode("utf-8", "surrogatepass")
    listed = data.split()
    kept = data.translate(None, SPACES)
    seen: set[bytes] = set()
    dup = 0
    for line in data.split(b"\n"):
        if line in seen:
            dup += bool(line.strip(SPACES))
        else:
            seen.add(line)
    chars = len(kept) - len(kept.translate(None, STARTS)) if not text.isascii() else len(kept)
    lower = kept.translate(None, UPPER)
    adjacent = sum(map(bytes.__eq__, listed, listed[1:]))
    return (len(listed), chars, len(kept) - len(kept.translate(None, SYMBOLS)), dup, repeated_words(listed), len(kept) - len(lower), len(kept) - len(kept.translate(None, MARKS)), len(kept) - len(kept.translate(None, DIGITS)), len(set(listed)), adjacent)


#: Bytes that begin a code point.
STARTS = bytes(b for b in range(256) if b & 0xC0 != 0x80)
UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
MARKS = b"!?"


def with_statistics(docs: DataFrame, keep: list[str], marking: lexicon.Lexicon, own: str | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` and the statistics of column ``text``. ``own`` is one of ``keep``: the label with
    which a row was counted in the lexicon."""
    names = BASE + MORE + MARKED
    schema = docs.select(*keep).schema
    for c in names:
        schema = schema.add(c, "long")

    @blobs.lean
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = lexicon.counter(marking)
        for batch in batches:
            labels = [None] * batch.num_rows if own is None else batch.column(keep.index(own)).to_pylist()
            found = [text_statistics(t) + marked(t, label) for t, label in zip(batch.column(batch.num_columns - 1).to_pylist(), labels)]
            columns = [pa.array(c, pa.int64()) for c in zip(*found)] or [pa.array([], pa.int64()) for _ in names]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*keep, *names])

    return docs.select(*keep, text_or_empty().alias(unused("text", keep))).mapInArrow(measure, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


#: What rules compare: each a ratio of two statistics, or one itself.
FEATURES: list[tuple[str, str | None]] = [("n_words", None), ("word_chars", "n_words"), ("n_symbols", "n_words"), ("n_dup_lines", "n_words"), ("n_repeat_words", "n_words"), ("n_upper", "word_chars"), ("n_marks", "n_words"), ("n_digits", "word_chars"), ("n_distinct", "n_words"), ("n_adjacent", "n_words")]
#: What rules for toxic documents compare beside these.
LEXICAL: list[tuple[str, str | None]] = [(c, under) for c in MARKED for under in (None, "n_words")]


@dataclass(frozen=True)
class Test:
    """feature >= threshold, or feature < threshold."""

    feature: int
    above: bool
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        return x[:, self.feature] >= self.threshold if self.above else x[:, self.feature] < self.threshold

    def column(self) -> Column:
        value = feature_column(*(FEATURES + LEXICAL)[self.feature])
        return value >= F.lit(self.threshold) if self.above else value < F.lit(self.threshold)


def feature_column(over: str, under: str | None) -> Column:
    top = F.col(over).cast("double")
    return top if under is None else top / F.greatest(F.col(under), F.lit(1)).cast("double")


def holds(rule: list[Test], x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for test in rule:
        out &= test.holds(x)
    return out


def _best_test(x: np.ndarray, bad: np.ndarray) -> tuple[float, Test | None]:
    """The test of most information gain (FOIL's) among thresholds between distinct values."""
    p, n = bad.sum(), (~bad).sum()
    base, best = np.log2(p / (p + n)), (1e-9, None)
    for k in range(x.shape[1]):
        order = np.argsort(x[:, k], kind="stable")
        value, hit = x[order, k], bad[order]
        edges = np.flatnonzero(np.diff(value)) + 1
        if not len(edges):
            continue
        done = np.concatenate([[0], np.cumsum(hit)])[edges]
        for above, pos, size in ((True, p - done, len(x) - edges), (False, done, edges)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(pos > 0, pos * (np.log2(pos / size) - base), 0)
            i = int(np.argmax(gain))
            if gain[i] > best[0]:
                best = (float(gain[i]), Test(k, above, float((value[edges[i]] + value[edges[i] - 1]) / 2)))
    return best


def learn(x: np.ndarray, bad: np.ndarray, precision: float = 0.9, least: int = 3, most_tests: int = 4, seed: int = 7) -> list[list[Test]]:
    """Rules that find bad rows, in order. A rule must be right on ``precision`` of what it covers that rules before it
    left, on the rows that grew it and on those that pruned it, and cover ``least`` rows."""
    rules: list[list[Test]] = []
    left = np.ones(len(x), bool)
    prune = np.random.default_rng(seed).permutation(len(x)) % 3 == 0
    while bad[left].any():
        rule: list[Test] = []
        cover = left & ~prune
        while len(rule) < most_tests and (bad & cover).any() and (~bad & cover).any():
            _, test = _best_test(x[cover], bad[cover])
            if test is None:
                break
            rule.append(test)
            cover = cover & test.holds(x)
        if not rule:
            break

        def worth(r: list[Test]) -> float:
            hit = left & prune & holds(r, x)
            return ((bad & hit).sum() - (~bad & hit).sum()) / max(1, hit.sum())

        kept = max((rule[:i] for i in range(len(rule), 0, -1)), key=worth)
        hit = left & holds(kept, x)
        parts = [hit & prune, hit & ~prune]
        if hit.sum() < least or any(h.any() and bad[h].mean() < precision for h in parts) or not bad[hit].any():
            break
        rules.append(kept)
        left &= ~hit
    return rules


def verdict(rules: list[list[Test]]) -> Column:
    """The list as one ordered conditional: false at the first rule that holds, else true."""
    out = None
    for rule in rules:
        all_of = rule[0].column()
        for test in rule[1:]:
            all_of = all_of & test.column()
        out = F.when(all_of, False) if out is None else out.when(all_of, False)
    return F.lit(True) if out is None else out.otherwise(True)


def labelled(labels: DataFrame, limit: int = LABELLED) -> DataFrame:
    """Labels (doc_id, quality, toxic) that teach: ``limit`` at most, chosen by a hash, the same ones in every run."""
    toxic = F.col("toxic") if "toxic" in labels.columns else F.lit(None)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("long").alias("quality"), toxic.cast("long").alias("toxic"))
    known = known.where("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)").distinct()
    return known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality", "toxic").limit(limit)


def teach(docs: DataFrame, labels: DataFrame, limit: int = LABELLED) -> tuple[list[list[Test]], lexicon.Lexicon]:
    """The rules learned from labels of documents that the base rules keep, and the lexicon they need; ``limit`` bounds
    the labels."""
    taught = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).join(F.broadcast(labelled(labels, limit)), "doc_id")
    taught = taught.groupBy("doc_id", "quality", "toxic").agg(F.max("text").alias("text"))
    taught = cut(taught.select("quality", (F.col("toxic") == 1).alias("bad"), "text"), "taught")
    marking = lexicon.learn(taught)
    columns = [feature_column(*f).alias(f"f{i}") for i, f in enumerate(FEATURES + LEXICAL)]
    rows = with_statistics(taught, ["quality", "bad"], marking, "bad").where(~base_failed()).select("quality", *columns, "bad")
    rows = rows.toPandas().sort_values(rows.columns, ignore_index=True)  # at most ``limit`` rows of numbers
    drop(taught)
    x = rows.iloc[:, 1:-1].to_numpy(np.float64)
    rules: list[list[Test]] = []
    for known, bad, features in ((rows["quality"].notna(), rows["quality"] == 0, len(FEATURES)), (rows["bad"].notna(), rows["bad"] == True, x.shape[1])):  # noqa: E712
        if known.any():
            rules += learn(x[known.to_numpy(), :features], bad[known].to_numpy(bool))
    return rules, marking


def apply_to(docs: DataFrame, labels: DataFrame, limit: int = LABELLED) -> DataFrame:
    """The rows of ``docs`` that the base rules and the learned list keep."""
    rules, marking = teach(docs, labels, limit)
    whole = docs.select(F.struct(*(F.col(c) for c in docs.columns)).alias("_document"), "text")
    return with_statistics(whole, ["_document"], marking).where(~base_failed() & verdict(rules)).select("_document.*")


def apply(docs: DataFrame, labels: DataFrame, limit: int = LABELLED) -> DataFrame:
    """doc_id, the statistics, base_failed and kept of each row of ``docs``, with its other columns but text; of these,
    such as have the name of a result are left out."""
    keep = [c for c in docs.columns if c not in {"text", *BASE, *MORE, *MARKED, "base_failed", "kept"}]
    rules, marking = teach(docs, labels, limit)
    stats = with_statistics(docs, keep, marking)
    return stats.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict(rules))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return apply(docs, table(spark, sf_dir, "labels")).select("doc_id", *BASE, "base_failed", "kept")
