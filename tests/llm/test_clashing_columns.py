"""Rows keep their columns, whatever these are called; results are those of the same rows without them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from costlens.llm import decontamination, line_dedup, near_copies, packing, quality, simhash, suffix_dedup, token_counts, token_output
from costlens.llm.bpe import default_vocabulary

NAMES = ["_text", "text_", "_doc", "_row", "row", "doc", "none", "d", "x", "fp", "key", "target", "block", "kind", "data", "id", "n_words", "n_bytes", "n_tokens", "piece", "start", "s", "w", "_removed", "_document"]


@pytest.fixture(scope="module")
def plain(spark):
    rows = [(1, "one two three four five six " * 9), (2, "one two three four five six " * 9), (2, "one two three four five six " * 9), (None, "a b c d"), (None, None), (7, "other words in this line of text are here\nthe second line")]
    return spark.createDataFrame(rows, "doc_id long, text string").cache()


@pytest.fixture(scope="module")
def wide(plain):
    return plain.withColumns({n: F.lit(f"mine {n}") for n in NAMES}).cache()


@pytest.mark.parametrize(
    "kept",
    [
        line_dedup.apply, simhash.one_of_each, near_copies.one_of_each,
        lambda docs: decontamination.clean(docs, docs.sparkSession.createDataFrame([(1, "other words in this line of text are here")], "item_id long, text string")),
        lambda docs: quality.apply_to(docs, docs.sparkSession.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")),
    ],
)
def test_rows_keep_their_columns(plain, wide, kept):
    out = kept(wide)
    assert out.columns == wide.columns
    assert all(r[n] == f"mine {n}" for r in out.collect() for n in NAMES)
    key = lambda f: sorted(map(tuple, f.select("doc_id", "text").collect()), key=repr)
    assert key(out) == key(kept(plain))


def test_quality_results_win(wide):
    labels = wide.sparkSession.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    out = quality.apply(wide, labels)
    assert dict(out.dtypes)["n_words"] == "bigint" and {r["_text"] for r in out.collect()} == {"mine _text"}


@pytest.mark.parametrize(
    "made",
    [
        suffix_dedup.deduplicated, line_dedup.removals,
        lambda docs: token_counts.edited_counts(docs, default_vocabulary()),
        lambda docs: packing.digest(packing.pack(docs, default_vocabulary())[0]).select("doc_id", "piece", "length"),
    ],
)
def test_results_ignore_other_columns(plain, wide, made):
    rows = lambda f: sorted(map(str, f.collect()))
    got = rows(made(wide))
    assert got == rows(made(plain)) and len(got) >= 6


def test_token_files_ignore_other_columns(plain, wide, tmp_path):
    for name, docs in (("a", plain), ("b", wide)):
        token_output.write_tokens(docs, str(tmp_path / name), default_vocabulary())
    a, b = (sorted(map(str, token_output.read_tokens(plain.sparkSession, str(tmp_path / n)).collect())) for n in "ab")
    assert a == b and len(a) == 6
