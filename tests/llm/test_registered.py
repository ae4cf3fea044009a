"""Every registered query of this part on the provided tables: against its SQL, or a plain version of its contract."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import oracle
import pytest
import xxhash

import corpus_pipeline
from costlens.llm import queries
from costlens.llm.bpe import BatchEncoder, default_vocabulary

SPACE = r"[^\x20\x09-\x0D]+"
LOWER = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.fixture(scope="module")
def texts(con):
    return {i: t or "" for i, t in con.execute("SELECT doc_id, text FROM documents").fetchall()}


@pytest.fixture(scope="module")
def encoder():
    return BatchEncoder.of(default_vocabulary()).tokenizer


def run(spark, sf_dir, name):
    return {r["doc_id"]: r.asDict() for r in queries.QUERIES[name](spark, sf_dir).collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, sf_dir, con, name):
    missing, extra, rows = oracle.compare(queries.QUERIES[name](spark, sf_dir), con, queries.ORACLE_SQL[name])
    assert not missing and not extra and rows


def test_op3(spark, sf_dir, texts, encoder):
    got = run(spark, sf_dir, "op3_token_counts")
    assert {i: r["n_tokens"] for i, r in got.items()} == {i: len(encoder.encode(t, add_special_tokens=False).ids) for i, t in texts.items()}


def test_op4(spark, sf_dir, texts):
    got = run(spark, sf_dir, "op4_quality_rules")
    for i, t in texts.items():
        listed = re.findall(SPACE, t)
        grams = Counter(tuple(listed[k : k + 8]) for k in range(len(listed) - 7))
        repeated = {k + d for k in range(len(listed) - 7) if grams[tuple(listed[k : k + 8])] > 1 for d in range(8)}
        lines, dup = set(), 0
        for line in t.split("\n"):
            dup += line in lines and bool(re.search(SPACE, line))
            lines.add(line)
        want = (len(listed), sum(map(len, listed)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(repeated))
        r = got[i]
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want, i
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and not (r["base_failed"] and r["kept"])
    assert len(got) == len(texts)


def test_op5(spark, sf_dir, con, texts):
    found = {(r["doc_id"], r["item_id"]) for r in queries.QUERIES["op5_decontamination"](spark, sf_dir).collect()}
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    assert {(i, k) for i, t in texts.items() for k, item in items if item in t} <= found


def test_op6(spark, sf_dir, texts, encoder):
    rows = [r.asDict() for r in queries.QUERIES["op6_packing"](spark, sf_dir).collect()]
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    total = 0
    for i, t in texts.items():
        ids, at = np.array([*encoder.encode(t, add_special_tokens=False).ids, 2], "<u4"), 0
        total += len(ids)
        pieces = sorted(by_doc[i], key=lambda r: r["piece"])
        for k, r in enumerate(pieces):
            assert (r["piece"], r["start"]) == (k, at) and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]]) and (k == 0 or r["length"] == 1024)
            at += r["length"]
        assert at == len(ids) and len(pieces) == -(-len(ids) // 1024)
    for listed in by_seq.values():
        end = 0
        for r in sorted(listed, key=lambda r: r["offset"]):
            assert r["offset"] == end
            end += r["length"]
        assert end <= 1024
    assert len(by_seq) <= 1.02 * -(-total // 1024) + 1
    assert all(1 <= r["bound"] <= r["bins"] for r in rows)


def test_op7(spark, sf_dir, texts):
    prints = {}
    for i, t in texts.items():
        w = re.findall(SPACE, LOWER(t))
        h = [xxhash.xxh64_intdigest(" ".join(w[k : k + 3]).encode(), 42) for k in range(max(1, len(w) - 2))] if w else []
        bits = np.unpackbits(np.array(h, ">u8").view(np.uint8).reshape(len(h), 8), axis=1).sum(0) if h else np.zeros(64)
        prints[i] = int("".join("1" if 2 * int(b) > len(h) else "0" for b in bits), 2)
    group = {i: i for i in prints}
    for a in prints:
        for b in prints:
            if (prints[a] ^ prints[b]).bit_count() <= 2 and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {k: low if v == high else v for k, v in group.items()}
    got = run(spark, sf_dir, "op7_simhash")
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in got.items()} == {i: (f"{p:016x}", group[i]) for i, p in prints.items()}


def test_op8(spark, sf_dir, texts):
    tokens = {i: [*re.findall(SPACE, LOWER(t)), " end"] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    seen = Counter(w for i, listed in tokens.items() if not held[i] for w in listed)
    n, v = sum(seen.values()), len(seen)
    got = run(spark, sf_dir, "op8_lm_scoring")
    for i, listed in tokens.items():
        r, base = got[i], sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in listed)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(listed), sum(w in seen for w in listed), n)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
    better = [r["score"] - r["base_score"] for r in got.values() if r["held_out"]]
    assert sum(better) > 0  # held-out texts are likelier under the model


def test_op9(spark, sf_dir, texts, encoder):
    got, start = run(spark, sf_dir, "op9_token_output"), 0
    for i in sorted(texts):
        ids = np.array([*encoder.encode(texts[i], add_special_tokens=False).ids, 0], "<u4")
        assert tuple(got[i][c] for c in ("start", "n_tokens", "ids_crc32")) == (start, len(ids), zlib.crc32(ids))
        start += len(ids)


def test_pipeline_runs_and_takes_nothing(spark, sf_dir, tmp_path):
    got = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(got.columns)
    ends = {}
    for r in got.collect():
        ends[r["sequence_id"]] = ends.get(r["sequence_id"], 0) + r["length"]
    assert ends and max(ends.values()) <= 1024
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut(stage(spark, docs, sf_dir), "none")
        assert docs.count() == 0
