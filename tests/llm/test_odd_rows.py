"""Null ids, repeated rows, empty and long texts, clashing columns and empty tables against plain versions."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from costlens.llm import chat, packing, simhash, suffix_dedup, token_counts, token_output
from costlens.llm.bpe import BatchEncoder, default_vocabulary

LINE = "a passage of more than a hundred bytes that stands in several of these texts, again and again, word for word. "
ROWS = [(None, LINE), (None, LINE), (None, None), (3, "x" + LINE + LINE), (3, "x" + LINE + LINE), (3, ""), (5, None), (9, "short"), (9, "other"), (12, LINE + "é ﬁ  end")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "clash", "clash") for r in ROWS], "doc_id long, text string, fingerprint string, n_tokens string").repartition(3)


@pytest.fixture(scope="module")
def encoder():
    return BatchEncoder.of(default_vocabulary()).tokenizer


def ids_of(encoder, text, end):
    return np.array([*encoder.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_suffix_dedup(docs):
    key = lambda i: -1 if i is None else i
    want, places = Counter(), {}
    for i, t in ROWS:  # rows of equal doc_id are one document: earlier or later by start
        raw = (t or "").encode()
        for s in range(len(raw) - 99):
            places.setdefault(raw[s : s + 100], set()).add((key(i), s))
    for i, t in ROWS:
        raw, gone = (t or "").encode(), set()
        for s in range(len(raw) - 99):
            if min(places[raw[s : s + 100]]) < (key(i), s):
                gone.update(range(s, s + 100))
        kept = bytes(b for k, b in enumerate(raw) if k not in gone)
        n_spans = sum(k not in gone or k - 1 not in gone for k in sorted(gone)) if gone else 0
        want[(i, len(raw), len(gone), n_spans, hashlib.sha256(kept).hexdigest())] += 1
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.deduplicated(docs).collect())
    assert got == want


def test_token_counts(docs, encoder):
    got = token_counts.edited_counts(docs, default_vocabulary())
    want = Counter((i, len(encoder.encode(t or "", add_special_tokens=False).ids)) for i, t in ROWS)
    assert Counter((r["doc_id"], r["n_tokens"]) for r in got.collect()) == want


def test_packing(docs, encoder):
    got = packing.digest(packing.pack(docs, default_vocabulary())[0]).collect()
    want = Counter((i, zlib.crc32(ids_of(encoder, t, 2)), len(ids_of(encoder, t, 2))) for i, t in ROWS)
    assert Counter((r["doc_id"], r["ids_crc32"], r["length"]) for r in got) == want


def test_simhash(spark, tmp_path, docs):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter((r["doc_id"], r["fingerprint"]) for r in simhash.op7_simhash(spark, str(tmp_path)).select("doc_id", "fingerprint").collect())
    want = Counter()
    for i, t in ROWS:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        h = [xxhash.xxh64_intdigest(" ".join(w[k : k + 3]).encode(), 42) for k in range(max(1, len(w) - 2))] if w else []
        want[(i, f"{sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)):016x}")] += 1
    assert got == want


def test_token_files_beyond_a_frame(spark, tmp_path, encoder):
    rows = [(None, "first"), (1, "b"), (1, "a"), (4, "word " * (token_output.FRAME_IDS + 10)), (4, "word " * (token_output.FRAME_IDS + 10)), (6, None)]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, start string")
    token_output.write_tokens(frame, str(tmp_path / "t"), default_vocabulary())
    got = sorted(((r["start"], r["n_tokens"], r["ids_crc32"], r["doc_id"]) for r in token_output.read_tokens(spark, str(tmp_path / "t")).collect()))
    start, want = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = ids_of(encoder, t, 0)
        want.append((start, len(ids), zlib.crc32(ids), i))
        start += len(ids)
    assert got == want


@pytest.mark.parametrize("rows", [[], [(1, 1, "user", "x"), (1, None, None, None), (1, 1, "user", "x"), (None, 2, "assistant", "y" * 100_000)]])
def test_chat(spark, tmp_path, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame.withColumns({n: F.lit("clash") for n in ("node", "leaf", "depth", "score", "parent")}).write.parquet(f"{tmp_path}/conversations.parquet")
    rows = [*rows, (chat.ADDED, 0, "user", chat.ADDED_TEXT), (chat.ADDED, 1, "assistant", chat.ADDED_TEXT)]
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"]) for r in chat.op10_chat_formatting(spark, str(tmp_path)).collect()}
    want = {}
    for c in {r[0] for r in rows}:
        own = sorted(((t is not None, t or 0, r or "", x or "") for i, t, r, x in rows if i == c))
        said = "".join(f"{r}\n{x}\n" for *_, r, x in own)
        want[c] = (len(own), hashlib.sha256(said.encode()).hexdigest(), sum(len(x) for *_, r, x in own if r == "assistant"))
    assert got == want
