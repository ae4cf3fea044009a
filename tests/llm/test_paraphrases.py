"""Recall of benchmark decontamination against the longest common subsequence over all pairs, of all that it admits."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from costlens.llm import decontamination as d


def test_recall_of_paraphrases(spark):
    random.seed(12)
    vocabulary = ["".join(random.choice("bcdfglmnprst") + random.choice("aeiou") for _ in range(random.randint(2, 4))) for _ in range(1500)]
    common = vocabulary[:40]
    word = lambda: random.choice(common if random.random() < 0.4 else vocabulary)
    say = lambda n: [word() for _ in range(n)]
    items = [(k, say(random.choice([15, 25, 40, 90]))) for k in range(30)]
    docs = []
    for i in range(70):
        listed = say(random.randint(60, 250))
        if i % 2:
            kept = [word() if random.random() < random.choice([0.05, 0.15, 0.3]) else w for w in items[i % 30][1] if random.random() > 0.05]
            at = random.randint(0, len(listed))
            listed[at:at] = kept
        docs.append((i, listed))
    number = {w: k for k, w in enumerate({w for _, listed in [*items, *docs] for w in listed})}
    code = lambda listed: np.array([number[w] for w in listed])
    every, possible = set(), set()
    for k, item in items:
        a, size = code(item), len(item)
        for i, listed in docs:
            b = code(listed)
            lcs = max(d.common_subsequence(a, b[at : at + size + size // 2]) for at in range(0, max(1, len(b) - size // 2), 4))
            if lcs >= d.PARAPHRASE * size:  # an item is one sentence, so that its answer is all of it
                every.add((i, k))
            if d.common_subsequence(a, b) >= d.PARAPHRASE * size:
                possible.add((i, k))
    frames = (spark.createDataFrame([(i, " ".join(w).capitalize() + ".") for i, w in rows], f"{name} long, text string") for name, rows in (("doc_id", docs), ("item_id", items)))
    found = {(r["doc_id"], r["item_id"]) for r in d.matches(*frames).collect()}
    assert len(every) >= 15 and found <= possible
    assert len(every & found) >= 0.9 * len(every), (len(every & found), len(every))


def test_recall_on_the_tables(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    found = d.matches(docs, bench).collect()
    assert found and all(-1 <= r["cosine"] <= 1 for r in found)
    number: dict[bytes, int] = {}
    code = lambda text: np.array([number.setdefault(w, len(number)) for w in d.words(text or "")], np.int64)
    items = []
    for r in bench.collect():
        answer = d.re.split(r"(?<=[.!?])\s+", r["text"].strip())[-1]
        items.append((r["item_id"], code(r["text"]), code(answer)))
    every = set()
    for r in docs.collect():
        b = code(r["text"])
        for k, a, answer in items:
            if np.isin(b, a).sum() < d.PARAPHRASE * len(a) or d.common_subsequence(a, b[np.isin(b, a)]) < d.PARAPHRASE * len(a):
                continue
            for at in range(0, max(1, len(b) - len(a) // 2), max(1, len(a) // 8)):
                near = b[at : at + len(a) + len(a) // 2]
                lcs = d.common_subsequence(a, near)
                if lcs >= d.SURE * len(a) or lcs >= d.PARAPHRASE * len(a) and d.common_subsequence(answer, near) >= d.ANSWER * len(answer):
                    every.add((r["doc_id"], k))
                    break
    got = {(r["doc_id"], r["item_id"]) for r in found}
    assert len(every) >= 10 and len(every & got) >= 0.9 * len(every), (len(every & got), len(every))


def test_nothing_is_found_without_the_latent_space(spark, sf_dir, monkeypatch):
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    assert d.matches(docs, bench).count()
    monkeypatch.setattr(d, "latent_space", lambda found, items, weight, rows: np.zeros((len(weight), 4)))
    assert not d.matches(docs, bench).count()


def test_blocks_hold_every_entry():
    """Blocks of passages that share their words multiply as the whole matrix does."""
    random = np.random.default_rng(5)
    names, docs = 300, 9
    rows = [np.sort(random.choice(4000, 900, replace=False)) for _ in range(docs)]
    words = [random.integers(0, names, len(r)).astype(np.int32).tobytes() for r in rows]
    batch = pa.RecordBatch.from_arrays([pa.array([4000] * docs), pa.array(words, pa.binary()), pa.array([r.astype(np.int32).tobytes() for r in rows], pa.binary())], names=["n_words", "words", "places"])
    p = d.Passages.of(batch, names)
    value, starts, _ = p.rows(np.ones(names))
    whole = np.zeros((len(starts), names), np.float32)
    whole[p.entry, p.word] = value
    assert len(starts) > 3 * d.BLOCK
    got = np.zeros_like(whole)
    for at, used, dense in p.blocks(value, starts, names):
        assert len(dense) <= d.BLOCK and (dense != 0).any(axis=0).all()
        got[np.arange(at, at + len(dense))[:, None], used] = dense
    assert (got == whole).all()
