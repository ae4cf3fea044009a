"""What line dedup spends on a word, and the bytes of packed numbers."""

from __future__ import annotations

import numpy as np
import pytest

from costlens.llm import blobs, line_dedup, set_join, word_hash


def test_words_are_mixed_once(monkeypatch):
    """A slab mixes the hash of each distinct word, not of each word of its lines."""
    seen, mixed = [], line_dedup.mixed
    monkeypatch.setattr(line_dedup, "mixed", lambda h: seen.append(len(h)) or mixed(h))
    words = [f"w{i}" for i in range(20)]
    texts = ["\n".join(" ".join(words[a : a + 10]) for a in range(10)).encode() for _ in range(50)]
    found = line_dedup._slab(7, [False] * 50, np.arange(50), np.arange(50), texts)
    slab = line_dedup.Slab(dict(zip(("block", "hash", "sets", "docs"), found)))
    assert len(slab.size) == 10 and len(slab.hash) == 19
    assert len(set(slab.names().tolist())) == 10
    assert max(seen) == 19


def test_buckets_are_pieces():
    """Rows are put in order once; a bucket's are no copies of them."""
    cell = np.random.default_rng(1).integers(0, 1 << 48, 500, dtype=np.uint64)
    rows = {"cell": cell, "item": np.arange(500, dtype=np.uint64)}
    got = list(set_join.buckets(rows, 7))
    assert [b for b, _ in got] == list(range(7))
    assert all(x["item"].base is got[0][1]["item"].base is not None for _, x in got)
    assert np.concatenate([x["cell"] for _, x in got]).tolist() == sorted(cell.tolist())
    assert all((cell[x["item"]] == x["cell"]).all() for _, x in got)
    assert list(set_join.buckets({k: v[:0] for k, v in rows.items()}, 7)) == []


@pytest.mark.parametrize("width", range(9))
def test_packed_bytes(width):
    """At each width the bytes are the numbers' low bytes, and are read back from any buffer."""
    most = (1 << 8 * width) - 1
    values = [most, *np.random.default_rng(width).integers(0, most, 999, dtype=np.uint64, endpoint=True).tolist(), 0]
    data = blobs.packed(np.array(values, np.uint64))
    assert data == bytes([width]) + len(values).to_bytes(8, "little") + b"".join(v.to_bytes(8, "little")[:width] for v in values)
    for view in (data, memoryview(b"xyz" + data)[3:], memoryview(data + b"more")):
        back = blobs.unpacked(view)
        assert back.dtype == np.uint64 and back.flags.writeable and back.tolist() == values
    assert blobs.unpacked(blobs.packed(np.zeros(0, np.uint64))).tolist() == []


def test_order_of_numbers(monkeypatch):
    """Numbers of 64, 48 and few bits, equal ones, ones that differ in their low bits alone; ``argsort`` only for these."""
    draw, asked, argsort = np.random.default_rng(2), [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda *a, **k: asked.append(len(a[0])) or argsort(*a, **k))
    whole = draw.integers(0, (1 << 64) - 1, 3000, dtype=np.uint64)
    plain = [whole, whole >> np.uint64(16), whole >> np.uint64(60), np.repeat(whole[:5], 300), whole[:1], whole[:0], whole[:9] * np.uint64(0)]
    close = (np.uint64(1) << np.uint64(63)) + whole % np.uint64(50)
    for x in (*plain, close):
        order = word_hash.order_of(x)
        assert sorted(order.tolist()) == list(range(len(x))) and x[order].tolist() == sorted(x.tolist())
        found, at = word_hash.numbered(x)
        assert found.tolist() == sorted(set(x.tolist())) and (found[at] == x).all()
    assert asked == [len(close)] * 2
