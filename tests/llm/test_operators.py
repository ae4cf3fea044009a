"""Each training-data operator against a plain version, on small texts with nulls, ties, repeats and long rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from costlens.llm import chat, decontamination, language_model, line_dedup, packing, quality, simhash, suffix_dedup, token_counts, token_output
from costlens.llm.bpe import BatchEncoder, default_vocabulary

SCHEMA = "doc_id long, text string"
#: A column whose name operators use inside, and one of another kind.
WIDE = "doc_id long, text string, n_words string, kept string, lang string"
SPACE = r"[^\x20\x09-\x0D]+"


def words(text):
    return re.findall(SPACE, text or "")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def texts():
    random.seed(5)
    vocabulary = ["".join(random.choice("abcdeéñ") for _ in range(random.randint(1, 9))) for _ in range(300)]

    def line():
        return " ".join(random.choice(vocabulary) for _ in range(random.randint(1, 25)))

    rows = []
    for i in range(60):
        text = "\n".join(line() for _ in range(random.randint(1, 6)))
        rows.append((i, text))
        if i % 5 == 0:
            rows.append((100 + i, text))  # a copy
        if i % 7 == 0:
            rows.append((200 + i, text.replace("a", "b", 1)))  # a near copy
        if i % 9 == 0:
            rows.append((300 + i, line() + "\n" + text + "\n" + line()))  # a passage in another text
    rows += [(400, None), (401, ""), (402, " \t\n\x0b"), (403, "a"), (404, "x" * 3000), (405, "ab " * 900), (406, "\n".join(["same line of words here"] * 5)), (407, "日本語 text — ok")]
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(texts, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(frame):
    return {r["doc_id"]: r for r in frame.collect()}


def test_line_dedup(spark, docs, texts, nothing):
    rows = [(i, k, frozenset(words(line))) for i, t in sorted(texts) for k, line in enumerate((t or "").split("\n"))]
    near = lambda a, b: 5 * len(a & b) >= 4 * len(a | b)
    want = defaultdict(list)
    sets = list({s for _, _, s in rows if s})
    first = {}
    for i, k, s in rows:
        first.setdefault(s, (i, k))
    least = {s: min(first[x] for x in sets if near(s, x)) for s in sets}
    for i, k, s in rows:
        if s and least[s] < (i, k):
            want[i].append(k)
    got = by_id(line_dedup.removals(docs))
    assert {i: list(got[i]["removed"]) for i, _ in texts} == {i: want[i] for i, _ in texts}
    assert got[400]["n_lines"] == 1 and line_dedup.removals(nothing).count() == 0
    applied = {r["doc_id"]: r["text"] for r in line_dedup.apply(docs).collect()}
    for i, t in texts:
        assert applied[i] == (t if not want[i] else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in want[i]))
    twice = spark.createDataFrame([(1, "a b c\nd e f"), (1, "a b c\nd e f"), (None, "a b c")], SCHEMA)
    assert sorted(list(r["removed"]) for r in line_dedup.removals(twice).collect()) == [[], [0], [0]]


def brute_suffixes(rows):
    seen, out = set(), {}
    for i, t in sorted(rows):
        data = (t or "").encode()
        covered = bytearray(len(data))
        for s in range(len(data) - 99):
            key = data[s : s + 100]
            if key in seen:
                covered[s : s + 100] = b"\1" * 100
            seen.add(key)
        kept = bytes(c for c, v in zip(data, covered) if not v)
        runs = sum(v and not (k and covered[k - 1]) for k, v in enumerate(covered))
        out[i] = (len(data), len(data) - len(kept), runs, hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_dedup(docs, texts, nothing):
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.deduplicated(docs).collect()}
    assert got == brute_suffixes(texts)
    assert suffix_dedup.deduplicated(nothing).count() == 0


def test_suffix_sort_orders_and_verifies():
    random.seed(2)
    rows = np.array([[random.choice(b"ab") for _ in range(suffix_dedup.STRETCH)] for _ in range(40)], np.uint8)
    rows[5] = rows[9] = rows[20]
    s = suffix_dedup.Stretches(rows)
    order = s.sort(np.arange(40), np.full(40, 7), np.zeros(40, np.int64))
    assert order.tolist() == sorted(range(40), key=lambda i: (rows[i, 7:107].tobytes(), i))
    s.sums[:] = 0  # every comparison collides
    places = np.zeros(40, suffix_dedup.PLACE)
    places["key"] = np.arange(40)
    r, _ = s.repeated(np.arange(40), np.full(40, 7), np.zeros(40, np.int64), places)
    assert sorted(r.tolist()) == [9, 20], r


def test_token_counts(docs, texts, nothing):
    encoder = BatchEncoder.of(default_vocabulary())
    size = lambda t: len(encoder.tokenizer.encode(t, add_special_tokens=False).ids)
    edit = lambda t: [(m.start(), m.end(), "<X> ") for m in re.finditer("ab+", t)]
    got = by_id(token_counts.edited_counts(docs, default_vocabulary(), edit))
    for i, t in texts:
        assert (got[i]["n_tokens"], got[i]["n_tokens_after"]) == (size(t or ""), size(token_counts.applied(t or "", edit(t or ""))))
    assert got[0]["reencoded_chars"] < 2 * len(texts[0][1]) + 400
    assert token_counts.edited_counts(nothing, default_vocabulary()).count() == 0


def test_kept_trees_take_edits_that_come_later(spark, docs, texts):
    vocabulary = default_vocabulary()
    encoder = BatchEncoder.of(vocabulary)
    size = lambda t: len(encoder.tokenizer.encode(t, add_special_tokens=False).ids)
    trees = token_counts.kept_trees(docs, vocabulary)
    now = {i: t or "" for i, t in texts}
    random.seed(4)
    for turn in range(3):
        edits = []
        for i, t in now.items():
            if i % (turn + 2) == 0 and len(t) > 20:
                a = random.randint(0, len(t) - 10)
                edits.append((i, a, a + random.randint(0, 9), random.choice(["", " new", "日本", "1234 5"])))
        got = by_id(token_counts.edited(trees, spark.createDataFrame([*edits, (None, 0, 1, "x"), (-5, 0, 1, "y")], "doc_id long, start long, stop long, replacement string"), vocabulary).cache())
        for i, a, b, new in edits:
            now[i] = now[i][:a] + new + now[i][b:]
        assert {i: (r["text"], r["n_tokens_after"]) for i, r in got.items()} == {i: (t, size(t)) for i, t in now.items()}
        trees = spark.createDataFrame([(i, r["text"], r["n_tokens_after"], r["chars"], r["tokens"]) for i, r in got.items()], token_counts.TREES)


def test_token_tree_takes_edits_in_any_order():
    encoder = BatchEncoder.of(default_vocabulary())
    random.seed(3)
    parts = ["'", "s", "re", " ", "  ", "\n", "a", "9", "é", "!", "ll", "\t", "x y", "don't"]
    for _ in range(60):
        text = "".join(random.choice(parts) for _ in range(40))
        tree = token_counts.TokenTree(text, *encoder.leaves([text])[0])
        for _ in range(5):
            now = tree.present()
            a = random.randint(0, len(now))
            b = min(len(now), a + random.randint(0, 5))
            new = "".join(random.choice(parts) for _ in range(random.randint(0, 3)))
            assert tree.edit(a, b, new, encoder)
            assert tree.present() == now[:a] + new + now[b:]
            assert tree.total == len(encoder.tokenizer.encode(tree.present(), add_special_tokens=False).ids)


def brute_quality(text):
    w = words(text)
    windows = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    covered = {k + j for k in range(len(w) - 7) if windows[tuple(w[k : k + 8])] > 1 for j in range(8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        dup += bool(words(line)) and line in seen
        seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_quality(spark, docs, texts, nothing):
    wide = spark.createDataFrame([(i, t, "x", "y", "en") for i, t in texts] + [(None, "null id " * 30, None, None, None)], WIDE)
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in texts] + [(None, 0, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    got = by_id(quality.apply(wide, labels))
    for i, t in texts:
        want = brute_quality(t)
        assert tuple(got[i][c] for c in quality.BASE) == want
        assert got[i]["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert got[i]["kept"] == (not got[i]["base_failed"])
    kept = quality.apply_to(wide, labels)
    assert kept.columns == wide.columns and kept.count() == sum(r["kept"] for r in got.values())
    assert quality.apply(nothing, labels).count() == 0
    long = words(" ".join(f"w{k % 4100}" for k in range(9000)))
    assert quality.repeated_words([w.encode() for w in long]) == brute_quality(" ".join(long))[4]


def test_quality_rules_learn_held_out():
    rng = np.random.default_rng(1)
    x = rng.random((3000, len(quality.FEATURES)))
    bad = (x[:, 2] > 0.8) | ((x[:, 5] > 0.7) & (x[:, 6] < 0.3))
    rules = quality.learn(x[:2000], bad[:2000])
    said = np.zeros(1000, bool)
    for r in rules:
        said |= quality.holds(r, x[2000:])
    assert (said == bad[2000:]).mean() > 0.97 and len(rules) >= 2
    assert quality.learn(x[:50], np.zeros(50, bool)) == []


def test_decontamination(spark, docs):
    random.seed(9)
    vocabulary = ["".join(random.choice("ghijklmn") for _ in range(random.randint(2, 8))) for _ in range(900)]
    say = lambda n: " ".join(random.choice(vocabulary) for _ in range(n))
    items = [(k, say(random.randint(12, 60)).capitalize() + ".") for k in range(20)] + [(98, None), (99, "")]
    rows = [(k, say(400)) for k in range(40)]
    want = set()
    for k in range(20):
        text = say(random.randint(0, 150)) + " " + items[k][1] + " " + say(random.randint(0, 150))
        if k % 3 == 1:
            text = text.upper()
        if k % 3 == 2:  # a paraphrase: every sixth word another
            said = items[k][1].split()
            said[::6] = [random.choice(vocabulary) for _ in said[::6]]
            text = say(90) + " " + " ".join(said) + " " + say(20)
        rows.append((100 + k, text))
        want.add((100 + k, k))
    rows += [(500, None), (501, ""), (None, items[3][1])]
    want.add((None, 3))
    frame = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.matches(frame, bench).collect()}
    assert got == want
    clean = decontamination.clean(frame, bench)
    assert clean.columns == frame.columns and clean.count() == len(rows) - 21
    assert decontamination.matches(frame.limit(0), bench).count() == 0
    assert decontamination.matches(frame, bench.limit(0)).count() == 0


def test_packing(docs, texts, nothing):
    vocabulary = default_vocabulary()
    encoder = BatchEncoder.of(vocabulary)
    planned, ids = packing.pack(docs, vocabulary, capacity=64)
    rows, places = defaultdict(list), defaultdict(list)
    for r in planned.collect():
        rows[r["doc_id"]].append(r)
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    total = 0
    for i, t in texts:
        want = np.append(np.array(encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, np.uint32), np.uint32(2))
        total += len(want)
        own = sorted(rows[i], key=lambda r: r["piece"])
        assert [r["start"] for r in own] == np.cumsum([0] + [r["length"] for r in own])[:-1].tolist()
        assert all(r["length"] == 64 for r in own[1:]) and sum(r["length"] for r in own) == len(want)
        assert all(r["ids_crc32"] == zlib.crc32(want[r["start"] : r["start"] + r["length"]].astype("<u4")) for r in own)
    for parts in places.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0] + [n for _, n in parts])[:-1].tolist() and sum(n for _, n in parts) <= 64
    assert len(places) <= math.ceil(total / 64) + 2
    whole = packing.sequences(planned, ids).collect()
    assert sum(len(r["ids"]) for r in whole) == 2 * total
    assert packing.pack(nothing, vocabulary)[0].count() == 0


def test_bounds_never_pass_the_best():
    random.seed(4)
    for _ in range(200):
        sizes = np.array([random.randint(1, 20) for _ in range(random.randint(1, 9))])
        _, _, fill = packing.best_fit_decreasing(sizes, 20)

        def fits(left, bins):
            if not left:
                return True
            return any(left[0] <= b and fits(left[1:], (*bins[:k], b - left[0], *bins[k + 1 :])) for k, b in enumerate(bins) if b not in bins[:k])

        best = next(n for n in range(1, 10) if fits(sorted(sizes.tolist(), reverse=True), (20,) * n))
        assert packing.lower_bound(sizes, 20) <= best <= len(fill)


def brute_simhash(text):
    w = words(lowered(text))
    shingles = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


@pytest.mark.parametrize("bucket", [1, 128])
def test_simhash(spark, docs, texts, nothing, bucket, monkeypatch):
    monkeypatch.setattr(simhash.links, "__defaults__", (2, bucket))
    prints = {i: brute_simhash(t) for i, t in texts}
    ids = sorted(prints)
    group = {i: i for i in ids}
    for a in ids:
        for b in ids:
            if (prints[a] ^ prints[b]).bit_count() <= 2 and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {k: low if v == high else v for k, v in group.items()}
    rows, known = simhash.grouped(docs, ["doc_id"])
    got = {r["doc_id"]: (r["fp"] % 2**64, r["component_id"]) for r in rows.join(known, "fp").collect()}
    assert got == {i: (prints[i], group[i]) for i in ids}
    assert sorted(r["doc_id"] for r in simhash.one_of_each(docs).collect()) == sorted(set(group.values()))
    assert simhash.one_of_each(nothing).count() == 0


def test_simhash_thresholds_cover_the_radius():
    costs = [[0.0, 5.0, 50.0], [0.0, 1.0, 9.0], [0.0, 2.0, 70.0]]
    cost, ts = simhash.allocate(costs, 0)
    assert (cost, ts) == (8.0, [0, 0, 0])
    for part, t in simhash.scheme(1000, np.full((64, 64), 250.0) + np.diag(np.full(64, 250.0))):
        assert part and t in (0, 1)


@pytest.mark.parametrize("order, slab, segment", [(3, 8_000_000, 256), (3, 700, 4), (2, 700, 3), (1, 700, 3), (4, 700, 5)])
def test_language_model(spark, docs, texts, nothing, monkeypatch, order, slab, segment):
    monkeypatch.setattr(language_model, "SLAB", slab)
    monkeypatch.setattr(language_model, "SEGMENT", segment)
    tokens = {i: [*words(lowered(t)), " end"] for i, t in texts}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    seen = {k: Counter() for k in range(1, order + 1)}
    for i, w in tokens.items():
        if not held[i]:
            for k in seen:
                padded = w if k == 1 else [" begin", *w]
                seen[k].update(tuple(padded[at : at + k]) for at in range(len(padded) - k + 1))
    n, v = sum(seen[1].values()), len(seen[1])
    times = lambda h: seen[1][" end",] if h == (" begin",) else seen[len(h)][h]

    def p(history, w):
        if not history:
            return (seen[1][w,] + 1) / (n + v + 1)
        shorter = p(history[1:], w)
        most = len(seen[len(history) + 1]) / len(seen[len(history)])
        return (seen[len(history) + 1][(*history, w)] + most * shorter) / (times(history) + most) if times(history) else shorter

    got = by_id(language_model.scored(docs, order))
    for i, w in tokens.items():
        padded = [" begin", *w]
        base = sum(math.log10(p((), x)) for x in w)
        score = sum(math.log10(p(tuple(padded[max(0, k + 2 - order) : k + 1]), x)) for k, x in enumerate(w))
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(w), sum(seen[1][x,] > 0 for x in w), n)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and math.isclose(r["score"], score, rel_tol=1e-9), i
    assert language_model.scored(nothing).count() == 0


def test_language_model_takes_nulls_and_repeats(spark):
    rows = [(None, "a b", "x", 1), (None, "a b", "y", 2), (1, "a b c", "z", 3), (1, "a b c", "z", 3), (3, None, None, 4)]
    got = language_model.scored(spark.createDataFrame(rows, "doc_id long, text string, block string, score long")).collect()
    assert len(got) == 5 and sum(r["doc_id"] is None and r["held_out"] for r in got) == 2
    assert len({r["score"] for r in got if r["doc_id"] == 1}) == 1 and {r["n_tokens"] for r in got if r["doc_id"] == 3} == {1}


def test_automaton_sums_to_one():
    """Over all words, of which training has not seen one, from every state."""
    lm, rng = language_model, np.random.default_rng(4)
    known = np.sort(np.array([5, 9, 14, 1 << 40, lm.END, lm.BEGIN], np.uint64))
    end, unseen = (int(np.searchsorted(known, np.uint64(h))) for h in (lm.END, 14))
    others = [k for k in range(len(known)) if known[k] not in (lm.END, lm.BEGIN) and k != unseen]
    texts = [[*rng.choice(others, rng.integers(0, 7)).tolist(), end] for _ in range(12)] + [[unseen, others[0], end]]
    docs = [np.zeros(13, np.uint64), np.zeros(13, np.uint64), np.arange(13) == 12, np.array([len(t) for t in texts])]
    slab = lm.Slab(dict(block=0, hash=lm.blobs.steps(known), words=lm.blobs.packed(np.array(sum(texts, []))), docs=lm.pack(docs)), 3)
    count = {k: np.bincount(g[slab.train & (g >= 0)], minlength=len(slab.key[k])) for k, g in slab.gram.items()}
    made, _ = lm.automaton(slab, count, {k: ((c > 0).sum(), c.sum()) for k, c in count.items()})
    assert len(made.fail) > 10 and (count[1] == 0).sum() == 2  # the unseen word and the begin mark
    words_ = np.array([k for k in range(len(known)) if k != slab.begin])
    for state in range(len(made.fail)):
        gain, _ = made.step(np.full(len(words_), state), words_)
        assert math.isclose((10**gain).sum(), 1, rel_tol=1e-9), state


def test_token_output(spark, docs, texts, nothing, tmp_path):
    encoder = BatchEncoder.of(default_vocabulary())
    token_output.write_tokens(docs, str(tmp_path / "t"), default_vocabulary())
    got, start = by_id(token_output.read_tokens(spark, str(tmp_path / "t"))), 0
    for i, t in sorted(texts):
        want = np.append(np.array(encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, np.uint32), np.uint32(0)).astype("<u4")
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(want), zlib.crc32(want))
        start += len(want)
    token_output.write_tokens(nothing, str(tmp_path / "n"), default_vocabulary())
    assert token_output.read_tokens(spark, str(tmp_path / "n")).count() == 0


def test_frames_round_trip_and_slice():
    rng = np.random.default_rng(6)
    for n in (0, 1, 127, 128, 129, 5000):
        ids = rng.integers(0, 60, n).astype(np.uint32)
        ids[rng.random(n) < 0.05] = rng.integers(0, 2**32, 1)[0]
        ids[: n // 3] = 7
        frame = token_output.Frame(token_output.pack_frame(np.array([1]), np.array([False]), np.array([n]), ids))
        assert (frame.ids() == ids).all()
        for _ in range(20):
            a, b = sorted(rng.integers(0, n + 1, 2).tolist())
            assert (frame.ids(a, b) == ids[a:b]).all()


def test_chat(spark):
    rows = [(1, 0, "system", "Be # kind"), (1, 1, "user", None), (1, 2, "assistant", "a\\h </turn> ### x"), (2, 5, "user", "only"), (2, 5, "user", "only"), (None, 0, "assistant", "no id"), (3, None, None, "null turn"), (3, 0, "assistant", "")]
    rows += [(4, k, "assistant" if k % 2 else "user", f"turn {k}\n</turn>\n### user:\n") for k in range(700)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    messages = chat.cut(chat.chained(frame), "m")
    chosen = chat.paths(messages.select("node", "parent", chat.F.lit(1.0).alias("score")))
    chats = chat.formatted(chosen.join(messages.drop("parent"), "node"))
    assert chats.where("conv_id = 4").count() == 3
    got = {r["conv_id"]: r for r in chat.digests(chats).collect()}
    for c in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0))
        whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert (got[c]["n_turns"], got[c]["turns_sha256"], got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(own), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_chat_ranks_branches(spark):
    nodes = spark.createDataFrame([(1, None, 1.0), (2, 1, 0.2), (3, 1, 0.9), (4, 3, 0.1), (5, 3, 0.8), (6, 2, 0.3), (7, None, 0.5)], "node long, parent long, score double")
    got = defaultdict(list)
    for r in chat.paths(nodes).orderBy("depth").collect():
        got[r["root"]].append(r["node"])
    assert got == {1: [1, 3, 5], 7: [7]}
    assert chat.paths(nodes, keep=2).select("leaf").distinct().count() == 3


def test_repeats_are_read_off_the_order(monkeypatch):
    """Stretches whose repeats lie apart: without the sort equal strings are no neighbours."""
    rng = np.random.default_rng(17)
    kinds = rng.integers(97, 123, (5, suffix_dedup.STRETCH)).astype(np.uint8)
    pick = rng.integers(0, 5, 60)
    places = np.zeros(60, suffix_dedup.PLACE)
    places["key"], places["high"] = np.arange(60), suffix_dedup.SPAN - 1
    row, seg = np.tile(np.arange(60), 3), np.repeat(np.arange(3), 60)
    at = np.repeat([0, 7, 40], 60)
    want = {(i, a) for i in range(60) for a in (0, 7, 40) if pick[i] in pick[:i]}
    found = lambda: set(zip(*(x.tolist() for x in suffix_dedup.Stretches(kinds[pick]).repeated(row, at, seg, places))))
    assert found() == want
    monkeypatch.setattr(suffix_dedup.Stretches, "sort", lambda self, row, at, seg: row)
    assert found() != want
