"""Operator 4's lexicon: learned words and beginnings, and the toxic documents that its rules find."""

import random

from costlens.llm import lexicon, quality

SCHEMA = "doc_id long, text string"


def made(n, seed=3):
    """n documents; of every eighth the words hold one of two marks: a word, or a beginning of invented words."""
    rng = random.Random(seed)
    plain = ["".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(2, 9))) for _ in range(500)]
    rows = []
    for k in range(n):
        said = [rng.choice(plain) for _ in range(rng.randint(40, 120))]
        if k % 8 == 0:
            for _ in range(6):
                said[rng.randrange(len(said))] = "Nastyword" if k % 16 else "ürgh" + rng.choice(plain)
        rows.append((k, " ".join(said)))
    return rows


def test_toxic_documents_are_found_held_out(spark):
    rows = made(1600)
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(k, 1, int(k % 8 == 0)) for k, _ in rows if k % 3], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["kept"] for r in quality.apply(docs, labels).collect()}
    held_out = [k for k, _ in rows if k % 3 == 0]
    caught = [k for k in held_out if k % 8 == 0 and not got[k]]
    assert len(caught) >= 0.95 * sum(k % 8 == 0 for k in held_out)
    assert all(got[k] for k in held_out if k % 8)
    assert {r["doc_id"] for r in quality.apply_to(docs, labels).collect()} == {k for k in got if got[k]}


def test_labels_with_gaps(spark):
    rows = made(400) + [(None, "nastyword " * 40), (1000, None), (1001, "")]
    docs = spark.createDataFrame(rows + rows[:1], SCHEMA)
    ids = [k for k, _ in rows if k is not None]
    for labels in (
        spark.createDataFrame([(k, None, int(k % 8 == 0)) for k in ids] + [(5, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int"),
        spark.createDataFrame([(k, 1, None) for k in ids], "doc_id long, quality int, toxic int"),
        spark.createDataFrame([(k, 1) for k in ids], "doc_id long, quality int"),
        spark.createDataFrame([], "doc_id long, quality int, toxic int"),
    ):
        got = [r for r in quality.apply(docs, labels).collect()]
        assert len(got) == len(rows) + 1
        dropped = {r["doc_id"] for r in got if not r["kept"] and not r["base_failed"]}
        toxic = "toxic" in labels.columns and labels.where("toxic = 1").count() > 0
        assert dropped == ({k for k in ids if k % 8 == 0 and k < 400} if toxic else set())


def test_terms_are_judged_without_the_text_itself(spark):
    rows = [(True, "Vile thing")] * lexicon.LEAST + [(False, "thing " + "y" * 90), (None, "vile")]
    found = lexicon.learn(spark.createDataFrame(rows, "bad boolean, text string"))
    assert found["vile "] == (lexicon.LEAST, 0) and found["vil"] == (lexicon.LEAST, 0) and found["thing "] == (lexicon.LEAST, 1)
    assert not any(t.startswith("y") for t in found)
    count = lexicon.counter({"vile ": (lexicon.LEAST, 0), "thi": (38, 1)})  # a loose term and a strict one
    assert count("vile VILE, thing", None) == (1, 3)
    assert count("vile thing", True) == (0, 1)  # its own count off, one is too rare and one no more than loose
    assert count("thing", False) == (1, 1)
    assert lexicon.counter({})("vile", None) == (0, 0) and count("", None) == (0, 0)


def test_counts_are_those_of_every_term_of_every_word():
    rng = random.Random(8)
    words = ["".join(rng.choice("abç") for _ in range(rng.randint(1, 9))) for _ in range(400)]
    listed = sorted({t for w in words for t in lexicon.terms(w)})
    found = {t: (rng.randint(5, 60), rng.randint(0, 30)) for t in rng.sample(listed, 60)}
    count = lexicon.counter(found)
    for own in (None, False, True):
        for _ in range(40):
            said = rng.sample(words, rng.randint(0, 50))
            grades = [max((lexicon.grade(found[t][0] - (own is True), found[t][1] - (own is False)) for t in lexicon.terms(w) if t in found), default=0) for w in said]
            assert count(", ".join(said).upper().replace("Ç", "ç"), own) == (sum(g == 2 for g in grades), sum(g > 0 for g in grades))


def test_verdicts_read_again_from_the_list(spark):
    """kept is what a plain reading of the learned list says of the statistics."""
    rows = made(900)
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(k, int(k % 5 > 0), int(k % 8 == 0)) for k, _ in rows if k % 3], "doc_id long, quality int, toxic int")
    rules, marking = quality.teach(docs, labels)
    assert rules and marking
    features = quality.FEATURES + quality.LEXICAL
    stats = quality.with_statistics(docs, ["doc_id"], marking).collect()
    value = lambda r, f: float(r[f[0]]) if f[1] is None else r[f[0]] / max(r[f[1]], 1)
    want = {}
    for r in stats:
        holds = lambda t: (value(r, features[t.feature]) >= t.threshold) == t.above  # noqa: B023, E731
        failed = r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]
        want[r["doc_id"]] = not failed and not any(all(map(holds, rule)) for rule in rules)
    assert {r["doc_id"]: r["kept"] for r in quality.apply(docs, labels).collect()} == want and not all(want.values())
