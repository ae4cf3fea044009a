"""Items longer than a window, and paraphrases, in op5_decontamination."""

from __future__ import annotations

import random

from costlens.llm import decontamination


def test_long_items_and_paraphrases_match(spark):
    random.seed(21)
    vocabulary = ["".join(random.choice("ghijklmn") for _ in range(random.randint(2, 8))) for _ in range(900)]
    say = lambda n: " ".join(random.choice(vocabulary) for _ in range(n))
    items = [(k, say((30, 70, 200, 300, 400, 700)[k % 6]) + ".") for k in range(24)]
    rows, want = [(k, say(500)) for k in range(40)], set()
    for k, text in items:
        if k % 2:  # every fourth word another
            said = text.split()
            said[::4] = [random.choice(vocabulary) for _ in said[::4]]
            text = " ".join(said)
        rows.append((100 + k, say(random.randint(0, 150)) + " " + text + " " + say(random.randint(0, 150))))
        want.add((100 + k, k))
    frame, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.matches(frame, bench).collect()} == want
