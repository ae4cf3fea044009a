"""Words and beginnings of words that labelled documents tell apart: a statistic for operator 4's decision lists.

A term is a word (a run of letters, in lower case) or its beginning of some lengths. For each term the taught documents
are counted that hold it, those labelled bad and the others. A term is strict or loose by the share of bad ones. Every
document gets the number of its words that hold a strict term and of those that hold a loose one. A taught document's own
count is taken off the terms before its words are judged, so that rules are not learned from what the lexicon remembers.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blobs

WORD = re.compile(r"[^\W\d_]+")
#: Lengths of beginnings; longer words than LONGEST count by their beginnings alone.
BEGINNINGS = (3, 4, 5, 6, 7, 8)
LONGEST = 40
#: Bad documents that hold a term at least, and their share among all that hold it (one more counted on the other side).
LEAST = 5
STRICT, LOOSE = 0.95, 0.6
#: Terms or words that a task remembers at a time.
REMEMBERED = 100_000

#: Term: bad documents and others that hold it.
Lexicon = dict[str, tuple[int, int]]


def terms(word: str) -> list[str]:
    """Beginnings of a word, and itself with a space after it."""
    found = [word[:k] for k in BEGINNINGS if k < len(word)]
    if len(word) <= LONGEST:
        found.append(word + " ")
    return found


def grade(bad: int, others: int) -> int:
    """2: strict, 1: loose, 0: neither."""
    share = bad / (bad + others + 1)
    return 0 if bad < LEAST or share < LOOSE else 1 if share < STRICT else 2


def counter(lexicon: Lexicon) -> Callable[[str, bool | None], tuple[int, int]]:
    """Counts a text's words with a strict term and with a loose or strict one. ``own`` is the label under which the text
    is itself counted in the lexicon, None if it is not to be taken off."""
    judged: dict[bool | None, dict[str, int]] = {}
    heads: dict[bool | None, set[str]] = {}
    for own in (None, False, True):
        found = {t: grade(b - (own is True), o - (own is False)) for t, (b, o) in lexicon.items()}
        judged[own] = {t: g for t, g in found.items() if g}
        heads[own] = {t.rstrip()[: BEGINNINGS[0]] for t in judged[own]}  # other words hold no term
    known: dict[bool | None, dict[str, int]] = {None: {}, False: {}, True: {}}

    def count(text: str, own: bool | None = None) -> tuple[int, int]:
        grades, begun, memory = judged[own], heads[own], known[own]
        if not grades:
            return 0, 0
        listed = [w for w in WORD.findall(text.lower()) if w[: BEGINNINGS[0]] in begun]
        if len(memory) > REMEMBERED:
            memory.clear()
        for word in set(listed).difference(memory):
            memory[word] = max((grades.get(t, 0) for t in terms(word)), default=0)
        of = Counter(map(memory.__getitem__, listed))
        return of[2], of[1] + of[2]

    return count


def counted(taught: DataFrame) -> DataFrame:
    """Terms of rows (bad boolean, text), with the bad rows and others that hold them. A row without a label counts for none."""

    @blobs.lean
    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides: tuple[Counter[str], Counter[str]] = (Counter(), Counter())

        def sums() -> pa.RecordBatch:
            listed = list(sides[0].keys() | sides[1].keys())
            columns = [pa.array(listed, pa.string())] + [pa.array([side[t] for t in listed], pa.int64()) for side in (sides[1], sides[0])]
            for side in sides:
                side.clear()
            return pa.RecordBatch.from_arrays(columns, names=["term", "bad", "others"])

        for batch in batches:
            for bad, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sides[bad].update({t for w in set(WORD.findall(text.lower())) for t in terms(w)})
                if len(sides[0]) + len(sides[1]) > REMEMBERED:
                    yield sums()
        yield sums()

    rows = taught.where(F.col("bad").isNotNull()).select("bad", "text").mapInArrow(held, "term string, bad long, others long")
    return rows.groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("others").alias("others"))


def learn(taught: DataFrame) -> Lexicon:
    """The lexicon of rows (bad boolean, text): its terms number at most what so many labelled texts hold."""
    rows = counted(taught)
    rows = rows.where((F.col("bad") >= LEAST) & (F.col("bad") >= LOOSE * (F.col("bad") + F.col("others"))))
    return {r["term"]: (r["bad"], r["others"]) for r in rows.collect()}
