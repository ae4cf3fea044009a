"""Operator 11: a Merkle manifest of documents.

A leaf is the SHA-256 of a row's fields. Per source, leaves ascend by doc_id (rows of equal doc_id by leaf); every
``FANOUT`` consecutive nodes, the last ones fewer, become the SHA-256 of their digests until one is left, the source's
subroot; subroots, by source, become the root in the same way.

Places of leaves come from a sort over all partitions (``ranges.placed``), so a source with a third of all rows is spread.
Then superblocks: ``FANOUT ** LEVELS`` consecutive nodes of a source are one group, in which ``applyInPandas`` collapses
``LEVELS`` levels at once and keeps each node's siblings (its lower proof). The block roots are reduced in the same way
until each source has one, so n rows take log(n) / log(FANOUT ** LEVELS) rounds and no group is larger than a superblock.
A proof is a lower proof followed by its block's; the latter is handed down once a block, not once a leaf.

A proof is bytes: for each level one that tells how many siblings stand left and right (four bits each), then their
digests. So ``fold`` needs nothing else to get from a leaf to the root.

Nulls: a null field is ``-``; a null source is a source of its own, the first; rows without doc_id come first in it and
are not tampered with. Repeated rows are leaves of their own, ties fall to the lesser leaf. Texts may be of any length:
only their digests move. An empty table has no rows and no root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import blobs
from .common import cut, drop, table
from .ranges import placed

FANOUT = 3
#: Levels that one group collapses.
LEVELS = 6
WIDTH = FANOUT**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Bytes of a digest.
SIZE = 32
BLOCK = "none boolean, source string, block long, root binary, tags array<string>, leaves array<binary>, changed array<binary>, proofs array<binary>"
KEY = ["none", "source", "block"]


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(fields: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, fields)).cast("binary"), 256))


def above(run: list[bytes]) -> bytes:
    """The node over a run of nodes: digests are hashed as hex text."""
    return hashlib.sha256("".join(d.hex() for d in run).encode()).digest()


def collapse(nodes: list[bytes], levels: int | None) -> tuple[bytes, list[bytes]]:
    """The node above all after so many levels (None: as many as leave one), and each node's proof up to it."""
    proofs = [bytearray() for _ in nodes]
    below, done = [[i] for i in range(len(nodes))], 0
    while len(nodes) > 1 if levels is None else done < levels:
        over, under = [], []
        for a in range(0, len(nodes), FANOUT):
            run = nodes[a : a + FANOUT]
            for k in range(len(run)):
                step = bytes([k << 4 | len(run) - 1 - k]) + b"".join(run[:k] + run[k + 1 :])
                for i in below[a + k]:
                    proofs[i] += step
            over.append(above(run))
            under.append([i for part in below[a : a + FANOUT] for i in part])
        nodes, below, done = over, under, done + 1
    return nodes[0], [bytes(p) for p in proofs]


def steps(proof: bytes) -> Iterator[tuple[list[bytes], list[bytes]]]:
    """Left and right siblings, level by level."""
    at = 0
    while at < len(proof):
        left, right = proof[at] >> 4, proof[at] & 15
        found = [proof[at + 1 + SIZE * k : at + 1 + SIZE * (k + 1)] for k in range(left + right)]
        yield found[:left], found[left:]
        at += 1 + SIZE * (left + right)


def fold(leaf: bytes, proof: bytes) -> bytes:
    """The root that a leaf and its proof lead to."""
    for left, right in steps(proof):
        leaf = above([*left, leaf, *right])
    return leaf


def superblocks(nodes: DataFrame) -> DataFrame:
    """One row for each superblock of nodes (none, source, place, digest, tag, changed), with its root and the proofs of
    its nodes, in the order of places."""

    def reduce(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place")
        first, leaves = group.iloc[0], [bytes(d) for d in group["digest"]]
        # a first block that is not full is its source's only one
        root, proofs = collapse(leaves, None if first["block"] == 0 and len(leaves) < WIDTH else LEVELS)
        changed = [None if c is None else bytes(c) for c in group["changed"]]
        return pd.DataFrame([{"none": first["none"], "source": first["source"], "block": first["block"], "root": root, "tags": list(group["tag"]), "leaves": leaves, "changed": changed, "proofs": proofs}])

    rows = nodes.withColumn("block", F.floor(F.col("place") / WIDTH).cast("long"))
    return cut(rows.groupBy(*KEY).applyInPandas(reduce, BLOCK), "superblocks")


def reduced(nodes: DataFrame) -> list[DataFrame]:
    """Superblocks of nodes, of their roots and so on; the last has one block for each source."""
    rounds = [superblocks(nodes)]
    while rounds[-1].where("block > 0").limit(1).count():
        up = rounds[-1].select("none", "source", F.col("block").alias("place"), F.col("root").alias("digest"), F.lit(None).cast("string").alias("tag"), F.lit(None).cast("binary").alias("changed"))
        rounds.append(superblocks(up))
    return rounds


def handed_down(rounds: list[DataFrame], upper: DataFrame, names: list[str]) -> DataFrame:
    """The blocks of the first round with proof, their way to the root. ``upper`` (none, source, proof and ``names``) has
    that of each source's subroot."""
    blocks = rounds[-1].join(upper, ["none", "source"])
    for lower in rounds[-2::-1]:
        each = blocks.select("none", "source", "block", "proof", *names, F.posexplode("proofs").alias("k", "own"))
        each = each.select("none", "source", (F.col("block") * WIDTH + F.col("k")).alias("block"), F.concat("own", "proof").alias("proof"), *names)
        blocks = lower.join(each, KEY)
    return blocks


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Of each row of ``docs``: tag (doc_id as text), leaf, changed (leaf of the row with ``tampered`` as its text, null
    without), own and shared proof, subroot and root, all as bytes."""
    fields = [F.col(c) for c in FIELDS]
    changed = F.lit(None).cast("binary") if tampered is None else digest([*fields[:-1], tampered])
    leaves = docs.select(F.col("source").isNull().alias("none"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), F.col("doc_id").cast("long").alias("doc_id"), digest(fields).alias("digest"), changed.alias("changed"))
    leaves = cut(leaves.withColumn("row", F.monotonically_increasing_id()), "leaves")
    # null first, then by bytes; rows that are wholly alike are told apart by their place in the table
    keyed = leaves.withColumn("key", F.when(~F.col("none"), F.col("source")))
    nodes = placed(keyed, "key", ["doc_id", "digest", "row"])
    rounds = reduced(nodes.select("none", "source", "place", "digest", F.col("doc_id").cast("string").alias("tag"), "changed"))
    drop(leaves)
    drop(nodes)
    ends = rounds[-1].select(F.when(~F.col("none"), F.col("source")).alias("key"), "none", "source", "root")
    tops = placed(ends.withColumn("all", F.lit(0)), "all", ["key"])
    top = reduced(tops.select(F.lit(False).alias("none"), F.lit("").alias("source"), "place", F.col("root").alias("digest"), F.lit(None).cast("string").alias("tag"), F.lit(None).cast("binary").alias("changed")))
    root = top[-1].select("none", "source", F.lit(b"").alias("proof"), F.col("root").alias("whole"))
    ways = handed_down(top, root, ["whole"]).select("block", "proof", "whole", F.posexplode("proofs").alias("k", "own"))
    ways = ways.select((F.col("block") * WIDTH + F.col("k")).alias("place"), F.concat("own", "proof").alias("proof"), "whole")
    upper = tops.join(ways, "place").select("none", "source", "proof", F.col("root").alias("subroot"), "whole")
    blocks = handed_down(rounds, upper, ["subroot", "whole"])
    each = F.arrays_zip("tags", "leaves", "changed", "proofs")
    listed = blocks.select("proof", "subroot", F.col("whole").alias("root"), F.explode(each).alias("e"))
    return listed.select(F.col("e.tags").alias("tag"), F.col("e.leaves").alias("leaf"), F.col("e.changed").alias("changed"), F.col("e.proofs").alias("own"), "proof", "subroot", "root")


def checked(listed: DataFrame) -> DataFrame:
    """Digests of proofs, and the root that each row's changed leaf, or else its own, leads to."""
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "n_siblings"]
    kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_(), pa.int64()]

    @blobs.lean
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for tag, leaf, changed, own, upper, subroot, root in zip(*(c.to_pylist() for c in batch.columns)):
                proof = own + upper
                siblings = [d.hex() for left, right in steps(proof) for d in left + right]
                folded = fold(leaf if changed is None else changed, proof)
                said = hashlib.sha256("".join(siblings).encode()).hexdigest()
                rows.append((None if tag is None else int(tag), leaf.hex(), subroot.hex(), root.hex(), said, folded.hex(), folded == root, len(siblings)))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * len(names), kinds)], names=names)

    order = ["tag", "leaf", "changed", "own", "proof", "subroot", "root"]
    return listed.select(*order).mapInArrow(check, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, n_siblings long")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    even = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 2 == 0
    text = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return checked(manifest(docs, text))
