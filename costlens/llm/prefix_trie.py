"""Operator 13: the trie of conversations' common beginnings.

A node is a distinct sequence of first turns. A conversation's turns are numbered and hashed in order of their places; both
run over all partitions (``ranges``), so one conversation may be of any length. A prefix is known by a polynomial of its
turns' MD5 digests modulo 2**127 - 1: what a partition computes from the middle of a conversation is joined to what came
before with one multiplication.

Sums over subtrees go by heavy paths. A node's heavy child is the one with most conversations (the least conv_id of equal
ones). Pointer doubling along heavy edges finds each node's path; no two nodes ever point to the same one, so these joins
have no hot keys. Below a light edge a node has at most half its parent's conversations: paths whose heads have 2**k to
2**(k+1) - 1 conversations hang only on paths of greater k. So one round for each k, from the least, sums up a path's
values from its end (in arrays of ``SEGMENT`` nodes, then over these) and adds the path's total to its head's parent:
as many rounds as the number of conversations has bits.

Nulls: a null role or text is empty, a null turn comes first; rows of equal turn follow each other by role and by the MD5
digest of their text. Rows without conv_id belong to no conversation and are left out. Repeated rows are turns of their
own. Texts may be of any length: only their digests move. An empty table has no nodes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import blobs
from .common import cut, drop, table
from .ranges import differs, edges, placed

#: Modulus, base and start of the polynomials; fixed values.
PRIME = 2**127 - 1
BASE = 0x3C6EF372FE94F82BA54FF53A5F1D36F1
START = 1
ROOT = START.to_bytes(16, "big")
#: Conversations share the beginning of the one whose id is a multiple of FAMILY, up to LONGEST turns.
FAMILY, LONGEST = 100, 5
#: Nodes of a path that are one array.
SEGMENT = 1024
#: Parents with more than one in so many of all nodes as children are joined apart.
SHARE = 1000
#: Conversation ids that are one piece of a digest's input.
PIECE = 50_000


def hashed(rows: DataFrame) -> DataFrame:
    """``rows`` (conv, part_, place, turn binary, size) in order, with depth (from 1), key and parent (prefixes' hashes).

    Those that a task begins in the middle of a conversation are completed by what the partitions before found.
    """

    @blobs.lean
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, n, before, state = TaskContext.get().partitionId(), 0, -1, None, 0
        for batch in batches:
            places, keys, parents = [], [], []
            for new, turn in zip(differs(batch.column(0), before), batch.column(1).to_pylist()):
                # a conversation that begins here has the start's value; one that runs on gets it later
                n, state = (0, START if at + len(places) else 0) if new else (n + 1, state)
                parents.append(state.to_bytes(16, "big"))
                state = (state * BASE + int.from_bytes(turn, "big") + 1) % PRIME
                keys.append(state.to_bytes(16, "big"))
                places.append(n)
            if batch.num_rows:
                before = batch.column(0)[batch.num_rows - 1]
            columns = [pa.array([part] * batch.num_rows, pa.int32()), pa.array(range(at, at + batch.num_rows), pa.int64()), pa.array(places, pa.int64()), pa.array(keys, pa.binary()), pa.array(parents, pa.binary())]
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *columns], names=["g", "size", "part", "at", "n", "key", "parent"])

    order = ["conv", "own", "place"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "turn", "size")
    made = cut(ranged.mapInArrow(local, "g long, size long, part int, at long, n long, key binary, parent binary"), "prefixes")
    return completed(made)


def completed(made: DataFrame) -> DataFrame:
    """Gives the first conversation of each partition its hash and depth from what the partitions before hold of it."""
    carry: dict[int, tuple[int, int]] = {}
    before: tuple[int, int, int] | None = None
    for e in edges(made, "key"):
        runs_on = before is not None and before[0] == e["first"]["g"]
        done, state = (before[1], before[2]) if runs_on else (0, START)
        carry[e["part"]] = (done, state)
        n, key = e["last"]["n"] + 1, int.from_bytes(e["last"]["key"], "big")
        if e["last"]["g"] == e["first"]["g"]:
            n, key = n + done, (state * pow(BASE, n, PRIME) + key) % PRIME
        before = (e["last"]["g"], n, key)

    @blobs.lean
    def complete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv", "size", "depth", "key", "parent"]
        for batch in batches:
            conv, size, part, at, n, key, parent = (c.to_pylist() for c in batch.columns)
            power: dict[int, tuple[int, int]] = {}
            for i, p in enumerate(part):
                if at[i] != n[i]:  # not the partition's first conversation
                    continue
                done, state = carry[p]
                k, lift = power.get(p, (-1, 0))
                lift = lift * BASE % PRIME if k == n[i] - 1 and k >= 0 else state * pow(BASE, n[i], PRIME) % PRIME
                power[p] = (n[i], lift)
                parent[i] = ((lift + int.from_bytes(parent[i], "big")) % PRIME).to_bytes(16, "big")
                key[i] = ((lift * BASE + int.from_bytes(key[i], "big")) % PRIME).to_bytes(16, "big")
                n[i] += done
            columns = [pa.array(conv, pa.int64()), pa.array(size, pa.int64()), pa.array([x + 1 for x in n], pa.int64()), pa.array(key, pa.binary()), pa.array(parent, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return made.select("g", "size", "part", "at", "n", "key", "parent").mapInArrow(complete, "conv long, size long, depth long, key binary, parent binary")


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Prefixes of the rebuilt conversations (conv, size, depth, key, parent), and all conversations (conv)."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    said = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    turns = rows.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("no"), role.alias("role"), F.md5(text.cast("binary")).alias("tie"), said.alias("turn"), F.char_length(text).cast("long").alias("size"))
    turns = cut(placed(turns, "conv", ["no", "role", "tie"]).select("conv", "place", "turn", "size"), "turns")
    shared = (F.crc32(F.col("conv").cast("string").cast("binary")) % (LONGEST + 1)).alias("shared")
    convs = cut(turns.select("conv").distinct().select("conv", (F.col("conv") - F.col("conv") % FAMILY).alias("base"), shared), "convs")
    # at most LONGEST turns of a conversation are lent, to the less than 2 * FAMILY ids that it is the base of
    lent = turns.where((F.col("conv") % FAMILY == 0) & (F.col("place") < LONGEST)).withColumnRenamed("conv", "base")
    begun = convs.join(lent, "base").where(F.col("place") < F.col("shared")).select("conv", F.lit(0).alias("own"), "place", "turn", "size")
    kept = turns.where(F.col("place") >= shared).select("conv", F.lit(1).alias("own"), "place", "turn", "size")
    prefixes = cut(hashed(begun.unionByName(kept)), "prefixes")
    drop(turns)
    return prefixes, convs.select("conv")


def tree(prefixes: DataFrame, convs: DataFrame) -> DataFrame:
    """Nodes: key, parent, depth, size, n_convs, conv (least member), n_children, up (parent if it is its heavy child)."""
    # all of a node's rows agree in depth, parent and size
    counted = prefixes.groupBy("key", "parent", "depth", "size").agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv"))
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv")).where("n_convs > 0")
    root = root.select(F.lit(ROOT).alias("key"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("size"), "n_convs", "conv")
    nodes = cut(counted.unionByName(root), "nodes")
    families = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("above")).agg(F.count("*").alias("n_children"), F.max_by("key", F.struct("n_convs", (-F.col("conv")).alias("first"))).alias("heavy"))
    families = cut(families, "families")
    nodes_ = nodes.join(families.select("above", "n_children"), nodes["key"] == families["above"], "left").drop("above")
    heavy = families.select(F.col("heavy"), F.col("above").alias("up"))
    out = nodes_.join(heavy, F.col("key") == F.col("heavy"), "left").drop("heavy").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    out = cut(out, "tree")
    drop(nodes)
    drop(families)
    return out


def paths(nodes: DataFrame) -> DataFrame:
    """key, head (the first node of its heavy path), weight (the head's conversations), by pointer doubling."""
    state = nodes.select("key", "up", F.when(F.col("up").isNull(), F.col("key")).alias("head"), F.when(F.col("up").isNull(), F.col("n_convs")).alias("weight"))
    done, active = state.where("up IS NULL").drop("up"), cut(state.where("up IS NOT NULL").select("key", "up"), "pointers")
    while active.limit(1).count():
        # a pointer meets a node that knows its head, or one that points further
        known = done.select(F.col("key").alias("up"), F.lit(None).cast("binary").alias("next"), "head", "weight")
        going = active.select(F.col("key").alias("up"), F.col("up").alias("next"), F.lit(None).cast("binary").alias("head"), F.lit(None).cast("long").alias("weight"))
        met = cut(active.join(known.unionByName(going), "up").select("key", F.col("next").alias("up"), "head", "weight"), "pointers")
        done = done.unionByName(met.where("up IS NULL").drop("up"))
        active = met.where("up IS NOT NULL").select("key", "up")
    return done


def with_parents(nodes: DataFrame, columns: list[str]) -> DataFrame:
    """Each node's parent's columns, with ``above_`` before their names; null for the root.

    Nodes with more than one in ``SHARE`` of all nodes as children number less than ``SHARE`` and are broadcast.
    """
    renamed = [F.col(c).alias(f"above_{c}") for c in columns]
    total = nodes.count()
    many = F.col("n_children") * SHARE > total
    hot = F.broadcast(nodes.where(many).select(F.col("key").alias("parent"), *renamed))
    other = nodes.where(~many & (F.col("n_children") > 0)).select(F.col("key").alias("parent"), *renamed)
    by_hot = nodes.join(hot, "parent")
    by_other = nodes.join(hot.select("parent"), "parent", "left_anti").join(other, "parent", "left")
    return by_hot.unionByName(by_other, allowMissingColumns=True)


def subtree_sums(nodes: DataFrame, values: list[str]) -> DataFrame:
    """key and the sums of ``values`` (none negative) over each node's subtree. ``nodes``: key, parent, depth, head,
    weight, values."""
    held = cut(nodes.withColumn("level", F.length(F.bin("weight"))).sortWithinPartitions("level"), "levels")
    within = Window.partitionBy("head", "segment").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    later = Window.partitionBy("head").orderBy(F.desc("segment")).rowsBetween(Window.unboundedPreceding, -1)
    out, brought = held.where(F.lit(False)).select("key", *values), None
    for k in sorted(r["level"] for r in held.select("level").distinct().collect()):  # as many as a count has bits
        own = held.where(F.col("level") == k).withColumn("segment", F.floor(F.col("depth") / SEGMENT))
        if brought is not None:  # what light paths bring, one row a parent
            sums = brought.groupBy("parent").agg(*(F.sum(v).alias(f"{v}_") for v in values)).withColumnRenamed("parent", "key")
            own = own.join(sums, "key", "left").withColumns({v: F.col(v) + F.coalesce(F.col(f"{v}_"), F.lit(0)) for v in values})
        summed = own.select("key", "parent", "head", "segment", *(F.sum(v).over(within).alias(v) for v in values))
        # the first node of a segment holds its total; those of later segments are added
        totals = summed.groupBy("head", "segment").agg(*(F.max(v).alias(v) for v in values))
        totals = totals.select("head", "segment", *(F.coalesce(F.sum(v).over(later), F.lit(0)).alias(f"{v}_") for v in values))
        whole = summed.join(totals, ["head", "segment"]).select("key", "parent", "head", *((F.col(v) + F.col(f"{v}_")).alias(v) for v in values))
        whole = cut(whole, "sums")
        heads = whole.where("key = head AND parent IS NOT NULL").select("parent", *values)
        brought = heads if brought is None else brought.unionByName(heads)
        out = out.unionByName(whole.select("key", *values))
    return out


def end_digests(ends: DataFrame) -> DataFrame:
    """key and ends_sha256 of rows (key, conv). Ids are put together in pieces before a node's pieces meet."""

    @blobs.lean
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["key", "first", "listed"], [pa.binary(), pa.int64(), pa.binary()]
        key, found = None, []

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((key, found[0], ",".join(map(str, found)).encode()), kinds)], names=names)

        for batch in batches:
            for k, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if found and (k != key or len(found) == PIECE):
                    yield row()
                    found = []
                key = k
                found.append(conv)
        if found:
            yield row()

    @blobs.lean
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, hashlib.sha256()
        for batch in batches:
            rows = []
            for k, listed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k != key:
                    if key is not None:
                        rows.append((key, digest.hexdigest()))
                    key, digest = k, hashlib.sha256(listed)
                else:
                    digest.update(b"," + listed)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.binary(), pa.string()))], names=["key", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()], pa.string())], names=["key", "ends_sha256"])

    ranged = ends.repartitionByRange("key", "conv").sortWithinPartitions("key", "conv").select("key", "conv")
    listed = ranged.mapInArrow(pieces, "key binary, first long, listed binary")
    met = listed.repartition("key").sortWithinPartitions("key", "first").select("key", "listed")
    return cut(met.mapInArrow(digests, "key binary, ends_sha256 string"), "ends")


def trie(rows: DataFrame) -> DataFrame:
    """The nodes of rows (conv_id, turn, role, text), as op13's contract says."""
    prefixes, convs = rebuilt(rows)
    nodes = tree(prefixes, convs)
    last = prefixes.groupBy(F.col("conv").alias("conv_")).agg(F.max_by("key", "depth").alias("key"))
    ends = convs.join(last, F.col("conv") == F.col("conv_"), "left").select(F.coalesce("key", F.lit(ROOT)).alias("key"), "conv")
    ended = end_digests(ends)
    own = nodes.join(paths(nodes), "key").select("key", "parent", "depth", "head", "weight", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"))
    sums = subtree_sums(own, ["n_leaves", "saved_tokens"])
    whole = with_parents(nodes, ["conv"]).join(sums, "key").join(ended, "key", "left")
    none = hashlib.sha256(b"").hexdigest()
    return whole.select(F.col("conv").alias("conv_id"), "depth", F.col("above_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))
