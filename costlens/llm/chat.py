r"""Operator 10: reply trees as conversations.

Messages form trees by parent links. Self-joins that double the links' reach give every message its depth and the sum
of scores above it, after as many rounds as the depth has bits. Branches (root-to-leaf paths) are ranked by mean score;
the same links, walked back from the chosen leaves, list each path's messages. A path is formatted turn by turn:

    ### role:\n text \n</turn>\n

In roles and texts ``\``, ``#`` and the ``<`` of ``</turn>`` are written ``\\``, ``\h`` and ``\l`` (a role's line break
``\n``), so no control string can occur inside them and reading back restores them. The loss mask covers the trained
role's texts. A conversation is one row, or several rows of ``TURNS`` turns each if it is longer.

Nulls: a null text or role is empty, a null conv_id is a conversation of its own, a null turn comes first; rows of
equal turn follow each other by role and text; branches of equal score by length, then leaf. A long text is one row. An empty table gives only the added conversation. Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table

TURNS = 256
ADDED = -7
ADDED_TEXT = r"\### Assistant: </turn> ok"
HEAD, COLON, TAIL = "### ", ":\n", "\n</turn>\n"


def escaped(text: Column) -> Column:
    out = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("#"), F.lit("\\h"))
    return F.replace(out, F.lit("</turn>"), F.lit("\\l/turn>"))


PLAIN = {"\\\\": "\\", "\\h": "#", "\\l": "<", "\\n": "\n"}
ESCAPE = re.compile(r"\\[\\hln]")


def unescaped(text: str) -> str:
    return ESCAPE.sub(lambda m: PLAIN[m[0]], text) if "\\" in text else text


def depths(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Depth, root and score sum of each node (node, parent, score), and the links of reach 1, 2, 4, ..."""
    names = ["node", "up", "depth", "total", "root"]
    active = cut(nodes.select("node", F.col("parent").alias("up"), F.lit(1).cast("long").alias("depth"), F.col("score").alias("total"), F.when(F.col("parent").isNull(), F.col("node")).alias("root")), "links")
    done, links = active.where(F.col("up").isNull()), []
    active = active.where(F.col("up").isNotNull())
    while not active.isEmpty():
        links.append(active.select("node", "up"))
        # a node that has met its root is done; only the others go on
        above = active.unionByName(done).select(F.col("node").alias("up"), F.col("up").alias("up_"), F.col("depth").alias("d_"), F.col("total").alias("t_"), F.col("root").alias("r_"))
        met = active.join(above, "up").select("node", F.col("up_").alias("up"), (F.col("depth") + F.col("d_")).alias("depth"), (F.col("total") + F.col("t_")).alias("total"), F.col("r_").alias("root"))
        met = cut(met.select(*names), "links")
        done = done.unionByName(met.where(F.col("up").isNull()))
        active = met.where(F.col("up").isNotNull())
    return done.drop("up"), links


def paths(nodes: DataFrame, keep: int = 1) -> DataFrame:
    """Messages of each tree's ``keep`` best branches: node, root, leaf, depth. ``nodes``: node, parent, score.

    Branches rank by mean score, then length, then leaf.
    """
    reach, links = depths(nodes)
    leaves = reach.join(nodes.select(F.col("parent").alias("node")).where("node IS NOT NULL").distinct(), "node", "left_anti")
    rank = F.struct((F.col("total") / F.col("depth")).alias("score"), "depth", (-F.col("node")).alias("first"))
    if keep == 1:
        chosen = leaves.groupBy("root").agg(F.max_by("node", rank).alias("leaf"))
    else:
        place = F.row_number().over(Window.partitionBy("root").orderBy(rank.desc()))
        chosen = leaves.select("root", F.col("node").alias("leaf"), place.alias("place")).where(F.col("place") <= keep).drop("place")
    on_path = cut(chosen.select("leaf", F.col("leaf").alias("node")), "paths")
    for link in links:
        # written each time: a step refers to all before it, so that the plan would double
        on_path = on_path.unionByName(cut(on_path.join(link, "node").select("leaf", F.col("up").alias("node")), "paths"))
    return on_path.join(reach.select("node", "depth", "root"), "node")


def formatted(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """Conversations from turns (conv_id, leaf, depth, role, text): conv_id, leaf, chunk, text and loss spans."""
    role, text = escaped(F.coalesce("role", F.lit(""))), escaped(F.coalesce("text", F.lit("")))
    head = F.concat(F.lit(HEAD), F.replace(role, F.lit("\n"), F.lit("\\n")), F.lit(COLON))
    turn = F.struct("depth", F.concat(head, text, F.lit(TAIL)).alias("text"), F.length(head).alias("at"), F.length(text).alias("size"), F.coalesce(F.col("role") == trained_role, F.lit(False)).alias("loss"))
    rows = turns.select("conv_id", "leaf", F.floor((F.col("depth") - 1) / TURNS).alias("chunk"), turn.alias("turn"))
    grouped = rows.groupBy("conv_id", "leaf", "chunk").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    zero = F.struct(F.lit(0).alias("done"), F.array().cast("array<struct<start:int,stop:int>>").alias("spans"))

    def step(s: Column, t: Column) -> Column:
        span = F.struct((s["done"] + t["at"]).alias("start"), (s["done"] + t["at"] + t["size"]).alias("stop"))
        return F.struct((s["done"] + F.length(t["text"])).alias("done"), F.when(t["loss"], F.array_append(s["spans"], span)).otherwise(s["spans"]).alias("spans"))

    return grouped.select("conv_id", "leaf", "chunk", F.array_join("turns.text", "").alias("text"), F.aggregate("turns", zero, step, lambda s: s["spans"]).alias("loss"))


def parse(text: str) -> Iterator[tuple[str, str]]:
    """Roles and texts of a formatted text."""
    for turn in text.split(TAIL)[:-1]:
        role, _, said = turn[len(HEAD) :].partition(COLON)
        yield unescaped(role), unescaped(said)


def digests(chats: DataFrame) -> DataFrame:
    """Reads conversations back. A long one goes through its task chunk by chunk."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        key, turns, loss = None, hashlib.sha256(), hashlib.sha256()
        n = chars = size = 0

        def row() -> tuple:
            return (key[0], n, turns.hexdigest(), chars, loss.hexdigest(), size)

        for batch in batches:
            rows = []
            for conv, leaf, text, spans in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if (conv, leaf) != key:
                    if key:
                        rows.append(row())
                    key, turns, loss = (conv, leaf), hashlib.sha256(), hashlib.sha256()
                    n = chars = size = 0
                for role, said in parse(text):
                    turns.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                    n += 1
                for span in spans:
                    part = unescaped(text[span["start"] : span["stop"]])
                    loss.update(part.encode("utf-8", "surrogatepass"))
                    chars += len(part)
                size += len(text)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
        if key:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row(), kinds)], names=names)

    ordered = chats.repartition("leaf").sortWithinPartitions("leaf", "chunk")
    return ordered.select("conv_id", "leaf", "text", "loss").mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def chained(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as messages: node, parent, conv_id, role, text. Each row answers the one before.

    Rows are sorted over all partitions, so that a long conversation is spread. Only each partition's first and last row
    meet the driver.
    """
    ranged = rows.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text")
    made = cut(ranged.withColumn("node", F.monotonically_increasing_id()), "messages")
    part = F.shiftright("node", 33)
    ends = made.groupBy(part.alias("part")).agg(F.min("node").alias("first"), F.min_by("conv_id", "node").alias("first_conv"), F.max("node").alias("last"), F.max_by("conv_id", "node").alias("last_conv")).orderBy("part").collect()
    before = [(b["first"], a["last"]) for a, b in zip(ends, ends[1:]) if a["last_conv"] == b["first_conv"]]
    own = made.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv"), (F.col("node") + 1).alias("node"))
    joined = made.join(own, "node", "left").withColumn("parent", F.when(F.col("parent_conv").eqNullSafe(F.col("conv_id")), F.col("parent"))).drop("parent_conv")
    if before:
        links = rows.sparkSession.createDataFrame(before, "node long, crossing long")
        joined = joined.join(F.broadcast(links), "node", "left").withColumn("parent", F.coalesce("parent", "crossing")).drop("crossing")
    return joined


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    added = spark.createDataFrame([(ADDED, 0, "user", ADDED_TEXT), (ADDED, 1, "assistant", ADDED_TEXT)], rows.schema)
    messages = cut(chained(rows.unionByName(added)), "chained")
    # the table has no scores: all branches are equal, and each tree has one
    chosen = paths(messages.select("node", "parent", F.lit(1.0).alias("score")))
    turns = chosen.join(messages.drop("parent"), "node")
    return digests(cut(formatted(turns), "chats"))
