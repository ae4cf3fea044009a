"""Positions and running totals of groups that may be larger than any task holds.

Rows are sorted over all partitions by group and order, so that one large group is spread over many. Each task numbers its
own rows; a group that runs on from the partition before needs what came before it there, which is one number for each
partition. Only these meet the driver: as many rows as there are partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from . import blobs
from .common import cut


def differs(column: pa.Array, before: pa.Scalar | None) -> list[bool]:
    """Whether each value is another than the one before it; null is a value. ``before`` is the value before the first."""
    if not len(column):
        return []
    first = before is None or column[0].as_py() != before.as_py()
    left, right = column.slice(0, len(column) - 1), column.slice(1)
    same = pc.if_else(pc.or_(pc.is_null(left), pc.is_null(right)), pc.and_(pc.is_null(left), pc.is_null(right)), pc.equal(left, right))
    return [first, *pc.invert(same).to_pylist()]


def edges(made: DataFrame, *carried: str) -> list[Row]:
    """Of each partition, in order: part, its first group and its last, the rows of the last group, and of the last row
    the columns ``carried``. ``made`` has part, at (place in the partition), n (place in the group's run) and g."""
    last = F.max_by(F.struct("g", "n", *carried), "at").alias("last")
    return made.groupBy("part").agg(F.min_by(F.struct("g"), "at").alias("first"), last).orderBy("part").collect()


def placed(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with column place: the place, from 0, among the rows of equal ``group``, by ``order``, nulls first.

    The columns part, at, n and g are used on the way; ``rows`` must not have them.
    """

    @blobs.lean
    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, n, before = TaskContext.get().partitionId(), 0, -1, None
        for batch in batches:
            places = []
            for new in differs(key := batch.column(batch.num_columns - 1), before):
                n = 0 if new else n + 1
                places.append(n)
            if batch.num_rows:
                before = key[batch.num_rows - 1]
            columns = [pa.array([part] * batch.num_rows, pa.int32()), pa.array(range(at, at + batch.num_rows), pa.int64()), pa.array(places, pa.int64())]
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, "part", "at", "n"])

    keyed = rows.withColumn("g", F.col(group))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema)
    ranged = keyed.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    made = cut(ranged.mapInArrow(numbered, f"{schema}, part int, at long, n long"), "placed")
    return carry_over(made).drop("part", "at", "n", "g")


def carry_over(made: DataFrame) -> DataFrame:
    """Adds place to rows numbered by partition."""
    before, carry = None, []
    for e in edges(made):
        add = before[1] if before is not None and before[0] == e["first"]["g"] else 0
        carry.append((e["part"], add))
        spans = e["last"]["g"] == e["first"]["g"]
        before = (e["last"]["g"], e["last"]["n"] + 1 + (add if spans else 0))
    # rows of a partition's first group have the same place in it as in the group's run
    added = made.sparkSession.createDataFrame(carry, "part int, add long")
    return made.join(F.broadcast(added), "part").withColumn("place", F.col("n") + F.when(F.col("at") == F.col("n"), F.col("add")).otherwise(0)).drop("add")
