"""Exact positions inside ordered groups, with no task that holds a group.

Rows are range-partitioned by (group, order), numbered as each sorted partition streams by, written once, and moved by
the sizes of the partitions before theirs.  A group of any size spreads over as many ranges as it needs; rows that tie
in the whole order are dealt apart by a seeded random column and numbered in any order."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .common import cut


def _number(batches):
    """Rows of a sorted partition, numbered from 0 inside each run of the first column."""
    part, last, run = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        group = batch.column(0)
        edge = np.concatenate([[True], pc.not_equal(group[1:], group[:-1]).to_numpy(zero_copy_only=False).astype(bool)])
        at = np.flatnonzero(edge)
        place = np.arange(n) - np.repeat(at, np.diff(np.append(at, n)))
        first = int(at[1]) if len(at) > 1 else n
        if group[0].as_py() == last:
            place[:first] += run
        last, run = group[n - 1].as_py(), int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(place.astype(np.int64))],
                                         names=[*batch.schema.names, "part", "place"])


def ranked(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``df`` with ``pos``, the row's 0-based position in its group by ``order`` (nulls first), and ``n``, the group's rows.

    ``group`` is not null and the first column; the names pos, n, part, place and toss must be free.  The table of
    partition sizes has a row for each (partition, group in it): groups plus partitions."""
    keys = [group, *order, "toss"]
    sorted_ = df.withColumn("toss", F.rand(17)).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("toss")
    schema = StructType([*df.schema.fields, StructField("part", IntegerType()), StructField("place", LongType())])
    placed = cut(sorted_.mapInArrow(_number, schema))
    before = Window.partitionBy(group).orderBy("part")
    sizes = (placed.groupBy(group, "part").agg(F.count(F.lit(1)).alias("rows"))
             .withColumn("start", F.sum("rows").over(before) - F.col("rows"))
             .withColumn("n", F.sum("rows").over(Window.partitionBy(group))).drop("rows"))
    return (placed.join(sizes, [group, "part"]).withColumn("pos", F.col("start") + F.col("place"))
            .drop("part", "place", "start"))
