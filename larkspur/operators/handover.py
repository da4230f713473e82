"""SRC3: from a table's snapshot to its change stream, without a lock.

The snapshot is read chunk by chunk while the table changes.  Around the read of a chunk two marks are noted, positions
``low`` and ``high`` of the change stream: the chunk's rows hold at least what changed up to ``low`` and at most what changed
up to ``high``.  So a chunk row yields to any change of its key between its marks: the change is in the stream and
at least as new.  A row that does not yield takes the place of the low mark: it holds everything up to there, and nothing of its
key comes before the high mark.  Whoever applies the result in the order of positions ends with the snapshot and all later
changes, each key's newest state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

READ, DELETE = "r", "d"


def handover(chunk_rows: DataFrame, changes: DataFrame, payload: Sequence[str], key: str = "key") -> DataFrame:
    """(key, pos, op, *payload): all changes at their own position, and the chunk rows that do not yield.

    ``chunk_rows``: key, chunk, low, high and payload; ``changes``: key, chunk (the chunk its key falls in), seq, op and
    payload.  The marks are one row a chunk; the keys that changed between their marks are gathered by a partial
    aggregate before any shuffle, so a key with most of the changes costs one row a task."""
    marks = chunk_rows.groupBy("chunk").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    during = (changes.select(key, "chunk", "seq").join(marks, "chunk").where("seq > low and seq <= high").select(key).distinct())
    kept = chunk_rows.join(during, chunk_rows[key].eqNullSafe(during[key]), "left_anti")
    return (changes.select(key, F.col("seq").alias("pos"), "op", *payload)
            .unionByName(kept.select(key, F.col("low").alias("pos"), F.lit(READ).alias("op"), *payload)))


def current_rows(events: DataFrame, payload: Sequence[str], key: str = "key") -> DataFrame:
    """What a table holds after the events (key, pos, op, *payload): each key's last one unless that is a delete.  A
    snapshot row comes after a change of its own position; changes that share a position count in payload order."""
    last = F.max(F.struct("pos", (F.col("op") == READ).alias("read"), *payload, "op"))
    return (events.groupBy(key).agg(last.alias("last")).where(F.col("last.op") != DELETE)
            .select(key, *[F.col(f"last.{c}").alias(c) for c in payload]))
