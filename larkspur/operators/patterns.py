"""Sequence patterns (CEP1-CEP7, UNI1) as closed-form neighbour predicates.

All operators run on ``larkspur.plans.segmented`` so a hot key is split
across tasks.  Orders are made total with a tie-break column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.plans import segmented as S

MATCHED, TIMEOUT = "matched", "timeout"


def bounce_entry(pages: DataFrame) -> Column:
    """Entry page for bounce detection: ``last_page_id`` absent or empty
    (JSON null counts as absent)."""
    return (~F.col("has_last_page")) | F.coalesce(F.col("last_page_id") == "", F.lit(True))


def bounce(pages: DataFrame, window_ms: int = 10_000, key: str = "mid",
           ts: str = "ts_ms", tie: str = "rec_id", entry: Column | None = None,
           max_rows: int | None = None) -> DataFrame:
    """CEP1-CEP3 + CEP6: entry page followed, with strict contiguity, by an
    entry page within ``window_ms`` is a *matched* bounce; an entry whose
    next event is missing or at least ``window_ms`` later is a *timeout*
    bounce.  Returns every emitted entry with ``kind`` and ``next_ts``."""
    e = entry if entry is not None else bounce_entry(pages)
    x = pages.withColumn("_entry", e)
    x = S.assign_segments(x, [key], [ts, tie], max_rows)
    x = S.with_neighbors(x, [key], [ts, tie], [ts, "_entry"], n_next=1)
    n = F.col("next_1")
    gap = n[ts] - F.col(ts)
    matched = n["_entry"] & (gap < window_ms)
    emitted = F.col("_entry") & (n.isNull() | n["_entry"] | (gap >= window_ms))
    out = (x.where(emitted)
            .withColumn("kind", F.when(F.coalesce(matched, F.lit(False)), F.lit(MATCHED)).otherwise(F.lit(TIMEOUT)))
            .withColumn("next_ts", n[ts]))
    return S.drop_segments(out).drop("_entry", "next_1")


def bounce_branches(pages: DataFrame, **kw) -> tuple[DataFrame, DataFrame]:
    """CEP1 (matched) and CEP2 (timeout side output) as two frames."""
    b = bounce(pages, **kw)
    return b.where(F.col("kind") == MATCHED), b.where(F.col("kind") == TIMEOUT)


def union_branches(a: DataFrame, b: DataFrame) -> DataFrame:
    """UNI1: union keeping duplicates, by column name (independent inputs)."""
    return a.unionByName(b)


def union_of_branches(df: DataFrame, *conds: Column) -> DataFrame:
    """UNI1 for branches of one frame (main + side output): the union of
    ``df.where(c)`` for every ``c``, duplicates kept, in a single pass over
    ``df`` (a union of two filtered copies would evaluate ``df`` twice)."""
    x = df.withColumn("_branch", F.explode(F.sequence(F.lit(0), F.lit(len(conds) - 1))))
    keep = F.lit(False)
    for i, c in enumerate(conds):
        keep = keep | ((F.col("_branch") == i) & F.coalesce(c, F.lit(False)))
    return x.where(keep).drop("_branch")


def strict_times(df: DataFrame, cond: Column, n: int, key: str, ts: str, tie: str,
                 payload: Sequence[str] = (), max_rows: int | None = None) -> DataFrame:
    """CEP4 / CEP5: ``n`` consecutive events (strict contiguity) all meeting
    ``cond``; overlapping matches are all kept (no skip).  One row per match
    with ``e1..en`` structs of ``(ts, tie, *payload)``."""
    cols = [ts, tie, *payload]
    x = df.withColumn("_c", cond)
    x = S.assign_segments(x, [key], [ts, tie], max_rows)
    x = S.with_neighbors(x, [key], [ts, tie], cols + ["_c"], n_next=n - 1)
    ok = F.col("_c")
    for i in range(1, n):
        ok = ok & F.coalesce(F.col(f"next_{i}._c"), F.lit(False))
    out = x.where(ok).withColumn("e1", F.struct(*[F.col(c) for c in cols]))
    for i in range(1, n):
        out = out.withColumn(f"e{i + 1}", F.struct(*[F.col(f"next_{i}.{c}").alias(c) for c in cols]))
    return S.drop_segments(out).select(key, *[f"e{i}" for i in range(1, n + 1)])


def strict_times_within(df: DataFrame, cond: Column, n: int, key: str, ts: str, tie: str, within_ms: int,
                        payload: Sequence[str] = (), max_rows: int | None = None) -> DataFrame:
    """CEP6 on CEP4 / CEP5: ``n`` consecutive events meeting ``cond``, all less than ``within_ms`` after the first, and as a
    side output the partial matches that ran out of time.

    Every event meeting ``cond`` starts a partial match.  It grows while the next event comes in time and meets ``cond``, dies
    when one in time does not, and times out when the next one is late or there is none.  One row a start that is *matched*
    (``length`` n) or *timeout* (fewer): ``kind``, ``length`` and ``e1..en`` structs of ``(ts, tie, *payload)``, null from
    ``length`` on."""
    cols = [ts, tie, *payload]
    x = df.withColumn("_c", F.coalesce(cond, F.lit(False)))
    x = S.assign_segments(x, [key], [ts, tie], max_rows)
    x = S.with_neighbors(x, [key], [ts, tie], cols + ["_c"], n_next=n - 1)
    late = [F.col(f"next_{i}").isNull() | (F.col(f"next_{i}.{ts}") - F.col(ts) >= within_ms) for i in range(1, n)]
    # the first event after the start that is late or does not meet the condition decides
    state = F.struct(F.lit(MATCHED).alias("kind"), F.lit(n).alias("length"))
    for i in reversed(range(1, n)):
        state = (F.when(late[i - 1], F.struct(F.lit(TIMEOUT).alias("kind"), F.lit(i).alias("length")))
                 .when(~F.col(f"next_{i}._c"), F.lit(None)).otherwise(state))
    x = x.where(F.col("_c")).withColumn("_state", state).where(F.col("_state").isNotNull())
    first = [F.struct(*[F.col(c) for c in cols]).alias("e1")]
    more = [F.when(F.col("_state.length") > i, F.struct(*[F.col(f"next_{i}.{c}").alias(c) for c in cols])).alias(f"e{i + 1}") for i in range(1, n)]
    return x.select(key, "_state.kind", "_state.length", *first, *more)


def strict_runs(df: DataFrame, cond: Column, key: str, ts: str, tie: str,
                min_len: int = 1, max_rows: int | None = None) -> DataFrame:
    """CEP7: maximal runs of consecutive events meeting ``cond`` (gaps and
    islands): ``(key, run_start_ts, run_end_ts, run_len)``.

    Within a run, the running count of all events and the running count of
    matching events grow together, so their difference identifies the run:
    one segmented pass, then a partial aggregate per (key, run)."""
    x = df.withColumn("_c", F.coalesce(cond, F.lit(False)))
    x = S.assign_segments(x, [key], [ts, tie], max_rows)
    x = S.with_running(x, [key], [ts, tie], aggs=[(F.lit(1).cast("long"), "_n_all", "sum"),
                                                 (F.col("_c").cast("long"), "_n_c", "sum")])
    runs = (x.where(F.col("_c")).withColumn("_run", F.col("_n_all") - F.col("_n_c"))
             .groupBy(key, "_run")
             .agg(F.min(ts).alias("run_start_ts"), F.max(ts).alias("run_end_ts"),
                  F.count(F.lit(1)).alias("run_len")))
    return runs.where(F.col("run_len") >= min_len).drop("_run")
