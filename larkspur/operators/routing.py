"""Config-driven routing of change events (RTE1-RTE4, DDL1, SNK2, SNK4).

Config records arrive as a change feed of ``table_process`` rows.  Routing
joins every data record to the config of its ``(table, operation)`` pair,
prunes the payload to the configured columns, stamps ``sink_table`` and
splits by sink type: ``kafka`` -> topic output, ``hbase`` -> dimension
upsert, anything else (or no config) -> dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions import json as J
from larkspur.plans import asof as A

SINK_KAFKA, SINK_HBASE, SINK_CLICKHOUSE = "kafka", "hbase", "clickhouse"   # fixed sink names
# JSN8: fields of a routing-config record (fixed names).
CFG_FIELDS = ["source_table", "operate_type", "sink_type", "sink_table", "sink_columns", "sink_pk", "sink_extend"]
_CFG_DDL = ", ".join(f"{f} string" for f in CFG_FIELDS)
DEFAULT_PK = "id"
DEFAULT_DIM_SCHEMA = "DIM"


def decode_config_feed(feed: DataFrame, value: str = "value") -> DataFrame:
    """JSN8: decode config envelopes.  ``accepted`` is false for records
    without ``source_table`` (e.g. deletes with empty data) and for records
    carrying unknown fields (strict binding)."""
    feed = J.with_parsed(feed, value, "_fv")
    v = F.col("_fv")
    m = F.try_variant_get(v, "$.data", "map<string,variant>")
    known = F.array(*[F.lit(c) for c in CFG_FIELDS])
    unknown = F.coalesce(F.size(F.array_except(F.map_keys(m), known)) > 0, F.lit(False))
    cfg = F.try_variant_get(v, "$.data", f"struct<{_CFG_DDL}>")
    x = feed.select("*", J.path(v, "$.type", "string").alias("type"), cfg.alias("_cfg"),
                    unknown.alias("_unknown"))
    return (x.select(*[c for c in feed.columns if c not in (value, "_fv")], "type",
                     *[F.col(f"_cfg.{c}").alias(c) for c in CFG_FIELDS],
                     (F.col("_cfg.source_table").isNotNull() & ~F.col("_unknown")).alias("accepted")))


# Optional operation-name aliases for config rows (config tables often say
# ``insert`` where change events say ``create``).  Off by default: exact match.
INSERT_AS_CREATE = {"insert": "create"}


def config_versions(feed: DataFrame, op_aliases: dict[str, str] | None = None) -> DataFrame:
    """Accepted config rows with their arrival ``seq``.  ``op_aliases`` maps
    config operation names onto change-event names (e.g. INSERT_AS_CREATE)."""
    v = decode_config_feed(feed).where(F.col("accepted")).drop("accepted")
    if op_aliases:
        ot = F.col("operate_type")
        mapped = ot
        for src, dst in op_aliases.items():
            mapped = F.when(ot == src, F.lit(dst)).otherwise(mapped)
        v = v.withColumn("operate_type", mapped)
    return v


def latest_config(versions: DataFrame, seq: str = "seq") -> DataFrame:
    """RTE2: last write wins per (source_table, operate_type); deletes never
    remove a route.  A partial aggregate, so one busy key is cheap."""
    best = F.max_by(F.struct(*[F.col(c) for c in CFG_FIELDS[2:]], F.col(seq).alias(seq)), F.col(seq))
    g = versions.groupBy("source_table", "operate_type").agg(best.alias("_b"))
    return g.select("source_table", "operate_type", "_b.*")


def _apply(joined: DataFrame) -> DataFrame:
    """Stamp sink_table and prune ``data`` to the configured columns (JSN4, JSN6)."""
    return joined.withColumn("data", J.prune_columns(F.col("data"), F.col("sink_columns")))


def route_latest(data: DataFrame, latest: DataFrame) -> DataFrame:
    """RTE1: every data record sees the latest config (snapshot semantics).
    The config side is one row per (table, operation) and held by every task,
    as broadcast state is; left to estimates, a large config feed makes the
    planner shuffle all records by their few keys."""
    cfg = F.broadcast(latest.withColumnRenamed("seq", "cfg_seq"))
    # null-safe keys: an inferred isnotnull() filter would otherwise be pushed
    # into the scan and re-run the record parse there
    j = data.join(cfg, data["table"].eqNullSafe(cfg["source_table"])
                  & data["operation"].eqNullSafe(cfg["operate_type"]),
                  "inner").drop("source_table", "operate_type")
    return _apply(j)


def route_asof(data: DataFrame, versions: DataFrame, seq: str = "seq", width: int | None = None) -> DataFrame:
    """RTE3: a data record sees only config rows that arrived before it.

    A segmented merge by arrival (``plans.asof``): data and config rows of a (table, operation) meet in order, segment by
    segment, and the last config of earlier segments is carried in, so neither a busy table nor a key with millions of
    versions gathers in one row or task."""
    attrs = CFG_FIELDS[2:]
    out = A.merge(data, versions, ["table", "operation"], ["source_table", "operate_type"], seq, attrs, width)
    return _apply(out.select(*data.columns, F.col(f"matched.{seq}").alias("cfg_seq"), *[f"matched.{a}" for a in attrs]))


def split_by_sink(routed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """RTE4: (kafka main output, hbase side output); other sink types drop."""
    return (routed.where(F.col("sink_type") == SINK_KAFKA),
            routed.where(F.col("sink_type") == SINK_HBASE))


def tag_by_sink(routed: DataFrame) -> DataFrame:
    """RTE4 in one pass: ``stream`` = main (kafka) / side (hbase); other sink
    types are dropped.  Use this when both outputs are written together."""
    return (routed.where(F.col("sink_type").isin(SINK_KAFKA, SINK_HBASE))
                  .withColumn("stream", F.when(F.col("sink_type") == SINK_KAFKA, F.lit("main"))
                              .otherwise(F.lit("side"))))


def topic_value(kafka_rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """SNK2: record-chosen topic: ``topic = sink_table``, ``value = data`` JSON (and the columns to ``keep``)."""
    return kafka_rows.select(F.col("sink_table").alias("topic"),
                             F.to_json("data").alias("value"), *keep)


def pk_value(data: Column, sink_pk: Column) -> Column:
    pk = F.coalesce(sink_pk, F.lit(DEFAULT_PK))
    return F.try_variant_get(F.element_at(data, pk), "$", "string")


def dim_upsert_latest(hbase_rows: DataFrame, order: Sequence[str] | str, keep: str | None = None) -> DataFrame:
    """SNK4 (batch form): the surviving row per (sink_table, primary key)
    after upserting records in arrival ``order`` (kept as column ``keep``).  Records with an empty
    payload (deletes) upsert nothing and are skipped."""
    o = F.col(order) if isinstance(order, str) else F.struct(*[F.col(c) for c in order])
    x = (hbase_rows.where(F.size("data") > 0)
         .withColumn("pk", pk_value(F.col("data"), F.col("sink_pk"))))
    last = [F.max(o).alias(keep)] if keep else []
    # the key that tells rows apart comes first: sorts compare their first column fastest
    g = x.groupBy("pk", "sink_table").agg(F.max_by(F.col("data"), o).alias("data"), *last)
    return g.select("sink_table", "pk", "data", *([keep] if keep else []))


def dim_columns(dims: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Write by column name: every dimension column as varchar."""
    return dims.select("sink_table", "pk", *[
        F.try_variant_get(F.element_at("data", F.lit(c)), "$", "string").alias(c) for c in columns])


def ddl_text(versions: DataFrame, schema: str = DEFAULT_DIM_SCHEMA, only_tables: bool = True) -> DataFrame:
    """DDL1: ``create table if not exists`` text per config row: every column
    ``varchar``, the primary key (default ``id``) marked, extension appended."""
    x = versions.where(F.col("sink_type") == SINK_HBASE) if only_tables else versions
    pk = F.coalesce(F.col("sink_pk"), F.lit(DEFAULT_PK))
    cols = F.array_join(F.transform(F.split(F.col("sink_columns"), ","), lambda f: F.concat(
        f, F.when(f == pk, F.lit(" varchar primary key")).otherwise(F.lit(" varchar")))), ",")
    ddl = F.concat(F.lit(f"create table if not exists {schema}."), F.col("sink_table"), F.lit("("), cols,
                   F.lit(")"), F.coalesce(F.col("sink_extend"), F.lit("")))
    return x.withColumn("ddl", ddl)


def create_dimension_tables(spark, latest: DataFrame, schema: str = DEFAULT_DIM_SCHEMA,
                            fmt: str = "parquet") -> list[str]:
    """DDL1 (catalog side): ``CREATE TABLE IF NOT EXISTS`` for every table
    sink of the current config, all columns STRING, primary key first.

    Catalog DDL runs on the driver, one statement after another; the tables
    stream through it a partition at a time.  A failing statement raises (it
    is not swallowed)."""
    tables = latest.where(F.col("sink_type") == SINK_HBASE).select(
        "sink_table", "sink_columns", F.coalesce(F.col("sink_pk"), F.lit(DEFAULT_PK)).alias("pk")).distinct()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    done = []
    for r in tables.orderBy(*tables.columns).toLocalIterator():
        cols = [c for c in r.sink_columns.split(",") if c]
        ordered = [r.pk] + [c for c in cols if c != r.pk] if r.pk in cols else cols
        body = ", ".join(f"`{c}` STRING" for c in ordered)
        name = f"{schema}.{r.sink_table}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({body}) USING {fmt}")
        done.append(name)
    return done
