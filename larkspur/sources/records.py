"""Record streams derived from the warehouse tables.

The pipelines consume JSON text logs, change events, CSV score lines and
login events.  These functions derive such records from the parquet tables
with plain column expressions (one output record per input row, no
grouping), so every derived stream grows with its table.  The DuckDB
oracles in ``larkspur.oracle`` apply the same arithmetic to the same
tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.time import ntz_to_ms

# ---------------------------------------------------------------------------
# Fixed values of the derivation (shared with the SQL oracles).
# ---------------------------------------------------------------------------
START_EVENT = "signup"          # event type that becomes a start (app launch) log
ENTRY_EVENT = "view"            # page log without last_page_id: an entry page
EMPTY_LAST_PAGE_EVENT = "click"  # clicks with k % 20 = 0 carry last_page_id = ""
FAIL_EVENT = "error"            # login stand-in: an error is a failed login
DIRTY_EVERY = 10                # event_id % 10 = 0 -> truncated JSON line
ARRIVAL_MULT, ARRIVAL_MOD, ARRIVAL_STEP_MS = 7919, 97, 600_000  # arrival disorder
CDC_SERVER, CDC_DB = "dbserver", "shop"
ORDER_OP = {"F": "c", "O": "u", "P": "d"}   # o_orderstatus -> change op code
NO_DATA_EVERY = 50              # o_orderkey % 50 = 0 -> envelope without "data"


def k_of(props: Column | str = "props") -> Column:
    p = F.col(props) if isinstance(props, str) else props
    return F.get_json_object(p, "$.k").cast("bigint")


def events_base(events: DataFrame) -> DataFrame:
    """events + ``ts_ms`` (epoch ms) + ``k`` (props.k) + ``arrival_ms``."""
    return (events
            .withColumn("ts_ms", ntz_to_ms(F.col("ts")))
            .withColumn("k", k_of("props"))
            .withColumn("arrival_ms", F.col("ts_ms") + (F.col("event_id") * ARRIVAL_MULT % ARRIVAL_MOD)
                        * F.lit(ARRIVAL_STEP_MS)))


def app_log_lines(events: DataFrame, dirty: bool = False) -> DataFrame:
    """One JSON app-log line per event: ``(rec_id, value)``.

    * ``signup``: start log ``{"common", "start", "ts"}``; ``start`` is JSON
      null when k % 5 = 0; signups with k % 4 > 0 also carry displays
      (ignored downstream, as for any start log).
    * others: page log ``{"common", "page", "displays"?, "ts"}``;
      ``view`` has no ``last_page_id`` (entry page), a click with k % 20 = 0
      has ``last_page_id = ""``, the rest ``"home"``; k % 4 display items.
    * ``dirty=True`` drops the last character of every 10th line.
    """
    e = events_base(events)
    k = F.col("k")
    is_new = F.when(k < 50, F.lit("1")).otherwise(F.lit("0"))
    common = F.to_json(F.struct(F.col("user_id").cast("string").alias("mid"), is_new.alias("is_new")))
    last_page = (F.when(F.col("event_type") == ENTRY_EVENT, F.lit(None).cast("string"))
                 .when((F.col("event_type") == EMPTY_LAST_PAGE_EVENT) & (k % 20 == 0), F.lit(""))
                 .otherwise(F.lit("home")))
    page = F.to_json(F.struct(F.col("event_type").alias("page_id"), last_page.alias("last_page_id")))
    n_disp = k % 4
    displays = F.to_json(F.transform(
        F.sequence(F.lit(1), F.greatest(n_disp, F.lit(1))),
        lambda i: F.struct(F.concat(F.col("event_id").cast("string"), F.lit("-"), i.cast("string")).alias("item"),
                           i.alias("pos"))))
    disp_part = F.when(n_disp > 0, F.concat(F.lit(',"displays":'), displays)).otherwise(F.lit(""))
    start = F.when(k % 5 == 0, F.lit("null")).otherwise(
        F.to_json(F.struct(F.lit("icon").alias("entry"), (k * 10).alias("loading_time"))))
    ts = F.col("ts_ms").cast("string")
    start_line = F.concat(F.lit('{"common":'), common, F.lit(',"start":'), start, disp_part,
                          F.lit(',"ts":'), ts, F.lit("}"))
    page_line = F.concat(F.lit('{"common":'), common, F.lit(',"page":'), page, disp_part,
                         F.lit(',"ts":'), ts, F.lit("}"))
    line = F.when(F.col("event_type") == START_EVENT, start_line).otherwise(page_line)
    if dirty:
        line = F.when(F.col("event_id") % DIRTY_EVERY == 0, line.substr(F.lit(1), F.length(line) - 1)) \
            .otherwise(line)
    return e.select(F.col("event_id").alias("rec_id"), F.col("arrival_ms"), line.alias("value"))


def login_events(events: DataFrame) -> DataFrame:
    """Login-event stand-in: ``(user_id, ip_address, event_type, timestamp, seq)``;
    ``event_type = 'fail'`` for error events, else the event type."""
    e = events_base(events)
    return e.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("10.0."), (F.col("user_id") % 256).cast("string"), F.lit("."),
                 F.col("k").cast("string")).alias("ip_address"),
        F.when(F.col("event_type") == FAIL_EVENT, F.lit("fail")).otherwise(F.col("event_type")).alias("event_type"),
        F.col("ts_ms").alias("timestamp"),
        F.col("event_id").alias("seq"))


def score_lines(events: DataFrame) -> DataFrame:
    """CSV score records ``name,score,epoch_ms`` (name = event type, score =
    props.k) with a disordered arrival time ``arrival_ms``."""
    e = events_base(events)
    return e.select(
        F.col("event_id").alias("seq"), F.col("arrival_ms"),
        F.concat_ws(",", F.col("event_type"), F.col("k").cast("string"),
                    F.col("ts_ms").cast("string")).alias("value"))


def order_change_events(orders: DataFrame) -> DataFrame:
    """Debezium-style change events for ``orders``: ``(seq, topic, value)``.

    Status F/O/P -> op c/u/d; a delete carries ``before`` and a null
    ``after``.  Decimals are encoded as strings and dates as 'yyyy-MM-dd'
    text (string decimal handling)."""
    row = F.struct(
        F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus"),
        F.col("o_totalprice").cast("decimal(16,2)").cast("string").alias("o_totalprice"),
        F.date_format(F.col("o_orderdate"), "yyyy-MM-dd").alias("o_orderdate"),
        F.col("o_orderpriority"))
    op = (F.when(F.col("o_orderstatus") == "F", F.lit("c"))
          .when(F.col("o_orderstatus") == "O", F.lit("u"))
          .otherwise(F.lit("d")))
    rec = F.struct(
        F.when(op != "c", row).alias("before"),
        F.when(op != "d", row).alias("after"),
        op.alias("op"),
        F.struct(F.lit(CDC_DB).alias("db"), F.lit("orders").alias("table")).alias("source"))
    return orders.select(
        (F.col("o_orderkey") * 10).alias("seq"),
        F.lit(f"{CDC_SERVER}.{CDC_DB}.orders").alias("topic"),
        F.to_json(rec, {"ignoreNullFields": "false"}).alias("value"))


def lineitem_change_events(lineitem: DataFrame) -> DataFrame:
    """Change events for ``lineitem`` (line 1 = create, later lines = update)."""
    row = F.struct(
        F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber").cast("bigint")
        .alias("l_linenumber"),
        F.col("l_quantity").cast("decimal(16,2)").cast("string").alias("l_quantity"),
        F.col("l_extendedprice").cast("decimal(16,2)").cast("string").alias("l_extendedprice"),
        F.col("l_returnflag"),
        F.date_format(F.col("l_shipdate"), "yyyy-MM-dd").alias("l_shipdate"))
    op = F.when(F.col("l_linenumber") == 1, F.lit("c")).otherwise(F.lit("u"))
    rec = F.struct(
        F.lit(None).cast("string").alias("before"),
        row.alias("after"), op.alias("op"),
        F.struct(F.lit(CDC_DB).alias("db"), F.lit("lineitem").alias("table")).alias("source"))
    return lineitem.select(
        (F.col("l_orderkey") * 10 + 1).alias("seq"),
        F.lit(f"{CDC_SERVER}.{CDC_DB}.lineitem").alias("topic"),
        F.to_json(rec, {"ignoreNullFields": "false"}).alias("value"),
        # total order of versions of one l_orderkey (ties broken to uniqueness)
        F.col("l_shipdate"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"),
        F.col("l_extendedprice"))


def sharded_topics(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Topics of a sharded database, ``(seq, topic)``: the customer or supplier picks the database, the status or
    return flag the table."""
    def of(df, seq, shard, name, kind):
        return df.select(seq.alias("seq"), F.concat(F.lit(f"{CDC_SERVER}.{CDC_DB}_"), (F.col(shard) % 7).cast("string"),
                                                    F.lit(f".{name}_"), F.lower(kind)).alias("topic"))
    return of(orders, F.col("o_orderkey") * 10, "o_custkey", "orders", "o_orderstatus").unionByName(
        of(lineitem, F.col("l_orderkey") * 10 + 1, "l_suppkey", "lineitem", "l_returnflag"))


def broken_change_events(orders: DataFrame) -> DataFrame:
    """``order_change_events`` with broken ones among them: o_orderkey % 10 = 0 is cut short, 3 has an unknown op,
    7 has none."""
    key = F.col("seq") / 10
    x = order_change_events(orders)
    op = r'"op":"[a-z]"'
    value = (F.when(key % 10 == 0, F.expr("left(value, length(value) - 1)"))
             .when(key % 10 == 3, F.regexp_replace("value", op, '"op":"t"'))
             .when(key % 10 == 7, F.regexp_replace("value", op, '"ts":0')).otherwise(F.col("value")))
    return x.withColumn("value", value)


# A table that changes while its snapshot is read: order rows, changed by line items.  Every third line number belongs to one
# busy order, every fourth supplier comes late; a chunk is read between positions low and high, its rows at ``READ_AT``.
HOT_ORDER, CHUNK_KEYS, LATE_BY, READ_AT = 1, 500, 20_000, 2_000
PLACE = 1_000_000                # positions between two places of the change stream


def order_state_changes(lineitem: DataFrame) -> DataFrame:
    """``(key, chunk, seq, op, state)``: one change of an order a line item; returned ones delete it."""
    key = F.when(F.col("l_linenumber") % 3 == 0, F.lit(HOT_ORDER)).otherwise(F.col("l_orderkey")).cast("long")
    place = F.col("l_orderkey") * 10 + F.col("l_linenumber") + F.when(F.col("l_suppkey") % 4 == 0, LATE_BY).otherwise(0)
    return lineitem.select(
        key.alias("key"), F.floor(key / CHUNK_KEYS).alias("chunk"),
        (place * PLACE + (F.col("l_partkey") * 1000 + F.col("l_suppkey")) % PLACE).alias("seq"),
        F.when(F.col("l_returnflag") == "R", F.lit("d")).otherwise(F.lit("u")).alias("op"),
        F.concat(F.lit("part "), F.col("l_partkey").cast("string"), F.lit(" of "), F.col("l_suppkey").cast("string")).alias("state"))


def order_snapshot_chunks(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """``(key, chunk, low, high, state)``: the rows a chunked read of the orders finds.  A row is what the table held when
    its chunk was read: the last change up to then, or the order as it was; deleted rows are not found."""
    low = F.col("chunk") * (CHUNK_KEYS * 10 * PLACE)
    seen = (order_state_changes(lineitem).where(F.col("seq") <= low + READ_AT * PLACE)
            .groupBy("key").agg(F.max(F.struct("seq", "state", "op")).alias("last")))
    rows = orders.select(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("base")).join(seen, "key", "full")
    return (rows.where("last is null or last.op <> 'd'").withColumn("chunk", F.floor(F.col("key") / CHUNK_KEYS))
            .select("key", "chunk", low.alias("low"), (low + CHUNK_KEYS * 10 * PLACE).alias("high"),
                    F.coalesce("last.state", "base").alias("state")))


def dimension_config_feed(customer: DataFrame) -> DataFrame:
    """Config change envelopes that send every customer's own table to a dimension: the nation picks columns, primary
    key and table options."""
    key, kind = F.col("c_custkey"), F.col("c_nationkey") % 3
    cols = F.when(kind == 0, F.lit("id,name")).when(kind == 1, F.lit("code,name,segment")).otherwise(F.lit("name,id,balance"))
    cfg = _cfg_struct(F.concat(F.lit("tenant_"), key.cast("string")), F.lit("create"), F.lit("hbase"),
                      F.concat(F.lit("dim_tenant_"), key.cast("string")), cols,
                      F.when(kind == 1, F.lit("code")), F.when(kind == 2, F.concat(F.lit(" SALT_BUCKETS = "), (key % 8 + 1).cast("string"))))
    return customer.select((key * 10 + 7).alias("seq"), F.concat(
        F.lit('{"data":'), F.to_json(cfg, {"ignoreNullFields": "false"}),
        F.lit(f',"type":"insert","database":"{CONFIG_DB}","table":"table_process"}}')).alias("value"))


def cdc_envelopes(orders: DataFrame) -> DataFrame:
    """Already-normalised envelopes ``{data, operation, dbname, table}`` as
    JSON text; every 50th order is a heartbeat without ``data``."""
    op = (F.when(F.col("o_orderstatus") == "F", F.lit("create"))
          .when(F.col("o_orderstatus") == "O", F.lit("update"))
          .otherwise(F.lit("delete")))
    data = F.to_json(F.struct(F.col("o_orderkey"), F.col("o_orderstatus")))
    tail = F.concat(F.lit('"operation":"'), op, F.lit('","dbname":"'), F.lit(CDC_DB),
                    F.lit('","table":"orders"}'))
    value = F.when(F.col("o_orderkey") % NO_DATA_EVERY == 0, F.concat(F.lit("{"), tail)) \
        .otherwise(F.concat(F.lit('{"data":'), data, F.lit(","), tail))
    return orders.select(F.col("o_orderkey").alias("seq"), value.alias("value"))


# ---------------------------------------------------------------------------
# Routing-config change feed (``table_process`` rows).
# Fixed initial snapshot: (seq, type, source_table, operate_type, sink_type,
# sink_table, sink_columns, sink_pk, sink_extend).
# ---------------------------------------------------------------------------
LINEITEM_DIM_COLUMNS = "l_orderkey,l_partkey,l_suppkey,l_linenumber,l_quantity,l_shipdate"
CONFIG_SNAPSHOT = [
    (5, "insert", "orders", "create", "kafka", "dwd_order_create",
     "o_orderkey,o_custkey,o_totalprice,o_orderdate", "o_orderkey", None),
    (15, "insert", "orders", "update", "kafka", "dwd_order_update",
     "o_orderkey,o_orderstatus", "o_orderkey", None),
    (25, "insert", "orders", "delete", "clickhouse", "ck_order_delete", "o_orderkey", "o_orderkey", None),
    (35, "insert", "lineitem", "create", "hbase", "dim_lineitem", LINEITEM_DIM_COLUMNS, "l_orderkey",
     " SALT_BUCKETS = 4"),
    (45, "insert", "lineitem", "update", "hbase", "dim_lineitem", LINEITEM_DIM_COLUMNS, "l_orderkey",
     " SALT_BUCKETS = 4"),
    (55, "insert", "customer", "create", "hbase", "dim_customer", "id,name,nation", None, None),
]
# Rules of the config updates derived from orders (o_orderkey = key):
#   key % 500 = 250  -> update of (orders, update): columns by (key / 500) % 3
#   key % 500 = 400  -> delete envelope with empty data (ignored)
#   key % 2000 = 1000 -> update of (orders, create) to "o_orderkey,o_custkey"
#   key % 3000 = 1500 -> (orders, delete) alternating kafka / clickhouse
#   key % 5000 = 4999 -> record with an unknown field (rejected by strict decode)
CONFIG_UPDATE_COLUMNS = ("o_orderkey,o_orderstatus", "o_orderkey,o_orderstatus,o_orderpriority",
                         "o_orderkey, o_orderstatus")
CONFIG_DB = "shop_config"


def _cfg_struct(st, ot, sk, stbl, cols, pk, ext):
    return F.struct(st.alias("source_table"), ot.alias("operate_type"), sk.alias("sink_type"),
                    stbl.alias("sink_table"), cols.alias("sink_columns"), pk.alias("sink_pk"),
                    ext.alias("sink_extend"))


def config_feed(orders: DataFrame) -> DataFrame:
    """Config change envelopes ``{data, type, database, table}`` as JSON
    text with arrival ``seq``: the fixed snapshot plus updates derived
    from ``orders`` (see the rules above)."""
    names = ("seq", "type", "source_table", "operate_type", "sink_type", "sink_table", "sink_columns", "sink_pk",
             "sink_extend")
    fixed = [F.struct(*[F.lit(v).cast("long" if n == "seq" else "string").alias(n) for n, v in zip(names, row)])
             for row in CONFIG_SNAPSHOT]
    snap = orders.sparkSession.range(1).select(F.inline(F.array(*fixed)))
    snap = snap.select("seq", "type", _cfg_struct(*[F.col(c) for c in (
        "source_table", "operate_type", "sink_type", "sink_table", "sink_columns", "sink_pk",
        "sink_extend")]).alias("cfg"), F.lit(None).cast("string").alias("extra"))
    key = F.col("o_orderkey")
    lit = F.lit
    cols = (F.when((key / 500).cast("long") % 3 == 0, lit(CONFIG_UPDATE_COLUMNS[0]))
            .when((key / 500).cast("long") % 3 == 1, lit(CONFIG_UPDATE_COLUMNS[1]))
            .otherwise(lit(CONFIG_UPDATE_COLUMNS[2])))
    null = lit(None).cast("string")
    upd = _cfg_struct(lit("orders"), lit("update"), lit("kafka"), lit("dwd_order_update"), cols,
                      lit("o_orderkey"), null)
    crt = _cfg_struct(lit("orders"), lit("create"), lit("kafka"), lit("dwd_order_create"),
                      lit("o_orderkey,o_custkey"), lit("o_orderkey"), null)
    dlt = _cfg_struct(lit("orders"), lit("delete"),
                      F.when((key / 3000).cast("long") % 2 == 0, lit("kafka")).otherwise(lit("clickhouse")),
                      lit("dwd_order_delete"), lit("o_orderkey,o_orderstatus"), lit("o_orderkey"), null)
    bad = _cfg_struct(lit("orders"), lit("update"), lit("kafka"), lit("dwd_order_bad"),
                      lit("o_orderkey"), lit("o_orderkey"), null)
    derived = (orders
               .where((key % 500 == 250) | (key % 500 == 400) | (key % 2000 == 1000)
                      | (key % 3000 == 1500) | (key % 5000 == 4999))
               .select(
                   (key * 10 + 5).alias("seq"),
                   F.when(key % 500 == 400, lit("delete")).otherwise(lit("update")).alias("type"),
                   F.when(key % 500 == 250, upd).when(key % 500 == 400, lit(None))
                    .when(key % 2000 == 1000, crt).when(key % 3000 == 1500, dlt)
                    .otherwise(bad).alias("cfg"),
                   F.when((key % 5000 == 4999) & (key % 500 != 250) & (key % 500 != 400)
                          & (key % 2000 != 1000) & (key % 3000 != 1500), lit("unexpected"))
                    .alias("extra")))
    feed = snap.unionByName(derived)
    data = F.when(F.col("cfg").isNull(), lit("{}")).otherwise(
        F.when(F.col("extra").isNull(), F.to_json(F.col("cfg"), {"ignoreNullFields": "false"}))
         .otherwise(F.to_json(F.struct(F.col("cfg.*"), F.col("extra").alias("comment")),
                              {"ignoreNullFields": "false"})))
    value = F.concat(lit('{"data":'), data, lit(',"type":"'), F.col("type"),
                     lit(f'","database":"{CONFIG_DB}","table":"table_process"}}'))
    return feed.select("seq", value.alias("value"))


def page_log_typed(events: DataFrame) -> DataFrame:
    """The parsed page-log layer (DWD) as typed columns, derived with the same
    rules as ``app_log_lines`` (parse(app_log_lines) equals this frame on its
    columns; see the ``json_extract_paths`` check).  Sequence operators read
    this layer: a columnar scan instead of re-parsing JSON text per branch."""
    e = events_base(events).where(F.col("event_type") != START_EVENT)
    k = F.col("k")
    last_page = (F.when(F.col("event_type") == ENTRY_EVENT, F.lit(None).cast("string"))
                 .when((F.col("event_type") == EMPTY_LAST_PAGE_EVENT) & (k % 20 == 0), F.lit(""))
                 .otherwise(F.lit("home")))
    return e.select(
        F.col("event_id").alias("rec_id"), "arrival_ms",
        F.col("user_id").cast("string").alias("mid"),
        F.when(k < 50, F.lit("1")).otherwise(F.lit("0")).alias("is_new"),
        "ts_ms", F.col("event_type").alias("page_id"), last_page.alias("last_page_id"),
        (F.col("event_type") != ENTRY_EVENT).alias("has_last_page"))
