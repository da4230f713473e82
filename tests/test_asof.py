"""As-of routing as a segmented merge, and the same routing in a stream that sees the files in any order."""

import random

from pyspark.sql import functions as F

from larkspur import catalog as C
from larkspur.operators import routing as RT
from larkspur.plans import asof as A
from larkspur.sources import records as R
from larkspur.sources.tables import table
from larkspur.streaming import jobs as J
from tests.test_streaming import SF, _memory


def expected(left, right):
    """Last right row of the key strictly before each left row, by plain search."""
    out = []
    for key, at, row in left:
        earlier = [(s, v) for k, s, v in right if k == key and s < at]
        if earlier:
            out.append((row, *max(earlier)))
    return sorted(out)


def merged(spark, left, right, width):
    l_ = spark.createDataFrame([(k, None, at, row) for k, at, row in left], "k string, empty string, at long, row long")
    r = spark.createDataFrame([(k, None, at, v) for k, at, v in right], "rk string, rempty string, at long, v string")
    x = A.merge(l_, r, ["k", "empty"], ["rk", "rempty"], "at", ["v"], width)
    return sorted((m.row, m.matched.at, m.matched.v) for m in x.collect())


def test_merge_brute_force(spark):
    """Gaps of many segments, keys without versions, null keys, equal places, rows before the first version."""
    rng = random.Random(8)
    keys = ["a", "b", None, ""]
    left = [(rng.choice(keys), rng.randrange(2000), i) for i in range(700)] + [("none", 5, 9000)]
    right = [(rng.choice(keys[:3]), rng.randrange(300, 2000), f"v{i}") for i in range(60)] + [("a", 700, "x"), ("a", 700, "y"), ("b", 10, "old")]
    for width in (1, 7, 100, 10**6):
        assert merged(spark, left, right, width) == expected(left, right)
    assert merged(spark, left[:0], right, 10) == [] == merged(spark, left, right[:0], 10)


def test_one_key_with_a_million_versions(spark):
    """A row of the merge never holds a history, and a window never more than a segment."""
    n, width = 1_000_000, 50_000
    right = spark.range(n).select(F.lit("t").alias("rk"), (F.col("id") * 2).alias("at"), F.col("id").cast("string").alias("v"))
    left = spark.range(0, 2 * n, 50).select(F.lit("t").alias("k"), F.col("id").alias("at"))
    x = A.merge(left, right, ["k"], ["rk"], "at", ["v"], width)
    plan = x._jdf.queryExecution().optimizedPlan().toString()
    assert "collect" not in plan and "percentile" not in plan
    got = x.agg(F.count("*"), F.sum(F.expr("cast(matched.v = cast((at - 1) div 2 as string) as int)"))).first()
    assert got[0] == got[1] == 2 * n // 50 - 1                       # all but the row at 0, each with the version before it
    sizes = left.select("at").unionByName(right.select("at")).groupBy(F.floor(F.col("at") / width)).count().agg(F.max("count")).first()[0]
    assert sizes <= width + width


def test_at_most_four_scans(spark):
    """Of what really runs: the summary of the config feed is made once for both of its uses."""
    df = C.route_asof(spark, SF)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Final Plan" in final and final.count("Scan parquet") <= 4


def shuffled(df, path, seed, n=6):
    """``df`` in ``n`` files dealt at random, so that no file and no row order follows arrival."""
    import os
    import time
    df.withColumn("_f", F.pmod(F.xxhash64("value", F.lit(seed)), F.lit(n))).repartition(n, "_f").drop("_f").write.parquet(path)
    files = sorted(f for f in os.listdir(path) if f.endswith(".parquet"))
    random.Random(seed).shuffle(files)
    for i, f in enumerate(files):
        at = time.time() - 1000 + i
        os.utime(f"{path}/{f}", (at, at))


def replay(spark, scratch, seed, name):
    # one whole stream unit a position: the routed rows' own numbers are kept
    feed, config = C._change_feed(spark, SF).drop("ord"), R.config_feed(table(spark, SF, "orders"))
    top = feed.agg(F.max("seq")).first()[0]
    shuffled(feed, f"{scratch}/data", seed)
    shuffled(config, f"{scratch}/cfg", seed + 1, n=3)
    end = spark.createDataFrame([(3 * top + 10_000, "dbserver.shop.none", "{}")], feed.schema)
    end.coalesce(1).write.mode("append").parquet(f"{scratch}/data")
    stream = lambda path, schema, k: spark.readStream.schema(schema).option("maxFilesPerTrigger", k).parquet(path)
    routed = J.route_asof_stream(stream(f"{scratch}/data", feed.schema, 2), stream(f"{scratch}/cfg", config.schema, 1),
                                 delay_ms=2 * top, salts=3, bucket_ms=500)
    return J.routed_payload(_memory(routed, name, f"{scratch}/ck"))


def test_stream_equals_batch_whatever_the_file_order(spark, scratch):
    want = C.route_asof(spark, SF)
    for seed in (1, 2):
        got = replay(spark, f"{scratch}/{seed}", seed, f"asof_{seed}").where(F.col("sink_type").isin(RT.SINK_KAFKA, RT.SINK_HBASE))
        got = got.select("table", "seq", "operation", "sink_type", "sink_table", "cfg_seq", C._kept().alias("kept_keys"), C._data_json().alias("data_json"))
        assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert want.where("cfg_seq > 100").count() > 0
