"""Hot keys: one key holds a third of all rows (and a third have null keys).

Results must stay exact and whole; plans must pre-aggregate before the
shuffle so the hot key reaches its reducer as one row per map task.
"""

import contextlib
import io

from pyspark.sql import functions as F

from starloom.operators.suite import Suite
from starloom.operators.dedup import dedup_by_rank
from starloom.operators.joins import with_key_exists
from starloom.operators.profile import duplicate_rows

N = 60000


def _skewed(spark):
    ids = spark.range(0, N, numPartitions=12)
    key = (F.when(F.col("id") % 3 == 0, F.lit("HOT"))
           .when(F.col("id") % 3 == 1, F.lit(None).cast("string"))
           .otherwise(F.concat(F.lit("K"), (F.col("id") % 997).cast("string"))))
    return ids.select(key.alias("k"), F.col("id").alias("v"))


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_dedup_hot_and_null_keys_exact(spark):
    df = _skewed(spark)
    out = dedup_by_rank(df, ["k"], [F.col("v").desc()])
    got = {r["k"]: r["v"] for r in out.collect()}
    exp = {r["k"]: r["m"] for r in df.groupBy("k").agg(F.max("v").alias("m")).collect()}
    assert got == exp
    assert got["HOT"] == max(i for i in range(N) if i % 3 == 0)
    plan = _plan(out)
    # the first WindowGroupLimit in the printed plan is the final one; a partial one sits below the exchange
    assert plan.count("WindowGroupLimit") >= 2


def test_existence_join_keeps_every_row(spark):
    df = _skewed(spark)
    keys = spark.createDataFrame([("HOT",), ("K1",), ("HOT",)], "key string")
    out = with_key_exists(df, "k", keys, "key", "exists")
    assert out.count() == N
    agg = {(r["k"] if r["k"] in ("HOT", None) else "other", r["exists"]): r["n"]
           for r in out.withColumn("k", F.when(F.col("k").isin("HOT") | F.col("k").isNull(), F.col("k"))
                                  .otherwise(F.lit("other")))
           .groupBy("k", "exists").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert agg[("HOT", True)] == N // 3
    assert agg[(None, None)] == N // 3          # null key -> unknown, not false
    assert sum(n for (k, e), n in agg.items() if k == "other") == N // 3


def test_duplicate_listing_and_grain_check_under_skew(spark):
    df = _skewed(spark)
    dups = duplicate_rows(df.where(F.col("k").isNotNull()), F.col("k"), "dk")
    assert dups.where(F.col("dk") == "HOT").count() == N // 3
    assert dups.select("n_copies").where(F.col("dk") == "HOT").first()[0] == N // 3
    suite = Suite({"t": df})
    suite.unique("grain", "t", ["k"])
    viol = suite.run().first()["violations"]
    assert viol == N - df.select("k").distinct().count()


def test_session_enables_skew_handling(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_hot_key_join_partition_is_split_by_aqe(spark):
    """With broadcast off and skew thresholds at test scale, AQE splits the
    partitions of the hot key and of the null keys (SortMergeJoin skew=true)."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = _skewed(spark)
        keys = df.where("k IS NOT NULL").select(F.col("k").alias("key")).distinct()
        out = with_key_exists(df, "k", keys, "key", "exists")
        rows = out.groupBy("exists").agg(F.count(F.lit(1)).alias("n")).collect()
        assert {r["exists"]: r["n"] for r in rows} == {True: 2 * N // 3, None: N // 3}
        counted = with_key_exists(df, "k", keys, "key", "exists")
        counted.collect()
        assert "skew=true" in _plan(counted)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_null_key_rows_go_around_the_join(spark):
    """Asked for, null-key rows are not shuffled at all: they stay where they came from."""
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                                 "spark.sql.adaptive.autoBroadcastJoinThreshold",
                                                 "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        df = _skewed(spark)
        keys = df.select(F.col("k").alias("key")).distinct()
        out = with_key_exists(df, "k", keys, "key", "exists", nulls_apart=True)
        assert out.count() == N and out.where("k IS NULL AND exists IS NULL").count() == N // 3
        spread = (out.where(F.col("k").isNull()).select(F.spark_partition_id().alias("p"))
                  .distinct().count())
        assert spread == 12  # as many as the input has
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_orphans_match_left_anti(spark):
    from starloom.operators.joins import orphans
    df = _skewed(spark)
    dim = spark.createDataFrame([("HOT",), ("K5",)], "key string")
    ours = sorted(map(tuple, orphans(df, "k", dim, "key").collect()), key=repr)
    anti = sorted(map(tuple, df.join(dim, df["k"] == dim["key"], "left_anti").collect()), key=repr)
    assert ours == anti and len(ours) > N // 3


def test_identical_null_key_copies_spread(spark):
    """A third of the rows are identical copies with a null key: still spread."""
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                                 "spark.sql.adaptive.autoBroadcastJoinThreshold",
                                                 "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k in old:
            spark.conf.set(k, "false" if k.endswith("enabled") else "-1")
        df = spark.range(0, 30000, numPartitions=12).select(
            F.when(F.col("id") % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("id").cast("string")).alias("k"))
        keys = df.select(F.col("k").alias("key")).distinct()
        out = with_key_exists(df, "k", keys, "key", "exists", nulls_apart=True)
        nulls = out.where(F.col("k").isNull())
        assert nulls.count() == 10000
        assert nulls.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
