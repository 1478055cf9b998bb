import pytest
from helpers import as_set
from pyspark.sql import functions as F

from celltide.operators import joins
from celltide.operators.joins import Lookup


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def hot(spark):
    """A third of the rows share one key, with identical content; some keys are null."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 3 == 1, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
        .alias("key"),
        F.lit(1).alias("v"),
    )


@pytest.fixture
def side(spark):
    rows = [("hot", 1.0), (None, 2.0)] + [(f"k{i}", float(i)) for i in range(0, 50, 2)]
    return spark.createDataFrame(rows, "key string, x double")


@pytest.mark.parametrize("null_safe", [False, True])
def test_both_ways_give_the_same_rows(spark, hot, side, null_safe, request):
    small = joins.left_lookup(hot, Lookup(side, ("key",), 1000), null_safe)
    expected = as_set(small)
    assert "BroadcastHashJoin" in _plan(small)
    assert len(expected) == 3000
    nulls = {x for k, v, x in expected if k is None}
    assert nulls == ({2.0} if null_safe else {None})

    request.getfixturevalue("no_broadcast")
    large = joins.left_lookup(hot, Lookup(side, ("key",), 1000), null_safe)
    assert "SortMergeJoin" in _plan(large) and "_salt" not in large.columns
    assert as_set(large) == expected


def test_a_hot_key_is_spread_over_tasks(spark, hot, side, no_broadcast):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.left_lookup(hot, Lookup(side, ("key",), 1000))
        shares = (
            joined.filter("key = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        )
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(shares) == 4
    assert max(r["count"] for r in shares) < 500


def test_limit_follows_the_session(spark, hot, side, no_broadcast):
    name = "spark.sql.autoBroadcastJoinThreshold"
    for text, expected in [("-1", -1), ("10485760b", 10 << 20), ("64MB", 64 << 20), ("2g", 2 << 30)]:
        spark.conf.set(name, text)
        assert joins.broadcast_limit(hot) == expected
    assert Lookup(side, ("key",), 11).fits(11)
    assert not Lookup(side, ("key",), 12).fits(11)
    assert not Lookup(side, ("key",), 0).fits(-1)


def test_sizes_are_measured(spark, side, workspace):
    sized = joins.unique_lookup(side, "key")
    staged = joins.staged_lookup(side, ["key"], workspace, "side")
    texts = sum(len(r.key or "") for r in side.collect())
    assert sized.bytes == staged.bytes == 27 * (48 + 8) + texts
    assert as_set(staged.df) == as_set(side)
    empty = joins.staged_lookup(side.filter("x < 0"), ["key"], workspace, "side")
    assert empty.bytes == 0 and empty.df.isEmpty()


def test_repeated_keys_are_refused_but_nulls_are_not(spark):
    twice = spark.createDataFrame([("a", 1.0), ("a", 1.0)], "key string, x double")
    with pytest.raises(joins.DuplicateKeyError):
        joins.unique_lookup(twice, "key")
    nulls = spark.createDataFrame([(None, 1.0), (None, 1.0)], "key string, x double")
    joins.unique_lookup(nulls, "key")
