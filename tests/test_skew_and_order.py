"""Hot keys and hot timestamps: the work is spread, the results stay."""

import pytest
from pyspark.sql import functions as F

from kilnmark.operators import chronological_rank
from kilnmark.operators.ordering import in_parts, numbered
from kilnmark.operators.skew import hot_keys, join_spread


@pytest.fixture
def apart(spark):
    """Eight partitions, as on a cluster: adaptive execution does not merge them, nothing is broadcast unasked."""
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8",
             "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_times(spark, n=30_000):
    """A third of the rows on one time, many small ties, some without a time."""
    ts = F.when(F.col("id") % 3 == 0, 5000).when(F.col("id") % 101 == 0, None).otherwise(F.col("id") * 7919 % 9000)
    return spark.range(n).select("id", F.timestamp_seconds(ts).alias("ts"))


def test_positions_with_a_hot_time(apart):
    rows = hot_times(apart)
    got = {r["id"]: r["position"] for r in chronological_rank(rows).collect()}
    times = {r["id"]: r["ts"] for r in rows.collect()}
    order = sorted(t for t in times.values() if t is not None)
    first = {}
    for k, t in enumerate(order):
        first.setdefault(t, k + 1)
    assert got == {k: first.get(t) for k, t in times.items()}


def test_hot_time_is_cut_over_parts(apart):
    """No part holds much more than its share, though one time has a third of all rows."""
    placed = in_parts(hot_times(apart).where("ts IS NOT NULL"), ["ts"])
    sizes = [r["count"] for r in placed.groupBy("__part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / 8
    hot = placed.where(F.unix_seconds("ts") == 5000).select("__part").distinct().count()
    assert hot >= 3


def test_numbers_without_gaps(apart):
    rows = hot_times(apart, 5000)
    got = sorted((r["number"], r["ts"]) for r in numbered(rows.where("ts IS NOT NULL"), ["ts"]).collect())
    assert [n for n, _ in got] == list(range(len(got)))
    assert [t for _, t in got] == sorted(t for _, t in got)
    assert numbered(rows.where("false"), ["ts"]).count() == 0 and chronological_rank(rows.where("false")).count() == 0


def test_positions_when_all_times_are_one(apart):
    rows = apart.range(2000).select("id", F.timestamp_seconds(F.lit(7)).alias("ts"))
    assert {r["position"] for r in chronological_rank(rows).collect()} == {1}


def keyed(spark, n=60_000):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, "warm").otherwise(F.concat(F.lit("k"), F.col("id") % 5000))
    return spark.range(n).select("id", key.alias("k"), (F.col("id") % 2).cast("string").alias("side"))


def hashes(rows, *names):
    return {r[0] for r in rows.where(F.col("k").isin(*names)).select(F.xxhash64("k")).distinct().collect()}


def test_hot_keys_are_found(apart):
    rows = keyed(apart)
    assert set(hot_keys(rows, ["k"], share=20)) == hashes(rows, "hot")
    assert set(hot_keys(rows, ["k"], share=100)) == hashes(rows, "hot", "warm")
    assert hot_keys(rows.where("false"), ["k"]) == []
    assert hot_keys(rows.where("k LIKE 'k%'"), ["k"]) == []


@pytest.mark.parametrize("hot", [None, [], "all"])
@pytest.mark.parametrize("spread", [1, 5, 32])
def test_join_does_not_depend_on_salts(apart, hot, spread):
    rows = keyed(apart, 6000)
    lookup = rows.groupBy("k").agg(F.max("id").alias("top")).where("top % 2 = 0")
    named = [r[0] for r in rows.select(F.xxhash64("k")).distinct().limit(150).collect()] if hot == "all" else hot
    got = {(r["id"], r["top"]) for r in join_spread(rows, lookup, ["k"], ["id"], spread, named).collect()}
    plain = {(r["id"], r["top"]) for r in rows.join(lookup, "k").collect()}
    assert got == plain and plain


def test_only_hot_keys_multiply_the_lookup(apart):
    """The rows that the lookup's generator makes: one for each ordinary key, 32 for the hot one."""
    rows = keyed(apart)
    lookup = rows.groupBy("k").agg(F.max("id").alias("top"))
    joined = join_spread(rows, lookup, ["k"], ["id"], 32, list(hashes(rows, "hot")))
    apart.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = join_spread(rows, lookup, ["k"], ["id"], 32, list(hashes(rows, "hot")))
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        made = _generated(joined)
    finally:
        apart.conf.unset("spark.sql.adaptive.enabled")
    assert made == lookup.count() + 31
    assert max(sizes) < 2.5 * sum(sizes) / 8


def _generated(frame):
    frame.collect()
    found = []

    def walk(node):
        if node.nodeName().startswith("Generate"):
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(frame._jdf.queryExecution().executedPlan())
    return sum(found)
