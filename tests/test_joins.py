"""Full outer joins with hot keys, interval joins, as-of joins."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from plans import plan_of
from tableflow import PipelineSpec, build
from tableflow.operators import asof_join, full_outer_join, interval_join


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def hot_sides(spark, rows=6000):
    left = spark.range(rows).selectExpr("if(id % 3 = 0, 7, id % 500) as k", "if(id % 50 = 1, null, 1) as a0", "id as a")
    left = left.selectExpr("if(a0 is null, null, k) as k", "a")
    right = spark.range(40).selectExpr("if(id = 0, 7, id * 30) as k", "concat('b', id) as b")
    return left, right.unionByName(spark.sql("select cast(null as bigint) as k, 'none' as b"))


@pytest.mark.parametrize("hot_rows", [1, 50, 10**6])
@pytest.mark.parametrize("turned", [False, True])
def test_full_outer_join_is_sparks(spark, hot_rows, turned):
    left, right = hot_sides(spark)
    if turned:
        left, right = right, left
    right = right.where("k is null or k <> 30")
    want = left.alias("l").join(right.alias("r"), F.expr("l.k = r.k"), "full_outer")
    names = [name for side in (left, right) for name in side.columns if name != "k"]
    want = want.select(F.coalesce("l.k", "r.k").alias("k"), *names)
    assert rows_of(full_outer_join(left, right, ["k"], hot_rows)) == rows_of(want)


def test_full_outer_join_on_two_columns_and_both_sides_hot(spark):
    left = spark.range(300).selectExpr("id % 2 as k", "cast(id % 3 as string) as m", "id as a")
    right = spark.range(200).selectExpr("id % 2 as k", "cast(id % 4 as string) as m", "id as b")
    got = full_outer_join(left, right, ["k", "m"], 10)
    want = left.join(right, ["k", "m"], "full_outer").select("k", "m", "a", "b")
    assert rows_of(got) == rows_of(want)


def test_a_hot_key_is_no_hot_task(spark):
    """A third of the rows has one key, and another part has none."""
    left, right = hot_sides(spark, 60_000)
    before = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = full_outer_join(left, right, ["k"], 100)
        assert "FullOuter" in plan_of(df, "simple")
        sizes = [row["count"] for row in df.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before[0])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[1])
    assert len(sizes) == 8 and max(sizes) <= 2 * statistics.median(sizes)


def intervals(rng, count, reach):
    rows = []
    for at in range(count):
        start = rng.randrange(-reach, reach)
        size = rng.choice([0, 1, 2, 5, 8, 63, 64, 65, 1000, 10 * reach])
        rows.append((at, rng.choice("xy"), start, start + rng.randrange(size + 1) if rng.random() < 0.8 else start + size))
    return rows + [(count, "x", None, 5), (count + 1, "x", 5, 4), (count + 2, None, 0, 9)]


@pytest.mark.parametrize("by", [(), ("k",)])
def test_interval_join_is_brute_force(spark, by):
    rng = random.Random(1)
    one, two = intervals(rng, 150, 3000), intervals(rng, 150, 3000)
    left = spark.createDataFrame(one, "a long, k string, s long, e long")
    right = spark.createDataFrame(two, "b long, k string, s2 long, e2 long")
    if not by:
        right = right.withColumnRenamed("k", "k2")
    got = interval_join(left, right, ("s", "e"), ("s2", "e2"), by).select("a", "b")
    want = [
        (a, b)
        for a, k, s, e in one
        for b, k2, s2, e2 in two
        if None not in (s, s2) and s <= e and s2 <= e2 and s <= e2 and s2 <= e and (not by or k == k2 is not None)
    ]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_interval_join_has_no_nested_loop(spark):
    left = spark.range(100).selectExpr("id as a", "timestamp_ntz'2024-01-01' + make_interval(0,0,0,0,0,id) as t")
    right = spark.range(9).selectExpr("id as b", "timestamp'2024-01-01' + make_interval(0,0,0,0,id) as u", "date'2024-01-01' as d")
    right = right.selectExpr("b", "cast(u as timestamp_ntz) as u", "cast(u as timestamp_ntz) + interval 3 minutes as v")
    df = interval_join(left, right, ("t", "t"), ("u", "v"))
    plan = plan_of(df, "simple")
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert df.count() == sum(h <= m / 60 <= h + 0.05 for h in range(9) for m in range(100))
    with pytest.raises(TypeError, match="double"):
        interval_join(left.withColumn("x", F.lit(1.5)), right, ("x", "x"), ("u", "v"))


@pytest.mark.parametrize("hot_rows", [1, 30, 10**6])
@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("by", [("k",), ()])
def test_asof_join_is_brute_force(spark, hot_rows, how, by):
    rng = random.Random(2)
    one = [(at, rng.choice(["h", "h", "h", "x", "y", None]), rng.choice([rng.randrange(400), None] + [7] * 2)) for at in range(300)]
    two = [(f"r{t}", k, t) for k in ("h", "x", "z") for t in sorted(rng.sample(range(400), 60))] + [("n", None, 3), ("m", "h", None)]
    if not by:
        two = two[:60]
    left = spark.createDataFrame(one, "a long, k string, t int").repartition(5)
    right = spark.createDataFrame(two, "b string, k string, u int").repartition(3)
    if not by:
        right = right.drop("k")
    got = asof_join(left, right, "t", "u", by, how, hot_rows)
    want = []
    for a, k, t in one:
        found = [(u, b) for b, k2, u in two if t is not None and u is not None and u <= t and (not by or k == k2 is not None)]
        if found or how == "left":
            u, b = max(found) if found else (None, None)
            want.append((a, k, t, b, u))
    assert rows_of(got) == sorted(want, key=repr)


def test_asof_join_of_empty_sides(spark):
    left = spark.createDataFrame([(1, 2)], "a int, t int")
    right = spark.createDataFrame([], "b int, u int")
    assert rows_of(asof_join(left, right, "t", "u")) == [(1, 2, None, None)]
    assert rows_of(asof_join(right, left, "u", "t")) == []
    with pytest.raises(ValueError, match="left or inner"):
        asof_join(left, right, "t", "u", how="outer")
    with pytest.raises(ValueError, match="both sides have column"):
        asof_join(left, left, "t", "t")


def test_joins_in_a_spec(spark):
    spark.sql("select 1 as k, 10 as t union all select 2, 30").createOrReplaceTempView("left_rows")
    spark.sql("select 1 as k, 5 as u, 'x' as v union all select 1, 11, 'y'").createOrReplaceTempView("right_rows")
    mapping = [
        {"id": "l", "source": "ext_hive", "location": "left_rows"},
        {"id": "r", "source": "ext_hive", "location": "right_rows"},
    ]

    def joined(**custom):
        both = {"left": "l", "right": "r"} | custom
        last = {"id": "j", "source": "join", "custom": both, "join": "j", "where": "k is not null"}
        return rows_of(build(spark, PipelineSpec.from_dict({"source": {"mapping": [*mapping, last]}})))

    assert joined(kind="asof", by=["k"], **{"left-time": "t", "right-time": "u"}) == [(1, 10, 5, "x"), (2, 30, None, None)]
    assert joined(kind="full", on=["k"]) == [(1, 10, 11, "y"), (1, 10, 5, "x"), (2, 30, None, None)]
    spans = {"left-span": ["t", "t"], "right-span": ["u", "u"]}
    assert joined(kind="range", by=["k"], **spans) == []
    for custom, message in (({"kind": "near"}, "unknown kind"), ({}, "needs custom.kind"), ({"kind": "full"}, "custom.on")):
        with pytest.raises(ValueError, match=message):
            joined(**custom)
    for name in ("left_rows", "right_rows"):
        spark.catalog.dropTempView(name)
