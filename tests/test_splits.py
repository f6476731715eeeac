"""Split keys and regions against brute force."""

from bisect import bisect_right
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tableflow.operators import region_of, split_keys, split_positions
from tableflow.operators.search import count_up_to


def keys_frame(spark, keys):
    return spark.createDataFrame([(key,) for key in keys], "rowkey string")


def by_rank(keys, regions):
    """Sort everything, nulls first, and read off the positions."""
    ordered = sorted(keys, key=lambda key: (key is not None, (key or "").encode()))
    picked = {ordered[at] for at in split_positions(len(ordered), regions) if at < len(ordered)}
    return sorted(picked - {None}, key=str.encode)


def test_positions():
    assert split_positions(100, 1) == []
    assert split_positions(100, 2) == [0]
    assert split_positions(10, 5) == [0, 3, 5, 8]  # 2.5 and 7.5 round up
    assert split_positions(1, 5) == [0, 0, 1, 1]
    assert split_positions(0, 3) == [0, 0]
    with pytest.raises(ValueError, match="at least 1"):
        split_positions(10, 0)


@given(total=st.integers(0, 10**9), regions=st.integers(2, 200))
def test_positions_are_the_rounded_shares(total, regions):
    for at, position in enumerate(split_positions(total, regions)):
        share = Fraction(total * at, regions - 1)
        assert abs(position - share) <= Fraction(1, 2) + Fraction(1, 1000)


CASES = {
    "unique": [f"k{n:04}" for n in range(1000)],
    "one hot key": ["m"] * 700 + [f"{n:03}" for n in range(300)],
    "two hot keys and a tail": ["a"] * 400 + ["z"] * 400 + [f"q{n}" for n in range(200)],
    "all the same": ["x"] * 1000,
    "nulls": [None] * 300 + [str(n) for n in range(700)],
    "only nulls": [None] * 10,
    "few": ["b", "a"],
    "one": ["only"],
    "none": [],
    "odd text": ["", "a", "a!", "a$b", "é", "\U0001f600", "￿", '"', "\\", "a\nb", "'"] * 30,
}


@pytest.mark.parametrize("regions", [1, 2, 7, 100])
@pytest.mark.parametrize("name", CASES)
def test_split_keys_equal_the_ranks(spark, name, regions):
    frame = keys_frame(spark, CASES[name]).repartition(4).cache()
    assert split_keys(frame, regions) == by_rank(CASES[name], regions)
    frame.unpersist()


@pytest.mark.parametrize("regions", [2, 7, 100])
@pytest.mark.parametrize("name", ["unique", "one hot key", "two hot keys and a tail", "nulls", "odd text"])
def test_narrowing_gives_the_same_keys(spark, name, regions):
    frame = keys_frame(spark, CASES[name]).repartition(4).cache()
    found = split_keys(frame, regions, gap_rows=20, sample_keys=10)
    assert found == by_rank(CASES[name], regions)
    frame.unpersist()


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    keys=st.lists(st.one_of(st.none(), st.text(st.characters(codec="utf-8"), max_size=3)), max_size=80),
    regions=st.integers(1, 12),
    gap_rows=st.integers(1, 40),
)
def test_any_keys(spark, keys, regions, gap_rows):
    found = split_keys(keys_frame(spark, keys), regions, gap_rows=gap_rows, sample_keys=5)
    assert found == by_rank(keys, regions)


def test_a_key_of_any_type_is_ranked_as_text(spark):
    frame = spark.range(50).withColumnRenamed("id", "k")
    assert split_keys(frame, 5, key="k") == by_rank([str(n) for n in range(50)], 5)


@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=3), max_size=40, unique=True))
@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
def test_region_is_the_number_of_splits_not_above_the_key(spark, splits):
    splits = sorted(splits)
    keys = sorted({*splits, *(key + "a" for key in splits), "", "~"})
    found = keys_frame(spark, keys).select("rowkey", region_of("rowkey", splits).alias("r")).collect()
    assert {row.rowkey: row.r for row in found} == {key: bisect_right(splits, key) for key in keys}


def test_search_on_numbers(spark):
    found = spark.range(12).select("id", count_up_to(F.col("id"), [2, 5, 9], "bigint").alias("n"))
    assert [row.n for row in found.orderBy("id").collect()] == [0, 0, 1, 1, 1, 2, 2, 2, 2, 3, 3, 3]
