"""Joins that need more than an equality: hot keys on both outer sides, intervals, latest rows.

All are equi-joins or windows for Spark. What is counted before them are a few keys or levels: a hot
key is one with more rows than a fair share of a task, so there are never more of them than tasks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.operators.cells import quoted
from tableflow.operators.search import array_literal

# Rows that one key may have in one task; fewer than a task's fair share are never hot.
HOT_ROWS = 1_000_000
# Parts of a task's fair share a hot key is cut into, so that chance spreads them evenly.
PARTS = 4


def _columns(names: Sequence[str], side: str) -> list[Column]:
    return [F.col(f"{side}.{quoted(name)}") for name in names]


def _distinct_names(left: Sequence[str], right: Sequence[str]) -> None:
    twice = sorted({name.lower() for name in left} & {name.lower() for name in right})
    if twice:
        raise ValueError(f"both sides have column(s) {', '.join(twice)}: rename them in one")


def _hot_share(df: DataFrame, rows: int, hot_rows: int) -> int:
    """Rows of one key that are too many for a task."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(hot_rows, math.ceil(rows / (PARTS * tasks)))


def full_outer_join(left: DataFrame, right: DataFrame, on: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """All rows of both sides, joined where the columns ``on`` are equal; null keys match nothing.

    Spark does not split a hot key of a full outer join. Keys with too many rows are counted; of each, the
    side with more rows is dealt over salts and the other one repeated for each salt. A repeated row meets
    some salt that has rows, so where it meets none it is dropped, and an unmatched row comes out once. Rows with a null
    key are dealt over all tasks. Columns of the same name, but for ``on``, are refused.
    """
    rest = [[name for name in side.columns if name not in on] for side in (left, right)]
    _distinct_names(*rest)
    spark, keys = left.sparkSession, [F.col(quoted(name)) for name in on]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = _hot_share(left, left.count() + right.count(), hot_rows)
    counts = [side.dropna(subset=list(on)).groupBy(*keys).agg(F.count("*").alias("n")) for side in (left, right)]
    hot: dict[tuple, list[int]] = {}
    for at, found in enumerate(counts):
        for row in found.where(F.col("n") > share).collect():
            hot.setdefault(tuple(row)[:-1], [0, 0])[at] = row["n"]
    schema = T.StructType([left.schema[name] for name in on])
    salted = schema.add("__salts", T.IntegerType()).add("__left", T.BooleanType())
    listed = [(*key, math.ceil(max(n) / share), n[0] >= n[1]) for key, n in hot.items()]
    listed = F.broadcast(spark.createDataFrame(listed, salted))

    def dealt(side: DataFrame, is_left: bool) -> DataFrame:
        at = F.monotonically_increasing_id()
        no_key = F.greatest(*[key.isNull() for key in keys]) if len(keys) > 1 else keys[0].isNull()
        own = side.join(listed, list(on), "left")
        repeated = F.col("__salts").isNotNull() & (F.col("__left") != F.lit(is_left))
        salts = F.when(repeated, F.sequence(F.lit(0), F.col("__salts") - 1)).otherwise(
            F.array(F.when(no_key, at % tasks).otherwise(F.coalesce(at % F.col("__salts"), F.lit(0))).cast("int"))
        )
        columns = [F.col(quoted(name)) for name in side.columns]
        return own.select(*columns, repeated.alias("__repeated"), F.lit(True).alias("__is"), F.explode(salts).alias("__salt"))

    one, two = dealt(left, True).alias("l"), dealt(right, False).alias("r")
    same = F.col("l.__salt") == F.col("r.__salt")
    for name in on:
        same &= F.col(f"l.{quoted(name)}") == F.col(f"r.{quoted(name)}")
    unmet = (F.col("l.__repeated") & F.col("r.__is").isNull()) | (F.col("r.__repeated") & F.col("l.__is").isNull())
    met = one.join(two, same, "full_outer").where(~F.coalesce(unmet, F.lit(False)))
    names = [F.coalesce(a, b).alias(name) for name, a, b in zip(on, _columns(on, "l"), _columns(on, "r"))]
    return met.select(*names, *_columns(rest[0], "l"), *_columns(rest[1], "r"))


def as_number(df: DataFrame, name: str) -> Column:
    """A whole number, date or time as a long of the same order: units, days or microseconds."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.IntegralType):
        return F.col(quoted(name)).cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(quoted(name)).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(F.col(quoted(name)))
    if isinstance(kind, T.TimestampNTZType):
        return F.expr(f"timestampdiff(microsecond, timestamp_ntz'1970-01-01 00:00:00', {quoted(name)})")
    raise TypeError(f"{name} is {kind.simpleString()}: only whole numbers, dates and times have an order in bins")


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    by: Sequence[str] = (),
) -> DataFrame:
    """Pairs of rows whose closed intervals overlap, and whose columns ``by`` are equal.

    A point is an interval with the same start and end. An interval's level is the power of two that
    covers its length, and a pair is looked for at the greater level of the two, in bins of that width: each
    interval lies in two of them at most, however long it is. The pair comes out in the bin of the later
    start alone. So the join is one on level and bin, which Spark can sort, hash and split where it is hot. Rows with
    a null or a negative length overlap nothing.
    """
    rest = [name for name in right.columns if name not in by]
    _distinct_names(left.columns, rest)

    def sized(df: DataFrame, span: tuple[str, str]) -> DataFrame:
        start, end = (as_number(df, name) for name in span)
        own = df.withColumn("__start", start).withColumn("__end", end).where("__end >= __start")
        return own.withColumn("__level", F.ceil(F.log2(F.col("__end") - F.col("__start") + 1)).cast("int"))

    one, two = sized(left, left_span), sized(right, right_span)

    def binned(df: DataFrame, others: DataFrame) -> DataFrame:
        levels = sorted(row[0] for row in others.select("__level").distinct().collect())  # 64 at most
        at = F.transform(array_literal(levels, "int"), lambda other: F.greatest(other, F.col("__level")))
        own = df.withColumn("__at", F.explode(F.array_distinct(at)))
        return own.withColumn("__bin", F.explode(F.expr("sequence(shiftright(__start, __at), shiftright(__end, __at))")))

    same = F.expr("l.__at = r.__at and l.__bin = r.__bin")
    for name in by:
        same &= F.col(f"l.{quoted(name)}") == F.col(f"r.{quoted(name)}")
    overlap = F.expr("""
        l.__start <= r.__end and r.__start <= l.__end and l.__at = greatest(l.__level, r.__level)
        and l.__bin = shiftright(greatest(l.__start, r.__start), l.__at)
    """)
    met = binned(one, two).alias("l").join(binned(two, one).alias("r"), same & overlap)
    return met.select(*_columns(left.columns, "l"), *_columns(rest, "r"))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    left_time: str,
    right_time: str,
    by: Sequence[str] = (),
    how: str = "left",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Each left row with the latest right row of its key whose time is not after its own.

    Both sides are one sorted stream per key, in which a window carries the last right row along. A key with too
    many rows is cut at quantiles of its times; what each cut begins with is the last right row of
    the cuts before it, found from one row per cut. Of several right rows of one time, the one with the
    greatest hash counts. ``how`` is ``left`` or ``inner``; rows with a null key or time match nothing.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"an as-of join is left or inner, not {how!r}")
    rest = [name for name in right.columns if name not in by]
    _distinct_names(left.columns, rest)
    keys = [f"__key{at}" for at in range(len(by))]

    def stream(df: DataFrame, time: str, is_left: bool) -> DataFrame:
        row = F.struct(*[F.col(quoted(name)) for name in (df.columns if is_left else rest)])
        none = F.lit(None)
        return df.select(
            *[F.col(quoted(name)).alias(key) for name, key in zip(by, keys)],
            as_number(df, time).alias("__time"),
            F.lit(is_left).alias("__is_left"),
            (F.lit(0).cast("long") if is_left else F.xxhash64(*[quoted(name) for name in rest])).alias("__tie"),
            (row if is_left else none.cast(left_row)).alias("__l"),
            (none.cast(right_row) if is_left else row).alias("__r"),
        )

    left_row, right_row = left.schema, T.StructType([right.schema[name] for name in rest])
    rows = stream(left, left_time, True).unionByName(stream(right, right_time, False))
    usable = F.col("__time").isNotNull()
    for key in keys:
        usable &= F.col(key).isNotNull()
    timed = rows.where(usable)
    keys = keys or ["__key"]
    timed = timed if by else timed.withColumn("__key", F.lit(0))
    counts = timed.groupBy(*keys).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    share = _hot_share(left, total, hot_rows)
    hot = counts.where(F.col("n") > share).collect()
    if hot:
        parts = math.ceil(max(row["n"] for row in hot) / share)
        known = left.sparkSession.createDataFrame([tuple(row)[:-1] for row in hot], timed.select(*keys).schema)
        share_of = [at / parts for at in range(1, parts)]
        cuts = timed.join(F.broadcast(known), keys).groupBy(*keys)
        cuts = cuts.agg(F.array_distinct(F.percentile_approx("__time", share_of, 10 * parts)).alias("__cuts")).collect()
        schema = known.schema.add("__cuts", T.ArrayType(T.LongType()))
        cuts = F.broadcast(left.sparkSession.createDataFrame([tuple(row) for row in cuts], schema))
        timed = timed.join(cuts, keys, "left")
        cut = F.coalesce(F.size(F.filter("__cuts", lambda at: at < F.col("__time"))), F.lit(-1))
        timed = timed.withColumn("__cut", F.when(F.col("__cuts").isNull(), -1).otherwise(cut))
        heads = cuts.select(*keys, F.explode(F.sequence(F.lit(0), F.size("__cuts"))).alias("__cut"))
        last = timed.where("__cut >= 0 and not __is_left").groupBy(*keys, "__cut")
        last = last.agg(F.max_by("__r", F.struct("__time", "__tie")).alias("__last"))
        before = Window.partitionBy(*keys).orderBy("__cut").rowsBetween(Window.unboundedPreceding, -1)
        heads = heads.join(last, [*keys, "__cut"], "left")
        heads = heads.select(*keys, "__cut", F.last("__last", ignorenulls=True).over(before).alias("__head"))
    else:
        timed = timed.withColumn("__cut", F.lit(-1))
    so_far = Window.partitionBy(*keys, "__cut").orderBy("__time", "__is_left", "__tie")
    so_far = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = timed.withColumn("__r", F.last("__r", ignorenulls=True).over(so_far)).where("__is_left")
    if hot:
        found = found.join(F.broadcast(heads), [*keys, "__cut"], "left")
        found = found.withColumn("__r", F.coalesce("__r", "__head"))
    found = found.select("__l", "__r")
    if how == "left":
        found = found.unionByName(rows.where(~usable & F.col("__is_left")).select("__l", "__r"))
    else:
        found = found.where("__r is not null")
    return found.select("__l.*", *[F.col(f"__r.{quoted(name)}").alias(name) for name in rest])
