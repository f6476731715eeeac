"""What the operators share: the checkpoint folder, whole groups out of sorted streams."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: stands for a null id where ids are compared; sorts before every other
NO_ID = -(2**63)
#: rows of a few numbers each up to which a counted table is broadcast
BROADCAST_ROWS = 1_000_000


#: bytes that Spark hands to a Python worker at once; its default is 64 MB, which a task holds several times
ARROW_BYTES = 4 << 20


def ready(spark: SparkSession) -> SparkSession:
    """A session whose checkpoints go to ``spark.checkpoint.dir``; a folder of our own if unset.

    Spark takes the setting up by itself when the session starts. Only a local session without it,
    as in tests, gets a temporary folder here. Arrow batches are set to ``ARROW_BYTES`` at most.
    """
    batches = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(batches))) > ARROW_BYTES:
        spark.conf.set(batches, str(ARROW_BYTES))
    if not spark.sparkContext.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="tableflow-checkpoints-")
        spark.sparkContext.setCheckpointDir(folder)
    return spark


def order_id(name: str = "doc_id") -> Column:
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID))


def stored(df: DataFrame) -> DataFrame:
    """The rows, computed once and kept in the shared checkpoint folder."""
    ready(df.sparkSession)
    return df.checkpoint()


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Stored rows, marked for broadcast only if they are counted to be few."""
    return F.broadcast(df) if df.count() <= rows else df


def whole_groups(
    batches: Iterator[pa.RecordBatch], key: str, least: int, size: Callable[[pa.Table], int] = len
) -> Iterator[pa.Table]:
    """Tables of whole groups, from batches that are sorted by ``key`` (no nulls).

    A table holds as many groups as it takes for a size of ``least``. A single group is never cut.
    """
    waiting: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        if not len(batch):
            continue
        waiting.append(batch)
        held += size(batch)
        if held < least:
            continue
        table = pa.Table.from_batches(waiting)
        keys = table.column(key).to_numpy()
        cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
        if cut:
            yield table.slice(0, cut)
        rest = table.slice(cut)
        waiting = rest.to_batches()
        held = size(rest) if cut else held
        least = least if cut else 2 * held  # a large group: look again when it has doubled
    if waiting:
        yield pa.Table.from_batches(waiting)
