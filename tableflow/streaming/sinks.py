"""Stream sinks: what a checkpoint has not seen yet is written once.

Spark logs which files each batch read before it runs, and which files a batch wrote when it ends. A batch that dies is
run again from the same files, and readers see only files of batches that have ended: each row comes out
once, wherever a run was killed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.operators.cells import row_key, row_to_cells
from tableflow.sinks.store import CellStore
from tableflow.spec import TargetSpec


def write_stream(df: DataFrame, spark: SparkSession, target: TargetSpec) -> None:
    """Write all that is there by now, in batches, and stop; the next run goes on from there.

    Options beside those of the place: ``checkpoint``, a folder of this job's own. Files (``hdfs``) are
    appended. Cells (``hbase``) are put, with the time of their batch as the version; their store is
    addressed by path.
    """
    (checkpoint,) = target.require("checkpoint")
    if target.place == "hdfs":
        kind, compression, path = target.require("format", "compression", "location")
        rows, options = df, {"compression": compression}
    elif target.place == "hbase":
        name, cf = target.require("tablename", "cf")
        if target.flag("bulkload"):
            raise ValueError("a stream puts its cells: it has no bulkload")
        store = CellStore(spark, name, target.option("format", ""))
        store.check_format()
        keys = target.option("key-columns")
        keys = [keys] if isinstance(keys, str) else keys
        version = F.unix_millis(F.current_timestamp())  # of the batch, also when it is run again
        rows, options = row_to_cells(df, row_key(df, keys), cf, version), {}
        kind, path = "parquet", store.stream_path()
    else:
        raise ValueError(f"a stream is written to hdfs or hbase, not {target.place!r}")
    writer = rows.writeStream.format(kind).outputMode("append").options(**options)
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
