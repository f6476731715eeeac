"""Counts of a run, taken while it runs: rows of each source and of the result."""

from __future__ import annotations

import time
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tableflow.sinks.store import PartitionedTable

_ROWS = "part string, id string, rows bigint, started timestamp, seconds double, run string"


class RunMetrics:
    """Observations of one run, and the table their counts are added to.

    Rows are counted as they pass, so nothing is read twice. What a source's own filter and column list
    leave is counted; a filter behind the join stays above the count, so it does not reach the scan.
    """

    def __init__(self, spark: SparkSession, location: str):
        self.spark, self.run, self.began = spark, uuid.uuid4().hex, time.time()
        self.table = PartitionedTable(spark, location, ("run",))
        self.seen: list[tuple[str, str, Observation]] = []

    def counted(self, df: DataFrame, part: str, name: str) -> DataFrame:
        observation = Observation(f"tableflow_{self.run}_{len(self.seen)}")
        self.seen.append((part, name, observation))
        return df.observe(observation, F.count(F.lit(1)).alias("rows"))

    def write(self) -> None:
        """One row for each source and one for the result; null for what the plan did not need.

        A count arrives with the end of the first job that it is part of. Asked for once all such messages
        are in, it is there or never comes: a side that turns out not to be needed is not run to its end.
        """
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        started, seconds = datetime.fromtimestamp(self.began, timezone.utc), time.time() - self.began
        rows = []
        for part, name, observation in self.seen:
            found = observation._jo.getRowOrEmpty()
            rows.append((part, name, found.get().getLong(0) if found.isDefined() else None, started, seconds, self.run))
        self.table.create(_ROWS)
        self.table.insert(self.spark.createDataFrame(rows, _ROWS).coalesce(1))
