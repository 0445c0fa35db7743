"""The outcome of a job as a one-row frame."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class JobResult:
    status: str
    status_desc: str = ""
    row_cnt: int | None = None
    data: DataFrame | None = None

    def as_row(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(self.status, self.status_desc, self.row_cnt)],
            "status string, status_desc string, row_cnt bigint",
        )
