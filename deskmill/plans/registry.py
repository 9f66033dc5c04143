"""Query name to Spark job and, where SQL can say it, the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Job = Callable[[SparkSession, str], DataFrame]

JOBS: dict[str, Job] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable[[Job], Job]:
    def register(job: Job) -> Job:
        if name in JOBS:
            raise ValueError(f"{name} is registered twice")
        JOBS[name] = job
        if check is not None:
            CHECKS[name] = check
        return job

    return register


def iso_days(df: DataFrame) -> DataFrame:
    """DATE columns as ISO text, which both engines print alike."""
    days = {name: F.date_format(name, "yyyy-MM-dd") for name, kind in df.dtypes if kind == "date"}
    return df.withColumns(days) if days else df
