"""A session with the settings that the library's results are defined under."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: UTC dates; re-planning at run time; equal sides of skewed joins split.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def session(master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName("brackwater")
    if master:
        builder = builder.master(master)
    return builder.config(map=SETTINGS | settings).getOrCreate()
