"""A session with the settings that the library counts on; any session will do, as no operator depends on them."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "taxaspark", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
