"""Assignment files: one read a line, with its hits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaspark.functions import hit_tokens, read_id, strip
from taxaspark.sources.lines import read_lines


def parse_assignments(lines: DataFrame) -> DataFrame:
    """at, value -> at, read_id, tokens; blank lines are left out."""
    line = lines.withColumn("value", strip(F.col("value"))).where("value <> ''")
    return line.select("at", read_id(F.col("value")).alias("read_id"), hit_tokens(F.col("value")).alias("tokens"))


def read_assignments(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return parse_assignments(read_lines(spark, paths))
