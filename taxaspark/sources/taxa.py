"""Lists of taxa, and their names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaspark.functions import int_like_python, strip
from taxaspark.functions.text import WHITE
from taxaspark.sources.lines import read_lines


def read_taxa(spark: SparkSession, path: str) -> DataFrame:
    """taxid: the first word of each line; blank lines, lines that start with ``#`` and words that aren't numbers don't count."""
    lines = read_lines(spark, path).select(strip(F.col("value")).alias("value")).where("value <> '' and not startswith(value, '#')")
    return lines.select(int_like_python(F.split(F.col("value"), WHITE, 2)[0]).alias("taxid")).where("taxid is not null").distinct()


def read_taxonomy(spark: SparkSession, names: str, merged: str | None = None) -> DataFrame:
    """taxid, name from dump files: scientific names, and for merged ids the name of the id they became.

    Rows have fields between ``\\t|\\t`` and end in ``\\t|``.
    """
    fields = lambda path: read_lines(spark, path).select(F.split(F.regexp_replace("value", r"\t\|$", ""), r"\t\|\t").alias("f"))
    own = fields(names).where("get(f, 3) = 'scientific name'").select(F.get("f", F.lit(0)).try_cast("bigint").alias("taxid"), F.get("f", F.lit(1)).alias("name"))
    own = own.where("taxid > 0")
    if merged:
        became = fields(merged).select(F.get("f", F.lit(0)).try_cast("bigint").alias("old"), F.get("f", F.lit(1)).try_cast("bigint").alias("taxid"))
        own = own.unionByName(became.join(own, "taxid").select(F.col("old").alias("taxid"), "name"))
    return own.groupBy("taxid").agg(F.min("name").alias("name"))
