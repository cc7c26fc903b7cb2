"""Lines of text files in a stable order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def require(spark: SparkSession, path: str) -> None:
    """An error if there is nothing at ``path``, which may be a pattern."""
    if "*" not in path and not exists(spark, path):
        raise FileNotFoundError(f"no such file: {path}")


def is_directory(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def read_lines(spark: SparkSession, paths: str | list[str], line_sep: str | None = None) -> DataFrame:
    """at, value: ``at`` is a struct that orders lines by path as given, then file, then place.

    A file's splits are ordered by their start, and lines within a split by a counter of the task that reads it; nothing is shuffled.
    Bytes that aren't UTF-8 are replaced.
    """
    paths = [paths] if isinstance(paths, str) else paths
    for p in paths:
        require(spark, p)
    parts = []
    for k, p in enumerate(paths):
        reader = spark.read if line_sep is None else spark.read.option("lineSep", line_sep)
        meta = F.col("_metadata")
        at = F.struct(F.lit(k).alias("input"), meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("row"))
        parts.append(reader.text(p).select(at.alias("at"), F.make_valid_utf8("value").alias("value")))
    return reduce(DataFrame.unionAll, parts)


def plain(path: Column) -> Column:
    """A local path without its scheme, as users write it; others as they are."""
    return F.regexp_replace(path, "^file:/+", "/")


def read_files(spark: SparkSession, files: list[str], line_sep: str | None = None) -> DataFrame:
    """file, at, value of many files in one scan, whatever their number."""
    meta = F.col("_metadata")
    reader = spark.read if line_sep is None else spark.read.option("lineSep", line_sep)
    if not files:
        return spark.createDataFrame([], "file string, at struct<input int, file string, block bigint, row bigint>, value string")
    at = F.struct(F.lit(0).alias("input"), meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("row"))
    return reader.text(files).select(plain(meta["file_path"]).alias("file"), at.alias("at"), F.make_valid_utf8("value").alias("value"))


def sums_before(lines: DataFrame, counts: dict[str, Column]) -> DataFrame:
    """``lines`` with, by name, the sum of each count over all lines before this one in its file.

    Sums run within a file's split, one task each, and a split starts from the sum of those before: one row a split is gathered.
    """
    split = F.struct(F.col("at.input").alias("input"), F.col("at.file").alias("file"), F.col("at.block").alias("block"))
    rows = lines.withColumns({"__split": split, **{f"__{n}": c.cast("bigint") for n, c in counts.items()}})
    totals = rows.groupBy("__split").agg(*[F.sum(f"__{n}").alias(n) for n in counts]).collect()  # a row a split
    start, last, sums = [], None, {}
    for r in sorted(totals, key=lambda r: tuple(r["__split"])):
        if r["__split"][:2] != last:
            last, sums = r["__split"][:2], dict.fromkeys(counts, 0)
        start.append((tuple(r["__split"]), *[sums[n] for n in counts]))
        sums = {n: sums[n] + r[n] for n in counts}
    known = lines.sparkSession.createDataFrame(start, "__split struct<input int, file string, block bigint>, " + ", ".join(f"__{n}_0 bigint" for n in counts))
    earlier = Window.partitionBy("__split").orderBy("at.row").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(F.broadcast(known), "__split")
    rows = rows.withColumns({n: F.col(f"__{n}_0") + F.coalesce(F.sum(f"__{n}").over(earlier), F.lit(0)) for n in counts})
    return rows.select(*lines.columns, *counts)


def line_numbers(lines: DataFrame, name: str = "n", heads: bool = False) -> DataFrame:
    """``lines`` of :func:`read_lines`, all that it gives, with ``name``: their number from 0 in its order, over all files; nothing is shuffled.

    A split's lines are counted by the task that reads it, so that each starts from the sum of those before: a row a split comes to
    the driver. ``heads``: the first line of a file, but for the first file's, is left out.
    """
    split = F.struct(F.col("at.input").alias("input"), F.col("at.file").alias("file"), F.col("at.block").alias("block"))
    start, before = [], 0
    for r in sorted(lines.groupBy(split.alias("split")).agg(F.min("at.row").alias("low"), F.count("*").alias("n")).collect(), key=lambda r: tuple(r["split"])):
        drops = heads and bool(start) and r["split"]["block"] == 0
        start.append((r["low"] >> 33, r["low"], r["low"] + r["n"], before - drops, drops))
        before += r["n"] - drops
    known = lines.sparkSession.createDataFrame(start, "__task bigint, __low bigint, __end bigint, __before bigint, __drops boolean")
    # by the task that reads a line, which counts its few splits' lines one after the other: a number is looked up, and no path
    row = F.col("at.row")
    rows = lines.join(F.broadcast(known), (F.shiftright(row, 33) == F.col("__task")) & (row >= F.col("__low")) & (row < F.col("__end")))
    rows = rows.where(~(F.col("__drops") & (row == F.col("__low"))))
    return rows.select(*lines.columns, (F.col("__before") + F.col("at.row") - F.col("__low")).alias(name))


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a file; empty if there is none."""
    require(spark, path)
    rows = spark.read.text(path).head(1)
    return rows[0][0] if rows else ""


def delimiter(spark: SparkSession, path: str) -> str:
    """A tab if the first line has one, else a comma."""
    return "\t" if "\t" in first_line(spark, path) else ","
