"""Delimited text with a header, whose quoted fields may hold line ends, read by many tasks a file.

Whether a line starts a record depends on all lines before it: a quote may be open. What a line does to that question is known from
the line alone: it leaves it as it is, turns it round, or settles it. So each line tells, each file split sums up, and the splits'
sums, a row each, are put together in order; then every line knows how it begins. Lines of one record are joined, and records are
parsed as such. Most records are one line and aren't moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from taxaspark.sources.lines import delimiter, read_lines, sums_before


def _ends_open(line: Column, sep: str) -> Column:
    """Whether a line that begins outside of quotes ends inside: after whole fields, quoted or not, one is opened and not closed."""
    quoted, plain = '"(?:[^"]|"")*+"[^{0}]*+', '(?!")[^{0}]*+'
    return line.rlike(f'^(?>(?:{quoted}|{plain}){{0}})*+"(?:[^"]|"")*+$'.replace("{0}", sep))


def _after_quote(line: Column, sep: str) -> Column:
    """What follows the field that a line that begins inside of quotes closes; null if it closes none."""
    closed = f'^(?:[^"]|"")*+"[^{sep}]*+{sep}?'
    return F.when(~line.rlike('^(?:[^"]|"")*+$'), F.regexp_replace(line, closed, ""))


def records(lines: DataFrame, sep: str) -> DataFrame:
    """at, value: the lines of each quoted record as one value, at the place of its first line."""
    line = F.col("value")
    outside, rest = _ends_open(line, sep), _after_quote(line, sep)
    inside = F.coalesce(_ends_open(rest, sep), F.lit(True))
    # how a line ends that begins outside, and one that begins inside of quotes
    rows = lines.withColumns({"__a": outside, "__b": inside})
    settles, turns = F.col("__a") == F.col("__b"), F.col("__a") & ~F.col("__b")
    counted = sums_before(rows, {"__turned": turns.cast("int")})
    split = F.struct("at.input", "at.file", "at.block")
    earlier = Window.partitionBy("__split").orderBy("at.row").rowsBetween(Window.unboundedPreceding, -1)
    said = F.when(settles, F.struct(F.col("__a").alias("a"), F.col("__turned").alias("n")))
    counted = counted.withColumns({"__split": split, "__said": said})
    # the last line of each split that settles it: a row a split, put in order here
    last = counted.groupBy("__split").agg(F.max_by("__said", F.when(F.col("__said").isNotNull(), F.col("at.row"))).alias("s")).collect()
    start, file, known = [], None, None
    for r in sorted(last, key=lambda r: tuple(r["__split"])):
        if r["__split"][:2] != file:
            file, known = r["__split"][:2], (False, 0)
        start.append((tuple(r["__split"]), known))
        known = (r["s"]["a"], r["s"]["n"]) if r["s"] else known
    before = lines.sparkSession.createDataFrame(start, "__split struct<input int, file string, block bigint>, __first struct<a boolean, n bigint>")
    state = F.coalesce(F.last("__said", ignorenulls=True).over(earlier), "__first")
    counted = counted.join(F.broadcast(before), "__split").withColumn("__state", state)
    opened = (F.col("__state.a").cast("bigint") + F.col("__turned") - F.col("__state.n")) % 2 == 1
    known_lines = counted.withColumn("__open", opened).withColumn("__left", F.when(F.col("__open"), F.col("__b")).otherwise(F.col("__a")))
    alone = known_lines.where(~F.col("__open") & ~F.col("__left")).select("at", "value")
    several = sums_before(known_lines.where(F.col("__open") | F.col("__left")).select("at", "value", "__open"), {"__n": (~F.col("__open")).cast("int")})
    record = F.col("__n") + (~F.col("__open")).cast("int")
    whole = several.groupBy("at.input", "at.file", record.alias("__record")).agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("r"))
    return alone.unionByName(whole.select(F.col("r")[0]["at"].alias("at"), F.array_join(F.transform("r", lambda x: x["value"]), "\n").alias("value")))


def header(spark: SparkSession, path: str, sep: str) -> list[str]:
    return spark.read.csv(path, sep=sep, header=True, quote='"', escape='"').columns


def read_delimited(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """at, and the columns of the header as strings, from a tab- or comma-separated file, gzipped or not."""
    sep = sep or delimiter(spark, path)
    names = header(spark, path, sep)
    if not names:
        return spark.createDataFrame([], "at struct<input int, file string, block bigint, row bigint>")
    lines = read_lines(spark, path)
    # a file begins with its header
    tops = lines.where("at.block = 0").groupBy(F.col("at.file").alias("__file")).agg(F.min("at.row").alias("__row"))
    body = lines.join(F.broadcast(tops), (F.col("at.file") == F.col("__file")) & (F.col("at.block") == 0) & (F.col("at.row") == F.col("__row")), "left_anti")
    shape = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(names))])
    parsed = records(body, sep).where("trim(value) <> ''").select("at", F.from_csv("value", shape.simpleString()[7:-1].replace(":", " "), {"sep": sep, "quote": '"', "escape": '"', "maxCharsPerColumn": "-1"}).alias("r"))
    return parsed.select("at", *[F.col(f"r.c{k}").alias(n) for k, n in enumerate(names)])
