"""Positions in intervals: an equi-join on bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from taxaspark.storage import materialize

#: Bases of a bin, about the length of a gene, so that most intervals stand in one or two.
BIN = 2048
#: Bins of one level that an interval reaches at most (and one more at its edge); and levels, enough for 64 bits.
STEP = 64
LEVELS = 9
MOST = (1 << 63) - 1


def intervals_at(points: DataFrame, intervals: DataFrame, on: list[str], pos: str = "pos", fuzzy: int = 0, width: int = BIN) -> DataFrame:
    """``points`` inner-joined with the closed intervals (start, end) that hold ``pos``, and exact (boolean).

    Where none holds it and ``fuzzy`` is over 0, those that meet [max(1, pos - fuzzy), pos + fuzzy]. An interval goes to every bin
    that it reaches when widened by ``fuzzy``, a point to its own, so that each pair meets once. One that would reach more than
    STEP bins goes to a level with wider ones, STEP times as wide each, and points to the levels that some interval has: a long
    interval, or one with a wild end, is a few rows like any other. Positions under 1 have none. ``points`` must be distinct in
    ``on`` and ``pos``. (Intervals are written, and their levels are a job.)
    """
    fuzzy = max(0, fuzzy)
    # a point sees what ends at 1 or later, however far it is from there
    low = F.greatest("start", F.lit(fuzzy).cast("bigint")) - fuzzy
    high = F.least("end", F.lit(MOST - fuzzy).cast("bigint")) + fuzzy
    spread = intervals.where((F.col("end") >= 1) & (F.col("start") <= F.col("end"))).withColumns({"low": low, "high": high})
    level = F.lit(0)
    for k in range(1, LEVELS):
        level = F.when(F.col("high") - F.col("low") >= width * STEP**k, k).otherwise(level)
    # written, as their levels are asked for before they are joined
    spread = materialize(spread.withColumn("level", level), "intervals")
    levels = sorted(r[0] for r in spread.select("level").distinct().collect())  # LEVELS at most
    bins = F.sequence(_bin(F.col("low"), width), _bin(F.col("high"), width))
    # a long interval stands in many bins, so every interval's bin is a key like any other: keys spread even where contigs don't
    spread = spread.withColumn("bin", F.explode(bins))
    each = F.explode(F.array(*map(F.lit, levels))) if len(levels) > 1 else F.lit(levels[0] if levels else 0)
    binned = points.where(F.col(pos) > 0).withColumn("level", each).withColumn("bin", _bin(F.col(pos), width))
    joined = binned.join(spread, [*on, "level", "bin"]).where(F.col(pos).between(F.col("low"), F.col("high"))).drop("level", "bin", "low", "high")
    joined = joined.withColumn("exact", _holds(F.col(pos)))
    if not fuzzy:
        return joined
    some = F.max("exact").over(Window.partitionBy(*on, pos))
    return joined.withColumn("some", some).where("exact or not some").drop("some")


def _bin(place: Column, width: int) -> Column:
    """Its number among the bins of the row's level."""
    return F.call_function("div", place, F.lit(width).cast("bigint") * F.element_at(F.array(*[F.lit(STEP**k).cast("bigint") for k in range(LEVELS)]), F.col("level") + 1))


def _holds(pos: Column) -> Column:
    return (F.col("start") <= pos) & (F.col("end") >= pos)


def cds_at(hits: DataFrame, cds: DataFrame, fuzzy: int = 0) -> DataFrame:
    """assembly, accession, pos, cds_id, product, cds_ord for each distinct place of ``hits`` that has coding sequences.

    Each cds_id once a place, as its first by (start, end, cds_id, product); cds_ord counts them in that order from 1.
    """
    places = hits.where("assembly <> '' and accession <> '' and pos > 0").select("assembly", "accession", "pos").distinct()
    found = intervals_at(places, cds.withColumnRenamed("contig", "accession"), ["assembly", "accession"], "pos", fuzzy)
    one = found.groupBy("assembly", "accession", "pos", "cds_id").agg(F.min(F.struct("start", "end", "product")).alias("f"))
    order = Window.partitionBy("assembly", "accession", "pos").orderBy("f.start", "f.end", "cds_id", "f.product")
    return one.select("assembly", "accession", "pos", "cds_id", F.col("f.product").alias("product"), F.row_number().over(order).alias("cds_ord"))
