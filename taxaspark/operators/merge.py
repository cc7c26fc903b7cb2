"""Merging the hits of a read over inputs, and statistics by taxon."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from taxaspark.functions import strict_hits_of

MODES = {"taxid": ["read_id", "taxid"], "taxid-gi": ["read_id", "taxid", "seqid"]}


def parsed_hits(reads: DataFrame) -> DataFrame:
    """at, hit_idx, read_id, raw, h: a row for each hit; h is null where it can't be read."""
    rows = reads.select("at", "read_id", F.posexplode(strict_hits_of(F.col("tokens"))).alias("hit_idx", "t"))
    return rows.select("at", "hit_idx", "read_id", "t.raw", "t.h")


def strict_hits(reads: DataFrame) -> DataFrame:
    """at, read_id, tokens -> at, hit_idx, read_id, raw, taxid, seqid, pos, edit: a row for each hit that can be read."""
    return parsed_hits(reads).where("h is not null").select("at", "hit_idx", "read_id", "raw", "h.*")


def malformed_hits(reads: DataFrame) -> DataFrame:
    """at, hit_idx, read_id, raw of the hits that :func:`strict_hits` leaves out."""
    return parsed_hits(reads).where("h is null").drop("h")


def best_hits(hits: DataFrame, mode: str = "taxid") -> DataFrame:
    """read_id, taxid, seqid, pos, edit: of each read and taxon (and sequence) the hit of the least edit distance.

    Equal distances: the least sequence, then the least position. One aggregation, with partial results before the shuffle.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}")
    best = hits.groupBy(*MODES[mode]).agg(F.min(F.struct("edit", F.col("seqid").alias("s"), "pos")).alias("b"))
    return best.select("read_id", "taxid", F.col("b.s").alias("seqid"), "b.pos", "b.edit")


def render_hits(best: DataFrame) -> DataFrame:
    """read_id, value: a line for each read, its hits by distance, taxon, sequence and position."""
    full = F.concat_ws("", F.col("taxid"), F.lit("-"), F.col("seqid"), F.lit("-"), F.col("pos"), F.lit("="), F.col("edit"))
    text = F.when(F.col("seqid") != "", full).otherwise(F.concat_ws("=", F.col("taxid"), F.col("edit")))
    lists = best.select("read_id", F.struct("edit", "taxid", "seqid", "pos", text.alias("text")).alias("h")).groupBy("read_id").agg(F.array_sort(F.collect_list("h")).alias("h"))
    return lists.select("read_id", F.concat("read_id", F.lit(":"), F.array_join(F.transform("h", lambda h: h["text"]), ",")).alias("value"))


def taxon_report(best: DataFrame) -> DataFrame:
    """taxid, reads, unique_reads (of no other taxon), hits, min_edit, sum_edit. Of each taxon, over merged hits."""
    by_read = best.groupBy("read_id", "taxid").agg(F.count("*").alias("n"), F.min("edit").alias("low"), F.sum("edit").alias("total"))
    rows = by_read.withColumn("taxa", F.count("*").over(Window.partitionBy("read_id")))
    return rows.groupBy("taxid").agg(F.count("*").alias("reads"), F.sum((F.col("taxa") == 1).cast("bigint")).alias("unique_reads"), F.sum("n").alias("hits"), F.min("low").alias("min_edit"), F.sum("total").alias("sum_edit"))
