"""Assignment lines as a stream.

Filtering needs one line at a time, so it has no state and no watermark. With ``trigger(availableNow=True)`` and a checkpoint, a
query takes up where it stopped, and new files in the directory are taken once. Order and dense numbers over all hits belong to
batches: use ``foreachBatch`` with the batch operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from taxaspark.functions import hit_tokens, read_id, strict_hits_of, strip
from taxaspark.operators.annotate import name_organisms
from taxaspark.operators.filters import counters, filter_hits, kept_lines, taxa_lists
from taxaspark.sources.mapping import last_by
from taxaspark.storage import materialize, scratch


def _reads(lines: DataFrame) -> DataFrame:
    line = lines.select(strip(F.make_valid_utf8("value")).alias("value")).where("value <> ''")
    return line.select(read_id(F.col("value")).alias("read_id"), hit_tokens(F.col("value")).alias("tokens"))


def _filtered(lines: DataFrame, include: list[int] | None, exclude: list[int] | None, delta: int) -> DataFrame:
    return filter_hits(_reads(lines), delta=delta, lists={"include": include, "exclude": exclude})


def _kept(filtered: DataFrame) -> DataFrame:
    return kept_lines(filtered.withColumn("at", F.lit(0))).select("value")


def filtered_lines(lines: DataFrame, include: list[int] | None = None, exclude: list[int] | None = None, delta: int = 0) -> DataFrame:
    """value -> value: lines with the hits that the filters leave. The same expressions as in batches."""
    return _kept(_filtered(lines, include, exclude, delta))


def filter_stream(spark: SparkSession, directory: str, include: list[int] | None = None, exclude: list[int] | None = None, delta: int = 0) -> DataFrame:
    return filtered_lines(spark.readStream.text(directory), include, exclude, delta)


def start_filter(spark: SparkSession, directory: str, out: str, checkpoint: str, include: list[int] | DataFrame | None = None, exclude: list[int] | DataFrame | None = None, delta: int = 0) -> StreamingQuery:
    """Filter what is there and stop; a later start with the same checkpoint takes what has come since.

    Taxa are lists or static tables. Where a table is too long for a lookup, each batch of lines is joined with it by the batch
    operators and written as a folder of its own, which replaces that of an earlier try. The counters of what was kept and removed
    are in the query's progress, under ``counters``.
    """
    tables = {n: t for n, t in (("include", include), ("exclude", exclude)) if isinstance(t, DataFrame)}
    lists = taxa_lists(**tables)
    plain = {"include": include, "exclude": exclude} | {n: lists.get(n) for n in tables}
    lines = spark.readStream.text(directory)
    if all(n in lists for n in tables):
        kept = _kept(_filtered(lines, plain["include"], plain["exclude"], delta).observe("counters", *counters()))
        return kept.writeStream.format("text").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    joined = {n: t for n, t in tables.items() if n not in lists}
    known = {n: plain[n] for n in plain if n not in joined}

    def step(batch: DataFrame, number: int) -> None:
        with scratch(spark):
            # written, as the join by line reads the lines twice
            rows = materialize(_reads(batch).withColumn("at", F.monotonically_increasing_id()), "batch")
            _kept(filter_hits(rows, delta=delta, lists=known, **joined)).write.mode("overwrite").text(f"{out}/batch={number:06}")

    return lines.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def named_hits(lines: DataFrame, mapping: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """A row for each hit with its sequence's and organism's names: a stream joined with static tables."""
    hits = _reads(lines).select("read_id", F.explode(strict_hits_of(F.col("tokens"))).alias("t")).select("read_id", "t.h").where("h is not null").select("read_id", "h.*")
    by_seqid = last_by(mapping, "seqid").select("seqid", "assembly", F.col("header").alias("accession"), "description")
    rows = hits.join(by_seqid, "seqid", "left").withColumns({c: F.coalesce(c, F.lit("")) for c in ("assembly", "accession", "description")})
    return name_organisms(rows, taxonomy)
