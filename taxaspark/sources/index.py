"""The index of references: seeds in buckets, and blocks of sequences.

Rows of seeds stand in files by their seed's hash. A session that is told of these buckets joins and counts seeds where they are:
reads' seeds go to the index, and the index isn't shuffled.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaspark.sources.lines import exists

#: Letters of references for a bucket of seeds, and the least number of buckets.
BUCKET_LETTERS = 1 << 23
LEAST_BUCKETS = 8


def describe(spark: SparkSession, index: str) -> dict | None:
    """buckets and seed_size of an index; None where there is none."""
    path = f"{index}/index.json"
    return json.loads("".join(r[0] for r in spark.read.text(path).collect())) if exists(spark, path) else None


@contextmanager
def _named(spark: SparkSession, index: str, buckets: int) -> Iterator[str]:
    """A name for the seeds' files and their buckets, for as long as a plan or a write needs one; the files stay."""
    name = f"taxaspark_{uuid.uuid4().hex}"
    place = f"{index}/seeds".replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} (seed STRING, seqid STRING, taxid BIGINT, pos BIGINT) USING parquet CLUSTERED BY (seed) SORTED BY (seed) INTO {buckets} BUCKETS LOCATION '{place}'")
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE {name}")


def read_seeds(spark: SparkSession, index: str) -> DataFrame:
    """seed, seqid, taxid, pos, in buckets by seed."""
    found = describe(spark, index)
    if found is None:
        return spark.read.parquet(f"{index}/seeds")
    with _named(spark, index, found["buckets"]) as name:
        return spark.table(name)


def read_blocks(spark: SparkSession, index: str) -> DataFrame:
    """seqid, taxid, block, part."""
    return spark.read.parquet(f"{index}/blocks")


def write_seeds(seeds: DataFrame, index: str, buckets: int, append: bool = False) -> None:
    """A file for each bucket, sorted by seed; ``append`` adds files to the buckets."""
    spark = seeds.sparkSession
    rows = seeds.select("seed", F.col("seqid").cast("string").alias("seqid"), F.col("taxid").cast("bigint").alias("taxid"), F.col("pos").cast("bigint").alias("pos")).repartition(buckets, "seed")
    if append:
        with _named(spark, index, buckets) as name:
            rows.write.mode("append").format("parquet").bucketBy(buckets, "seed").sortBy("seed").saveAsTable(name)
        return
    name = f"taxaspark_{uuid.uuid4().hex}"
    rows.write.mode("overwrite").format("parquet").bucketBy(buckets, "seed").sortBy("seed").option("path", f"{index}/seeds").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")


def buckets_for(letters: int) -> int:
    return max(LEAST_BUCKETS, -(-letters // BUCKET_LETTERS))
