"""FASTA and FASTQ, plain or gzipped, through Spark's text source.

A FASTA record starts with ``>`` at the start of a line, so records are split at ``\\n>``: a header that holds ``>`` stays whole,
a file of any size is read record by record, and plain files are split among tasks. A file starts with its first record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaspark.functions.text import WHITE
from taxaspark.sources.lines import read_files, read_lines


def _first_word(header: Column) -> Column:
    return F.split(header, WHITE, 2)[0]


def parse_fasta(rows: DataFrame) -> DataFrame:
    """value (a record without its mark, or with it) and other columns -> those, id (first word), description (whole header), seq."""
    rest = [c for c in rows.columns if c != "value"]
    rows = rows.withColumn("value", F.regexp_replace("value", "^[\\s\\uFEFF]*>", "")).where("trim(value) <> ''")
    line = F.substring_index("value", "\n", 1)
    header = F.regexp_replace(line, "\r$", "")
    body = F.regexp_replace(F.substring(F.col("value"), F.length(line) + 2, F.length("value")), "\\s+", "")
    return rows.select(*rest, _first_word(header).alias("id"), header.alias("description"), body.alias("seq"))


def read_fasta(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """at, id, description, seq."""
    return parse_fasta(read_lines(spark, paths, line_sep="\n>"))


def read_fasta_of(spark: SparkSession, files: dict[str, str]) -> DataFrame:
    """assembly, at, id, description, seq from each assembly's file, all files in one scan."""
    known = spark.createDataFrame([(p.removeprefix("file://"), a) for a, p in files.items()], "file string, assembly string")
    rows = read_files(spark, sorted(set(files.values())), line_sep="\n>").join(F.broadcast(known), "file").drop("file")  # a row a file: no task gets all records of one
    return parse_fasta(rows)


def read_fastq(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """at, id, description, seq, qual from records of four lines.

    Which of four a line is depends on all lines before it in its file: lines are counted by file split, and each split starts from
    the sum of those before, so that only one number a split is gathered. Lines go to their records with the numbers of file and
    split in place of the names, and nothing sorts them before: a gzipped file is one split, and what reads it holds little.
    """
    lines = read_lines(spark, path)
    split = F.struct(F.col("at.input").alias("input"), F.col("at.file").alias("file"), F.col("at.block").alias("block"))
    lines = lines.select("at", split.alias("split"), F.regexp_replace("value", "\r$", "").alias("value"))
    low = lines.groupBy("split").agg(F.min("at.row").alias("low"), F.count("*").alias("n")).collect()
    start, last, before, files = [], None, 0, 0
    for k, r in enumerate(sorted(low, key=lambda r: tuple(r["split"]))):
        if r["split"][:2] != last:
            last, before, files = r["split"][:2], 0, files + 1
        start.append((tuple(r["split"]), r["low"], before, files, k))
        before += r["n"]
    known = F.broadcast(spark.createDataFrame(start, "split struct<input int, file string, block bigint>, low bigint, before bigint, f int, s int"))  # a row a split
    n = F.col("before") + F.col("at.row") - F.col("low")
    numbered = lines.join(known, "split").select("f", F.floor(n / 4).cast("bigint").alias("record"), "s", F.col("at.row").alias("row"), (n % 4).cast("int").alias("k"), "value")
    records = numbered.repartition("f", "record").groupBy("f", "record").agg(F.min(F.struct("s", "row")).alias("p"), *[F.max(F.when(F.col("k") == k, F.col("value"))).alias(name) for k, name in ((0, "head"), (1, "seq"), (3, "qual"))])
    at = F.struct("split.input", "split.file", "split.block", "p.row").alias("at")
    records = records.withColumn("s", F.col("p.s")).join(known.select("s", "split"), "s").withColumn("at", at)
    header = F.regexp_replace("head", "^@", "")
    return records.where("head <> ''").select("at", _first_word(header).alias("id"), header.alias("description"), F.coalesce("seq", F.lit("")).alias("seq"), F.coalesce("qual", F.lit("")).alias("qual"))


def read_reads(spark: SparkSession, fasta: str | list[str] | None = None, fastq: str | list[str] | None = None) -> DataFrame:
    """Reads from exactly one of the two: at, id, description, seq, qual (null for FASTA)."""
    if bool(fasta) == bool(fastq):
        raise ValueError("give exactly one of fasta and fastq")
    if fastq:
        return read_fastq(spark, fastq)
    return read_fasta(spark, fasta).select("at", "id", "description", "seq", F.lit(None).cast("string").alias("qual"))
