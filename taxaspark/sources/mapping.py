"""Map tables: what a sequence key stands for."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaspark.sources.delimited import read_delimited

#: The columns of a map table, in the order in which it is written; and those a reader asks for.
COLUMNS = ["seqid", "assembly", "taxid", "header", "description", "gff", "protein_fasta"]
NEEDED = ["seqid", "assembly", "header", "description", "gff", "protein_fasta"]


def read_mapping(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """at, and NEEDED as strings (empty for null), from tab- or comma-separated files, gzipped or not.

    ``at`` orders rows by file as given, then place: of rows with one key the last counts.
    """
    parts = []
    for k, path in enumerate([paths] if isinstance(paths, str) else paths):
        rows = read_delimited(spark, path)
        missing = sorted(set(NEEDED) - set(rows.columns))
        if missing:
            raise ValueError(f"map table {path} lacks the columns {', '.join(missing)}")
        at = F.struct(F.lit(k).alias("input"), F.col("at.file").alias("file"), F.col("at.block").alias("block"), F.col("at.row").alias("row"))
        parts.append(rows.select(at.alias("at"), *[F.coalesce(c, F.lit("")).alias(c) for c in NEEDED]))
    if not parts:
        raise ValueError("no map table is given")
    return reduce(DataFrame.unionByName, parts)


def last_by(rows: DataFrame, key: str) -> DataFrame:
    """Of the rows with one ``key`` that isn't empty, the last by ``at``."""
    rest = [c for c in rows.columns if c not in ("at", key)]
    kept = rows.where(F.col(key) != "").groupBy(key).agg(F.max_by(F.struct(*rest), F.col("at")).alias("r"))
    return kept.select(key, *[F.col(f"r.{c}").alias(c) for c in rest])


def repeated_keys(mapping: DataFrame) -> DataFrame:
    """seqid: the keys that stand in more than one of the files."""
    return mapping.where("seqid <> ''").groupBy("seqid").agg(F.min("at.input").alias("a"), F.max("at.input").alias("b")).where("a < b").select("seqid")
