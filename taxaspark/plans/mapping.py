"""index-build, assign, merge and extract-reads."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaspark.operators.merge import best_hits, render_hits, strict_hits, taxon_report
from taxaspark.operators.numbering import dense_ids
from taxaspark.operators.reads import split_reads
from taxaspark.operators.seeds import EDIT_RATE, MAX_HITS, MIN_SEED, SEED_INTERVAL, SEED_SIZE, TUNE_MAX_HITS, assign, build_index, cut, reference_records
from taxaspark.sinks import touch, write_lines, write_table
from taxaspark.sinks.files import children, delete, join_files, parts_of, read_text
from taxaspark.sources import read_assignments, read_fasta, read_reads
from taxaspark.sources.index import buckets_for, describe, read_blocks, read_seeds, write_seeds
from taxaspark.sources.lines import delimiter, exists, is_directory, require
from taxaspark.storage import materialize, scratch


def index_build(spark: SparkSession, fasta: str, index: str, mapping: str | None = None, skip_missing: bool = False, seed_size: int = SEED_SIZE, append: bool = False) -> None:
    """Write ``<index>/seeds`` (in buckets by seed) and ``<index>/blocks`` (of sequences). ``append`` adds references to an index without a rebuild.

    A sequence key stands for one sequence: keys that repeat, or that the index has already, are an error.
    """
    known = spark.read.csv(mapping, sep=delimiter(spark, mapping), header=True) if mapping else None
    contigs = reference_records(read_fasta(spark, fasta), known, skip_missing)
    found = describe(spark, index) if append else None
    if found and found["seed_size"] != seed_size:
        raise ValueError(f"the index has seeds of {found['seed_size']} letters, not {seed_size}")
    keys = contigs.select("seqid")
    if found:
        keys = keys.unionByName(read_blocks(spark, index).where("block = 0").select("seqid"))
    twice = keys.groupBy("seqid").count().where("count > 1").head(1)
    if twice:
        raise ValueError(f"more than one sequence has the key {twice[0][0]!r}")
    cut(contigs).repartition("seqid", "block").sortWithinPartitions("seqid", "block").write.mode("append" if found else "overwrite").parquet(f"{index}/blocks")
    buckets = found["buckets"] if found else buckets_for(contigs.agg(F.coalesce(F.sum(F.length("seq")), F.lit(0))).first()[0])
    write_seeds(build_index(contigs, seed_size), index, buckets, append=bool(found))
    touch(spark, f"{index}/index.json", json.dumps({"buckets": buckets, "seed_size": seed_size}) + "\n")


#: Files of reads in a batch.
BATCH_FILES = 64


def assign_reads(spark: SparkSession, index: str, results: str, fasta: str | None = None, fastq: str | None = None, max_assignments: int | None = None, max_candidates: int | None = None, max_hits: int = MAX_HITS, tune_max_hits: int = TUNE_MAX_HITS, seed_size: int = SEED_SIZE, min_seed: float = MIN_SEED, seed_interval: int = SEED_INTERVAL, edit_rate: float = EDIT_RATE, read_offset: int = 0, force_overwrite: bool = False, batch_files: int = BATCH_FILES) -> None:
    """Write a line with the assignments of each read that has any; ``fasta`` or ``fastq`` is a file, a directory or a pattern.

    Files of reads are a stream: a checkpoint says which are done, and a batch of ``batch_files`` of them is mapped at a time. Its
    lines and the ids of its reads, with a hit or without, are folders of their own, so that a batch that is run again replaces
    what it wrote. A later run, or one after a failure, takes up new files and unfinished batches, and no read is mapped twice, also
    where ``read_offset`` (so many reads of each file are skipped) is another one. ``force_overwrite`` starts anew.

    If ``results`` ends in ``/`` it is a directory, and batches are added as folders of it. Else it is one file, joined from the
    batches' lines when there is a new one. The state stands in ``<results>.state``.
    """
    if bool(fasta) == bool(fastq):
        raise ValueError("give exactly one of fasta and fastq")
    source = fasta or fastq
    require(spark, source)
    require(spark, f"{index}/seeds")
    seeds, blocks = read_seeds(spark, index), read_blocks(spark, index)
    size = (describe(spark, index) or {}).get("seed_size", seed_size)
    if size != seed_size:
        raise ValueError(f"the index has seeds of {size} letters, not {seed_size}")
    path, whole = results.rstrip("/"), not results.endswith("/")
    state = f"{path}.state"
    lines_dir, mapped_dir = (f"{state}/lines" if whole else path), f"{state}/mapped"
    if force_overwrite:
        for p in (state, path):
            delete(spark, p)
    if exists(spark, path) and not exists(spark, state):  # results of a run that left no state: their reads are done
        earlier = read_assignments(spark, path)
        if whole:
            earlier.select(F.concat_ws("", "read_id", F.lit(":"), F.array_join("tokens", ",")).alias("value")).write.text(f"{lines_dir}/batch=000000")
        earlier.select("read_id").write.parquet(f"{mapped_dir}/batch=000000")

    def step(batch: DataFrame, number: int) -> None:
        tag = f"batch=o{read_offset}-{number:06}"
        files = sorted(r[0] for r in batch.select("path").collect())  # ``batch_files`` at most
        if not files:
            return
        reads = read_reads(spark, **{"fasta" if fasta else "fastq": files})
        if read_offset:
            numbered = dense_ids(reads, ["at"], "n")
            first = numbered.groupBy(F.col("at.input").alias("input")).agg(F.min("n").alias("low"))  # a row a file
            reads = numbered.join(F.broadcast(first), F.col("at.input") == F.col("input")).where(F.col("n") - F.col("low") >= read_offset)
        reads = reads.select(F.col("id").alias("read_id"), "seq")
        if others := [p for p in children(spark, mapped_dir) if not p.endswith(f"/{tag}")]:
            reads = reads.join(spark.read.parquet(*others).select("read_id").distinct(), "read_id", "left_anti")
        with scratch(spark):
            reads = materialize(reads, "reads")
            hits = assign(reads, seeds, blocks, max_assignments, edit_rate, size=seed_size, interval=seed_interval, max_hits=max_hits, tune_max_hits=tune_max_hits, min_seed=min_seed, max_candidates=max_candidates)
            render_hits(hits).orderBy("read_id").select("value").write.mode("overwrite").text(f"{lines_dir}/{tag}")
            reads.select("read_id").distinct().write.mode("overwrite").parquet(f"{mapped_dir}/{tag}")

    if "*" not in source and not is_directory(spark, source):
        source = f"{source[:-1]}[{source[-1]}]"  # a stream reads directories and patterns; this one fits the file alone
    stream = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").option("maxFilesPerTrigger", batch_files).load(source)
    stream.select("path").writeStream.foreachBatch(step).option("checkpointLocation", f"{state}/checkpoint-{read_offset}").trigger(availableNow=True).start().awaitTermination()
    if whole:
        batches = children(spark, lines_dir)
        done = "\n".join(batches)
        if not exists(spark, path) or not exists(spark, f"{state}/joined") or "\n".join(r[0] for r in spark.read.text(f"{state}/joined").collect()) != done:
            join_files(spark, [p for b in batches for p in parts_of(spark, b)], path, keep=True)
            touch(spark, f"{state}/joined", done)


def merge_files(spark: SparkSession, inputs: list[str], output: str, mode: str = "taxid", report: str | None = None) -> None:
    """Write the merged assignments, by read, and the statistics by taxon."""
    if not inputs:
        raise ValueError("give at least one input")
    best = best_hits(strict_hits(read_assignments(spark, inputs)), mode)
    write_lines(render_hits(best), output, order=["read_id"])
    if report:
        write_table(taxon_report(best).orderBy("taxid"), report)


def extract_reads(spark: SparkSession, assignments: str | list[str], matched: str, unmatched: str, fasta: str | None = None, fastq: str | None = None) -> None:
    """Write the reads that have an assignment, and those that don't, in input order and the format of the input."""
    reads = read_reads(spark, fasta, fastq)
    for rows, path in zip(split_reads(reads, read_assignments(spark, assignments)), (matched, unmatched), strict=True):
        write_lines(rows.select("at", read_text(F.col("description"), F.col("seq"), F.col("qual")).alias("value")), path, order=["at"])
