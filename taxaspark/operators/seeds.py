"""Mapping reads to references: exact seeds, candidate places, and alignment of what remains.

The index is a table with a row for each seed position of the references. Decisions where the parameters alone don't
settle the semantics: reads are mapped as they are and reverse-complemented; positions are 1-based starts of the alignment on
the forward strand; a read may have floor(edit_rate * length) edits; ``min_seed`` is the share of a read's seeds that must lie
on a candidate's diagonal (within the edits), one at least; ties go to the lower sequence key, then position.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from taxaspark.operators.alignment import semi_global_many
from taxaspark.storage import materialize

SEED_SIZE, SEED_INTERVAL = 18, 15
MAX_HITS, TUNE_MAX_HITS = 2000, 200
MIN_SEED, EDIT_RATE = 0.015, 0.13
#: Letters of a block of a reference, and of the pieces that its seeds are cut from (a letter's place is found by counting).
BLOCK = 4096
PIECE = 256
#: Distinct seeds of reads that are sent to the tasks that cut references; with more of them, references' seeds are shuffled.
SENT = 1 << 20


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTUacgtu", "TGCAAtgcaa"))


def upper(seq: Column) -> Column:
    """ASCII letters in upper case; a sequence keeps its length, whatever else it holds."""
    return F.translate(seq, "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _positions(length: Column, size: int, step: int) -> Column:
    """0-based starts of windows of ``size``, every ``step``; none in shorter sequences."""
    last = length - F.lit(size)
    return F.when(last >= 0, F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"), F.lit(step).cast("bigint"))).otherwise(F.array().cast("array<bigint>"))


def cut(contigs: DataFrame, overlap: int = 0, block: int = BLOCK) -> DataFrame:
    """seqid, taxid, block (0, 1, ...), part: sequences in upper case, cut into blocks in one pass over each.

    A part goes ``overlap`` (at most ``block``) letters into the next block, so that a window that starts in a block is whole there.
    """
    pieces = contigs.select("seqid", "taxid", F.regexp_extract_all(upper(F.col("seq")), F.lit(f"(?s).{{1,{block}}}"), F.lit(0)).alias("pieces"))
    if overlap:
        more = lambda p, k: F.concat(p, F.coalesce(F.substring(F.get("pieces", k + 1), 1, overlap), F.lit("")))
        pieces = pieces.withColumn("pieces", F.transform("pieces", more))
    return pieces.select("seqid", "taxid", F.posexplode("pieces").alias("block", "part")).withColumn("block", F.col("block").cast("bigint"))


def build_index(contigs: DataFrame, size: int = SEED_SIZE, unknown: str | None = "N") -> DataFrame:
    """seed, seqid, taxid, pos (0-based): every window of the references' sequences; those with the ``unknown`` letter aren't seeds.

    A sequence is first cut into overlapping blocks, which are dealt out, so that a chromosome isn't one task.
    """
    block = max(BLOCK, size)
    parts = cut(contigs, size - 1, block).repartition("seqid", "block")
    pieces = parts.withColumn("first", F.explode(_positions(F.length("part"), size, PIECE)))
    pieces = pieces.select("seqid", "taxid", (F.col("block") * block + F.col("first")).alias("first"), F.substring(F.col("part"), (F.col("first") + 1).cast("int"), F.lit(PIECE + size - 1)).alias("part"))
    rows = pieces.withColumn("k", F.explode(_positions(F.length("part"), size, 1)))
    rows = rows.select(F.substring(F.col("part"), (F.col("k") + 1).cast("int"), F.lit(size)).alias("seed"), "seqid", "taxid", (F.col("first") + F.col("k")).alias("pos"))
    return rows if unknown is None else rows.where(~F.contains("seed", F.lit(unknown)))


def read_seeds(reads: DataFrame, size: int = SEED_SIZE, interval: int = SEED_INTERVAL) -> DataFrame:
    """read_id, strand (+ or -), offset, seed, n_seeds, read_length."""
    both = reads.select("read_id", upper(F.col("seq")).alias("seq")).select("read_id", F.explode(F.array(F.struct(F.lit("+").alias("strand"), F.col("seq")), F.struct(F.lit("-").alias("strand"), reverse_complement(F.col("seq")).alias("seq")))).alias("s"))
    rows = both.select("read_id", "s.strand", "s.seq", _positions(F.length("s.seq"), size, interval).alias("at"))
    rows = rows.select("read_id", "strand", F.length("seq").alias("read_length"), F.size("at").alias("n_seeds"), F.explode("at").alias("offset"), "seq")
    return rows.select("read_id", "strand", "read_length", "n_seeds", "offset", F.substring(F.col("seq"), (F.col("offset") + 1).cast("int"), F.lit(size)).alias("seed"))


def seeds_of(reads: DataFrame, contigs: DataFrame, size: int = SEED_SIZE, interval: int = SEED_INTERVAL, unknown: str | None = "N") -> DataFrame:
    """Of an index of ``contigs`` that is read once, the rows of seeds that some read has, written; the rest is never stored.

    An index is worth its space (a row a letter) where other reads follow. Seeds of reads go to the references: as far as one task
    can hold them (SENT) nothing of an index is shuffled, and beyond that its rows are, once.
    """
    wanted = materialize(read_seeds(reads, size, interval).select("seed").distinct(), "wanted")
    few = F.broadcast(wanted) if wanted.count() <= SENT else wanted
    return materialize(build_index(contigs, size, unknown).join(few, "seed", "left_semi"), "seeds")


def candidates(reads: DataFrame, index: DataFrame, size: int = SEED_SIZE, interval: int = SEED_INTERVAL, max_hits: int = MAX_HITS, tune_max_hits: int = TUNE_MAX_HITS, min_seed: float = MIN_SEED, edit_rate: float = EDIT_RATE, max_candidates: int | None = None) -> DataFrame:
    """read_id, strand, seqid, taxid, diagonal (bucket), low, high (range of starts), seeds: places where a read may align.

    Seeds with more than ``max_hits`` places don't count. Where a read's seeds have more than ``tune_max_hits`` places, every
    second one counts. Frequencies come from one aggregation of the index, and only rows of seeds that some read has are joined.
    """
    wanted = read_seeds(reads, size, interval)
    frequency = index.join(wanted.select("seed").distinct(), "seed", "left_semi").groupBy("seed").agg(F.count("*").alias("places")).where(F.col("places") <= max_hits)
    wanted = wanted.join(frequency, "seed")
    dense = (F.col("places") > tune_max_hits) & (F.floor(F.col("offset") / interval) % 2 == 1)
    found = wanted.where(~dense).join(index, "seed")
    start = F.col("pos") - F.col("offset")
    slack = F.greatest(F.floor(F.col("read_length") * edit_rate), F.lit(1))
    # a diagonal may fall near a bucket's edge: each start counts in its own bucket and the next, and the fuller one is kept
    bucket = F.floor(start / slack)
    rows = found.select("read_id", "strand", "seqid", "taxid", "n_seeds", "offset", start.alias("start"), F.explode(F.array(bucket, bucket + 1)).alias("diagonal"))
    groups = rows.groupBy("read_id", "strand", "seqid", "taxid", "diagonal").agg(F.count_distinct("offset").alias("seeds"), F.min("start").alias("low"), F.max("start").alias("high"), F.max("n_seeds").alias("n_seeds"))
    near = Window.partitionBy("read_id", "strand", "seqid", "low", "high").orderBy("diagonal")
    groups = groups.where(F.col("seeds") >= F.greatest(F.ceil(F.col("n_seeds") * min_seed), F.lit(1))).withColumn("k", F.row_number().over(near)).where("k = 1")
    if max_candidates is not None:
        best = Window.partitionBy("read_id").orderBy(F.desc("seeds"), "seqid", "strand", "low")
        groups = groups.withColumn("k", F.row_number().over(best)).where(F.col("k") <= max_candidates)
    return groups.select("read_id", "strand", "seqid", "taxid", "diagonal", "low", "high", "seeds")


def verify(cands: DataFrame, reads: DataFrame, contigs: DataFrame, edit_rate: float = EDIT_RATE, max_assignments: int | None = None) -> DataFrame:
    """read_id, taxid, seqid, pos (1-based), edit: candidates that align within the edits, the best of each sequence and strand place.

    ``contigs``: seqid, seq, one row a sequence, or :func:`cut` already. A candidate meets the blocks that its window touches, no
    whole sequence; alignment runs on Arrow batches.
    """
    blocks = contigs if "part" in contigs.columns else cut(contigs.select("seqid", F.lit(None).alias("taxid"), "seq"))
    rows = cands.join(reads.select("read_id", upper(F.col("seq")).alias("read")), "read_id")
    slack = F.floor(F.length("read") * edit_rate)
    first = F.greatest(F.col("low") - slack, F.lit(0))
    size = F.col("high") + F.length("read") + slack - first
    rows = rows.select("read_id", "seqid", "taxid", F.when(F.col("strand") == "+", F.col("read")).otherwise(reverse_complement(F.col("read"))).alias("read"), first.alias("first"), size.alias("size"), slack.alias("slack")).distinct()
    touched = F.sequence(F.floor(F.col("first") / BLOCK), F.floor((F.col("first") + F.greatest("size", F.lit(1)) - 1) / BLOCK))
    met = rows.withColumn("block", F.explode(touched)).join(blocks.select("seqid", "block", "part"), ["seqid", "block"])
    whole = met.groupBy(*rows.columns).agg(F.array_sort(F.collect_list(F.struct("block", "part"))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["part"]), "")
    rows = whole.withColumn("window", F.substring(text, (F.col("first") - F.col("parts")[0]["block"] * BLOCK + 1).cast("int"), F.col("size").cast("int"))).drop("parts", "size")

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = semi_global_many(b["read"].tolist(), b["window"].tolist())
            out = b[["read_id", "taxid", "seqid"]].assign(pos=b["first"] + [s + 1 for _, s in found], edit=[e for e, _ in found])
            yield out[out["edit"] <= b["slack"]]

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    aligned = rows.mapInPandas(align, f"read_id string, taxid bigint, seqid {kinds['seqid']}, pos bigint, edit bigint")
    hits = aligned.distinct()
    if max_assignments is not None:
        best = Window.partitionBy("read_id").orderBy("edit", "seqid", "pos")
        hits = hits.withColumn("k", F.row_number().over(best)).where(F.col("k") <= max_assignments).drop("k")
    return hits


def assign(reads: DataFrame, index: DataFrame, contigs: DataFrame, max_assignments: int | None = None, edit_rate: float = EDIT_RATE, **search) -> DataFrame:
    """read_id, taxid, seqid, pos, edit of every assignment. ``reads``: read_id, seq; ``contigs``: seqid, seq, or :func:`cut`.

    Equal reads are mapped once, under a digest of their letters, and their ids meet the result: a read that comes a million times
    is no hot seed.
    """
    keyed = reads.select("read_id", upper(F.col("seq")).alias("seq")).withColumn("key", F.md5("seq"))
    once = keyed.select(F.col("key").alias("read_id"), "seq").dropDuplicates(["read_id"])
    found = verify(candidates(once, index, edit_rate=edit_rate, **search), once, contigs, edit_rate, max_assignments)
    return found.withColumnRenamed("read_id", "key").join(keyed.select("key", "read_id"), "key").select("read_id", "taxid", "seqid", "pos", "edit")


def reference_records(records: DataFrame, mapping: DataFrame | None = None, skip_missing: bool = False) -> DataFrame:
    """FASTA records (id, seq) -> seqid, taxid, seq: from ids ``seqid-taxid``, or through ``mapping`` (header, taxid, seqid).

    Records that have neither raise an error, or are left out with ``skip_missing``. (The check is a job.)
    """
    if mapping is None:
        keyed = records.select(F.substring_index("id", "-", 1).alias("seqid"), F.when(F.col("id").rlike("^[^-]+-[0-9]+$"), F.substring_index("id", "-", -1).try_cast("bigint")).alias("taxid"), "id", "seq")
    else:
        known = mapping.select(F.col("header").alias("id"), F.col("taxid").try_cast("bigint").alias("taxid"), F.col("seqid").cast("string").alias("seqid"))
        keyed = records.select("id", "seq").join(known, "id", "left").select("seqid", "taxid", "id", "seq")
    if not skip_missing:
        lost = keyed.where("taxid is null").select("id").head(1)
        if lost:
            raise ValueError(f"no sequence key and taxon for {lost[0][0]!r}")
    return keyed.where("taxid is not null").select("seqid", "taxid", "seq")
