"""filter: an assignment file by taxa and edit distance."""

from __future__ import annotations

import logging

from pyspark.sql import Observation, SparkSession

from taxaspark.operators.filters import counters, filter_hits, kept_lines, taxa_lists
from taxaspark.sinks import write_lines, write_splits
from taxaspark.sources import read_assignments, read_taxa
from taxaspark.storage import materialize, scratch

log = logging.getLogger(__name__)


def filter_file(spark: SparkSession, source: str, out: str, include_taxa: str | None = None, exclude_taxa: str | None = None, edit_delta: int = 0) -> dict[str, int]:
    """Write the lines that keep a hit, in input order; the counts of what was kept and removed.

    One pass over the input, without a shuffle: lines are written by file split, and counted on their way. Only where a list of taxa
    is too long for a lookup, hits are joined with it, and lines are put in order again.
    """
    if edit_delta < 0:
        raise ValueError("--edit-delta must be 0 or more")
    taxa = [None if p is None else read_taxa(spark, p) for p in (include_taxa, exclude_taxa)]
    lists = taxa_lists(*taxa)
    reads = read_assignments(spark, source)
    seen = Observation()
    filtered = filter_hits(reads, *taxa, edit_delta, lists).observe(seen, *counters())
    if len(lists) == 2:
        write_splits(kept_lines(filtered), reads.inputFiles(), out)
    else:
        with scratch(spark):  # written before the sort, which evaluates its input more than once
            write_lines(kept_lines(materialize(filtered, "filtered")), out, order=["at"])
    counts = seen.get
    for name, n in counts.items():
        log.info("%s: %d", name.replace("_", " "), n)
    return counts
