"""Splitting reads by whether they have an assignment."""

from __future__ import annotations

from pyspark.sql import DataFrame


def split_reads(reads: DataFrame, assignments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Matched and unmatched ``reads``: those whose id is, or isn't, a read_id of ``assignments``."""
    ids = assignments.where("read_id is not null").select(assignments["read_id"].alias("id")).distinct()
    return reads.join(ids, "id", "left_semi"), reads.join(ids, "id", "left_anti")
