"""FASTA records as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: columns of a FASTA line.
WRAP = 60


def wrap(seq: Column, width: int = WRAP) -> Column:
    """The sequence in lines of ``width``, without a line end after the last."""
    return F.regexp_replace(seq, f"(.{{{width}}})(?=.)", "$1\n")


def record_bytes(header: Column, seq_length: Column, width: int = WRAP) -> Column:
    """Characters of a record with its line ends: the header's, and the sequence's in lines of ``width``."""
    return (F.length(header) + 1 + seq_length + F.ceil(seq_length / F.lit(width))).cast("bigint")


def safe_header(header: Column) -> Column:
    """On one line, without spaces at its ends."""
    return F.trim(F.replace(header, F.lit("\n"), F.lit(" ")))
