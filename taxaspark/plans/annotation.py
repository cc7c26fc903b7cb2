"""annotate: organisms, coding sequences and proteins for the hits of assignment files."""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaspark.operators.annotate import CDS_COLUMNS, TAXA_COLUMNS, annotated_lines, annotated_table, first_hits, name_organisms, number_proteins, resolve
from taxaspark.operators.intervals import cds_at
from taxaspark.operators.merge import parsed_hits
from taxaspark.sinks import touch, write_lines, write_table
from taxaspark.sinks.files import FIELDS, protein_text, write_table_lines
from taxaspark.sources import read_assignments, read_fasta_of, read_gff, read_mapping, read_taxonomy
from taxaspark.sources.lines import exists
from taxaspark.sources.mapping import last_by, repeated_keys
from taxaspark.storage import materialize, scratch

log = logging.getLogger(__name__)


def _resources(spark: SparkSession, hits: DataFrame, mapping: DataFrame, column: str, strict: bool) -> dict[str, str]:
    """Path of each assembly that has hits, from its last row in the map tables. One row an assembly comes to the driver."""
    wanted = hits.where("assembly <> ''").select("assembly").distinct()
    rows = wanted.join(last_by(mapping, "assembly").select("assembly", column), "assembly", "left").collect()
    paths = {r["assembly"]: r[column] for r in rows}
    with ThreadPoolExecutor(32) as pool:  # a remote file system answers many questions at once
        named = sorted({p for p in paths.values() if p and p != "NA"})
        there = {p for p, found in zip(named, pool.map(lambda p: exists(spark, p), named), strict=True) if found}
    for assembly, path in sorted(paths.items()):
        if path not in there:
            if strict:
                raise FileNotFoundError(f"{column} of assembly {assembly!r} does not exist: {path}")
            log.warning("assembly %s has no %s: %s", assembly, column, path)
    return {a: p for a, p in paths.items() if p in there}


def annotate(spark: SparkSession, assignments: str | list[str], map_tables: str | list[str], out: str, proteins_out: str, taxonomy: str | None = None, merged: str | None = None, taxa_only: bool = False, fuzzy: int = 0, strict: bool = False, compression: str = "none") -> int:
    """Write the annotated table and the proteins; the number of hits.

    ``taxonomy``: a dump of names; without it organisms are empty. ``strict``: a missing annotation or protein file is an error;
    else its hits have ``NA``. A sequence key in several map tables is warned of; the last one counts. ``compression``: of the
    parts of a table whose path ends in ``/``, such as gzip.
    """
    mapping = read_mapping(spark, map_tables)
    if not isinstance(map_tables, str) and len(map_tables) > 1:
        for r in repeated_keys(mapping).limit(20).collect():
            log.warning("sequence %s is in more than one map table: the last counts", r[0])
    hits = parsed_hits(read_assignments(spark, assignments)).select("at", "hit_idx", "read_id", "raw", F.col("h").isNotNull().alias("readable"), "h.*")
    names = read_taxonomy(spark, taxonomy, merged) if taxonomy else spark.createDataFrame([], "taxid bigint, name string")
    with scratch(spark):
        # named hits, their places and the coding sequences there are each written once; what follows reads them several times
        rows = materialize(name_organisms(resolve(hits, mapping), names), "hits")
        for r in rows.where("not readable").select("raw").limit(20).collect():
            log.warning("hit can't be read: %s", r[0])
        rows = rows.where("readable").drop("readable")
        n = rows.count()
        if not n:
            touch(spark, out, "\t".join(TAXA_COLUMNS + ([] if taxa_only else CDS_COLUMNS)) + "\r\n")
            touch(spark, proteins_out)
            return 0
        if taxa_only:
            write_table(annotated_table(rows), out, compression)
            touch(spark, proteins_out)
            return n
        places = materialize(first_hits(rows), "places")
        cds = read_gff(spark, _resources(spark, rows, mapping, "gff", strict), places, max(0, fuzzy))
        found = materialize(cds_at(places, cds, fuzzy), "cds")
        found, proteins = number_proteins(found, places, read_fasta_of(spark, _resources(spark, found, mapping, "protein_fasta", strict)))
        write_table_lines(annotated_lines(rows, found, FIELDS), TAXA_COLUMNS + CDS_COLUMNS, out, compression)
        write_lines(proteins.select("protein_id", protein_text(F.col("protein_id"), F.col("header"), F.col("seq")).alias("value")), proteins_out, order=["protein_id"])
        return n
