"""Annotation of hits: sequences, organisms, coding sequences, proteins, order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaspark.operators.intervals import cds_at
from taxaspark.operators.numbering import dense_ids
from taxaspark.sources.mapping import last_by
from taxaspark.storage import materialize

#: The columns of an annotated table.
TAXA_COLUMNS = ["ReadID", "Taxid", "Organism Name", "Assembly", "Accession", "Description", "Position", "Edit Distance"]
CDS_COLUMNS = ["CDS ID", "Protein ID", "Annotation"]
PLACE = ["assembly", "accession", "pos"]
#: Coding sequences at places that are sent to every task, behind the sort of hits; more of them travel with the hits.
SENT = 1 << 19


def resolve(hits: DataFrame, mapping: DataFrame) -> DataFrame:
    """``hits`` with assembly, accession and description of their seqid; empty where it isn't in the map table."""
    by_seqid = last_by(mapping, "seqid").select("seqid", "assembly", F.col("header").alias("accession"), "description")
    out = hits.join(by_seqid, "seqid", "left")
    return out.withColumns({c: F.coalesce(c, F.lit("")) for c in ("assembly", "accession", "description")})


def name_organisms(hits: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """``hits`` with organism: the name of its own taxid, whatever the map table says of the sequence; empty if unknown."""
    names = taxonomy.where("taxid > 0").groupBy("taxid").agg(F.min("name").alias("organism"))
    return hits.join(names, "taxid", "left").withColumn("organism", F.coalesce("organism", F.lit("")))


def add_cds(hits: DataFrame, cds: DataFrame, fuzzy: int = 0) -> DataFrame:
    """A row for each hit and coding sequence at its place, with cds_id, product and cds_ord; ``NA`` and 0 where there is none."""
    found = cds_at(hits, cds, fuzzy)
    out = hits.join(found, ["assembly", "accession", "pos"], "left")
    return out.withColumns({"cds_id": F.coalesce("cds_id", F.lit("NA")), "product": F.coalesce("product", F.lit("NA")), "has_cds": F.col("cds_ord").isNotNull(), "cds_ord": F.coalesce("cds_ord", F.lit(0))})


def first_hits(hits: DataFrame) -> DataFrame:
    """assembly, accession, pos, first: each place that can have coding sequences, once, and its first hit (at, hit_idx)."""
    return hits.where("assembly <> '' and accession <> '' and pos > 0").groupBy(*PLACE).agg(F.min(F.struct("at", "hit_idx")).alias("first"))


def number_proteins(found: DataFrame, places: DataFrame, proteins: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``found`` (of :func:`cds_at`) with protein_id, and the proteins: protein_id, header, seq. ``places``: of :func:`first_hits`.

    The sequence of a coding sequence is that of its id in its assembly's proteins. Equal sequences are one protein; ids count
    from 1 in the order in which sequences come first in the annotated table, and the header is that of the first. Coding
    sequences without a protein have ``NA``. All of this is done by place, not by hit: a place's first hit tells its order.
    """
    order = F.struct(*PLACE, "first.at", "first.hit_idx", "cds_ord")
    first = found.where("cds_id <> ''").join(places, PLACE).groupBy("assembly", "cds_id").agg(F.min(order).alias("place"))
    source = proteins.where("seq <> ''").groupBy("assembly", F.col("id").alias("cds_id")).agg(F.min_by(F.struct("description", "seq"), "at").alias("p"))
    known = first.join(source, ["assembly", "cds_id"]).select("assembly", "cds_id", "place", "p.description", "p.seq", F.sha2("p.seq", 256).alias("digest"))
    distinct = known.groupBy("digest").agg(F.min("place").alias("place"), F.min_by(F.struct("description", "seq"), "place").alias("p"))
    numbered = dense_ids(distinct, ["place"], "protein_id")
    ids = known.join(numbered.select("digest", "protein_id"), "digest").select("assembly", "cds_id", "protein_id")
    out = found.join(ids, ["assembly", "cds_id"], "left").withColumn("protein_id", F.coalesce(F.col("protein_id").cast("string"), F.lit("NA")))
    return out, numbered.select("protein_id", F.col("p.description").alias("header"), "p.seq")


def with_cds(hits: DataFrame, found: DataFrame, order: list[str] | None = None) -> DataFrame:
    """A row for each hit and coding sequence at its place, with cds_id, product and protein_id; ``NA`` where there is none.

    With ``order``, hits stand in it, and those of a hit by cds_ord. Hits alone are sorted, with the number of rows that they become,
    and multiply afterwards: what is shuffled grows with the hits, however many coding sequences share a place. (``found`` is
    written and counted.)
    """
    found = materialize(found.select(*PLACE, "cds_ord", "cds_id", "product", "protein_id"), "annotations")
    sort = lambda rows: rows.orderBy(*order) if order else rows
    if found.count() <= SENT:
        rows = sort(hits.join(F.broadcast(found.groupBy(*PLACE).agg(F.max("cds_ord").alias("n"))), PLACE, "left"))
        # the generator stands between sort and join, of which the optimizer would else take the sort away
        rows = rows.withColumn("cds_ord", F.explode_outer(F.sequence(F.lit(1), F.col("n"))))
        rows = rows.join(F.broadcast(found), [*PLACE, "cds_ord"], "left")
    else:
        lists = found.groupBy(*PLACE).agg(F.array_sort(F.collect_list(F.struct("cds_ord", "cds_id", "product", "protein_id"))).alias("found"))
        rows = sort(hits.join(lists, PLACE, "left")).withColumn("f", F.explode_outer("found")).select(*hits.columns, "f.cds_id", "f.product", "f.protein_id")
    return rows.select(*hits.columns, *[F.coalesce(c, F.lit("NA")).alias(c) for c in ("cds_id", "product", "protein_id")])


#: The order of the table: assembly, accession, position, then input order.
ORDER = [*PLACE, "at", "hit_idx"]
_TAXA = dict(zip(TAXA_COLUMNS, ["read_id", "taxid", "organism", "assembly", "accession", "description", "pos", "edit"], strict=True))
_CDS = dict(zip(CDS_COLUMNS, ["cds_id", "protein_id", "product"], strict=True))


def annotated_table(hits: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """The table as it is written, in its order. Without ``found``: taxa alone."""
    rows = hits.orderBy(*ORDER) if found is None else with_cds(hits, found, ORDER)
    return rows.select(*[F.col(c).alias(n) for n, c in (_TAXA if found is None else _TAXA | _CDS).items()])


def annotated_lines(hits: DataFrame, found: DataFrame, options: dict[str, str]) -> DataFrame:
    """value: the rows of :func:`annotated_table` with ``found`` as lines, in its order; ``options``: of the fields' format.

    A hit's fields and those of a coding sequence at a place are each made into text once, however many rows they stand in.
    """
    # behind another field, as a mark of comments counts at the start of a line alone
    tail = lambda *fields: F.substr(F.to_csv(F.struct(F.lit("x").alias("x"), *fields), options), F.lit(2))
    given = found.select(*PLACE, "cds_ord", tail("cds_id", "protein_id", "product").alias("tail"))
    given = materialize(given, "annotations")
    lists = given.groupBy(*PLACE).agg(F.array_sort(F.collect_list(F.struct("cds_ord", "tail"))).alias("t")).select(*PLACE, F.col("t.tail").alias("tails"))
    head = F.to_csv(F.struct(*_TAXA.values()), options).alias("head")
    if given.count() <= SENT:
        # the generator stands between sort and join, of which the optimizer would else take the sort away
        rows = hits.orderBy(*ORDER).withColumn("one", F.explode(F.array(F.lit(1)))).select(*PLACE, head)
        rows = rows.join(F.broadcast(lists), PLACE, "left")
    else:
        rows = hits.join(lists, PLACE, "left").orderBy(*ORDER).select(head, "tails")
    rows = rows.select("head", F.explode_outer("tails").alias("tail"))
    return rows.select(F.concat("head", F.coalesce("tail", tail(*[F.lit("NA").alias(c) for c in _CDS.values()]))).alias("value"))
