"""Filtering hits by taxa and by edit distance. Rows are reads with arrays of hits, so that nothing is shuffled."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaspark.functions import lenient_hit, render_line

#: Lists up to this size become a set of literals in the plan, a hash lookup a hit.
INLINE = 10_000
#: Longer ones up to this size become one literal, arrays by hash (20 MB or so at most), which is a hash lookup, too; still longer ones are joined.
LOOKUP = 1 << 19


def parse_lenient(reads: DataFrame) -> DataFrame:
    """tokens -> hits: array of (raw, taxid, edit), without those that can't be read."""
    return reads.withColumn("hits", F.filter(F.transform("tokens", lenient_hit), lambda h: h.isNotNull()))


def _bucket(taxid: Column, n: Column) -> Column:
    return F.pmod(F.xxhash64(taxid), n).cast("int")


def buckets(taxa: DataFrame, n: int) -> Column:
    """A constant: ``taxa`` as an array of ``n`` arrays, by hash. (A job.) It comes as one text, as a column a taxon takes the planner long."""
    size = F.lit(n)
    dealt = taxa.select(_bucket(F.col("taxid"), size).alias("b"), "taxid").unionByName(taxa.sparkSession.range(n).select(F.col("id").cast("int").alias("b"), F.lit(None).cast("bigint").alias("taxid")))
    some = dealt.groupBy("b").agg(F.collect_list("taxid").alias("some"))  # without the nulls, which make empty buckets
    text = some.agg(F.to_json(F.transform(F.sort_array(F.collect_list(F.struct("b", "some"))), lambda x: x["some"]))).first()[0]
    return F.from_json(F.lit(text), "array<array<bigint>>")


def _one(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` evaluated once for a row: an array of one names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _by_taxon(hits: Column, taxa: list[int] | Column, among: bool) -> Column:
    """Hits whose taxon is, or isn't, among ``taxa``: a list, or :func:`buckets`."""
    if isinstance(taxa, Column):
        found = lambda h: F.array_contains(F.get(taxa, _bucket(h["taxid"], F.size(taxa))), h["taxid"])
    elif taxa:
        found = lambda h: h["taxid"].isin(taxa)
    else:
        found = lambda h: F.lit(False)
    return F.filter(hits, lambda h: found(h) if among else ~found(h))


def keep_taxa(hits: Column, include: list[int] | Column | None = None, exclude: list[int] | Column | None = None) -> Column:
    """Hits whose taxon is in ``include`` (None: all are) and not in ``exclude``. An empty ``include`` keeps nothing."""
    if include is not None:
        hits = _by_taxon(hits, include, True)
    if isinstance(exclude, Column) or exclude:
        hits = _by_taxon(hits, exclude, False)
    return hits


def keep_near_best(hits: Column, delta: int = 0) -> Column:
    """Hits whose edit distance is within ``delta`` of the least in the row."""
    if delta < 0:
        raise ValueError("the edit delta is 0 or more")
    return _one(F.array_min(hits["edit"]), lambda best: F.filter(hits, lambda h: h["edit"] <= best + F.lit(delta)))


def _join_taxa(reads: DataFrame, include: DataFrame | None, exclude: DataFrame | None) -> DataFrame:
    """Taxa filters for lists over LOOKUP: hits are exploded, joined and put together again in their order, by line."""
    hits = reads.select("at", F.posexplode("hits").alias("k", "h")).withColumn("taxid", F.col("h.taxid"))
    if include is not None:
        hits = hits.join(include.select("taxid"), "taxid", "left_semi")
    if exclude is not None:
        hits = hits.join(exclude.select("taxid"), "taxid", "left_anti")
    kept = hits.groupBy("at").agg(F.array_sort(F.collect_list(F.struct("k", "h"))).alias("kept"))
    out = reads.join(kept, "at", "left").withColumn("hits", F.transform(F.coalesce("kept", F.array().cast(kept.schema["kept"].dataType)), lambda x: x["h"]))
    return out.drop("kept")


def taxa_lists(include: DataFrame | None = None, exclude: DataFrame | None = None) -> dict[str, list[int] | Column | None]:
    """include and exclude as lists, those over INLINE taxa as :func:`buckets`; those over LOOKUP are absent and have to be joined.

    (Counts the lists: a job each, two if they are long.)
    """
    lists = {}
    for name, taxa in (("include", include), ("exclude", exclude)):
        some = None if taxa is None else taxa.select(F.col("taxid").cast("bigint").alias("taxid")).where("taxid is not null").distinct()
        rows = None if some is None else some.limit(INLINE + 1).collect()
        if rows is None or len(rows) <= INLINE:
            lists[name] = None if rows is None else [r[0] for r in rows]
        elif (n := some.count()) <= LOOKUP:
            lists[name] = buckets(some, n // 4 + 1)
    return lists


def filter_hits(reads: DataFrame, include: DataFrame | None = None, exclude: DataFrame | None = None, delta: int = 0, lists: dict[str, list[int] | Column | None] | None = None) -> DataFrame:
    """at, read_id, tokens -> those, parsed (readable hits) and hits (what the filters leave).

    Taxa first, then the distance to the best hit that is left, each line by itself even if a read has several. ``lists``: what
    :func:`taxa_lists` said of the taxa; longer lists are joined instead of looked up.
    """
    lists = taxa_lists(include, exclude) if lists is None else lists
    reads = parse_lenient(reads).withColumn("parsed", F.col("hits"))
    reads = reads.withColumn("hits", keep_taxa(F.col("hits"), lists.get("include"), lists.get("exclude")))
    if len(lists) < 2:
        reads = _join_taxa(reads, None if "include" in lists else include, None if "exclude" in lists else exclude)
    return reads.withColumn("hits", keep_near_best(F.col("hits"), delta))


def kept_lines(filtered: DataFrame) -> DataFrame:
    """at, value: the lines of reads with a hit left, their hits as they were written."""
    kept = filtered.where((F.col("read_id") != "") & (F.size("hits") > 0))
    return kept.select("at", render_line(F.col("read_id"), F.transform("hits", lambda h: h["raw"])).alias("value"))


def counters() -> list[Column]:
    """kept_reads, kept_hits, removed_reads, removed_hits over filtered lines, as aggregates.

    Removed hits are readable ones only; a read without readable hits is removed and adds no hit.
    """
    usable = (F.col("read_id") != "") & (F.size("parsed") > 0)
    kept = usable & (F.size("hits") > 0)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return [
        total(kept.cast("int")).alias("kept_reads"),
        total(F.when(kept, F.size("hits"))).alias("kept_hits"),
        total((~kept).cast("int")).alias("removed_reads"),
        total(F.when(usable, F.size("parsed") - F.size("hits"))).alias("removed_hits"),
    ]


def filter_counters(filtered: DataFrame) -> DataFrame:
    """The :func:`counters` as a row."""
    return filtered.agg(*counters())
