"""The operators on the TPC-H-like tables, which stand for hits, map tables, annotations and reports; with DuckDB SQL for each.

lineitem -> hits, part -> map table and contigs, orders -> coding sequences and proteins, nation and region -> taxonomy,
supplier -> taxa, documents -> contigs, benchmark -> reads, events -> JSON reports.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaspark.functions import attribute, attributes, record_bytes, render_line, safe_header, wrap
from taxaspark.operators import annotate as A
from taxaspark.operators import filters, intervals, merge, numbering, reads, refbuild, seeds
from taxaspark.sources.assignments import parse_assignments
from taxaspark.sources.gff import parse_gff
from taxaspark.sources.mapping import last_by
from taxaspark.sources.report import assembly_of, first_place_last_value, taxid_of
from taxaspark.storage import materialize

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _ORACLE[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- what stands for what: the same rules in both engines ---------------------------------------------------------------

HITS = """
  SELECT concat('r:', l_orderkey) AS read_id, CAST(l_suppkey AS BIGINT) AS taxid, CAST(l_partkey AS VARCHAR(20)) AS seqid,
         CAST(l_quantity AS BIGINT) * 18 AS pos, CAST(l_linenumber AS BIGINT) AS edit
  FROM lineitem
"""
MAP = """
  SELECT CAST(p_partkey AS VARCHAR(20)) AS seqid, p_brand AS assembly, concat('NC_', p_size % 10) AS accession, p_name AS description
  FROM part WHERE p_partkey % 10 <> 0
"""
CDS = """
  SELECT concat('Brand#', o_custkey % 25 + 1) AS assembly, concat('NC_', o_orderkey % 10) AS contig, CAST(1 + o_orderkey % 900 AS BIGINT) AS st,
         CAST(1 + o_orderkey % 900 + o_custkey % 20 AS BIGINT) AS en, concat('g', o_orderkey % 700) AS cds_id, o_orderpriority AS product
  FROM orders
"""
#: A hit as text, and the lines of reads; malformed ones by part number.
RAW = "concat(taxid, '-', seqid, '-', pos, '=', edit)"
ODD = """
  SELECT concat('read:', p_partkey, ':', p_partkey, '-s', p_size, '-', p_size, '=', p_size % 5, ',',
         CASE p_size % 9 WHEN 0 THEN '1-a-b-10=2' WHEN 1 THEN 'nope' WHEN 2 THEN '1-x=2=3' WHEN 3 THEN '7=-1' WHEN 4 THEN '1_0=2'
              WHEN 5 THEN '=3' WHEN 6 THEN '12=' WHEN 7 THEN '+5=4' ELSE '8=0' END, ',,', p_size, '=', p_size % 3) AS value
  FROM part
"""


def _sql(spark: SparkSession, sf_dir: str, text: str, *names: str) -> DataFrame:
    """A statement both engines read, over named tables, without views in the session's catalog."""
    text = text.replace("{", "{{").replace("}", "}}")
    for n in names:
        text = text.replace(f"FROM {n}", f"FROM {{{n}}}")
    return spark.sql(text, **{n: _table(spark, sf_dir, n) for n in names})


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """at orders hits by all that they are, as order and line number aren't unique."""
    rows = _sql(spark, sf_dir, HITS, "lineitem")
    return rows.withColumn("at", F.struct("read_id", "edit", "seqid", "pos", "taxid")).withColumn("hit_idx", F.lit(0))


def _mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sql(spark, sf_dir, MAP, "part")
    return rows.select(F.struct("seqid").alias("at"), "seqid", "assembly", F.col("accession").alias("header"), "description", F.concat(F.lit("/"), "assembly").alias("gff"))


def _cds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, CDS, "orders").select("assembly", "contig", F.col("st").alias("start"), F.col("en").alias("end"), "cds_id", "product")


def _reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """at, read_id, tokens: the hits of each order."""
    raw = F.concat_ws("", F.col("taxid").cast("string"), F.lit("-"), "seqid", F.lit("-"), F.col("pos").cast("string"), F.lit("="), F.col("edit").cast("string"))
    rows = _hits(spark, sf_dir).groupBy("read_id").agg(F.array_sort(F.collect_list(raw)).alias("tokens"))
    return rows.select(F.struct("read_id").alias("at"), "read_id", "tokens")


def _taxa(spark: SparkSession, sf_dir: str, regions: str) -> DataFrame:
    return _sql(spark, sf_dir, f"SELECT CAST(s_suppkey AS BIGINT) AS taxid FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey IN ({regions}))", "supplier", "nation")


INCLUDE = "taxid IN (SELECT s_suppkey FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey IN (0, 1, 2)))"
EXCLUDE = "taxid NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey IN (2, 3)))"


# -- parsing ----------------------------------------------------------------------------------------------------------


@query(f"""
WITH h AS ({HITS}), lines AS (SELECT concat(read_id, ':', string_agg({RAW}, ',' ORDER BY {RAW})) AS value FROM h GROUP BY read_id),
t AS (SELECT regexp_extract(value, '^(.*):[^:]*$', 1) AS read_id, unnest(string_split(regexp_extract(value, ':([^:]*)$', 1), ',')) AS raw FROM lines)
SELECT read_id, CAST(regexp_extract(raw, '^([0-9]+)-', 1) AS BIGINT) AS taxid, regexp_extract(raw, '^[0-9]+-([^-]+)-', 1) AS seqid,
       CAST(regexp_extract(raw, '-([0-9]+)=', 1) AS BIGINT) AS pos, CAST(regexp_extract(raw, '=([0-9]+)$', 1) AS BIGINT) AS edit
FROM t
""")
def parse_lines_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _reads(spark, sf_dir).select("at", render_line(F.col("read_id"), F.col("tokens")).alias("value"))
    return merge.strict_hits(parse_assignments(lines)).select("read_id", "taxid", "seqid", "pos", "edit")


_TOKENS = f"""
WITH o AS ({ODD}), s AS (SELECT regexp_extract(value, '^(.*):[^:]*$', 1) AS read_id, string_split(regexp_extract(value, ':([^:]*)$', 1), ',') AS parts FROM o),
t AS (SELECT read_id, unnest(list_filter(parts, lambda x: x <> '')) AS raw FROM s)
"""


def _odd_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_assignments(_sql(spark, sf_dir, ODD, "part").select(F.struct("value").alias("at"), "value"))


@query(_TOKENS + r"""
SELECT read_id, raw, CAST(replace(split_part(raw, '-', 1), '_', '') AS BIGINT) AS taxid, edit FROM (
  SELECT read_id, raw, CAST(regexp_extract(raw, '=([+-]?[0-9]+)$', 1) AS BIGINT) AS edit, regexp_extract(raw, '^(.*)=', 1) AS l
  FROM t WHERE regexp_matches(raw, '=[+-]?[0-9]+$')
) WHERE regexp_matches(split_part(l, '-', 1), '^[+-]?[0-9]+(_[0-9]+)*$') AND taxid IS NOT NULL
""".replace("split_part(raw, '-', 1), '_'", "split_part(l, '-', 1), '_'"))
def parse_lines_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.parse_lenient(_odd_reads(spark, sf_dir)).select("read_id", F.explode("hits").alias("h")).select("read_id", "h.raw", "h.taxid", "h.edit")


@query(_TOKENS + r"SELECT read_id, raw FROM t WHERE NOT regexp_matches(raw, '^([0-9]+-[^-]+-[0-9]+|[0-9]+)=[0-9]+$')")
def malformed_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.malformed_hits(_odd_reads(spark, sf_dir)).select("read_id", "raw")


# -- filters ----------------------------------------------------------------------------------------------------------


def _exploded(filtered: DataFrame) -> DataFrame:
    return filtered.select("read_id", F.explode("hits").alias("h")).select("read_id", "h.raw")


def _filter_sql(where: str, delta: int, ending: str = "SELECT read_id, raw FROM k") -> str:
    return f"""
WITH h AS ({HITS}), f AS (SELECT read_id, {RAW} AS raw, edit, min(edit) OVER (PARTITION BY read_id) AS best FROM h WHERE {where}),
k AS (SELECT read_id, raw FROM f WHERE edit <= best + {delta}) {ending}
"""


@query(_filter_sql("true", 1))
def edit_delta_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exploded(filters.filter_hits(_reads(spark, sf_dir), delta=1))


@query(_filter_sql(INCLUDE, 10_000))
def taxa_include(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exploded(filters.filter_hits(_reads(spark, sf_dir), include=_taxa(spark, sf_dir, "0, 1, 2"), delta=10_000))


@query(_filter_sql(EXCLUDE, 10_000))
def taxa_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exploded(filters.filter_hits(_reads(spark, sf_dir), exclude=_taxa(spark, sf_dir, "2, 3"), delta=10_000))


@query(_filter_sql(f"{INCLUDE} AND {EXCLUDE}", 0))
def include_then_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exploded(filters.filter_hits(_reads(spark, sf_dir), include=_taxa(spark, sf_dir, "0, 1, 2"), exclude=_taxa(spark, sf_dir, "2, 3")))


@query(_filter_sql("false", 0))
def include_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = spark.createDataFrame([], "taxid bigint")
    return _exploded(filters.filter_hits(_reads(spark, sf_dir), include=none))


@query(_filter_sql(INCLUDE, 0, "SELECT concat(read_id, ':', string_agg(raw, ',' ORDER BY raw)) AS line FROM k GROUP BY read_id"))
def filtered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.kept_lines(filters.filter_hits(_reads(spark, sf_dir), include=_taxa(spark, sf_dir, "0, 1, 2"))).select(F.col("value").alias("line"))


@query(f"""
WITH h AS ({HITS}), f AS (SELECT read_id, edit, {INCLUDE} AS ok, min(CASE WHEN {INCLUDE} THEN edit END) OVER (PARTITION BY read_id) AS best FROM h),
r AS (SELECT read_id, count(*) AS n, count(*) FILTER (ok AND edit <= best) AS k FROM f GROUP BY read_id)
SELECT CAST(count(*) FILTER (k > 0) AS BIGINT) AS kept_reads, CAST(coalesce(sum(k), 0) AS BIGINT) AS kept_hits,
       CAST(count(*) FILTER (k = 0) AS BIGINT) AS removed_reads, CAST(coalesce(sum(n - k), 0) AS BIGINT) AS removed_hits FROM r
""")
def filter_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.filter_counters(filters.filter_hits(_reads(spark, sf_dir), include=_taxa(spark, sf_dir, "0, 1, 2")))


# -- merge and extract ---------------------------------------------------------------------------------------------------


def _merge_sql(keys: str, ending: str) -> str:
    return f"""
WITH h AS ({HITS}), r AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY edit, seqid, pos) AS k FROM h),
b AS (SELECT read_id, taxid, seqid, pos, edit FROM r WHERE k = 1) {ending}
"""


@query(_merge_sql("read_id, taxid", "SELECT * FROM b"))
def merge_taxid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.best_hits(_hits(spark, sf_dir))


@query(_merge_sql("read_id, taxid, seqid", "SELECT * FROM b"))
def merge_taxid_gi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.best_hits(_hits(spark, sf_dir), "taxid-gi")


@query(_merge_sql("read_id, taxid", f"SELECT read_id, concat(read_id, ':', string_agg({RAW}, ',' ORDER BY edit, taxid, seqid, pos)) AS value FROM b GROUP BY read_id"))
def assignment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.render_hits(merge.best_hits(_hits(spark, sf_dir)))


@query(
    _merge_sql(
        "read_id, taxid",
        """, t AS (SELECT *, count(*) OVER (PARTITION BY read_id) AS taxa FROM b)
SELECT taxid, count(*) AS reads, CAST(count(*) FILTER (taxa = 1) AS BIGINT) AS unique_reads, count(*) AS hits, min(edit) AS min_edit, CAST(sum(edit) AS BIGINT) AS sum_edit FROM t GROUP BY taxid""",
    )
)
def taxon_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.taxon_report(merge.best_hits(_hits(spark, sf_dir)))


def _orders_as_reads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    customers = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("description"))
    return customers, _table(spark, sf_dir, "orders").where("o_custkey % 3 <> 0").select(F.col("o_custkey").alias("read_id"))


@query("SELECT c_custkey AS id, c_name AS description FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_custkey % 3 <> 0)")
def extract_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.split_reads(*_orders_as_reads(spark, sf_dir))[0]


@query("SELECT c_custkey AS id, c_name AS description FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_custkey % 3 <> 0)")
def extract_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.split_reads(*_orders_as_reads(spark, sf_dir))[1]


# -- annotation -------------------------------------------------------------------------------------------------------------

_RESOLVED = f"""
h AS ({HITS}), m AS ({MAP}), r AS MATERIALIZED (
  SELECT h.*, coalesce(m.assembly, '') AS assembly, coalesce(m.accession, '') AS accession, coalesce(m.description, '') AS description
  FROM h LEFT JOIN m ON h.seqid = m.seqid
)"""
_FOUND = """
p AS (SELECT DISTINCT assembly, accession, pos FROM r WHERE assembly <> '' AND accession <> '' AND pos > 0),
e AS (SELECT p.*, c.cds_id, c.product, c.st, c.en FROM p JOIN c ON p.assembly = c.assembly AND p.accession = c.contig AND p.pos BETWEEN c.st AND c.en)"""
_FUZZY = _FOUND + """,
z AS (
  SELECT * FROM e UNION ALL
  SELECT p.*, c.cds_id, c.product, c.st, c.en FROM p JOIN c ON p.assembly = c.assembly AND p.accession = c.contig AND c.st <= p.pos + 5 AND c.en >= greatest(1, p.pos - 5)
  WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.assembly = p.assembly AND e.accession = p.accession AND e.pos = p.pos)
)"""
_ONE = """
d AS (SELECT *, row_number() OVER (PARTITION BY assembly, accession, pos, cds_id ORDER BY st, en, product) AS k FROM {})"""


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.resolve(_hits(spark, sf_dir), _mapping(spark, sf_dir))


def _taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("taxid"), F.col("n_name").alias("name"))


@query(f"""
WITH {_RESOLVED}
SELECT read_id AS "ReadID", taxid AS "Taxid", coalesce(n_name, '') AS "Organism Name", assembly AS "Assembly", accession AS "Accession",
       description AS "Description", pos AS "Position", edit AS "Edit Distance"
FROM r LEFT JOIN nation ON taxid = n_nationkey AND taxid > 0
""")
def annotate_taxa_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.annotated_table(A.name_organisms(_resolved(spark, sf_dir), _taxonomy(spark, sf_dir)))


@query(f"WITH {_RESOLVED}, c AS ({CDS}), {_FOUND} SELECT assembly, accession, pos, cds_id, product, st AS \"start\", en AS \"end\" FROM e")
def cds_annotate_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = _resolved(spark, sf_dir).where("assembly <> '' and pos > 0").select("assembly", "accession", "pos").distinct()
    found = intervals.intervals_at(places, _cds(spark, sf_dir).withColumnRenamed("contig", "accession"), ["assembly", "accession"])
    return found.select("assembly", "accession", "pos", "cds_id", "product", "start", "end")


@query(f"WITH {_RESOLVED}, c AS ({CDS}), {_FUZZY} SELECT assembly, accession, pos, cds_id, product, st AS \"start\", en AS \"end\" FROM z")
def cds_annotate_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = _resolved(spark, sf_dir).where("assembly <> '' and pos > 0").select("assembly", "accession", "pos").distinct()
    found = intervals.intervals_at(places, _cds(spark, sf_dir).withColumnRenamed("contig", "accession"), ["assembly", "accession"], fuzzy=5)
    return found.select("assembly", "accession", "pos", "cds_id", "product", "start", "end")


@query(f"""
WITH {_RESOLVED}, c AS ({CDS}), {_FUZZY}, {_ONE.format('z')}
SELECT assembly, accession, pos, cds_id, product, CAST(row_number() OVER (PARTITION BY assembly, accession, pos ORDER BY st, en, cds_id, product) AS INTEGER) AS cds_ord
FROM d WHERE k = 1
""")
def cds_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.cds_at(_resolved(spark, sf_dir), _cds(spark, sf_dir), fuzzy=5)


#: Proteins: of two thirds of the coding sequences' ids, with 200 sequences among them.
PROTEINS = """
  SELECT DISTINCT concat('Brand#', o_custkey % 25 + 1) AS assembly, concat('g', o_orderkey % 700) AS id FROM orders WHERE o_orderkey % 3 <> 0
"""


def _proteins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sql(spark, sf_dir, PROTEINS, "orders")
    seq = F.md5(F.pmod(F.ascii(F.substring("id", -1, 1)) * 37 + F.length("id") * 5 + F.ascii(F.substring("assembly", -1, 1)), F.lit(200)).cast("string"))
    return rows.select("assembly", "id", F.struct("id").alias("at"), F.concat("assembly", F.lit(" "), "id").alias("description"), seq.alias("seq"))


_PROTEIN_SEQ = "md5(CAST((ascii(right(id, 1)) * 37 + length(id) * 5 + ascii(right(assembly, 1))) % 200 AS VARCHAR))"
_ANNOTATED = f"""
{_RESOLVED}, c AS ({CDS}), {_FOUND}, {_ONE.format('e')},
o AS (SELECT *, row_number() OVER (PARTITION BY assembly, accession, pos ORDER BY st, en, cds_id, product) AS cds_ord FROM d WHERE k = 1),
a AS (SELECT r.*, coalesce(o.cds_id, 'NA') AS cds_id, coalesce(o.product, 'NA') AS product, coalesce(o.cds_ord, 0) AS cds_ord
      FROM r LEFT JOIN o ON r.assembly = o.assembly AND r.accession = o.accession AND r.pos = o.pos),
n AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY assembly, accession, pos, read_id, edit, seqid, pos, taxid, cds_ord) AS line FROM a),
s AS (SELECT assembly, id AS cds_id, concat(assembly, ' ', id) AS header, {_PROTEIN_SEQ} AS seq FROM ({PROTEINS})),
f AS (SELECT seq, min(line) AS line, arg_min(header, line) AS header FROM n JOIN s USING (assembly, cds_id) GROUP BY seq),
i AS (SELECT seq, header, row_number() OVER (ORDER BY line) AS protein_id FROM f)"""


def _annotated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The coding sequences at the hits' places, with their proteins' ids, and the proteins."""
    places = materialize(A.first_hits(_resolved(spark, sf_dir)), "places")
    found = materialize(intervals.cds_at(places, _cds(spark, sf_dir)), "cds")
    return A.number_proteins(found, places, _proteins(spark, sf_dir))


@query(f"""
WITH {_ANNOTATED}
SELECT read_id AS "ReadID", taxid AS "Taxid", coalesce(n_name, '') AS "Organism Name", n.assembly AS "Assembly", accession AS "Accession", description AS "Description",
       pos AS "Position", edit AS "Edit Distance", n.cds_id AS "CDS ID", coalesce(CAST(protein_id AS VARCHAR), 'NA') AS "Protein ID", product AS "Annotation"
FROM n LEFT JOIN s ON n.assembly = s.assembly AND n.cds_id = s.cds_id LEFT JOIN i ON s.seq = i.seq LEFT JOIN nation ON taxid = n_nationkey AND taxid > 0
""")
def annotate_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = _annotated(spark, sf_dir)
    return A.annotated_table(A.name_organisms(_resolved(spark, sf_dir), _taxonomy(spark, sf_dir)), found)


_KEY = ["read_id", "taxid", "seqid", "pos", "edit"]


@query(f"WITH {_RESOLVED}, c AS ({CDS}), {_FOUND}, {_ONE.format('e')}, o AS (SELECT * FROM d WHERE k = 1) SELECT read_id, taxid, seqid, r.pos, edit, coalesce(cds_id, 'NA') AS cds_id, coalesce(product, 'NA') AS product FROM r LEFT JOIN o ON r.assembly = o.assembly AND r.accession = o.accession AND r.pos = o.pos")
def annotate_cds_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the annotated table the columns of coding sequences, with the hit as key."""
    return A.add_cds(_resolved(spark, sf_dir), _cds(spark, sf_dir)).select(*_KEY, "cds_id", "product")


@query(f"WITH {_ANNOTATED} SELECT read_id, taxid, seqid, pos, edit, n.cds_id, coalesce(CAST(protein_id AS VARCHAR), 'NA') AS protein_id FROM n LEFT JOIN s ON n.assembly = s.assembly AND n.cds_id = s.cds_id LEFT JOIN i ON s.seq = i.seq")
def annotate_protein_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the annotated table the column of proteins, with hit and coding sequence as key."""
    return A.with_cds(_resolved(spark, sf_dir), _annotated(spark, sf_dir)[0]).select(*_KEY, "cds_id", "protein_id")


_SIGNED = HITS.replace("CAST(l_quantity AS BIGINT) * 18 AS pos", "CAST(l_quantity AS BIGINT) * 18 - 450 AS pos")


@query(f"WITH {_RESOLVED.replace(HITS, _SIGNED)}, c AS ({CDS}), {_FUZZY}, {_ONE.format('z')} SELECT read_id, taxid, seqid, r.pos, edit, coalesce(d.cds_id, 'NA') AS cds_id FROM r LEFT JOIN d ON d.k = 1 AND r.assembly = d.assembly AND r.accession = d.accession AND r.pos = d.pos")
def cds_of_signed_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the positions are 0 or below: they have no coding sequence, also within a fuzzy distance of one."""
    hits = _hits(spark, sf_dir).withColumn("pos", F.col("pos") - 450)
    return A.add_cds(A.resolve(hits, _mapping(spark, sf_dir)), _cds(spark, sf_dir), 5).select(*_KEY, "cds_id")


@query(f"WITH {_ANNOTATED} SELECT protein_id, header, seq FROM i")
def protein_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _annotated(spark, sf_dir)[1]


@query("""
SELECT c_custkey, concat('>', c_custkey, ' ', trim(replace(c_name, chr(10), ' ')), chr(10),
       regexp_replace(regexp_replace(repeat(c_name, c_custkey % 9 + 1), '(.{60})', '\\1' || chr(10), 'g'), chr(10) || '$', '')) AS record
FROM customer
""".replace("\\\\1", "\\1"))
def protein_fasta_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "customer")
    seq = F.expr("repeat(c_name, int(c_custkey % 9 + 1))")
    return rows.select("c_custkey", F.concat(F.lit(">"), F.col("c_custkey").cast("string"), F.lit(" "), safe_header(F.col("c_name")), F.lit("\n"), wrap(seq)).alias("record"))


@query("SELECT c_custkey, trim(replace(concat(' ', replace(c_name, '#', chr(10)), chr(10), c_custkey % 7, ' '), chr(10), ' ')) AS header FROM customer")
def protein_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers with line ends and spaces at their ends."""
    rows = _sql(spark, sf_dir, "SELECT c_custkey, concat(' ', replace(c_name, '#', chr(10)), chr(10), c_custkey % 7, ' ') AS header FROM customer", "customer")
    return rows.select("c_custkey", safe_header(F.col("header")).alias("header"))


# -- map tables and reports ---------------------------------------------------------------------------------------------------


@query("SELECT p_brand AS assembly, arg_max(p_name, p_partkey) AS description FROM part GROUP BY p_brand")
def map_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "part").select(F.struct("p_partkey").alias("at"), F.col("p_brand").alias("assembly"), F.col("p_name").alias("description"))
    return last_by(rows, "assembly")


@query(f"WITH m AS ({MAP}) SELECT assembly, concat('/', assembly) AS gff, arg_max(accession, seqid) AS header FROM m GROUP BY assembly")
def assembly_resource(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_by(_mapping(spark, sf_dir), "assembly").select("assembly", "gff", "header")


@query("""
SELECT p_brand AS assembly, min(p_partkey) AS first_part, arg_max(CAST(p_size AS BIGINT), p_partkey) AS taxid FROM part GROUP BY p_brand
""")
def report_first_place_last_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir).select("assembly", F.col("ordinal.p_partkey").alias("first_part"), "taxid")


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "part").select(F.struct("p_partkey").alias("at"), F.col("p_brand").alias("assembly"), F.col("p_size").cast("bigint").alias("taxid"))
    return first_place_last_value(rows)


_JSON = """concat('{', CASE user_id % 4 WHEN 0 THEN '"assembly_accession":"A' WHEN 1 THEN '"accession":"' ELSE '"assembly":{"assemblyAccession":"B' END, user_id,
  CASE user_id % 4 WHEN 0 THEN '","tax_id":7' WHEN 1 THEN '","organism":{"taxid":"9' WHEN 2 THEN '","organism":{"organism_taxid":"x' ELSE '","organism":{"tax_id":"3' END, event_id,
  CASE user_id % 4 WHEN 0 THEN '}' WHEN 1 THEN '"}}' ELSE '"}}}' END)"""


@query(f"""
WITH j AS (SELECT event_id, {_JSON} AS o FROM events),
f AS (SELECT event_id, coalesce(json_extract_string(o, '$.assembly_accession'), json_extract_string(o, '$.accession'), json_extract_string(o, '$.assembly.assemblyAccession')) AS assembly,
  coalesce(json_extract_string(o, '$.tax_id'), json_extract_string(o, '$.assembly.organism.tax_id'), json_extract_string(o, '$.assembly.organism.organism_taxid'), json_extract_string(o, '$.organism.taxid')) AS t FROM j)
SELECT event_id, assembly, CASE WHEN regexp_matches(t, '^[0-9]+$') THEN CAST(t AS BIGINT) END AS taxid FROM f
""")
def report_json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sql(spark, sf_dir, f"SELECT event_id, {_JSON} AS o FROM events", "events").withColumn("o", F.parse_json("o"))
    return rows.select("event_id", assembly_of(F.col("o")).alias("assembly"), taxid_of(F.col("o")).alias("taxid"))


_ATTRS = "concat('ID=cds-', o_orderkey, '; Note=a=b', CASE o_custkey % 3 WHEN 0 THEN ';product=' WHEN 1 THEN concat(';product=', o_orderpriority) ELSE '' END, ';Note=', o_custkey, ';flag;protein_id=p', o_custkey)"


@query(f"""
WITH g AS (SELECT o_orderkey, {_ATTRS} AS attrs FROM orders)
SELECT o_orderkey, regexp_extract(attrs, '^ID=([^;]*)', 1) AS id, regexp_extract(attrs, '.*;Note=([^;]*)', 1) AS note, nullif(regexp_extract(concat(attrs, ';'), 'product=([^;]+);', 1), '') AS product,
       CAST(3 + CAST(contains(attrs, 'product=') AS INTEGER) AS INTEGER) AS n_attributes FROM g
""")
def gff_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sql(spark, sf_dir, f"SELECT o_orderkey, {_ATTRS} AS attrs FROM orders", "orders")
    a = F.col("attrs")
    return rows.select("o_orderkey", attribute(a, "ID").alias("id"), attributes(a)["Note"].alias("note"), F.nullif(attribute(a, "product"), F.lit("")).alias("product"), F.size(attributes(a)).alias("n_attributes"))


_GFF = f"concat_ws(chr(9), concat('NC_', o_orderkey % 10), 'src', CASE o_orderkey % 4 WHEN 0 THEN 'gene' ELSE 'CDS' END, CASE o_orderkey % 11 WHEN 0 THEN 'x' ELSE CAST(o_orderkey AS VARCHAR(20)) END, o_orderkey + o_custkey, '.', '+', '0', {_ATTRS})"


@query(f"""
WITH g AS (SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderkey % 4 <> 0 AND o_orderkey % 11 <> 0)
SELECT concat('NC_', o_orderkey % 10) AS contig, CAST(o_orderkey AS BIGINT) AS "start", CAST(o_orderkey + o_custkey AS BIGINT) AS "end", CAST(o_orderkey AS VARCHAR) AS cds_id,
       CASE o_custkey % 3 WHEN 1 THEN o_orderpriority ELSE 'NA' END AS product FROM g
""")
def gff_cds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_gff(_sql(spark, sf_dir, f"SELECT {_GFF} AS value FROM orders", "orders"))


# -- reference building ----------------------------------------------------------------------------------------------------------


def _contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as contigs, brands as assemblies."""
    return _table(spark, sf_dir, "part").select(F.col("p_brand").alias("assembly"), F.struct("p_partkey").alias("at"), F.col("p_name").alias("id"), F.col("p_name").alias("description"), F.expr("repeat(p_name, int(p_size))").alias("seq"))


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refbuild.with_header(refbuild.key_contigs(_contigs(spark, sf_dir), _report(spark, sf_dir)))


_KEYED = """
g AS (SELECT p_brand AS assembly, min(p_partkey) AS ordinal, arg_max(CAST(p_size AS BIGINT), p_partkey) AS taxid FROM part GROUP BY p_brand),
k AS (SELECT row_number() OVER (ORDER BY ordinal, p_partkey) AS seqid, assembly, taxid, p_partkey, length(p_name) * p_size AS n, ordinal FROM part JOIN g ON assembly = p_brand)"""


@query(f"WITH {_KEYED} SELECT seqid, assembly, taxid, p_partkey FROM k")
def global_seq_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed(spark, sf_dir).select("seqid", "assembly", "taxid", F.col("at.p_partkey").alias("p_partkey"))


@query(f"WITH {_KEYED} SELECT seqid, concat('>', seqid, '-', taxid) AS fasta_header, CAST(length(concat('>', seqid, '-', taxid)) + 1 + n + ceil(n / 60.0) AS BIGINT) AS n_bytes FROM k")
def fasta_wrap_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed(spark, sf_dir).select("seqid", "fasta_header", "n_bytes")


@query("""
WITH RECURSIVE d AS (
  SELECT row_number() OVER (ORDER BY doc_id) AS seqid, CAST(length('>x') + 1 + n_chars + ceil(n_chars / 60.0) AS BIGINT) AS n FROM documents
), f AS (
  SELECT seqid, 0 AS chunk, n AS filled FROM d WHERE seqid = 1
  UNION ALL
  SELECT d.seqid, CASE WHEN filled > 0 AND filled + n > 20000 THEN chunk + 1 ELSE chunk END, CASE WHEN filled > 0 AND filled + n > 20000 THEN n ELSE filled + n END
  FROM f JOIN d ON d.seqid = f.seqid + 1
)
SELECT seqid, CAST(chunk AS BIGINT) AS chunk FROM f
""")
def chunk_next_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = numbering.dense_ids(_table(spark, sf_dir, "documents").select("doc_id", "n_chars"), ["doc_id"], "seqid")
    return refbuild.next_fit(docs.select("seqid", record_bytes(F.lit(">x"), F.col("n_chars")).alias("n_bytes")), 20_000)


@query(f"WITH {_KEYED} SELECT taxid, count(DISTINCT assembly) AS assemblies FROM k GROUP BY taxid")
def assemblies_per_taxid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refbuild.assemblies_per_taxid(_keyed(spark, sf_dir))


@query(f"""
WITH {_KEYED} SELECT 'assemblies' AS metric, count(DISTINCT assembly) AS value FROM k UNION ALL SELECT 'sequences', count(*) FROM k
UNION ALL SELECT 'taxa', count(DISTINCT taxid) FROM g
""")
def ref_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = _report(spark, sf_dir)
    return refbuild.summary(report, report, _keyed(spark, sf_dir))


# -- mapping ---------------------------------------------------------------------------------------------------------------------


def _references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as references: what is aligned here is text."""
    return _table(spark, sf_dir, "documents").where("text is not null").select(F.col("doc_id").cast("string").alias("seqid"), F.pmod("doc_id", F.lit(97)).cast("bigint").alias("taxid"), F.col("text").alias("seq"))


@query("""
WITH u AS (SELECT item_id, translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') AS t FROM benchmark),
k AS (SELECT item_id, t, unnest(range(0, length(t) - 17)) AS pos FROM u)
SELECT CAST(item_id AS VARCHAR) AS seqid, pos, substr(t, pos + 1, 18) AS seed FROM k
""")
def index_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = _table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("seqid"), F.col("item_id").alias("taxid"), F.col("text").alias("seq"))
    return seeds.build_index(refs, unknown=None).select("seqid", "pos", "seed")


def _assign_sql(reads: str, refs: str, rate: float = 0.13, max_hits: int = 2000, tune: int = 200) -> str:
    """Assignments with edits: ``reads`` has read_id and seq, ``refs`` seqid, taxid and t, in upper case.

    Seeds are found text by text, and each candidate's window is aligned by a table of distances, one anti-diagonal a step. A cell
    is its distance times a million less the start of its part, so that the least cell has the least distance and the last start.
    """
    return f"""
WITH RECURSIVE b AS ({reads}), d AS ({refs}),
q AS MATERIALIZED (
  SELECT read_id, '+' AS strand, seq, length(seq) AS m FROM b UNION ALL SELECT read_id, '-', reverse(translate(seq, 'ACGTU', 'TGCAA')), length(seq) FROM b
), s AS MATERIALIZED (
  SELECT read_id, strand, m, k AS off, substr(seq, k + 1, 18) AS seed FROM (SELECT *, unnest(range(0, m - 17, 15)) AS k FROM q WHERE m >= 18)
), e AS MATERIALIZED (
  SELECT seed, seqid, t FROM (SELECT DISTINCT seed FROM s) JOIN d ON contains(t, seed)
), o AS (
  SELECT seed, seqid, CAST(strpos(t, seed) AS BIGINT) AS pos, substr(t, strpos(t, seed) + 1) AS rest FROM e
  UNION ALL
  SELECT seed, seqid, pos + strpos(rest, seed), substr(rest, strpos(rest, seed) + 1) FROM o WHERE strpos(rest, seed) > 0
), f AS (
  SELECT seed, count(*) AS places FROM o GROUP BY seed HAVING count(*) <= {max_hits}
), h AS (
  SELECT read_id, strand, m, off, seqid, pos - 1 - off AS start, greatest(CAST(floor(m * CAST({rate} AS DOUBLE)) AS BIGINT), 1) AS slack
  FROM s JOIN f USING (seed) JOIN o USING (seed) WHERE NOT (places > {tune} AND off // 15 % 2 = 1)
), g AS (
  SELECT read_id, strand, m, seqid, floor(start / CAST(slack AS DOUBLE)) + x AS diagonal, min(start) AS low, max(start) AS high
  FROM h, (SELECT unnest(range(2)) AS x) GROUP BY ALL
), w AS MATERIALIZED (
  SELECT row_number() OVER () AS pair, * FROM (
    SELECT DISTINCT g.read_id, seqid, taxid, q.seq, greatest(low - sl, 0) AS first, substr(t, greatest(low - sl, 0) + 1, high + g.m + sl - greatest(low - sl, 0)) AS win, sl
    FROM (SELECT *, CAST(floor(m * CAST({rate} AS DOUBLE)) AS BIGINT) AS sl FROM g) g JOIN q USING (read_id, strand) JOIN d USING (seqid))
), l AS MATERIALIZED (
  SELECT pair, length(seq) AS m, list_transform(range(1, length(seq) + 1), lambda i: substr(seq, i, 1)) AS r, list_transform(range(1, length(win) + 1), lambda i: substr(win, i, 1)) AS t FROM w
), c AS (
  SELECT pair, m, len(t) AS n, r, t, CAST(0 AS BIGINT) AS k, list_transform(range(m + 1), lambda i: CASE WHEN i = 0 THEN CAST(0 AS BIGINT) END) AS x, list_transform(range(m + 1), lambda i: CAST(NULL AS BIGINT)) AS y FROM l
  UNION ALL
  SELECT pair, m, n, r, t, k + 1, list_transform(range(m + 1), lambda i: CASE WHEN i > k + 1 OR k + 1 - i > n THEN NULL WHEN i = 0 THEN -(k + 1) WHEN i = k + 1 THEN i * 1000000
    ELSE least(y[i] + CASE WHEN r[i] = t[k + 1 - i] THEN 0 ELSE 1000000 END, x[i + 1] + 1000000, x[i] + 1000000) END), x FROM c WHERE k < m + n
), z AS (
  SELECT pair, (v + 999999) // 1000000 AS edit, (v + 999999) // 1000000 * 1000000 - v AS start FROM (SELECT pair, k, x[m + 1] AS v FROM c WHERE k >= m)
  QUALIFY row_number() OVER (PARTITION BY pair ORDER BY edit, k) = 1
)
SELECT DISTINCT read_id, CAST(taxid AS BIGINT) AS taxid, seqid, CAST(first + start + 1 AS BIGINT) AS pos, CAST(edit AS BIGINT) AS edit FROM z JOIN w USING (pair) WHERE edit <= sl
"""


_UPPER = "translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')"


@query(_assign_sql(f"SELECT CAST(item_id AS VARCHAR) AS read_id, {_UPPER} AS seq FROM benchmark", f"SELECT CAST(doc_id AS VARCHAR) AS seqid, doc_id % 97 AS taxid, {_UPPER} AS t FROM documents WHERE text IS NOT NULL"))
def assign_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items with up to 13 % edits, both ways round, in all documents."""
    reads_ = _table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("read_id"), F.col("text").alias("seq"))
    refs = _references(spark, sf_dir)
    return seeds.assign(reads_, seeds.seeds_of(reads_, refs, unknown=None), refs)


@query(_assign_sql(f"SELECT CAST(item_id AS VARCHAR) AS read_id, {_UPPER} AS seq FROM benchmark", f"SELECT CAST(doc_id AS VARCHAR) AS seqid, doc_id % 97 AS taxid, {_UPPER} AS t FROM documents WHERE text IS NOT NULL", 0.05, 3, 1))
def assign_rare_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeds of at most three places, every second one of those with more than one place, and 5 % edits."""
    reads_ = _table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("read_id"), F.col("text").alias("seq"))
    refs = _references(spark, sf_dir)
    return seeds.assign(reads_, seeds.seeds_of(reads_, refs, unknown=None), refs, edit_rate=0.05, max_hits=3, tune_max_hits=1)


#: Items with every 40th letter left out, changed or doubled, by item.
_EDITED = "array_to_string(list_transform(range(1, length(text) + 1), lambda i: CASE WHEN i % 40 <> 20 THEN substr(text, i, 1) WHEN item_id % 3 = 0 THEN '' WHEN item_id % 3 = 1 THEN '#' ELSE concat(substr(text, i, 1), substr(text, i, 1)) END), '')"


@query(_assign_sql(f"SELECT concat('e', item_id) AS read_id, {_UPPER.replace('text', 'x')} AS seq FROM (SELECT item_id, {_EDITED} AS x FROM benchmark)", f"SELECT CAST(item_id AS VARCHAR) AS seqid, item_id % 97 AS taxid, {_UPPER} AS t FROM benchmark"))
def assign_edited_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with an edit in every 40 letters, against the items themselves."""
    items = _table(spark, sf_dir, "benchmark")
    letter = lambda i: F.substring(F.col("text"), i, F.lit(1))
    edited = F.transform(F.sequence(F.lit(1), F.length("text")), lambda i: F.when(i % 40 != 20, letter(i)).when(F.col("item_id") % 3 == 0, "").when(F.col("item_id") % 3 == 1, "#").otherwise(F.concat(letter(i), letter(i))))
    reads_ = items.select(F.concat(F.lit("e"), "item_id").alias("read_id"), F.array_join(edited, "").alias("seq"))
    refs = items.select(F.col("item_id").cast("string").alias("seqid"), F.pmod("item_id", F.lit(97)).cast("bigint").alias("taxid"), F.col("text").alias("seq"))
    return seeds.assign(reads_, seeds.build_index(refs, unknown=None), refs)


from taxaspark import file_queries  # noqa: E402, F401  adds the queries on files
