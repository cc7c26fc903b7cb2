"""The readers, sinks and whole commands on files made of the TPC-H-like tables; with DuckDB SQL on the tables for each.

Files stand in a folder of the shared storage that is deleted when the result, a table of its own, is written.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaspark import queries as Q
from taxaspark.functions import base_name
from taxaspark.operators import annotate as A
from taxaspark.operators import filters, merge, seeds
from taxaspark.operators.numbering import dense_ids
from taxaspark.plans.annotation import annotate
from taxaspark.plans.filtering import filter_file
from taxaspark.plans.mapping import assign_reads as assign_files
from taxaspark.plans.mapping import extract_reads, index_build, merge_files
from taxaspark.plans.reference import reference_build, stage_gff
from taxaspark.queries import query
from taxaspark.sinks import single_file, touch, write_table
from taxaspark.sinks.files import fasta_text, read_text
from taxaspark.sources import assembly_files, read_assignments, read_fasta, read_fastq, read_gff, read_mapping, read_report, read_taxa, read_taxonomy
from taxaspark.sources.gff import STAGED
from taxaspark.sources.lines import exists, line_numbers, read_lines
from taxaspark.sources.mapping import last_by
from taxaspark.storage import materialize, work_folder
from taxaspark.streaming import hits as streams


def _file(df: DataFrame, path: str, order: str, head: str = "", compression: str = "none") -> str:
    """The column value as lines of one file."""
    parts = f"{path}.parts"
    df.orderBy(order).select("value").write.option("compression", compression).text(parts)
    single_file(df.sparkSession, parts, path, head)
    return path


def _assignments(spark: SparkSession, sf_dir: str, path: str, where: str = "true") -> str:
    """An assignment file: a line for each order, its hits sorted as text."""
    hits = Q._hits(spark, sf_dir).where(where)
    raw = F.concat_ws("", F.col("taxid").cast("string"), F.lit("-"), "seqid", F.lit("-"), F.col("pos").cast("string"), F.lit("="), F.col("edit").cast("string"))
    lines = hits.groupBy("read_id").agg(F.array_join(F.sort_array(F.collect_list(raw)), ",").alias("hits"))
    return _file(lines.select("read_id", F.concat("read_id", F.lit(":"), "hits").alias("value")), path, "read_id")


def _numbered(lines: DataFrame, heads: bool = False) -> DataFrame:
    """line (from 1) and value, in the order of the file, or with ``heads`` of the parts of a table, whose header is one line."""
    return line_numbers(lines, heads=heads).select((F.col("n") + 1).alias("line"), F.when(F.endswith("value", F.lit("\r")), F.left("value", F.length("value") - 1)).otherwise(F.col("value")).alias("value"))


# -- map tables, reports, taxa ----------------------------------------------------------------------------------------------


def _map_file(spark: SparkSession, sf_dir: str, path: str) -> str:
    rows = Q._mapping(spark, sf_dir).withColumns({"taxid": F.lit(1), "protein_fasta": F.lit("NA")})
    write_table(rows.select("seqid", "assembly", "taxid", "header", "description", "gff", "protein_fasta"), path)
    return path


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS seqid, CASE WHEN p_partkey % 5 = 0 THEN 'late' ELSE p_brand END AS assembly, concat('NC_', p_size % 10) AS header,
       CASE WHEN p_partkey % 5 = 0 THEN concat('later, "', p_size, '"', chr(10), p_name) ELSE p_name END AS description FROM part
""")
def file_map_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tab- and a comma-separated map table: of a key in both the row of the later file counts."""
    with work_folder(spark) as folder:
        late = Q._sql(spark, sf_dir, "SELECT p_partkey, concat('NA,', p_partkey, ',late,NC_', p_size % 10, ',\"later, \"\"', p_size, '\"\"', chr(10), p_name, '\",NA') AS value FROM part WHERE p_partkey % 5 = 0", "part")
        paths = [_map_file(spark, sf_dir, f"{folder}/a.tsv"), _file(late, f"{folder}/b.csv", "p_partkey", "gff,seqid,assembly,header,description,protein_fasta\n")]
        return materialize(last_by(read_mapping(spark, paths), "seqid").select("seqid", "assembly", "header", "description"), "map")


_REPORT = "SELECT p_brand AS assembly, arg_max(CAST(p_size AS BIGINT), p_partkey) AS taxid, CAST(row_number() OVER (ORDER BY min(p_partkey)) AS INTEGER) AS place FROM part GROUP BY p_brand"


def _read_report(spark: SparkSession, sf_dir: str, name: str, line: str, head: str = "", tail: str = "", compression: str = "none") -> DataFrame:
    with work_folder(spark) as folder:
        rows = Q._sql(spark, sf_dir, f"SELECT p_partkey, {line} AS value FROM part", "part")
        if tail:
            rows = rows.unionByName(spark.createDataFrame([((1 << 31) - 1, tail)], "p_partkey int, value string"), allowMissingColumns=False)
        found = read_report(spark, _file(rows, f"{folder}/{name}", "p_partkey", head, compression))
        found = dense_ids(found, ["ordinal"], "place")
        return materialize(found.select("assembly", "taxid", F.col("place").cast("int").alias("place")), "report")


@query(_REPORT)
def file_report_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read_report(spark, sf_dir, "r.tsv", "concat_ws(chr(9), p_name, p_brand, p_size, 'x')", "name\taccession\ttaxid\tmore\n")


@query(_REPORT)
def file_report_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read_report(spark, sf_dir, "r.csv", "concat(p_size, ',\"a, b\",', p_brand)", "organism_taxid,name,assembly_accession\n")


@query(_REPORT)
def file_report_jsonl_gz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read_report(spark, sf_dir, "r.jsonl.gz", "concat('{\"assembly\":{\"accession\":\"', p_brand, '\"},\"organism\":{\"tax_id\":\"', p_size, '\"}}')", compression="gzip")


@query(_REPORT)
def file_report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document: an array over many lines."""
    return _read_report(spark, sf_dir, "r.json", "concat('{\"name\":\"a[]{,\\\\\\\"', p_name, '\", \"more\":[1,{\"x\":[', p_partkey, ',2]}],', CASE p_partkey % 3 WHEN 0 THEN chr(10) ELSE '' END, '\"accession\":\"', p_brand, '\",\"taxid\":', p_size, CASE p_partkey % 4 WHEN 0 THEN '}, {} ,' ELSE '},' END)", "[\n", "{}]")


@query("SELECT DISTINCT CAST(s_suppkey % 40 AS BIGINT) AS taxid FROM supplier WHERE s_suppkey % 7 > 2")
def file_taxa_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    with work_folder(spark) as folder:
        line = "CASE s_suppkey % 7 WHEN 0 THEN concat('# ', s_suppkey) WHEN 1 THEN '' WHEN 2 THEN concat('x', s_suppkey) ELSE concat('  ', s_suppkey % 40, chr(9), s_name) END"
        rows = Q._sql(spark, sf_dir, f"SELECT s_suppkey, {line} AS value FROM supplier", "supplier")
        return materialize(read_taxa(spark, _file(rows, f"{folder}/taxa.txt", "s_suppkey")), "taxa")


def _taxonomy_file(spark: SparkSession, sf_dir: str, path: str) -> str:
    text = "SELECT n_nationkey, explode(array(concat_ws(concat(chr(9), '|', chr(9)), n_nationkey, concat('old ', n_name), '', concat('synonym', chr(9), '|')), concat_ws(concat(chr(9), '|', chr(9)), n_nationkey, n_name, '', concat('scientific name', chr(9), '|')))) AS value FROM nation"
    return _file(Q._sql(spark, sf_dir, text, "nation"), path, "n_nationkey")


@query("SELECT CAST(n_nationkey AS BIGINT) AS taxid, n_name AS name FROM nation WHERE n_nationkey > 0 UNION ALL SELECT CAST(n_nationkey + 1000 AS BIGINT), n_name FROM nation WHERE n_nationkey > 0 AND n_nationkey % 2 = 0")
def file_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    with work_folder(spark) as folder:
        became = Q._sql(spark, sf_dir, "SELECT n_nationkey, concat(n_nationkey + 1000, chr(9), '|', chr(9), n_nationkey, chr(9), '|') AS value FROM nation WHERE n_nationkey % 2 = 0", "nation")
        found = read_taxonomy(spark, _taxonomy_file(spark, sf_dir, f"{folder}/names.dmp"), _file(became, f"{folder}/merged.dmp", "n_nationkey"))
        return materialize(found.select("taxid", "name"), "taxonomy")


# -- sequences and annotations -------------------------------------------------------------------------------------------------


def _customers(spark: SparkSession, sf_dir: str, fastq: bool = False) -> DataFrame:
    rows = Q._sql(spark, sf_dir, "SELECT c_custkey, concat('c', c_custkey, ' ', c_name) AS description, repeat(translate(c_name, ' ', '_'), CAST(c_custkey % 7 AS INT)) AS seq FROM customer", "customer")
    return rows.select("c_custkey", read_text(F.col("description"), F.col("seq"), F.expr("repeat('I', length(seq))") if fastq else F.lit(None).cast("string")).alias("value"))


_CUSTOMERS = "SELECT concat('c', c_custkey) AS id, concat('c', c_custkey, ' ', c_name) AS description, repeat(translate(c_name, ' ', '_'), c_custkey % 7) AS seq FROM customer"


@query(_CUSTOMERS)
def file_fasta(spark: SparkSession, sf_dir: str) -> DataFrame:
    with work_folder(spark) as folder:
        return materialize(read_fasta(spark, _file(_customers(spark, sf_dir), f"{folder}/a.fasta", "c_custkey")).select("id", "description", "seq"), "fasta")


@query(f"SELECT id, description, seq, repeat('I', length(seq)) AS qual FROM ({_CUSTOMERS})")
def file_fastq_gz(spark: SparkSession, sf_dir: str) -> DataFrame:
    with work_folder(spark) as folder:
        path = _file(_customers(spark, sf_dir, fastq=True), f"{folder}/a.fastq.gz", "c_custkey", compression="gzip")
        return materialize(read_fastq(spark, path).select("id", "description", "seq", "qual"), "fastq")


_GFF_SQL = """
SELECT concat('A', o_custkey % 2) AS assembly, concat('NC_', o_orderkey % 10) AS contig, CAST(o_orderkey AS BIGINT) AS "start", CAST(o_orderkey + o_custkey AS BIGINT) AS "end", CAST(o_orderkey AS VARCHAR) AS cds_id,
       CASE o_custkey % 3 WHEN 1 THEN o_orderpriority ELSE 'NA' END AS product FROM orders WHERE o_orderkey % 4 <> 0 AND o_orderkey % 11 <> 0
"""


def _gff_files(spark: SparkSession, sf_dir: str, folder: str) -> dict[str, str]:
    rows = Q._sql(spark, sf_dir, f"SELECT o_orderkey, o_custkey, {Q._GFF} AS value FROM orders", "orders")
    return {f"A{k}": _file(rows.where(F.col("o_custkey") % 2 == k), f"{folder}/{k}.gff", "o_orderkey", "##gff-version 3\n") for k in (0, 1)}


@query(_GFF_SQL)
def file_gff(spark: SparkSession, sf_dir: str) -> DataFrame:
    with work_folder(spark) as folder:
        return materialize(read_gff(spark, _gff_files(spark, sf_dir, folder)), "gff")


@query(_GFF_SQL)
def file_gff_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Through the table that a reference build stages."""
    with work_folder(spark) as folder:
        staged = stage_gff(spark, _gff_files(spark, sf_dir, folder), f"{folder}/reference.cds")
        return materialize(read_gff(spark, {"A0": staged, "A1": staged}), "gff")


@query("""
SELECT concat('A', n_nationkey) AS assembly, CASE WHEN n_nationkey % 2 = 0 THEN 'b_genomic.fna.gz' ELSE 'a_genomic.fna' END AS genome,
       CASE WHEN n_nationkey % 3 > 0 THEN 'x.gff3' END AS gff, CASE WHEN n_nationkey % 4 > 0 THEN 'p.faa' END AS protein FROM nation
""")
def file_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    with work_folder(spark) as folder:
        for r in Q._table(spark, sf_dir, "nation").select("n_nationkey").collect():  # 25 rows at any scale
            k = r[0]
            for name in ["a_genomic.fna", *["b_genomic.fna.gz"] * (k % 2 == 0), *["x.gff3"] * (k % 3 > 0), *["p.faa"] * (k % 4 > 0)]:
                touch(spark, f"{folder}/A{k}/{name}")
        found = assembly_files(spark, folder)
        return materialize(found.select("assembly", *[base_name(F.col(c)).alias(c) for c in ("genome", "gff", "protein")]), "layout")


# -- whole commands ----------------------------------------------------------------------------------------------------------------

_HEAD = "concat_ws(chr(9), 'ReadID', 'Taxid', 'Organism Name', 'Assembly', 'Accession', 'Description', 'Position', 'Edit Distance')"


@query(f"""
WITH {Q._RESOLVED}, t AS (
  SELECT row_number() OVER (ORDER BY assembly, accession, pos, read_id, {Q.RAW}) + 1 AS line,
         concat_ws(chr(9), read_id, taxid, coalesce(n_name, ''), assembly, accession, description, pos, edit) AS value
  FROM r LEFT JOIN nation ON taxid = n_nationkey AND taxid > 0)
SELECT 1 AS line, {_HEAD} AS value UNION ALL SELECT line, value FROM t
""")
def annotate_command(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the annotated file and their order."""
    with work_folder(spark) as folder:
        annotate(spark, _assignments(spark, sf_dir, f"{folder}/a.clp"), _map_file(spark, sf_dir, f"{folder}/map.tsv"), f"{folder}/out/", f"{folder}/out.faa", _taxonomy_file(spark, sf_dir, f"{folder}/names.dmp"), taxa_only=True, compression="gzip")
        return materialize(_numbered(read_lines(spark, f"{folder}/out/"), heads=True), "lines")


#: Hits without a place, of every fifth line number.
_MIXED = "CASE WHEN edit % 5 = 0 THEN concat(taxid, '=', edit) ELSE " + Q.RAW + " END"


def _gff_line() -> Column:
    return F.concat_ws("\t", "contig", F.lit("src"), F.lit("CDS"), F.col("start").cast("string"), F.col("end").cast("string"), F.lit("."), F.lit("+"), F.lit("0"), F.concat(F.lit("ID=cds-"), "cds_id", F.lit(";product="), "product"))


def _annotation_files(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """GFF and protein files of each brand; the map table that names them."""
    cds = Q._cds(spark, sf_dir)
    proteins = Q._proteins(spark, sf_dir)
    text = fasta_text(F.concat("id", F.lit(" "), "description"), F.col("seq"))
    name = lambda end: F.concat(F.lit(f"{folder}/"), F.replace("assembly", F.lit("#"), F.lit("_")), F.lit(end))
    for end, rows in (("gff", cds.select("assembly", _gff_line().alias("value"))), ("faa", proteins.select("assembly", text.alias("value")))):
        rows.withColumn("b", F.replace("assembly", F.lit("#"), F.lit("_"))).repartition("b").select("b", "value").write.partitionBy("b").text(f"{folder}/{end}.parts")
        for r in Q._mapping(spark, sf_dir).select(F.replace("assembly", F.lit("#"), F.lit("_"))).distinct().collect():  # 25 brands at any scale
            if exists(spark, f"{folder}/{end}.parts/b={r[0]}"):
                single_file(spark, f"{folder}/{end}.parts/b={r[0]}", f"{folder}/{r[0]}.{end}")
    rows = Q._mapping(spark, sf_dir).withColumns({"taxid": F.lit(1), "gff": name(".gff"), "protein_fasta": name(".faa")})
    write_table(rows.select("seqid", "assembly", "taxid", "header", "description", "gff", "protein_fasta"), f"{folder}/map.tsv")
    return f"{folder}/map.tsv"


def _annotate_whole(spark: SparkSession, sf_dir: str, folder: str) -> None:
    hits = Q._hits(spark, sf_dir)
    raw = F.when(F.col("edit") % 5 == 0, F.concat_ws("=", F.col("taxid").cast("string"), F.col("edit").cast("string"))).otherwise(F.concat_ws("", F.col("taxid").cast("string"), F.lit("-"), "seqid", F.lit("-"), F.col("pos").cast("string"), F.lit("="), F.col("edit").cast("string")))
    lines = hits.groupBy("read_id").agg(F.array_join(F.array_sort(F.collect_list(raw)), ",").alias("hits"))
    source = _file(lines.select("read_id", F.concat("read_id", F.lit(":"), "hits").alias("value")), f"{folder}/a.clp", "read_id")
    annotate(spark, source, _annotation_files(spark, sf_dir, folder), f"{folder}/out/", f"{folder}/out.faa", _taxonomy_file(spark, sf_dir, f"{folder}/names.dmp"), fuzzy=5, compression="gzip")


_WHOLE = f"""
x AS ({Q.HITS}), y AS (SELECT read_id, taxid, CASE WHEN edit % 5 = 0 THEN '' ELSE seqid END AS seqid, CASE WHEN edit % 5 = 0 THEN 0 ELSE pos END AS pos, edit, {_MIXED} AS raw FROM x),
h AS (SELECT *, row_number() OVER (PARTITION BY read_id ORDER BY raw) AS hit FROM y), m AS ({Q.MAP}), r AS MATERIALIZED (
  SELECT h.*, coalesce(m.assembly, '') AS assembly, coalesce(m.accession, '') AS accession, coalesce(m.description, '') AS description FROM h LEFT JOIN m ON h.seqid = m.seqid
), c AS ({Q.CDS}), {Q._FUZZY}, {Q._ONE.format('z')},
o AS (SELECT *, row_number() OVER (PARTITION BY assembly, accession, pos ORDER BY st, en, cds_id, product) AS cds_ord FROM d WHERE k = 1),
n AS MATERIALIZED (
  SELECT r.*, coalesce(o.cds_id, 'NA') AS cds_id, coalesce(o.product, 'NA') AS product, row_number() OVER (ORDER BY r.assembly, r.accession, r.pos, read_id, hit, coalesce(o.cds_ord, 0)) AS line
  FROM r LEFT JOIN o ON r.assembly = o.assembly AND r.accession = o.accession AND r.pos = o.pos
), s AS MATERIALIZED (SELECT assembly, id AS cds_id, concat(id, ' ', assembly, ' ', id) AS header, {Q._PROTEIN_SEQ} AS seq FROM ({Q.PROTEINS})),
f AS (SELECT seq, min(line) AS line, arg_min(header, line) AS header FROM n JOIN s USING (assembly, cds_id) GROUP BY seq),
i AS MATERIALIZED (SELECT seq, header, row_number() OVER (ORDER BY line) AS protein_id FROM f)"""


@query(f"""
WITH {_WHOLE}
SELECT 1 AS line, concat_ws(chr(9), {_HEAD}, 'CDS ID', 'Protein ID', 'Annotation') AS value UNION ALL
SELECT line + 1, concat_ws(chr(9), read_id, taxid, coalesce(n_name, ''), n.assembly, accession, description, pos, edit, n.cds_id, coalesce(CAST(protein_id AS VARCHAR), 'NA'), product)
FROM n LEFT JOIN s ON n.assembly = s.assembly AND n.cds_id = s.cds_id LEFT JOIN i ON s.seq = i.seq LEFT JOIN nation ON taxid = n_nationkey AND taxid > 0
""")
def annotate_command_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eleven columns, line by line, from GFF and protein files; hits with and without a place, and fuzzy places."""
    with work_folder(spark) as folder:
        _annotate_whole(spark, sf_dir, folder)
        return materialize(_numbered(read_lines(spark, f"{folder}/out/"), heads=True), "lines")


@query(f"WITH {_WHOLE} SELECT CAST(protein_id AS VARCHAR) AS id, concat(protein_id, ' ', header) AS description, seq FROM i")
def annotate_command_proteins(spark: SparkSession, sf_dir: str) -> DataFrame:
    with work_folder(spark) as folder:
        _annotate_whole(spark, sf_dir, folder)
        return materialize(read_fasta(spark, f"{folder}/out.faa").select("id", "description", "seq"), "proteins")


@query(f"SELECT 'table' AS file, concat_ws(chr(9), {_HEAD}, 'CDS ID', 'Protein ID', 'Annotation') AS value UNION ALL SELECT 'assignments', concat('read:', p_partkey, ':', p_name) FROM part")
def annotate_command_no_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of lines without a hit that can be read: a header alone, and proteins without a line."""
    with work_folder(spark) as folder:
        lines = Q._sql(spark, sf_dir, "SELECT p_partkey, concat('read:', p_partkey, ':', p_name) AS value FROM part", "part")
        annotate(spark, _file(lines, f"{folder}/a.clp", "p_partkey"), _map_file(spark, sf_dir, f"{folder}/map.tsv"), f"{folder}/out.tsv", f"{folder}/out.faa")
        files = [_numbered(read_lines(spark, f"{folder}/{name}")).select(F.lit(kind).alias("file"), "value") for name, kind in (("out.tsv", "table"), ("out.faa", "proteins"), ("a.clp", "assignments"))]
        return materialize(reduce(DataFrame.unionByName, files), "lines")


@query("SELECT 'table' AS file, count(*) + 1 AS lines, CAST(8 AS INTEGER) AS columns FROM lineitem UNION ALL SELECT 'assignments', count(DISTINCT l_orderkey), 1 FROM lineitem")
def annotate_command_taxa_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Taxa alone: a table of eight columns, and a file of proteins that is there and has no line, although the map table names annotations."""
    with work_folder(spark) as folder:
        annotate(spark, _assignments(spark, sf_dir, f"{folder}/a.clp"), _annotation_files(spark, sf_dir, folder), f"{folder}/out/", f"{folder}/out.faa", taxa_only=True, compression="gzip")
        files = [line_numbers(read_lines(spark, f"{folder}/{name}"), heads=kind == "table").select(F.lit(kind).alias("file"), "value") for name, kind in (("out/", "table"), ("out.faa", "proteins"), ("a.clp", "assignments"))]
        lines = reduce(DataFrame.unionByName, files)
        return materialize(lines.groupBy("file").agg(F.count("*").alias("lines"), F.max(F.size(F.split("value", "\t"))).alias("columns")), "files")


_BUILT = """
g AS (SELECT replace(p_brand, '#', '') AS assembly, min(p_partkey) AS ordinal, arg_max(CAST(p_size AS BIGINT), p_partkey) AS taxid FROM part GROUP BY ALL),
k AS (SELECT row_number() OVER (ORDER BY ordinal, p_partkey) AS seqid, assembly, taxid, p_partkey, p_name, length(p_name) * p_size AS n FROM part JOIN g ON assembly = replace(p_brand, '#', ''))"""


def _built(spark: SparkSession, sf_dir: str, folder: str, times: int = 1, index_gff: bool = False) -> str:
    """A reference of parts as contigs (``times`` as long) and brands as assemblies, with annotations if they are indexed; its directory."""
    rows = Q._sql(spark, sf_dir, "SELECT replace(p_brand, '#', '') AS assembly, p_partkey, p_name, p_size FROM part", "part")
    record = fasta_text(F.concat(F.col("p_partkey").cast("string"), F.lit(" "), "p_name"), F.expr(f"repeat(translate(p_name, ' ', '_'), int(p_size) * {times})"))
    rows.select("assembly", "p_partkey", record.alias("value")).repartition("assembly").sortWithinPartitions("assembly", "p_partkey").select("assembly", "value").write.partitionBy("assembly").text(f"{folder}/parts")
    if index_gff:
        cds = Q._cds(spark, sf_dir).select(F.replace("assembly", F.lit("#"), F.lit("")).alias("assembly"), _gff_line().alias("value"))
        cds.repartition("assembly").write.partitionBy("assembly").text(f"{folder}/gff")
    for r in rows.select("assembly").distinct().collect():  # 25 brands at any scale
        single_file(spark, f"{folder}/parts/assembly={r[0]}", f"{folder}/data/{r[0]}/x_genomic.fna")
        if index_gff and exists(spark, f"{folder}/gff/assembly={r[0]}"):
            single_file(spark, f"{folder}/gff/assembly={r[0]}", f"{folder}/data/{r[0]}/x.gff")
    report = _file(rows.select("p_partkey", F.concat_ws("\t", "assembly", F.col("p_size").cast("string")).alias("value")), f"{folder}/report.tsv", "p_partkey", "accession\ttaxid\n")
    reference_build(spark, f"{folder}/data", report, f"{folder}/out", 1, index_gff=index_gff)
    return f"{folder}/out"


@query(f"WITH {_BUILT} SELECT concat(seqid, '-', taxid) AS id, CAST(n AS INTEGER) AS n FROM k")
def reference_build_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    with work_folder(spark) as folder:
        return materialize(read_fasta(spark, f"{_built(spark, sf_dir, folder)}/reference.chunk.*.fasta").select("id", F.length("seq").alias("n")), "chunks")


@query(f"WITH {_BUILT} SELECT CAST(seqid AS VARCHAR) AS seqid, assembly, CAST(p_partkey AS VARCHAR) AS header, concat(p_partkey, ' ', p_name) AS description, 'NA' AS gff, 'NA' AS protein_fasta FROM k")
def reference_build_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    with work_folder(spark) as folder:
        return materialize(read_mapping(spark, f"{_built(spark, sf_dir, folder)}/reference.map.tsv").drop("at"), "map")


@query(f"""
WITH RECURSIVE {_BUILT}, d AS MATERIALIZED (
  SELECT seqid, concat(seqid, '-', taxid) AS id, 8 * n AS n, CAST(length(concat('>', seqid, '-', taxid)) + 1 + 8 * n + ceil(8 * n / 60.0) AS BIGINT) AS b FROM k
), f AS (
  SELECT seqid, 0 AS chunk, b AS filled FROM d WHERE seqid = 1
  UNION ALL
  SELECT d.seqid, CASE WHEN filled > 0 AND filled + b > 1048576 THEN chunk + 1 ELSE chunk END, CASE WHEN filled > 0 AND filled + b > 1048576 THEN b ELSE filled + b END
  FROM f JOIN d ON d.seqid = f.seqid + 1
), c AS (
  SELECT chunk, CAST(sum(1 + ceil(n / 60.0)) AS BIGINT) AS lines, CAST(max(least(n, 60)) AS BIGINT) AS widest, CAST(sum(b) AS BIGINT) AS n_bytes FROM d JOIN f USING (seqid) GROUP BY chunk
)
SELECT id, chunk, CAST(n AS INTEGER) AS n, lines, widest, n_bytes FROM d JOIN f USING (seqid) JOIN c USING (chunk)
""")
def reference_build_chunk_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunk file of each record; the lines of that file, its widest one of a sequence, and its size."""
    with work_folder(spark) as folder:
        pattern = f"{_built(spark, sf_dir, folder, times=8)}/reference.chunk.*.fasta"
        chunk = F.regexp_extract("at.file", r"chunk\.(\d+)\.fasta$", 1).cast("int").alias("chunk")
        line = F.length("value").cast("bigint")
        files = read_lines(spark, pattern).groupBy(chunk).agg(F.count("*").alias("lines"), F.max(F.when(~F.col("value").startswith(">"), line)).alias("widest"), F.sum(line + 1).alias("n_bytes"))
        return materialize(read_fasta(spark, pattern).select("id", chunk, F.length("seq").alias("n")).join(files, "chunk"), "chunks")


@query(f"""
WITH c AS ({Q.CDS}) SELECT replace(assembly, '#', '') AS assembly, contig, st AS "start", en AS "end", cds_id, product, true AS staged FROM c WHERE assembly IN (SELECT p_brand FROM part)
""")
def reference_build_index_gff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coding sequences as annotate reads them, from what the map table of a build with indexed annotations names."""
    with work_folder(spark) as folder:
        mapping = read_mapping(spark, f"{_built(spark, sf_dir, folder, index_gff=True)}/reference.map.tsv")
        named = {r[0]: r[1] for r in mapping.where("gff <> 'NA'").select("assembly", "gff").distinct().collect()}  # 25 brands at any scale
        staged = F.col("assembly").isin([a for a, p in named.items() if p.endswith(STAGED)])
        return materialize(read_gff(spark, named).select("assembly", "contig", "start", "end", "cds_id", "product", staged.alias("staged")), "gff")


@query(f"""
WITH {_BUILT} SELECT 'Assemblies processed' AS metric, count(DISTINCT assembly) AS value FROM k UNION ALL SELECT 'Total sequences', count(*) FROM k
UNION ALL SELECT 'Unique taxa', count(DISTINCT taxid) FROM g
""")
def reference_build_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    with work_folder(spark) as folder:
        lines = read_lines(spark, f"{_built(spark, sf_dir, folder)}/reference.summary.txt").select(F.split("value", ": ").alias("f"))
        rows = lines.where(F.get("f", F.lit(0)).isin("Assemblies processed", "Total sequences", "Unique taxa"))
        return materialize(rows.select(F.get("f", F.lit(0)).alias("metric"), F.replace(F.get("f", F.lit(1)), F.lit(","), F.lit("")).cast("bigint").alias("value")), "summary")


@query(Q.oracle_sql()["assignment_lines"].replace("SELECT read_id, concat", "SELECT concat"))
def merge_command(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files whose hits belong to the same reads."""
    with work_folder(spark) as folder:
        paths = [_assignments(spark, sf_dir, f"{folder}/{k}.clp", f"edit % 2 = {k}") for k in (0, 1)]
        merge_files(spark, paths, f"{folder}/out.clp")
        return materialize(read_lines(spark, f"{folder}/out.clp").select("value"), "lines")


@query("SELECT concat('c', c_custkey) AS id, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderkey % 3 <> 0) AS matched FROM customer")
def extract_command(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads of a FASTA file by two assignment files."""
    with work_folder(spark) as folder:
        reads = _file(_customers(spark, sf_dir), f"{folder}/reads.fasta", "c_custkey")
        lines = Q._sql(spark, sf_dir, "SELECT o_orderkey, concat('c', o_custkey, ':1=0') AS value FROM orders", "orders")
        paths = [_file(lines.where(F.col("o_orderkey") % 3 == k), f"{folder}/{k}.clp", "o_orderkey") for k in (1, 2)]
        extract_reads(spark, paths, f"{folder}/yes.fasta", f"{folder}/no.fasta", fasta=reads)
        both = [read_fasta(spark, f"{folder}/{name}.fasta").select("id", F.lit(name == "yes").alias("matched")) for name in ("yes", "no")]
        return materialize(both[0].unionByName(both[1]), "reads")


def _taxa_file(spark: SparkSession, sf_dir: str, path: str, regions: str) -> str:
    return _file(Q._taxa(spark, sf_dir, regions).select("taxid", F.concat_ws("\t", F.col("taxid").cast("string"), F.lit("x")).alias("value")), path, "taxid")


_COMMAND = f"""
WITH h AS ({Q.HITS}), f AS (SELECT read_id, {Q.RAW} AS raw, edit, {Q.INCLUDE} AND {Q.EXCLUDE} AS ok, min(CASE WHEN {Q.INCLUDE} AND {Q.EXCLUDE} THEN edit END) OVER (PARTITION BY read_id) AS best FROM h),
r AS (SELECT read_id, count(*) AS n, count(*) FILTER (ok AND edit <= best + 1) AS k, string_agg(raw, ',' ORDER BY raw) FILTER (ok AND edit <= best + 1) AS raws FROM f GROUP BY read_id)
"""


@query(f"{_COMMAND} SELECT row_number() OVER (ORDER BY read_id) AS line, concat(read_id, ':', raws) AS value FROM r WHERE k > 0")
def filter_command(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the filtered file and their order."""
    with work_folder(spark) as folder:
        include, exclude = (_taxa_file(spark, sf_dir, f"{folder}/{k}.txt", regions) for k, regions in enumerate(("0, 1, 2", "2, 3")))
        filter_file(spark, _assignments(spark, sf_dir, f"{folder}/a.clp"), f"{folder}/out.clp", include, exclude, 1)
        return materialize(_numbered(read_lines(spark, f"{folder}/out.clp")), "lines")


@query(f"""{_COMMAND}
SELECT 'kept_reads' AS metric, CAST(count(*) FILTER (k > 0) AS BIGINT) AS value FROM r UNION ALL SELECT 'kept_hits', CAST(coalesce(sum(k), 0) AS BIGINT) FROM r
UNION ALL SELECT 'removed_reads', CAST(count(*) FILTER (k = 0) AS BIGINT) FROM r UNION ALL SELECT 'removed_hits', CAST(coalesce(sum(n - k), 0) AS BIGINT) FROM r
""")
def filter_command_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the command counts on its one pass."""
    with work_folder(spark) as folder:
        include, exclude = (_taxa_file(spark, sf_dir, f"{folder}/{k}.txt", regions) for k, regions in enumerate(("0, 1, 2", "2, 3")))
        counts = filter_file(spark, _assignments(spark, sf_dir, f"{folder}/a.clp"), f"{folder}/out/", include, exclude, 1)
        return spark.createDataFrame(list(counts.items()), "metric string, value bigint")


# -- errors ------------------------------------------------------------------------------------------------------------------------


@query(f"""
WITH h AS ({Q.HITS}), m AS ({Q.MAP}), p AS (SELECT max(p_partkey) AS last FROM part), b AS (SELECT min(assembly) AS brand FROM h JOIN m USING (seqid))
SELECT 'key twice' AS "case", concat('more than one sequence has the key ''', last, '''') AS error FROM p UNION ALL
SELECT 'key of the index', concat('more than one sequence has the key ''', last, '''') FROM p UNION ALL
SELECT 'no key', concat('no sequence key and taxon for ''lost', last, '''') FROM p UNION ALL
SELECT 'seeds of another size', 'the index has seeds of 18 letters, not 20' UNION ALL
SELECT 'no annotations', concat('gff of assembly ''', brand, ''' does not exist: /', brand) FROM b UNION ALL
SELECT 'columns of the map table', 'map table /bad.tsv lacks the columns description, gff, header, protein_fasta' UNION ALL
SELECT 'no input', 'no such file: /none' UNION ALL
SELECT 'no taxa', 'no such file: /none' UNION ALL
SELECT 'delta below 0', '--edit-delta must be 0 or more' UNION ALL
SELECT 'no taxon', 'no assembly has a taxon in the report /report.tsv' UNION ALL
SELECT 'size of 0', '--max-size-mb must be over 0' UNION ALL
SELECT 'both kinds of reads', 'give exactly one of fasta and fastq' UNION ALL
SELECT 'no reads', 'no such file: /none' UNION ALL
SELECT 'nothing to merge', 'give at least one input'
""")
def command_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ends a command on files of whole tables of which a line, an option or a name is wrong; and that nothing is written then."""
    with work_folder(spark) as folder:
        parts = Q._sql(spark, sf_dir, "SELECT p_partkey, p_name, p_brand, p_size FROM part", "part")
        last = parts.orderBy(F.col("p_partkey").desc()).limit(1)
        record = lambda head: F.concat(F.lit(">"), head, F.lit("\n"), F.translate("p_name", " ", "A")).alias("value")
        good = parts.select("p_partkey", record(F.concat(F.col("p_partkey").cast("string"), F.lit("-1"))))
        again = last.select("p_partkey", record(F.concat(F.col("p_partkey").cast("string"), F.lit("-2"))))
        lost = last.select("p_partkey", record(F.concat(F.lit("lost"), F.col("p_partkey").cast("string"))))
        fasta, more, twice, unkeyed = (_file(rows, f"{folder}/{name}.fasta", "p_partkey") for name, rows in (("good", good), ("again", again), ("twice", good.unionByName(again)), ("lost", good.unionByName(lost))))
        assignments, mapping = _assignments(spark, sf_dir, f"{folder}/a.clp"), _map_file(spark, sf_dir, f"{folder}/map.tsv")
        bad = _file(parts.select("p_partkey", F.concat_ws("\t", F.col("p_partkey").cast("string"), "p_brand", F.lit("1")).alias("value")), f"{folder}/bad.tsv", "p_partkey", "seqid\tassembly\ttaxid\n")
        report = _file(parts.select("p_partkey", F.concat("p_brand", F.lit("\tx")).alias("value")), f"{folder}/report.tsv", "p_partkey", "accession\ttaxid\n")
        index, none, out = f"{folder}/index", f"{folder}/none", f"{folder}/out"
        index_build(spark, fasta, index)
        table = lambda t, **more: annotate(spark, assignments, t, f"{out}/t.tsv", f"{out}/p.faa", **more)
        cases = {
            "key twice": lambda: index_build(spark, twice, f"{out}/index"),
            "key of the index": lambda: index_build(spark, more, index, append=True),
            "no key": lambda: index_build(spark, unkeyed, f"{out}/index"),
            "seeds of another size": lambda: index_build(spark, more, index, append=True, seed_size=20),
            "no annotations": lambda: table(mapping, strict=True),
            "columns of the map table": lambda: table(bad),
            "no input": lambda: filter_file(spark, none, f"{out}/f.clp"),
            "no taxa": lambda: filter_file(spark, assignments, f"{out}/f.clp", none),
            "delta below 0": lambda: filter_file(spark, assignments, f"{out}/f.clp", edit_delta=-1),
            "no taxon": lambda: reference_build(spark, folder, report, f"{out}/build", 1),
            "size of 0": lambda: reference_build(spark, folder, report, f"{out}/build", 0),
            "both kinds of reads": lambda: assign_files(spark, index, f"{out}/r.clp", fasta=fasta, fastq=fasta),
            "no reads": lambda: assign_files(spark, index, f"{out}/r.clp", fasta=none),
            "nothing to merge": lambda: merge_files(spark, [], f"{out}/m.clp"),
        }
        rows = []
        for case, command in cases.items():
            try:
                command()
                error = "none"
            except (ValueError, FileNotFoundError) as e:
                error = str(e).replace(folder, "")
            rows.append((case, f"{error}; something is written" if exists(spark, out) else error))
        return spark.createDataFrame(rows, "case string, error string")


# -- lists too long for a literal, order, streams --------------------------------------------------------------------------------


def _long(spark: SparkSession, taxa: DataFrame) -> DataFrame:
    """``taxa`` and so many that no hit has that the filter has no literals for them."""
    return taxa.unionByName(spark.range(filters.INLINE + 1).select((-F.col("id") - 1).alias("taxid")))


@query(Q._filter_sql(f"{Q.INCLUDE} AND {Q.EXCLUDE}", 0))
def taxa_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    include, exclude = (_long(spark, Q._taxa(spark, sf_dir, regions)) for regions in ("0, 1, 2", "2, 3"))
    return Q._exploded(filters.filter_hits(Q._reads(spark, sf_dir), include=include, exclude=exclude))


@query(f"""
WITH h AS ({Q.HITS}), r AS (SELECT read_id, list_sort(list({Q.RAW})) AS raws FROM h GROUP BY read_id),
i AS (SELECT read_id, raws, unnest(range(len(raws))) AS k FROM r) SELECT read_id, CAST(k AS INTEGER) AS hit_idx, raws[k + 1] AS raw FROM i
""")
def hit_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    with work_folder(spark) as folder:
        reads = read_assignments(spark, _assignments(spark, sf_dir, f"{folder}/a.clp"))
        return materialize(merge.strict_hits(reads).select("read_id", "hit_idx", "raw"), "hits")


@query(Q._filter_sql("taxid % 3 <> 0 AND taxid % 5 <> 1", 1, f"SELECT concat(read_id, ':', string_agg(raw, ',' ORDER BY raw)) AS line FROM k GROUP BY read_id"))
def stream_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream over a directory, run until nothing is left to read."""
    with work_folder(spark) as folder:
        _assignments(spark, sf_dir, f"{folder}/in/a.clp")
        taxa = Q._table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("bigint").alias("taxid"))
        streams.start_filter(spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint", taxa.where("taxid % 3 <> 0"), taxa.where("taxid % 5 = 1"), 1).awaitTermination()
        return materialize(spark.read.text(f"{folder}/out").select(F.col("value").alias("line")), "lines")


@query(f"WITH {Q._RESOLVED} SELECT read_id, seqid, pos, edit, taxid, assembly, accession, description, coalesce(n_name, '') AS organism FROM r LEFT JOIN nation ON taxid = n_nationkey AND taxid > 0")
def stream_named_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    with work_folder(spark) as folder:
        _assignments(spark, sf_dir, f"{folder}/in/a.clp")
        rows = streams.named_hits(spark.readStream.text(f"{folder}/in"), Q._mapping(spark, sf_dir), Q._taxonomy(spark, sf_dir))
        rows.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
        return materialize(spark.read.parquet(f"{folder}/out").select("read_id", "seqid", "pos", "edit", "taxid", "assembly", "accession", "description", "organism"), "hits")


@query("SELECT DISTINCT CAST(l_suppkey AS BIGINT) AS taxid, coalesce(n_name, '') AS organism FROM lineitem LEFT JOIN nation ON l_suppkey = n_nationkey AND l_suppkey > 0")
def organism_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.name_organisms(Q._hits(spark, sf_dir).select("taxid").distinct(), Q._taxonomy(spark, sf_dir)).select("taxid", "organism")


# -- mapping -----------------------------------------------------------------------------------------------------------------------

_UPPER = "translate({}, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')"


def _exact_sql(reads: str, refs: str) -> str:
    """Every place where a read stands unedited: ``reads`` has read_id and t, ``refs`` seqid, taxid and t."""
    return f"""
q AS ({reads}), d AS ({refs}), m AS (SELECT q.read_id, d.seqid, d.taxid, q.t AS r, d.t AS t FROM q JOIN d ON contains(d.t, q.t)),
p AS (SELECT *, unnest(range(1, length(t) - length(r) + 2)) AS pos FROM m),
a AS (SELECT read_id, CAST(taxid AS BIGINT) AS taxid, seqid, pos, CAST(0 AS BIGINT) AS edit FROM p WHERE substr(t, pos, length(r)) = r)"""


_EXACT = _exact_sql(
    f"SELECT CAST(item_id AS VARCHAR) AS read_id, {_UPPER.format('text')} AS t FROM benchmark WHERE length(text) >= 18",
    f"SELECT CAST(doc_id AS VARCHAR) AS seqid, doc_id % 97 AS taxid, {_UPPER.format('text')} AS t FROM documents WHERE text IS NOT NULL",
)


def _exact(spark: SparkSession, sf_dir: str, **limits) -> DataFrame:
    reads = Q._table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("read_id"), F.col("text").alias("seq"))
    refs = Q._references(spark, sf_dir)
    return seeds.assign(reads, seeds.seeds_of(reads, refs, unknown=None), refs, edit_rate=0.0, max_hits=1 << 40, **limits)


@query(f"WITH {_EXACT} SELECT * FROM a")
def assign_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads against references without edits: every place where one stands."""
    return _exact(spark, sf_dir)


@query(f"WITH {_EXACT}, n AS (SELECT *, row_number() OVER (PARTITION BY read_id ORDER BY edit, seqid, pos) AS k FROM a) SELECT read_id, taxid, seqid, pos, edit FROM n WHERE k <= 1")
def assign_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exact(spark, sf_dir, max_assignments=1)


#: Items as sequences: no white space, and no N, which is no letter of a seed.
_ITEM = "translate(regexp_replace(text, '\\s+', '', 'g'), 'nN', 'mM')"


def _items_sql(reads: str) -> str:
    refs = f"SELECT concat('s', item_id) AS seqid, item_id % 9 AS taxid, {_UPPER.format(_ITEM)} AS t FROM benchmark"
    return f"WITH {_exact_sql(f'SELECT concat(chr(105), item_id) AS read_id, {_UPPER.format(_ITEM)} AS t FROM ({reads})', refs)} SELECT * FROM a"


def _assign_items(spark: SparkSession, sf_dir: str, folder: str) -> tuple[str, str]:
    """An index of the benchmark's items, whose keys come from a mapping of headers, and the items as reads: index and FASTA file."""
    items = Q._table(spark, sf_dir, "benchmark")
    fasta = _file(items.select("item_id", fasta_text(F.concat(F.lit("i"), "item_id"), F.translate(F.regexp_replace("text", r"\s+", ""), "nN", "mM")).alias("value")), f"{folder}/items.fasta", "item_id")
    keys = items.select("item_id", F.concat_ws(",", F.concat(F.lit("i"), "item_id"), (F.col("item_id") % 9).cast("string"), F.concat(F.lit("s"), "item_id")).alias("value"))
    index_build(spark, fasta, f"{folder}/index", _file(keys, f"{folder}/keys.csv", "item_id", "header,taxid,seqid\n"))
    return f"{folder}/index", fasta


def _assigned(spark: SparkSession, results: str) -> DataFrame:
    return materialize(merge.strict_hits(read_assignments(spark, results)).select("read_id", "taxid", "seqid", "pos", "edit"), "assigned")


@query(_items_sql("SELECT *, row_number() OVER (ORDER BY item_id) AS k FROM benchmark QUALIFY k > 5"))
def assign_command_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All reads but the first five."""
    with work_folder(spark) as folder:
        index, fasta = _assign_items(spark, sf_dir, folder)
        assign_files(spark, index, f"{folder}/out.clp", fasta=fasta, edit_rate=0.0, max_hits=1 << 40, read_offset=5)
        return _assigned(spark, f"{folder}/out.clp")


@query(_items_sql("SELECT * FROM benchmark"))
def assign_command_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All reads but the first five, and then the rest."""
    with work_folder(spark) as folder:
        index, fasta = _assign_items(spark, sf_dir, folder)
        for offset in (5, 0):
            assign_files(spark, index, f"{folder}/out.clp", fasta=fasta, edit_rate=0.0, max_hits=1 << 40, read_offset=offset)
        return _assigned(spark, f"{folder}/out.clp")


@query(_items_sql("SELECT * FROM benchmark"))
def assign_command_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index of the items with an even number, to which the others are added; results as a directory, of two batches."""
    with work_folder(spark) as folder:
        items = Q._table(spark, sf_dir, "benchmark")
        value = fasta_text(F.concat(F.concat(F.lit("s"), "item_id"), F.lit("-"), (F.col("item_id") % 9).cast("string")), F.translate(F.regexp_replace("text", r"\s+", ""), "nN", "mM"))
        for k in (0, 1):
            part = items.where(F.col("item_id") % 2 == k)
            index_build(spark, _file(part.select("item_id", value.alias("value")), f"{folder}/{k}.fasta", "item_id"), f"{folder}/index", append=k == 1)
            read = F.concat(F.lit(">i"), "item_id", F.lit("\n"), F.translate(F.regexp_replace("text", r"\s+", ""), "nN", "mM"))
            _file(part.select("item_id", read.alias("value")), f"{folder}/reads/{k}.fasta", "item_id")
        assign_files(spark, f"{folder}/index", f"{folder}/out/", fasta=f"{folder}/reads", edit_rate=0.0, max_hits=1 << 40, batch_files=1)
        return _assigned(spark, f"{folder}/out/batch=*")
