"""Reports that give each assembly its taxon: delimited text, JSON lines, or one JSON document; gzipped or not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from taxaspark.functions import first_filled, int_like_python, strip
from taxaspark.sources.delimited import read_delimited
from taxaspark.sources.lines import read_lines, sums_before
from taxaspark.storage import materialize

#: Names that columns or fields may have, in the order in which they are tried.
ASSEMBLY_NAMES = ["assembly_accession", "assemblyAccession", "assembly_accession_version", "accession"]
TAXID_NAMES = ["tax_id", "taxid", "organism_tax_id", "organism_taxid"]


def _fields(obj: Column, path: str, names: list[str]) -> list[Column]:
    return [F.try_variant_get(obj, f"{path}.{n}", "string") for n in names]


def assembly_of(obj: Column) -> Column:
    """Of a variant: at the top, then under ``assembly``."""
    return first_filled(*_fields(obj, "$", ASSEMBLY_NAMES), *_fields(obj, "$.assembly", ASSEMBLY_NAMES))


def taxid_of(obj: Column) -> Column:
    """At the top, then under assembly.organism, assembly and organism; only digits count."""
    found = first_filled(*[f for p in ("$", "$.assembly.organism", "$.assembly", "$.organism") for f in _fields(obj, p, TAXID_NAMES)])
    return F.when(found.rlike("^[0-9]+$"), found.try_cast("bigint"))


def first_place_last_value(rows: DataFrame) -> DataFrame:
    """at, assembly, taxid -> ordinal, assembly, taxid: an assembly stands where it came first, with the taxon that came last.

    ``ordinal`` orders assemblies; it is the struct ``at``.
    """
    return rows.groupBy("assembly").agg(F.min("at").alias("ordinal"), F.max_by("taxid", "at").alias("taxid")).select("ordinal", "assembly", "taxid")


#: A JSON string, and the letters that open and close objects and arrays.
_STRING = r'"(?:[^"\\]|\\.)*+"'
_TOKEN = rf"{_STRING}|[\[\]{{}},]|[^\"\[\]{{}},]+"


def _brackets(value: Column) -> Column:
    """The brackets of a line, outside of its strings."""
    return F.regexp_replace(F.regexp_replace(value, _STRING, ""), r"[^\[\]{}]+", "")


def _depth(brackets: Column) -> Column:
    """By how much they go down into the document, less those that come up."""
    return F.length(F.regexp_replace(brackets, r"[\]}]", "")) - F.length(F.regexp_replace(brackets, r"[\[{]", ""))


#: A line of more strings, brackets and what lies between them is cut as rows of its own, which can be any number.
TOKENS = 4096


def _goes(token: Column) -> Column:
    return F.when(token.isin("[", "{"), 1).when(token.isin("]", "}"), -1).otherwise(0)


def _pieces(tokens: Column, depth: Column) -> Column:
    """A line's text between the array's commas: one piece more than commas, without the array's own brackets."""

    def step(s: Column, c: Column) -> Column:
        d = s["d"] + _goes(c)
        own = ((c == "[") & (d == 1)) | ((c == "]") & (d == 0))
        same = F.struct(d.alias("d"), s["done"].alias("done"), s["text"].alias("text"))
        ended = F.struct(d.alias("d"), F.array_append(s["done"], s["text"]).alias("done"), F.lit("").alias("text"))
        longer = F.struct(d.alias("d"), s["done"].alias("done"), F.concat(s["text"], c).alias("text"))
        return F.when(own, same).when((c == ",") & (d == 1), ended).otherwise(longer)

    start = F.struct(depth.cast("bigint").alias("d"), F.array().cast("array<string>").alias("done"), F.lit("").alias("text"))
    return F.aggregate(tokens, start, step, lambda s: F.array_append(s["done"], s["text"]))


def _tokens(rows: DataFrame) -> DataFrame:
    """at, k, text, comma: the same of longer lines, a row a token, and whether it is one of the array's commas."""
    tokens = rows.select("at", "depth", F.posexplode(F.regexp_extract_all("value", F.lit(_TOKEN), F.lit(0))).alias("k", "text"))
    reached = F.sum(_goes(F.col("text"))).over(Window.partitionBy("at").orderBy("k"))
    tokens = tokens.withColumn("d", F.col("depth") + reached).where(~(((F.col("text") == "[") & (F.col("d") == 1)) | ((F.col("text") == "]") & (F.col("d") == 0))))
    return tokens.select("at", "k", "text", ((F.col("text") == ",") & (F.col("d") == 1)).alias("comma"))


def document_items(lines: DataFrame) -> DataFrame:
    """at, value: the items of a JSON document over many lines, or the document itself if it isn't an array.

    A line's strings end in it, so that a line's brackets tell its depth, and sums over file splits that of every line's start.
    Only lines that reach the array itself are cut at its commas; no task holds the document.
    """
    rows = lines.where(strip(F.col("value")) != "").withColumn("brackets", _brackets(F.col("value")))
    step = lambda s, c: F.struct((s["d"] + F.when(c.isin("[", "{"), 1).otherwise(-1)).alias("d"), F.least(s["low"], s["d"] + F.when(c.isin("[", "{"), 1).otherwise(-1)).alias("low"))
    least = F.aggregate(F.split("brackets", ""), F.struct(F.lit(0).alias("d"), F.lit(0).alias("low")), lambda s, c: F.when(c == "", s).otherwise(step(s, c)))["low"]
    rows = sums_before(rows.select("at", "value", _depth(F.col("brackets")).alias("goes"), least.alias("least")), {"depth": F.col("goes")})
    rows = materialize(rows.select("at", "value", "depth", "least"), "document")  # later jobs read it several times
    top = rows.where("depth = 0").select("at", "value").orderBy("at").head(2)
    if len(top) > 1:
        raise ValueError("the report is neither JSON lines nor one document")
    if not top or not top[0]["value"].lstrip("\ufeff \t").startswith("["):
        return rows.groupBy("at.input", "at.file").agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("r")).select(F.col("r")[0]["at"].alias("at"), F.array_join(F.transform("r", lambda x: x["value"]), "\n").alias("value"))
    # a line that stays inside of one item is a piece of it
    inside = (F.col("depth") + F.col("least") > 1) & (F.col("depth") > 1)
    tokens = F.regexp_extract_all("value", F.lit(_TOKEN), F.lit(0))
    cut = F.get(F.transform(F.array(tokens), lambda ts: F.when(F.size(ts) <= TOKENS, _pieces(ts, F.col("depth")))), F.lit(0))
    rows = rows.withColumn("pieces", F.when(inside, F.array("value")).otherwise(cut))
    rows = materialize(rows.select("at", "depth", "pieces", F.when(F.col("pieces").isNull(), F.col("value")).alias("value")), "pieces")
    long = _tokens(rows.where("pieces is null"))
    commas = rows.where("pieces is not null").select("at", "pieces", (F.size("pieces") - 1).alias("commas"))
    commas = commas.unionByName(long.groupBy("at").agg(F.sum(F.col("comma").cast("int")).alias("commas")), allowMissingColumns=True)
    numbered = sums_before(commas, {"item": F.col("commas")})
    items = numbered.where("pieces is not null").select("at", "item", F.posexplode("pieces").alias("k", "text")).select("at", "k", "text", (F.col("item") + F.col("k")).alias("n"))
    within = F.sum(F.col("comma").cast("int")).over(Window.partitionBy("at").orderBy("k"))
    more = long.withColumn("within", within).join(numbered.where("pieces is null").select("at", "item"), "at").where("not comma")
    items = items.unionByName(more.select("at", "k", "text", (F.col("item") + F.col("within")).alias("n"))).where("text <> ''")
    whole = items.groupBy("at.input", "at.file", "n").agg(F.sort_array(F.collect_list(F.struct("at.block", "at.row", "k", "text"))).alias("r"))
    first = F.struct("input", "file", F.lit(0).cast("bigint").alias("block"), F.col("n").alias("row"))
    return whole.select(first.alias("at"), F.array_join(F.transform("r", lambda x: x["text"]), "").alias("value")).where(strip(F.col("value")) != "")


def parse_json(lines: DataFrame, dealt: bool = False) -> DataFrame:
    """at, assembly, taxid from JSON lines; if any line isn't JSON, from all of them as one document.

    ``dealt``: lines come from one task (of a gzipped file), and are dealt out before they are parsed. What is parsed is written
    once, as the search for a line that isn't JSON reads all of it.
    """
    filled = lines.select("at", strip(F.col("value")).alias("value")).where("value <> ''")
    if dealt:
        filled = materialize(filled.repartition(F.xxhash64("at.row")), "lines")
    parsed = filled.select("at", F.try_parse_json("value").alias("o"))
    if parsed.where("o is null").limit(1).count():
        parsed = document_items(lines).select("at", F.parse_json("value").alias("o"))
    parsed = parsed.where(F.schema_of_variant("o").startswith("OBJECT"))
    return parsed.select("at", assembly_of(F.col("o")).alias("assembly"), taxid_of(F.col("o")).alias("taxid")).where("assembly is not null and taxid is not null")


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """ordinal, assembly, taxid."""
    low = path.lower()
    if low.endswith((".jsonl", ".jsonl.gz", ".json", ".json.gz")):
        return first_place_last_value(parse_json(read_lines(spark, path), low.endswith(".gz")))
    rows = read_delimited(spark, path)
    if len(rows.columns) < 2:
        raise ValueError(f"report has no header: {path}")
    assembly = next((c for c in ASSEMBLY_NAMES if c in rows.columns), None)
    taxid = next((c for c in TAXID_NAMES if c in rows.columns), None)
    if assembly is None or taxid is None:
        raise ValueError(f"report {path} needs one of {ASSEMBLY_NAMES} and one of {TAXID_NAMES}; it has {sorted(c for c in rows.columns if c != 'at')}")
    return first_place_last_value(rows.select("at", F.col(f"`{assembly}`").alias("assembly"), int_like_python(F.col(f"`{taxid}`")).alias("taxid")).where("assembly <> '' and taxid is not null"))
