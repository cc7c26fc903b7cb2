"""Text and tables as one file, or, where the path ends in ``/``, as a directory of parts."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaspark.functions import safe_header, wrap
from taxaspark.sources.lines import plain


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def parts_of(spark: SparkSession, directory: str) -> list[str]:
    """The parts of a directory that Spark wrote, in order."""
    fs, source = _fs(spark, directory)
    return sorted(str(s.getPath()) for s in fs.listStatus(source) if s.getPath().getName().startswith("part-"))


def children(spark: SparkSession, directory: str) -> list[str]:
    """The folders of a directory, in order; none if it isn't there."""
    fs, p = _fs(spark, directory)
    return sorted(str(s.getPath()) for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, source: str, path: str) -> None:
    """Rename within a file system; what stands at ``path`` is replaced."""
    fs, p = _fs(spark, source)
    target = _fs(spark, path)[1]
    fs.mkdirs(target.getParent())
    fs.delete(target, True)
    if not fs.rename(p, target):
        raise OSError(f"can't rename {source} to {path}")


def join_files(spark: SparkSession, parts: list[str], path: str, head: str = "", keep: bool = False) -> None:
    """``head`` and the parts, in order, as the file ``path``. The parts are used up unless ``keep``.

    One part becomes the file by a rename, and a file system that can append files to each other is asked to; no byte is copied
    then. Others have the bytes streamed by the driver's file client, without Spark's memory: give outputs of many parts a path that
    ends in ``/``. The file appears when it is whole.
    """
    if len(parts) == 1 and not head and not keep:
        move(spark, parts[0], path)
        return
    made = f"{path}.made-{uuid.uuid4().hex}"
    touch(spark, made, head)
    if keep or not _concatenated(spark, made, parts):
        fs, p = _fs(spark, made)
        out = fs.create(p, True)
        try:
            out.write(bytearray(head.encode()))
            for part in parts:
                with_fs, source = _fs(spark, part)
                stream = with_fs.open(source)
                try:
                    spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 16, False)
                finally:
                    stream.close()
        finally:
            out.close()
    move(spark, made, path)


def _concatenated(spark: SparkSession, path: str, parts: list[str]) -> bool:
    """Append ``parts`` to the file ``path`` by the file system's own means; false if it has none."""
    fs, target = _fs(spark, path)
    some = [_fs(spark, p)[1] for p in parts]
    array = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Path, len(some))
    for k, p in enumerate(some):
        array[k] = p
    try:
        fs.concat(target, array)
    except UnsupportedOperationException:
        return False
    return True


def single_file(spark: SparkSession, directory: str, path: str, head: str = "") -> None:
    """Join the parts of ``directory`` in order into ``path``, after ``head``, and delete the directory."""
    join_files(spark, parts_of(spark, directory), path, head)
    delete(spark, directory)


def write_files(df: DataFrame, key: str, order: list[str], name: Callable[[int], str], value: str = "value") -> list[int]:
    """The lines of each ``key`` (an integer) as the file ``name(key)``, in ``order``; the keys.

    A file is written whole by one task, and many at a time; the driver renames them and sees no byte.
    """
    spark = df.sparkSession
    parts = f"{name(0)}.parts-{uuid.uuid4().hex}"
    df.repartition(key).sortWithinPartitions(key, *order).select(key, value).write.partitionBy(key).text(parts)
    fs, folder = _fs(spark, parts)
    keys = sorted(int(s.getPath().getName().partition("=")[2]) for s in fs.listStatus(folder) if "=" in s.getPath().getName())
    with ThreadPoolExecutor(32) as pool:
        list(pool.map(lambda k: single_file(spark, f"{parts}/{key}={k}", name(k)), keys))
    fs.delete(folder, True)
    return keys


def write_splits(df: DataFrame, inputs: list[str], path: str, value: str = "value") -> None:
    """The lines of a map-only plan, in input order, without a sort of all rows.

    ``df`` has ``at`` of the reader: each task orders what it has of a file's split, and the splits' parts stand in the order of
    ``inputs`` (the files that were read). A path that ends in ``/`` is a directory with a folder for each split.
    """
    spark = df.sparkSession
    split = F.concat_ws("-", F.lpad(F.col("at.input").cast("string"), 6, "0"), F.md5(plain(F.col("at.file"))), F.lpad(F.col("at.block").cast("string"), 19, "0"))
    rows = df.withColumn("split", split).sortWithinPartitions("split", "at").select("split", value)
    if path.endswith("/"):
        rows.write.mode("overwrite").partitionBy("split").text(path)
        return
    parts = f"{path}.parts-{uuid.uuid4().hex}"
    rows.write.partitionBy("split").text(parts)
    fs, folder = _fs(spark, parts)
    place = {hashlib.md5(re.sub("^file:/+", "/", f).encode()).hexdigest(): k for k, f in enumerate(sorted(inputs))}
    named = [s.getPath().getName() for s in fs.listStatus(folder) if "=" in s.getPath().getName()]
    number = lambda n: (n[6:12], place[n[13:45]], n[46:])  # noqa: E731  "split=", input, digest, block
    join_files(spark, [p for n in sorted(named, key=number) for p in parts_of(spark, f"{parts}/{n}")], path)
    fs.delete(folder, True)


def touch(spark: SparkSession, path: str, text: str = "") -> None:
    """A file with ``text``; empty without."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    if text:
        out.write(bytearray(text.encode()))
    out.close()


def write_lines(df: DataFrame, path: str, value: str = "value", order: list[str] | None = None) -> None:
    """One text file of a string column, lines ended by a line feed, in ``order``; a directory of parts if ``path`` ends in ``/``."""
    rows = df.orderBy(*order) if order else df
    if path.endswith("/"):
        rows.select(value).write.mode("overwrite").text(path)
        return
    parts = f"{path}.parts-{uuid.uuid4().hex}"
    rows.select(value).write.text(parts)
    single_file(df.sparkSession, parts, path)


#: Of the fields of a table.
FIELDS = {"sep": "\t", "quote": '"', "escape": '"', "lineSep": "\r\n", "emptyValue": "", "nullValue": ""}


def write_table(df: DataFrame, path: str, compression: str = "none") -> None:
    """One tab-separated file with a header; lines end in CR LF, quotes are doubled, and fields quoted only where needed.

    The order of ``df`` is kept. Without rows there is the header alone. If ``path`` ends in ``/``, it is a directory of parts,
    each with a header and in ``compression``: no byte passes through the driver.
    """
    if path.endswith("/"):
        df.write.mode("overwrite").csv(path, **FIELDS, header=True, compression=compression)
        return
    parts = f"{path}.parts-{uuid.uuid4().hex}"
    df.write.csv(parts, **FIELDS, header=False)
    single_file(df.sparkSession, parts, path, "\t".join(df.columns) + "\r\n")


def write_table_lines(lines: DataFrame, columns: list[str], path: str, compression: str = "none") -> None:
    """What :func:`write_table` makes of a table, from its rows as lines (value, of FIELDS) in their order; there is one at least."""
    head = "\t".join(columns) + "\r\n"
    if path.endswith("/"):
        first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0  # of a task, which writes one part
        rows = lines.select(F.when(first, F.concat(F.lit(head), "value")).otherwise(F.col("value")).alias("value"))
        rows.write.mode("overwrite").option("maxRecordsPerFile", 0).text(path, lineSep="\r\n", compression=compression)
        return
    parts = f"{path}.parts-{uuid.uuid4().hex}"
    lines.select("value").write.text(parts, lineSep="\r\n")
    single_file(lines.sparkSession, parts, path, head)


def fasta_text(header: Column, seq: Column) -> Column:
    """A record without the line end after its last line."""
    return F.when(seq == "", F.concat(F.lit(">"), header)).otherwise(F.concat(F.lit(">"), header, F.lit("\n"), wrap(seq)))


def protein_text(protein_id: Column, header: Column, seq: Column) -> Column:
    return fasta_text(F.concat(protein_id.cast("string"), F.lit(" "), safe_header(header)), seq)


def read_text(description: Column, seq: Column, qual: Column) -> Column:
    """A read as FASTQ if it has qualities, else as FASTA."""
    return F.when(qual.isNotNull(), F.concat(F.lit("@"), description, F.lit("\n"), seq, F.lit("\n+\n"), qual)).otherwise(fasta_text(description, seq))
