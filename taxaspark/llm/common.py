"""What the operators of this subpackage share: tables, the shared folder, Arrow batches of texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaspark.storage import materialize, remove, shared_dir

__all__ = ["materialize", "remove", "shared_dir"]

#: Characters that one numpy pass takes at once; a longer text is a pass of its own.
CHUNK_CHARS = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the fold that no model learns labels from: crc32 of the id as text, modulo 4, is 2 (a null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample_hash(seed: int, by: list[str]) -> Column:
    """A seeded hash of the columns ``by``, from 0 to 2^63 - 1. Rows that are alike in them have the same."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in by]), 1)


def hash_cut(wanted: int, n: int) -> int:
    """Under which hash about ``wanted`` of ``n`` distinct rows lie, with a margin so that there are hardly ever fewer."""
    return (1 << 63) - 1 if wanted >= n else min((1 << 63) - 1, int((1.5 * wanted + 64) / n * (1 << 63)))


def bounded_sample(df: DataFrame, by: list[str], bound: int, seed: int) -> DataFrame:
    """At most ``bound`` rows, chosen by a seeded hash of the columns ``by``; of rows that are alike in them only one.

    All of the distinct rows, if there are no more. One pass estimates their number, which fixes a cut of the hash; the rows under
    it lose their repeats, and those of the least hashes stay. The bound is hard however often an id or a text is repeated, a
    table with a row has a sample with a row, and the choice is the same on every run.
    """
    hashed = df.withColumn("__sample", sample_hash(seed, by))
    n = hashed.agg(F.approx_count_distinct("__sample", 0.02)).first()[0]
    few = hashed.where(F.col("__sample") <= hash_cut(bound, int(1.1 * n))).dropDuplicates(["__sample"])
    return few.orderBy("__sample").limit(bound).drop("__sample")


def with_columns_from_text(df: DataFrame, text: str, fields: list[T.StructField], score: Callable[[list[str | None]], list]) -> DataFrame:
    """All columns of ``df`` and, after them, ``fields``: ``score`` gets a batch of texts and returns one sequence per field.

    A column of ``df`` that has the name of a new one (in any case of letters) is replaced.
    """
    new = {f.name.lower() for f in fields}
    kept = df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in new])
    if text not in kept.columns:
        raise ValueError(f"no column {text!r}")
    at = kept.columns.index(text)
    schema = T.StructType([*kept.schema.fields, *fields])
    kinds = [{"double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "int": pa.int32(), "bigint": pa.int64()}[f.dataType.simpleString()] for f in fields]
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = score(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(v, kind) for v, kind in zip(out, kinds, strict=True))], names=names)

    return kept.mapInArrow(run, schema)


def chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` with about CHUNK_CHARS characters each."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK_CHARS:
            yield start, i
            start, size = i, 0
        size += len(t) + 2
    if start < len(texts):
        yield start, len(texts)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' code points, two line ends after each text, and where each text starts (one entry more than texts)."""
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 2 for t in texts], out=at[1:])
    joined = "\n\n".join(texts) + "\n\n" if texts else ""
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32), at


_LETTERS: np.ndarray | None = None


def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTERS


def segment_sums(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sum of the rows of ``values`` by ``owner`` (sorted, below n)."""
    out = np.zeros((n, *values.shape[1:]), np.float64)
    if len(owner):
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        out[owner[first]] = np.add.reduceat(values, first, axis=0)
    return out


_POWERS = np.ones(1, np.uint64)
_INVERSE = np.ones(1, np.uint64)
_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number modulo 2^64, and of its inverse."""
    global _POWERS, _INVERSE
    if len(_POWERS) < n:
        size = 1 << max(16, (n - 1).bit_length())
        _POWERS = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, _P, np.uint64)], dtype=np.uint64)
        _INVERSE = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, _P_INVERSE, np.uint64)], dtype=np.uint64)
    return _POWERS[:n], _INVERSE[:n]


class SpanHashes:
    """Hashes of any spans of an array, from one prefix sum: a span's hash depends on its values alone."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        power, self._inverse = _powers(n + 1)
        self._sum = np.zeros(n + 1, np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * power[:n], out=self._sum[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
        return mix((self._sum[end] - self._sum[start]) * self._inverse[start] + np.uint64(salt * 0x51ED2701 & (2**64 - 1)))


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    edge = np.diff(np.r_[np.int8(0), mask.view(np.int8), np.int8(0)])
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
