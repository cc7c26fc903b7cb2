"""Vector code compression: product codes whose entries are found by annular norm pruning.

Vectors of integers are cut into equal parts, and each part is replaced by the nearest entry (squared Euclidean distance, ties to
the lower index) of its position's codebook. Entries stand in order of their norms. By the triangle inequality an entry at distance
d from x has a norm within d of x's, so the search starts with the entry of the closest norm, binary-searches the interval of norms
that its distance allows, ends included, and evaluates that annulus alone, in exact integers.

Codebooks start as the parts of the vectors with the smallest ids. A round is one pass over the written integer vectors: each task
hands on sums and counts by part, entry and place, one aggregation adds them up, and the driver gets a number for each component
of the codebooks, whatever the table's size. Entries become the floor of their mean; unused entries stay.

Cases: null vectors and those with a null or non-finite component are left out. Integer components beyond 2^24 count as 2^24.
Vectors of different lengths: shorter ones are followed by zeros, to the largest length, rounded up to a multiple of the parts;
empty vectors are zeros. Null ids come after all others, and rows of one id in the order of their vectors. Fewer rows than entries:
so many entries. Repeated rows count each. Empty tables: no row. Columns named as a new one are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaspark.llm.common import materialize, table
from taxaspark.llm.vectors import finite, integers, matrix

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Pairs of a part and an entry that are evaluated at once.
PAIRS = 1 << 17


class Annuli:
    """Entries of one codebook in order of their norms."""

    def __init__(self, entries: np.ndarray):
        norms = np.sqrt((entries.astype(np.float64) ** 2).sum(1))
        self.order = np.argsort(norms, kind="stable")
        self.entries, self.norms = entries[self.order], norms[self.order]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The index and squared distance of each row's nearest entry, and how many distances were evaluated."""
        norm = np.sqrt((x.astype(np.float64) ** 2).sum(1))
        right = np.clip(np.searchsorted(self.norms, norm), 1, len(self.norms) - 1) if len(self.norms) > 1 else np.zeros(len(x), np.int64)
        left = np.maximum(right - 1, 0)
        first = np.where(np.abs(self.norms[left] - norm) <= np.abs(self.norms[right] - norm), left, right)
        index, best = self.order[first], ((x - self.entries[first]) ** 2).sum(1)
        # wider than the rounding of norms and roots, so that no entry of the annulus is lost
        reach = np.sqrt(best.astype(np.float64)) * (1 + 1e-9) + 1e-9 * norm + 1e-6
        low, high = np.searchsorted(self.norms, norm - reach, "left"), np.searchsorted(self.norms, norm + reach, "right")
        sizes = high - low
        ends = np.cumsum(sizes)
        a = 0
        while a < len(x):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PAIRS, "right")))
            owner = np.repeat(np.arange(a, b), sizes[a:b])
            place = np.arange(len(owner)) - np.repeat(ends[a:b] - sizes[a:b] - (ends[a - 1] if a else 0), sizes[a:b]) + low[owner]
            far = ((x[owner] - self.entries[place]) ** 2).sum(1)
            entry = self.order[place]
            rank = np.lexsort((entry, far, owner))
            top = rank[np.r_[True, owner[rank][1:] != owner[rank][:-1]]] if len(rank) else rank
            better = (far[top] < best[owner[top]]) | ((far[top] == best[owner[top]]) & (entry[top] < index[owner[top]]))
            top = top[better]
            index[owner[top]], best[owner[top]] = entry[top], far[top]
            a = b
        return index, best, len(x) + int(sizes.sum())


@dataclass
class Codebooks:
    """entries: parts x entries x numbers of a part."""

    entries: np.ndarray

    @property
    def width(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each row's (n x width) parts: two arrays n x parts."""
        parts, _, w = self.entries.shape
        found = [Annuli(self.entries[p]).nearest(x[:, p * w : (p + 1) * w])[:2] for p in range(parts)]
        return np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)

    def digest(self) -> str:
        """Hex of all components as decimal numbers by part, entry and place."""
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def _moved(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after one round over ``vectors`` (v)."""
    parts, k, w = books.entries.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((parts, k, w), np.int64), np.zeros((parts, k), np.int64)
        for batch in batches:
            x = matrix(batch.column(0), books.width)
            index, _ = books.assign(x)
            for p in range(parts):
                np.add.at(total[p], index[:, p], x[:, p * w : (p + 1) * w])
                n[p] += np.bincount(index[:, p], minlength=k)
        place = np.flatnonzero(n.reshape(-1))
        whole = np.concatenate([n[:, :, None], total], 2).reshape(parts * k, w + 1)[place]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(place, w + 1)), pa.array(np.tile(np.arange(w + 1), len(place))), pa.array(whole.reshape(-1))], names=["entry", "at", "n"])

    rows = vectors.select("v").mapInArrow(sums, "entry long, at long, n long").groupBy("entry", "at").agg(F.sum("n").alias("n")).toArrow()  # a number a component of the codebooks
    flat = np.zeros((parts * k, w + 1), np.int64)
    flat[rows.column(0).to_numpy(), rows.column(1).to_numpy()] = rows.column(2).to_numpy()
    used = flat[:, :1] > 0
    moved = np.where(used, flat[:, 1:] // np.maximum(flat[:, :1], 1), books.entries.reshape(parts * k, w))
    return Codebooks(moved.reshape(parts, k, w))


def fit_codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, id_col: str = "id", vector_col: str = "v") -> Codebooks | None:
    """Codebooks of all ``vectors`` (an id and an array of int); None if there is none."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    longest = rows.agg(F.max(F.size("v"))).first()[0]
    if longest is None:
        return None
    width = -(-longest // parts) * parts
    first = rows.orderBy(F.asc_nulls_last("id"), "v").limit(entries).select("v").toArrow().column(0).combine_chunks()  # a row an entry
    start = matrix(first, width).reshape(len(first), parts, width // parts)
    books = Codebooks(np.ascontiguousarray(start.transpose(1, 0, 2)))
    for _ in range(rounds):
        books = _moved(rows, books)
    return books


def encode(vectors: DataFrame, books: Codebooks, vector_col: str = "v") -> DataFrame:
    """``vectors`` with code (two hex digits a part) and error (squared distance over all parts) in place of ``vector_col``."""
    kept = vectors.select([F.col(f"`{c}`") for c in vectors.columns if c.lower() not in ("code", "error") or c == vector_col])
    at = kept.columns.index(vector_col)
    schema = T.StructType([*[f for f in kept.schema.fields if f.name != vector_col], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, far = books.assign(matrix(batch.column(at), books.width))
            codes = [r.tobytes().hex() for r in index.astype(np.uint8)]
            columns = [*[c for k, c in enumerate(batch.columns) if k != at], pa.array(codes, pa.string()), pa.array(far.sum(1))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return kept.mapInArrow(run, schema)


def decode(codes: DataFrame, books: Codebooks, code_col: str = "code", vector_col: str = "v") -> DataFrame:
    """``codes`` with the integer vector that each code stands for (null for a null code)."""
    shape = T.StructType([*[f for f in codes.schema.fields if f.name != vector_col], T.StructField(vector_col, T.ArrayType(T.LongType()))])
    kept = codes.select([F.col(f"`{c}`") for c in codes.columns if c != vector_col])
    at = kept.columns.index(code_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = np.arange(books.entries.shape[0])
        for batch in batches:
            made = [None if c is None else books.entries[parts, np.frombuffer(bytes.fromhex(c), np.uint8)].reshape(-1) for c in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.list_(pa.int64()))], names=shape.names)

    return kept.mapInArrow(run, shape)


def with_label_error(rows: DataFrame, label: str = "label") -> DataFrame:
    """``rows`` with label_error: error summed over the rows of a label, null being one. Sums are joined back, so no label is one task."""
    total = rows.groupBy(F.col(label).alias("__label")).agg(F.sum("error").alias("label_error"))
    return rows.join(total, F.col(label).eqNullSafe(F.col("__label"))).drop("__label")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").where(finite(F.col("embedding"))).select("vec_id", "label", integers(F.col("embedding"), SCALE).alias("v"))
    rows = materialize(rows, "vectors")
    books = fit_codebooks(rows, id_col="vec_id")
    if books is None:
        return rows.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    coded = materialize(encode(rows, books), "codes")
    return with_label_error(coded).select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def _oracle() -> str:
    near = "SELECT vec_id, label, part, x, k, d FROM (SELECT p.*, c.k, CAST(list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - c.c[i]) * (p.x[i] - c.c[i]))) AS BIGINT) AS d FROM p JOIN {c} c USING (part)) QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY d, k) = 1"
    text = """
WITH v AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS MATERIALIZED (
  SELECT vec_id, label, part, e[part * len(e) // 8 + 1 : (part + 1) * len(e) // 8] AS x FROM v, (SELECT unnest(range(8)) AS part)
), c0 AS MATERIALIZED (
  SELECT part, k, x AS c FROM p JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS k FROM v QUALIFY k < 16) USING (vec_id)
)"""
    for r in range(1, ROUNDS + 1):
        text += f""", a{r} AS MATERIALIZED ({near.format(c=f"c{r - 1}")}
), m{r} AS (
  SELECT part, k, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS c FROM (
    SELECT part, k, i, CAST(sum(y) AS DOUBLE) AS s, count(*) AS n FROM (SELECT part, k, unnest(x) AS y, unnest(range(len(x))) AS i FROM a{r}) GROUP BY ALL) GROUP BY ALL
), c{r} AS MATERIALIZED (
  SELECT o.part, o.k, coalesce(m.c, o.c) AS c FROM c{r - 1} o LEFT JOIN m{r} m ON o.part = m.part AND o.k = m.k
)"""
    return text + f""", z AS MATERIALIZED ({near.format(c=f"c{ROUNDS}")}), f AS (
  SELECT vec_id, label, string_agg(printf('%02x', k), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM z GROUP BY vec_id, label
), h AS (SELECT sha256(string_agg(y, ',' ORDER BY part, k, i)) AS sha FROM (SELECT part, k, unnest(list_transform(c, lambda x: CAST(x AS VARCHAR))) AS y, unnest(range(len(c))) AS i FROM c{ROUNDS}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, sha AS codebooks_sha256 FROM f, h
"""


ORACLE = _oracle()
