"""Hard-negative mining: product quantisation with stored residual norms, and exact windows.

Each row's integer vector is held twice in its block: as a code of one byte a part, with the norm of what the code leaves over
(rounded up), and as it is. An anchor's inner product with every entry of every part is a lookup table; the sum that a code picks
from it differs from the exact score by the residual's norm times the anchor's at most. So each score has a lower and an upper
bound, and only rows whose range meets what is asked for are scored exactly, in integers, from their vectors:

1. an anchor's positives: rows of its label whose upper bound reaches its k-th best positive so far;
2. for each positive a window of scores: rows of another label whose range meets the window and reaches its k-th best so far.

Both are one pass over the blocks for a group of anchors, which is broadcast with at most ``GROUP_BYTES`` of vectors and
``GROUP_ROWS`` anchors. Tasks hand on the k best that they have, and one ranking completes each window. Codebooks are fitted by
k-means on at most ``FIT_ROWS`` distinct vectors; they decide what is scored, and never what is found.

Cases: rows with a null label, a null vector, or a null or non-finite component take no part. Integer components beyond 2^24 count
as 2^24. Of vectors of different lengths the shorter counts as followed by zeros; an empty vector scores 0. Null ids: such rows
are no anchors; as candidates they come last of equal scores. A repeated id: each row is a candidate; as an anchor the row with the
least label, then vector, asks, once, and none of the id's rows is its positive or negative. Anchors without a positive, and windows
without a row, have no row. A repeated positive has a window for each of its places. Empty tables: no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from taxaspark.llm.common import bounded_sample, materialize, table
from taxaspark.llm.vectors import finite, integers, matrix

#: Dimensions of a part, entries of a codebook, vectors that the codebooks are fitted on, and rounds.
PART, ENTRIES, FIT_ROWS, FIT_ROUNDS = 2, 256, 4096, 6
#: Rows of a block, anchors that meet it at once, and pairs that are scored at once.
BLOCK_ROWS, ANCHOR_ROWS, PAIRS = 4096, 128, 1 << 15
#: Anchors of a broadcast, and bytes of their vectors.
GROUP_ROWS, GROUP_BYTES = 1 << 14, 8 << 20
#: Passes over the blocks in one plan.
PASSES = 16
EXACT = float(1 << 53)


class Quantizer:
    """entries: parts x entries x PART."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries

    @classmethod
    def fit(cls, x: np.ndarray) -> Quantizer:
        """Codebooks by k-means on the rows of ``x``, part by part; the same on every run."""
        parts = max(1, -(-x.shape[1] // PART))
        x = np.pad(x.astype(np.float64), ((0, 0), (0, parts * PART - x.shape[1])))
        books = []
        for p in range(parts):
            part = x[:, p * PART : (p + 1) * PART]
            entries = part[np.random.default_rng(p).permutation(len(part))[:ENTRIES]]
            for _ in range(FIT_ROUNDS):
                near = cls._nearest(part, entries)
                n = np.bincount(near, minlength=len(entries))
                sums = np.stack([np.bincount(near, part[:, d], len(entries)) for d in range(PART)], 1)
                entries = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], entries)
            books.append(entries)
        return cls(np.stack(books))

    @staticmethod
    def _nearest(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
        return np.argmin((entries**2).sum(1) - 2 * x @ entries.T, 1)

    def padded(self, x: np.ndarray) -> np.ndarray:
        parts = self.entries.shape[0]
        return np.pad(x.astype(np.float64), ((0, 0), (0, max(0, parts * PART - x.shape[1]))))

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (n x parts, a byte each) and the norms of what they leave over, rounded up."""
        parts = self.entries.shape[0]
        wide = self.padded(x)
        codes = np.stack([self._nearest(wide[:, p * PART : (p + 1) * PART], self.entries[p]) for p in range(parts)], 1).astype(np.uint8)
        left = wide - np.pad(self.entries[np.arange(parts), codes].reshape(len(x), -1), ((0, 0), (0, wide.shape[1] - parts * PART)))
        norm = np.sqrt((left**2).sum(1)) * (1 + 1e-9)
        return codes, np.nextafter(norm.astype(np.float32), np.float32(np.inf))

    def tables(self, a: np.ndarray) -> np.ndarray:
        """parts x anchors x entries: inner products of each anchor's part with each entry."""
        parts = self.entries.shape[0]
        wide = self.padded(a)[:, : parts * PART].reshape(len(a), parts, PART)
        return np.einsum("apd,pkd->pak", wide, self.entries)


BLOCK = "n long, width long, kind string, ids binary, nulls binary, labels binary, codes binary, residuals binary, data binary"


def pack_blocks(rows: DataFrame, quantizer: Quantizer | None) -> DataFrame:
    """id, label, v -> BLOCK, without codes if there is no quantizer: up to BLOCK_ROWS rows, numbers in the fewest bytes that hold them."""
    names, kinds = zip(*[x.split() for x in BLOCK.split(", ")], strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), BLOCK_ROWS):
                ids, labels, lists = batch.slice(a, BLOCK_ROWS).columns
                x = matrix(lists, int(lists.value_lengths().to_numpy().max(initial=0)))
                kind = next(k for k in ("<i2", "<i4") if not x.size or (np.iinfo(k).min <= x.min() and x.max() <= np.iinfo(k).max))
                codes, left = quantizer.encode(x) if quantizer else (np.zeros(0, np.uint8), np.zeros(0, np.float32))
                made = [len(x), x.shape[1], kind, ids.fill_null(0).to_numpy().tobytes(), ids.is_null().to_numpy(zero_copy_only=False).tobytes(), labels.to_numpy().tobytes(), codes.tobytes(), left.astype("<f4").tobytes(), x.astype(kind).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([m], {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[t]) for m, t in zip(made, kinds, strict=True)], names=list(names))

    return rows.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), "v").mapInArrow(run, BLOCK)


class Rows:
    """A block as it is read back."""

    def __init__(self, n: int, width: int, kind: str, ids: bytes, nulls: bytes, labels: bytes, codes: bytes, residuals: bytes, data: bytes):
        self.ids, self.nulls, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(nulls, bool), np.frombuffer(labels, np.int64)
        self.vectors = np.frombuffer(data, kind).reshape(n, width)
        self.codes, self.residuals = np.frombuffer(codes, np.uint8).reshape(n, -1), np.frombuffer(residuals, "<f4").astype(np.float64)


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of ``a`` with those of ``b``, pair by pair."""
    w = min(a.shape[1], b.shape[1])
    out = np.zeros(len(a), np.int64)
    for k in range(0, len(a), PAIRS):
        out[k : k + PAIRS] = np.einsum("ij,ij->i", a[k : k + PAIRS, :w].astype(np.int64), b[k : k + PAIRS, :w].astype(np.int64))
    return out


class Best:
    """The k best of each of n lists: score, id (null or not), highest scores first, then smaller ids."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.list, self.score, self.id, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        #: What a score must reach to count; below every score while a list isn't full.
        self.reach = np.full(n, np.iinfo(np.int64).min)

    def offer(self, lists: np.ndarray, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        some = score >= self.reach[lists]
        if not some.any():
            return
        own, value = np.concatenate([self.list, lists[some]]), np.concatenate([self.score, score[some]])
        name, bare = np.concatenate([self.id, ids[some]]), np.concatenate([self.null, null[some]])
        order = np.lexsort((name, bare, -value, own))
        own = own[order]
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        rank = np.arange(len(own)) - np.repeat(first, np.diff(np.r_[first, len(own)]))
        keep = order[rank < self.k]
        self.list, self.score, self.id, self.null = own[rank < self.k], value[keep], name[keep], bare[keep]
        last = np.flatnonzero(rank == self.k - 1)
        self.reach[own[last]] = value[order[last]]


class Group:
    """Anchors of a broadcast: ids, labels, vectors and their norms; with windows, each anchor's low and high (anchors x windows)."""

    def __init__(self, quantizer: Quantizer, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, low: np.ndarray | None = None, high: np.ndarray | None = None):
        self.quantizer, self.ids, self.labels, self.vectors, self.low, self.high = quantizer, ids, labels, vectors, low, high
        self.norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))

    def search(self, block: Rows, best: Best) -> int:
        """Offer what ``block`` holds for these anchors; how many pairs were scored."""
        scored = 0
        for a in range(0, len(self.ids), ANCHOR_ROWS):
            part = slice(a, a + ANCHOR_ROWS)
            tables = self.quantizer.tables(self.vectors[part])
            middle = np.zeros((tables.shape[1], len(block.ids)))
            for p in range(tables.shape[0]):
                middle += np.take(tables[p], block.codes[:, p], axis=1)
            # wider than the rounding of these sums
            slack = self.norms[part, None] * (block.residuals[None, :] * (1 + 1e-6)) + 1e-9 * np.abs(middle) + 1
            upper, lower = middle + slack, middle - slack
            alike = self.labels[part, None] == block.labels[None, :]
            other = block.nulls[None, :] | (self.ids[part, None] != block.ids[None, :])
            if self.low is None:
                row, col = np.nonzero(alike & other & (upper >= best.reach[part, None]))
                score = exact_scores(self.vectors[part][row], block.vectors[col])
                scored += len(row)
                best.offer(a + row, score, block.ids[col], block.nulls[col])
                continue
            wanted = []
            n = self.low.shape[1]
            for w in range(n):
                low, high = self.low[part, w], self.high[part, w]
                least = np.maximum(low, best.reach[w::n][part])
                wanted.append(~alike & other & (upper >= least[:, None]) & (lower <= high[:, None]))
            row, col = np.nonzero(reduce(np.logical_or, wanted))
            score = exact_scores(self.vectors[part][row], block.vectors[col])
            scored += len(row)
            for w in range(n):
                inside = wanted[w][row, col] & (score >= self.low[part, w][row]) & (score <= self.high[part, w][row])
                best.offer((a + row[inside]) * n + w, score[inside], block.ids[col[inside]], block.nulls[col[inside]])
        return scored


def _found(blocks: DataFrame, held, n_lists: int, k: int) -> DataFrame:
    """list, id, score: the k best of each list in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(n_lists, k)
        for batch in batches:
            for row in batch.to_pylist():
                held.value.search(Rows(**row), best)
        yield pa.RecordBatch.from_arrays([pa.array(best.list), pa.array(best.id, mask=best.null), pa.array(best.score)], names=["list", "id", "score"])

    return blocks.mapInArrow(run, "list long, id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("list").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _groups(packed: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels and vectors of the anchors, GROUP_ROWS and GROUP_BYTES at most (one row at least); the driver holds a group at a time."""
    held: list[Rows] = []
    size = bytes_ = 0
    for r in packed.toLocalIterator():
        block = Rows(*r)
        step = max(1, min(GROUP_ROWS, GROUP_BYTES // max(1, block.vectors.itemsize * block.vectors.shape[1])))
        for a in range(0, len(block.ids), step):
            part = block.ids[a : a + step], block.labels[a : a + step], block.vectors[a : a + step]
            if held and (size + len(part[0]) > GROUP_ROWS or bytes_ + part[2].nbytes > GROUP_BYTES):
                yield _joined(held)
                held, size, bytes_ = [], 0, 0
            held.append(part)
            size, bytes_ = size + len(part[0]), bytes_ + part[2].nbytes
    if held:
        yield _joined(held)


def _joined(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    width = max(p[2].shape[1] for p in parts)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), np.concatenate([np.pad(p[2], ((0, 0), (0, width - p[2].shape[1]))) for p in parts])


SHAPE = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    ``rows`` and ``anchors`` have id, label (integers) and v (array of int). For each anchor and each of its ``positives`` best rows of
    its own label, the ``negatives`` best rows of other labels with low * positive <= 100 * negative <= high * positive.
    """
    spark = rows.sparkSession
    whole = materialize(rows.select("id", "label", "v").where("label is not null and v is not null"), "rows")
    n = whole.count()
    if not n:
        return spark.createDataFrame([], SHAPE)
    sample = bounded_sample(whole.select("v"), ["v"], FIT_ROWS, 13).toArrow().column(0).combine_chunks()  # FIT_ROWS at most
    quantizer = Quantizer.fit(matrix(sample, int(sample.value_lengths().to_numpy().max(initial=0))))
    parts = max(spark.sparkContext.defaultParallelism * 2, -(-n // (16 * BLOCK_ROWS)))
    blocks = materialize(pack_blocks(whole.repartition(parts), quantizer), "blocks")
    once = anchors.where("id is not null and label is not null and v is not null").groupBy("id").agg(F.min(F.struct("label", "v")).alias("a")).select("id", "a.*")
    asked = materialize(pack_blocks(once, None), "anchors")
    results, made, sent = [], [], []
    for ids, labels, vectors in _groups(asked):
        held = spark.sparkContext.broadcast(Group(quantizer, ids, labels, vectors))
        near = _best(_found(blocks, held, len(ids), positives), positives).toArrow()  # ``positives`` rows an anchor of the group
        held.destroy()
        if not len(near):
            continue
        place = near.column("list").to_numpy() * positives + near.column("rank").to_numpy() - 1
        score = near.column("score").to_numpy()
        # the least and largest integer of the window; an empty one where there is no positive
        least, most = np.ones(len(ids) * positives, np.int64), np.zeros(len(ids) * positives, np.int64)
        least[place], most[place] = -((-low * score) // 100), (high * score) // 100
        held = spark.sparkContext.broadcast(Group(quantizer, ids, labels, vectors, least.reshape(-1, positives), most.reshape(-1, positives)))
        sent.append(held)
        of = spark.createDataFrame(pa.table({"list": pa.array(place), "anchor_id": pa.array(ids[near.column("list").to_numpy()]), "positive_id": near.column("id"), "positive_score": near.column("score")}))
        windows = _best(_found(blocks, held, len(ids) * positives, negatives), negatives).select("list", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        made.append(windows.join(of, "list").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
        if len(made) == PASSES:
            results.append(materialize(reduce(DataFrame.unionAll, made), "windows"))
            for x in sent:
                x.destroy()
            made, sent = [], []
    return reduce(DataFrame.unionAll, [*results, *made]) if results or made else spark.createDataFrame([], SHAPE)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").where(finite(F.col("embedding")) & F.col("label").isNotNull())
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select(F.col("vec_id").alias("id"), label.alias("label"), integers(F.col("embedding"), 256).alias("v"))
    return hard_negatives(rows, rows.where(F.col("id") % 100 == 0))


ORACLE = """
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), t AS MATERIALIZED (SELECT vec_id, unnest(e) AS x, unnest(range(len(e))) AS i FROM v
), s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, c.vec_id, CAST(sum(a.x * c.x) AS BIGINT) AS score FROM t a JOIN t c ON a.i = c.i AND a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0 GROUP BY ALL
), w AS MATERIALIZED (
  SELECT s.*, a.label = c.label AS alike FROM s JOIN v a ON a.vec_id = s.anchor_id JOIN v c ON c.vec_id = s.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM w WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN w ON w.anchor_id = p.anchor_id AND NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10
"""
