"""Line dedup: documents probe sharded minimal perfect hashes over the hashes of frequent lines.

A line's key is the line without ASCII white space at its ends, A-Z in lower case. Keys of ``min_chars`` code points are hashed
twice (128 bits together stand for the key), deduplicated within their document, and counted by one aggregation that also keeps
the largest id. Keys of at least ``min_docs`` documents go to shards by hash. Each shard is built in a task of its own: a minimal
perfect hash (bit arrays by level, a key's slot is the rank of its bit) and, by slot, arrays of fingerprints, counts and owners.
No line's text is shuffled, and no line is joined: documents look their lines' hashes up in the arrays.

The arrays that every document probes are broadcast: at most ``held_bytes`` of them, as measured, with the most frequent keys
first. Of a table with more keys the rest stay where they are, and the hashes that the broadcast arrays don't know are dealt to
them by shard and streamed past them. A key outside of the broadcast is in at most 1 / (keys held) of all lines, so that no shard
gets a hot key.

Cases: a null text is one empty line, like an empty one, and stays null. Each row is a document of its own, whatever its id. A key's
lines stay in every row with the largest id that holds it; null ids are below all others, and equal to each other. A line that
stands twice in a document counts once and goes or stays twice. An empty table: no row. Columns named as a new one are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaspark.llm.common import materialize, mix, table

MIN_CHARS, MIN_DOCS = 40, 5
#: Keys of a shard, about, and bytes of arrays in a broadcast.
SHARD_KEYS = 1 << 16
HELD_BYTES = 32 << 20
#: Bytes that a key's arrays and its bits take: 8 of fingerprint, 8 of owner, 4 of count, and less than 1 of bits.
KEY_BYTES = 21
WHITE = "".join(map(chr, [0x20, *range(0x09, 0x0E)]))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class MinimalHash:
    """A bijection from n distinct pairs of hashes to 0 .. n - 1, in about three bits a pair.

    At each level, pairs that are alone at their bit stay there, and the rest go on to the next level.
    """

    def __init__(self, words: np.ndarray, sizes: np.ndarray):
        """``words``: the levels' bits, one after another; ``sizes``: words of each."""
        self.words, self.sizes = words, sizes
        self.first = np.cumsum(sizes) - sizes
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    @staticmethod
    def _bit(h: np.ndarray, f: np.ndarray, level: int, n_bits: int) -> np.ndarray:
        return (mix(h ^ mix(f + np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (2**64 - 1)))) % np.uint64(n_bits)).astype(np.int64)

    @classmethod
    def build(cls, h: np.ndarray, f: np.ndarray) -> MinimalHash:
        levels = []
        while len(h):
            size = -(-2 * len(h) // 64)
            bit = cls._bit(h, f, len(levels), size * 64)
            alone = np.bincount(bit, minlength=size * 64)[bit] == 1
            bits = np.zeros(size * 64, np.uint8)
            bits[bit[alone]] = 1
            levels.append(np.packbits(bits, bitorder="little").view("<u8"))
            h, f = h[~alone], f[~alone]
        return cls(np.concatenate(levels) if levels else np.zeros(0, "<u8"), np.array([len(x) for x in levels], np.int64))

    def slots(self, h: np.ndarray, f: np.ndarray) -> np.ndarray:
        """The slot of each pair; of a pair that isn't among the n any slot, or -1."""
        out, left = np.full(len(h), -1), np.arange(len(h))
        for level, (first, size) in enumerate(zip(self.first, self.sizes, strict=True)):
            bit = self._bit(h[left], f[left], level, int(size) * 64)
            word, shift = first + (bit >> 6), (bit & 63).astype(np.uint64)
            value = self.words[word]
            there = (value >> shift & np.uint64(1)).astype(bool)
            below = value & ((np.uint64(1) << shift) - np.uint64(1))
            out[left[there]] = (self.before[word] + np.bitwise_count(below))[there]
            left = left[~there]
        return out


SHARD = "shard long, sizes binary, words binary, prints binary, owners binary, counts binary"


class Shard:
    """Fingerprints, owners and counts by slot."""

    def __init__(self, sizes: bytes, words: bytes, prints: bytes, owners: bytes, counts: bytes):
        self.slots = MinimalHash(np.frombuffer(words, "<u8"), np.frombuffer(sizes, "<i8"))
        self.prints, self.owners, self.counts = np.frombuffer(prints, "<u8"), np.frombuffer(owners, "<i8"), np.frombuffer(counts, "<u4")

    @staticmethod
    def packed(h: np.ndarray, f: np.ndarray, owner: np.ndarray, n: np.ndarray) -> list[bytes]:
        slots = MinimalHash.build(h, f)
        at = np.argsort(slots.slots(h, f))
        return [x.tobytes() for x in (slots.sizes.astype("<i8"), slots.words, f[at].astype("<u8"), owner[at].astype("<i8"), np.minimum(n[at], 2**32 - 1).astype("<u4"))]

    def find(self, h: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each pair is here, its owner and its count."""
        if not len(self.prints):
            return np.zeros(len(h), bool), np.zeros(len(h), np.int64), np.zeros(len(h), np.uint32)
        slot = self.slots.slots(h, f)
        known = (slot >= 0) & (self.prints[slot] == f)
        return known, self.owners[slot], self.counts[slot]


class Arrays:
    """Shards by number."""

    def __init__(self, shards: dict[int, Shard], n_shards: int):
        self.shards, self.n_shards = shards, n_shards

    def find(self, h: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        known, owner, count = np.zeros(len(h), bool), np.zeros(len(h), np.int64), np.zeros(len(h), np.uint32)
        if not len(h) or not self.shards:
            return known, owner, count
        shard = (h % np.uint64(self.n_shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
            one = self.shards.get(int(shard[part[0]]))
            if one:
                known[part], owner[part], count[part] = one.find(h[part], f[part])
        return known, owner, count


def line_key(line: Column) -> Column:
    return F.translate(F.trim(line, F.lit(WHITE)), UPPER, LOWER)


def _hashed(docs: DataFrame, text: str, min_chars: int) -> DataFrame:
    """``docs`` with __lines, and the two hashes of each line's key, __h and __f (null for short ones)."""
    keys = F.transform("__lines", line_key)
    hashed = lambda *salt: F.transform("__keys", lambda k: F.when(F.length(k) >= min_chars, F.xxhash64(*salt, k)))
    return docs.withColumn("__lines", F.split(F.coalesce(F.col(text), F.lit("")), "\n")).withColumn("__keys", keys).withColumns({"__h": hashed(), "__f": hashed(F.lit(1))}).drop("__keys")


def _flat(h: pa.Array, f: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, place among all lines, and hashes of the lines that have any."""
    sizes = h.value_lengths().to_numpy()
    values, prints = h.flatten(), f.flatten()
    at = np.flatnonzero(values.is_valid().to_numpy(zero_copy_only=False))
    return np.repeat(np.arange(len(h)), sizes)[at], at, values.drop_null().to_numpy().view(np.uint64), prints.drop_null().to_numpy().view(np.uint64)


def _in_documents(hashed: DataFrame, columns: list[str], kinds: str, known: Arrays | None = None) -> DataFrame:
    """``columns``, h, f: a row for each distinct key of each document; without those that ``known`` finds."""
    held = None if known is None else hashed.sparkSession.sparkContext.broadcast(known)  # at most the measured bytes of the arrays

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, _, h, f = _flat(batch.column("__h"), batch.column("__f"))
            order = np.lexsort((f, h, row))
            row, h, f = row[order], h[order], f[order]
            keep = np.r_[True, (row[1:] != row[:-1]) | (h[1:] != h[:-1]) | (f[1:] != f[:-1])] if len(row) else np.zeros(0, bool)
            if held is not None:
                keep &= ~held.value.find(h, f)[0]
            own = [batch.column(c).take(pa.array(row[keep])) for c in columns]
            yield pa.RecordBatch.from_arrays([*own, pa.array(h[keep].view(np.int64)), pa.array(f[keep].view(np.int64))], names=[*columns, "h", "f"])

    return hashed.select(*columns, "__h", "__f").mapInArrow(run, f"{kinds}, h long, f long")


def frequent_keys(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """h, f, n, owner: hashes of the keys of at least ``min_docs`` documents, how many, and the hash of the largest id."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    found = _in_documents(_hashed(rows, "text", min_chars), ["id"], f"id {kind}")
    counted = found.groupBy("h", "f").agg(F.count("*").alias("n"), F.max("id").alias("id")).where(F.col("n") >= min_docs)
    return counted.select("h", "f", "n", F.xxhash64("id").alias("owner"))


def build_shards(keys: DataFrame, n_shards: int) -> DataFrame:
    """h, f, n, owner -> SHARD: a row for each shard that has a key. A shard is about SHARD_KEYS keys, as hashes are even."""

    def build(group: pa.Table) -> pa.Table:
        h, f, n, owner = (group.column(c).to_numpy() for c in ("h", "f", "n", "owner"))
        made = [[group.column("shard")[0].as_py()], *[[x] for x in Shard.packed(h.view(np.uint64), f.view(np.uint64), owner, n)]]
        return pa.table([pa.array(made[0], pa.int64()), *[pa.array(x, pa.binary()) for x in made[1:]]], names=[x.split()[0] for x in SHARD.split(", ")])

    return keys.withColumn("shard", _shard(F.col("h"), n_shards)).groupBy("shard").applyInArrow(build, SHARD)


def _shard(h: Column, n_shards: int) -> Column:
    """``h`` as an unsigned number modulo ``n_shards``."""
    return F.pmod(F.pmod(h, F.lit(n_shards)) + F.when(h < 0, F.lit((1 << 64) % n_shards)).otherwise(F.lit(0)), F.lit(n_shards)).cast("long")


def _cut(keys: DataFrame, held: int) -> int:
    """The least count such that at most ``held`` keys have it or more."""
    bucket = F.floor(F.log2("n") * 8)
    rows = keys.groupBy(bucket.alias("b")).agg(F.count("*").alias("k"), F.min("n").alias("low")).orderBy(F.desc("b")).collect()  # 8 rows a doubling of the count: 512 at most
    cut, total = (1 << 63) - 1, 0
    for r in rows:
        total += r["k"]
        if total > held:
            break
        cut = r["low"]
    return cut


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, held_bytes: int = HELD_BYTES) -> DataFrame:
    """``docs`` with ``text`` less its repeated lines, n_lines (before) and n_dropped."""
    spark = docs.sparkSession
    docs = docs.select([F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")])
    keys = materialize(frequent_keys(docs, id_col, text, min_chars, min_docs), "keys")
    n_keys = keys.count()
    n_shards = max(1, -(-n_keys // SHARD_KEYS))
    most = n_keys * KEY_BYTES <= held_bytes
    cut = 0 if most else _cut(keys, held_bytes // KEY_BYTES)
    shards = {int(r[0]): Shard(*map(bytes, r[1:])) for r in build_shards(keys.where(F.col("n") >= cut), n_shards).toLocalIterator()}  # held_bytes at most
    known = Arrays(shards, n_shards)
    held = spark.sparkContext.broadcast(known)

    @F.arrow_udf("array<boolean>")
    def repeated(own: pa.Array, h: pa.Array, f: pa.Array) -> pa.Array:
        row, at, h_, f_ = _flat(h, f)
        found, owner, count = held.value.find(h_, f_)
        flags = np.zeros(len(h.flatten()), bool)
        flags[at] = found & (count >= min_docs) & (owner != own.to_numpy()[row])
        sizes = h.value_lengths().to_numpy()
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(flags))

    hashed = _hashed(docs, text, min_chars).withColumn("__own", F.xxhash64(f"`{id_col}`"))
    flagged = hashed.withColumn("__gone", repeated("__own", "__h", "__f"))
    if not most:
        flagged = _with_the_rest(flagged, text, keys.where(F.col("n") < cut), known, n_shards)
    kept = F.array_join(F.filter("__lines", lambda x, i: ~F.get("__gone", i)), "\n")
    new = {text: F.when(F.col(text).isNotNull(), kept), "n_lines": F.size("__lines").cast("long"), "n_dropped": F.size(F.filter("__gone", lambda g: g)).cast("long")}
    return flagged.withColumns(new).select(*docs.columns, "n_lines", "n_dropped")


def _with_the_rest(flagged: DataFrame, text: str, keys: DataFrame, known: Arrays, n_shards: int) -> DataFrame:
    """``flagged`` with the lines, too, whose keys aren't in the broadcast arrays ``known``.

    Of each document (its id and its text stand for it, each as a hash) the hashes that ``known`` doesn't find go to the shard's
    arrays, which stand first in their partition; what is found there comes back as a set of at most the document's keys.
    """
    who = {"__text": F.xxhash64(F.col(text)), "__more": F.xxhash64(F.lit(1), F.col(text))}
    names = ["__own", *who]
    flagged = flagged.withColumns(who)
    arrays = build_shards(keys, n_shards)
    asked = _in_documents(flagged, names, ", ".join(f"{c} long" for c in names), known).withColumn("shard", _shard(F.col("h"), n_shards))
    both = arrays.withColumn("kind", F.lit(0)).unionByName(asked.withColumn("kind", F.lit(1)), allowMissingColumns=True)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard = -1, None
        for batch in batches:
            ids = batch.column("shard").to_numpy()
            kind = batch.column("kind").to_numpy()
            for part in np.split(np.arange(len(ids)), np.flatnonzero((np.diff(ids) != 0) | (np.diff(kind) != 0)) + 1):
                a, n = int(part[0]), len(part)
                if kind[a] == 0:
                    number, shard = ids[a], Shard(*(batch.column(c)[a].as_py() for c in ("sizes", "words", "prints", "owners", "counts")))
                    continue
                if ids[a] != number:
                    continue  # no key of this shard is left
                piece = batch.slice(a, n)
                h, f, own = (piece.column(c).to_numpy() for c in ("h", "f", "__own"))
                found, owner, _ = shard.find(h.view(np.uint64), f.view(np.uint64))
                yield piece.filter(pa.array(found & (owner != own))).select([*names, "h", "f"])

    dealt = both.repartition("shard").sortWithinPartitions("shard", "kind")
    gone = dealt.mapInArrow(probe, ", ".join(f"{c} long" for c in [*names, "h", "f"]))
    sets = gone.groupBy(*names).agg(F.collect_set(F.struct("h", "f")).alias("__set"))
    back = flagged.join(sets.withColumnsRenamed({c: f"{c}_" for c in names}), [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in names], "left").drop(*[f"{c}_" for c in names])

    @F.arrow_udf("array<boolean>")
    def more(gone: pa.Array, h: pa.Array, f: pa.Array, found: pa.Array) -> pa.Array:
        flags = gone.flatten().to_numpy(zero_copy_only=False).copy()
        row, at, h_, f_ = _flat(h, f)
        sizes = found.value_lengths().fill_null(0).to_numpy()
        owner, pairs = np.repeat(np.arange(len(found)), sizes), found.flatten()
        left = np.rec.fromarrays([row, h_, f_])
        right = np.rec.fromarrays([owner, pairs.field("h").to_numpy().view(np.uint64), pairs.field("f").to_numpy().view(np.uint64)])
        flags[at] |= np.isin(left, right)
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(h.value_lengths().to_numpy())].astype(np.int32)), pa.array(flags))

    return back.withColumn("__gone", more("__gone", "__h", "__f", "__set"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents
), k AS (
  SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), f AS (
  SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), g AS (
  SELECT doc_id, line, i, last IS NOT NULL AND last <> doc_id AS gone FROM k LEFT JOIN f USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM g GROUP BY doc_id
"""
