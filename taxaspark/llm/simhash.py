"""SimHash near-duplicates: BK-trees over shards of fingerprints.

A text's fingerprint has the bits that more than half of its shingles' XXH64 hashes have. Equal texts (or, without a similarity,
equal fingerprints) are one node. Nodes are dealt to shards so that each pair sought meets in one at least:

* Without a similarity, links are all pairs of fingerprints within ``radius`` bits. 64 bits fall into radius + 1 blocks; two such
  fingerprints agree on one whole block, so that a shard is all fingerprints with one value of one block. Shards over ``SHARD``
  nodes are split again by blocks of the bits that are left, up to ``LEVELS`` times. This loses nothing.
* With a similarity, links are pairs of that Jaccard similarity of their shingle sets, or more. Shards are the nodes that share
  the least shingle under one of ``ORDERS`` seeded orders: a pair of similarity s meets with chance 1 - (1 - s)^ORDERS, 0.99994
  at 0.8. A shard's tree is searched within ``radius`` bits first (of fingerprints that count each shingle once), which joins most
  of what belongs together; pairs that are still apart then have their common shingles counted from lists of who holds what. The
  similarity of the whole sets (40 bits of each shingle's hash) decides for texts of any length. Samples of about 2,048 hashes
  only spare the trees' search pairs of long texts that look dissimilar; the counts decide on those.

Shards over ``SHARD`` nodes of the second kind are split by classes of length first, which loses nothing: similar sets have
similar lengths. Shards with the same nodes are searched once. A shard is a Burkhard-Keller tree: a node's children are keyed by their distance
from it, and a search within r follows from a node at distance d only the edges d - r to d + r.

What still has over ``SHARD`` nodes or ``SHARD_HASHES`` hashes is cut into parts, in two rounds. In the first, each part is a tree
of its own with the shard's pivot node in it. Components of what that finds leave most nodes of a shard in one component; links
are missing only between different ones, so that in the second round the nodes outside of a shard's largest component are built
into trees, which are broadcast in rounds of ``BROADCAST_BYTES`` as measured, and all other nodes search them where they
are. Beyond ``ROUNDS`` of them these nodes go to the tasks of all parts. Tasks hand on links that span what they found. Components come
from :mod:`taxaspark.llm.components`.

Cases: null or empty text and text of white space: fingerprint 0; such texts are copies of each other, and linked like any
other. Fewer words than a shingle: the whole sequence. Repeated rows, null ids: each row is marked; a component's id is the
least id that isn't null. Very long texts: bits are summed in parts. Empty table: no row.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaspark.llm.common import materialize, mix, table
from taxaspark.llm.components import components

#: Nodes of a part of a shard, and with a similarity the hashes of their sets.
SHARD = 256
SHARD_HASHES = 1 << 20
#: How often shards are split by bits.
LEVELS = 3
#: Bytes of fingerprints and sets that one broadcast has at most.
BROADCAST_BYTES = 16 << 20
#: Broadcasts of that size, one after the other, before nodes are shuffled instead.
ROUNDS = 64
ORDERS = 6
SKETCH = 2048
SEED = 42
#: Rows that a task gathers before it builds trees, if the groups are small.
BATCH_ROWS = 1 << 14
BATCH_BYTES = 16 << 20
#: Entries of lists of holders that are counted at once.
PIECE = 1 << 20
#: Bytes of a hash in a whole set.
WIDTH = 5


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 of each shingle, repeats included."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    h = xxhash.xxh64_intdigest
    n = len(words) - size + 1
    if n <= 1:
        return np.array([h(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    return np.fromiter((h(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[size - 1 :].tolist(), strict=True)), np.uint64, n)


def fingerprint(hashes: np.ndarray) -> int:
    if not len(hashes):
        return 0
    count = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 14):
        part = np.ascontiguousarray(hashes[a : a + (1 << 14)], "<u8")
        count += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * count > len(hashes), bitorder="little").view("<u8")[0])


def least_shingles(hashes: np.ndarray) -> list[int]:
    """The least hash under each of ORDERS seeded orders, tagged with the order; a text without shingles has none."""
    return [int(mix(mix(hashes ^ np.uint64(0x9E37 + k)).min(keepdims=True) + np.uint64(k)).view(np.int64)[0]) for k in range(ORDERS)] if len(hashes) else []


def sketch(hashes: np.ndarray) -> bytes:
    """Level, then the sorted distinct 32-bit hashes under 2^(32 - level); all at level 0 of up to SKETCH distinct ones."""
    return sampled((mix(hashes) >> np.uint64(32)).astype(np.uint32))


def sampled(hashes: np.ndarray) -> bytes:
    """The sketch of 32-bit hashes."""
    low = np.unique(hashes)
    level = 0
    while len(low) >> level > SKETCH:
        level += 1
    return bytes([level]) + low[: np.searchsorted(low, 1 << (32 - level))].tobytes() if level else b"\0" + low.tobytes()


def similarity(a: bytes, b: bytes) -> float:
    level = max(a[0], b[0])
    x, y = np.frombuffer(a, np.uint32, offset=1), np.frombuffer(b, np.uint32, offset=1)
    if level:
        x, y = x[: np.searchsorted(x, 1 << (32 - level))], y[: np.searchsorted(y, 1 << (32 - level))]
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / max(1, len(x) + len(y) - both) if len(x) or len(y) else 1.0


def whole_set(hashes: np.ndarray) -> bytes:
    """The first WIDTH bytes of the mixed hashes, sorted and distinct."""
    kept = np.unique(mix(hashes) >> np.uint64(64 - 8 * WIDTH))
    return kept.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - WIDTH :].tobytes()


def set_hashes(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // WIDTH, 8), np.uint8)
    out[:, 8 - WIDTH :] = np.frombuffer(data, np.uint8).reshape(-1, WIDTH)
    return out.view(">u8").ravel().astype(np.uint64)


def alike(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    """Whether two sorted sets have a similarity of ``least``."""
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= least * (len(a) + len(b) - both)


class Forest:
    """BK-trees of many groups at once, level by level: ``pivot`` has each tree node's row, ``edge`` parent * 128 + distance."""

    def __init__(self, prints: np.ndarray, rows: np.ndarray, group: np.ndarray, n_groups: int):
        """``rows``: those to go into trees, sorted by ``group`` (one number for each of them)."""
        pivots, edges = [], []
        # before its first level, a tree is the slot of its group's number; groups without rows have no pivot
        slot, made = group.astype(np.int64), n_groups
        pivot = np.full(n_groups, -1, np.int64)
        first = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]]) if len(rows) else np.zeros(0, np.int64)
        pivot[slot[first]] = rows[first]
        pivots.append(pivot)
        all_pivots = pivot
        while len(rows):
            rest = np.ones(len(rows), bool)
            rest[first] = False
            rows, slot = rows[rest], slot[rest]
            if not len(rows):
                break
            key = slot * 128 + np.bitwise_count(prints[rows] ^ prints[all_pivots[slot]])
            order = np.argsort(key, kind="stable")
            rows, key = rows[order], key[order]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            edges.append(key[first])
            slot = made + np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(rows)]))
            made += len(first)
            pivots.append(rows[first])
            all_pivots = np.concatenate(pivots)
        self.prints, self.pivot = prints, all_pivots
        self.edge = np.concatenate(edges) if edges else np.zeros(0, np.int64)
        self.base = n_groups

    def over(self, prints: np.ndarray) -> Forest:
        """The same trees where more rows stand behind those that they were built from."""
        out = object.__new__(Forest)
        out.prints, out.pivot, out.edge, out.base = prints, self.pivot, self.edge, self.base
        return out

    def within(self, rows: np.ndarray, group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row asked for, row found) for all at most ``radius`` bits apart, in pieces."""
        asked, slot = rows, group.astype(np.int64)
        live = self.pivot[slot] >= 0
        asked, slot = asked[live], slot[live]
        while len(asked):
            d = np.bitwise_count(self.prints[asked] ^ self.prints[self.pivot[slot]]).astype(np.int64)
            near = d <= radius
            yield asked[near], self.pivot[slot[near]]
            lo = np.searchsorted(self.edge, slot * 128 + np.maximum(d - radius, 0), "left")
            hi = np.searchsorted(self.edge, slot * 128 + np.minimum(d + radius, 64), "right")
            n = hi - lo
            asked = np.repeat(asked, n)
            slot = self.base + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)


class Union:
    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def links_of_groups(number: np.ndarray, side: np.ndarray, node: np.ndarray, prints: np.ndarray, whole: list[np.ndarray] | None, radius: int, least: float | None, forest: Forest | None = None, held: dict[int, Holders] | None = None) -> list[tuple[int, int]]:
    """Links that span what whole groups hold. ``number``: each row's group, 0 upwards. ``side``: bit 1 goes into the tree, bit 2 asks.

    ``whole``: the rows' sets, if links take a similarity. Rows are sorted by group; with ``forest`` and ``held``, made of the trees'
    rows before, these come first and the others are in any order.
    """
    looks: dict[int, bytes] = {}

    def look(i: int) -> bytes:
        if i not in looks:
            looks[i] = sampled((whole[i] >> np.uint64(8 * WIDTH - 32)).astype(np.uint32))
        return looks[i]

    in_tree, asks = np.flatnonzero(side & 1), np.flatnonzero(side & 2)
    forest = forest.over(prints) if forest else Forest(prints, in_tree, number[in_tree], int(number[-1]) + 1 if len(number) else 0)
    union, out, tried = Union(), [], set()
    for a in range(0, len(asks), SHARD):
        part = asks[a : a + SHARD]
        for q, p in forest.within(part, number[part], radius):
            one_way = (node[q] > node[p]) | ((side[q] != 3) & (node[q] != node[p]))  # where both ask, a pair comes twice
            for x, y in zip(q[one_way].tolist(), p[one_way].tolist(), strict=True):
                m, n = int(node[x]), int(node[y])
                if union.find(m) == union.find(n):
                    continue
                if least is not None:
                    if (m, n) in tried or (len(whole[x]) > SKETCH and len(whole[y]) > SKETCH and similarity(look(x), look(y)) < least) or not alike(whole[x], whole[y], least):
                        if len(tried) >= BATCH_ROWS:  # a memory of what needn't be tried again
                            tried.clear()
                        tried.add((m, n))
                        continue
                union.join(m, n)
                out.append((m, n))
    if least is not None:
        out += far_links(number, side, node, whole, union, least, held)
    return out


class Holders:
    """Who holds which hash: the hashes of some sets, sorted, and for each the number of its set."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.fromiter(map(len, sets), np.int64, len(sets))
        hashes, holder = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.int32), self.size)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.holder = hashes[order], holder[order]

    def common(self, mine: np.ndarray) -> np.ndarray:
        """How many hashes each set shares with the set ``mine``; looked up in pieces of PIECE entries, about."""
        lo = np.searchsorted(self.hashes, mine, "left")
        n = np.searchsorted(self.hashes, mine, "right") - lo
        both, ends, i = np.zeros(len(self.size), np.int64), np.cumsum(n), 0
        while i < len(n):
            j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + PIECE, "right")))
            k = n[i:j]
            both += np.bincount(self.holder[np.arange(k.sum()) + np.repeat(lo[i:j] - np.cumsum(k) + k, k)], minlength=len(both))
            i = j
        return both


def far_links(number: np.ndarray, side: np.ndarray, node: np.ndarray, whole: list[np.ndarray], union: Union, least: float, held: dict[int, Holders] | None = None) -> list[tuple[int, int]]:
    """Links among what ``union`` hasn't joined, whatever their fingerprints: every pair of a group is decided on its sets.

    ``held`` has the holders of a group's tree rows, in their order, and gets those that it lacks.
    """
    out = []
    if len(number) and (np.diff(number) < 0).any():
        order = np.argsort(number, kind="stable")
        number, side, node, whole = number[order], side[order], node[order], [whole[i] for i in order.tolist()]
    cut = np.flatnonzero(np.r_[True, number[1:] != number[:-1], True]) if len(number) else np.zeros(1, np.int64)
    for a, b in zip(cut.tolist(), cut[1:].tolist(), strict=False):
        tree, asks = (a + np.flatnonzero(side[a:b] & bit) for bit in (1, 2))
        if not len(tree) or not len(asks) or len({union.find(m) for m in node[a:b].tolist()}) == 1:
            continue
        group = int(number[a])
        holders = held.get(group) if held is not None else None
        if holders is None:
            holders = Holders([whole[i] for i in tree.tolist()])
            if held is not None:
                held[group] = holders
        for q in asks.tolist():
            both = holders.common(whole[q])
            for p in tree[both >= least * (len(whole[q]) + holders.size - both)].tolist():
                link = int(node[q]), int(node[p])
                if union.join(*link):
                    out.append(link)
    return out


def prints_of(docs: DataFrame, shingle: int, similar: bool, text: str, key: str) -> DataFrame:
    """id, text_hash, node, print (fingerprint as long); with ``similar`` also keys, shingles (the whole set) and n_shingles.

    With ``similar`` the fingerprint counts each shingle once, and else as often as it stands in the text.
    """
    rows = docs.select(F.col(key).alias("id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, nodes, keys, sets = [], [], [], []
            for t in batch.column(2).to_pylist():
                h = shingle_hashes(t, shingle)
                if similar:
                    h = np.unique(h)
                prints.append(fingerprint(h))
                if similar:
                    nodes.append(xxhash.xxh64_intdigest(b" ".join((t or "").encode("utf-8", "replace").lower().split()), 7))
                    keys.append(least_shingles(h))
                    sets.append(whole_set(h))
            p = pa.array(np.array(prints, np.uint64).view(np.int64))
            more = [pa.array(np.array(nodes, np.uint64).view(np.int64)), p, pa.array(keys, pa.list_(pa.int64())), pa.array(sets, pa.binary()), pa.array([len(x) // WIDTH for x in sets], pa.int64())] if similar else [p, p]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *more], names=names)

    names = ["id", "text_hash", "node", "print", *(["keys", "shingles", "n_shingles"] if similar else [])]
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, text_hash long, node long, print long" + (", keys array<long>, shingles binary, n_shingles long" if similar else ""))


def _bits(column: Column, start: Column, size: Column) -> Column:
    """``size`` (under 64) bits of a long from ``start`` (under 64) on."""
    ones = F.call_function("shiftleft", F.lit(1).cast("long"), size) - 1
    return F.call_function("shiftrightunsigned", column, start).bitwiseAND(ones)


def split_by_bits(rows: DataFrame, radius: int) -> DataFrame:
    """key, rest, width, node, print -> the same, a row for each of radius + 1 blocks of the ``width`` bits ``rest``.

    The key takes up the block's number and value, and ``rest`` loses its bits.
    """
    blocks = []
    for j in range(radius + 1):
        a, b = (F.floor(F.col("width") * k / (radius + 1)).cast("int") for k in (j, j + 1))
        above = F.when(b >= 64, F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", F.call_function("shiftrightunsigned", F.col("rest"), b), a))
        blocks.append(F.struct(F.xxhash64("key", F.lit(j), _bits(F.col("rest"), a, b - a)).alias("key"), above.bitwiseOR(_bits(F.col("rest"), F.lit(0), a)).alias("rest"), (F.col("width") - b + a).alias("width")))
    return rows.select("node", "print", F.explode(F.array(*blocks)).alias("b")).select("b.key", "b.rest", "b.width", "node", "print")


def split_by_length(rows: DataFrame, least: float) -> DataFrame:
    """key, node, print, n -> the same, a row for each of two classes of lengths ``n`` (1 at least), which the key takes up.

    Classes are 1 / ``least`` wide, and sets of a similarity of ``least`` differ in length by that factor at most: they lie in one
    class or in neighbouring ones, so that a node goes to its own class and to the next, and no pair is lost.
    """
    width = 1e-9 - math.log(least) if least > 0 else math.inf
    own = F.floor(F.log(F.col("n").cast("double")) / width).cast("long")
    return rows.select("node", "print", "n", F.explode(F.array(own, own + 1)).alias("class"), F.col("key").alias("of")).select(F.xxhash64("of", "class").alias("key"), "node", "print", "n")


def shards_of(nodes: DataFrame, radius: int, least: float | None) -> DataFrame:
    """key, parts, node, print: the shards that have two nodes or more, those with the same nodes once."""
    if least is not None:
        rows = nodes.select("node", "print", "n", F.explode("keys").alias("key"))
        hot = materialize(rows.groupBy("key").agg(F.count("*").alias("count")).where(F.col("count") > SHARD).select("key"), "hot-keys")
        return _sized(rows.join(hot, "key", "left_anti"), None).unionAll(_sized(split_by_length(rows.join(hot, "key"), least), None))
    live = nodes.select(F.lit(0).cast("long").alias("key"), F.col("print").alias("rest"), F.lit(64).alias("width"), "node", "print")
    if radius == 0:
        return live.limit(0).select("key", F.lit(1).alias("parts"), "node", "print")
    done = []
    for level in range(LEVELS):
        rows = split_by_bits(live, radius).withColumn("n", F.lit(0))
        if level == LEVELS - 1:
            return reduce(DataFrame.unionAll, [*done, _sized(rows, None)])
        sizes = materialize(rows.groupBy("key").agg(F.count("*").alias("count")).where(F.col("count") > SHARD).select("key"), "hot")
        done.append(_sized(rows, SHARD))
        if not sizes.limit(1).count():
            return reduce(DataFrame.unionAll, done)
        live = materialize(rows.join(sizes, "key").select("key", "rest", "width", "node", "print"), "split")


def _sized(rows: DataFrame, most: int | None) -> DataFrame:
    """key, parts, node, print of the rows whose key has 2 nodes or more (and ``most`` at most), of keys with equal nodes one."""
    sums = [F.sum(F.shiftright(F.xxhash64(F.lit(k), "node"), 20)).alias(f"sum{k}") for k in (1, 2)]
    sizes = rows.groupBy("key").agg(F.count("*").alias("count"), F.sum("n").alias("n"), *sums).where("count > 1")
    if most is not None:
        sizes = sizes.where(F.col("count") <= most)
    sizes = sizes.groupBy("count", "n", "sum1", "sum2").agg(F.min("key").alias("key"))
    parts = F.greatest(F.ceil(F.col("count") / SHARD), F.least("count", F.ceil(F.col("n") / SHARD_HASHES))).cast("int")
    return rows.join(sizes.select("key", parts.alias("parts")), "key").select("key", "parts", "node", "print")


def near_duplicates(docs: DataFrame, shingle: int = 5, radius: int = 24, least: float | None = 0.8, text: str = "text", key: str = "doc_id") -> DataFrame:
    """A row for each of ``docs``: id, text_hash (XXH64 of the text), node, fingerprint (16 hex digits), component_id.

    ``least``: the similarity that a link takes; None: all fingerprints within ``radius`` are linked.
    """
    if least is None and not 0 <= radius < 16:
        raise ValueError("without a similarity the radius is 0 to 15")
    made = materialize(prints_of(docs, shingle, least is not None, text, key).withColumn("row", F.monotonically_increasing_id()), "prints")
    more = [F.first("keys").alias("keys"), F.first("n_shingles").alias("n")] if least is not None else []
    nodes = materialize(made.groupBy("node").agg(F.min("print").alias("print"), F.min("id").alias("rep"), F.min("row").alias("row"), *more), "nodes")
    shards = materialize(shards_of(nodes, radius, least), "shards")

    def with_sets(rows: DataFrame) -> DataFrame:
        """With the shingles of one row of each node, where links take a similarity."""
        if least is None:
            return rows
        return rows.join(nodes.select("node", "row"), "node").join(made.select("row", "shingles"), "row").drop("row")

    def search(rows: DataFrame) -> DataFrame:
        """a, b: links that span what each group of ``rows`` (group, side, node, print) holds."""
        columns = ["group", "side", "node", "print", *(["shingles"] if least is not None else [])]
        return with_sets(rows).select(columns).repartition("group").sortWithinPartitions("group", "side").mapInArrow(_group_by_group(radius, least), "a long, b long")

    part = F.pmod(F.xxhash64("node", F.lit(5)), F.col("parts")).cast("int")
    group = F.xxhash64("key", "part").alias("group")
    cut = shards.withColumn("part", part)
    pivots = cut.where("parts > 1").groupBy("key", "parts").agg(F.min(F.struct(F.xxhash64("node").alias("order"), "node", "print", "part")).alias("p"))
    pivots = pivots.select("key", "p.node", "p.print", F.col("p.part").alias("own"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).where("part <> own")
    first = cut.select(group, F.lit(3).alias("side"), "node", "print").unionAll(pivots.select(group, F.lit(1).alias("side"), "node", "print"))
    roots = components(search(first))

    hot = cut.where("parts > 1").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    of_root = hot.groupBy("key", "root").agg(F.count("*").alias("count"))
    largest = of_root.groupBy("key").agg(F.max(F.struct("count", "root")).alias("r"), F.count("*").alias("n")).where("n > 1").select("key", F.col("r.root").alias("largest"))
    hot = materialize(hot.join(largest, "key").select("key", "parts", "part", "node", "print", (F.col("root") != F.col("largest")).alias("apart")), "hot")
    apart = hot.where("apart")
    weight = F.lit(32) if least is None else 32 + WIDTH * F.col("n")
    weighed = (apart if least is None else apart.join(nodes.select("node", "n"), "node")).select("node", weight.alias("bytes"))
    size = weighed.agg(F.sum("bytes")).first()[0]
    if size is not None:  # else no shard was cut into parts, or each is in one component
        rounds = _rounds(weighed, size)
        if rounds:
            asking = with_sets(hot.select("key", "node", "print"))
            built = with_sets(apart.select("key", "node", "print")).withColumn("round", _round_of(rounds))
            if rounds > 1:
                asking, built = materialize(asking, "asking"), materialize(built, "built")
            found = []
            for k in range(rounds):  # one broadcast at a time is held
                links, held = _search_broadcast(built.where(F.col("round") == k), asking, radius, least)
                found.append(materialize(links, "links"))
                held.destroy()
            more_links = reduce(DataFrame.unionAll, found)
        else:
            asks = apart.withColumn("own", F.col("part")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).where("part <> own")
            more_links = search(hot.select(group, F.lit(1).alias("side"), "node", "print").unionAll(asks.select(group, F.lit(2).alias("side"), "node", "print")))
        roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(more_links))

    rooted = nodes.select("node", "rep").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    labels = rooted.join(rooted.groupBy("root").agg(F.min("rep").alias("component_id")), "root").select("node", "root", "component_id")
    narrow = made.select("id", "text_hash", "node", "print")
    return narrow.join(labels, "node").select("id", "text_hash", "node", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id", "root")


def _round_of(rounds: int) -> Column:
    return F.pmod(F.xxhash64("node", F.lit(6)), F.lit(rounds)).cast("int")


def _rounds(weighed: DataFrame, size: int) -> int:
    """Into how many rounds ``weighed`` (node, bytes) is cut so that each has BROADCAST_BYTES at most; 0: over ROUNDS."""
    rounds = 1
    while rounds <= ROUNDS:
        if size <= rounds * BROADCAST_BYTES and weighed.groupBy(_round_of(rounds).alias("round")).agg(F.sum("bytes").alias("bytes")).agg(F.max("bytes")).first()[0] <= BROADCAST_BYTES:
            return rounds
        rounds *= 2
    return 0


def _sets(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [set_hashes(x.as_buffer()) for x in column]


def _links_batch(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a = np.array(found, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], names=["a", "b"])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of about BATCH_ROWS rows or BATCH_BYTES."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= BATCH_ROWS or sum(b.nbytes for b in held) >= BATCH_BYTES:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _group_by_group(radius: int, least: float | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Over rows of group, side, node, print and shingles, sorted by group and side: the links of each group.

    Those that go into a group's tree come first, and are a part's. Those that only ask, however many, go by in pieces.
    """

    def links(t: pa.Table) -> pa.RecordBatch:
        column = lambda k: t.column(k).to_numpy()
        number = np.cumsum(np.r_[False, np.diff(column(0)) != 0])
        return _links_batch(links_of_groups(number, column(1), column(2), column(3).view(np.uint64), _sets(t.column(4)) if least is not None else None, radius, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.Table] = []
        for t in _gathered(batches):
            t = pa.concat_tables([*rest, t]).combine_chunks()
            group = t.column(0).to_numpy()
            cut = int(np.searchsorted(group, group[-1], "left"))  # the last group may go on
            if cut:
                yield links(t.slice(0, cut))
            last = t.slice(cut)
            in_tree = int(np.searchsorted(last.column(1).to_numpy(), 2, "left")) if last.column(1)[len(last) - 1].as_py() == 2 else len(last)
            if in_tree < len(last):
                yield links(last)
                last = last.slice(0, in_tree)
            rest = [last]
        if rest and len(rest[0]):
            yield links(rest[0])

    return run


def _search_broadcast(apart: DataFrame, rows: DataFrame, radius: int, least: float | None) -> tuple[DataFrame, Broadcast]:
    """a, b: links between ``rows`` and the nodes ``apart`` of the same key; trees of the latter are built once and broadcast.

    Also the broadcast, which is to be destroyed when the links are written.
    """
    columns = ["key", "node", "print", *(["shingles"] if least is not None else [])]
    asked = apart.select(columns).toArrow().sort_by("key").combine_chunks()  # BROADCAST_BYTES at most, as measured
    keys, number = np.unique(asked.column(0).to_numpy(), return_inverse=True)
    prints = asked.column(2).to_numpy().view(np.uint64)
    sets = asked.column(3).to_pylist() if least is not None else None
    forest = Forest(prints, np.arange(len(prints)), number, len(keys))
    held = rows.sparkSession.sparkContext.broadcast((keys, number, asked.column(1).to_numpy(), prints, sets, forest))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, number, node, prints, sets, forest = held.value
        whole = [set_hashes(x) for x in sets] if least is not None else None
        holders: dict[int, Holders] = {}  # of the groups met so far: with the sets, a few times the size of the broadcast
        for t in _gathered(batches):
            t = t.filter(np.isin(t.column(0).to_numpy(), keys))
            column = lambda k, t=t: t.column(k).to_numpy()
            side = np.r_[np.full(len(node), 1), np.full(len(t), 2)]
            both = whole + _sets(t.column(3)) if least is not None else None
            found = links_of_groups(np.r_[number, np.searchsorted(keys, column(0))], side, np.r_[node, column(1)], np.r_[prints, column(2).view(np.uint64)], both, radius, least, forest, holders)
            yield _links_batch(found)

    return rows.select(columns).mapInArrow(run, "a long, b long"), held


def one_of_each(docs: DataFrame, marks: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The row of ``docs`` with the least id of each component; of its repeated rows one stays."""
    kept = marks.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")).alias("k")).select(F.col("k.id").alias("__id"), F.col("k.text_hash").alias("__hash"))
    hashed = docs.withColumn("__text_hash", F.xxhash64(F.col(text)))
    found = hashed.join(kept, F.col(key).eqNullSafe(F.col("__id")) & (F.col("__text_hash") == F.col("__hash")), "left_semi")
    return found.dropDuplicates([key, "__text_hash"]).select(docs.columns)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marks = near_duplicates(docs, shingle=3, radius=2, least=None)
    return marks.select(F.col("id").alias("doc_id"), "fingerprint", "component_id")
