"""Mixing overlapping sources to target weights: a min-cost flow over membership patterns, then a seeded choice of documents.

1. Documents with the same set of sources form a pattern; one aggregation gives each pattern's words.
2. A flow routes words from patterns to the sources' targets. A pattern offers its words once for each repetition allowed, and
   each further repetition costs more than the last, so that words are repeated only where no fresh ones can go.
3. A pattern's flow is so many whole passes over its documents and a rest. For the rest, documents are taken in the order of a
   seeded hash of their id, up to the document that brings the sum nearest. A histogram of the hash finds the part of its
   range where the rest ends, and only documents in that part are ordered, so that a hot source needs no ordering of its own.

The driver holds a row for each pattern; more than ``MAX_PATTERNS`` raise an error.

Cases: null text: size 0. Null source: a source of its own, after all others. No source (an empty list): taken 0, target null.
Size 0: taken 0. Rows with the same id have the same hash and are chosen together. Empty table: no row. All sizes 0: targets 0.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from taxaspark.llm.common import materialize, table

MAX_PATTERNS = 50_000
WORD = r"[^\x20\x09-\x0D]+"
#: Hex digits of the hash that number the parts of its range.
PART_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def by_code_point(source: str | None) -> tuple:
    return (source is None, source or "")


def water_fill(sizes: dict[str | None, int], weight: Callable[[int], float], share: float, most: float) -> dict[str | None, float]:
    """Targets: ``share`` of all words by weight, none above ``most`` times its source, the excess shared again by weight."""
    order = sorted(sizes, key=by_code_point)
    w = {s: weight(i) for i, s in enumerate(order)}
    target, left, open_ = {}, share * sum(sizes.values()), list(order)
    while open_:
        total = sum(w[s] for s in open_)
        over = [s for s in open_ if left * w[s] / total > most * sizes[s]]
        if not over:
            return target | {s: left * w[s] / total for s in open_}
        for s in over:
            target[s] = float(most * sizes[s])
        left, open_ = left - sum(target[s] for s in over), [s for s in open_ if s not in target]
    return target


def route(patterns: dict[tuple, int], targets: dict[str | None, int], repeats: int) -> dict[tuple, dict[str | None, int]]:
    """Words from each pattern to each of its sources: the largest flow within targets, of the least cost.

    Arcs into a pattern carry its size once per repetition, at costs 0, 1, 2 ...; successive shortest paths with potentials.
    """
    out: dict[tuple, dict[str | None, int]] = {}
    for part in _components(patterns):
        nodes = {("p", p) for p in part} | {("s", s) for p in part for s in p}
        arcs: dict = {n: [] for n in nodes | {"from", "to"}}

        def arc(a, b, cap, cost, arcs=arcs):
            forth, back = [b, cap, cost, None], [a, 0, -cost, None]
            forth[3], back[3] = back, forth
            arcs[a].append(forth)
            arcs[b].append(back)
            return forth

        ways = {}
        for p in part:
            for k in range(repeats):
                arc("from", ("p", p), patterns[p], k)
            for s in p:
                ways[p, s] = arc(("p", p), ("s", s), repeats * patterns[p], 0)
        for s in {s for p in part for s in p}:
            arc(("s", s), "to", targets.get(s, 0), 0)
        height = dict.fromkeys(arcs, 0)
        while True:
            best, via, queue, n = {"from": 0}, {}, [(0, 0, "from")], 0
            while queue:
                d, _, a = heapq.heappop(queue)
                if d > best[a]:
                    continue
                for e in arcs[a]:
                    b, cap, cost, _back = e
                    if cap > 0 and (new := d + cost + height[a] - height[b]) < best.get(b, float("inf")):
                        best[b], via[b], n = new, (a, e), n + 1
                        heapq.heappush(queue, (new, n, b))
            if "to" not in best:
                break
            for a in arcs:
                height[a] += min(best.get(a, best["to"]), best["to"])
            b, path = "to", []
            while b != "from":
                b, e = via[b]
                path.append(e)
            flow = min(e[1] for e in path)
            for e in path:
                e[1] -= flow
                e[3][1] += flow
        for (p, s), e in ways.items():
            out.setdefault(p, {})[s] = e[3][1]
    return out


def _components(patterns: dict[tuple, int]) -> list[list[tuple]]:
    root: dict = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for p in patterns:
        for s in p[1:]:
            root[find(s)] = find(p[0])
    parts: dict = {}
    for p in patterns:
        if p:
            parts.setdefault(find(p[0]), []).append(p)
    return list(parts.values())


def mix(docs: DataFrame, size: str, sources: str, key: str = "doc_id", weight: Callable[[int], float] = lambda i: (3, 1, 2)[i % 3], share: float = 1.5, repeats: int = 2, seed: str = "mix-1", measured: DataFrame | None = None) -> DataFrame:
    """``docs`` with source_size, target, repeats and taken (size times repeats).

    ``sources``: a column of one source, or of an array of them; with several, source_size and target are sums over them.
    ``measured``: the same rows (key, size and sources at least) where they are cheap to read, as they are read four times.
    """
    measured = docs if measured is None else measured
    is_array = isinstance(docs.schema[sources].dataType, T.ArrayType)
    pattern = F.array_sort(F.array_distinct(F.coalesce(F.col(sources), F.array().cast("array<string>")))) if is_array else F.array(F.col(sources).cast("string"))
    hashed = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    # a text form of the pattern joins with plain equality; null differs from every string
    code = F.array_join(F.transform(pattern, lambda s: F.coalesce(F.concat(F.lit("s"), F.hex(s)), F.lit("n"))), ",")
    rows = measured.select(F.col(size).cast("long").alias("size"), code.alias("code"), pattern.alias("pattern"), hashed.alias("hash"))

    got = rows.groupBy("code").agg(F.sum("size").alias("size"), F.first("pattern").alias("pattern")).limit(MAX_PATTERNS + 1).collect()
    if len(got) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    sizes = {tuple(sorted(r.pattern, key=by_code_point)): r["size"] or 0 for r in got}
    codes = {tuple(sorted(r.pattern, key=by_code_point)): r.code for r in got}
    of_source: dict = {}
    for p, n in sizes.items():
        for s in p:
            of_source[s] = of_source.get(s, 0) + n
    targets = water_fill(of_source, weight, share, repeats)
    flows = route(sizes, {s: round(t) for s, t in targets.items()}, repeats)
    plan = []
    for p, n in sizes.items():
        total = sum(flows.get(p, {}).values())
        passes, rest = divmod(total, n) if n else (0, 0)
        plan.append((codes[p], passes, rest, sum(of_source[s] for s in p), sum(targets[s] for s in p) if p else None))

    spark = docs.sparkSession
    kind = "code string, passes long, rest long, source_size long, target double"
    # a row for each pattern, at most MAX_PATTERNS: no shuffle moves a document, and a hot source is nobody's key
    wanted = F.broadcast(spark.createDataFrame([p for p in plan if p[2]], kind).select("code", "rest"))
    part = F.substring("hash", 1, PART_DIGITS)
    sums = rows.groupBy("code", part.alias("part")).agg(F.sum("size").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("code").orderBy("part"))
    ends = sums.withColumn("upto", upto).join(wanted, "code").where((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("n") < F.col("rest"))).select("code", "part", (F.col("rest") - F.col("upto") + F.col("n")).alias("left"))
    edge = rows.withColumn("part", part).join(F.broadcast(ends), ["code", "part"])  # one row for each pattern
    edge = edge.groupBy("code", "part", "hash", "left").agg(F.sum("size").alias("n")).withColumn("upto", F.sum("n").over(Window.partitionBy("code").orderBy("hash")))
    before = F.col("upto") - F.col("n")
    chosen = (F.col("upto") <= F.col("left")) | (F.col("upto") - F.col("left") < F.col("left") - before)
    cuts = {r[0]: r[2] or r[1] for r in edge.groupBy("code", "part").agg(F.max(F.when(chosen, F.col("hash")))).collect()}

    found = spark.createDataFrame([(*p, cuts.get(p[0])) for p in plan], f"{kind}, cut string").select(F.col("code").alias("__code"), F.col("passes").alias("__passes"), F.col("cut").alias("__cut"), "source_size", "target")
    new = ["source_size", "target", "repeats", "taken"]
    kept = docs.select([F.col(f"`{c}`") for c in docs.columns if c.lower() not in new]).withColumns({"__code": code, "__hash": hashed})
    times = F.when(F.col(size) > 0, F.col("__passes") + (F.col("__hash") <= F.coalesce("__cut", F.lit(""))).cast("long")).otherwise(F.lit(0))
    joined = kept.join(F.broadcast(found), "__code").withColumn("repeats", times)
    return joined.withColumn("taken", F.col("repeats") * F.col(size)).select(*kept.columns[:-2], *new)


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    docs = materialize(docs, "sizes")
    return mix(docs, "size", "source").select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5(concat('mix-1:', coalesce(CAST(doc_id AS VARCHAR), ''))) AS hash
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER) + 1] AS w
  FROM d GROUP BY source
), r AS (
  SELECT 0 AS step, source, source_size, w, false AS fixed, CAST(NULL AS DOUBLE) AS target, true AS again FROM s
  UNION ALL
  SELECT step + 1, source, source_size, w, fixed OR t > 2 * source_size,
         CASE WHEN fixed THEN target WHEN t > 2 * source_size THEN CAST(2 * source_size AS DOUBLE) ELSE t END,
         bool_or(NOT fixed AND t > 2 * source_size) OVER ()
  FROM (
    SELECT *, CASE WHEN NOT fixed THEN
        (1.5 * CAST(sum(source_size) OVER () AS DOUBLE) - CAST(sum(CASE WHEN fixed THEN 2 * source_size ELSE 0 END) OVER () AS DOUBLE)) * w
        / CAST(sum(CASE WHEN fixed THEN 0 ELSE w END) OVER () AS DOUBLE) END AS t
    FROM r WHERE again
  )
), t AS (
  SELECT source, source_size, target, CAST(round_even(target, 0) AS BIGINT) AS words FROM r QUALIFY step = max(step) OVER ()
), c AS (
  SELECT d.*, t.source_size, t.target, words // nullif(t.source_size, 0) AS passes, words % nullif(t.source_size, 0) AS rest,
         sum(size) OVER (PARTITION BY d.source ORDER BY hash) AS upto, sum(size) OVER (PARTITION BY d.source, hash) AS n
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(CASE WHEN size = 0 THEN 0 ELSE size * (passes + CASE WHEN rest > 0 AND (upto <= rest OR upto - rest < rest - (upto - n)) THEN 1 ELSE 0 END) END AS BIGINT) AS taken
FROM c
"""
