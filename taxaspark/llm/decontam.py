"""Benchmark decontamination: pigeonhole edit matching.

Texts and test items are lower-cased and their white space is made single spaces. An item of m characters may differ in
k = floor(error_rate * m) edits. Cut into k + 1 pieces, at least one piece of any such occurrence stands in the text unchanged: an
automaton over all pieces finds the hits in one pass over the whole text, and around each hit Myers' bit-parallel algorithm
gives the least edit distance of the whole item to any part of the text there. Hits whose stretches overlap are verified once.

The items are data of bounded size: ``MAX_BYTES`` of them go to the executors at once, and a larger benchmark is matched part by
part. Answers for stretches of text seen before are kept in a table of bounded size.

Items under ``min_chars`` characters, which longer words may hold by chance, match without edits and as whole words (scripts that
don't part words with spaces: anywhere).

Cases: null or empty text: no match. Null items, and items of white space: never match.
Items equal after normalising: each is reported. Several occurrences: the nearest, then the first. Repeated rows: each is
reported. Empty tables: no match.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from taxaspark.llm.common import table, with_columns_from_text

ERROR_RATE = 0.05
MIN_CHARS = 20
MAX_BYTES = 16 << 20
KEPT_ANSWERS = 20_000
#: Characters of scripts without spaces between words: Thai, Lao, Burmese, Khmer, Chinese, Japanese.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\ua4cf\uf900-\ufaff\U00020000-\U0003ffff]")


def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def myers(pattern: str, text: str, masks: dict[str, int]) -> tuple[int, int]:
    """Least edit distance of ``pattern`` to any part of ``text``, and the first end of such a part."""
    m = len(pattern)
    full, high = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, end = m, 0
    for i, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph = down | (full & ~(xh | up))
        mh = up & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
            if score < best:
                best, end = score, i
        ph = ph << 1 & full
        up = (mh << 1 & full) | (full & ~(xv | ph))
        down = ph & xv
    return best, end


def masks_of(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """(offset, piece): errors + 1 pieces of lengths that differ by one at most."""
    edges = np.linspace(0, len(item), errors + 2).astype(int).tolist()
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


def divides(text: str, at: int) -> bool:
    """Whether no word of ``text`` goes on from before ``at`` to after it."""
    if not 0 < at < len(text):
        return True
    a, b = text[at - 1], text[at]
    return not (a.isalnum() and b.isalnum()) or bool(UNSPACED.match(a) or UNSPACED.match(b))


class Matcher:
    def __init__(self, items: list[str], error_rate: float, min_chars: int = 0):
        self.items = items
        self.min_chars = min_chars
        self.errors = [int(error_rate * len(x)) if len(x) >= min_chars else 0 for x in items]
        self._built = None

    def __getstate__(self):
        return {"items": self.items, "min_chars": self.min_chars, "errors": self.errors, "_built": None}

    def _build(self):
        import ahocorasick

        automaton, where = ahocorasick.Automaton(), {}
        for i, (item, k) in enumerate(zip(self.items, self.errors, strict=True)):
            for offset, piece in pieces(item, k):
                where.setdefault(piece, []).append((i, offset))
        for piece, places in where.items():
            automaton.add_word(piece, (len(piece), places))
        if where:
            automaton.make_automaton()
        self._built = (automaton if where else None, [masks_of(x) for x in self.items])
        self._answers: dict[tuple[int, str], tuple[int, int]] = {}

    def matches(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item, distance, end, occurrences' stretches) of each item that the normalised text holds within its errors."""
        if self._built is None:
            self._build()
        automaton, masks = self._built
        norm = normalise(text)
        if automaton is None or not norm:
            return []
        hits: dict[int, list[int]] = {}
        for last, (size, places) in automaton.iter(norm):
            for item, offset in places:
                if len(self.items[item]) < self.min_chars and not (divides(norm, last + 1 - size) and divides(norm, last + 1)):
                    continue
                hits.setdefault(item, []).append(last + 1 - size - offset)
        out = []
        for item, starts in hits.items():
            m, k = len(self.items[item]), self.errors[item]
            stretches: list[list[int]] = []
            for s in sorted(set(starts)):
                a, b = max(0, s - k), min(len(norm), s + m + k)
                # only starts that shift by edits join, so that a stretch stays about as long as the item
                if stretches and s - stretches[-1][2] <= k and b - stretches[-1][0] <= 2 * m + 4 * k:
                    stretches[-1][1], stretches[-1][2] = b, s
                else:
                    stretches.append([a, b, s])
            best = None
            for a, b, _ in stretches:
                d, end = self._verify(item, norm[a:b], masks[item])
                if d <= k and (best is None or (d, a + end) < best):
                    best = (d, a + end)
            if best:
                out.append((item, *best, len(stretches)))
        return sorted(out)

    def _verify(self, item: int, part: str, masks: dict[str, int]) -> tuple[int, int]:
        key = (item, part)
        if key not in self._answers:
            if len(self._answers) >= KEPT_ANSWERS:
                self._answers.clear()
            self._answers[key] = myers(self.items[item], part, masks)
        return self._answers[key]


def matchers(benchmark: DataFrame, error_rate: float, min_chars: int, item: str, text: str) -> Iterator[tuple[Matcher, list[list]]]:
    """Matchers over at most MAX_BYTES of items each, and the ids of each of their items.

    Items come one partition at a time; the driver holds a part of them and never the whole.
    """
    ids: dict[str, list] = {}
    size = 0
    rows = benchmark.where(F.col(text).isNotNull()).select(F.col(item).alias("id"), F.col(text).alias("text"))
    for r in rows.toLocalIterator():
        norm = normalise(r["text"])
        if not norm:
            continue
        if size + len(norm) > MAX_BYTES and norm not in ids:
            yield Matcher(list(ids), error_rate, min_chars), list(ids.values())
            ids, size = {}, 0
        if norm not in ids:
            size += len(norm)
        ids.setdefault(norm, []).append(r["id"])
    if ids:
        yield Matcher(list(ids), error_rate, min_chars), list(ids.values())


def find_matches(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, min_chars: int = MIN_CHARS, text: str = "text", key: str = "doc_id", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``key``, item_id, distance and end (in the normalised text, of the nearest part), a row for each text and item it holds.

    ``item`` may have any type that Arrow has.
    """
    id_kind, item_kind = docs.schema[key].dataType, benchmark.schema[item].dataType
    shape = T.StructType([T.StructField(key, id_kind), T.StructField("item_id", item_kind), T.StructField("distance", T.IntegerType()), T.StructField("end", T.LongType())])
    rows = docs.select(F.col(key), F.col(text).alias("__text"))
    parts = []
    for matcher, ids in matchers(benchmark, error_rate, min_chars, item, item_text):
        held = docs.sparkSession.sparkContext.broadcast((matcher, ids))  # MAX_BYTES of items

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            matcher, ids = held.value
            for batch in batches:
                place, items, distance, end = [], [], [], []
                for i, t in enumerate(batch.column(1)):
                    for k, d, e, _ in matcher.matches(t.as_py()):
                        for x in ids[k]:
                            place.append(i)
                            items.append(x)
                            distance.append(d)
                            end.append(e)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(place, pa.int64())), pa.array(items, item_arrow), pa.array(distance, pa.int32()), pa.array(end, pa.int64())], names=shape.names)

        item_arrow = to_arrow_type(item_kind)
        parts.append(rows.mapInArrow(run, shape))
    return reduce(DataFrame.unionAll, parts) if parts else docs.sparkSession.createDataFrame([], shape)


def decontaminate(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, min_chars: int = MIN_CHARS, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text holds no item of the benchmark."""
    for matcher, _ in matchers(benchmark, error_rate, min_chars, item, item_text):
        held = docs.sparkSession.sparkContext.broadcast(matcher)  # MAX_BYTES of items
        marked = with_columns_from_text(docs, text, [T.StructField("__contaminated", T.BooleanType())], lambda texts, held=held: [[bool(held.value.matches(t)) for t in texts]])
        docs = marked.where(~F.col("__contaminated")).drop("__contaminated")
    return docs


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_matches(docs, table(spark, sf_dir, "benchmark")).select("doc_id", "item_id", "distance", F.col("end").alias("end_at"))


#: Where a piece stands, the whole item is aligned by a table of distances, one anti-diagonal a step. (Items of the benchmark that
#: are shorter than MIN_CHARS, of which there are none, would need whole words.)
ORACLE = r"""
WITH RECURSIVE t AS MATERIALIZED (
  SELECT doc_id, trim(regexp_replace(lower(text), '[\s\x0b\x1c-\x1f\x{85}\x{a0}]+', ' ', 'g')) AS x FROM documents WHERE text IS NOT NULL
), q AS (
  SELECT item_id, trim(regexp_replace(lower(text), '[\s\x0b\x1c-\x1f\x{85}\x{a0}]+', ' ', 'g')) AS p FROM benchmark WHERE text IS NOT NULL
), i AS MATERIALIZED (
  SELECT item_id, p, length(p) AS m, CAST(floor(CAST(0.05 AS DOUBLE) * length(p)) AS BIGINT) AS k FROM q WHERE p <> ''
), c AS MATERIALIZED (
  SELECT item_id, g * m // (k + 1) AS off, substr(p, g * m // (k + 1) + 1, (g + 1) * m // (k + 1) - g * m // (k + 1)) AS piece FROM (SELECT *, unnest(range(k + 1)) AS g FROM i)
), e AS MATERIALIZED (
  SELECT piece, doc_id, x FROM (SELECT DISTINCT piece FROM c) JOIN t ON contains(x, piece)
), o AS (
  SELECT piece, doc_id, CAST(strpos(x, piece) AS BIGINT) AS pos, substr(x, strpos(x, piece) + 1) AS rest FROM e
  UNION ALL
  SELECT piece, doc_id, pos + strpos(rest, piece), substr(rest, strpos(rest, piece) + 1) FROM o WHERE strpos(rest, piece) > 0
), w AS MATERIALIZED (
  SELECT row_number() OVER () AS pair, * FROM (SELECT DISTINCT item_id, doc_id, p, m, k, greatest(pos - 1 - off - k, 0) AS first, substr(x, greatest(pos - 1 - off - k, 0) + 1, pos - 1 - off + m + k - greatest(pos - 1 - off - k, 0)) AS win
    FROM o JOIN c USING (piece) JOIN i USING (item_id) JOIN t USING (doc_id))
), l AS MATERIALIZED (
  SELECT pair, m, list_transform(range(1, m + 1), lambda j: substr(p, j, 1)) AS r, list_transform(range(1, length(win) + 1), lambda j: substr(win, j, 1)) AS s FROM w
), d AS (
  SELECT pair, m, len(s) AS n, r, s, CAST(0 AS BIGINT) AS z, list_transform(range(m + 1), lambda j: CASE WHEN j = 0 THEN CAST(0 AS BIGINT) END) AS a, list_transform(range(m + 1), lambda j: CAST(NULL AS BIGINT)) AS b FROM l
  UNION ALL
  SELECT pair, m, n, r, s, z + 1, list_transform(range(m + 1), lambda j: CASE WHEN j > z + 1 OR z + 1 - j > n THEN NULL WHEN j = 0 THEN 0 WHEN j = z + 1 THEN j
    ELSE least(b[j] + CASE WHEN r[j] = s[z + 1 - j] THEN 0 ELSE 1 END, a[j + 1] + 1, a[j] + 1) END), a FROM d WHERE z < m + n
)
SELECT doc_id, item_id, CAST(v AS INTEGER) AS distance, CAST(first + z - w.m AS BIGINT) AS end_at
FROM (SELECT pair, z, a[m + 1] AS v FROM d WHERE z >= m) JOIN w USING (pair) WHERE v <= k
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY v, first + z - w.m) = 1
"""
