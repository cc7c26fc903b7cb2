"""SimHash groups, components, top-k search, mixing and the pipeline against plain versions."""

import random

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from taxaspark.llm import langid, mixing, simhash, topk
from taxaspark.llm.common import held_out
from taxaspark.llm.components import components
from taxaspark.llm.decontam import normalise
from taxaspark.llm.queries import oracle_sql, queries

SMALL = "/root/testdata/sf0.001"


def grouped(ids, links):
    """The least member of each node's component."""
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(35)] + [(k, k + 1) for k in range(100, 140)] + [(5, 5), (7, None)]
    want = {n: r for n, r in grouped({x for a, b in links for x in (a, b) if x is not None}, [(a, b) for a, b in links if b is not None]).items() if n != r}
    assert {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()} == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def words_of(text):
    return (text or "").encode().lower().split()


def shingles(text, k):
    w = words_of(text)
    return [b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or ([b" ".join(w)] if w else [])


def plain_print(text, k):
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles(text, k)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_hash_is_the_one_named(spark):
    for s in ("", "a", "some three words", "é" * 40):
        assert spark.createDataFrame([(s,)], "s string").select(F.xxhash64("s")).first()[0] % (1 << 64) == xxhash.xxh64_intdigest(s.encode(), 42)


@pytest.mark.parametrize("radius", [0, 1, 2, 5])
def test_trees_against_all_pairs(radius):
    rng = np.random.default_rng(radius)
    centre = rng.integers(0, 1 << 63, 6).astype(np.uint64)
    prints = centre[rng.integers(0, 6, 300)]
    for _ in range(5):
        prints ^= np.where(rng.random(300) < 0.5, np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64), np.uint64(0))
    group = np.sort(rng.integers(0, 4, 300))
    rows = np.arange(300)
    forest = simhash.Forest(prints, rows, group, 4)
    assert sorted(forest.pivot[forest.pivot >= 0].tolist()) == rows.tolist()
    got = {(q, p) for a, b in forest.within(rows, group, radius) for q, p in zip(a.tolist(), b.tolist(), strict=True)}
    far = np.bitwise_count(prints[:, None] ^ prints[None, :])
    assert got == {(i, j) for i in range(300) for j in range(300) if group[i] == group[j] and far[i, j] <= radius}


def variants(rng):
    """Documents, and copies with a few words changed, so that similarities lie on both sides of the threshold."""
    vocabulary = [f"w{k}" for k in range(400)]
    out = []
    for _ in range(25):
        base = rng.choices(vocabulary, k=rng.choice([1, 3, 8, 40, 150]))
        out.append(" ".join(base))
        for _ in range(rng.randint(0, 5)):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 5])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            out.append(rng.choice([" ", "\n\t"]).join(copy).upper())
    return out


def rows_of(spark, texts):
    rows = [(k, t) for k, t in enumerate(texts)] + [(900, None), (901, ""), (902, " \n"), (903, "w1"), (3, texts[3])]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    return rows, df.withColumns({"node": F.lit("x"), "ROOT": F.lit(1), "fingerprint": F.lit(2), "id": F.lit(3), "component_id": F.lit(4)})


@pytest.mark.parametrize(("shard", "levels", "most"), [(1024, 3, 1 << 24), (3, 1, 1 << 24), (2, 2, 500), (2, 2, 0)])
def test_fingerprint_groups(spark, monkeypatch, shard, levels, most):
    monkeypatch.setattr(simhash, "SHARD", shard)
    monkeypatch.setattr(simhash, "LEVELS", levels)
    monkeypatch.setattr(simhash, "BROADCAST_BYTES", most)
    rows, df = rows_of(spark, variants(random.Random(5)))
    prints = {i: plain_print(t, 3) for i, t in rows}
    ids = sorted(prints)
    want = grouped(ids, [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 2])
    got = simhash.near_duplicates(df, shingle=3, radius=2, least=None).collect()
    assert len(got) == len(rows)
    assert {(r.id, r.fingerprint, r.component_id) for r in got} == {(i, f"{prints[i]:016x}", want[i]) for i in ids}


@pytest.mark.parametrize(("shard", "most"), [(1024, 1 << 24), (3, 1 << 24), (3, 0)])
def test_similar_groups(spark, monkeypatch, shard, most):
    monkeypatch.setattr(simhash, "SHARD", shard)
    monkeypatch.setattr(simhash, "BROADCAST_BYTES", most)
    rows, df = rows_of(spark, variants(random.Random(6)))
    sets = {i: set(shingles(t, 5)) for i, t in rows}
    whole = {i: words_of(t) for i, t in rows}
    ids = sorted(sets)
    near = lambda a, b: whole[a] == whole[b] or (sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    want = grouped(ids, [(a, b) for a in ids for b in ids if a < b and near(a, b)])
    marks = simhash.near_duplicates(df)
    assert {(r.id, r.component_id) for r in marks.collect()} == set(want.items())
    assert len(set(want.values())) < len(ids)
    kept = simhash.one_of_each(df, marks)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values())) and kept.columns == df.columns


@pytest.mark.parametrize("most", [1 << 24, 20_000, 0])
def test_one_hot_shard(spark, monkeypatch, most):
    """Hundreds of texts that share most of their words: a shard of many parts, with links between nodes of different ones."""
    monkeypatch.setattr(simhash, "SHARD", 8)
    monkeypatch.setattr(simhash, "BROADCAST_BYTES", most)
    rng = random.Random(13)
    base = [f"h{k}" for k in range(120)]
    texts = []
    for _ in range(160):
        copy = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 4, 5, 6])):
            copy[rng.randrange(60, 120)] = f"z{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    sets = [set(shingles(t, 5)) for t in texts]
    near = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    want = grouped(range(160), [(a, b) for a in range(160) for b in range(a) if near(a, b)])
    assert len(set(want.values())) > 3
    got = simhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    assert {r.id: r.component_id for r in got.collect()} == want


@pytest.mark.parametrize("least", [0.5, 0.8, 1.0])
def test_classes_of_length(spark, least):
    """Lengths that a pair of that similarity can have share a key, even at the very edge; far ones don't."""
    sizes = [n for n in range(1, 400)] + [10**6, 1_250_000, 2 * 10**6]
    rows = spark.createDataFrame([(7, n, n, n) for n in sizes], "key bigint, node bigint, print bigint, n bigint")
    keys = {}
    for r in simhash.split_by_length(rows, least).collect():
        keys.setdefault(r.n, set()).add(r.key)
    assert all(len(k) == 2 for k in keys.values())
    for a in sizes:
        assert all(keys[a] & keys[b] for b in sizes if a <= b and a >= least * b)
        assert not any(keys[a] & keys[b] for b in sizes if a < 0.99 * least**2 * b)


def test_blocks_of_bits(spark):
    """Pairs within the radius agree on a key at every level, and a level takes a block's bits away."""
    rng = random.Random(2)
    prints = [rng.getrandbits(64) for _ in range(40)]
    prints += [p ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for p in prints]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    rows = spark.createDataFrame([(0, p, 64, p, p) for p in signed], "key bigint, rest bigint, width int, node bigint, print bigint")
    for _ in range(3):
        rows = simhash.split_by_bits(rows, 2)
        got = rows.collect()
        keys = {}
        for r in got:
            keys.setdefault(r.node, set()).add(r.key)
        assert all(keys[a] & keys[b] for a, b in zip(signed[:40], signed[40:], strict=True))
        assert all(0 <= r.rest < 1 << r.width for r in got)
        assert len({(r.key, r.rest) for r in got}) == len({(r.key, r.node) for r in got})


def test_repeated_lines(spark):
    """Equal sets of shingles are linked, however often a text repeats some of them, and whatever that does to fingerprints."""
    rng = random.Random(8)
    texts = []
    for _ in range(60):
        line, rest = (" ".join(f"v{rng.randrange(10**6)}" for _ in range(n)) for n in (10, 250))
        texts += [f"{line} {line} {rest}", f"{line} " * rng.randint(80, 120) + rest]
    sets = [set(shingles(t, 5)) for t in texts]
    far = [(plain_print(a, 5) ^ plain_print(b, 5)).bit_count() for a, b in zip(texts[::2], texts[1::2], strict=True)]
    assert all(a == b for a, b in zip(sets[::2], sets[1::2], strict=True)) and sum(d > 24 for d in far) > 1
    got = simhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    assert {r.id: r.component_id for r in got.collect()} == {i: i - i % 2 for i in range(len(texts))}


@pytest.mark.parametrize("hashes", [simhash.SHARD_HASHES, 12_000])
def test_long_texts_near_the_threshold(spark, monkeypatch, hashes):
    """Pairs of thousands of shingles with similarities just over and just under 0.8 are decided like short ones."""
    monkeypatch.setattr(simhash, "SHARD_HASHES", hashes)
    rng = random.Random(10)
    n, texts, want = 6000, [], {}
    for k in range(24):
        words = [f"u{rng.randrange(10**7)}" for _ in range(n)]
        far = [f"u{rng.randrange(10**7)}" for _ in range(n)]
        changed = n // 9 + rng.choice([-12, -6, 6, 12])  # the end of the text, so that shingles change with words
        a, b = " ".join(words), " ".join(words[: n - changed] + far[:changed])
        sa, sb = set(shingles(a, 5)), set(shingles(b, 5))
        near = len(sa & sb) >= 0.8 * len(sa | sb)
        assert abs(len(sa & sb) / len(sa | sb) - 0.8) < 0.01
        texts += [a, b]
        want |= {2 * k: 2 * k, 2 * k + 1: 2 * k + (not near)}
    assert 5 < sum(i != r for i, r in want.items()) < 19
    got = simhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    assert {r.id: r.component_id for r in got.collect()} == want


def test_sketches_of_long_texts():
    rng = np.random.default_rng(4)
    for share in (0.6, 0.8, 0.95):
        common = rng.integers(0, 1 << 62, int(40_000 * share)).astype(np.uint64)
        a, b = (np.r_[common, rng.integers(0, 1 << 62, 40_000 - len(common)).astype(np.uint64)] for _ in range(2))
        true = len(common) / (80_000 - len(common))
        assert abs(simhash.similarity(simhash.sketch(a), simhash.sketch(b)) - true) < 0.04
        assert len(simhash.sketch(a)) < 4 * simhash.SKETCH + 200
    assert simhash.similarity(simhash.sketch(common[:500]), simhash.sketch(common[100:500])) == pytest.approx(0.8)


def test_groups_of_nothing_and_null_ids(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.near_duplicates(none).count() == 0
    df = spark.createDataFrame([(None, "a b"), (None, "a b"), (None, "other words here now and then"), (4, "a b")], none.schema)
    marks = simhash.near_duplicates(df)
    assert sorted(str(r.component_id) for r in marks.collect()) == ["4", "4", "4", "None"]
    assert sorted(str(r.doc_id) for r in simhash.one_of_each(df, marks).collect()) == ["4", "None"]


def plain_top(vectors, k, wanted):
    out = []
    for q in sorted({i for i, v in vectors if v is not None and None not in v and i is not None and wanted(i)}):
        asked = min(v for i, v in vectors if i == q and v is not None)
        scored = [(-max(topk.LEAST, min(topk.MOST, sum(a * b for a, b in zip(asked, v, strict=False)))), i is None, i or 0) for i, v in vectors if i != q and v is not None and None not in v]
        out += [(q, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("block_rows", "tight"), [(256, False), (3, True)])
def test_top_k_against_all_pairs(spark, monkeypatch, block_rows, tight):
    """In one pass, and in several with first bounds; repeated and null ids, odd and huge vectors."""
    if tight:
        for name, value in (("QUERY_BYTES", 300), ("FIRST_BLOCKS", 4), ("PASSES", 2), ("QUERY_ROWS", 2)):
            monkeypatch.setattr(topk, name, value)
    rng = random.Random(3)
    vectors = [(i, [rng.randint(-9, 9) for _ in range(6)]) for i in range(90)]
    vectors += [(90, []), (91, [1]), (92, None), (93, [0] * 6), (7, [9] * 6), (94, [1 << 61, -(1 << 61), 1]), (110, [1 << 40, 1 << 40]), (95, vectors[4][1]), (100, vectors[4][1])]
    vectors += [(None, [9, 9, 9, 9, 9, 9]), (None, vectors[0][1]), (120, [None, 3])]
    df = spark.createDataFrame(vectors, "vec_id bigint, vector array<bigint>").withColumns({"id": F.lit(1), "v": F.lit(2), "a": F.lit(3)})
    got = topk.top_k(df, df.where("vec_id % 10 = 0"), 5, block_rows=block_rows)
    want = plain_top(vectors, 5, lambda i: i % 10 == 0)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want and any(r[2] is None for r in want)
    if not tight:
        assert topk.top_k(df.limit(0), df.limit(0)).count() == 0
        assert topk.top_k(df, df.where("vec_id is null")).count() == 0
        assert topk.top_k(df.where("vec_id in (1, 2)"), df.where("vec_id = 1")).count() == 1


def test_top_k_of_many_equal_vectors(spark):
    """The smallest ids win, and equal vectors don't meet in one block or task."""
    df = spark.range(3000).select(F.col("id").alias("vec_id"), F.array(F.lit(3), F.lit(-1)).cast("array<bigint>").alias("vector"))
    got = topk.top_k(df, df.where("vec_id in (1, 700)"), 3)
    assert sorted(tuple(r) for r in got.collect()) == [(1, 1, 0, 10), (1, 2, 2, 10), (1, 3, 3, 10), (700, 1, 0, 10), (700, 2, 1, 10), (700, 3, 2, 10)]


def test_top_k_skips_blocks():
    """Blocks whose bound is under the k-th score, or under a score to reach, aren't scored."""
    seen = []

    class Counted(topk.Block):
        def score(self, queries):
            seen.append(int(self.ids[0]))
            return super().score(queries)

    blocks = [Counted(np.arange(10 * b, 10 * b + 10), np.full((10, 4), b, np.int64)) for b in range(20)]
    best = topk.Best(1, 5)
    topk.search(blocks, np.array([-1]), np.ones((1, 4), np.int64), best)
    assert best.id.tolist() == [[190, 191, 192, 193, 194]] and seen == [190]
    topk.search(blocks[:10], np.array([-1]), np.ones((1, 4), np.int64), topk.Best(1, 5, np.array([50])))
    assert seen == [190]


def test_water_fill():
    weight = lambda i: (3, 1, 2)[i % 3]
    sizes = {"a": 10, "b": 1000, None: 500, "c": 90}
    got = mixing.water_fill(sizes, weight, 1.5, 2)
    assert sum(got.values()) == pytest.approx(1.5 * 1600)
    assert got["a"] == 20 and all(got[s] <= 2 * sizes[s] + 1e-9 for s in sizes)
    free = [s for s in sizes if got[s] < 2 * sizes[s]]
    order = sorted(sizes, key=mixing.by_code_point)
    assert len({round(got[s] / weight(order.index(s)), 6) for s in free}) <= 1
    assert mixing.water_fill({}, weight, 1.5, 2) == {}
    assert mixing.water_fill({"a": 0}, weight, 1.5, 2) == {"a": 0.0}


def test_flow_against_exhaustive_search():
    """Least repetition for the largest flow, over all ways to route small whole numbers."""
    import itertools

    rng = random.Random(9)
    for _ in range(12):
        patterns = {("a",): rng.randint(0, 2), ("b",): rng.randint(0, 2), ("a", "b"): rng.randint(1, 3)}
        targets = {"a": rng.randint(0, 4), "b": rng.randint(0, 4)}
        got = mixing.route(patterns, targets, 2)
        best = None
        arcs = [(p, s) for p in patterns for s in p]
        for flow in itertools.product(*[range(2 * patterns[p] + 1) for p, _ in arcs]):
            used = {p: sum(f for f, (q, _) in zip(flow, arcs, strict=True) if q == p) for p in patterns}
            into = {s: sum(f for f, (_, t) in zip(flow, arcs, strict=True) if t == s) for s in targets}
            if all(used[p] <= 2 * patterns[p] for p in patterns) and all(into[s] <= targets[s] for s in targets):
                key = (-sum(flow), sum(max(0, used[p] - patterns[p]) for p in patterns))
                best = key if best is None or key < best else best
        total = sum(sum(x.values()) for x in got.values())
        again = sum(max(0, sum(got[p].values()) - patterns[p]) for p in patterns)
        assert (-total, again) == best
        assert all(sum(got[p].get(s, 0) for p in patterns) <= targets[s] for s in targets)


def test_overlapping_sources(spark):
    rng = random.Random(4)
    sets = [["a"], ["b"], ["a", "b"], ["b", "c"], [], [None, "a"]]
    rows = [(k, rng.choice(sets), rng.randint(0, 40)) for k in range(300)] + [(7, ["a"], 3), (None, ["c", "b", "b"], 5), (None, None, 2), (301, ["b"], None)]
    df = spark.createDataFrame(rows, "doc_id bigint, src array<string>, n bigint").withColumns({"code": F.lit("x"), "hash": F.lit(1), "Taken": F.lit(2), "passes": F.lit(3), "cut": F.lit(4)})
    out = mixing.mix(df, "n", "src")
    got = out.collect()
    assert len(got) == len(rows) and [c for c in out.columns if c.lower() == "taken"] == ["taken"]
    assert all(0 <= r.repeats <= 2 and (r.taken or 0) == r.repeats * (r.n or 0) for r in got)
    assert all(r.repeats == 0 for r in got if not r.src)
    total = sum(r.n or 0 for r in got if r.src)
    sizes = {s: sum(r.n or 0 for r in got if r.src and s in r.src) for s in ("a", "b", "c", None)}
    targets = mixing.water_fill(sizes, lambda i: (3, 1, 2)[i % 3], 1.5, 2)
    taken = sum(r.taken or 0 for r in got)
    assert abs(taken - min(sum(targets.values()), 2 * total)) < 40 * len(sets)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(df.repartition(5), "n", "src").collect()))
    assert mixing.mix(df.limit(0), "n", "src").count() == 0


def test_too_many_patterns(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_PATTERNS", 3)
    with pytest.raises(ValueError):
        mixing.mix(spark.createDataFrame([(i, str(i), 1) for i in range(5)], "doc_id int, s string, n int"), "n", "s")


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_queries_equal_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "embeddings", "conversations", "benchmark"):
        c.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    df = queries()[name](spark, SMALL)
    rel = c.execute(oracle_sql()[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(repr, map(tuple, df.select(names).collect()))) == sorted(map(repr, rel.fetchall()))


def test_each_number_has_a_query():
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in queries())] == []
    assert len(corpus_pipeline.STAGES) == 5


def plain_pipeline(spark, docs, sf_dir):
    """The stages as loops over rows; the language model is the operator's own."""
    from taxaspark.llm.simhash import shingle_hashes  # noqa: F401

    model = langid.fit(docs.where(~held_out(F.col("doc_id"))))
    rows = [r.asDict() for r in docs.select(corpus_pipeline.COLUMNS).collect()]
    rows = [r for r, ok in zip(rows, model.score([r["text"] for r in rows])[2], strict=True) if ok]
    sets = {r["doc_id"]: set(shingles(r["text"], 5)) for r in rows}
    whole = {r["doc_id"]: words_of(r["text"]) for r in rows}
    ids = sorted(sets)
    group = grouped(ids, [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if whole[a] == whole[b] or (min(len(sets[a]), len(sets[b])) >= 0.8 * max(len(sets[a]), len(sets[b])) and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))])
    rows = sorted((r for r in rows if group[r["doc_id"]] == r["doc_id"]), key=lambda r: r["doc_id"])
    n, least = corpus_pipeline.PASSAGE_BYTES, {}
    for r in rows:
        b = r["text"].encode()
        for p in range(len(b) - n + 1):
            least.setdefault(b[p : p + n], r["doc_id"])
    for r in rows:
        b, gone = r["text"].encode(), set()
        for p in range(len(b) - n + 1):
            if least[b[p : p + n]] < r["doc_id"]:
                gone.update(range(p, p + n))
        r["text"] = bytes(x for i, x in enumerate(b) if i not in gone).decode("utf-8", "ignore")
        r["n_chars"] = len(r["text"])
    rows = [r for r in rows if r["text"].strip()]
    items = [normalise(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    return [r for r in rows if not any(i in normalise(r["text"]) for i in items)]


def test_pipeline_against_loops(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, got, SMALL)
        assert sorted(got.columns) == sorted(corpus_pipeline.COLUMNS), name
    want = plain_pipeline(spark, docs, SMALL)
    key = lambda r: tuple(r[c] for c in corpus_pipeline.COLUMNS)
    assert sorted(map(key, (r.asDict() for r in got.collect()))) == sorted(map(key, want))
    mixed = corpus_pipeline.mixed(spark, got, SMALL).collect()
    out = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(str, mixed)) == sorted(map(str, out.collect()))
    taken = {}
    for r in mixed:
        taken.setdefault(r.source, [r.target, 0])[1] += r.taken
    longest = max(r.size for r in mixed)
    assert all(abs(t - n) <= longest for t, n in taken.values())


def test_stages_with_odd_rows(spark):
    """Null ids, texts, languages and sources, an empty and a long text, a repeated row, and columns with clashing names: what stays."""
    cat, hund, more = "the cat sat on the mat", "der hund und die katze " * 3000, "some english words and more of them here"
    rows = [(1, None, None, None, None), (None, more, None, None, 1), (2, "", "en", "s", 0), (3, cat, "en", None, 9), (3, cat, "en", None, 9), (4, hund, "de", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").withColumns({"score": F.lit(1), "kept": F.lit(2), "size": F.lit(3), "__hash": F.lit(4)})
    stages = [f for _, f in corpus_pipeline.STAGES]
    want = [
        # a text without a letter has no language
        [rows[1], *rows[3:]],
        # texts without words are alike, and so are the two rows of an id
        [rows[0], rows[1], rows[3], rows[5]],
        # a row is no document with a smaller id than its like; nothing is left of a text without letters
        [(None, more, None, None, len(more)), *[(3, cat, "en", None, len(cat))] * 2, (4, hund, "de", "s", len(hund))],
        rows,
    ]
    key = lambda r: repr(tuple(r))
    for stage, expected in zip(stages, want, strict=False):
        got = stage(spark, docs, SMALL)
        assert got.columns == corpus_pipeline.COLUMNS
        assert sorted(map(key, got.collect())) == sorted(map(key, expected)), stage
    # the null source has 20 words and can't take more than twice that; s takes the rest of 1.5 times all
    mixed = [(r.doc_id, r["size"], r.source_size, r.target, r.repeats, r.taken) for r in stages[4](spark, docs, SMALL).collect()]
    assert sorted(map(key, mixed)) == sorted(map(key, [(None, 8, 20, 40.0, 2, 16), (3, 6, 20, 40.0, 2, 12), (3, 6, 20, 40.0, 2, 12), (4, 15_000, 15_000, 22_490.0, 1, 15_000)]))
    for stage in stages:
        assert stage(spark, docs.limit(0), SMALL).count() == 0
