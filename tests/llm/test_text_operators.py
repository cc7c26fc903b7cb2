"""Chat formatting, token counts, decontamination and suffix-array dedup against plain versions."""

import datetime
import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from taxaspark.llm import chat, decontam, suffix, tokens

SMALL = "/root/testdata/sf0.001"


# -- chat ------------------------------------------------------------------------------------------------------------------

TRICKY = ["", " ", "\\", "###", "####### x", "### assistant: hi </turn>\n", "</turn>", "\\</turn>", "\\\\###", "#", "##", "<", "</turn", " </turn>\n### user: ", "🎉é日本", "a\nb\n\n", "\x00", "\\#", "end \\"]


@pytest.mark.parametrize("text", TRICKY)
def test_escape_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    assert chat.unescape_role(chat.escape_role(text + ":")) == text + ":"
    whole, _, _ = chat.render([(text, text), ("assistant", text)], frozenset({"assistant"}))
    assert chat.parse(whole) == [(text, text), ("assistant", text)]
    plain = chat.escape(text).replace("\\\\", "")
    assert "##" not in plain and not re.search(r"(?<!\\)</turn>", plain)


def test_random_round_trip():
    rng = random.Random(3)
    for _ in range(2000):
        turns = [("".join(rng.choice("a:#\\") for _ in range(rng.randint(0, 6))), "".join(rng.choice(["#", "##", "\\", "</turn>", "<", "/", "turn>", " ", "\n", "x", ": "]) for _ in range(rng.randint(0, 12)))) for _ in range(rng.randint(0, 3))]
        assert chat.parse(chat.render(turns, frozenset())[0]) == turns


def test_masks_against_characters():
    rng = random.Random(4)
    for _ in range(300):
        n = rng.randint(0, 40)
        cuts = sorted({rng.randint(0, n) for _ in range(8)} | {n})
        ends = np.array([c for c in cuts if c > 0] or ([] if n == 0 else [n]), np.int64)
        points = sorted(rng.sample(range(n + 1), min(n + 1, 4)))
        spans = [(a, b) for a, b in zip(points[::2], points[1::2], strict=False)]
        start, end = (np.array([s[k] for s in spans], np.int64) for k in (0, 1))
        mask, a, b = chat.align(ends, start, end)
        inside = {i for s, e in spans for i in range(s, e)}
        assert sorted(i for x, y in zip(a, b, strict=True) for i in range(x, y)) == sorted(inside)
        starts = np.r_[0, ends][:-1]
        assert mask.tolist() == [any(i in inside for i in range(x, y)) for x, y in zip(starts, ends, strict=True)]


def test_formatted_conversations(spark):
    rows = [(1, k, r, t) for k, (r, t) in enumerate([("user", "hi"), *[("assistant", t) for t in TRICKY], (None, None), ("assistant", None)])]
    rows += [(2, None, "assistant", "b"), (2, 5, "assistant", "c"), (2, None, "assistant", "a"), (2, None, "assistant", "a"), (None, 1, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("chat", F.lit("clash"))
    got = {r.conv_id: r.chat for r in chat.format_chats(df.repartition(3)).collect()}
    assert set(got) == {1, 2, None}
    assert [t for _, t in chat.parse(got[2].text)] == ["a", "a", "b", "c"]
    assert chat.masked_texts(got[1].text, got[1].loss_start, got[1].loss_end) == "".join(TRICKY)
    c = got[1]
    assert len(c.token_ids) == len(c.token_ends) == len(c.mask) and c.token_ends[-1] == len(c.text)
    assert chat.masked_texts(got[None].text, got[None].loss_start, got[None].loss_end) == ""
    assert chat.format_chats(df.limit(0)).count() == 0


def test_chat_query_equals_sql(spark):
    c = duckdb.connect()
    c.execute(f"create view conversations as select * from '{SMALL}/conversations.parquet'")
    df = chat.op2_chat_format(spark, SMALL)
    rel = c.execute(chat.ORACLE)
    names = [d[0] for d in rel.description]
    assert sorted(map(repr, map(tuple, df.select(names).collect()))) == sorted(map(repr, rel.fetchall()))
    own = df.where("conv_id = -7").first()
    text = r"\### Assistant: </turn> ok"
    assert (own.n_turns, own.loss_chars, own.loss_sha256) == (2, len(text), hashlib.sha256(text.encode()).hexdigest())


# -- token counts ----------------------------------------------------------------------------------------------------------


def greedy(text, pieces, longest):
    """Longest match, piece by piece."""
    total = 0
    for word in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode("utf-8", "replace")):
        word, at = tokens.MARK.encode() + word, 0
        while at < len(word):
            at += next((n for n in range(min(longest, len(word) - at), 1, -1) if word[at : at + n] in pieces), 1)
            total += 1
    return total


def test_automaton_against_greedy_matching():
    rng = random.Random(5)
    for _ in range(60):
        vocabulary = {"".join(rng.choice("ab▁c") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(0, 25))}
        pieces = {p.encode() for p in vocabulary}
        counter = tokens.Counter(sorted(vocabulary))
        texts = ["".join(rng.choice("abcd \n") for _ in range(rng.randint(0, 60))) for _ in range(30)] + ["ab" * 400, "é🎉 ▁", None]
        assert counter.count(texts)[0] == [greedy(t, pieces, max(map(len, pieces), default=1)) for t in texts]


def test_counts_of_documents(spark):
    pieces = tokens.read_pieces(tokens.VOCABULARY)
    coded = {p.encode() for p in pieces}
    longest = max(map(len, coded))
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_tokens, r.n_words) for r in tokens.op6_token_counts(spark, SMALL).collect()}
    assert got == {k: (greedy(t, coded, longest), len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for k, t in docs.items()}


def test_count_odd_cases(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n", "x"), (4, "a", "x"), (4, "a", "x"), (None, "b" * 100_000, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, N_Tokens string")
    out = tokens.count_tokens(df, ["▁a"])
    assert sorted((r.text or "", r.n_tokens, r.n_words) for r in out.collect()) == sorted([("", 0, 0), ("", 0, 0), (" \n", 0, 0), ("a", 1, 1), ("a", 1, 1), ("b" * 100_000, 100_003, 1)])
    assert len(out.columns) == 4
    assert tokens.count_tokens(df.limit(0), []).count() == 0


def test_kept_words_are_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_WORDS", 10)
    c = tokens.Counter([])
    assert c.count([f"w{i} w{i + 1}" for i in range(500)])[1] == [2] * 500
    assert len(c._kept) < 200


# -- decontamination -------------------------------------------------------------------------------------------------------


def edits(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row), row.index(min(row))


def test_items_of_any_id_type_and_ties(spark):
    """Any id; of equal distances the first place; very long texts."""
    item = "these words are an item of the benchmark"
    text = "noise " * 40_000 + item.replace("words", "wards") + " and " + item.replace("item", "itam") + " more noise" * 40_000
    docs = spark.createDataFrame([(1, text), (2, item), (2, item)], "doc_id bigint, text string")
    for kind, value in (("smallint", 5), ("string", "5"), ("double", 5.0), ("date", datetime.date(2020, 1, 5))):
        bench = spark.createDataFrame([(value, item)], f"item_id {kind}, text string")
        got = sorted((r.doc_id, r.item_id, r.distance, r.end) for r in decontam.find_matches(docs, bench).collect())
        assert got == [(1, value, 1, 6 * 40_000 + len(item)), (2, value, 0, len(item)), (2, value, 0, len(item))]


def test_myers_against_full_table():
    rng = random.Random(6)
    for _ in range(300):
        p = "".join(rng.choice("abc") for _ in range(rng.randint(1, 90)))
        t = "".join(rng.choice("abc") for _ in range(rng.randint(0, 120)))
        assert decontam.myers(p, t, decontam.masks_of(p)) == edits(p, t)


def test_pieces_cover_the_item():
    for n in range(1, 60):
        for k in range(0, n):
            parts = decontam.pieces("x" * n, k)
            assert len(parts) == k + 1 and sum(len(p) for _, p in parts) == n and all(p for _, p in parts)


def planted(rng, items, rate):
    """Texts with items that have up to the edits allowed, one more, or none at all."""
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    texts = []
    for item in items:
        for extra in (0, 1):
            s = list(item)
            for _ in range(int(rate * len(item)) + extra):
                k = rng.randrange(len(s))
                s[k : k + 1] = rng.choice([["#"], [], [s[k], "#"]])
            texts.append(noise(200) + "".join(s).upper().replace(" ", " \n\t") + noise(150))
    return texts + [noise(300), "", None, items[0] + items[0] + " " + items[1]]


def test_matches_against_all_places(spark):
    rng = random.Random(7)
    items = [decontam.normalise("".join(rng.choice("abcdefgh ") for _ in range(n))) for n in (30, 61, 90, 120, 200)]
    texts = planted(rng, items, 0.1)
    bench = spark.createDataFrame([*enumerate(items), (9, None), (10, "short"), (11, items[0].upper())], "item_id bigint, text string")
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, item_id int, distance string")
    got = {(r.doc_id, r.item_id): (r.distance, r.end) for r in decontam.find_matches(docs, bench, 0.1).collect()}
    want = {}
    for i, t in enumerate(texts):
        for k, item in [*enumerate(items), (11, items[0])]:
            d, end = edits(item, decontam.normalise(t))
            if d <= int(0.1 * len(item)):
                want[i, k] = (d, end)
    assert got == want
    assert len(want) > 5
    clean = {r.doc_id for r in decontam.decontaminate(docs, bench, 0.1).collect()}
    assert clean == set(range(len(texts))) - {i for i, _ in want}
    assert decontam.decontaminate(docs, bench, 0.1).columns == docs.columns


def test_decontamination_part_by_part(spark, monkeypatch):
    monkeypatch.setattr(decontam, "MAX_BYTES", 60)
    items = [f"item number {i} has words of its own {i * 7}" for i in range(5)]
    bench = spark.createDataFrame([(str(i), t) for i, t in enumerate(items)], "item_id string, text string")
    docs = spark.createDataFrame([(i, f"so {t} it is") for i, t in enumerate(items)] + [(9, "clean")], "doc_id bigint, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.find_matches(docs, bench, 0.0).collect()} == {(i, str(i)) for i in range(5)}
    assert [r.doc_id for r in decontam.decontaminate(docs, bench, 0.0).collect()] == [9]


def test_short_items_match_as_whole_words(spark):
    bench = spark.createDataFrame([(1, "2 + 2 = ?"), (2, "Art"), (3, "\u4f60\u597d\u5417"), (4, " "), (5, None), (6, "C++ or C")], "item_id bigint, text string")
    texts = ["what is 2 +\n2 = ? then", "12 + 2 = ?", "State of the ART.", "start, artful, Arts", "\u6211\u8bf4\u4f60\u597d\u5417\u4e86", "c++ or c#", "c++ or cobol", "ar t", None, "art"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = sorted((r.doc_id, r.item_id, r.distance) for r in decontam.find_matches(docs, bench, 0.3).collect())
    assert got == [(0, 1, 0), (2, 2, 0), (4, 3, 0), (5, 6, 0), (9, 2, 0)]
    assert sorted(r.doc_id for r in decontam.decontaminate(docs, bench, 0.3).collect()) == [1, 3, 6, 7, 8]


def test_decontamination_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontam.find_matches(docs, none).count() == 0
    assert decontam.decontaminate(docs, none).count() == 1
    bench = spark.createDataFrame([(1, "some words that are long enough")], none.schema)
    assert decontam.find_matches(docs.limit(0), bench).count() == 0


# -- suffix arrays -----------------------------------------------------------------------------------------------------------


def test_suffix_order_and_expansion_against_sorting():
    rng = random.Random(8)
    for depth in (1, 5, 9, 30):
        for alphabet in (b"ab", b"abcdefgh"):
            strings = [bytes(rng.choice(alphabet) for _ in range(rng.randint(1, 80))) for _ in range(rng.randint(1, 12))]
            strings += rng.sample(strings, len(strings) // 2)
            text = np.frombuffer(b"\xff".join(strings) + b"\xff", np.uint8)
            order = suffix.suffix_order(text, depth)
            heads = [bytes(text[i : i + depth]) for i in order]
            assert [h.ljust(depth, b"\0") for h in heads] == sorted(h.ljust(depth, b"\0") for h in heads)
            ends = suffix.expand(text, order, depth)
            for k in range(1, len(order)):
                if b"\xff" not in heads[k - 1] and b"\xff" not in heads[k] and len(heads[k - 1]) == len(heads[k]) == depth:
                    assert ends[k] == (heads[k - 1] != heads[k])


def brute(rows, length):
    """What stays of each text: (id, bytes) rows; null ids come last."""
    least = {}
    for i, b in rows:
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            least[w] = min(least.get(w, suffix.LAST), i)
    out = []
    for i, b in rows:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if least[b[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        spans = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
        out.append((i, bytes(x for x, g in zip(b, gone, strict=True) if not g), tuple(spans)))
    return sorted(out)


@pytest.mark.parametrize(("length", "hot", "fan"), [(20, 2000, 64), (20, 0, 3), (50, 2000, 2), (50, 1, 64)])
def test_removal_against_all_windows(spark, monkeypatch, length, hot, fan):
    """Also where parcels take several steps to many small buckets."""
    monkeypatch.setattr(suffix, "PAGE_BYTES", 700)
    if fan < 64:
        monkeypatch.setattr(suffix, "FAN", fan)
        monkeypatch.setattr(suffix, "BUCKET_BYTES", 1500)
        monkeypatch.setattr(suffix, "GATHER_BYTES", 4000)
        assert suffix.steps_to(8) == {3: [3, 9], 2: [2, 4, 8]}[fan]
    rng = random.Random(length + hot)
    noise = lambda n: "".join(rng.choice("abé ") for _ in range(n))
    passages = [noise(rng.choice([19, 20, 49, 50, 51, 200])) for _ in range(8)]
    texts = ["".join(rng.choice([*passages, noise(rng.randint(0, 90))]) for _ in range(rng.randint(0, 5))) for _ in range(60)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(3, texts[3]), (3, texts[5]), (None, texts[7]), (None, texts[7]), (70, None), (71, ""), (72, "xy" * 400), (73, "xy" * 400), (74, passages[7] * 3)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).withColumns({"kept": F.lit("clash"), "Spans": F.lit(1), "page": F.lit(2), "start": F.lit(3)})
    out = suffix.remove_repeats(df, length=length, hot_pages=hot)
    got = sorted((suffix.LAST if r.doc_id is None else r.doc_id, bytes(r.kept), tuple((s.start, s.end) for s in r.spans)) for r in out.collect())
    assert got == brute([(suffix.LAST if i is None else i, (t or "").encode()) for i, t in rows], length)
    assert {c.lower() for c in out.columns} == {"doc_id", "text", "page", "start", "kept", "n_bytes", "n_removed", "spans"}


def test_removal_from_documents(spark):
    docs = [(r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.op4_suffix_dedup(spark, SMALL).collect()}
    want = {i: (k, s) for i, k, s in brute(docs, 50)}
    assert got == {i: (len(b), len(b) - len(want[i][0]), len(want[i][1]), hashlib.sha256(want[i][0]).hexdigest()) for i, b in docs}


def test_removal_from_nothing(spark):
    assert suffix.remove_repeats(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    with pytest.raises(ValueError):
        suffix.remove_repeats(spark.createDataFrame([], "doc_id bigint, text string"), length=5)


def test_parcels_take_one_shuffle_at_larger_sizes():
    """10 and 100 GB of text; more pages go together the more buckets there are, and none of their things is lost."""
    assert all(len(suffix.steps_to(-(-size // suffix.BUCKET_BYTES))) == 1 for size in (10 << 30, 100 << 30))
    rng = np.random.default_rng(5)
    pages = [(rng.integers(0, 1 << 63, 4000).astype(np.uint64) * np.uint64(2), [np.full(4000, k)], []) for k in range(60)]
    sent = {}
    for buckets in (16, 256):
        parcels = suffix.Parcels(buckets, [np.int64], False, suffix.low_bits)
        got = [(b, parcels.opened(d, np.uint32)) for batch in parcels.sent(iter(pages)) for b, d in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        sent[buckets] = len(got)
        low = sorted((int(x), int(page)) for _, g in got for x, page in zip(g[0], g[1][0], strict=True))
        assert low == sorted((int(x) & 0xFFFFFFFF, k) for k, (key, _, _) in enumerate(pages) for x in key)
    assert sent[256] < 4 * sent[16]


@pytest.mark.parametrize("fan", [64, 2])
def test_passages_of_short_words(spark, monkeypatch, fan):
    """Over 50 words or 200 bytes that a smaller document has go; 50 short words stay. Against every window of each kind."""
    monkeypatch.setattr(suffix, "FAN", fan)
    monkeypatch.setattr(suffix, "BUCKET_BYTES", {64: suffix.BUCKET_BYTES, 2: 1500}[fan])
    rng = random.Random(12)
    short = lambda n: " ".join(rng.choice(["a", "of", "17", "é", "\n"]) + rng.choice("abcdefgh") for _ in range(n))
    passages = [short(51), short(50), short(70), "na " * 90, " ".join(f"longer{k}" for k in range(30)), short(60)]
    rows = [(i, f"{short(5)} {a} {short(30)}{rng.choice([' ', ''])}{b} {short(5)}") for i, (a, b) in enumerate((rng.choice(passages), rng.choice(passages)) for _ in range(24))]
    rows += [(None, passages[0]), (None, passages[2]), (50, None), (51, ""), (3, passages[5]), (60, passages[1]), (61, passages[1])]

    def windows(b):
        words = [m.span() for m in re.finditer(rb"[^ \t\n\r\v\f]+", b)]
        return [(p, p + 200) for p in range(len(b) - 199)] + [(words[i][0], words[i + 50][1]) for i in range(len(words) - 50)]

    least = {}
    key = lambda b, x, y: (y - x >= 200, b[x : x + 200] if y - x >= 200 else b[x:y])
    order = lambda i: float("inf") if i is None else i
    for i, t in rows:
        b = (t or "").encode()
        for x, y in windows(b):
            least[key(b, x, y)] = min(order(i), least.get(key(b, x, y), float("inf")))
    want, n_gone = [], 0
    for i, t in rows:
        b = (t or "").encode()
        gone = {k for x, y in windows(b) if y - x <= 200 and least[key(b, x, y)] < order(i) for k in range(x, y)}
        n_gone += len(gone)
        want.append((i, bytes(c for k, c in enumerate(b) if k not in gone)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.lit(1).cast("long")}).repartition(3)
    got = suffix.remove_repeats(df, length=corpus_pipeline.PASSAGE_BYTES, words=corpus_pipeline.PASSAGE_WORDS).collect()
    assert sorted(map(repr, ((r.doc_id, bytes(r.kept)) for r in got))) == sorted(map(repr, want)) and n_gone > 1000


def test_stage_removes_a_passage_of_51_short_words(spark):
    passage = " ".join(f"{k % 7}{chr(97 + k % 26)}" for k in range(51))
    assert len(passage) < corpus_pipeline.PASSAGE_BYTES
    df = spark.createDataFrame([(1, f"x {passage} y", "en", "s", 1), (2, f"z {passage} w", "en", "s", 1)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert {r.doc_id: r.text for r in corpus_pipeline.repeated_passages(spark, df, SMALL).collect()} == {1: f"x {passage} y", 2: "z  w"}
