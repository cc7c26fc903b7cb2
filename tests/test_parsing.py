"""Parsing rules, each trap by itself."""

import random

import pytest
from pyspark.sql import functions as F

from taxaspark import functions as X
from taxaspark.operators import filters, merge
from taxaspark.sources.assignments import parse_assignments


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    ("text", "number"),
    [("12", 12), (" 12 ", 12), ("+5", 5), ("-3", -3), ("1_0", 10), ("1__0", None), ("_1", None), ("1.5", None), ("", None), ("12L", None), ("x", None), ("9223372036854775808", None), (" 7　", 7)],
)
def test_int_like_python(spark, text, number):
    assert one(spark, X.int_like_python, text) == number


def test_strip_takes_all_white_space(spark):
    assert one(spark, X.strip, "\t \x1c a b  \r\n") == "a b"


@pytest.mark.parametrize(
    ("line", "read", "tokens"),
    [("read:1:2:1-a-10=0,2=1", "read:1:2", ["1-a-10=0", "2=1"]), ("r:,,1=0,", "r", ["1=0"]), ("no colon", "no colon", []), ("r:", "r", []), (":1=0", "", ["1=0"])],
)
def test_lines(spark, line, read, tokens):
    assert one(spark, X.read_id, line) == read
    assert one(spark, X.hit_tokens, line) == tokens


@pytest.mark.parametrize(
    ("token", "lenient", "strict"),
    [
        ("123-acc-10=2", (123, 2), (123, "acc", 10, 2)),
        ("123=2", (123, 2), (123, "", 0, 2)),
        ("1-a-b-10=2", (1, 2), None),
        (" 2=1", (2, 1), (2, "", 0, 1)),
        ("1-x=2=3", (1, 3), None),
        ("7=-1", (7, -1), None),
        ("nope", None, None),
        ("=3", None, None),
        ("5=", None, None),
        ("1-007-3=0", (1, 0), (1, "007", 3, 0)),
    ],
)
def test_two_parsers(spark, token, lenient, strict):
    got = one(spark, X.lenient_hit, token)
    assert (got and (got["taxid"], got["edit"])) == lenient
    assert got is None or got["raw"] == token
    got = one(spark, X.strict_hit, token)
    assert (got and tuple(got)) == strict


def test_gff_attributes(spark):
    text = "ID=x; Note=bar=baz;flag;ID=y;empty="
    assert one(spark, X.attributes, text) == {"ID": "y", "Note": "bar=baz", "empty": ""}
    assert one(spark, lambda c: X.attribute(c, "Note"), text) == "bar=baz"
    assert one(spark, lambda c: X.attribute(c, "none"), text) is None
    assert one(spark, X.attributes, "") == {}


@pytest.mark.parametrize("n", [0, 1, 59, 60, 61, 120, 125])
def test_wrap_and_size(spark, n):
    lines = [("A" * n)[i : i + 60] for i in range(0, n, 60)]
    assert one(spark, X.wrap, "A" * n) == "\n".join(lines)
    assert one(spark, lambda c: X.record_bytes(F.lit(">rec1"), F.length(c)), "A" * n) == len("".join(x + "\n" for x in [">rec1", *lines]))


def reads_of(spark, lines):
    return parse_assignments(spark.createDataFrame(list(enumerate(lines)), "at int, value string"))


def python_filter(lines, include, exclude, delta):
    """The rules written down once more, line by line."""
    import re

    number = lambda s: int(s) if re.fullmatch(r"\s*[+-]?\d+(_\d+)*\s*", s, re.A) else None
    out, count = [], {"kept_reads": 0, "kept_hits": 0, "removed_reads": 0, "removed_hits": 0}
    for line in lines:
        line = line.strip()
        if not line:
            continue
        read, _, rest = line.rpartition(":") if ":" in line else (line, "", "")
        hits = []
        for raw in filter(None, rest.split(",")):
            left, mark, edit = raw.rpartition("=")
            taxid, edit = number(left.split("-")[0]), number(edit)
            if mark and taxid is not None and edit is not None:
                hits.append((raw, taxid, edit))
        kept = [h for h in hits if (include is None or h[1] in include) and (exclude is None or h[1] not in exclude)]
        kept = [h for h in kept if h[2] <= min(x[2] for x in kept) + delta]
        if read and hits:
            count["removed_hits"] += len(hits) - len(kept)
        if read and kept:
            count["kept_reads"] += 1
            count["kept_hits"] += len(kept)
            out.append(read + ":" + ",".join(h[0] for h in kept))
        else:
            count["removed_reads"] += 1
    return out, count


@pytest.mark.parametrize(("include", "exclude", "delta"), [(None, None, 0), ({1, 3}, {3}, 0), (set(), None, 5), (None, {2}, 1), ({1, 2, 3, 4}, None, 2)])
@pytest.mark.parametrize("inline", [10_000, 0])
def test_filter_against_python(spark, monkeypatch, include, exclude, delta, inline):
    monkeypatch.setattr(filters, "INLINE", inline)
    rng = random.Random(5)
    hit = lambda: rng.choice([f"{rng.randint(0, 5)}-s{rng.randint(0, 3)}-{rng.randint(0, 9)}={rng.randint(0, 4)}", f"{rng.randint(0, 5)}={rng.randint(-1, 4)}", "bad", "", "1-x=2=3", "1_0=1", " 2=1"])
    lines = [rng.choice(["r:1", "r", "", "x:"]) + rng.choice([":", ":", ""]) + ",".join(hit() for _ in range(rng.randint(0, 4))) for _ in range(400)] + ["", "  ", "only"]
    taxa = [None if t is None else spark.createDataFrame([(x,) for x in t], "taxid bigint") for t in (include, exclude)]
    filtered = filters.filter_hits(reads_of(spark, lines), *taxa, delta)
    want, count = python_filter(lines, include, exclude, delta)
    assert [r[0] for r in filters.kept_lines(filtered).orderBy("at").select("value").collect()] == want
    assert filters.filter_counters(filtered).first().asDict() == count


@pytest.mark.parametrize("lookup", [1 << 20, 0])
def test_long_lists_are_looked_up_and_longer_ones_joined(spark, monkeypatch, lookup):
    monkeypatch.setattr(filters, "INLINE", 2)
    monkeypatch.setattr(filters, "LOOKUP", lookup)
    include = spark.range(-50, 3000, 2).select(F.col("id").alias("taxid")).unionByName(spark.createDataFrame([(None,), (2,)], "taxid bigint"))
    exclude = spark.range(0, 3000, 6).select(F.col("id").alias("taxid"))
    rng = random.Random(7)
    lines = [f"r{k}:" + ",".join(f"{rng.randint(-60, 3100)}-s-1={rng.randint(0, 3)}" for _ in range(rng.randint(0, 30))) for k in range(200)]
    filtered = filters.filter_hits(reads_of(spark, lines), include, exclude, 1)
    want, count = python_filter(lines, set(range(-50, 3000, 2)), set(range(0, 3000, 6)), 1)
    assert [r[0] for r in filters.kept_lines(filtered).orderBy("at").select("value").collect()] == want
    assert filters.filter_counters(filtered).first().asDict() == count
    assert ("Join" in filtered._jdf.queryExecution().executedPlan().toString()) == (not lookup)


@pytest.mark.parametrize(("token", "taxid", "edit"), [("0012-a:b-3=04", 12, 4), ("5=3\u2028", 5, 3), ("5-x=3\r", 5, 3), ("7-=1", 7, 1), ("123456789012345678901=2", None, None), ("12x-a-1=2", None, None)])
def test_plain_hits_are_cut_like_others(spark, token, taxid, edit):
    got = one(spark, X.lenient_hit, token)
    assert (got and (got["raw"], got["taxid"], got["edit"])) == (taxid and (token, taxid, edit))


def test_filtering_has_no_shuffle(spark):
    filtered = filters.filter_hits(reads_of(spark, ["r:1=0,2=3"]), delta=1)
    assert "Exchange" not in filters.kept_lines(filtered)._jdf.queryExecution().executedPlan().toString()


def test_one_line_at_a_time(spark):
    lines = filters.kept_lines(filters.filter_hits(reads_of(spark, ["r:1=0", "r:1=5,2=6"]), delta=0))
    assert [r.value for r in lines.orderBy("at").collect()] == ["r:1=0", "r:1=5"]


def test_negative_delta(spark):
    with pytest.raises(ValueError):
        filters.filter_hits(reads_of(spark, []), delta=-1)


def test_merge(spark):
    hits = merge.strict_hits(reads_of(spark, ["a:1-x-5=2,1-y-9=1,2=0", "a:1-y-3=1", "b:1-x-5=0", "c:bad"]))
    best = merge.best_hits(hits)
    assert {tuple(r) for r in best.collect()} == {("a", 1, "y", 3, 1), ("a", 2, "", 0, 0), ("b", 1, "x", 5, 0)}
    assert len(merge.best_hits(hits, "taxid-gi").collect()) == 4
    assert {r.value for r in merge.render_hits(best).collect()} == {"a:2=0,1-y-3=1", "b:1-x-5=0"}
    assert {tuple(r) for r in merge.taxon_report(best).collect()} == {(1, 2, 1, 2, 0, 1), (2, 1, 0, 1, 0, 0)}
    with pytest.raises(ValueError):
        merge.best_hits(hits, "other")
