"""Intervals, proteins, map tables, and the whole annotate command."""

import random

import pytest

from taxaspark import plans
from taxaspark.operators import annotate, intervals
from taxaspark.operators.numbering import dense_ids, prefix_numbers
from taxaspark.sinks import write_table
from taxaspark.sinks.files import FIELDS, write_table_lines
from taxaspark.sources import read_gff, read_mapping, read_taxonomy
from taxaspark.sources.lines import line_numbers, read_lines
from taxaspark.sources.mapping import last_by

CDS = "assembly string, contig string, start bigint, end bigint, cds_id string, product string"


def places(spark, positions, assembly="A", contig="c"):
    return spark.createDataFrame([(assembly, contig, p) for p in positions], "assembly string, accession string, pos bigint")


def found(df):
    return {(r.pos, r.cds_id) for r in df.collect()}


def test_borders(spark):
    cds = spark.createDataFrame([("A", "c", 10, 20, "g", "p")], CDS)
    assert found(intervals.cds_at(places(spark, [9, 10, 20, 21, 0, -1]), cds)) == {(10, "g"), (20, "g")}
    assert found(intervals.cds_at(places(spark, [4, 5, 25, 26]), cds, fuzzy=5)) == {(5, "g"), (25, "g")}
    assert not found(intervals.cds_at(places(spark, [15], contig="other"), cds, fuzzy=5))
    assert not found(intervals.cds_at(places(spark, [15], assembly=""), cds))


def test_exact_hides_fuzzy(spark):
    cds = spark.createDataFrame([("A", "c", 10, 20, "g", "p"), ("A", "c", 22, 30, "h", "p")], CDS)
    assert found(intervals.cds_at(places(spark, [20, 21]), cds, fuzzy=3)) == {(20, "g"), (21, "g"), (21, "h")}


def test_order_and_repeats(spark):
    cds = spark.createDataFrame([("A", "c", 1, 9, "b", "x"), ("A", "c", 1, 9, "a", "y"), ("A", "c", 1, 8, "b", "z"), ("A", "c", 0, 3, "c", "w")], CDS)
    rows = intervals.cds_at(places(spark, [2]), cds).orderBy("cds_ord").collect()
    assert [(r.cds_id, r.product, r.cds_ord) for r in rows] == [("c", "w", 1), ("b", "z", 2), ("a", "y", 3)]


@pytest.mark.parametrize("fuzzy", [0, 7])
def test_bins_against_all_pairs(spark, fuzzy):
    rng = random.Random(fuzzy)
    cds = [("A", f"c{rng.randint(0, 2)}", s := rng.randint(-5, 400), s + rng.choice([0, 3, 40, 300]), f"g{k}", "p") for k in range(60)]
    points = sorted({(f"c{rng.randint(0, 2)}", rng.randint(0, 450)) for _ in range(120)})
    df = spark.createDataFrame([("A", c, p) for c, p in points], "assembly string, accession string, pos bigint")
    got = {(r.accession, r.pos, r.cds_id) for r in intervals.intervals_at(df, spark.createDataFrame(cds, CDS).withColumnRenamed("contig", "accession"), ["assembly", "accession"], fuzzy=fuzzy, width=16).collect()}
    want = set()
    for c, p in points:
        exact = [g for g in cds if g[1] == c and g[2] <= p <= g[3]] if p > 0 else []
        near = [g for g in cds if g[1] == c and g[2] <= p + fuzzy and g[3] >= max(1, p - fuzzy)] if p > 0 else []
        want |= {(c, p, g[4]) for g in (exact or (near if fuzzy else []))}
    assert got == want


def test_dense_ids(spark):
    rng = random.Random(2)
    rows = rng.sample(range(10_000), 500)
    got = dense_ids(spark.createDataFrame([(x,) for x in rows], "x int"), ["x"], "n").orderBy("n").collect()
    assert [(r.x, r.n) for r in got] == [(x, i + 1) for i, x in enumerate(sorted(rows))]
    assert dense_ids(spark.createDataFrame([], "x int"), ["x"], "n").count() == 0


def test_prefix_numbers(spark):
    rng = random.Random(3)
    groups = {g: o for o, g in enumerate(rng.sample("abcdefgh", 8))}
    rows = [(g, groups[g], k) for g in groups for k in range(rng.randint(1, 9))]
    rng.shuffle(rows)
    got = prefix_numbers(spark.createDataFrame(rows, "g string, o int, k int"), "g", "o", "k", "n").orderBy("n").collect()
    assert [(r.o, r.k) for r in got] == sorted((o, k) for _, o, k in rows)
    assert [r.n for r in got] == list(range(1, len(rows) + 1))


def test_gff(spark, tmp_path):
    rows = ["##gff-version 3", "c\t.\tgene\t1\t9\t.\t+\t0\tID=g", "c\t.\tCDS\t1\t9\t.\t+\t0\tID=cds-a;product=", "c\t.\tCDS\tx\t9\t.\t+\t0\tID=bad", "c\t.\tCDS\t5\t3\t.\t+\t0\tID=back"]
    rows += ["c\t.\tCDS\t2\t8\t.\t+\t0\tID=;protein_id=cds-p;product=Q", "c\t.\tCDS\t2\t8\t.\t+\t0\tproduct=no id", "c\t.\tCDS\t3\t4\t.\t+\t0\tprotein_id=", "c\t.\tCDS\t3"]
    (tmp_path / "a.gff").write_text("\n".join(rows) + "\n")
    got = {(r.assembly, r.contig, r.start, r.end, r.cds_id, r["product"]) for r in read_gff(spark, {"A": str(tmp_path / "a.gff")}).collect()}
    assert got == {("A", "c", 1, 9, "a", "NA"), ("A", "c", 2, 8, "p", "Q"), ("A", "c", 3, 4, "", "NA")}


MAP_HEAD = "seqid\tassembly\ttaxid\theader\tdescription\tgff\tprotein_fasta\r\n"


def test_mapping(spark, tmp_path):
    (tmp_path / "1.tsv").write_text(MAP_HEAD + '1\tA\t9\tc1\t"a ""quoted"" one"\tg1\tp1\r\n1\tA\t9\tc1\tlast in file\tg2\tp1\r\n\tB\t9\tc\tno key\tg3\tp\r\n')
    (tmp_path / "2.csv").write_text("seqid,assembly,header,description,gff,protein_fasta\n1,C,c9,later file,g,p\n007,A,c7,,g4,p\n")
    rows = read_mapping(spark, [str(tmp_path / "1.tsv"), str(tmp_path / "2.csv")])
    assert {r.seqid: (r.assembly, r.description) for r in last_by(rows, "seqid").collect()} == {"1": ("C", "later file"), "007": ("A", "")}
    assert {r.assembly: r.gff for r in last_by(rows, "assembly").collect()} == {"A": "g4", "B": "g3", "C": "g"}
    assert {r.description for r in rows.where("seqid = '1'").collect()} == {'a "quoted" one', "last in file", "later file"}
    (tmp_path / "3.tsv").write_text("seqid\tassembly\n")
    with pytest.raises(ValueError, match="lacks"):
        read_mapping(spark, str(tmp_path / "3.tsv"))


def test_taxonomy(spark, tmp_path):
    (tmp_path / "names").write_text("1\t|\troot\t|\t\t|\tscientific name\t|\n7\t|\tE. x\t|\t\t|\tscientific name\t|\n7\t|\tother\t|\t\t|\tsynonym\t|\n")
    (tmp_path / "merged").write_text("70\t|\t7\t|\n")
    assert {tuple(r) for r in read_taxonomy(spark, str(tmp_path / "names"), str(tmp_path / "merged")).collect()} == {(1, "root"), (7, "E. x"), (70, "E. x")}


@pytest.fixture
def world(tmp_path):
    (tmp_path / "A.gff").write_text("c1\t.\tCDS\t10\t20\t.\t+\t0\tID=cds-g1;product=One\nc1\t.\tCDS\t15\t30\t.\t+\t0\tID=g2\n")
    (tmp_path / "A.faa").write_text(">g1 first protein\n" + "M" * 70 + "\n>g2 same\n" + "M" * 70 + "\n")
    (tmp_path / "map.tsv").write_text(MAP_HEAD + f"1\tA\t9\tc1\tcontig one\t{tmp_path}/A.gff\t{tmp_path}/A.faa\r\n2\tB\t9\tc2\tcontig two\tNA\tNA\r\n")
    (tmp_path / "hits").write_text("r1:5-1-16=0,5-2-3=1\nr2:7=2,bad\nr3:5-9-4=0\nr4:5-1-12=1\n")
    (tmp_path / "names").write_text("5\t|\tFive\t|\t\t|\tscientific name\t|\n")
    return tmp_path


def test_annotate(spark, world):
    n = plans.annotate(spark, str(world / "hits"), str(world / "map.tsv"), str(world / "out.tsv"), str(world / "out.faa"), taxonomy=str(world / "names"))
    assert n == 5
    text = (world / "out.tsv").read_bytes().decode()
    assert text.endswith("\r\n")
    rows = [line.split("\t") for line in text.split("\r\n")[:-1]]
    assert rows[0][-3:] == ["CDS ID", "Protein ID", "Annotation"]
    assert rows[1:] == [
        ["r2", "7", "", "", "", "", "0", "2", "NA", "NA", "NA"],
        ["r3", "5", "Five", "", "", "", "4", "0", "NA", "NA", "NA"],
        ["r4", "5", "Five", "A", "c1", "contig one", "12", "1", "g1", "1", "One"],
        ["r1", "5", "Five", "A", "c1", "contig one", "16", "0", "g1", "1", "One"],
        ["r1", "5", "Five", "A", "c1", "contig one", "16", "0", "g2", "1", "NA"],
        ["r1", "5", "Five", "B", "c2", "contig two", "3", "1", "NA", "NA", "NA"],
    ]
    assert (world / "out.faa").read_text() == ">1 g1 first protein\n" + "M" * 60 + "\n" + "M" * 10 + "\n"


def test_annotate_strict(spark, world):
    with pytest.raises(FileNotFoundError):
        plans.annotate(spark, str(world / "hits"), str(world / "map.tsv"), str(world / "o"), str(world / "p"), strict=True)


def test_annotate_taxa_only_and_empty(spark, world):
    plans.annotate(spark, str(world / "hits"), str(world / "map.tsv"), str(world / "o.tsv"), str(world / "o.faa"), taxa_only=True)
    assert len((world / "o.tsv").read_text().split("\n")[0].split("\t")) == 8
    assert (world / "o.faa").read_text() == ""
    (world / "none").write_text("r:bad\n")
    assert plans.annotate(spark, str(world / "none"), str(world / "map.tsv"), str(world / "e.tsv"), str(world / "e.faa")) == 0
    assert (world / "e.tsv").read_bytes().count(b"\n") == 1
    assert (world / "e.faa").read_text() == ""


def test_hits_are_sorted_before_they_multiply(spark, monkeypatch):
    """Both ways of :func:`with_cds` give the same rows in order, and what the sort shuffles has a row a hit."""
    hits = spark.createDataFrame([("A", "c", p % 3 + 1, p, 0) for p in range(9)], "assembly string, accession string, pos bigint, at int, hit_idx int")
    found = spark.createDataFrame([("A", "c", p, k, f"g{k}", "x", str(k)) for p in (1, 2) for k in range(1, p + 3)], "assembly string, accession string, pos bigint, cds_ord int, cds_id string, product string, protein_id string")
    order = ["assembly", "accession", "pos", "at", "hit_idx"]
    want = [(p, at, c) for p, n in ((1, 3), (2, 4), (3, 0)) for at in range(p - 1, 9, 3) for c in ([f"g{k}" for k in range(1, n + 1)] or ["NA"])]
    for sent in (annotate.SENT, 0):
        monkeypatch.setattr(annotate, "SENT", sent)
        rows = annotate.with_cds(hits, found, order)
        assert [(r.pos, r["at"], r.cds_id) for r in rows.collect()] == want
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Generate") < plan.index("Sort [")


def test_lines_are_numbered_where_they_are(spark, tmp_path):
    for k in range(3):
        (tmp_path / "t").mkdir(exist_ok=True)
        (tmp_path / "t" / f"part-{k}").write_text("head\n" + "".join(f"{k}-{i}\n" for i in range(k * 40 + 1)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        for heads in (False, True):
            rows = line_numbers(read_lines(spark, str(tmp_path / "t")), heads=heads)
            got = [(r.n, r.value) for r in rows.orderBy("n").collect()]
            want = [x for k in range(3) for x in ["head"] * (not heads or k == 0) + [f"{k}-{i}" for i in range(k * 40 + 1)]]
            assert got == list(enumerate(want))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 << 20))


def test_annotations_of_a_file_are_many_tasks(spark, tmp_path):
    """Lines meet the name of their file's assembly without a shuffle by file."""
    (tmp_path / "a.gff").write_text("c\t.\tCDS\t1\t9\t.\t+\t0\tID=g1\n")
    plan = read_gff(spark, {"A": str(tmp_path / "a.gff")})._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


@pytest.mark.parametrize("sent", [1 << 19, 0])
def test_lines_are_those_of_the_table(spark, tmp_path, monkeypatch, sent):
    """Byte for byte, with fields that need quotes or lose white space, as parts and as one file; fields are made into text before rows multiply."""
    monkeypatch.setattr(annotate, "SENT", sent)
    odd = ["#r", "a\tb", 'q"q', " x ", "", "l\nf", "c\r", "'", "é"]
    hits = [((k,), 0, o, k, odd[-k % 9], "A", odd[k % 3], odd[(k + 4) % 9], 1 + k % 3, k) for k, o in enumerate(odd * 3)]
    hits = spark.createDataFrame(hits, "at struct<n int>, hit_idx int, read_id string, taxid bigint, organism string, assembly string, accession string, description string, pos bigint, edit bigint")
    found = [("A", odd[k], p, n, odd[(k + n) % 9], odd[(n + p) % 9], str(n)) for k in range(3) for p in (1, 2) for n in range(1, 4 + k)]
    found = spark.createDataFrame(found, "assembly string, accession string, pos bigint, cds_ord int, cds_id string, product string, protein_id string")
    columns = annotate.TAXA_COLUMNS + annotate.CDS_COLUMNS
    for end in ("", "/"):
        write_table(annotate.annotated_table(hits, found), f"{tmp_path}/table{end}")
        lines = annotate.annotated_lines(hits, found, FIELDS)
        write_table_lines(lines, columns, f"{tmp_path}/lines{end}")
        texts = []
        for name in ("table", "lines"):
            path = tmp_path / name
            parts = [p.read_bytes() for p in sorted(path.glob("part-*"))] if end else [path.read_bytes()]
            head = ("\t".join(columns) + "\r\n").encode()
            assert all(p.startswith(head) for p in parts if p) and any(parts)
            texts.append(b"".join(p.removeprefix(head) for p in parts))
            (path.rename(tmp_path / f"{name}.old{len(end)}"))
        assert texts[0] == texts[1] and texts[0].count(b"\r\n") > 60
    text = lines._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("explode(") < text.index("to_csv")
