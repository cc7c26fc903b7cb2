"""Reports, FASTA, layout, chunks, the reference-build command, mapping, extraction, streams and the command line."""

import csv
import gzip
import json
import random

import pytest

from taxaspark import cli, plans
from taxaspark.operators import alignment, refbuild, seeds
from taxaspark.sources import assembly_files, read_fasta, read_fastq, read_reads, read_report, read_taxa
from taxaspark.sources import layout
from taxaspark.sources import report as reports
from taxaspark.sources.delimited import read_delimited
from taxaspark.sources.lines import delimiter
from taxaspark.streaming import start_filter


def report(spark, path, text):
    if path.suffix == ".gz":
        path.write_bytes(gzip.compress(text.encode()))
    else:
        path.write_text(text)
    return [(r.assembly, r.taxid) for r in read_report(spark, str(path)).orderBy("ordinal").collect()]


def test_delimiter(spark, tmp_path):
    (tmp_path / "a").write_text("x\ty\n1,2\n")
    (tmp_path / "b").write_text("x,y\n1\t2\n")
    assert delimiter(spark, str(tmp_path / "a")) == "\t"
    assert delimiter(spark, str(tmp_path / "b")) == ","


def test_delimited_reports(spark, tmp_path):
    assert report(spark, tmp_path / "r.tsv", "assembly_accession\ttax_id\nA\t1\nB\t2\nA\t3\nC\tx\n\t4\n") == [("A", 3), ("B", 2)]
    assert report(spark, tmp_path / "r.csv", "taxid,accession\n1_0,A\n") == [("A", 10)]
    with pytest.raises(ValueError, match="needs one of"):
        report(spark, tmp_path / "n.tsv", "a\tb\n1\t2\n")


def test_json_reports(spark, tmp_path):
    lines = '{"assembly_accession":"A","tax_id":1}\n\n{"assembly":{"accession":"B","organism":{"taxid":"2"}}}\n{"accession":"C","organism":{"tax_id":"x"}}\n[1]\n'
    assert report(spark, tmp_path / "r.jsonl", lines) == [("A", 1), ("B", 2)]
    assert report(spark, tmp_path / "r.jsonl.gz", lines) == [("A", 1), ("B", 2)]
    assert report(spark, tmp_path / "many.json", '[\n {"accession":"A","taxid":5},\n {"accession":"B",\n "organism_taxid":6}\n]\n') == [("A", 5), ("B", 6)]
    assert report(spark, tmp_path / "one.json", '{"accession":\n"A","taxid":5}') == [("A", 5)]
    assert report(spark, tmp_path / "line.json", '[{"accession":"A","taxid":5}]\n') == []


def test_layout(spark, tmp_path):
    for name in ("A/x_genomic.fna", "A/y_genomic.fna.gz", "A/b.gff", "A/a.gff", "A/z_protein.faa", "B/readme", "C/deep/q_genomic.fna"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("")
    got = {r.assembly: tuple(x and x.rpartition("/")[2] for x in (r.genome, r.gff, r.protein)) for r in assembly_files(spark, str(tmp_path)).collect()}
    assert got == {"A": ("y_genomic.fna.gz", "a.gff", "z_protein.faa"), "B": (None, None, None)}


def test_fasta(spark, tmp_path):
    text = ">a one > two\nAC\nGT\n\n>b\r\nTT\r\n>empty\n"
    (tmp_path / "f.fa").write_text(text)
    (tmp_path / "f.fa.gz").write_bytes(gzip.compress(text.encode()))
    for name in ("f.fa", "f.fa.gz"):
        assert [(r.id, r.description, r.seq) for r in read_fasta(spark, str(tmp_path / name)).orderBy("at").collect()] == [("a", "a one > two", "ACGT"), ("b", "b", "TT"), ("empty", "empty", "")]


def test_fastq(spark, tmp_path):
    rows = [(f"r{i} x", "ACGT"[: i % 4 + 1], "@+I#"[: i % 4 + 1]) for i in range(50)]
    (tmp_path / "f.fq").write_text("".join(f"@{h}\n{s}\n+\n{q}\n" for h, s, q in rows))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        got = [(r.description, r.seq, r.qual) for r in read_fastq(spark, str(tmp_path / "f.fq")).orderBy("at").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == rows
    with pytest.raises(ValueError):
        read_reads(spark)
    with pytest.raises(ValueError):
        read_reads(spark, "a", "b")


def test_taxa(spark, tmp_path):
    (tmp_path / "t").write_text("# c\n123\n456 extra\nbad\n\n")
    assert {r.taxid for r in read_taxa(spark, str(tmp_path / "t")).collect()} == {123, 456}
    with pytest.raises(FileNotFoundError):
        read_taxa(spark, str(tmp_path / "none"))


def folded(sizes, limit):
    out, chunk, filled = [], 0, 0
    for n in sizes:
        if filled and filled + n > limit:
            chunk, filled = chunk + 1, 0
        filled += n
        out.append(chunk)
    return out


@pytest.mark.parametrize("limit", [10, 1, 200, 10_000])
def test_next_fit(spark, limit):
    """Against a fold: over many ranges, records over the limit, records of no bytes, keys with gaps; no task has all records."""
    rng = random.Random(limit)
    sizes = [rng.choice([0, 0, 1, rng.randint(1, 14), rng.randint(1, 14), 40]) for _ in range(200)]
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        rows = refbuild.next_fit(spark.createDataFrame([(3 * k + 7, n) for k, n in enumerate(sizes)], "seqid bigint, n_bytes bigint"), limit)
        assert [r.chunk for r in rows.orderBy("seqid").collect()] == folded(sizes, limit)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    with pytest.raises(ValueError):
        refbuild.next_fit(rows, 0)


def test_next_starts_look_back(spark):
    """A frame that ends with its partition is summed up anew for each row: the time of a range would grow with its square."""
    placed = spark.createDataFrame([(0, 1, 1, 5, 0), (0, 2, 2, 5, 5), (1, 3, 3, 5, 10)], "p bigint, k bigint, i bigint, n bigint, start bigint")
    found = refbuild._next_starts(placed, 8)
    assert "unboundedfollowing" not in found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert [r.next for r in found.orderBy("k").collect()] == [2, 3, 1 << 62]


def test_next_fit_of_nothing(spark):
    assert refbuild.next_fit(spark.createDataFrame([], "seqid bigint, n_bytes bigint"), 5).count() == 0


@pytest.fixture
def genomes(tmp_path):
    rng = random.Random(6)
    seqs = {}
    for a, n in (("B", 2), ("A", 1), ("Z", 0)):  # Z has a genome file without contigs
        (tmp_path / "data" / a).mkdir(parents=True)
        seqs[a] = [(f"{a}{k} contig {k}", "".join(rng.choice("ACGT") for _ in range(400_000))) for k in range(n)]
        (tmp_path / "data" / a / f"{a}_genomic.fna").write_text("".join(f">{h}\n{s}\n" for h, s in seqs[a]))
    (tmp_path / "report.tsv").write_text("accession\ttaxid\nB\t7\nmissing\t1\nA\t8\nZ\t9\n")
    return tmp_path, seqs


def test_reference_build(spark, genomes):
    path, seqs = genomes
    out = path / "out"
    numbers = plans.reference_build(spark, str(path / "data"), str(path / "report.tsv"), str(out), 1, index_gff=False)
    assert numbers == {"assemblies": 2, "taxa": 3, "sequences": 3, "chunks": 2}
    wrap = lambda s: "".join(s[i : i + 60] + "\n" for i in range(0, len(s), 60))
    records = [">1-7\n" + wrap(seqs["B"][0][1]), ">2-7\n" + wrap(seqs["B"][1][1]), ">3-8\n" + wrap(seqs["A"][0][1])]
    assert (out / "reference.chunk.0.fasta").read_text() == records[0] + records[1]
    assert (out / "reference.chunk.1.fasta").read_text() == records[2]
    table = (out / "reference.map.tsv").read_bytes().decode().split("\r\n")
    assert table[1].split("\t") == ["1", "B", "7", "B0", "B0 contig 0", "NA", "NA"]
    text = (out / "reference.summary.txt").read_text()
    assert "Total sequences: 3" in text and text.endswith("Assemblies per taxid:\n  7\t1\n  8\t1\n")
    with pytest.raises(ValueError):
        plans.reference_build(spark, str(path / "data"), str(path / "report.tsv"), str(out), 0)


def test_map_merge_and_extract(spark, genomes):
    path, seqs = genomes
    out = path / "out"
    plans.reference_build(spark, str(path / "data"), str(path / "report.tsv"), str(out), 10)
    rng = random.Random(8)
    first, other = seqs["B"][0][1][:5000], seqs["A"][0][1][:5000]
    (path / "small.fa").write_text(f">1-7\n{first}\n>2-8\n{other}\n")
    plans.index_build(spark, str(path / "small.fa"), str(path / "index"))
    flip = str.maketrans("ACGT", "TGCA")
    bad = list(first[1000:1100])
    for i in (20, 55, 90):
        bad[i] = bad[i].translate(flip)
    reads = [("exact", first[200:300]), ("edits", "".join(bad)), ("back", other[700:800].translate(flip)[::-1]), ("noise", "".join(rng.choice("ACGT") for _ in range(100))), ("short", "ACG")]
    (path / "r.fa").write_text("".join(f">{n}\n{s}\n" for n, s in reads))
    plans.assign_reads(spark, str(path / "index"), str(path / "r.bn"), fasta=str(path / "r.fa"))
    lines = (path / "r.bn").read_text().split("\n")
    assert lines == ["back:8-2-701=0", "edits:7-1-1001=3", "exact:7-1-201=0", ""]
    plans.merge_files(spark, [str(path / "r.bn"), str(path / "r.bn")], str(path / "m.clp"), report=str(path / "m.tsv"))
    assert (path / "m.clp").read_text().split("\n") == lines
    assert (path / "m.tsv").read_bytes().decode().split("\r\n")[1:] == ["7\t2\t2\t2\t0\t3", "8\t1\t1\t1\t0\t0", ""]
    plans.extract_reads(spark, str(path / "m.clp"), str(path / "in.fa"), str(path / "not.fa"), fasta=str(path / "r.fa"))
    assert [x for x in (path / "not.fa").read_text().split("\n") if x.startswith(">")] == [">noise", ">short"]
    with pytest.raises(ValueError):
        plans.merge_files(spark, [], "x")


def test_index_headers(spark):
    records = spark.createDataFrame([("1-7", "ACGT"), ("odd", "ACGT")], "id string, seq string")
    with pytest.raises(ValueError, match="odd"):
        seeds.reference_records(records)
    assert [tuple(r) for r in seeds.reference_records(records, skip_missing=True).collect()] == [("1", 7, "ACGT")]
    mapping = spark.createDataFrame([("odd", "9", "5")], "header string, taxid string, seqid string")
    assert [tuple(r) for r in seeds.reference_records(records, mapping, skip_missing=True).collect()] == [("5", 9, "ACGT")]


def test_alignment_against_full_table():
    rng = random.Random(9)

    def brute(read, window):
        row = list(range(len(read) + 1))
        best = row[-1]
        for c in window:
            new = [0]
            for i, a in enumerate(read, 1):
                new.append(min(row[i - 1] + (a != c), row[i] + 1, new[-1] + 1))
            row = new
            best = min(best, row[-1])
        return best

    for _ in range(200):
        read, window = ("".join(rng.choice("ACGT") for _ in range(rng.randint(lo, hi))) for lo, hi in ((1, 20), (0, 40)))
        edits, start = alignment.semi_global(read, window)
        assert edits == brute(read, window)
        assert 0 <= start <= len(window)


def test_stream_takes_up_where_it_stopped(spark, tmp_path):
    (tmp_path / "in").mkdir()
    args = (str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check"))
    (tmp_path / "in" / "1.txt").write_text("a:1=0,2=1\nb:3=0\n")
    start_filter(spark, *args, include=[1, 2]).awaitTermination(120)
    (tmp_path / "in" / "2.txt").write_text("c:2=4\nnone\n")
    start_filter(spark, *args, include=[1, 2]).awaitTermination(120)
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == ["a:1=0", "c:2=4"]


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "in").write_text("read1:1-a-10=0,2-b-5=3,3-c-1=0\nread2:2=1\nread3:3=0\n")
    (tmp_path / "include").write_text("1\n3\n")
    (tmp_path / "exclude").write_text("3\n")
    assert cli.main(["filter", "--input", str(tmp_path / "in"), "--out", str(tmp_path / "out"), "--include-taxa", str(tmp_path / "include"), "--exclude-taxa", str(tmp_path / "exclude")]) == 0
    assert (tmp_path / "out").read_text() == "read1:1-a-10=0\n"
    assert cli.main(["filter", "--input", str(tmp_path / "gone"), "--out", "x"]) == 1
    assert cli.main(["filter", "--input", str(tmp_path / "in"), "--out", "x", "--edit-delta", "-1"]) == 1
    assert cli.main(["assign", "--index", "i", "-m", "r"]) == 1
    assert cli.main(["merge", "-o", "x"]) == 1
    with pytest.raises(SystemExit):
        cli.main(["--version"])


def test_quoted_records_over_many_splits(spark, tmp_path):
    """Fields with line ends, doubled quotes and stray quotes, against the csv module; splits of a few lines."""
    rng = random.Random(11)
    pieces = ["a", '5" pipe', "two\nlines", "", "x\ty", 'say "yes"', "\n\n", "plain", '"', "end\n"]
    rows = [[str(k), *(rng.choice(pieces) for _ in range(3))] for k in range(300)]
    with open(tmp_path / "t.tsv", "w", newline="") as f:
        out = csv.writer(f, delimiter="\t")
        out.writerow(["k", "one", "two", "three"])
        out.writerows(rows)
        f.write('stray\t5" pipe\tb "quoted" c\tx\r\n')
    want = [*rows, ["stray", '5" pipe', 'b "quoted" c', "x"]]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = read_delimited(spark, str(tmp_path / "t.tsv")).orderBy("at")
        assert spark.read.text(str(tmp_path / "t.tsv")).rdd.getNumPartitions() > 10
        got = [[x or "" for x in r[1:]] for r in df.collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == want


@pytest.mark.parametrize("bound", [4096, 12, 0])
def test_only_long_lines_of_a_document_become_a_row_a_token(spark, tmp_path, monkeypatch, bound):
    monkeypatch.setattr(reports, "TOKENS", bound)
    cut, exploded = reports._tokens, []
    monkeypatch.setattr(reports, "_tokens", lambda rows: exploded.append(rows.count()) or cut(rows))
    record = lambda k: json.dumps({"name": "a[]{,\\\"", "more": [1, {"x": [k, 2]}], "accession": f"A{k}", "taxid": k})
    text = "[\n" + record(1) + ",\n" + ", ".join(record(k) for k in range(2, 9)) + " , {} ,\n" + record(9)[:-1] + "\n}\n, " + record(10) + ",\n" + record(11) + "]"
    (tmp_path / "r.json").write_text(text)
    assert [(r.assembly, r.taxid) for r in reports.read_report(spark, str(tmp_path / "r.json")).orderBy("ordinal").collect()] == [(f"A{k}", k) for k in range(1, 12)]
    assert (exploded == [0]) == (bound == 4096)


def test_json_documents_over_many_splits(spark, tmp_path):
    """Items of any layout, cut at the array's commas; strings that hold brackets and quotes; items that are no objects."""
    rng = random.Random(12)
    items = [{"accession": f"A{k}", "taxid": k, "more": [{"x": "]},[{" * rng.randint(0, 2)}, 'say "no\\']} for k in range(60)]
    text = "[\n" + ",\n".join(rng.choice([json.dumps(x), json.dumps(x, indent=1), json.dumps(x, indent=3).replace(",\n", "\n,")]) for x in items) + ", 5, [1, 2], null\n]"
    (tmp_path / "r.json").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "301")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = [(r.assembly, r.taxid) for r in read_report(spark, str(tmp_path / "r.json")).orderBy("ordinal").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == [(f"A{k}", k) for k in range(60)]
    (tmp_path / "one.json").write_text(json.dumps(items[7], indent=2))
    assert [(r.assembly, r.taxid) for r in read_report(spark, str(tmp_path / "one.json")).collect()] == [("A7", 7)]
    (tmp_path / "bad.jsonl").write_text('{"accession": "A", "taxid": 1}\nnot json\n')
    with pytest.raises(ValueError, match="neither"):
        read_report(spark, str(tmp_path / "bad.jsonl"))


def test_names_come_bit_by_bit(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layout, "AT_ONCE", 2)
    monkeypatch.setattr(layout, "HELD", 3)
    for k in range(7):
        (tmp_path / f"A{k}").mkdir()
        for name in ("b_genomic.fna", "a_genomic.fna", *["a_genomic.fna.gz"] * (k % 2)):
            (tmp_path / f"A{k}" / name).write_text("")
    got = {r.assembly: r.genome.rpartition("/")[2] for r in layout.assembly_files(spark, str(tmp_path)).collect()}
    assert got == {f"A{k}": "a_genomic.fna" + ".gz" * (k % 2) for k in range(7)}
    assert layout.assembly_files(spark, str(tmp_path / "A0")).count() == 0


def _errors(d):
    """Case, command line and a word of the message: what ends a command before it writes anything."""
    build = lambda **a: ["reference-build", "--data-dir", a.get("data", f"{d}/data"), "--report", a.get("report", f"{d}/report.tsv"), "--out-dir", f"{d}/out", "--max-size-mb", a.get("size", "1")]
    annotate = lambda table, *more: ["annotate", f"{d}/a.clp", "--map-table", table, "--out", f"{d}/o.tsv", "--proteins-out", f"{d}/o.faa", *more]
    keep = ["filter", "--out", f"{d}/kept.clp", "--input"]
    return [
        ("no input of filter", [*keep, f"{d}/none.clp"], "none.clp"),
        ("delta below 0", [*keep, f"{d}/a.clp", "--edit-delta", "-1"], "edit-delta"),
        ("no taxa file", [*keep, f"{d}/a.clp", "--include-taxa", f"{d}/none.txt"], "none.txt"),
        ("columns of the map table", annotate(f"{d}/bad.tsv"), "protein_fasta"),
        ("no map table", annotate(f"{d}/none.tsv"), "none.tsv"),
        ("no assignments", ["annotate", f"{d}/none.clp", *annotate(f"{d}/map.tsv")[2:]], "none.clp"),
        ("no annotations", annotate(f"{d}/map.tsv", "--strict"), "gff of assembly 'A'"),
        ("no data", build(data=f"{d}/none"), "none"),
        ("no report", build(report=f"{d}/none.tsv"), "none.tsv"),
        ("size of 0", build(size="0"), "max-size-mb"),
        ("empty report", build(report=f"{d}/empty.jsonl"), "no assembly"),
        ("columns of the report", build(report=f"{d}/bad.tsv"), "needs one of"),
        ("both kinds of reads", ["assign", "--fasta", "x", "--fastq", "y", "--index", "i", "-m", "r"], "exactly one"),
        ("neither kind", ["extract-reads", "--assignments", "a", "--matched", "m", "--unmatched", "u"], "exactly one"),
        ("no reads", ["assign", "--fasta", f"{d}/none.fa", "--index", f"{d}/index", "-m", f"{d}/r"], "none.fa"),
        ("no index", ["assign", "--fasta", f"{d}/r.fa", "--index", f"{d}/index", "-m", f"{d}/r"], "index"),
        ("no inputs of merge", ["merge", "-o", f"{d}/m"], "at least one"),
        ("header without a key", ["index-build", "-f", f"{d}/r.fa", "-i", f"{d}/made"], "no sequence key"),
    ]


@pytest.mark.parametrize("k", range(18))
def test_errors_of_commands(spark, tmp_path, capsys, monkeypatch, k):
    monkeypatch.setattr("taxaspark.session.session", lambda *a, **b: spark)
    (tmp_path / "data/A").mkdir(parents=True)
    for name, text in {"a.clp": "r:1-1-5=0\n", "bad.tsv": "seqid\tassembly\n1\tA\n", "empty.jsonl": "\n{}\n", "report.tsv": "accession\ttaxid\nA\t1\n", "r.fa": ">r\nACGT\n"}.items():
        (tmp_path / name).write_text(text)
    (tmp_path / "map.tsv").write_text("seqid\tassembly\ttaxid\theader\tdescription\tgff\tprotein_fasta\r\n1\tA\t1\tc\td\t/none.gff\tNA\r\n")
    case, args, word = _errors(tmp_path)[k]
    before = sorted(p.name for p in tmp_path.iterdir())
    assert cli.main(args) == 1, case
    assert word in capsys.readouterr().err
    assert sorted(p.name for p in tmp_path.iterdir()) == before


def test_readers_of_one_split_sort_nothing(spark, tmp_path):
    """What reads a gzipped file deals its lines out: FASTQ lines by record, without a sort by split; JSON lines before they are parsed."""
    with gzip.open(tmp_path / "a.fq.gz", "wt") as f:
        f.write("".join(f"@r{k} x\n{'ACGT' * k}\n+\n{'IIII' * k}\n" for k in range(50)))
    reads = read_fastq(spark, str(tmp_path / "a.fq.gz"))
    plan = reads._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2
    assert [(r.id, r.seq, r.qual) for r in reads.orderBy("at").collect()] == [(f"r{k}", "ACGT" * k, "IIII" * k) for k in range(50)]
    with gzip.open(tmp_path / "r.jsonl.gz", "wt") as f:
        f.write("".join(f'{{"accession":"A{k % 7}","taxid":{k}}}\n' for k in range(60)))
    found = read_report(spark, str(tmp_path / "r.jsonl.gz"))
    assert [(r.assembly, r.taxid) for r in found.orderBy("ordinal").collect()] == [(f"A{k}", max(j for j in range(60) if j % 7 == k)) for k in range(7)]
    assert all(f.endswith(".parquet") for f in found.inputFiles())
