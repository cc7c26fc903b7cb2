"""Staged annotations, resume and append, parts, repeated keys, long intervals, streams against batches."""

import random
import re
import threading
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from taxaspark.operators import alignment, filters, intervals, merge, seeds
from taxaspark.operators.refbuild import key_contigs
from taxaspark.plans import mapping
from taxaspark.plans.annotation import annotate
from taxaspark.plans.filtering import filter_file
from taxaspark.plans.mapping import assign_reads, index_build
from taxaspark.plans.reference import reference_build, stage_gff
from taxaspark.sinks import write_lines, write_table
from taxaspark.sources.assignments import parse_assignments, read_assignments
from taxaspark.sources.gff import read_gff
from taxaspark.sources.index import read_seeds
from taxaspark.storage import materialize, scratch
from taxaspark.streaming.hits import named_hits, start_filter

ODD = "r:99999999999999999999-7-3=1,5-7-3=1, 7-a=b-3=4,12-5,1=2-3-4,7=8,1-a-b-10=2,-1=1,1-2-99999999999999999999=1"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def reads(spark):
    return parse_assignments(spark.createDataFrame([(1, ODD)], "at int, value string"))


def test_strict_hits(reads):
    got = [(r.hit_idx, r.taxid, r.seqid, r.pos, r.edit) for r in merge.strict_hits(reads).orderBy("hit_idx").collect()]
    assert got == [(1, 5, "7", 3, 1), (2, 7, "a=b", 3, 4), (5, 7, "", 0, 8)]
    assert [r.hit_idx for r in merge.malformed_hits(reads).orderBy("hit_idx").collect()] == [0, 3, 4, 6, 7, 8]


def test_hits_are_matched_and_cut_once(reads):
    text = plan(merge.strict_hits(reads))
    assert text.count("RLIKE") == 1 and text.count("-|=(?=") == 1


def test_stream_keeps_the_hits_of_the_batch(spark, reads, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.clp").write_text(ODD + "\n")
    known = spark.createDataFrame([((1,), "7", "A", "c", "d")], "at struct<k: int>, seqid string, assembly string, header string, description string")
    rows = named_hits(spark.readStream.text(str(tmp_path / "in")), known, spark.createDataFrame([(5, "five")], "taxid bigint, name string"))
    rows.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("read_id", "taxid", "seqid", "pos", "edit").collect()
    assert sorted(got) == sorted(merge.strict_hits(reads).select("read_id", "taxid", "seqid", "pos", "edit").collect())


def test_taxa_are_looked_up(spark, reads):
    taxa = spark.range(1000).select(F.col("id").alias("taxid"))
    text = plan(filters.filter_hits(reads, include=taxa, exclude=taxa.where("taxid = 7")))
    assert "INSET" in text and "array_contains" not in text


def test_intervals_of_any_length(spark):
    rng = random.Random(5)
    points = sorted({rng.choice([rng.randint(1, 5000), rng.randint(1, 10**7), 10**12, (1 << 63) - 1]) for _ in range(150)})
    starts = [rng.randint(1, 10**6) for _ in range(60)]
    ends = [(1, 10**13), (-5, (1 << 63) - 1), (7, 3), (-9, 0), (1, 1), *((s, s + rng.choice([10, 3000, 140_000, 9_000_000])) for s in starts)]
    ivs = [("c", s, e, str(k)) for k, (s, e) in enumerate(ends)]
    p, i = spark.createDataFrame([("c", x) for x in points], "k string, pos bigint"), spark.createDataFrame(ivs, "k string, start bigint, end bigint, id string")
    for fuzzy in (0, 5, 3000):
        want = []
        for x in points:
            hold = [v for _, s, e, v in ivs if s <= x <= e]
            near = [v for _, s, e, v in ivs if s <= e and e >= 1 and s <= x + fuzzy and e >= max(1, x - fuzzy)]
            want += [(x, v) for v in (hold or near)]
        assert sorted((r.pos, r.id) for r in intervals.intervals_at(p, i, ["k"], fuzzy=fuzzy).collect()) == sorted(want)


def best_starts(read, window):
    """Least edits of the read against any part of the window, and every start that has them at the first end."""
    best = {}
    for start in range(len(window) + 1):
        row = list(range(len(read) + 1))
        best.setdefault((row[-1], start), set()).add(start)
        for end in range(start, len(window)):
            new = [row[0] + 1]
            for k, c in enumerate(read):
                new.append(min(row[k] + (c != window[end]), row[k + 1] + 1, new[k] + 1))
            row = new
            best.setdefault((row[-1], end + 1), set()).add(start)
    least = min(e for e, _ in best)
    end = min(at for e, at in best if e == least)
    return least, best[least, end]


@pytest.mark.parametrize("cells", [1, 1 << 19])
def test_alignments_in_batches(monkeypatch, cells):
    monkeypatch.setattr(alignment, "CELLS", cells)
    rng = random.Random(3)
    pairs = [("".join(rng.choices("ACG", k=rng.randint(1, 7))), "".join(rng.choices("ACG", k=rng.randint(0, 12)))) for _ in range(200)]
    pairs += [("", "AC"), ("A", ""), ("\U0001f600A", "xA\U0001f600Ax")]
    for n in (63, 64, 65, 130):  # reads of one word, just so, and more
        read = "".join(rng.choices("ACGT", k=n))
        near = "".join(c for c in read if rng.random() > 0.05)
        pairs += [(read, "TTT" + near[:70] + "G" + near[70:] + "CA"), (read, read), (read, near[9:])]
    together = alignment.semi_global_many([r for r, _ in pairs], [w for _, w in pairs])
    for (read, window), (edits, start) in zip(pairs, together, strict=True):
        least, starts = best_starts(read, window)
        assert edits == least and start == (max(starts) if edits < len(read) else 0), (read, window)
        assert alignment.semi_global(read, window) == (edits, start)


def test_blocks_hold_every_window(spark):
    text = "".join(random.Random(1).choices("ACGT", k=9000))
    refs = spark.createDataFrame([("a", 1, text), ("b", 2, text[:4096]), ("c", 3, text[:5]), ("d", 4, "")], "seqid string, taxid bigint, seq string")
    got = sorted((r.seqid, r.pos, r.seed) for r in seeds.build_index(refs).collect())
    assert got == sorted((i, k, s[k : k + 18]) for i, s in (("a", text), ("b", text[:4096])) for k in range(len(s) - 17))


def test_reads_over_block_edges(spark):
    text = "".join(random.Random(2).choices("ACGT", k=10_000))
    refs = spark.createDataFrame([("a", 1, text)], "seqid string, taxid bigint, seq string")
    places = [0, 4000, 4095, 4096, 8100, 9900]
    rows = [(str(p), text[p : p + 50] + text[p + 51 : p + 100]) for p in places]
    out = seeds.assign(spark.createDataFrame(rows, "read_id string, seq string"), seeds.build_index(refs), refs).collect()
    assert {(r.read_id, r.pos) for r in out if r.edit == 1} >= {(str(p), p + 1) for p in places}


@pytest.fixture
def index(spark, tmp_path):
    rng = random.Random(4)
    refs = {f"{k}-{k + 10}": "".join(rng.choices("ACGT", k=400)) for k in range(1, 4)}
    (tmp_path / "refs.fasta").write_text("".join(f">{h}\n{s}\n" for h, s in refs.items()))
    index_build(spark, str(tmp_path / "refs.fasta"), str(tmp_path / "index"))
    (tmp_path / "reads.fasta").write_text("".join(f">r{h}\n{s[20:120]}\n" for h, s in refs.items()) + ">none\n" + "".join(rng.choices("ACGT", k=90)) + "\n")
    return tmp_path


def lines(path):
    return Path(path).read_text().splitlines()


def mapped(spark, results):
    """Ids of the reads that were mapped, as often as they were."""
    return sorted(r[0] for r in spark.read.parquet(f"{results}.state/mapped").select("read_id").collect())


def test_resume_maps_what_is_left(spark, index):
    out, args = str(index / "out.clp"), dict(fasta=str(index / "reads.fasta"))
    assign_reads(spark, str(index / "index"), out, read_offset=2, **args)
    assert [x.split(":")[0] for x in lines(out)] == ["r3-13"]
    assert mapped(spark, out) == ["none", "r3-13"]
    for _ in range(2):
        assign_reads(spark, str(index / "index"), out, **args)
        assert sorted(x.split(":")[0] for x in lines(out)) == ["r1-11", "r2-12", "r3-13"]
        assert mapped(spark, out) == ["none", "r1-11", "r2-12", "r3-13"]
    assign_reads(spark, str(index / "index"), out, read_offset=3, force_overwrite=True, **args)
    assert lines(out) == [] and mapped(spark, out) == ["none"]


@pytest.mark.parametrize("ending", ["", "/"])
def test_resume_after_a_failure_between_batches(spark, index, monkeypatch, ending):
    """Each file a batch; the second one fails, before its lines or after them; the run after it maps each read once."""
    (index / "in").mkdir()
    records = (index / "reads.fasta").read_text().split(">")[1:]
    for k, record in enumerate(records):
        (index / "in" / f"{k}.fasta").write_text(f">{record}")
    results, calls = f"{index}/results{ending}", []
    true = mapping.assign

    def failing(reads, *args, **kwargs):
        calls.append(sorted(r[0] for r in reads.select("read_id").collect()))
        if len(calls) == 2:
            raise RuntimeError("stopped")
        return true(reads, *args, **kwargs)

    monkeypatch.setattr(mapping, "assign", failing)
    args = dict(fasta=str(index / "in"), batch_files=1)
    with pytest.raises(Exception, match="stopped"):
        assign_reads(spark, str(index / "index"), results, **args)
    assert len(mapped(spark, f"{index}/results")) == 1
    assign_reads(spark, str(index / "index"), results, **args)
    assert mapped(spark, f"{index}/results") == ["none", "r1-11", "r2-12", "r3-13"] and len(calls) == 5 and calls[1] == calls[2]
    # a new file is taken up, with a read that was mapped before and one that wasn't
    (index / "in/9.fasta").write_text(f">{records[0]}>new\n{records[1].split()[1]}\n")
    assign_reads(spark, str(index / "index"), results, **args)
    assert calls[5:] == [["new"]]
    text = "".join(p.read_text() for p in sorted((index / "results").rglob("part-*"))) if ending else (index / "results").read_text()
    assert sorted(x.split(":")[0] for x in text.splitlines()) == ["new", "r1-11", "r2-12", "r3-13"]


def test_results_without_a_state_are_kept(spark, index):
    (index / "out.clp").write_text("r1-11:5=0\n")
    assign_reads(spark, str(index / "index"), str(index / "out.clp"), fasta=str(index / "reads.fasta"))
    got = lines(index / "out.clp")
    assert got[0] == "r1-11:5=0" and sorted(x.split(":")[0] for x in got[1:]) == ["r2-12", "r3-13"]


def test_the_index_is_not_shuffled(spark, index):
    """Reads' seeds go to the buckets: no exchange stands above a scan of the seeds before its join or count."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        reads = spark.createDataFrame([("a", "ACGTTGCA" * 9)], "read_id string, seq string")
        found = seeds.candidates(reads, read_seeds(spark, str(index / "index")))
        tree = found._jdf.queryExecution().executedPlan().toString().split("\n")
        scans = 0
        for k, line in enumerate(tree):
            if "FileScan parquet" not in line:
                continue
            scans += 1
            depth = line.index("FileScan")
            above = []
            for x in reversed(tree[:k]):
                at = len(x) - len(x.lstrip(" :+-"))
                if at < depth:
                    above.append(x.strip(" :+-"))
                    depth = at
            until = next(i for i, x in enumerate(above) if "Join" in x)
            assert not any("Exchange" in x for x in above[: until + 1]) and "Bucketed: true" in line
        assert scans == 2 and found.collect() == []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_equal_reads_are_mapped_once(spark):
    text = "".join(random.Random(7).choices("ACGT", k=400))
    refs = spark.createDataFrame([("a", 1, text)], "seqid string, taxid bigint, seq string")
    rows = [*((f"r{k}", text[50:150]) for k in range(5)), ("low", text[50:150].lower()), ("other", text[200:260])]
    got = seeds.assign(spark.createDataFrame(rows, "read_id string, seq string"), seeds.build_index(refs), refs).collect()
    assert {(r.read_id, r.pos, r.edit) for r in got} >= {(n, 51 if n != "other" else 201, 0) for n, _ in rows}


def test_limits(spark, index):
    out, args = str(index / "out.clp"), dict(fasta=str(index / "reads.fasta"), force_overwrite=True)
    assign_reads(spark, str(index / "index"), out, max_hits=0, **args)
    assert lines(out) == []
    assign_reads(spark, str(index / "index"), out, max_candidates=1, max_assignments=1, tune_max_hits=0, **args)
    assert [x.split(":")[0] for x in lines(out)] == ["r1-11", "r2-12", "r3-13"] and all(x.endswith("-21=0") for x in lines(out))


def test_append(spark, index):
    more = index / "more.fasta"
    more.write_text(">9-19\n" + "ACGTTGCA" * 20 + "\n")
    index_build(spark, str(more), str(index / "index"), append=True)
    assert spark.read.parquet(str(index / "index/blocks")).select("seqid").distinct().count() == 4
    with pytest.raises(ValueError, match="more than one sequence"):
        index_build(spark, str(more), str(index / "index"), append=True)


def test_staged_annotations_are_read(spark, tmp_path, caplog):
    """The same table from the raw annotations and from the staged ones."""
    (tmp_path / "data/A1").mkdir(parents=True)
    (tmp_path / "data/A1/x_genomic.fna").write_text(">c1 one\nACGT\n")
    (tmp_path / "data/A1/x.gff").write_text("c1\ts\tCDS\t1\t9\t.\t+\t0\tID=cds-g1;product=p\nc1\ts\tCDS\t5\t10000000000000\t.\t+\t0\tID=g2\n")
    (tmp_path / "data/A1/x.faa").write_text(">g1 some\nMKV\n")
    (tmp_path / "report.tsv").write_text("accession\ttaxid\nA1\t7\n")
    (tmp_path / "a.clp").write_text("r1:7-1-6=0\nr2:7-1-20=1\n")
    got = []
    for staged in (False, True):
        out = tmp_path / f"out{staged}"
        reference_build(spark, str(tmp_path / "data"), str(tmp_path / "report.tsv"), str(out), 1, index_gff=staged)
        table = out / "reference.map.tsv"
        assert ("reference.cds" in table.read_text()) == staged
        assert annotate(spark, str(tmp_path / "a.clp"), [str(table)] * 2, str(out / "t.tsv"), str(out / "p.faa"), strict=True) == 2
        got.append(((out / "t.tsv").read_text(), (out / "p.faa").read_text()))
    assert got[0] == got[1] and got[0][0].count("g2") == 2 and got[0][1] == ">1 g1 some\nMKV\n"
    assert "more than one map table" in caplog.text


def test_no_sequence_reaches_the_numbering(spark):
    """Sequences are dealt once, by assembly and place, however large the tables are; nothing numbers or sorts them."""
    contigs = spark.createDataFrame([("A", (k,), "x", "x", "ACGT") for k in range(5)], "assembly string, at struct<k: int>, id string, description string, seq string")
    report = spark.createDataFrame([(1, "A", 7)], "ordinal int, assembly string, taxid bigint")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keyed = key_contigs(contigs, report)
        text = keyed._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"Exchange hashpartitioning\(assembly#\d+, at#\d+, ", text)) == 2
        assert not re.search(r"hashpartitioning\(assembly#\d+, \d+\)|SinglePartition.*seq#", text)
        assert sorted((r.at.k, r.seqid, r.taxid, r.seq) for r in keyed.collect()) == [(k, k + 1, 7, "ACGT") for k in range(5)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_directories_of_parts(spark, tmp_path):
    df = spark.range(100).select(F.col("id").cast("string").alias("value"), "id")
    write_lines(df, f"{tmp_path}/a/", order=["id"])
    write_table(df, f"{tmp_path}/b/")
    assert [x for part in sorted((tmp_path / "a").glob("part-*")) for x in part.read_text().splitlines()] == [str(k) for k in range(100)]
    assert spark.read.csv(f"{tmp_path}/b", sep="\t", header=True).count() == 100


@pytest.mark.parametrize("inline", [10_000, 1])
@pytest.mark.parametrize("ending", ["", "/"])
def test_filter_in_one_pass(spark, tmp_path, monkeypatch, inline, ending):
    """Lines in order over many splits and files, looked up or joined; the counters of the same pass."""
    monkeypatch.setattr(filters, "INLINE", inline)
    rng = random.Random(inline)
    rows = [[f"r{k}x{i}:" + ",".join(f"{rng.randint(1, 4)}-s-{rng.randint(1, 99)}={rng.randint(0, 4)}" for _ in range(rng.randint(0, 4))) for i in range(200)] for k in range(3)]
    for k in (2, 0, 1):
        (tmp_path / f"{k}.clp").write_text("\n".join(rows[k]) + "\n\n")
    (tmp_path / "in.txt").write_text("1\n2\n3\n")
    (tmp_path / "out.txt").write_text("2\n")
    want, counts = [], dict.fromkeys(("kept_reads", "kept_hits", "removed_reads", "removed_hits"), 0)
    for line in (x for part in rows for x in part):
        name, _, text = line.partition(":")
        hits = [h for h in text.split(",") if h]
        left = [h for h in hits if h[0] in "13"]
        left = [h for h in left if int(h[-1]) <= min(int(x[-1]) for x in left) + 1]
        if left:
            want.append(f"{name}:{','.join(left)}")
        counts["kept_reads" if left else "removed_reads"] += 1
        counts["kept_hits"] += len(left)
        counts["removed_hits"] += len(hits) - len(left)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = filter_file(spark, f"{tmp_path}/*.clp", f"{tmp_path}/kept{ending}", f"{tmp_path}/in.txt", f"{tmp_path}/out.txt", 1)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == counts
    if ending:
        text = sorted(x for p in (tmp_path / "kept").rglob("part-*") for x in p.read_text().splitlines())
        assert text == sorted(want)
    else:
        assert lines(tmp_path / "kept") == want


def test_filtering_is_not_shuffled(spark, tmp_path):
    (tmp_path / "a.clp").write_text("r:1=0\n")
    taxa = spark.createDataFrame([(1,)], "taxid bigint")
    rows = filters.kept_lines(filters.filter_hits(read_assignments(spark, f"{tmp_path}/a.clp"), include=taxa)).sortWithinPartitions("at")
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("inline", [10_000, 1])
def test_stream_with_tables_of_taxa(spark, tmp_path, monkeypatch, inline):
    monkeypatch.setattr(filters, "INLINE", inline)
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.clp").write_text("r:1=3,2=0,3=1\ns:2=0\nt:1=1,1=2\n")
    include = spark.createDataFrame([(k,) for k in (1, 2, 3)], "taxid bigint")
    exclude = spark.createDataFrame([(2,)], "taxid bigint")
    args = (spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check"), include, exclude, 1)
    query = start_filter(*args)
    query.awaitTermination()
    if inline > 1:
        assert query.lastProgress.observedMetrics["counters"].asDict() == {"kept_reads": 2, "kept_hits": 3, "removed_reads": 1, "removed_hits": 3}
    (tmp_path / "in/b.clp").write_text("u:3=1,1=1\n")
    start_filter(*args).awaitTermination()
    got = sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect())
    assert got == ["r:3=1", "t:1=1,1=2", "u:3=1,1=1"]


@pytest.mark.parametrize("fuzzy", [0, 700_000])
def test_staged_annotations_are_pruned_by_place(spark, tmp_path, fuzzy):
    """The slices of the places alone are read, and nothing that holds a place is lost: long, wide and wild sequences."""
    rng = random.Random(fuzzy)
    rows = []
    for k in range(300):
        start = rng.randint(-5, 60_000_000)
        rows.append((f"c{k % 3}", start, start + rng.choice([30, 900, 3_000_000, 17_000_000, 40_000_000]), k))
    rows += [("c0", -9, -3, 300), ("c1", 1, (1 << 63) - 1, 301)]
    (tmp_path / "x.gff").write_text("".join(f"{c}\ts\tCDS\t{s}\t{e}\t.\t+\t0\tID=g{k}\n" for c, s, e, k in rows))
    files = {"A": str(tmp_path / "x.gff")}
    path = stage_gff(spark, files, str(tmp_path / "r.cds"))
    staged = {"A": path}
    order = ["contig", "start", "end", "cds_id", "product"]
    assert read_gff(spark, staged).orderBy(order).collect() == read_gff(spark, files).orderBy(order).collect()
    places = spark.createDataFrame([("A", c, rng.randint(1, 70_000_000)) for c in ("c0", "c1", "c9") for _ in range(6)], "assembly string, accession string, pos bigint")
    pruned = read_gff(spark, staged, places, fuzzy)
    assert "dynamicpruning" in pruned._jdf.queryExecution().executedPlan().toString()
    found = lambda cds: sorted(intervals.cds_at(places, cds, fuzzy).collect())
    assert found(pruned) == found(read_gff(spark, files)) != []
    assert pruned.select("cds_id").distinct().count() < 302


def test_shuffle_files_go_when_a_table_is_written(spark):
    """What the shuffles of a written table leave, tables around a scratch, and the session's setting."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        blocks = disk.getAllBlocks()
        return {name for k in range(blocks.size()) if (name := blocks.apply(k).name()).startswith("shuffle_")}

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    had, was = shuffles(), spark.conf.get(setting)
    with scratch(spark):
        with scratch(spark) as write:
            rows = write(spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 10).alias("k")).count(), "rows")
        assert rows.count() == 10
        path = rows.inputFiles()[0].removeprefix("file://")
    for _ in range(50):  # they go in the background
        left = {x for x in shuffles() - had if x.endswith(".data")}
        if len(left) <= 1:  # of the count
            break
        time.sleep(0.1)
    assert len(left) <= 1 and spark.conf.get(setting) == was and not Path(path).exists()


def test_tables_of_threads_are_their_own(spark):
    """A table that another thread makes isn't deleted with this thread's scratch."""
    made = []
    with scratch(spark):
        thread = threading.Thread(target=lambda: made.append(materialize(spark.range(3), "other")))
        thread.start()
        thread.join()
        mine = materialize(spark.range(2), "mine")
        assert mine.count() == 2
    assert made[0].count() == 3
    with pytest.raises(Exception, match="(?i)not exist|FILE_NOT_EXIST|FAILED_READ"):
        mine.collect()


def test_seeds_of_reads_alone_are_stored(spark, monkeypatch):
    """The rows of an index that some read asks for, and the same assignments as with the whole index, both ways."""
    rng = random.Random(9)
    text = "".join(rng.choice("ACGT") for _ in range(900))
    refs = spark.createDataFrame([("1", 5, text), ("2", 6, text[300:700].lower())], "seqid string, taxid bigint, seq string")
    reads = spark.createDataFrame([("a", text[320:380]), ("b", seeds_reverse(text[40:100])), ("c", "ACGT")], "read_id string, seq string")
    whole = seeds.build_index(refs)
    wanted = {r.seed for r in seeds.read_seeds(reads).collect()}
    rows = sorted(r for r in map(tuple, whole.collect()) if r[0] in wanted)
    for sent in (seeds.SENT, 0):
        monkeypatch.setattr(seeds, "SENT", sent)
        some = seeds.seeds_of(reads, refs)
        assert sorted(map(tuple, some.collect())) == rows != []
        assert sorted(seeds.assign(reads, some, refs).collect()) == sorted(seeds.assign(reads, whole, refs).collect()) != []


def seeds_reverse(seq):
    return seq[::-1].translate(str.maketrans("ACGT", "TGCA"))
