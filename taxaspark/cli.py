"""``python -m taxaspark.cli``: the commands."""

from __future__ import annotations

import argparse
import logging
import sys

from taxaspark import __version__

log = logging.getLogger(__name__)
#: Options that other engines need and Spark doesn't: taken, and named in the log.
NO_MEANING = {"threads", "chunk_size", "tmpdir", "bwt_occ_sample_rate", "sa_sample_rate"}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="taxaspark", description="Read assignments on Spark.")
    top.add_argument("--version", action="version", version=__version__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, text: str) -> argparse.ArgumentParser:
        p = commands.add_parser(name, help=text, description=text)
        p.add_argument("-v", "--verbose", action="count", default=0)
        return p

    p = command("reference-build", "Genomes to keyed FASTA chunks, a map table and a summary.")
    for name in ("data-dir", "report", "out-dir"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--max-size-mb", type=int, required=True)
    p.add_argument("--map-out", "--map_out")
    p.add_argument("--summary-out")
    p.add_argument("--index-gff", action="store_true")
    p.add_argument("--force-reindex", action="store_true")
    p.add_argument("--prefix", default="reference")
    p.add_argument("--log")

    p = command("index-build", "Seed table of reference chunks.")
    p.add_argument("-f", "--fasta", required=True)
    p.add_argument("-i", "--index", required=True)
    p.add_argument("--mapping")
    p.add_argument("--bwt-occ-sample-rate", type=int, default=64)
    p.add_argument("--sa-sample-rate", type=int, default=32)
    p.add_argument("--skip-missing", action="store_true")
    p.add_argument("--seed-size", type=int, default=18)
    p.add_argument("--append", action="store_true")

    p = command("assign", "Map reads to references.")
    p.add_argument("--fasta")
    p.add_argument("--fastq")
    p.add_argument("--index", required=True)
    p.add_argument("-m", "--results", required=True)
    for name, kind, default in (("max-assignments", int, None), ("max-candidates", int, None), ("max-hits", int, 2000), ("tune-max-hits", int, 200), ("seed-size", int, 18), ("min-seed", float, 0.015), ("seed-interval", int, 15), ("read-offset", int, 0)):
        p.add_argument(f"--{name}", type=kind, default=default)
    p.add_argument("-e", "--edit-rate", type=float, default=0.13)
    p.add_argument("-t", "--threads", type=int, default=4)
    p.add_argument("--force-overwrite", action="store_true")

    p = command("merge", "Merge the hits of reads over inputs.")
    p.add_argument("--mode", choices=["taxid", "taxid-gi"], default="taxid")
    p.add_argument("-o", "--output", required=True)
    p.add_argument("--report")
    p.add_argument("-t", "--threads", type=int, default=4)
    p.add_argument("inputs", nargs="*")

    p = command("filter", "Filter hits by taxa and edit distance.")
    p.add_argument("--input", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--include-taxa")
    p.add_argument("--exclude-taxa")
    p.add_argument("--edit-delta", type=int, default=0)
    p.add_argument("--log")

    p = command("annotate", "Name hits, and find their coding sequences and proteins.")
    p.add_argument("assignments", nargs="+")
    p.add_argument("--map-table", action="append", nargs="+", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--proteins-out", required=True)
    p.add_argument("--taxonomy-names")
    p.add_argument("--taxonomy-merged")
    p.add_argument("--taxa-only", action="store_true")
    p.add_argument("--chunk-size", type=int, default=500_000)
    p.add_argument("--tmpdir")
    p.add_argument("--fuzzy", type=int, default=0)
    p.add_argument("--strict", action="store_true")

    p = command("extract-reads", "Split reads by whether they have an assignment.")
    p.add_argument("--fasta")
    p.add_argument("--fastq")
    p.add_argument("--assignments", action="append", required=True)
    p.add_argument("--matched", required=True)
    p.add_argument("--unmatched", required=True)
    return top


def run(args: argparse.Namespace) -> None:
    from taxaspark import plans
    from taxaspark.session import session

    a = vars(args)
    for name in sorted(NO_MEANING & a.keys()):
        log.info("--%s has no meaning here", name.replace("_", "-"))
    if args.command in ("assign", "extract-reads") and bool(args.fasta) == bool(args.fastq):
        raise ValueError("give exactly one of --fasta and --fastq")
    spark = session()
    pick = lambda *names: {n: a[n] for n in names}
    if args.command == "reference-build":
        plans.reference_build(spark, **pick("data_dir", "report", "out_dir", "max_size_mb", "map_out", "summary_out", "index_gff", "force_reindex", "prefix"))
    elif args.command == "index-build":
        plans.index_build(spark, **pick("fasta", "index", "mapping", "skip_missing", "seed_size", "append"))
    elif args.command == "assign":
        plans.assign_reads(spark, **pick("index", "results", "fasta", "fastq", "max_assignments", "max_candidates", "max_hits", "tune_max_hits", "seed_size", "min_seed", "seed_interval", "edit_rate", "read_offset", "force_overwrite"))
    elif args.command == "merge":
        plans.merge_files(spark, **pick("inputs", "output", "mode", "report"))
    elif args.command == "filter":
        plans.filter_file(spark, args.input, **pick("out", "include_taxa", "exclude_taxa", "edit_delta"))
    elif args.command == "annotate":
        tables = [t for group in args.map_table for t in group]
        plans.annotate(spark, args.assignments, tables, taxonomy=args.taxonomy_names, merged=args.taxonomy_merged, **pick("out", "proteins_out", "taxa_only", "fuzzy", "strict"))
    else:
        plans.extract_reads(spark, **pick("assignments", "matched", "unmatched", "fasta", "fastq"))


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.DEBUG if args.verbose else logging.INFO, filename=getattr(args, "log", None), format="%(asctime)s %(levelname)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    try:
        run(args)
    except (ValueError, FileNotFoundError) as e:
        print(f"taxaspark {args.command}: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
