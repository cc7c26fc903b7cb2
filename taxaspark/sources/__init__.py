"""Readers: each returns a DataFrame and reads through Spark, so that any path that Spark opens will do."""

from taxaspark.sources.assignments import read_assignments
from taxaspark.sources.fasta import read_fasta, read_fasta_of, read_fastq, read_reads
from taxaspark.sources.gff import read_gff
from taxaspark.sources.layout import assembly_files
from taxaspark.sources.mapping import read_mapping
from taxaspark.sources.report import read_report
from taxaspark.sources.taxa import read_taxa, read_taxonomy

__all__ = ["assembly_files", "read_assignments", "read_fasta", "read_fasta_of", "read_fastq", "read_gff", "read_mapping", "read_reads", "read_report", "read_taxa", "read_taxonomy"]
