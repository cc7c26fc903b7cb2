"""Whole commands, from files to files."""

from taxaspark.plans.annotation import annotate
from taxaspark.plans.filtering import filter_file
from taxaspark.plans.mapping import assign_reads, extract_reads, index_build, merge_files
from taxaspark.plans.reference import reference_build

__all__ = ["annotate", "assign_reads", "extract_reads", "filter_file", "index_build", "merge_files", "reference_build"]
