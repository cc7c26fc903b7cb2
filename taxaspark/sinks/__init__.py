"""Writers. Spark writes directories of parts; :func:`single_file` makes one file of them where a user wants a file."""

from taxaspark.sinks.files import single_file, touch, write_files, write_lines, write_splits, write_table

__all__ = ["single_file", "touch", "write_files", "write_lines", "write_splits", "write_table"]
