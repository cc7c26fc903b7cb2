"""Column functions: no UDFs, all of them expressions of the JVM."""

from taxaspark.functions.fasta import record_bytes, safe_header, wrap
from taxaspark.functions.hits import hit_tokens, lenient_hit, read_id, render_line, strict_hit, strict_hits_of
from taxaspark.functions.text import attribute, attributes, base_name, first_filled, int_like_python, strip

__all__ = ["attribute", "attributes", "base_name", "first_filled", "hit_tokens", "int_like_python", "lenient_hit", "read_id", "record_bytes", "render_line", "safe_header", "strict_hit", "strict_hits_of", "strip", "wrap"]
