"""Text and attribute functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters that Python's str.strip removes.
WHITE = r"[\t-\r\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"


def strip(c: Column) -> Column:
    """Without white space at both ends, of any kind."""
    return F.regexp_replace(c, f"^{WHITE}+|{WHITE}+$", "")


def int_like_python(c: Column) -> Column:
    """Long where Python's int() takes the text (ASCII digits, sign, single underscores, white space around); else null.

    Numbers beyond 64 bits give null.
    """
    return F.when(c.rlike(f"^{WHITE}*[+-]?[0-9]+(_[0-9]+)*{WHITE}*$"), F.replace(strip(c), F.lit("_"), F.lit("")).try_cast("bigint"))


def _pairs(attrs: Column) -> Column:
    """Stripped ``key=value`` parts of a GFF attribute column, in order."""
    return F.filter(F.transform(F.split(attrs, ";"), strip), lambda p: F.instr(p, "=") > 0)


def _value(pair: Column) -> Column:
    return F.substring(pair, F.instr(pair, "=") + 1, F.length(pair))


def attribute(attrs: Column, key: str) -> Column:
    """Value of the last ``key`` in a GFF attribute column, which may hold ``=``; null where it is absent."""
    hits = F.filter(_pairs(attrs), lambda p: p.startswith(f"{key}="))
    return _value(F.try_element_at(hits, F.lit(-1)))


def attributes(attrs: Column) -> Column:
    """All attributes as a map; of repeated keys the last one counts."""
    entries = F.transform(_pairs(attrs), lambda p: F.struct(F.substring_index(p, "=", 1).alias("k"), _value(p).alias("v")))
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.greatest(F.size(entries), F.lit(1))), lambda x: x["k"] == e["k"]))
    return F.map_from_entries(last)


def first_filled(*cs: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cs])


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)
