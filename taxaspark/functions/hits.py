"""Assignment lines ``<read id>:<hit>,<hit>...`` and their hits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from taxaspark.functions.text import int_like_python, strip

#: The two forms of a hit, taxid-seqid-position=edit and taxid=edit.
HIT = "^[0-9]+(-[^-]+-[0-9]+)?=[0-9]+$"
#: Where a hit of either form is cut; a sequence's name may hold ``=``.
_CUT = "-|=(?=[0-9]+$)"
#: Hits of plain digits, which are cut without more ado: the number before the first sign, and the one after the last.
_PLAIN = "^[0-9]{1,18}(-[^=]*)?=[0-9]{1,18}\\z"


def read_id(line: Column) -> Column:
    """What stands before the last colon; the whole line if there is none."""
    return F.when(F.instr(line, ":") > 0, F.substring(line, F.lit(1), F.length(line) - F.length(F.substring_index(line, ":", -1)) - 1)).otherwise(line)


def hit_tokens(line: Column) -> Column:
    """Hits after the last colon, without empty ones; none without a colon."""
    return F.array_remove(F.split(F.when(F.instr(line, ":") > 0, F.substring_index(line, ":", -1)).otherwise(F.lit("")), ","), "")


def lenient_hit(token: Column) -> Column:
    """raw, taxid and edit by the rules of filtering: edit after the last ``=``, taxid before the first ``-`` of the rest.

    Null where there is no ``=`` or either number isn't one.
    """
    after = F.substring_index(token, "=", -1)
    hit = lambda taxid, edit: F.struct(token.alias("raw"), taxid.alias("taxid"), edit.alias("edit"))
    plain = hit(F.substring_index(F.substring_index(token, "=", 1), "-", 1).try_cast("bigint"), after.try_cast("bigint"))
    left = F.substring(token, F.lit(1), F.length(token) - F.length(after) - 1)
    taxid, edit = int_like_python(F.substring_index(left, "-", 1)), int_like_python(after)
    other = F.when((F.instr(token, "=") > 0) & edit.isNotNull() & taxid.isNotNull(), hit(taxid, edit))
    return F.when(token.rlike(_PLAIN), plain).otherwise(other)


def strict_hit(token: Column) -> Column:
    """taxid, seqid, pos and edit by the rules of annotation; null where neither form fits or a number is beyond 64 bits.

    The form without a sequence has seqid ``""`` and pos 0. Seqid stays a string: ``007`` is not ``7``.
    """

    def hit(parts: Column) -> Column:
        number = lambda k: F.get(parts, F.lit(k)).try_cast("bigint")
        full = F.size(parts) == 4
        pos, edit = F.when(full, number(2)).otherwise(F.lit(0).cast("bigint")), F.when(full, number(3)).otherwise(number(1))
        found = F.struct(number(0).alias("taxid"), F.when(full, F.get(parts, F.lit(1))).otherwise(F.lit("")).alias("seqid"), pos.alias("pos"), edit.alias("edit"))
        return F.when(number(0).isNotNull() & pos.isNotNull() & edit.isNotNull(), found)

    token = strip(token)
    # an array of one names the parts, so that each hit is matched and cut once
    return F.get(F.transform(F.array(F.when(token.rlike(HIT), F.split(token, _CUT))), hit), F.lit(0))


def strict_hits_of(tokens: Column) -> Column:
    """raw and h of each token, to be exploded: a filter on what a generator makes isn't pushed below it, and nothing is parsed twice."""
    return F.transform(tokens, lambda t: F.struct(t.alias("raw"), strict_hit(t).alias("h")))


def render_line(read: Column, raws: Column) -> Column:
    return F.concat(read, F.lit(":"), F.array_join(raws, ","))
