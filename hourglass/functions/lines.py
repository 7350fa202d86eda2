"""Line-level expressions for delimited text.

The raw crash export has 29 comma-separated cells, two of which may hold a comma
inside them: the location cell ``"(lat, lon)"`` and quoted street names. The
repair is one regular-expression branch chosen by the comma count, exactly one
branch per line, so a line with both problems stays broken and is quarantined.
Both patterns are greedy and run through Java regex inside the JVM.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the crash export layout.
CRASH_FIELDS = 29                 # cells in a raw line
CRASH_DROP_ORDINALS = (6, 10, 11)  # location cell, persons injured, persons killed
MAX_COMMAS = CRASH_FIELDS - 1
PAREN_PATTERN = r"\(.*\)"          # greedy: first '(' to last ')'
QUOTED_COMMA_PATTERN = r'"(.*),(.*)"'  # greedy: drops the last comma inside the outer quotes
QUOTED_COMMA_REPLACEMENT = "$1$2"
FILL_VALUE = "-1"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def comma_count(c) -> Column:
    """Commas in the line (a plain string replace; cheaper than a regex count)."""
    c = _col(c)
    return F.length(c) - F.length(F.replace(c, F.lit(","), F.lit("")))


def strip_parenthesised(c) -> Column:
    """Delete from the first ``(`` to the last ``)``."""
    return F.regexp_replace(_col(c), PAREN_PATTERN, "")


def unquote_comma(c) -> Column:
    """``"A, B, C"`` becomes ``A, B C`` (last inner comma and the quotes go)."""
    return F.regexp_replace(_col(c), QUOTED_COMMA_PATTERN, QUOTED_COMMA_REPLACEMENT)


def repair_delimiters(c, max_commas: int = MAX_COMMAS) -> Column:
    """Only lines with too many commas are touched; parentheses win over quotes."""
    c = _col(c)
    fixed = F.when(c.rlike(PAREN_PATTERN), strip_parenthesised(c)).otherwise(unquote_comma(c))
    return F.when(comma_count(c) > F.lit(max_commas), fixed).otherwise(c)


def is_well_formed(repaired, n_fields: int = CRASH_FIELDS) -> Column:
    """C7 test on a repaired line: exactly ``n_fields`` cells, i.e. ``n_fields - 1``
    commas (same answer as splitting, without building the array). Meant for a
    projected flag; to filter rows that are split anyway, test ``size`` of the split
    (a pushed-down filter gets no common-subexpression elimination, and this form
    reads the line twice)."""
    return comma_count(repaired) == F.lit(n_fields - 1)


def split_fields(c) -> Column:
    """C4: split on commas keeping trailing empty cells."""
    return F.split(_col(c), ",", -1)


def split_fields_trimmed(c) -> Column:
    """Split like Java's ``String.split(",")``: trailing empty cells are dropped."""
    return F.split(F.regexp_replace(_col(c), ",+$", ""), ",", -1)


def project_ordinals(arr, n_fields: int = CRASH_FIELDS,
                     drop: Sequence[int] = CRASH_DROP_ORDINALS) -> list[Column]:
    """The kept cells (0-based ordinals) as separate columns."""
    arr = _col(arr)
    return [F.try_element_at(arr, F.lit(i + 1)) for i in range(n_fields) if i not in set(drop)]


def fill_empty(c, fill: str = FILL_VALUE) -> Column:
    """Empty cell to the sentinel."""
    c = _col(c)
    return F.when(c == F.lit(""), F.lit(fill)).otherwise(c)


def join_fields(cols: Iterable) -> Column:
    """Cells back to one comma-separated line."""
    return F.concat_ws(",", *[_col(c) for c in cols])
