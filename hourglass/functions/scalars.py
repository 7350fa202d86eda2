"""Column-level functions.

All of them return ``Column`` expressions built from Spark built-ins, so they stay
inside whole-stage codegen. Parsing is tolerant (``try_*``): Spark runs with ANSI
mode on, where a bad date or number would otherwise fail the whole job.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed values that must equal the source project's encodings.
# Weather labels in code order 0..9 (the encoding used by the final model).
WEATHER_LABELS = (
    "sleet",
    "wind",
    "snow",
    "fog",
    "rain",
    "partly-cloudy-night",
    "clear-night",
    "cloudy",
    "partly-cloudy-day",
    "clear-day",
)
# Text formats of the raw inputs.
CRASH_TS_FORMAT = "MM/dd/yyyy H:mm"
CRASH_DATE_FORMAT = "MM/dd/yyyy"
CONTEXT_TS_FORMAT = "MM/dd/yyyy h:m:s a"
# Sentinel written by the line cleaner for an empty cell, and its label.
SENTINEL = "-1"
UNSPECIFIED = "Unspecified"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- strings and times -------------------------------------------------------

def concat_date_time(date_col: ColumnOrName, time_col: ColumnOrName) -> Column:
    """``date + ' ' + time``; null when either part is null (``concat`` semantics)."""
    return F.concat(_col(date_col), F.lit(" "), _col(time_col))


def parse_timestamp(c: ColumnOrName, fmt: str) -> Column:
    """Tolerant parse to wall-clock ``timestamp_ntz``; bad or blank text gives null.

    Parsed straight to ``timestamp_ntz`` so the session time zone never shifts a
    wall-clock time (a local time skipped by a daylight-saving change stays as
    written); ``try_to_timestamp`` only guards against text that does not parse.
    """
    c, f = _col(c), F.lit(fmt)
    return F.when(F.try_to_timestamp(c, f).isNotNull(), F.to_timestamp_ntz(c, f))


def parse_crash_ts(c: ColumnOrName) -> Column:
    """``MM/dd/yyyy H:mm``."""
    return parse_timestamp(c, CRASH_TS_FORMAT)


def parse_crash_date(c: ColumnOrName) -> Column:
    """``MM/dd/yyyy`` to ``date``."""
    return F.try_to_date(_col(c), CRASH_DATE_FORMAT)


def parse_context_ts(c: ColumnOrName) -> Column:
    """12-hour clock ``MM/dd/yyyy h:m:s a``."""
    return parse_timestamp(c, CONTEXT_TS_FORMAT)


_TRUNC_UNITS = ("year", "month", "day", "hour", "minute")


def trunc_time(c: ColumnOrName, unit: str = "hour") -> Column:
    """Round down to year / month / day / hour / minute as ``timestamp_ntz``.

    Rebuilt from the wall-clock fields, so the result does not depend on the
    session time zone (``date_trunc`` would pass through a zoned timestamp).
    """
    c = _col(c)
    keep = _TRUNC_UNITS.index(unit.lower())
    fields = [F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c)]
    floor = [None, F.lit(1), F.lit(1), F.lit(0), F.lit(0)]
    parts = [fields[i] if i <= keep else floor[i] for i in range(len(fields))]
    return F.make_timestamp_ntz(*parts, F.lit(0))


def hour_of(c: ColumnOrName) -> Column:
    """Hour 0-23."""
    return F.hour(_col(c))


def hour_group(c: ColumnOrName, width: int = 4) -> Column:
    """``floor(hour / width)``; 0-5 for the default width."""
    return F.floor(F.hour(_col(c)) / F.lit(width)).cast("int")


def day_of_week(c: ColumnOrName) -> Column:
    """Sunday = 1 ... Saturday = 7."""
    return F.dayofweek(_col(c))


def day_monday_first(c: ColumnOrName) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return (F.weekday(_col(c)) + F.lit(1)).cast("int")


# --- lookups and recodes -----------------------------------------------------

def recode(c: ColumnOrName, mapping: Mapping, default=None) -> Column:
    """Literal map lookup with an optional default for unknown keys.

    The map is a literal in the plan (constant-folded, no join). For a mapping that
    grows with data use a broadcast join against a lookup table instead.
    """
    lookup = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    value = F.try_element_at(lookup, _col(c))
    return value if default is None else F.coalesce(value, F.lit(default))


def encode_weather(c: ColumnOrName, labels=WEATHER_LABELS) -> Column:
    """X11: weather label to its position in ``labels`` (0..9 for the default order);
    unknown or null gives a null int."""
    return recode(c, {label: code for code, label in enumerate(labels)}).cast("int")


def decode_weather(code: ColumnOrName) -> Column:
    """Inverse of X11 for building views: code 0..9 to label, anything else null."""
    return recode(code, dict(enumerate(WEATHER_LABELS)))


def sentinel_to_label(c: ColumnOrName, sentinel: str = SENTINEL, label: str = UNSPECIFIED) -> Column:
    """Replace one sentinel value, keep every other value (and nulls)."""
    c = _col(c)
    return F.when(c == F.lit(sentinel), F.lit(label)).otherwise(c)


def null_flag(c: ColumnOrName) -> Column:
    """1 when present, 0 when null (``has_event``)."""
    return _col(c).isNotNull().cast("int")


def null_to_zero(c: ColumnOrName) -> Column:
    """Null to 0."""
    return F.coalesce(_col(c), F.lit(0))


def label_any_match(c: ColumnOrName) -> Column:
    """0 when the value is null (no matching fact), else 1."""
    return F.when(_col(c).isNull(), F.lit(0)).otherwise(F.lit(1))


def label_positive(c: ColumnOrName) -> Column:
    """0 when the value equals 0, else 1 (a null also gives 1)."""
    return F.when(_col(c) == F.lit(0), F.lit(0)).otherwise(F.lit(1))


# --- numbers -----------------------------------------------------------------

def tolerant_cast(c: ColumnOrName, dtype: str) -> Column:
    """J2 element: cast that yields null instead of failing on bad text."""
    return _col(c).try_cast(dtype)


def row_sum(cols: Iterable[ColumnOrName]) -> Column:
    """Sum across columns; null when any input is null."""
    return reduce(lambda a, b: a + b, (_col(c) for c in cols))


def fraction(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Ratio as double; null instead of an error on a zero denominator."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))
