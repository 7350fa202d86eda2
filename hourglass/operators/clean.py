"""Table-level line cleaning.

All operators are map-only projections except ``distinct_lines`` (one shuffle with
map-side de-duplication) and the optional byte-order sort (range partitioned, so
no single reducer holds every line).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.functions import lines as L


def with_row_key(df: DataFrame, key_col: str | None = None, out: str = "row_key") -> DataFrame:
    """A unique row key. An existing key column (e.g. byte offsets) is reused;
    otherwise ``monotonically_increasing_id`` (unique, not dense, partition-dependent)."""
    key = F.col(key_col) if key_col else F.monotonically_increasing_id()
    return df.withColumn(out, key.cast("bigint"))


def quarantine_malformed(df: DataFrame, value_col: str = "value",
                         n_fields: int = L.CRASH_FIELDS) -> DataFrame:
    """C7 as a flag: ``is_malformed`` is true when the repaired line has the wrong cell count."""
    repaired = L.repair_delimiters(value_col, n_fields - 1)
    return df.withColumn("is_malformed", ~L.is_well_formed(repaired, n_fields))


def computed_once(*cols) -> "F.Column":
    """Emit ``cols`` as one generated row per input row (``inline`` of a one-element array).

    Spark pushes a filter below the projection that computes the columns it reads,
    substituting the expressions, and filter conditions get no common-subexpression
    elimination. Each predicate on a split cell would then re-run the repair and the
    split. A filter on generated columns stays above the ``Generate``, so the line is
    split once however many predicates follow (measured: 2-3x less CPU for Q1 on raw
    lines). Only worth it where filters follow: the generated row costs a copy."""
    return F.inline(F.array(F.struct(*cols)))


def crash_cells(df: DataFrame, value_col: str = "value", key_col: str | None = None,
                n_fields: int = L.CRASH_FIELDS,
                drop: Sequence[int] = L.CRASH_DROP_ORDINALS) -> DataFrame:
    """C1 -> C4 -> C5 -> C6 -> C7 (+ C8): ``row_key``, ``is_malformed``, ``cells``.

    ``cells`` holds the kept cells with empties filled; a line whose repaired form
    has the wrong cell count keeps its row with every cell set to the sentinel.
    The split runs once per line in its own projection, so the per-cell
    expressions below read a column instead of re-splitting the line. For tables that
    are filtered next, see ``crash_table``.
    """
    keyed = with_row_key(df, key_col)
    arr = L.split_fields(L.repair_delimiters(value_col, n_fields - 1))
    staged = keyed.select("row_key", arr.alias("_cells"))
    malformed = F.size("_cells") != F.lit(n_fields)
    cells = [F.when(malformed, F.lit(L.FILL_VALUE)).otherwise(L.fill_empty(c))
             for c in L.project_ordinals("_cells", n_fields, drop)]
    return staged.select("row_key", malformed.alias("is_malformed"), F.array(*cells).alias("cells"))


# Names given to the 26 kept cells of the crash layout, in cell order.
CRASH_COLUMNS = (
    "crash_date", "crash_time", "borough", "zip_code", "latitude", "longitude",
    "on_street", "cross_street", "off_street",
    "ped_injured", "ped_killed", "cyc_injured", "cyc_killed", "mot_injured", "mot_killed",
    "factor_1", "factor_2", "factor_3", "factor_4", "factor_5", "collision_id",
    "vehicle_1", "vehicle_2", "vehicle_3", "vehicle_4", "vehicle_5",
)


def crash_table(df: DataFrame, value_col: str = "value", key_col: str | None = None) -> DataFrame:
    """Cleaned crash lines as a named, all-string table: ``row_id`` plus the 26 kept
    cells (``-1`` for empty or quarantined). This is what the cleaned CSV reads back
    as, and the input of ``plans.analyses.prepare_facts``; map-only.

    Only (key, split array) goes through ``computed_once``: filters on the named cells stay
    above it and read the array, and cells nobody asks for are pruned."""
    keyed = with_row_key(df, key_col)
    arr = L.split_fields(L.repair_delimiters(value_col, L.CRASH_FIELDS - 1))
    split = keyed.select(computed_once(F.col("row_key").alias("row_id"), arr.alias("_cells")))
    malformed = F.size("_cells") != F.lit(L.CRASH_FIELDS)
    cells = L.project_ordinals("_cells", L.CRASH_FIELDS, L.CRASH_DROP_ORDINALS)
    return split.select("row_id", *[F.when(malformed, F.lit(L.FILL_VALUE)).otherwise(L.fill_empty(c)).alias(name)
                                    for name, c in zip(CRASH_COLUMNS, cells)])


def clean_crash_lines(df: DataFrame, value_col: str = "value", key_col: str | None = None,
                      n_fields: int = L.CRASH_FIELDS,
                      drop: Sequence[int] = L.CRASH_DROP_ORDINALS,
                      keep_flag: bool = False) -> DataFrame:
    """C13 = C1 -> C4 -> C5 -> C6 -> C7 -> C8 -> C9, map-only.

    Output ``value`` is ``key,<kept cells>`` (27 cells for the crash layout); with
    ``keep_flag`` the ``row_key`` and ``is_malformed`` columns are kept as well.
    """
    cells = crash_cells(df, value_col, key_col, n_fields, drop)
    line = F.concat_ws(",", F.col("row_key").cast("string"), F.col("cells"))
    cols = [line.alias("value")]
    if keep_flag:
        cols = ["row_key", "is_malformed", *cols]
    return cells.select(*cols)


def distinct_lines(df: DataFrame, col: str = "value", sort: bool = True) -> DataFrame:
    """Equal lines collapse to one; optional byte-order sort (UTF-8 binary order)."""
    out = df.select(col).distinct()
    return out.orderBy(col) if sort else out


# The kept ordinals of the hourly pedestrian export.
CONTEXT_KEEP_ORDINALS = (0, 1, 2, 3, 4, 5, 6, 8, 9)


def clean_context_lines(df: DataFrame, value_col: str = "value",
                        keep: Sequence[int] = CONTEXT_KEEP_ORDINALS,
                        key_col: str | None = None, drop_rows: bool = False) -> DataFrame:
    """C11 (+ C12 when ``drop_rows``): keep ordinals 0-6, 8, 9 of each line.

    Cells are counted like Java's ``split(",")`` (trailing empty cells dropped). A
    line with too few cells yields a null ``value`` and ``is_short`` = true instead
    of failing the job.
    C12 (off by default): skip the header at key 0 containing ``location``, lines
    with an empty cell 5 and lines whose cell 2 is the number 0.
    """
    arr = L.split_fields_trimmed(value_col)
    needed = max(keep) + 1
    staged = df.select(*( [key_col] if key_col else []), F.col(value_col).alias("_raw"),
                       arr.alias("_cells"))
    short = F.size("_cells") < F.lit(needed)
    line = F.when(short, F.lit(None).cast("string")).otherwise(
        L.join_fields([F.try_element_at("_cells", F.lit(i + 1)) for i in keep]))
    out = staged
    if drop_rows:
        cell = lambda i: F.try_element_at("_cells", F.lit(i + 1))
        header = (F.col(key_col) == F.lit(0)) & F.col("_raw").contains("location") if key_col \
            else F.lit(False)
        empty5 = F.coalesce(cell(5) == F.lit(""), F.lit(True))
        zero2 = F.coalesce(cell(2).try_cast("int") == F.lit(0), F.lit(False))
        out = out.filter(~header & ~empty5 & ~zero2)
    return out.select(*([key_col] if key_col else []), line.alias("value"), short.alias("is_short"))
