"""Row-ordered work per key that stays balanced whatever the size of a key.

A running sum, a "next row" or a row number needs the rows of a key in order.
A plain window puts each key into one task, which fails once a single key holds
a large part of the data.  The functions here divide such keys, work inside the parts in parallel,
and hand each part the summary of the parts before it (or after it, for backward work).

Cells adapt to the rows. A key of at most ``CELL_ROWS`` rows, or a small share of all, is one cell. A larger key is
cut into cells of fixed width of its first order column (an hour, or ``CELL_NUMBERS`` of a whole number); a cell
that still holds too many rows is cut at places of the whole order, rows of its own that a hash chooses, so equal times are
divided too. What is divided is known from counts per key and per cell, made by plain groupings: a key or cell
is divided only if it holds more than one in ``CELLS`` of all rows, so the tables of what is divided have fewer
than ``CELLS`` rows, and about as many cuts in all, whatever the data, and are broadcast. Nothing is collected and no job runs before the action.

Parts only divide the work: results are the same however it is divided. The carries are made of divided keys alone, so
data without large keys costs one count per key beside the plain window.

``order`` must be a total order inside a key, so its last column is a row id.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from rillwork.functions.scalar import epoch_micros, floor_div

SEGMENT = "__segment"
_KEY, _LARGE, _CUTS = "__key", "__large", "__cuts"

CELL_SECONDS = 3600
CELL_NUMBERS = 1 << 20
CELL_ROWS = 200_000  # rows that a task may well put in order
CELLS = 4096  # and what holds less than such a share of all rows is not divided
CUTS = 256  # parts of a cell with too many rows at most, as every row of it looks through them


# --- cells -----------------------------------------------------------------------------------

def with_cells(df: DataFrame, first: str, cell: float | None = None) -> DataFrame:
    """Add ``__segment``, the number of the cell of the first order column; null values are a cell of their own."""
    value = _number(df, first)
    if value is None:
        raise TypeError(f"rows cannot be put in order by {first}, a {df.schema[first].dataType.simpleString()}, first: times and whole numbers can")
    is_time = not isinstance(df.schema[first].dataType, T.IntegralType)
    width = int((cell or CELL_SECONDS) * 1_000_000) if is_time else int(cell or CELL_NUMBERS)
    # null times come first in ascending order, and so does their cell
    return df.withColumn(SEGMENT, F.coalesce(floor_div(value, max(width, 1)), F.lit(-(1 << 63))))


def _number(df: DataFrame, column: str) -> Column | None:
    """A time or whole number as a long; None for other types."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return epoch_micros(F.col(column))
    return F.col(column).cast("long") if isinstance(kind, T.IntegralType) else None


def in_parts(rows: DataFrame, part: Sequence[str], order: Sequence[str], cell: float | None = None, most: int = CELL_ROWS) -> DataFrame:
    """Add ``__segment``, the part of its key a row is in, comparable in the order, and ``__large``, whether its key is divided.

    With ``cell`` every key is cut into cells of that width.
    """
    counts = rows.groupBy(*part).agg(F.count(F.lit(1)).alias("__n"))
    total = (counts.agg(F.sum("__n")) if part else counts).scalar()
    limit = F.greatest(F.lit(most).cast("long"), F.coalesce((total / CELLS).cast("long"), F.lit(0)))
    cells = with_cells(rows, order[0], cell)
    if cell is not None:
        source, cells = cells, cells.withColumn(_LARGE, F.lit(True))
    elif part:
        large = F.broadcast(counts.filter(F.col("__n") > limit).select(*part, F.lit(True).alias(_LARGE)))
        source, cells = cells.join(large.drop(_LARGE), list(part)), cells.join(large, list(part), "left")
    else:
        source, cells = cells.filter(total > limit), cells.withColumn(_LARGE, F.when(total > limit, True))
    # of a cell with too many rows, a share of rows chosen by hash are the places where it is cut
    inside, place = [*part, SEGMENT], F.struct(*order)
    source = source.select(*inside, *[c for c in order if c not in part])
    full = source.groupBy(*inside).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > limit)
    share = F.least(F.lit(float(CUTS)), F.col("__n") / max(most, 1)) / F.col("__n")
    chosen = F.pmod(F.xxhash64(*order), F.lit(1 << 52)) < share * float(1 << 52)
    cuts = source.join(F.broadcast(full), inside).filter(chosen).groupBy(*inside).agg(F.sort_array(F.collect_set(place)).alias(_CUTS))
    rows = cells.join(F.broadcast(cuts), inside, "left")
    behind = F.coalesce(F.size(F.filter(_CUTS, lambda c: c < place)), F.lit(0))
    return rows.withColumn(SEGMENT, F.when(F.col(_LARGE), F.struct(F.col(SEGMENT).alias("cell"), F.when(F.col(_CUTS).isNull(), 0).otherwise(behind).alias("cut")))
                           .otherwise(F.struct(F.lit(0).cast("long").alias("cell"), F.lit(0).alias("cut")))).drop(_CUTS)


def same_keys(keys: Sequence[str], prefix: str) -> Column:
    """Key equality in which null equals null, as it does in a group."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(prefix + k))
    return cond


def _direction(order: Sequence[str], backward: bool) -> list[Column]:
    return [F.col(o).desc() if backward else F.col(o).asc() for o in order]


# --- values along the order -------------------------------------------------------------------

@dataclass(frozen=True)
class Running:
    """A value folded over the rows of a key from its start (its end if ``backward``) to the row.

    ``fold`` is sum, count, min, max, first or last; nulls are skipped.
    ``exclusive`` leaves the row itself out, so ``last`` then means the nearest earlier value.
    """

    fold: str
    value: Column
    backward: bool = False
    exclusive: bool = False


def _fold(fold: str, c: Column) -> Column:
    if fold in ("first", "last"):
        return getattr(F, fold)(c, ignorenulls=True)
    return getattr(F, fold)(c)


def _segment_total(spec: Running, order: Sequence[str]) -> Column:
    if spec.fold in ("first", "last"):
        known_at = F.when(spec.value.isNotNull(), F.struct(*order))
        pick = F.min_by if (spec.fold == "first") != spec.backward else F.max_by
        return pick(spec.value, known_at)
    return _fold(spec.fold, spec.value)


def _combine(fold: str, carry: Column, here: Column) -> Column:
    if fold in ("sum", "count"):
        return F.coalesce(carry + here, here, carry)
    if fold == "min":
        return F.least(carry, here)
    if fold == "max":
        return F.greatest(carry, here)
    return F.coalesce(carry, here) if fold == "first" else F.coalesce(here, carry)


@dataclass(frozen=True)
class Near:
    """``value`` of the next ``n`` rows (of the previous ones, nearest first, if ``backward``) as an array.

    ``value`` must not be null (wrap it in a struct if it may be); the array is shorter near the end of a key.
    """

    value: Column
    n: int
    backward: bool = False


def scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: dict[str, Running | Near],
         cell: float | None = None, most: int = CELL_ROWS) -> DataFrame:
    """Add running values and neighbours to every row, all in one pass over the ordered keys; ``most`` rows stay in one part in any case."""
    rows, part = df, []
    if keys:
        # Structs are equal when their nulls are, so join, window and exchange share one plain key.
        rows, part = rows.withColumn(_KEY, F.struct(*keys)), [_KEY]
    rows = in_parts(rows, part, order, cell, most)
    inside = [*part, SEGMENT]
    carries = {name: "__carry_" + name for name in columns}
    # what one row per cell can carry comes from one grouping
    single = {n: c for n, c in columns.items() if isinstance(c, Running) or c.n == 1}
    large = rows.filter(_LARGE)
    parts = [_cell_carry(large, part, order, single, carries)] if single else []
    parts += [_near_carry(large, part, order, spec, carries[name]) for name, spec in columns.items() if name not in single]
    source = rows
    for carry in parts:
        rows = rows.join(carry, inside, "left")
    rows = rows.select(*source.columns, *carries.values())
    for name, spec in columns.items():
        ordered = Window.partitionBy(*inside).orderBy(*_direction(order, spec.backward))
        if isinstance(spec, Running):
            frame = ordered.rowsBetween(Window.unboundedPreceding, -1 if spec.exclusive else 0)
            here = _fold(spec.fold, spec.value).over(frame)
        else:
            # Seen in the chosen direction, previous rows lie ahead too.
            here = F.collect_list(spec.value).over(ordered.rowsBetween(1, spec.n))
            if spec.backward:
                # The frame before the row needs no second sort; it comes farthest first.
                forward = Window.partitionBy(*inside).orderBy(*_direction(order, False))
                here = F.reverse(F.collect_list(spec.value).over(forward.rowsBetween(-spec.n, -1)))
        rows = rows.withColumn(name, here)
        kind = rows.schema[name].dataType
        carry = F.col(carries[name])
        if isinstance(spec, Running):
            whole = _combine(spec.fold, carry, F.col(name)).cast(kind)
        else:
            whole = F.slice(F.concat(name, F.coalesce(carry, F.array().cast(kind))), 1, spec.n)
        rows = rows.withColumn(name, whole)
    return rows.drop(SEGMENT, _LARGE, _KEY, *carries.values())


def _by_segment(part: Sequence[str], backward: bool):
    segment = F.col(SEGMENT)
    return Window.partitionBy(*part).orderBy(segment.desc() if backward else segment.asc())


def _cell_carry(source: DataFrame, part: Sequence[str], order: Sequence[str], specs: dict[str, Running | Near],
                names: dict[str, str]) -> DataFrame:
    """Per cell, the fold over all cells before it (after it, if backward), or the one row next to it."""
    totals, carry = [], []
    for n, spec in specs.items():
        cells = _by_segment(part, spec.backward)
        if isinstance(spec, Near):
            nearest = F.max_by if spec.backward else F.min_by
            totals.append(nearest(spec.value, F.struct(*order)).alias(names[n]))
            carry.append(F.collect_list(names[n]).over(cells.rowsBetween(1, 1)).alias(names[n]))
        else:
            totals.append(_segment_total(spec, order).alias(names[n]))
            fold = F.sum(names[n]) if spec.fold == "count" else _fold(spec.fold, F.col(names[n]))
            carry.append(fold.over(cells.rowsBetween(Window.unboundedPreceding, -1)).alias(names[n]))
    return source.groupBy(*part, SEGMENT).agg(*totals).select(*part, SEGMENT, *carry)


def _near_carry(source: DataFrame, part: Sequence[str], order: Sequence[str], spec: Near, name: str) -> DataFrame:
    """Per cell, the first rows of the cells after it (before it, if backward): n per cell are enough."""
    place = F.row_number().over(
        Window.partitionBy(*part, SEGMENT).orderBy(*_direction(order, spec.backward)))
    heads = (
        source.select(*part, SEGMENT, *[c for c in order if c not in part], spec.value.alias("__v"))
        .withColumn("__p", place).filter(F.col("__p") <= spec.n)
        .groupBy(*part, SEGMENT).agg(F.sort_array(F.collect_list(F.struct("__p", "__v"))).alias("__h")))
    later = F.flatten(F.collect_list("__h").over(_by_segment(part, spec.backward).rowsBetween(1, spec.n)))
    return heads.select(*part, SEGMENT, F.slice(later, 1, spec.n)["__v"].alias(name))


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: dict[str, Running],
            cell: float | None = None, most: int = CELL_ROWS) -> DataFrame:
    """Add running values, one per entry of ``columns``, to every row."""
    return scan(df, keys, order, columns, cell, most)


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rn",
                cell: float | None = None, most: int = CELL_ROWS) -> DataFrame:
    """Add the 1-based position of each row inside its key."""
    return scan(df, keys, order, {name: Running("count", F.lit(1))}, cell, most)


def neighbours(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, n: int, name: str,
               backward: bool = False, cell: float | None = None, most: int = CELL_ROWS) -> DataFrame:
    """Add an array of ``value`` of the next (previous) ``n`` rows; see ``Near``."""
    return scan(df, keys, order, {name: Near(value, n, backward)}, cell, most)
