"""Pivots whose columns are declared, or taken from the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.operators.selection import small

#: More columns than this are no table any more.
MAX_COLUMNS = 10_000


def pivot(cells: DataFrame, rows: str, column: str, value: Column, declared: Sequence | None = None,
          expected: Sequence = ()) -> DataFrame:
    """One row per ``rows`` value, one column per ``column`` value.

    ``declared`` lists the columns, which saves a pass for finding them; a
    value outside the list is an error, never a dropped cell. Without it the
    small ``cells`` table is computed first and the values that occur become
    columns, after those of ``expected``, which are there in any case. Rows whose
    ``column`` is null make no column.
    """
    cells = cells.where(F.col(column).isNotNull())
    if declared is None:
        cells, _ = small(cells)
        found = [r[0] for r in cells.select(column).distinct().limit(MAX_COLUMNS + 1).collect()]
        if len(found) > MAX_COLUMNS:
            raise ValueError(f"{column} has more than {MAX_COLUMNS} values")
        known = [*expected, *sorted(set(found) - set(expected))]
        return cells.groupBy(rows).pivot(column, known).agg(value) if known else cells.select(rows).distinct()
    known = list(declared)
    kind = cells.schema[column].dataType
    other = F.raise_error(F.concat(F.lit(f"{column} has a value that is not declared: "), F.col(column).cast("string")))
    checked = F.when(F.col(column).isin(known), F.col(column)).otherwise(other.cast(kind))
    return cells.withColumn(column, checked).groupBy(rows).pivot(column, known).agg(value)
