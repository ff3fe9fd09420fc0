"""Row selection that is not pushed down."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_if(rows: DataFrame, condition: Column, columns: list[str]) -> DataFrame:
    """``columns`` of the rows that meet a condition on computed columns.

    ``where`` would be pushed below the projection that computes them, which then runs
    twice, and in the filter once per use. A generator of one row or none stays above it.
    """
    row = F.struct(*(F.col(name) for name in columns))
    return rows.select(F.inline(F.when(condition, F.array(row))))
