"""Writers for analysis results."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame


def save_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One analysis result as CSV with a header row (a folder of part files)."""
    df.write.mode(mode).option("header", True).csv(path)


def save_results(t, analyses: dict[str, Callable], folder: str, keys: Iterable[str] | None = None,
                 fmt: str = "csv") -> None:
    """Run each named analysis on ``t`` and write its result under ``folder/<key>``."""
    for key in keys or analyses:
        df = analyses[key](t)
        target = os.path.join(folder, key)
        if fmt == "csv":
            save_csv(df, target)
        else:
            df.write.mode("overwrite").parquet(target)
