"""Windows over a long series, without one task that sees it all.

A series of numbered places is cut into slices by arithmetic. A row of the last ``k`` places of a slice is also given
to the slice behind it, so each slice knows the rows before its first one, and a window within the slice, of up to
``k`` rows back, gives what the window over the whole series would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

SLICE = 1024


class Sliced:
    """The rows of a series in slices, with the window to use and the step that drops the repeated rows again.

    ``place`` numbers the rows of a series without a gap, and no place is filled twice; several series are told apart
    by ``keys``.
    """

    def __init__(self, df: DataFrame, place: Column, k: int, keys: tuple[str, ...] = ()) -> None:
        self.columns = df.columns
        width = F.lit(max(SLICE, k))
        own = F.floor(place / width)
        again = F.pmod(place, width) >= width - k if k else F.lit(False)
        slices = F.when(again, F.array(own, own + 1)).otherwise(F.array(own))
        self.rows = df.withColumns({"_place": place, "_own": own}).withColumn("_slice", F.explode(slices))
        self.window: WindowSpec = Window.partitionBy(*keys, "_slice").orderBy("_place")

    def select(self, *columns: str | Column) -> DataFrame:
        """Columns that may use ``window``; each row of the series once."""
        kept = self.rows.select("_own", "_slice", *columns).where(F.col("_own") == F.col("_slice"))
        return kept.drop("_own", "_slice")
