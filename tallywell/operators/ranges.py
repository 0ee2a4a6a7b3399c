"""A column joined to a table of ranges, such as a band table, of any length.

No range is collected and no pair of rows is listed. The starts of the ranges and the values are put into one order;
a value's only candidate is the last range that starts at or below it. The order is cut into slices by Spark's range
partitioning, so a slice is sorted in one task, and what a slice hands to the next is one range: the last that
started before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywell.sources.scratch import scratch_path


def check_bands(bands: DataFrame) -> DataFrame:
    """(code, low, high, next_code, next_low) of ranges that overlap the one that starts after them, or that are empty.

    Bands are first cut into slices of the order of ``low``, so no task sees them all.
    """
    marked = _in_slices(bands.select("low", "high", "code"), ["low", "high", "code"])
    inside = Window.partitionBy("_slice").orderBy("low", "high", "code")
    firsts = marked.groupBy("_slice").agg(F.min(F.struct("low", "code")).alias("_first"))
    # One row per slice.
    following = firsts.select("_slice", F.lead("_first").over(Window.partitionBy(F.lit(0)).orderBy("_slice")).alias("_next"))
    joined = marked.withColumn("_lead", F.lead(F.struct("low", "code")).over(inside)).join(following, "_slice")
    after = F.coalesce("_lead", "_next")
    return joined.select("code", "low", "high", after["code"].alias("next_code"), after["low"].alias("next_low")).where(
        (F.col("next_low") < F.col("high")) | (F.col("low") >= F.col("high")))


def band_join(df: DataFrame, value: Column, bands: DataFrame, out: str, refuse_overlaps: bool = True) -> DataFrame:
    """``df`` with the code of the range with low <= value < high in ``out``; NULL in a gap, and without a value.

    ``bands`` is a (low, high, code) table; one with a missing bound holds nothing. Distinct values are ranked, not
    rows, so a value that fills a third of the table is one row in the sort; the codes found are then joined back.
    """
    if refuse_overlaps and not check_bands(bands).isEmpty():
        raise ValueError("bands overlap or are empty: check_bands lists them")
    number = value.cast("double")
    rows = df.withColumn("_value", F.when(~F.isnan(number), number))
    asked = rows.where(F.col("_value").isNotNull()).select("_value").distinct()
    held = bands.where("low IS NOT NULL AND high IS NOT NULL").select(
        F.col("low").cast("double").alias("low"), F.col("high").cast("double").alias("high"), "code")
    # A start comes before an equal value.
    events = held.select(F.col("low").alias("_at"), F.lit(0).alias("_kind"), F.struct("low", "high", "code").alias("_band")).unionByName(
        asked.select(F.col("_value").alias("_at"), F.lit(1).alias("_kind")), allowMissingColumns=True)
    sliced = _in_slices(events, ["_at", "_kind"])
    so_far = Window.partitionBy("_slice").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lasts = sliced.groupBy("_slice").agg(F.max("_band").alias("_last"))
    # One row per slice.
    before = lasts.select("_slice", F.last("_last", ignorenulls=True).over(
        Window.partitionBy(F.lit(0)).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    placed = sliced.withColumn("_own", F.last("_band", ignorenulls=True).over(so_far)).where("_kind = 1")
    placed = placed.join(before, "_slice").select("_at", F.coalesce("_own", "_before").alias("_band"))
    codes = placed.where(F.col("_at") < F.col("_band.high")).select(F.col("_at").alias("_value"), F.col("_band.code").alias(out))
    return rows.join(codes, "_value", "left").select(*[F.col(c) for c in df.columns], out)


def _in_slices(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` with the number of its slice in ``_slice``; slices follow each other in the order.

    Written out, because sampled bounds may differ when a stage is worked out anew.
    """
    path = scratch_path(df.sparkSession, "slices")
    df.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()).write.parquet(path)
    return df.sparkSession.read.parquet(path)
