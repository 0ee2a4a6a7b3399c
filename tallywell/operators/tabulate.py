"""Tabulations of coded answers.

All of them group first, so that what is shuffled, joined or expanded afterwards is the table of
cells and not the responses. Totals and margins are read from those cells and reuse their exchange.
A margin is joined and not windowed: a segment with very many options would fill one window task,
while a join to one row per segment is broadcast or split by its measured size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell.operators.ranked import top_per_group
from tallywell.operators.series import Sliced
from tallywell.schema import NO_ANSWER, PRICE_BANDS


def share(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def with_base(df: DataFrame, columns: Sequence[str], base: str = "all") -> DataFrame:
    """``all`` keeps every row; ``valid`` leaves out NULL and ``no_answer`` in these columns."""
    if base == "all":
        return df
    if base != "valid":
        raise ValueError(f"base is 'all' or 'valid', not {base!r}")
    for c in columns:
        df = df.filter(F.col(c).isNotNull() & (F.col(c) != NO_ANSWER))
    return df


def _cells(df: DataFrame, *columns: Column | str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def freq_single(df: DataFrame, column: str, base: str = "all") -> DataFrame:
    """(code, n, share) of a single-answer question."""
    cells = _cells(with_base(df, [column], base), F.col(column).alias("code"))
    total = cells.agg(F.sum("n")).scalar()
    return cells.select("code", "n", share(F.col("n"), total).alias("share"))


def freq_multi(df: DataFrame, column: str, base: str = "all") -> DataFrame:
    """(option, n, share) of a multi-answer question; the base is the respondents who were asked.

    With the base ``valid``, only those who named an option other than ``no_answer`` count.

    The base is counted in the same pass, by a row without an option. Both readers of the cells use
    both counts, so that they share one exchange.
    """
    if base == "valid":
        df = df.withColumn(column, F.filter(column, lambda x: x != NO_ANSWER)).filter(F.size(column) > 0)
    elif base != "all":
        raise ValueError(f"base is 'all' or 'valid', not {base!r}")
    cells = _option_rows(df, column).groupBy("option").agg(
        F.count("option").alias("n"), F.count_if(F.col("option").isNull()).alias("_asked"))
    asked = cells.filter(F.col("n") == 0).agg(F.sum("_asked")).scalar()
    return cells.filter(F.col("_asked") == 0).select("option", "n", share(F.col("n"), asked).alias("share"))


def _option_rows(df: DataFrame, column: str, *keep: str) -> DataFrame:
    """One row per option of a respondent, and one with NULL for each respondent who was asked."""
    options = F.concat(F.array(F.lit(None).cast("string")), F.array_compact(F.array_distinct(column)))
    return df.filter(F.col(column).isNotNull()).select(*keep, F.explode(options).alias("option"))


def _with_margins(cells: DataFrame, a: str, b: str) -> DataFrame:
    """Add ``_row`` and ``_column``, the sums of ``n`` over the cells with the same a and the same b.

    A missing code is a code of its own.
    """
    rows = cells.groupBy(F.col(a).alias("_a")).agg(F.sum("n").alias("_row"))
    columns = cells.groupBy(F.col(b).alias("_b")).agg(F.sum("n").alias("_column"))
    return (
        cells.join(rows, F.col(a).eqNullSafe(F.col("_a")))
        .join(columns, F.col(b).eqNullSafe(F.col("_b"))).drop("_a", "_b")
    )


def crosstab(df: DataFrame, a: str, b: str, base: str = "all") -> DataFrame:
    """(a, b, n, row_share, col_share, total_share)."""
    cells = _cells(with_base(df, [a, b], base), a, b)
    total = cells.agg(F.sum("n")).scalar()
    n = F.col("n")
    return _with_margins(cells, a, b).select(
        a, b, "n", share(n, F.col("_row")).alias("row_share"),
        share(n, F.col("_column")).alias("col_share"), share(n, total).alias("total_share"))


def crosstab_multi(df: DataFrame, column: str, segment: str, base: str = "all") -> DataFrame:
    """(segment, option, n, share) with the respondents of the segment as base."""
    cells = _option_rows(with_base(df, [segment], base), column, segment).groupBy(segment, "option").agg(
        F.count("option").alias("n"), F.count_if(F.col("option").isNull()).alias("_asked"))
    asked = cells.filter(F.col("n") == 0).select(F.col(segment).alias("_key"), F.col("_asked").alias("_base"))
    return (
        cells.filter(F.col("_asked") == 0).join(asked, F.col(segment).eqNullSafe(F.col("_key")))
        .select(segment, "option", "n", share(F.col("n"), F.col("_base")).alias("share"))
    )


def csat(df: DataFrame, segment: str, score: str = "satisfaction_int", base: str = "all") -> DataFrame:
    """(segment, n, mean, sd, top2, bottom2) over the responses that gave a score from 1 to 5."""
    s = F.col(score)
    return with_base(df, [segment], base).filter(s.isNotNull()).groupBy(segment).agg(
        F.count(s).alias("n"),
        F.avg(s).alias("mean"),
        F.stddev_samp(s).alias("sd"),
        F.avg(F.when(s >= 4, 1.0).otherwise(0.0).cast("double")).alias("top2"),
        F.avg(F.when(s <= 2, 1.0).otherwise(0.0).cast("double")).alias("bottom2"),
    )


def subtotals(
    df: DataFrame, dims: Sequence[str], mode: str = "rollup",
    sets: Sequence[Sequence[str]] | None = None,
) -> DataFrame:
    """(dims, {dim}_total flags, n) for a rollup, a cube or chosen grouping sets.

    Counting the finest cells first means that the copies a cube makes are copies of cells.
    """
    cells = _cells(df, *dims)
    if mode == "rollup":
        grouped = cells.rollup(*dims)
    elif mode == "cube":
        grouped = cells.cube(*dims)
    elif mode == "sets" and sets is not None:
        grouped = cells.groupingSets([[F.col(c) for c in s] for s in sets], *dims)
    else:
        raise ValueError("mode is 'rollup', 'cube' or 'sets' (with sets)")
    flags = [F.grouping(d).cast("int").alias(f"{d}_total") for d in dims]
    return grouped.agg(*flags, F.sum("n").alias("n"))


def purchase_rate(
    df: DataFrame, segment: str, intent: str = "purchase_intent", base: str = "all"
) -> DataFrame:
    """(segment, n, def_rate, soft_rate): def_buy alone, and def_buy with maybe."""
    i = F.col(intent)
    rate = lambda hit: F.avg(F.when(hit, 1.0).otherwise(0.0).cast("double"))
    return with_base(df, [segment], base).filter(i.isNotNull()).groupBy(segment).agg(
        F.count(i).alias("n"),
        rate(i == "def_buy").alias("def_rate"),
        rate(i.isin("def_buy", "maybe")).alias("soft_rate"),
    )


def price_acceptance(
    df: DataFrame, order: Sequence[str] = tuple(PRICE_BANDS), intent: str = "purchase_intent",
    band: str = "price_band",
) -> DataFrame:
    """(intent, band, n, cum_share, unlisted_share): share of the intent that accepts this band or a dearer one.

    Each intent has a row for every listed band, also one that nobody chose. The base are all responses that
    name a band, so bands outside ``order`` show as ``unlisted_share``.
    """
    b = F.col(band)
    counted = df.groupBy(F.col(intent).alias("intent")).agg(
        F.array(*[F.count_if(b == code) for code in order]).alias("_n"), F.count(b).alias("_base"))
    total = lambda counts: F.aggregate(counts, F.lit(0).cast("bigint"), lambda x, y: x + y)
    rows = F.array(*[
        F.struct(F.lit(code).alias("band"), F.col("_n")[i].alias("n"),
                 share(total(F.slice("_n", i + 1, len(order))), F.col("_base")).alias("cum_share"))
        for i, code in enumerate(order)])
    unlisted = share(F.col("_base") - total(F.col("_n")), F.col("_base")).alias("unlisted_share")
    return counted.select("intent", unlisted, F.inline(rows)).select("intent", "band", "n", "cum_share", "unlisted_share")


def association(df: DataFrame, a: str, b: str, base: str = "all") -> DataFrame:
    """(n, chi2, dof, v): chi-square and Cramér's V of two code columns, NULL pairs left out.

    Only observed cells are visited. The expected counts of all cells add up to n, so the cells
    nobody chose contribute n minus the expected counts of the observed ones.
    """
    df = with_base(df, [a, b], base)
    cells = _cells(df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()), a, b)
    total = cells.agg(F.sum("n")).scalar().cast("double")
    n = F.col("n").cast("double")
    expected = F.col("_row").cast("double") * F.col("_column").cast("double") / total
    sums = (
        _with_margins(cells, a, b).select(a, b, n.alias("n"), expected.alias("e"))
        .agg(
            F.sum("n").alias("n"), F.sum("e").alias("e"), F.count(F.lit(1)).alias("cells"),
            F.sum((F.col("n") - F.col("e")) * (F.col("n") - F.col("e")) / F.col("e")).alias("seen"),
            F.countDistinct(a).alias("r"), F.countDistinct(b).alias("c"),
        )
    )
    unseen = F.when(F.col("cells") == F.col("r") * F.col("c"), 0.0).otherwise(F.col("n") - F.col("e"))
    narrow = F.least(F.col("r"), F.col("c")) - 1
    return (
        sums.withColumn("chi2", F.col("seen") + unseen)
        .select(
            F.col("n").cast("bigint").alias("n"), "chi2",
            ((F.col("r") - 1) * (F.col("c") - 1)).cast("bigint").alias("dof"),
            F.sqrt(F.try_divide(F.col("chi2"), F.col("n") * narrow)).alias("v"),
        )
    )


def pivot_table(
    df: DataFrame, row: str, column: str, codes: Sequence[str], other: str = "(other)", missing: str = "(missing)"
) -> DataFrame:
    """Wide counts, one column per code, and one each for other codes and for none; they add up to the rows.

    The codes are given, so no extra job looks for them.
    """
    value = F.col(column)
    return df.groupBy(row).agg(
        *[F.count_if(value == code).alias(code) for code in codes],
        F.count_if(~value.isin(*codes)).alias(other), F.count_if(value.isNull()).alias(missing))


def segment_index(
    df: DataFrame, segment: str, label: str, k: int, base: str = "all"
) -> DataFrame:
    """(segment, label, n, idx, rank): share in the segment over the overall share, times 100;
    the k labels that stand out most in each segment."""
    df = with_base(df, [segment, label], base)
    cells = _cells(df.filter(F.col(segment).isNotNull() & F.col(label).isNotNull()),
                   F.col(segment).alias("segment"), F.col(label).alias("label"))
    total = cells.agg(F.sum("n")).scalar()
    in_segment, overall = share(F.col("n"), F.col("_row")), share(F.col("_column"), total)
    indexed = _with_margins(cells, "segment", "label").withColumn("idx", F.round(in_segment / overall * 100, 6))
    return top_per_group(indexed, ["segment"], [F.desc("idx"), F.asc("label")], k).select("segment", "label", "n", "idx", "rank")


UNITS = {"day": "INTERVAL 1 DAY", "week": "INTERVAL 7 DAY", "month": "INTERVAL 1 MONTH"}


def bucket_no(unit: str, bucket: Column) -> Column:
    """The number of a day, week or month; neighbours differ by one."""
    if unit == "month":
        return (F.year(bucket) * 12 + F.month(bucket)).cast("bigint")
    days = F.unix_date(F.to_date(bucket)).cast("bigint")
    # Fixed value: day 4 is the first Monday.
    return F.floor((days - 4) / 7) if unit == "week" else days


def outside(df: DataFrame, first: str, last: str, unit: str = "day", time: str = "submitted_at") -> DataFrame:
    """(bucket, n) of the rows that ``trend`` leaves out between these dates, such as a clock that was never set."""
    day = F.to_date(time)
    stray = df.filter((day < F.lit(first).cast("date")) | (day > F.lit(last).cast("date")))
    return stray.groupBy(F.date_trunc(unit, F.col(time)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def trend(
    df: DataFrame, unit: str = "week", k: int = 3, by: str | None = None,
    time: str = "submitted_at", score: str = "satisfaction_int", between: tuple[str, str] | None = None,
) -> DataFrame:
    """(by, bucket, n, mean_score, delta, ma) per day, week or month.

    A series has a bucket for every unit from its first to its last, with n = 0 where nobody answered. ``delta`` is
    the change of n against the bucket before and ``ma`` the mean n of this bucket and the k before it. A long series
    is cut into slices, so no task sees all its buckets. ``between`` two dates keeps one wrong date from
    stretching the series; ``outside`` lists what it leaves out.
    """
    if unit not in UNITS:
        raise ValueError(f"unit is one of {', '.join(UNITS)}, not {unit!r}")
    keys = [by] if by else []
    if between:
        df = df.filter(F.to_date(time).between(*[F.lit(d).cast("date") for d in between]))
    found = (
        df.filter(F.col(time).isNotNull()).groupBy(*keys, F.date_trunc(unit, F.col(time)).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_score"))
    )
    spans = found.groupBy(*keys).agg(F.min("bucket").alias("_a"), F.max("bucket").alias("_b")).filter(F.col("_a").isNotNull())
    every = spans.select(*[F.col(c).alias("_by") for c in keys],
                         F.explode(F.sequence("_a", "_b", F.expr(UNITS[unit]))).alias("_bucket"))
    same = F.col("_bucket") == F.col("bucket")
    if by:
        same = same & F.col("_by").eqNullSafe(F.col(by))
    buckets = every.join(found, same, "left").select(
        *[F.col("_by").alias(c) for c in keys], F.col("_bucket").alias("bucket"),
        F.coalesce("n", F.lit(0)).alias("n"), "mean_score")
    series = Sliced(buckets, bucket_no(unit, F.col("bucket")), max(k, 1), tuple(keys))
    return series.select(
        *keys, "bucket", "n", "mean_score",
        (F.col("n") - F.lag("n").over(series.window)).alias("delta"),
        F.avg("n").over(series.window.rowsBetween(-k, 0)).alias("ma"),
    )
