"""Top-k, shares, scaling, nearest-rank values, sampling, row search."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.functions.numeric import exact_avg

# Fixed value: most rows taken for a spot check.
SAMPLE_ROWS = 500_000


def top_k(df: DataFrame, measure: str, k: int, ties: Sequence[str]) -> DataFrame:
    """The k largest rows by a measure; ties go by the given columns.

    Spark keeps k rows per task and merges those.
    """
    return df.orderBy(F.desc(measure), *[F.asc(t) for t in ties]).limit(k)


def share_of_total(df: DataFrame, measure: str, name: str, within: Sequence[str] = ()) -> DataFrame:
    """Each row's part of the total, or of its group's total.

    Meant for aggregated rows: without ``within`` they all meet in one task.
    """
    total = F.sum(measure).over(Window.partitionBy(*within))
    return df.withColumn(name, F.try_divide(F.col(measure).cast("double"), total.cast("double")))


def scale_to_unit(df: DataFrame, measure: str, name: str) -> DataFrame:
    """(x - min) / (max - min) over all rows; 0 where they are all equal. Aggregated rows only."""
    every = Window.partitionBy()
    low, high = F.min(measure).over(every), F.max(measure).over(every)
    spread = (high - low).cast("double")
    return df.withColumn(
        name, F.when(spread > 0, (F.col(measure) - low).cast("double") / spread).otherwise(0.0)
    )


def trailing_mean(df: DataFrame, by: Sequence[str], order: str, measure: str, name: str,
                  periods: int = 7) -> DataFrame:
    """Mean over the last ``periods`` rows, fewer at the start."""
    window = (f"partition by {', '.join(by)} order by {order} "
              f"rows between {periods - 1} preceding and current row")
    return df.selectExpr("*", f"{exact_avg(measure, over=window)} as {name}")


def nearest_rank(df: DataFrame, by: Sequence[str], value: str, quantiles: Mapping[str, float]) -> DataFrame:
    """Per group, the sorted value at index floor(n * q), the last one at most.

    Rows are first counted per distinct value, so the window sees one row per
    value and not one per input row. Use it on whole-number values (such as
    milliseconds or lengths), whose range bounds that count.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(*by).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumns({
        "_last": F.sum("_n").over(upto), "_all": F.sum("_n").over(Window.partitionBy(*by)),
    })

    def at(q: float) -> Column:
        index = F.least(F.floor(F.col("_all") * F.lit(q)), F.col("_all") - 1)
        return F.min(F.when(F.col("_last") > index, F.col(value)))

    return ranked.groupBy(*by).agg(*[at(q).alias(name) for name, q in quantiles.items()])


def sample_capped(df: DataFrame, cap: int = SAMPLE_ROWS, seed: int = 11) -> DataFrame:
    """min(cap, rows) rows at random. Runs one count.

    Every task thins its rows to a little over the share needed; only those are
    sorted. The margin is ten standard deviations; should the thinned set still
    be short, it is drawn again twice as large.
    """
    rows = df.count()
    if rows <= cap:
        return df
    fraction = min(1.0, (cap + 10 * math.sqrt(cap) + 10) / rows)
    drawn = df.withColumn("_u", F.rand(seed))
    thinned = drawn.where(F.col("_u") < fraction)
    while fraction < 1.0 and thinned.limit(cap).count() < cap:
        fraction = min(1.0, fraction * 2)
        thinned = drawn.where(F.col("_u") < fraction)
    return thinned.orderBy("_u").limit(cap).drop("_u")


def capped(df: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` rows of an ad-hoc answer."""
    return df.limit(rows)


def search_rows(df: DataFrame, text: str, columns: Sequence[str] | None = None,
                regex: bool = True) -> DataFrame:
    """Rows where any column's text matches the pattern, ignoring case; without ``regex``, contains the words."""
    hit = F.lit(False)
    for c in columns or df.columns:
        shown = F.col(f"`{c}`").cast("string")
        found = shown.rlike(f"(?i){text}") if regex else F.contains(F.lower(shown), F.lit(text.lower()))
        hit = hit | F.coalesce(found, F.lit(False))
    return df.where(hit)
