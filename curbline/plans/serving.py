"""Saved dashboard and ad-hoc queries, each a small aggregation over a mart.

``mart`` is the hourly mart, ``kpi`` the hourly KPIs per borough, ``fact`` the
enriched or mart fact. A mean of hourly means is what the dashboards show;
where a query takes ``weighted`` it can give the mean per trip instead.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.functions.calendar import iso_day_of_week
from curbline.functions.numeric import exact_avg, exact_sum, round_to
from curbline.functions.trip import text_list
from curbline.operators.clean import month_fence
from curbline.operators.marts import borough_group
from curbline.operators.quality import one_day
from curbline.operators.ranking import (
    nearest_rank,
    scale_to_unit,
    share_of_total,
    top_k,
    trailing_mean,
)


def filtered(df: DataFrame, start: date | str | None = None, end: date | str | None = None,
             feeds: Sequence[str] | None = None, boroughs: Sequence[str] | None = None,
             feed_column: str = "cab_type", borough_column: str = "borough_group") -> DataFrame:
    """The dashboard filters: dates (both included), feeds, boroughs. None means all."""
    if start is not None:
        df = df.where(f"pickup_date >= date '{start}'")
    if end is not None:
        df = df.where(f"pickup_date <= date '{end}'")
    if feeds:
        df = df.where(F.col(feed_column).isin(*feeds))
    if boroughs:
        df = df.where(F.col(borough_column).isin(*boroughs))
    return df


def in_year(df: DataFrame, year: int) -> DataFrame:
    """One year as a date range, which partition pruning and scan statistics can use."""
    return filtered(df, f"{year}-01-01", f"{year}-12-31")


def with_borough_group(kpi: DataFrame, borough: str = "pickup_borough") -> DataFrame:
    return kpi.selectExpr("*", f"{borough_group(borough)} as borough_group")


def grouped(df: DataFrame, *keys: str, **measures: str) -> DataFrame:
    """Measures, given as SQL text by name, per key."""
    return df.groupBy(*keys).agg(*[F.expr(f"{sql} as {name}") for name, sql in measures.items()])


TRIPS = "sum(trip_count)"


def monthly_volume(mart: DataFrame) -> DataFrame:
    return grouped(mart, "year_month", trips=TRIPS)


def avg_fare_by_group(kpi: DataFrame, weighted: bool = False) -> DataFrame:
    mean = exact_avg("avg_fare")
    if weighted:
        mean = f"({exact_sum('(avg_fare * trip_count)')}) / sum(trip_count)"
    return grouped(with_borough_group(kpi), "borough_group", avg_fare=mean)


def total_trips(mart: DataFrame) -> DataFrame:
    return grouped(mart, trips=TRIPS)


def total_revenue(mart: DataFrame) -> DataFrame:
    return grouped(mart, revenue=exact_sum("total_revenue"))


def volume_heatmap(mart: DataFrame) -> DataFrame:
    """Trips per hour and day name, scaled over all cells."""
    return scale_to_unit(grouped(mart, "pickup_hour", "day_name", trips=TRIPS), "trips", "intensity")


def fare_heatmap(kpi: DataFrame) -> DataFrame:
    """Mean fare per hour and day of week."""
    dated = kpi.selectExpr("pickup_hour", f"{iso_day_of_week('pickup_date')} as day_of_week", "avg_fare")
    return grouped(dated, "pickup_hour", "day_of_week", avg_fare=exact_avg("avg_fare"))


def revenue_by_group(mart: DataFrame, kpi: DataFrame, k: int = 20) -> DataFrame:
    """Borough groups by revenue with four measures; mean fare comes from the KPIs."""
    measured = grouped(
        mart, "borough_group", trips=TRIPS, revenue=exact_sum("total_revenue"),
        avg_duration=exact_avg("avg_duration_minutes"),
    )
    # A handful of groups on either side.
    joined = measured.join(F.broadcast(avg_fare_by_group(kpi)), "borough_group", "left")
    return top_k(joined, "revenue", k, ["borough_group"])


def daily_duration(mart: DataFrame) -> DataFrame:
    return grouped(mart, "pickup_date", avg_duration=exact_avg("avg_duration_minutes"))


def daily_speed(mart: DataFrame) -> DataFrame:
    return grouped(mart, "pickup_date", avg_speed=exact_avg("avg_speed_mph"))


def payment_share(fact: DataFrame, payment: str = "payment_type") -> DataFrame:
    return share_of_total(grouped(fact, payment, trips="count(1)"), "trips", "share")


def airport_split(mart: DataFrame) -> DataFrame:
    return grouped(mart, "is_airport", trips=TRIPS)


def weekend_split(mart: DataFrame) -> DataFrame:
    return grouped(mart, "is_weekend", trips=TRIPS)


def revenue_per_mile_by_group(kpi: DataFrame) -> DataFrame:
    """Mean revenue per mile, largest first."""
    out = grouped(
        with_borough_group(kpi), "borough_group",
        revenue_per_mile=exact_avg("revenue_per_mile"),
    )
    return out.orderBy(F.desc("revenue_per_mile"), "borough_group")


def big_numbers(kpi: DataFrame) -> DataFrame:
    """Means of the hourly means: fare, distance, duration."""
    names = ("avg_fare", "avg_distance_mi", "avg_duration_min")
    return grouped(kpi, **{n: exact_avg(n) for n in names})


def trips_by_hour(mart: DataFrame) -> DataFrame:
    return grouped(mart, "pickup_hour", trips=TRIPS).orderBy("pickup_hour")


def daily_revenue_trend(mart: DataFrame, periods: int = 7) -> DataFrame:
    """Revenue per day and feed with its trailing mean; one row per feed and day."""
    daily = grouped(mart, "cab_type", "pickup_date", revenue=exact_sum("total_revenue"))
    return trailing_mean(daily, ["cab_type"], "pickup_date", "revenue", "rolling_revenue", periods)


def feed_share_by_borough(fact: DataFrame, borough: str = "pickup_borough",
                          feed: str = "vehicle_type") -> DataFrame:
    counted = grouped(fact, borough, feed, trips="count(1)")
    return share_of_total(counted, "trips", "share", [borough])


def top_zones(fact: DataFrame, zone: str, k: int = 15) -> DataFrame:
    return top_k(grouped(fact, zone, trips="count(1)"), "trips", k, [zone])


def avg_fare_of(fact: DataFrame, feed: str, year: int, month: int, feed_column: str = "vehicle_type",
                ) -> DataFrame:
    """Mean fare of one feed in one month."""
    picked = month_fence(fact.where(F.col(feed_column) == feed), year, month, "pickup_date")
    return grouped(picked, avg_fare=exact_avg("fare_amount"), trips="count(1)")


def busiest_zone(fact: DataFrame, year: int, quarter: int, zone: str = "pickup_zone") -> DataFrame:
    """The zone with the most trips in a quarter."""
    picked = in_year(fact, year).where(f"quarter(pickup_date) = {quarter}")
    return top_zones(picked, zone, 1)


def credit_cash_share(fact: DataFrame, year: int, feed: str, payment: str = "payment_type_name",
                      feed_column: str = "vehicle_type") -> DataFrame:
    """Percent of a feed's trips in a year paid by card and in cash."""
    counted = grouped(
        in_year(fact, year).where(F.col(feed_column) == feed),
        trips="count(1)",
        credit=f"count_if({payment} = 'Credit card')",
        cash=f"count_if({payment} = 'Cash')",
    )
    return counted.selectExpr(
        "trips", "try_divide(credit * 100D, trips) as credit_percent",
        "try_divide(cash * 100D, trips) as cash_percent",
    )


def hourly_pattern(fact: DataFrame, borough: str, year: int) -> DataFrame:
    """Mean trips per hour of day over the days of a year that have any in that hour."""
    picked = in_year(fact, year).where(F.col("pickup_borough") == borough)
    per_day = grouped(picked, "pickup_date", "pickup_hour", trips="count(1)")
    return grouped(per_day, "pickup_hour", avg_trips="avg(trips)")


def trips_on(fact: DataFrame, day: date | str) -> DataFrame:
    """Trips of one day; a day without any gives 0."""
    return grouped(one_day(fact, day), trips="count(1)")


def revenue_by_borough_hour(kpi: DataFrame) -> DataFrame:
    """Revenue per borough and hour of day."""
    return grouped(kpi, "pickup_borough", "pickup_hour", revenue=exact_sum("total_revenue"))


def airport_fares(fact: DataFrame) -> DataFrame:
    """Mean fare of airport and other trips; unknown zones stand apart."""
    return grouped(fact, "is_airport_trip", avg_fare=exact_avg("fare_amount"), trips="count(1)")


def weekly_trend(kpi: DataFrame) -> DataFrame:
    """The seven-day rolling mean per borough at the end of each day."""
    last = grouped(kpi, "pickup_borough", "pickup_date", latest="max_by(rolling_7d_trips, pickup_hour)")
    return last.selectExpr("pickup_borough", "pickup_date", f"{round_to('latest', 6)} as rolling_7d_trips")


# Answer cases with the words an answer must and must not hold.
ANSWER_CASES: tuple[tuple[str, tuple[str, ...], tuple[str, ...]], ...] = (
    ("avg_fare_jan2023", ("average", "fare", "january", "2023"), ()),
    ("top_pickup_zone", ("zone", "trips", "2023"), ("i don't know", "cannot determine")),
    ("payment_type_share", ("credit card", "cash", "percent"), ()),
    ("hourly_pattern", ("hour", "manhattan", "trips"), ()),
    ("empty_result_graceful", ("no", "zero", "0", "empty", "returned", "none"), ("error", "exception")),
)


def score_answers(answers: DataFrame, text: str,
                  cases: Sequence[tuple[str, Sequence[str], Sequence[str]]] = ANSWER_CASES,
                  valid: str | None = None, case: str | None = None) -> DataFrame:
    """Share of wanted words, forbidden hit and pass flag of each answer, one row per case.

    With ``case``, the column that names what an answer was asked, each answer is scored against that case only
    and stays one row. An answer to an unknown case keeps its row: case and precision are NULL, it does not pass.
    """
    def hits(words: Sequence[str]) -> str:
        return " + ".join(
            f"cast(contains(lower({text}), {text_list([w.lower()])}) as int)" for w in words
        ) or "0"

    def scored(name: str, wanted: Sequence[str], barred: Sequence[str]) -> str:
        share = f"coalesce(({hits(wanted)}) / {len(wanted)}D, 0D)" if wanted else "1D"
        return (f"named_struct('case_id', {text_list([name])}, 'precision', {share}, "
                f"'forbidden_hit', coalesce(({hits(barred)}) > 0, false))")

    if case is None:
        out = answers.selectExpr("*", f"inline(array({', '.join(scored(*c) for c in cases)}))")
    else:
        own = " ".join(f"when {text_list([c[0]])} then {scored(*c)}" for c in cases)
        out = answers.withColumnRenamed(case, "_asked").selectExpr("*", f"case _asked {own} end as _own").selectExpr(
            *[f"`{c}`" for c in answers.columns if c != case],
            "_own.case_id", "_own.precision", "coalesce(_own.forbidden_hit, false) as forbidden_hit")
    return out.selectExpr(
        "*", f"coalesce(precision = 1 and {valid or 'true'} and not forbidden_hit, false) as passed")


def score_summary(scored: DataFrame, latency: str, by: Sequence[str] = ("case_id",)) -> DataFrame:
    """Pass rate, mean precision and nearest-rank latencies per run."""
    rates = grouped(
        scored, *by, pass_rate="sum(cast(passed as bigint)) / count(1)",
        precision_mean=exact_avg("precision"),
    )
    ranks: Mapping[str, float] = {"latency_p50": 0.5, "latency_p95": 0.95}
    return rates.join(nearest_rank(scored, by, latency, ranks), list(by), "left")
