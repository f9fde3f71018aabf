"""Range windows over raw rows, one partition key spread over many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.functions.numeric import exact_avg_of_two


def sliced_rolling_mean(df: DataFrame, by: Sequence[str], ts: str, measure: str, name: str, seconds: int,
                        slice_seconds: int | None = None) -> DataFrame:
    """Mean of ``measure`` over the rows of the last ``seconds`` up to each row's time, both ends included.

    Time is cut into slices, and a window partition is a key and a slice, so that a key with many rows meets in no
    single task. A row is copied to the later slices that its time reaches into; these copies enter the
    means and are not returned. With slices as long as the window (the default) a row is sent twice; shorter slices
    copy more, longer ones would not copy less and are cut to the window. Rows without a time have no window and get NULL.

    A window is the rows of its own slice up to its end and the copies that have not left before it. Both are running
    totals, one in the order of time and one against it, so the work per row does not grow with the rows of a
    window, and nothing is subtracted.
    """
    window_us = seconds * 1_000_000
    slice_us = max(1, min(slice_seconds or seconds, seconds) * 1_000_000)
    clock = f"unix_micros(cast({ts} as timestamp))"
    number = "({0} - pmod({0}, {1}L)) div {1}L"
    own, last = number.format(f"({clock})", slice_us), number.format(f"({clock} + {window_us}L)", slice_us)
    # Only the slice crosses the shuffle with a row; what follows from it is worked out behind it.
    dealt = df.selectExpr("*", f"explode_outer(sequence({own}, {last})) as _slice").repartition(
        *(F.col(f"`{c}`") for c in by), "_slice")
    placed = dealt.selectExpr(
        "*", f"{clock} as _us", f"_slice <=> {own} as _mine",
        f"coalesce(_slice = {last} and _slice > {own}, false) as _leaves")
    timed = placed.selectExpr(
        "*", f"case when _leaves then _us + {window_us}L else greatest(_us, _slice * {slice_us}L) end as _at",
        f"case when not _leaves then {measure} end as _come", f"case when _leaves then {measure} end as _left")
    slices = f"partition by {', '.join([*by, '_slice'])} order by _at"
    so_far = "range between unbounded preceding and current row"
    parts, mean = exact_avg_of_two("_come", f"{slices} {so_far}", "_left", f"{slices} desc {so_far}")
    rolled = timed.selectExpr("*", *parts).where("_mine")
    return rolled.selectExpr(*(f"`{c}`" for c in df.columns), f"case when _us is not null then {mean} end as {name}")
