"""The two result shapes of the dashboard, from the newest batch."""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame

from turnout.operators.newest import (
    bar_series,
    grid,
    newest_batch,
    top_groups,
    with_refresh_time,
    yes_no_counts,
)


class Dashboard(NamedTuple):
    """``rows`` for the table, ``bars`` for the chart, ``series`` the bars one by one."""

    rows: DataFrame
    bars: DataFrame
    series: DataFrame


def dashboard_of(newest: DataFrame, n: int = 10, time: Column | None = None) -> Dashboard:
    """Shapes of one batch that is already picked, refreshed now or at ``time``."""
    bars = yes_no_counts(newest, n)
    rows = with_refresh_time(grid(top_groups(newest, n)), time)
    return Dashboard(rows, bars, bar_series(bars))


def dashboard(table: DataFrame, n: int = 10, time: Column | None = None) -> Dashboard:
    """Shapes of the newest batch of the whole count table."""
    return dashboard_of(newest_batch(table), n, time)
