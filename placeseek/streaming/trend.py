"""Change of activity per key, on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame

from placeseek.operators.rerank import activity_change


def activity_change_stream(
    events: DataFrame, time: str, key: str, window: str, late: str = "2 days"
) -> DataFrame:
    """:func:`activity_change` with bounded state: one counter pair per key and open window.

    A window is emitted once the newest event is ``late`` past its end; events later than that
    are dropped.
    """
    return activity_change(events, time, key, window, late)
