"""Alert cooldown: after an alert, repeats of the same monitor are held back."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .windows import on_event_time


def first_after_pause(times: np.ndarray, last: int | None, pause: int) -> list[int]:
    """Greedy choice from sorted times: each at least ``pause`` after the previous."""
    chosen: list[int] = []
    at = 0 if last is None else int(np.searchsorted(times, last + pause, side="left"))
    while at < len(times):
        chosen.append(int(times[at]))
        at = int(np.searchsorted(times, times[at] + pause, side="left"))
    return chosen


def with_cooldown(
    alerts: DataFrame, monitor: str = "monitor", ts: str = "ts", hours: float = 6.0,
    delay: str = "1 hour",
) -> DataFrame:
    """Alerts that pass a cooldown of ``hours`` per monitor.

    State is one timestamp per monitor.  Only the alert times of one monitor in
    one micro-batch are held at once, as 8-byte integers.
    """
    pause = int(hours * 3600 * 1_000_000)

    def step(
        key: tuple, frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        times = np.sort(np.concatenate([f["_us"].to_numpy(dtype="int64") for f in frames]))
        last = state.get[0] if state.exists else None
        chosen = first_after_pause(times, last, pause)
        if chosen:
            state.update((chosen[-1],))
            yield pd.DataFrame({monitor: [str(key[0])] * len(chosen), "_us": chosen})

    timed = on_event_time(alerts, ts, delay).select(
        F.col(monitor).cast("string").alias(monitor), ts, F.unix_micros(ts).alias("_us")
    )
    passed = timed.groupBy(monitor).applyInPandasWithState(
        step, f"{monitor} string, _us bigint", "last bigint", "append",
        GroupStateTimeout.NoTimeout,
    )
    return passed.select(monitor, F.timestamp_micros("_us").alias(ts))
