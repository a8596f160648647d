"""Per-device state: debouncing and heartbeats. The only Python in the engine, Arrow-batched."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def _ordered(batches: Iterator[pd.DataFrame], by: list[str]) -> pd.DataFrame:
    return pd.concat(list(batches), ignore_index=True).sort_values(by, kind="stable", ignore_index=True)


def debounce(events: DataFrame, changes: int = 3, within_seconds: int = 5) -> DataFrame:
    """Events at which a device changes its state for the third time within a few seconds.

    Needs ``device, state, event_id, ts``. State per device: the last label and the times of the
    last changes, so it stays the same size for ever.
    """
    width = within_seconds * 1_000_000

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = _ordered(batches, ["t", "event_id"])
        last, ring = state.get if state.exists else (None, [])
        previous = rows["state"].shift(1)
        previous.iloc[0] = last
        moved = rows[previous.notna() & (previous != rows["state"])]
        times = np.concatenate([np.asarray(ring, dtype="int64"), moved["t"].to_numpy("int64")])
        state.update((rows["state"].iloc[-1], times[-(changes - 1):].tolist()))
        index = np.arange(len(ring), len(times))
        back = index - (changes - 1)
        glitch = np.zeros(len(index), dtype=bool)
        ready = back >= 0
        glitch[ready] = times[index[ready]] - times[back[ready]] <= width
        hits = moved[glitch]
        yield pd.DataFrame({"device": key[0], "event_id": hits["event_id"], "t": hits["t"]})

    keyed = events.select("device", "state", "event_id", F.unix_micros("ts").alias("t"))
    glitches = keyed.groupBy("device").applyInPandasWithState(
        step,
        "device string, event_id bigint, t bigint",
        "last string, ring array<bigint>",
        "append",
        GroupStateTimeout.NoTimeout,
    )
    return glitches.select("device", "event_id", F.timestamp_micros("t").alias("ts"))


def heartbeat(events: DataFrame, silence_seconds: int) -> DataFrame:
    """An offline mark (value NULL) for every device that stays silent too long.

    Needs ``device`` and a watermarked ``ts``. A silence that has ended is seen in the data; one
    that goes on is closed by an event-time timer. Nothing is filled in.
    """
    silence = silence_seconds * 1_000_000

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            (last,) = state.get
            state.remove()
            offline = np.asarray([last + silence], dtype="int64")
        else:
            times = np.sort(np.concatenate([b["t"].to_numpy("int64") for b in batches]))
            if state.exists:
                (last,) = state.get
                times = np.concatenate([[last], times[times > last]])
            offline = times[:-1][np.diff(times) > silence] + silence
            last = int(times[-1])
            deadline = (last + silence) // 1000
            if deadline <= state.getCurrentWatermarkMs():
                offline = np.append(offline, last + silence)
                state.remove()
            else:
                state.update((last,))
                state.setTimeoutTimestamp(deadline)
        yield pd.DataFrame({"device": key[0], "t": offline})

    keyed = events.select("device", "ts", F.unix_micros("ts").alias("t"))
    marks = keyed.groupBy("device").applyInPandasWithState(
        step, "device string, t bigint", "last bigint", "append", GroupStateTimeout.EventTimeTimeout
    )
    return marks.select("device", F.timestamp_micros("t").alias("offline_at"), F.lit(None).cast("double").alias("value"))
