"""Keyed state: sticky assignment with expiry and alert holding with repeats.

State per key is a pair of numbers or a name and a number. An event-time timeout removes
the state of a silent key once the watermark has passed its expiry.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

WEEK_SECONDS = 7 * 86400
DAY_SECONDS = 86400


def _in_order(rows: Iterator[pd.DataFrame], by: list[str]) -> pd.DataFrame:
    """One key's rows of a micro-batch in event order. The trigger's file or byte limit
    bounds them."""
    return pd.concat(list(rows)).sort_values(by, ignore_index=True)


def _expire_at(state: GroupState, event_us: int) -> None:
    """Let the state go when the watermark passes ``event_us``."""
    state.setTimeoutTimestamp(max(event_us // 1000, state.getCurrentWatermarkMs() + 1))


def sticky_assignments(stream: DataFrame, ttl_seconds: int = WEEK_SECONDS, lateness: str = "10 minutes") -> DataFrame:
    """``(user_id, row_id, timestamp, offered)`` -> the variant each request is served.

    The first offered variant stays with the user for ``ttl_seconds``; a request after
    that takes the offered one again.
    """
    ttl_us = ttl_seconds * 1_000_000

    def serve(key, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        variant, at = state.get if state.exists else (None, 0)
        batch = _in_order(rows, ["event_us", "row_id"])
        served, sticky = [], []
        for t, offered in zip(batch["event_us"], batch["offered"]):
            # a late request is served what the user has; the assignment's time never goes back
            alive = variant is not None and t - at < ttl_us
            if not alive:
                variant, at = offered, int(t)
            served.append(variant)
            sticky.append(alive)
        state.update((variant, at))
        _expire_at(state, at + ttl_us)
        yield pd.DataFrame(
            {"user_id": key[0], "row_id": batch["row_id"], "variant_id": served, "was_sticky": sticky}
        )

    keyed = stream.withWatermark("timestamp", lateness).select(
        "user_id", "row_id", "timestamp", F.unix_micros("timestamp").alias("event_us"), "offered"
    )
    row = keyed.schema["row_id"].dataType.simpleString()
    return keyed.groupBy("user_id").applyInPandasWithState(
        serve,
        f"user_id string, row_id {row}, variant_id string, was_sticky boolean",
        "variant string, assigned_us bigint",
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )


def held_alert_notices(
    stream: DataFrame, repeat_seconds: int = 12 * 3600, lateness: str = "10 minutes", forget_seconds: int = DAY_SECONDS
) -> DataFrame:
    """``(series, ts, active, for_seconds)`` -> notices after an unbroken hold, at most one
    per repeat interval and series. A series silent for ``forget_seconds`` starts anew."""
    repeat_us = repeat_seconds * 1_000_000
    unset = -1

    def hold(key, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        started, notified = state.get if state.exists else (unset, unset)
        batch = _in_order(rows, ["event_us"])
        notices = []
        for t, active, wait in zip(batch["event_us"], batch["active"], batch["for_seconds"]):
            if not active:
                started = unset
                continue
            started = int(t) if started == unset else started
            due = notified == unset or t - notified > repeat_us
            if t - started >= int(wait) * 1_000_000 and due:
                notified = int(t)
                notices.append((started, notified))
        state.update((started, notified))
        _expire_at(state, int(batch["event_us"].iloc[-1]) + max(repeat_us, forget_seconds * 1_000_000))
        if notices:
            yield pd.DataFrame(
                {
                    "series": key[0],
                    "started_us": [n[0] for n in notices],
                    "notified_us": [n[1] for n in notices],
                }
            )

    keyed = stream.withWatermark("ts", lateness).select(
        "series", "ts", F.unix_micros("ts").alias("event_us"), "active", "for_seconds"
    )
    return keyed.groupBy("series").applyInPandasWithState(
        hold,
        "series string, started_us bigint, notified_us bigint",
        "started bigint, notified bigint",
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
