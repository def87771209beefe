"""Routing, muting, repeating and mapping of alerts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog.operators.ordered import _join_on
from emberlog.session import stored

REPEAT_SECONDS = 12 * 3600


@dataclass(frozen=True)
class Route:
    receiver: str
    match: Mapping[str, str] = field(default_factory=dict)
    go_on: bool = False


# The routing tree, in order, and the receiver of everything else.
ROUTES = (
    Route("pagerduty-critical", {"severity": "critical"}, go_on=True),
    Route("slack-critical", {"severity": "critical"}),
    Route("slack-warnings", {"severity": "warning"}),
    Route("webhook-retrain", {"alertname": "DataDriftDetected"}),
    Route("webhook-retrain", {"alertname": "ModelAccuracyDegraded"}),
)
DEFAULT_RECEIVER = "default"

# Event type per alert name.
EVENT_TYPES = {
    "DataDriftDetected": "data-drift-alert",
    "ModelAccuracyDegraded": "performance-drift-alert",
    "HighErrorRate": "error-rate-alert",
    "HighLatency": "latency-alert",
}
DEFAULT_EVENT_TYPE = "generic-alert"

PAYLOAD_SCHEMA = (
    "alerts array<struct<labels:map<string,string>,annotations:map<string,string>>>"
)


def route_alerts(alerts: DataFrame, routes: Sequence[Route] = ROUTES, default: str = DEFAULT_RECEIVER) -> DataFrame:
    """One row per (alert, receiver): first match wins unless the route goes on."""
    taken: Column = F.lit(False)
    hits = []
    for r in routes:
        match: Column = F.lit(True)
        for label, value in r.match.items():
            match = match & F.coalesce(F.col(label) == value, F.lit(False))
        here = match & ~taken
        hits.append(F.when(here, F.lit(r.receiver)))
        if not r.go_on:
            taken = taken | match
    found = F.array_compact(F.array(*hits))
    return alerts.withColumn(
        "receiver", F.explode(F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(default))))
    )


def inhibit(alerts: DataFrame, equal: Sequence[str] = ("alertname", "instance"), ts: str = "ts",
            source: str = "critical", target: str = "warning") -> DataFrame:
    """Drop target-severity alerts that have a source-severity one with equal labels at
    the same evaluation time."""
    keys = [*equal, ts]
    mutes = alerts.where(F.col("severity") == source).select(*keys).distinct()
    keyed = alerts.withColumn("_is_target", F.col("severity") == target)
    renamed = mutes.select(*[F.col(k).alias(f"_m_{k}") for k in keys])
    condition = F.col("_is_target")
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_m_{k}"))
    return keyed.join(renamed, condition, "left_anti").drop("_is_target")


def next_ticks(ticks: DataFrame, keys: Sequence[str], gap: int) -> DataFrame:
    """For each tick (``keys``, ``_t``) the first one of its group after ``_t + gap``, as ``_to``.

    A group is cut into stretches of a sixteenth of the gap. The answer lies in the stretch
    of ``_t + gap``, or is the first tick of a later one; of the latter there is a row for
    each stretch only."""
    width = max(1, gap // 16)
    stretch = lambda c: F.floor(c / width).cast("long")
    t = F.col("_t")
    asks = ticks.select(*keys, stretch(t + gap).alias("_s"), (t + gap).alias("_at"), t.alias("_asker"), F.lit(None).cast("long").alias("_tick"))
    known = ticks.select(*keys, stretch(t).alias("_s"), t.alias("_at"), F.lit(None).cast("long").alias("_asker"), t.alias("_tick"))
    # from the end of a stretch: an ask comes before a tick of the same instant
    later = Window.partitionBy(*keys, "_s").orderBy(F.desc("_at"), F.asc_nulls_last("_asker")).rowsBetween(Window.unboundedPreceding, 0)
    inside = asks.unionByName(known).withColumn("_near", F.min("_tick").over(later)).where("_asker IS NOT NULL")
    firsts = asks.unionByName(known).groupBy(*keys, "_s").agg(F.min("_tick").alias("_first"))
    beyond = Window.partitionBy(*keys).orderBy(F.desc("_s")).rowsBetween(Window.unboundedPreceding, -1)
    firsts = firsts.select(*keys, "_s", F.min("_first").over(beyond).alias("_far"))
    found = _join_on(inside, firsts, [*keys, "_s"], "left")
    return found.select(*keys, F.col("_asker").alias("_t"), F.coalesce("_near", "_far").alias("_to"))


def suppress_repeats(
    alerts: DataFrame, keys: Sequence[str] = ("alertname", "severity"), ts: str = "ts", repeat_seconds: int = REPEAT_SECONDS
) -> DataFrame:
    """Notification times per alert group: the first, then one per repeat interval.

    What is sent depends on what was sent before: a chain through the group, from each tick
    to the first one past the interval. Pointers are doubled round by round, and a round
    marks as many ticks of the chain again as are known, so that the rounds grow with the
    logarithm of the notifications and a group's ticks are spread over all tasks.
    """
    keys = list(keys)
    ticks = stored(alerts.groupBy(*keys, F.unix_micros(ts).alias("_t")).agg(F.count(F.lit(1)).alias("alerts")).where("_t IS NOT NULL"))
    jumps = stored(next_ticks(ticks, keys, repeat_seconds * 1_000_000).where("_to IS NOT NULL"))
    sent = ticks.groupBy(*keys).agg(F.min("_t").alias("_t"))
    while not jumps.isEmpty():
        more = _join_on(sent, jumps, [*keys, "_t"]).select(*keys, F.col("_to").alias("_t"))
        sent = stored(sent.unionByName(more))
        ahead = jumps.select(*keys, F.col("_t").alias("_to"), F.col("_to").alias("_then"))
        jumps = stored(_join_on(jumps, ahead, [*keys, "_to"]).select(*keys, "_t", F.col("_then").alias("_to")))
    kept = _join_on(ticks, sent, [*keys, "_t"])
    return kept.select(*keys, F.timestamp_micros("_t").alias(ts), "alerts")


def event_type(name: Column, mapping: Mapping[str, str] = EVENT_TYPES, default: str = DEFAULT_EVENT_TYPE) -> Column:
    codes = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(codes, name), F.lit(default))


def alerts_from_payload(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """All alerts of webhook payloads with the event type each one triggers."""
    parsed = payloads.withColumn("_p", F.from_json(column, PAYLOAD_SCHEMA)).withColumn("_a", F.explode("_p.alerts"))
    unknown = F.lit("Unknown")
    name = F.coalesce(F.col("_a.labels")["alertname"], unknown)
    return parsed.select(
        *payloads.columns,
        name.alias("alertname"),
        F.coalesce(F.col("_a.labels")["severity"], unknown).alias("severity"),
        F.coalesce(F.col("_a.annotations")["description"], F.lit("No description")).alias("description"),
        event_type(name).alias("event_type"),
    )
