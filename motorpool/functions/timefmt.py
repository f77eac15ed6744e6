"""Timestamp parsing, latency and trailing-window expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted layouts, tried in this order (fixed values).
LAYOUTS = (
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX",
    "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]XXX",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]",
    "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]",
    "yyyy-MM-dd",
)
DEVICE_LAYOUT = "MMM dd HH:mm:ss XXX yyyy"


def parse_iso(text: Column) -> Column:
    """ISO-8601 in any accepted layout, NULL when unreadable."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in LAYOUTS])


def parse_iso_ms(text: Column) -> Column:
    return F.unix_millis(parse_iso(text))


def parse_device(text: Column) -> Column:
    """``Mon Jul 08 10:00:00 GMT+05:30 2024``: weekday dropped, "GMT" stripped."""
    body = F.regexp_replace(F.regexp_replace(text, r"^[A-Za-z]{3} ", ""), "GMT", "")
    return F.try_to_timestamp(body, F.lit(DEVICE_LAYOUT))


def utc_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def millis_between(start: Column, end: Column) -> Column:
    return F.unix_millis(end) - F.unix_millis(start)


def broker_latency_ms(ingest: Column, broker: Column) -> Column:
    """Negative clocks are not latencies."""
    gap = millis_between(ingest, broker)
    return F.when(gap >= 0, gap)


def age_ms(ts: Column, now: Column) -> Column:
    return F.greatest(millis_between(ts, now), F.lit(0).cast("long"))


def inference_latency_ms(ingest: Column, writer: Column, inference: Column) -> Column:
    """From the bronze write if known, else end to end."""
    return F.coalesce(millis_between(writer, inference), millis_between(ingest, inference))


def floor_seconds(ts: Column, seconds: int) -> Column:
    """Start of the tumbling window that holds ``ts``."""
    return F.timestamp_seconds(F.floor(F.unix_seconds(ts) / seconds) * seconds)
