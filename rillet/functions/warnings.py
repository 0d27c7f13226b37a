"""Counted and logged out-of-range values (U-S2's warnings).

The check of a value is one expression of the row; what it finds is counted beside the query by
Spark's observed metrics, without a second pass, a Python function or an accumulator.  A batch
query's counts are read from the observation, a stream's arrive with each micro-batch.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

log = logging.getLogger(__name__)

#: Log entries a second at most (the reference's service allows as many).
ENTRIES_PER_SECOND = 1000


def range_counts(value: Column, low: float, high: float) -> list[Column]:
    """Rows below, above and within the bounds (both belong to the range), without a value, and the
    extremes of what lies outside.  NaN is above every bound."""
    below, above = value < F.lit(low), value > F.lit(high)
    return [F.count_if(below).alias("below"), F.count_if(above).alias("above"), F.count_if(~below & ~above).alias("inside"),
            F.count_if(value.isNull()).alias("missing"), F.min(F.when(below, value)).cast("double").alias("lowest"),
            F.max(F.when(above, value)).cast("double").alias("highest")]


def watch_range(df: DataFrame, column: str, low: float, high: float, *, name: str | None = None) -> tuple[DataFrame, Observation | None]:
    """``df`` unchanged, its rows counted by range while they pass.

    For a batch DataFrame the second result holds the counts once an action has run (``.get``); for a stream it
    is None, and a :class:`RangeWarnings` listener gets the counts under ``name``.
    """
    metrics = range_counts(F.col(f"`{column}`"), low, high)
    name = name or f"range of {column}"
    if df.isStreaming:
        return df.observe(name, *metrics), None
    seen = Observation(name)
    return df.observe(seen, *metrics), seen


class RateLimit:
    """At most ``rate`` entries in any second; the others are counted."""

    def __init__(self, rate: int, clock: Callable[[], float] = time.monotonic) -> None:
        self.rate, self.clock = rate, clock
        self.since, self.let, self.held = clock(), 0, 0

    def allows(self) -> bool:
        now = self.clock()
        if now - self.since >= 1:
            self.since, self.let = now, 0
        self.let += 1
        if self.let <= self.rate:
            return True
        self.held += 1
        return False


def report(name: str, counts: dict, limit: RateLimit, warn: Callable[[str], None] = log.warning) -> None:
    """One entry for what lies below and one for what lies above, unless the rate is used up."""
    for side, extreme in (("below", "lowest"), ("above", "highest")):
        if counts.get(side) and limit.allows():
            held = f" ({limit.held} entries held back)" if limit.held else ""
            limit.held = 0
            warn(f"{name}: {counts[side]} values {side} the bound, {extreme} {counts[extreme]}{held}")


class RangeWarnings(StreamingQueryListener):
    """Logs the out-of-range counts of every micro-batch and keeps their totals by name."""

    def __init__(self, rate: int = ENTRIES_PER_SECOND, warn: Callable[[str], None] = log.warning) -> None:
        self.limit, self.warn = RateLimit(rate), warn
        self.totals: dict[str, dict[str, int]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for name, row in event.progress.observedMetrics.items():
            counts = row.asDict()
            if "below" not in counts or "above" not in counts:
                continue   # somebody else's metrics
            total = self.totals.setdefault(name, {"below": 0, "above": 0, "inside": 0, "missing": 0})
            for k in total:
                total[k] += counts[k]
            report(name, counts, self.limit, self.warn)

    def onQueryTerminated(self, event) -> None:
        pass
