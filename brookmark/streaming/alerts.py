"""Alerts on a stream of samples: a row when a condition has held long enough, and one when it ends."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from brookmark.operators.metrics import STALE_AFTER

FIRING, ENDED = "firing", "ended"
_STATE = "since long, last long, samples long, fired boolean, times array<long>, truths array<boolean>"


class Stretch:
    """The open stretch of one series, in microseconds; what ``hold`` computes, sample by sample."""

    def __init__(self, duration: int, max_gap: int, since: int = -1, last: int = -1, samples: int = 0, fired: bool = False):
        self.duration, self.max_gap = duration, max_gap
        self.since, self.last, self.samples, self.fired = since, last, samples, fired
        self.out: list[tuple[str, int, int, int]] = []

    def _say(self, what: str) -> None:
        self.out.append((what, self.since, self.last, self.samples))

    def close(self) -> None:
        if self.fired:
            self._say(ENDED)
        self.since, self.last, self.samples, self.fired = -1, -1, 0, False

    def add(self, at: int, true: bool) -> None:
        if self.samples and (not true or at > self.last + self.max_gap):
            self.close()
        if true:
            self.since = at if not self.samples else self.since
            self.last, self.samples = at, self.samples + 1
            if not self.fired and self.last - self.since >= self.duration:
                self.fired = True
                self._say(FIRING)

    def silent(self, now: int) -> None:
        """No sample up to ``now`` is missing any more."""
        if self.samples and now > self.last + self.max_gap:
            self.close()


def hold_stream(samples: DataFrame, ts: str, series: str | Sequence[str], condition: Column, duration: int,
                max_gap: int = STALE_AFTER, lateness: str = "1 minute") -> DataFrame:
    """The stretches of ``hold`` on a stream, append mode: (series, state, since, until, samples, held_seconds).

    A ``firing`` row comes when a stretch has lasted ``duration`` seconds, an ``ended`` row at its false
    sample or, by a timer, once the watermark is ``max_gap`` seconds past its last one; the ended rows are the rows of
    ``hold``. Samples up to ``lateness`` late are put in order; later ones are dropped by the watermark.
    At one instant true samples come before false ones. Samples without a time are left out; a null condition is false.
    A null series is one of its own, which ``hold`` leaves out.

    A series has one sample a scrape, so its state is the samples of ``lateness`` and four numbers, and
    a micro-batch holds few rows of it. Long back-fills belong to ``hold``, which cuts a series into slices.
    """
    keys = [series] if isinstance(series, str) else list(series)
    fields = {f.name: f.dataType.simpleString() for f in samples.schema.fields}
    schema = ", ".join(f"`{k}` {fields[k]}" for k in keys) + ", state string, since long, until long, samples long"
    flat = (
        samples.where(F.col(ts).isNotNull())
        .withWatermark(ts, lateness)
        .select(*keys, ts, F.unix_micros(F.col(ts).cast("timestamp")).alias("_at"), F.coalesce(condition, F.lit(False)).alias("_true"))
    )

    def follow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        since, last, count, fired, times, truths = state.get if state.exists else (-1, -1, 0, False, [], [])
        stretch = Stretch(duration * 1_000_000, max_gap * 1_000_000, since, last, count, fired)
        waiting = list(zip(times, truths))
        if not state.hasTimedOut:
            for frame in frames:
                waiting.extend(zip(frame["_at"].tolist(), frame["_true"].tolist()))
        waiting.sort(key=lambda s: (s[0], not s[1]))
        mark = state.getCurrentWatermarkMs()
        done = 0
        while done < len(waiting) and waiting[done][0] <= mark * 1000:
            stretch.add(*waiting[done])
            done += 1
        waiting = waiting[done:]
        stretch.silent(mark * 1000)
        if waiting or stretch.samples:
            ends = stretch.last + stretch.max_gap if stretch.samples else None
            wake = min(x for x in (ends, waiting[0][0] if waiting else None) if x is not None)
            state.update((
                stretch.since, stretch.last, stretch.samples, stretch.fired, [t for t, _ in waiting], [b for _, b in waiting],
            ))
            state.setTimeoutTimestamp(max(wake // 1000, mark) + 1)
        elif state.exists:
            state.remove()
        if stretch.out:
            rows = pd.DataFrame(stretch.out, columns=["state", "since", "until", "samples"])
            for i, name in enumerate(keys):
                rows.insert(i, name, [key[i]] * len(rows))
            yield rows

    found = flat.groupBy(*keys).applyInPandasWithState(follow, schema, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    held = (F.col("until") - F.col("since")) / 1e6
    return found.select(
        *keys, "state", F.timestamp_micros("since").alias("since"), F.timestamp_micros("until").alias("until"), "samples",
        held.alias("held_seconds"),
    )
