"""Feed health and repeated readings in a stream (A5, B7), by state per key with timers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.functions.columns import from_micros, micros, width_micros

OUTAGE = ("event string, outage_start timestamp, outage_end timestamp, skipped_polls long, "
          "recovered_at timestamp, reason string")


def stream_outages(polls: DataFrame, feed: str = "feed_id", time: str = "polled_at", ok: str = "ok",
                   silence: str | None = None, watermark: str = "1 minute") -> DataFrame:
    """A5 live: one row when a feed's outage opens and one when it closes.

    An outage opens at the first failed poll and closes with the first good one
    behind it: ``opened`` rows have the start, ``closed`` ones what the batch
    report has. With ``silence`` a feed whose last poll lies so far behind the
    watermark is down as well: its outage opens at the end of that time, without
    any poll (reason ``silent``), and closes with the next good poll. A feed is
    reported once an outage, however many polls fail and however often the query
    restarts. Polls count in time order within a micro-batch; state per feed is
    a handful of numbers.
    """
    import numpy as np
    import pandas as pd

    key_type = dict(polls.dtypes)[feed]
    names = [feed, *(f.split()[0] for f in OUTAGE.split(", "))]
    stamps = [f.split()[0] for f in OUTAGE.split(", ") if f.endswith(" timestamp")]
    columns = pd.Index(names)
    # A feed's batch is small, so what Python does per column and frame is most of the work: a poll goes in
    # as one number, twice its microseconds and one if it was good, and times come out as microseconds.
    out_schema = f"{feed} {key_type}, {OUTAGE.replace('timestamp', 'long')}"
    state_schema = "down boolean, start long, last_failed long, skipped long, last_poll long"
    quiet_us = width_micros(silence) if silence else None

    def step(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        down, start, failed, skipped, last = state.get if state.exists else (False, None, None, 0, None)
        out = []
        if state.hasTimedOut:
            if not down:
                down, start, failed, skipped = True, last + quiet_us, None, 0
                out.append((key[0], "opened", start, None, None, None, "silent"))
        else:
            for poll in sorted(x for p in pdfs for x in p["_poll"].tolist()):  # of polls at one time the failed first
                t, good = divmod(poll, 2)
                if good and down:
                    out.append((key[0], "closed", start, failed, skipped, t, None))
                    down, start, failed, skipped = False, None, None, 0
                elif not good:
                    if not down:
                        down, start = True, t
                        out.append((key[0], "opened", t, None, None, None, "failed"))
                    failed, skipped = t, skipped + 1
                last = t if last is None else max(last, t)
        state.update((down, start, failed, skipped, last))
        if quiet_us is not None and not down:
            state.setTimeoutTimestamp(max((last + quiet_us) // 1000, state.getCurrentWatermarkMs() + 1))
        if out:
            # as objects: missing numbers stay missing, and whole ones whole
            yield pd.DataFrame(np.array(out, object), columns=columns)

    timed = polls.where(F.col(time).isNotNull() & F.col(ok).isNotNull())
    inputs = [F.col(feed), (micros(time) * 2 + F.col(ok).cast("long")).alias("_poll")]
    timeout = GroupStateTimeout.NoTimeout
    if silence:
        # the watermark needs the column itself
        timed, timeout = timed.withWatermark(time, watermark), GroupStateTimeout.EventTimeTimeout
        inputs.append(F.col(time))
    told = timed.select(*inputs).groupBy(feed).applyInPandasWithState(step, out_schema, state_schema, "append", timeout)
    return told.select(*[from_micros(c).alias(c) if c in stamps else F.col(c) for c in names])


def stream_first_readings(ticks: DataFrame, delay: str = "10 minutes", keys: Sequence[str] = ("asset_id", "ts"),
                          order: Sequence[str] = ("ingested_at",), time: str = "ingested_at") -> DataFrame:
    """B7 exact: of the polls of one source reading the first, whole, by
    ``order``; the later ones are dropped.

    A reading is known until no poll has shown it for ``delay`` behind the
    watermark: each repeated poll renews it, so a reading that stays frozen,
    however long, is given out once. State is a timer per known reading, spread
    over tasks by reading, not by asset. Files must come in landing order (as file
    sources do); ``order`` decides within a micro-batch.
    """
    import pandas as pd

    schema = T.StructType(ticks.schema.fields)
    delay_ms = width_micros(delay) // 1000

    def step(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        pdf = pd.concat([p for p in pdfs if len(p)])
        known, newest = state.exists, pdf[time].max()
        if known and not pd.isna(newest):
            newest = max(newest, pd.Timestamp(state.get[0], unit="ms"))
        last_ms = 0 if pd.isna(newest) else newest.value // 10**6 if hasattr(newest, "value") else 0
        state.update((int(last_ms),))
        state.setTimeoutTimestamp(max(int(last_ms) + delay_ms, state.getCurrentWatermarkMs() + 1))
        if not known:
            yield pdf.sort_values(list(order), kind="stable").head(1)[schema.names]

    return (ticks.withWatermark(time, delay).groupBy(*keys)
                 .applyInPandasWithState(step, schema, "last long", "append", GroupStateTimeout.EventTimeTimeout))
