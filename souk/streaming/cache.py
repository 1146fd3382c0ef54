"""Request de-duplication with a time to live."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from souk.streaming.counts import with_event_time

# Default lifetime of a response, and the shorter one of the gateway.
DEFAULT_TTL = timedelta(seconds=60)
GATEWAY_TTL = timedelta(seconds=30)

# requests wait in state as JSON; its times keep their microseconds
EXACT_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _first_per_ttl(ttl: timedelta, columns: list[str]):
    """Per key, the requests at which no entry is alive; each starts an entry that lives for ``ttl``.

    A request waits in state until the watermark has passed it: only then can no earlier one arrive.
    """
    length = int(ttl.total_seconds() * 1_000_000)

    def pick(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        until, held = state.getOption or (None, [])
        waiting = [tuple(r) for r in held]
        for chunk in rows:
            waiting.extend(zip(chunk["_at"].tolist(), chunk["_row"].tolist()))
        waiting.sort()
        watermark = state.getCurrentWatermarkMs() * 1000
        done = bisect_left(waiting, (watermark,))
        picks = []
        for at, row in waiting[:done]:
            if until is None or at >= until:
                picks.append(row)
                until = at + length
        waiting = [r for r in waiting[done:] if until is None or r[0] >= until]  # the entry answers the others
        if waiting or (until is not None and until > watermark):
            state.update((until, waiting))
            # wake when the first request can be judged, or the entry has ended
            state.setTimeoutTimestamp(max((waiting[0][0] if waiting else until) // 1000, watermark // 1000 + 1))
        elif state.exists:
            state.remove()  # every later request is past this entry
        if picks:
            yield pd.DataFrame({columns[0]: [key[0]] * len(picks), columns[1]: picks})

    return pick


def ttl_dedup(requests: DataFrame, key: str = "key", ttl: timedelta = DEFAULT_TTL, ts: str = "ts",
              late: str = "10 minutes") -> DataFrame:
    """The requests that compute: the first per key, then the first at or after each expiry, by event time.

    The order of arrival within ``late`` plays no part: a request is judged once the watermark has passed it, so those
    of the last ``late`` before the newest are still open. Of equal times the smaller row, as JSON, is first. State per
    key is the end of its last entry and the requests not yet judged which that entry does not answer.
    """
    timed = with_event_time(requests, ts).filter(F.col(ts).isNotNull())
    rows = timed.select(F.col(key).alias("_key"), F.col(ts), F.unix_micros(ts).alias("_at"), F.to_json(F.struct(*timed.columns), EXACT_TIMES).alias("_row"))
    picked = rows.withWatermark(ts, late).groupBy("_key").applyInPandasWithState(
        _first_per_ttl(ttl, ["_key", "_row"]), outputStructType=f"_key {timed.schema[key].dataType.simpleString()}, _row string",
        stateStructType="until bigint, held array<struct<at: bigint, row: string>>", outputMode="Append",
        timeoutConf=GroupStateTimeout.EventTimeTimeout,
    )
    return picked.select(F.from_json("_row", timed.schema, EXACT_TIMES).alias("r")).select("r.*")
