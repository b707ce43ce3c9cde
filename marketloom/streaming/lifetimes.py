"""How long listings stay, as a stream: the first and last time that a key was seen, kept until it is gone."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def lifetimes_stream(listings: DataFrame, key: str, time: str = "ts", late: str = "1 day", gone_after: str = "14 days") -> DataFrame:
    """A row for a key whenever what is known of it changes: first_seen and last_seen (days), days between (0 counts as 7), active.

    A key that was not seen for ``gone_after`` of event time, by the watermark, gets a last row
    that is not active, and its state goes; if it is seen later, it begins anew. Rows later
    than ``late`` are left out, so are rows without a key.
    """
    patience = int(pd.Timedelta(gone_after).total_seconds() * 1000)
    kind = listings.schema[key].dataType.simpleString()

    def row(own: tuple, first: int, last: int, active: bool) -> pd.DataFrame:
        seen = [pd.Timestamp(t, unit="ms").normalize() for t in (first, last)]
        return pd.DataFrame({key: [own[0]], "first_seen": [seen[0].date()], "last_seen": [seen[1].date()], "days": [(seen[1] - seen[0]).days or 7], "active": [active]})

    def seen(own: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            first, last = state.get
            state.remove()
            yield row(own, first, last, False)
            return
        first, last = state.get if state.exists else (None, None)
        for part in parts:
            if len(part):
                first = int(min(part["ms"].min(), part["ms"].min() if first is None else first))
                last = int(max(part["ms"].max(), part["ms"].max() if last is None else last))
        state.update((first, last))
        state.setTimeoutTimestamp(max(last + patience, state.getCurrentWatermarkMs() + 1))
        yield row(own, first, last, True)

    own = listings.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(key, F.col(time).cast("timestamp").alias(time), F.unix_millis(F.col(time).cast("timestamp")).alias("ms")).withWatermark(time, late)
    fields = f"{key} {kind}, first_seen date, last_seen date, days int, active boolean"
    return own.groupBy(key).applyInPandasWithState(seen, fields, "first bigint, last bigint", "update", GroupStateTimeout.EventTimeTimeout)
