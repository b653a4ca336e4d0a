"""Session ordinals over a stream: keyed state across micro-batches, same numbers as the batch operator."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from riskfeat.operators.sessions import SESSION_GAP_SECONDS

SECOND = 1_000_000
# what a user's state holds: time of the last numbered row, its session and number, and the rows that wait
STATE = "last long, session long, row_no long, times array<long>, ranks array<int>, seqs array<long>"


def streaming_ordinals(
    events: DataFrame,
    time: str,
    user: str,
    seq: str,
    rank: str | None = None,
    lateness: str = "1 hour",
    gap: int = SESSION_GAP_SECONDS,
) -> DataFrame:
    """(user, seq, session, row_no, since_last) of every row, once the watermark has passed it.

    Rows wait in the user's state until no earlier row can come, then they are numbered in the order of time, ``rank`` and
    ``seq`` (both whole numbers): the session (from 0, a gap of more than ``gap`` seconds starts one), the row's number
    in the user's log (from 0) and the seconds since the row before. So files may come in any order within ``lateness``;
    rows that come later than that are left out, as rows without a user or a time are. A state holds the rows of
    ``lateness`` and three numbers for what went before.
    """
    rows = events.withWatermark(time, lateness).where(F.col(user).isNotNull() & F.col(time).isNotNull())
    rows = rows.select(
        F.col(user).alias("user"),
        F.col(time).alias("time"),
        F.unix_micros(time).alias("us"),
        (F.lit(0) if rank is None else F.col(rank)).cast("int").alias("rank"),
        F.col(seq).cast("long").alias("seq"),
    )
    kind = rows.schema["user"].dataType.simpleString()

    def number(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, session, row_no, times, ranks, seqs = state.get if state.exists else (None, 0, -1, [], [], [])
        waiting = list(zip(times, ranks, seqs))
        if not state.hasTimedOut:
            for batch in batches:
                waiting.extend(zip(batch["us"].tolist(), batch["rank"].tolist(), batch["seq"].tolist()))
        waiting.sort()
        watermark = state.getCurrentWatermarkMs()
        final = sum(us // 1000 <= watermark for us, _, _ in waiting)
        out = []
        for us, _, number_in_log in waiting[:final]:
            since = None if last is None else (us - last) // SECOND
            session += since is not None and us - last > gap * SECOND
            row_no += 1
            last = us
            out.append((key[0], number_in_log, session, row_no, since))
        rest = waiting[final:]
        state.update((last, session, row_no, *([r[i] for r in rest] for i in range(3))))
        if rest:
            state.setTimeoutTimestamp(max(rest[0][0] // 1000, watermark + 1))
        if out:
            done = pd.DataFrame(out, columns=["user", "seq", "session", "row_no", "since_last"])
            yield done.astype({"since_last": "Int64"})

    schema = f"user {kind}, seq long, session long, row_no long, since_last long"
    numbered = rows.groupBy("user").applyInPandasWithState(number, schema, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return numbered.withColumnRenamed("user", user)
