"""State over micro-batches: artifacts that were seen before, and budgets that go on from batch to batch."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

ADMITTED = "source string, artifact_id string, sha256 string, size_bytes long, ts timestamp, running_bytes long, admitted boolean"


def first_seen(artifacts: DataFrame, late: str = "1 day", by: list[str] = ("source", "sha256")) -> DataFrame:
    """A stream's artifacts without those whose source and hash came before, in this batch or an earlier one.

    A repeated artifact is known for at least ``late`` after the first (event time ``ts``); state is dropped after that.
    """
    return artifacts.withWatermark("ts", late).dropDuplicatesWithinWatermark(list(by))


def within_budget(artifacts: DataFrame, most_bytes: int) -> DataFrame:
    """``artifacts(source, artifact_id, sha256, size_bytes, ts)`` of a stream with the bytes of their source so far, and
    whether these are within the budget.

    A source's total is kept from batch to batch; within a batch artifacts count in order of time and id. One that
    doesn't fit is refused and doesn't count, so that a smaller one after it may still fit. A negative or null size
    counts as zero, a null source is a source of its own. A source's rows of one batch arrive in pieces; what is held of
    them at once are ids, hashes and sizes.
    """
    columns = ["source", "artifact_id", "sha256", "size_bytes", "ts"]

    def admit(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        total = state.get[0] if state.exists else 0
        rows = pd.concat(list(batches)).sort_values(["ts", "artifact_id"], kind="stable", na_position="last")
        running, admitted = [], []
        for size in rows["size_bytes"].fillna(0).clip(lower=0).astype("int64"):
            fits = total + int(size) <= most_bytes
            total += int(size) if fits else 0
            running.append(total)
            admitted.append(fits)
        state.update((total,))
        yield rows[columns].assign(running_bytes=running, admitted=admitted)

    return artifacts.select(*columns).groupBy("source").applyInPandasWithState(admit, ADMITTED, "total long", "append", GroupStateTimeout.NoTimeout)
