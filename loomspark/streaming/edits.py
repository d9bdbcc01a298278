"""Edits as a stream: hyperevent sessions, and identity reverts from state that a watermark puts in order."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from loomspark.plans.lookback import RADIUS
from loomspark.session import ensure_importable

#: The state store that processors with timers need.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def session_stream(edits: DataFrame, page: str, editor: str, at: str, gap: str, late: str) -> DataFrame:
    """``(page, editors, start)``: sessions of a page's edits, each once the watermark has passed its end.

    The rows are those of the batch form over all edits that were not more than ``late`` late.
    """
    marked = edits.withWatermark(at, late)
    sessions = marked.groupBy(page, F.session_window(at, gap).alias("w")).agg(F.sort_array(F.collect_set(editor)).alias("editors"))
    return sessions.select(page, "editors", F.col("w.start").alias("start"))


def _frame(rows: list[tuple]) -> pd.DataFrame:
    """Rows of the result; plain objects, which every pandas version hands over alike."""
    columns = list(zip(*rows, strict=True)) or [()] * 4
    return pd.DataFrame({n: pd.Series(list(c), dtype=object) for n, c in zip(("page", "rev", "position", "reverts_to"), columns, strict=True)})


class RevertProcessor(StatefulProcessor):
    """Holds a page's edits until the watermark has passed them, then compares them in order.

    State is what waits, how many edits were settled, and the last ``radius`` hashes.
    """

    def __init__(self, radius: int):
        self.radius = radius

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rev bigint, ms bigint, sha string")
        self.settled = handle.getValueState("settled", "position bigint, shas array<string>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = [(int(r), int(ms), s) for frame in rows for r, ms, s in zip(frame.rev, frame.ms, frame.sha, strict=True)]
        if new:
            self.waiting.appendList(new)
            for ms in sorted({ms for _, ms, _ in new}):
                self.handle.registerTimer(ms)
        yield _frame([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        until = expiredTimerInfo.getExpiryTimeInMs()
        rows = list(self.waiting.get()) if self.waiting.exists() else []
        due = sorted((r[1], r[0], r[2]) for r in rows if r[1] <= until)
        rest = [tuple(r) for r in rows if r[1] > until]
        position, shas = self.settled.get() if self.settled.exists() else (0, [])
        shas, out = list(shas), []
        for _, rev, sha in due:
            back = next((k for k in range(1, len(shas) + 1) if sha is not None and shas[-k] == sha), None)
            out.append((key[0], rev, position, position - back if back and back > 1 else None))
            position, shas = position + 1, [*shas, sha][-self.radius :]
        if due:
            self.settled.update((position, shas))
            self.waiting.put(rest) if rest else self.waiting.clear()
        yield _frame(out)

    def close(self) -> None:
        pass


def revert_stream(edits: DataFrame, page: str, rev: str, at: str, sha: str, late: str, radius: int = RADIUS) -> DataFrame:
    """``(page, rev, position, reverts_to)`` of an edit stream, as in the batch form, for edits that the watermark has passed.

    Edits that are not more than ``late`` late count at their own time, whatever order they arrive
    in; later ones are dropped.  The session's state store must be ``STATE_STORE``.
    """
    ensure_importable(edits.sparkSession)
    named = edits.select(F.col(page).cast("string").alias("page"), F.col(rev).cast("bigint").alias("rev"), F.col(at).alias("at"), F.unix_millis(F.col(at)).alias("ms"), F.col(sha).cast("string").alias("sha"))
    marked = named.where("page IS NOT NULL AND at IS NOT NULL").withWatermark("at", late)
    return marked.groupBy("page").transformWithStateInPandas(
        statefulProcessor=RevertProcessor(radius), outputStructType="page string, rev bigint, position bigint, reverts_to bigint", outputMode="Append", timeMode="EventTime"
    )
