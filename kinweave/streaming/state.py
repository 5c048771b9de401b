"""Keyed state on streams: newest profile per visitor, last interactions per conversation."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from kinweave.streaming.windows import start_batches
from kinweave.streaming.store import append_upserts

KEEP = 10


def latest_profile_state(events: DataFrame, value: str = "metric") -> DataFrame:
    """(tenant_id, visid, at, value): newest event per visitor, emitted whenever its visitor has new events (update mode).

    ``events``: tenant_id, visid, at (microseconds), and the value column; of equal times the greater value wins. One row of state per visitor,
    combined inside every task first, so a busy visitor is no burden.
    """
    newest = F.max(F.struct("at", F.col(value).alias("value"))).alias("newest")
    return events.groupBy("tenant_id", "visid").agg(newest).select(
        "tenant_id", "visid", F.col("newest.at").alias("at"), F.col("newest.value").alias(value))


class LastInteractions(StatefulProcessor):
    """List state with at most ``keep`` interactions per conversation, by turn; of one turn the greater text.

    With ``idle_ms``, a timer ends a conversation that has had no new interaction for so long: it is put out once more, marked ``ended``, and
    forgotten. The list itself lives twice as long at most (TTL), should a timer be lost with a changed query.
    """

    def __init__(self, keep: int, idle_ms: int | None):
        self.keep, self.idle_ms = keep, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        ttl = {"ttlDurationMs": 2 * self.idle_ms} if self.idle_ms else {}
        self.held = handle.getListState("interactions", T.StructType().add("turn", "long").add("text", "string"), **ttl)

    def _out(self, key, rows, ended: bool) -> pd.DataFrame:
        return pd.DataFrame({"conv_id": [key[0]], "turns": [[t for t, _ in rows]], "texts": [[x for _, x in rows]], "ended": [ended]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last = {int(t): x for t, x in self.held.get()}
        for pdf in rows:  # a busy conversation comes in pieces
            for turn, text in zip(pdf["turn"], pdf["text"]):
                if pd.notna(turn):
                    turn = int(turn)
                    before = last.get(turn)
                    last[turn] = text if before is None else before if text is None else max(before, text)
            last = dict(sorted(last.items())[-self.keep:])
        held = sorted(last.items())
        if held:
            self.held.put([(t, x) for t, x in held])
            if self.idle_ms:
                for old in list(self.handle.listTimers()):
                    self.handle.deleteTimer(old)
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
            yield self._out(key, held, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = [(int(t), x) for t, x in self.held.get()]
        self.held.clear()
        yield self._out(key, held, True)

    def close(self) -> None:
        pass


def conversation_memory_stream(turns: DataFrame, keep: int = KEEP, idle_ms: int | None = None) -> DataFrame:
    """(conv_id, turns, texts, ended): the last interactions of a conversation, emitted on every change (update mode, RocksDB state).

    ``turns``: conv_id, turn, text; rows without a turn number are no interactions. Turns may come in any order and repeatedly.
    """
    return turns.select("conv_id", "turn", "text").groupBy("conv_id").transformWithStateInPandas(
        LastInteractions(keep, idle_ms), "conv_id long, turns array<long>, texts array<string>, ended boolean", "Update",
        "ProcessingTime" if idle_ms else "None")


def start_upserts(changes: DataFrame, path: str, trigger: dict | None = None):
    """Log every change of a keyed state as an upsert of its micro-batch; ``store.current`` reads the newest row per key."""
    return start_batches(changes, lambda batch, i: append_upserts(batch, f"{path}/out", i), path, "update", trigger, several=False)
