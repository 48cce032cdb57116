"""Channel state followed as a stream of ledger events, one state a channel, equal to the batch fold of the ledger."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from newsloom.functions.channels import SUCCESS, UNHEALTHY
from newsloom.operators import ledger

_FIELDS = [f.rsplit(" ", 1) for f in ledger.CHANNEL.split(", ")]
_VALUES = [name for name, _ in _FIELDS[1:]]
#: Columns of a state that are those of the last event under another name.
_TAKEN = {"last_target_date": "date", "last_status": "status", "last_attempt_at": "attempted_at", "last_error_type": "error_type", "last_error": "reason"}


def plain(value):
    """A value without pandas' ways of saying that there is none."""
    return None if value is None or value is pd.NaT or (isinstance(value, float) and value != value) else value


def step(state: dict | None, event: dict) -> dict:
    """The state of a channel after one more attempt."""
    was = state or {}
    bad = event["status"] in UNHEALTHY
    out = {c: event.get(_TAKEN.get(c, c)) for c in _VALUES}
    out["frequency"] = event["frequency"] or was.get("frequency") or ""
    out["previous_status"] = was.get("last_status") or ""
    out["consecutive_unhealthy"] = (was.get("consecutive_unhealthy") or 0) + 1 if bad else 0
    won = event["status"] in SUCCESS
    out["last_success_at"] = event["attempted_at"] if won else was.get("last_success_at")
    out["last_success_date"] = event["date"] if won else was.get("last_success_date")
    return out


class ChannelFold(StatefulProcessor):
    """Keeps the state of one channel and says what it is whenever attempts come in.

    Events of a micro-batch are taken in the order of their numbers; numbers that the state holds already are passed
    over, so a batch that is run again changes nothing.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("channel", ", ".join(f"{n} {k}" for n, k in _FIELDS[1:]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state = dict(zip(_VALUES, self.state.get(), strict=True)) if self.state.exists() else None
        fresh = [{c: plain(v) for c, v in r.items()} for frame in rows for r in frame.to_dict("records")]
        fresh = sorted((r for r in fresh if state is None or r["seq"] > state["seq"]), key=lambda r: r["seq"])
        if not fresh:
            return
        for event in fresh:
            event["date"] = pd.Timestamp(event["date"]).date() if event["date"] is not None else None
            state = step(state, event)
        values = [int(state[n]) if k == "long" and state[n] is not None else state[n] for n, k in _FIELDS[1:]]
        self.state.update(tuple(values))
        yield pd.DataFrame([[key[0], *values]], columns=[n for n, _ in _FIELDS]).astype(object)

    def close(self) -> None:
        return


def states(events: DataFrame) -> DataFrame:
    """A stream of states, one row a channel and micro-batch in which it had attempts."""
    attempts = events.where((F.col("status") != ledger.MISSING) & (F.col("source") != ""))
    return attempts.groupBy("source").transformWithStateInPandas(ChannelFold(), ledger.CHANNEL, "Update", "None")


def follow(spark: SparkSession, folder: str, out: str, checkpoint: str):
    """A query that follows the committed versions of a ledger and appends states; ``latest`` reads them.

    The session needs RocksDB as its state store (``spark.sql.streaming.stateStore.providerClass``).
    """
    events = spark.readStream.schema(ledger.EVENT).parquet(f"{folder}/version=*")

    def put(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={epoch:010d}")  # run again, a batch replaces itself

    return states(events).writeStream.foreachBatch(put).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(updates: DataFrame) -> DataFrame:
    """The last state of each channel among all updates."""
    rest = [n for n, _ in _FIELDS[1:]]
    return updates.groupBy("source").agg(F.max_by(F.struct(*rest), F.col("seq")).alias("s")).select("source", "s.*")
