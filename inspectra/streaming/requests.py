"""Requests with an idempotency key: run once, refused while they run, answered
from memory afterwards.

A stream of requests and a stream of answers meet in one stateful operator, keyed
by the request's key. Its state is what the key is doing: nothing, running, or
done with an answer. Answers are forgotten after ``remember`` (the state's time to
live), and a run that has not answered after ``patience`` is given up by a timer,
so that a crash does not block its key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: Milliseconds that an answer is remembered, and that a run may take.
REMEMBER, PATIENCE = 3_600_000, 600_000
#: What becomes of a row: to be run now, refused (it runs already), an answer from
#: memory, an answer taken in, a failure taken in, an answer nobody waits for, a run
#: that was given up.
RUN, REFUSED, STORED, ANSWERED, FAILED, LATE, GIVEN_UP = "run", "refused", "stored", "answered", "failed", "late", "given up"
DECISIONS = "key string, request_id string, decision string, value string"
#: Whether a stream makes batches without new rows. Timers fire in them, and with
#: timers there is always one more: a stream that is to end makes none.
_EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Keyed(StatefulProcessor):
    """One key's state: ``running`` names the request that runs, ``answer`` what
    the last one gave."""

    def __init__(self, remember: int, patience: int):
        self.remember, self.patience = remember, patience

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.running = handle.getValueState("running", "request_id string, until long")
        self.answer = handle.getValueState("answer", "value string", self.remember)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        every = pd.concat(list(rows))
        # Answers first: who asks in the same batch may have them.
        every = every.sort_values(["kind", "timestamp", "request_id"], kind="stable")
        running = self.running.get()[0] if self.running.exists() else None
        answer = self.answer.get()[0] if self.answer.exists() else None
        known, out = self.answer.exists(), []
        for kind, request, value in zip(every["kind"], every["request_id"], every["value"]):
            if kind in ("answer", "failure"):
                if running != request:
                    out.append((request, LATE, value))
                    continue
                running = None
                self._stop()
                if kind == "answer":
                    answer, known = value, True
                    self.answer.update((value,))
                out.append((request, ANSWERED if kind == "answer" else FAILED, value))
            elif known:
                out.append((request, STORED, answer))
            elif running is not None:
                # The same request handed on again is the one that runs.
                out.append((request, RUN if running == request else REFUSED, value))
            else:
                running = request
                until = timerValues.getCurrentProcessingTimeInMs() + self.patience
                self.running.update((request, until))
                self.handle.registerTimer(until)
                out.append((request, RUN, value))
        yield self._rows(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        out = []
        if self.running.exists():
            request, until = self.running.get()
            if until <= expiredTimerInfo.getExpiryTimeInMs():
                self.running.clear()
                out.append((request, GIVEN_UP, None))
        yield self._rows(key, out)

    def _stop(self) -> None:
        self.handle.deleteTimer(self.running.get()[1])
        self.running.clear()

    @staticmethod
    def _rows(key, out) -> pd.DataFrame:
        return pd.DataFrame([(key[0], *o) for o in out], columns=["key", "request_id", "decision", "value"])

    def close(self) -> None:
        pass


def decide(requests: DataFrame, answers: DataFrame, remember: int = REMEMBER, patience: int = PATIENCE) -> DataFrame:
    """``key, request_id, decision, value`` of the rows of two streams: ``requests``
    (``key, request_id, timestamp, value``) and ``answers`` (the same and ``ok``).
    A request is the same one if its id is. The session takes the RocksDB state
    store, which time to live and timers need."""
    requests.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)
    columns = ["key", "request_id", "timestamp", "value"]
    asked = requests.select(*columns, F.lit("request").alias("kind"))
    given = answers.select(*columns, F.when(F.coalesce("ok", F.lit(False)), "answer").otherwise("failure").alias("kind"))
    rows = asked.unionByName(given).where("key is not null and request_id is not null")
    return rows.groupBy("key").transformWithStateInPandas(Keyed(remember, patience), DECISIONS, "Append", "ProcessingTime")


def serve(requests: DataFrame, answers: DataFrame, run: Callable[[DataFrame], DataFrame], answered: str, decisions: str, checkpoint: str, remember: int = REMEMBER, patience: int = PATIENCE, once: bool = True, seconds: int = 1) -> StreamingQuery:
    """Decide about requests, run those that are due, and keep what was decided.

    ``run`` takes the due requests and returns ``key, request_id, value, ok``; its
    rows are written as JSON to ``answered``, the folder that ``answers`` streams
    from, so a run's answer comes back as an event. A batch that is done again
    replaces its own files, in both folders."""

    def each(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            batch.write.mode("overwrite").json(f"{decisions}/batch={number}")
            due = batch.where(F.col("decision") == RUN)
            if not due.isEmpty():
                done = run(due.select("key", "request_id", "value")).select("key", "request_id", "value", "ok", F.current_timestamp().alias("timestamp"))
                done.write.mode("overwrite").json(f"{answered}/batch={number}")
        finally:
            batch.unpersist()

    return start(decide(requests, answers, remember, patience), each, checkpoint, once, seconds)


def start(decisions: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True, seconds: int = 1) -> StreamingQuery:
    """Start a stream of decisions. With ``once`` it takes what is there and ends;
    timers that are due fire as soon as it is started with new rows again."""
    writer, conf = decisions.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint), decisions.sparkSession.conf
    before = conf.get(_EMPTY_BATCHES)
    try:
        conf.set(_EMPTY_BATCHES, str(not once).lower())
        return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{seconds} seconds")).start()
    finally:
        conf.set(_EMPTY_BATCHES, before)
