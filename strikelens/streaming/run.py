"""Starting and pacing of streaming queries."""

from __future__ import annotations

import time

from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..runtime import state_for
from ..settings import BATCH_TICK
from .replay import Replay


def drain(writer: DataStreamWriter) -> StreamingQuery:
    """Process what is there, batch by batch, and stop once nothing is left."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def drain_ticks(replay: Replay, topic: str, writer: DataStreamWriter) -> StreamingQuery | None:
    """Offers one tick after the other and processes each before the next, so that a micro-batch is a tick, of however many files."""
    query = None
    with state_for(replay.spark, replay.size()):
        while replay.offer(topic):
            query = drain(writer)
    return query


def paced(writer: DataStreamWriter, tick: str = BATCH_TICK) -> StreamingQuery:
    """Keep running, one micro-batch per tick; the source limits how much a tick takes."""
    return writer.trigger(processingTime=tick).start()


def ticked(query: StreamingQuery, poll: float = 0.1) -> None:
    """Waits until a query has ended a micro-batch that began after the call.

    For queries whose source never runs dry, such as a clock: ``processAllAvailable`` would wait for a moment without new rows.
    """
    done = lambda: (query.lastProgress or {"batchId": -1})["batchId"]
    # the next batch may have begun before
    last = done() + 2
    while done() < last:
        if not query.isActive:
            raise query.exception() or RuntimeError("the query was stopped")
        time.sleep(poll)
