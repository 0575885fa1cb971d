"""Attempts that arrive over several batches, resolved as soon as their request is settled.

The state of a request is what its attempts have come to so far. It is closed when the outcome can't change any more, by a
success or a final failure with all attempts before it, or by the last retry; and at the latest when the watermark passes
its timeout, with what is known by then. Until the timeout it is remembered as closed, so copies of its attempts are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from profilegate.operators.normalize import NO_ATTEMPT

BUCKETS = 2_048
OUTPUT = "request_id string, outcome string, attempts_made int, closed_by string"


def settled(tries: dict[int, list], max_retries: int) -> tuple[int, str] | None:
    """The attempt that settles a request and how, if all before it are known; tries are [stops, outcome] by attempt."""
    for attempt in range(max_retries + 1):
        if attempt not in tries:
            return None
        stops, outcome = tries[attempt]
        if stops:
            return attempt, "success" if outcome == "ok" else "final_failure"
    return max_retries, "last_retry"


def latest(tries: dict[int, list]) -> int | None:
    """The attempt that counts if no other comes: the first that stops, else the last."""
    stops = [a for a, (stop, _) in tries.items() if stop]
    return min(stops) if stops else max(tries, default=None)


def resolve_stream(
    classified: DataFrame, max_retries: int = 2, *, ts: str = "requested_at", timeout: str = "10 minutes", buckets: int = BUCKETS
) -> DataFrame:
    """request_id, outcome, attempts_made and closed_by (success, final_failure, last_retry or timeout) of a stream.

    ``timeout`` is the watermark's delay, too: an attempt that is later than that is lost, and its request is closed without
    it. The result of a request whose attempts all come in time is that of ``normalize.resolve_attempts``. Of attempts
    that are repeated with another outcome, the earliest one that stops counts. Attempts without a number or beyond the last
    retry count for nothing but keep their request's place: it ends as ``no_attempt`` if there are no others. Those without a
    time have no place in a stream and are left out.

    Requests are dealt by hash to ``buckets``, each of which is one group: a group costs milliseconds in Python, a request in
    it microseconds. A bucket with new attempts is read and written whole, so there should be hundreds or a few thousand requests within
    the timeout for each. A checkpoint keeps the number it was begun with.
    """
    if max_retries < 0:
        raise ValueError("max_retries must not be negative")
    if buckets < 1:
        raise ValueError("buckets must be at least 1")
    rows = classified.select(
        "request_id",
        F.coalesce("attempt", F.lit(-1)).alias("attempt"),
        F.col(ts).cast("timestamp").alias("at"),
        F.coalesce("reason", F.lit("ok")).alias("outcome"),
        (F.col("reason").isNull() | ~F.col("retryable")).alias("stops"),
    ).filter("at IS NOT NULL")

    def resolve(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # By request: its tries, None once it is closed, and the moment of its timeout.
        known = {request: (None if tries is None else {a: [stops, outcome] for a, stops, outcome in tries}, due) for request, tries, due in json.loads(state.get[0] if state.exists else "[]")}
        watermark = state.getCurrentWatermarkMs()
        out: list[tuple] = []

        def close(request: str | None, tries: dict[int, list], attempt: int | None, how: str) -> None:
            outcome = NO_ATTEMPT if attempt is None else tries[attempt][1]
            out.append((request, outcome, 0 if attempt is None else attempt + 1, how))

        last: dict[str | None, int] = {}
        for batch in [] if state.hasTimedOut else batches:
            # In the order of time, so that of copies the first that stops is kept.
            batch = batch.sort_values(["attempt", "at", "outcome"])
            moments = batch["at"].to_numpy().astype("datetime64[ms]").astype("int64").tolist()
            columns = [batch[c].tolist() for c in ("request_id", "attempt", "stops", "outcome")]
            for request, attempt, stops, outcome, at in zip(*columns, moments, strict=True):
                last[request] = max(last.get(request, 0), at)
                tries = known.setdefault(request, ({}, 0))[0]
                if tries is not None and 0 <= attempt <= max_retries and not tries.get(attempt, [False])[0]:
                    tries[attempt] = [bool(stops), outcome]
        for request, at in last.items():
            tries = known[request][0]
            found = None if tries is None else settled(tries, max_retries)
            if found is not None:
                close(request, tries, *found)
                tries = None
            known[request] = (tries, max(at, watermark + 1))
        for request, (tries, due) in list(known.items()):
            if due < watermark:
                del known[request]
                if tries is not None:
                    close(request, tries, latest(tries), "timeout")
        if known:
            kept = [[r, None if tries is None else [[a, *x] for a, x in tries.items()], due] for r, (tries, due) in known.items()]
            state.update((json.dumps(kept),))
            state.setTimeoutTimestamp(min(due for _, due in known.values()))
        else:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=["request_id", "outcome", "attempts_made", "closed_by"])

    bucket = F.pmod(F.xxhash64("request_id"), F.lit(buckets))
    keyed = rows.withColumn("bucket", bucket).withWatermark("at", timeout).groupBy("bucket")
    return keyed.applyInPandasWithState(resolve, OUTPUT, "requests string", "append", GroupStateTimeout.EventTimeTimeout)
