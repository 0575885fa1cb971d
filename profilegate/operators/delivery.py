"""Publication outcomes from a delivery log (one row per record handed to the event log)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OK = "ok"


def acknowledged() -> Column:
    """A report counts as an acknowledgement only with topic, partition and offset."""
    complete = F.col("topic").isNotNull() & F.col("partition").isNotNull() & F.col("offset").isNotNull()
    return F.coalesce((F.col("outcome") == "ack") & complete, F.lit(False))


def delivery_outcome(log: DataFrame, *, single: bool = False) -> DataFrame:
    """One verdict per batch: time-outs first, then errors, then missing acknowledgements.

    ``single`` judges one-record publications, which know no flush time-out. Counters fold before
    the shuffle, so a batch of any size costs one row per map task.
    """
    counts = log.groupBy("batch_id").agg(
        F.count("*").alias("records"),
        F.count_if(acknowledged()).alias("acknowledged"),
        F.count_if(F.col("outcome") == "error").alias("errors"),
        F.count_if(F.col("outcome").isNull()).alias("undelivered"),
    )
    failed = F.when(F.col("errors") > 0, F.lit("delivery_failed")).when(
        F.col("acknowledged") != F.col("records"), F.lit("delivery_not_acknowledged")
    )
    timed_out = F.when(F.col("undelivered") > 0, F.lit("delivery_timeout"))
    verdict = F.coalesce(failed, F.lit(OK)) if single else F.coalesce(timed_out, failed, F.lit(OK))
    return counts.withColumn("result", verdict)


def unacknowledged_records(records: DataFrame, log: DataFrame) -> DataFrame:
    """Records no acknowledgement came back for.

    Repeated reports are folded before the join, so a record acknowledged many times meets its
    partner once. The join runs on the full record key, which spreads evenly.
    """
    keys = ["batch_id", "record_id"]
    return records.join(log.filter(acknowledged()).select(*keys).distinct(), keys, "left_anti")
