"""Service-level indicators over time: success rate, burn rate and sustained breaches.

Raw rows are folded to fixed time slots first. Windows then run over slots, whose number depends on
the time covered and not on the traffic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DAY = 24 * 3600


def slot_of(ts: Column, step: int) -> Column:
    """Start of the slot of an instant, in epoch seconds."""
    return (F.floor(F.unix_micros(ts.cast("timestamp")) / (step * 1_000_000)) * step).cast("long")


def slot_counts(df: DataFrame, ts: str, good: Column, step: int, by: Sequence[str]) -> DataFrame:
    """Good and total rows per group and slot."""
    return df.groupBy(*by, slot_of(F.col(ts), step).alias("slot")).agg(
        F.count("*").alias("total"), F.count_if(good).alias("good")
    )


def trailing(by: Sequence[str], span: int, step: int):
    """The slots that make up the last ``span`` seconds, the current one included."""
    return W.partitionBy(*by).orderBy("slot").rangeBetween(step - span, 0)


def success_rate(slots: DataFrame, by: Sequence[str], *, step: int, span: int = DAY, target: float = 0.99) -> DataFrame:
    """Rolling success rate over ``span`` at each slot, and whether it meets the target."""
    w = trailing(by, span, step)
    rolled = slots.select(*by, "slot", F.sum("good").over(w).alias("good"), F.sum("total").over(w).alias("total"))
    rate = F.col("good") / F.col("total")
    return rolled.withColumns({"success_rate": F.round(rate, 6), "meets_target": rate >= target})


def sustained(flag: Column, w, slots_needed: int) -> Column:
    """True where every slot of a full trailing window raises the flag.

    The window spans time, not rows, and counts raised flags only: a slot without traffic adds none,
    so a gap breaks the run instead of passing for health, and no calendar has to be joined in.
    """
    return F.count(F.when(flag, 1)).over(w) == slots_needed


def burn_rate_alerts(
    slots: DataFrame, by: Sequence[str], *, step: int, span: int = 1800, target: float = 0.99, limit: float = 2.0
) -> DataFrame:
    """Error-budget burn per slot, and an alert where it stays above ``limit`` for the whole span."""
    burn = (1 - F.col("good") / F.col("total")) / F.lit(1 - target)
    # Rounded before it is compared, so that a rate right at the limit does not alert.
    grid = slots.withColumn("burn_rate", F.round(burn, 6))
    alert = sustained(F.col("burn_rate") > limit, trailing(by, span, step), span // step)
    return grid.select(*by, "slot", "total", "good", "burn_rate", alert.alias("alert"))


def p99_alerts(
    df: DataFrame, ts: str, value: str, by: Sequence[str], *, threshold: float, step: int, span: int = 900, share: int = 99
) -> DataFrame:
    """Slots whose p99 is above the threshold, and an alert where that lasts for the whole span.

    The p99 itself is not needed: it exceeds the threshold exactly when fewer than 99 % of the rows
    stay within it. That takes two counters per slot instead of an ordering of its values.
    """
    slots = slot_counts(df.filter(F.col(value).isNotNull()), ts, F.col(value) <= threshold, step, by)
    grid = slots.withColumn("p99_breached", F.col("good") * 100 < F.col("total") * share)
    alert = sustained(F.col("p99_breached"), trailing(by, span, step), span // step)
    return grid.select(*by, "slot", "total", F.col("good").alias("within"), "p99_breached", alert.alias("alert"))
