"""Quality counters, ingestion signals and latency summaries.

Every aggregate here folds on the map side, so its shuffle carries one row per group and task, no
matter how uneven the groups are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from profilegate.operators import rules as R

# Upper bounds of the latency histogram, in the unit of the value; fixed values.
LATENCY_BOUNDS = (0.5, 1.0, 2.5, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0)


def status() -> Column:
    return F.when(R.is_valid(), F.lit("valid")).otherwise(F.lit("invalid"))


def status_counts(checked: DataFrame) -> DataFrame:
    """Rows per validation status and source, counted before reasons multiply them."""
    return checked.groupBy(status().alias("validation_status"), "source").agg(F.count("*").alias("profiles"))


def reason_counts(checked: DataFrame) -> DataFrame:
    """Rows per source and rejection reason; a row with many reasons counts under each."""
    reasons = checked.select("source", F.explode(R.REASONS).alias("reason"))
    return reasons.groupBy("source", "reason").agg(F.count("*").alias("profiles"))


def quality_counters(checked: DataFrame) -> DataFrame:
    """Status and reason counters from one pass: each row counts once under a null reason."""
    rows = checked.select(
        status().alias("validation_status"),
        "source",
        F.explode(F.concat(F.array(F.lit(None).cast("string")), R.REASONS)).alias("reason"),
    )
    return rows.groupBy("validation_status", "source", "reason").agg(F.count("*").alias("profiles"))


def status_rollup(checked: DataFrame) -> DataFrame:
    """Counters per status and source, per status, and in total."""
    rows = checked.select(status().alias("validation_status"), "source")
    return rows.rollup("validation_status", "source").agg(
        F.grouping_id().cast("int").alias("level"), F.count("*").alias("profiles")
    )


def invalid_without_reason(invalid: DataFrame, reasons: str = R.REASONS) -> DataFrame:
    """Share of invalid events that say why; anything below 100 % alerts."""
    totals = invalid.agg(
        F.count("*").alias("invalid_events"),
        F.count_if(F.coalesce(F.size(reasons), F.lit(0)) <= 0).alias("without_reason"),
    )
    share = F.when(F.col("invalid_events") > 0, 1 - F.col("without_reason") / F.col("invalid_events"))
    return totals.withColumns({"with_reason_share": F.round(share, 6), "alert": F.col("without_reason") > 0})


def failures_by_reason(attempts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Attempts and failures per reason with each reason's share of all attempts of its group.

    ``reason`` is null for a success. The shares are taken over the few grouped rows, not the input.
    """
    outcome = F.coalesce("reason", F.lit("ok")).alias("reason")
    counts = attempts.groupBy(*by, outcome).agg(F.count("*").alias("attempts"))
    total = F.sum("attempts").over(W.partitionBy(*by) if by else W.partitionBy(F.lit(0)))
    return counts.withColumn("rate", F.round(F.col("attempts") / total, 6))


def signal_totals(signals: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Attempts, valid, invalid and failed publications in one pass over ``signal`` rows."""
    counts = [F.count_if(F.col("signal") == s).alias(s) for s in ("created", "invalid", "publish_failed", "source_failed")]
    return signals.groupBy(*by).agg(F.count("*").alias("attempts"), *counts)


def latency_histogram(df: DataFrame, value: str, by: Sequence[str] = (), bounds: Sequence[float] = LATENCY_BOUNDS) -> DataFrame:
    """Cumulative histogram: rows at or below each bound, plus the total under an infinite bound."""
    counts = [F.count_if(F.col(value) <= b).alias(f"le_{i}") for i, b in enumerate(bounds)]
    wide = df.filter(F.col(value).isNotNull()).groupBy(*by).agg(*counts, F.count("*").alias("le_total"))
    pairs = [(F.lit(float(b)), F.col(f"le_{i}")) for i, b in enumerate(bounds)] + [(F.lit(float("inf")), F.col("le_total"))]
    rows = F.array(*[F.struct(b.alias("upper_bound"), n.alias("rows")) for b, n in pairs])
    return wide.select(*by, F.inline(rows))


def _cell(v: Column) -> Column:
    """Number of the logarithmic cell of a value, rising with the value; zero is a cell of its own."""
    # Logarithms of doubles lie between -746 and 710, so the sum below is positive.
    size = F.floor(F.least(F.ln(F.abs(v)), F.lit(710.0)) * 1000) + F.lit(1_000_000)
    return F.when(v == 0, F.lit(0).cast("long")).when(v > 0, size).otherwise(-size)


def exact_percentiles(df: DataFrame, value: str, per_mille: Sequence[int], by: Sequence[str]) -> DataFrame:
    """Nearest-rank percentiles per group, exact, without gathering a group anywhere.

    Equal values are folded first. A grid of cells as wide as a thousandth of their value, below and above
    zero, then locates the cell that holds each wanted rank; only the distinct values of those cells are
    ranked. A group of any size costs its cells in the first window and one cell in the second. Nulls and
    NaN are left out.
    """
    number = F.col(value).cast("double")
    clean = df.filter(number.isNotNull() & ~F.isnan(number)).select(*by, F.col(value).alias("_value"))
    cell = _cell(F.col("_value").cast("double"))
    folded = clean.groupBy(*by, "_value").agg(F.count("*").alias("_n")).withColumn("_cell", cell)

    # The grid comes from the raw rows again: a second cheap scan beats keeping the folded values.
    mine = [f"_by_{i}" for i in range(len(by))]
    keys = [F.col(c).alias(m) for c, m in zip(by, mine, strict=True)]
    grid = clean.groupBy(*keys, cell.alias("_grid_cell")).agg(F.count("*").alias("_in_cell"))
    whole = W.partitionBy(*mine)
    grid = grid.withColumns(
        {
            "_below": F.sum("_in_cell").over(whole.orderBy("_grid_cell")) - F.col("_in_cell"),
            "rows": F.sum("_in_cell").over(whole),
        }
    )
    wanted = grid.withColumn("per_mille", F.explode(F.array(*[F.lit(p) for p in per_mille])))
    rank = F.ceil(F.col("rows") * F.col("per_mille") / 1000) - F.col("_below")
    wanted = wanted.withColumn("_rank", rank).filter(F.col("_rank").between(1, F.col("_in_cell")))

    match = F.col("_cell") == F.col("_grid_cell")
    for c, m in zip(by, mine, strict=True):
        match &= F.col(c).eqNullSafe(F.col(m))
    hits = folded.join(wanted, match)
    seen = F.sum("_n").over(W.partitionBy(*by, "per_mille").orderBy("_value"))
    ranked = hits.withColumn("_seen", seen)
    reached = ranked.filter(F.col("_rank").between(F.col("_seen") - F.col("_n") + 1, F.col("_seen")))
    return reached.select(*by, "per_mille", "rows", F.col("_value").alias("value"))


def approximate_percentiles(
    df: DataFrame, value: str, per_mille: Sequence[int], by: Sequence[str], accuracy: int = 10_000
) -> DataFrame:
    """Percentiles from a bounded sketch per group: one shuffle, rank error at most 1/accuracy."""
    shares = [p / 1000 for p in per_mille]
    sketch = df.groupBy(*by).agg(
        F.count(value).alias("rows"), F.percentile_approx(value, shares, accuracy).alias("_values")
    )
    pairs = F.arrays_zip(F.array(*[F.lit(p) for p in per_mille]).alias("per_mille"), F.col("_values").alias("value"))
    return sketch.select(*by, "rows", F.inline(pairs)).select(*by, "per_mille", "rows", "value")


SKETCH_K = 800


def rank_error(k: int = SKETCH_K) -> float:
    """By how much the rank of a value from a sketch may be off, as a share of all rows, with 99 % confidence (KLL's bound)."""
    return 2.296 / k**0.9723


def quantile_sketches(df: DataFrame, value: str, by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """rows and a mergeable ``sketch`` of a few kilobytes per group, folded in the map tasks.

    Stored per slot, sketches give the percentiles of any window later, without its rows. Nulls and NaN are left out.
    """
    number = F.col(value).cast("double")
    clean = df.filter(number.isNotNull() & ~F.isnan(number)).withColumn("_value", number)
    return clean.groupBy(*by).agg(F.count("*").alias("rows"), F.kll_sketch_agg_double("_value", F.lit(k)).alias("sketch"))


def merged_percentiles(sketches: DataFrame, per_mille: Sequence[int], by: Sequence[str] = ()) -> DataFrame:
    """Percentiles over all sketches of each group, within ``rank_error`` of the exact rank; sketches merge in the map tasks."""
    merged = sketches.groupBy(*by).agg(F.sum("rows").alias("rows"), F.kll_merge_agg_double("sketch").alias("_sketch"))
    pairs = [F.struct(F.lit(p).alias("per_mille"), F.kll_sketch_get_quantile_double("_sketch", F.lit(p / 1000)).alias("value")) for p in per_mille]
    return merged.filter("rows > 0").select(*by, "rows", F.inline(F.array(*pairs))).select(*by, "per_mille", "rows", "value")
