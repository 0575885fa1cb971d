"""Times the headline queries; prints one JSON line.

Inputs are the test tables of $BENCH_SF_DIR. The profile events behind most queries (one per line
item, so 600 k at scale 0.1) are landed once as a table of many files before the clock starts, as an
ingestion job would leave them; the tables themselves come as single row groups, which one task reads.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profilegate.operators import contract as C
from profilegate.operators import metrics as M
from profilegate.operators import normalize as N
from profilegate.operators import rejects
from profilegate.operators import routing as RT
from profilegate.operators import rules as R
from profilegate.operators import sli
from profilegate.operators import views as V
from profilegate.options import JobOptions, configure, local_folder, shared_folder
from profilegate.plans import fixtures as FX
from profilegate.plans import landed as L
from profilegate.streaming import jobs

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ROUNDS = 3


def noop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    options = JobOptions(salt=FX.SALT, reference_date=FX.REFERENCE_DATE)
    base = shared_folder(local_folder(spark))
    tasks = 2 * int(CPUS)

    lines = FX.table(spark, FOLDER, "lineitem").select("l_orderkey", "l_linenumber")
    orders = FX.profile_events(spark, FOLDER)
    lines.join(orders, F.expr("l_orderkey = event_id")).drop("l_orderkey").repartition(tasks).write.parquet(base + "/events")
    events = spark.read.parquet(base + "/events")
    FX.raw_profiles(spark, FOLDER).repartition(tasks).write.parquet(base + "/raw")
    L.responses(spark, FOLDER).repartition(tasks).write.parquet(base + "/responses")
    responses = spark.read.parquet(base + "/responses")
    L.created_log(spark, FOLDER).repartition(tasks).write.parquet(base + "/log")
    log = spark.read.parquet(base + "/log")
    FX.table(spark, FOLDER, "events").repartition(tasks).write.parquet(base + "/ticks")
    raw_events = spark.read.parquet(base + "/ticks")

    def checked() -> DataFrame:
        return R.check_quality(events, FX.REFERENCE_DATE)

    benches = {
        "quality_reasons": lambda: checked().select("event_id", R.REASONS),
        "counters_all": lambda: M.quality_counters(checked()),
        "invalid_events": lambda: rejects.invalid_events(checked(), FX.SALT, "event_id"),
        "route_topics": lambda: RT.route(C.check_profiles(events, FX.REFERENCE_DATE), options),
        "latest_per_user": lambda: V.latest_per_key(events, V.USER_KEY, ["ingested_at", "event_id", "l_linenumber"]),
        "latest_valid": lambda: V.latest_valid(checked(), 100),
        "contract_profiles": lambda: C.check_profiles(spark.read.parquet(base + "/raw"), FX.REFERENCE_DATE),
        "validate_log": lambda: jobs.validate_log(log, options),
        "normalize_profiles": lambda: N.explode_profiles(N.classify_responses(responses), "request_id"),
        "resolve_attempts": lambda: N.resolve_attempts(N.classify_responses(responses), 2),
        "latency_summary": lambda: M.exact_percentiles(raw_events, "value", [500, 950, 990], ["event_type"]),
        "burn_rate_alerts": lambda: sli.burn_rate_alerts(L.event_slots(spark, FOLDER, 1800), ["sli"], step=1800, span=7200),
    }
    seconds = {}
    for name, build in benches.items():
        best = None
        for _ in range(ROUNDS):
            start = time.perf_counter()
            noop(build())
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
