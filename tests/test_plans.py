"""What filters and column selection leave of a scan."""

import datetime as dt

import pytest
from people import GOOD, TODAY, frame
from pyspark.sql import functions as F

from profilegate import schemas as S
from profilegate.operators import contract as C
from profilegate.operators import normalize as N
from profilegate.operators import rules as R
from profilegate.plans import fixtures, landed


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def dated(spark, tmp_path):
    def write(df):
        df.withColumn("day", F.lit(dt.date(2025, 1, 1))).write.partitionBy("day").parquet(str(tmp_path / "t"))
        return spark.read.parquet(str(tmp_path / "t"))

    return write


CHECKS = {
    "quality": lambda df: R.check_quality(df, TODAY),
    "profiles": lambda df: C.check_profiles(df, TODAY),
}


@pytest.mark.parametrize("name", CHECKS)
def test_filters_and_columns_reach_the_scan_of_profiles(spark, dated, name):
    checked = CHECKS[name](dated(frame(spark, [{}])))
    one = checked.filter("day = '2025-01-01' AND source_user_id IS NOT NULL").filter(F.size(R.REASONS) == 0)
    text = plan(one.select("source_user_id"))
    assert "PartitionFilters: [isnotnull(day" in text
    assert text.count("Generate ") == 1  # the rules are evaluated once
    key = plan(checked.filter("phone = 'x'").select("phone", R.REASONS))
    assert "Generate" in key


def test_filters_reach_the_scan_of_messages_and_responses(spark, dated, tmp_path):
    messages = dated(spark.createDataFrame([(1, S.CREATED_TOPIC, "{}")], "k long, topic string, value string"))
    text = plan(C.check_messages(messages).filter("day = '2025-01-01' AND k > 0"))
    assert "PartitionFilters: [isnotnull(day" in text and "GreaterThan(k,0)" in text
    assert text.count("from_json(VariantType") + text.count("concat([, value") <= 2 and text.count("sha2") <= 4
    rows = spark.createDataFrame([("a", 0, None, 1.0, 1, 200, None, "{}")], S.RESPONSE_SCHEMA)
    rows.withColumn("day", F.lit(dt.date(2025, 1, 1))).write.partitionBy("day").parquet(str(tmp_path / "r"))
    found = N.classify_responses(spark.read.parquet(str(tmp_path / "r"))).filter("day = '2025-01-01' AND attempt = 0")
    text = plan(found.filter("reason IS NULL").select("request_id"))
    assert "PartitionFilters: [isnotnull(day" in text and "EqualTo(attempt,0)" in text


def test_good_profile_is_complete():
    assert set(S.NORMALIZED_FIELDS) <= set(GOOD)


def test_derived_rows_are_dealt_by_their_number(spark, tmp_path):
    """A small file of many rows is worked on by many tasks, whatever its bytes."""
    spark.range(45_000).coalesce(1).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    dealt = fixtures.spread(rows)
    assert (rows.rdd.getNumPartitions(), dealt.rdd.getNumPartitions()) == (1, 5)
    assert dealt.distinct().count() == 45_000


def test_batches_of_a_stream_have_equally_many_files(spark, tmp_path):
    """Batches are written by several tasks, and each is read as one, even where it is empty or small."""
    path = str(tmp_path / "rows")
    number = F.when(F.col("id") < 10, 0).when(F.col("id") < 70_000, 1).otherwise(3)
    files = landed.in_files(spark.range(0, 100_000, 1, 8), path, 4, number)
    assert files == 3
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", files).parquet(path)
    seen = []
    writer = stream.writeStream.foreachBatch(lambda batch, i: seen.append((i, batch.count())))
    writer.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert seen == [(0, 10), (1, 69_990), (2, 0), (3, 30_000)]
