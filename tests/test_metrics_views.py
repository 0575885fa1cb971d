import datetime as dt
import math
import random

import pytest
from people import TODAY, frame
from pyspark.sql import functions as F

from profilegate import schemas as S
from profilegate.operators import by_user
from profilegate.operators import delivery as D
from profilegate.operators import metrics as M
from profilegate.operators import normalize as N
from profilegate.operators import rules as R
from profilegate.operators import sli
from profilegate.operators import views as V
from profilegate.operators.committed import Dates, Table
from profilegate.sources import event_log
from profilegate.sources import responses as RS


def log(spark, batches):
    """Outcome letters per batch: a acknowledged, p without offset, e error, u undelivered."""
    rows = []
    for b, letters in enumerate(batches):
        for i, letter in enumerate(letters):
            outcome = {"a": "ack", "p": "ack", "e": "error", "u": None}[letter]
            rows.append((f"b{b}", b * 100 + i, "t", outcome, 0, None if letter == "p" else i))
    return spark.createDataFrame(rows, S.DELIVERY_SCHEMA)


def test_delivery_precedence(spark):
    batches = ["aa", "aeu", "ae", "ap", "u", "pe", "p"]
    want = ["ok", "delivery_timeout", "delivery_failed", "delivery_not_acknowledged", "delivery_timeout", "delivery_failed", "delivery_not_acknowledged"]
    got = [r.result for r in D.delivery_outcome(log(spark, batches)).orderBy("batch_id").collect()]
    assert got == want
    single = [r.result for r in D.delivery_outcome(log(spark, ["a", "e", "u", "p"]), single=True).orderBy("batch_id").collect()]
    assert single == ["ok", "delivery_failed", "delivery_not_acknowledged", "delivery_not_acknowledged"]


def test_unacknowledged_records(spark):
    reports = log(spark, ["aeup", "aa"])
    records = reports.select("batch_id", "record_id").union(spark.createDataFrame([("b9", 1)], "a string, b long"))
    flooded = reports.union(reports.filter("record_id = 0")).union(reports.filter("record_id = 0"))
    got = D.unacknowledged_records(records, flooded).orderBy("batch_id", "record_id").collect()
    assert [tuple(r) for r in got] == [("b0", 1), ("b0", 2), ("b0", 3), ("b9", 1)]


def rank_percentile(values, per_mille):
    ordered = sorted(values)
    return ordered[math.ceil(len(ordered) * per_mille / 1000) - 1]


@pytest.mark.parametrize("seed", range(4))
def test_exact_percentiles_equal_sorting(spark, seed):
    rng = random.Random(seed)
    groups = {
        "flat": [5.0] * 700 + [5.5] * 300,
        "wide": [rng.lognormvariate(3, 4) for _ in range(900)],
        "one": [0.0],
        "ties": [float(rng.randint(0, 9)) for _ in range(500)],
        None: [rng.random() / 1000 for _ in range(400)],
    }
    rows = [(g, v) for g, values in groups.items() for v in values]
    rng.shuffle(rows)
    rows += [("flat", None), ("flat", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    wanted = [1, 500, 950, 990, 999, 1000]
    got = {(r.g, r.per_mille): (r.rows, r.value) for r in M.exact_percentiles(df, "v", wanted, ["g"]).collect()}
    assert got == {(g, p): (len(v), rank_percentile(v, p)) for g, v in groups.items() for p in wanted}


def test_approximate_percentiles_stay_within_their_bound(spark):
    df = spark.range(20_000).select(F.lit("g").alias("g"), F.col("id").cast("double").alias("v"))
    for row in M.approximate_percentiles(df, "v", [500, 990], ["g"], accuracy=1000).collect():
        assert abs(row.value - row.rows * row.per_mille / 1000) <= 20_000 / 1000 + 1


def test_counters_agree(spark):
    checked = R.check_quality(frame(spark, [{}, {}, {"username": ""}, {"username": "", "country": "X"}, {"source": "crm"}]), TODAY)
    status = {(r.validation_status, r.source): r.profiles for r in M.status_counts(checked).collect()}
    assert status == {("valid", "random_user"): 2, ("invalid", "random_user"): 2, ("valid", "crm"): 1}
    reason = {(r.source, r.reason): r.profiles for r in M.reason_counts(checked).collect()}
    assert reason == {("random_user", "missing_username"): 2, ("random_user", "unsupported_country"): 1}
    every = {(r.validation_status, r.source, r.reason): r.profiles for r in M.quality_counters(checked).collect()}
    assert every == {(s, src, None): n for (s, src), n in status.items()} | {("invalid", *key): n for key, n in reason.items()}
    rolled = {(r.validation_status, r.source, r.level): r.profiles for r in M.status_rollup(checked).collect()}
    assert rolled[None, None, 3] == 5 and rolled["valid", None, 1] == 3


def test_missing_reasons_alert(spark):
    df = spark.createDataFrame([(["a"],), ([],), (None,), (["b", "c"],)], "rejection_reasons array<string>")
    assert tuple(M.invalid_without_reason(df).first()) == (4, 2, 0.5, True)
    assert tuple(M.invalid_without_reason(df.limit(0)).first()) == (0, 0, None, False)


def test_gaps_break_a_sustained_run(spark):
    rows = [("s", 300 * i, 10, 0) for i in (0, 1, 2, 4, 5, 6, 7, 8)] + [("t", 0, 10, 10)]
    slots = spark.createDataFrame(rows, "sli string, slot long, total long, good long")
    alerts = sli.burn_rate_alerts(slots, ["sli"], step=300, span=900).filter("alert").collect()
    assert sorted(r.slot for r in alerts) == [600, 1800, 2100, 2400]


def test_burn_rate_at_the_limit_does_not_alert(spark):
    slots = spark.createDataFrame([("s", 0, 100, 98), ("t", 0, 100, 97)], "sli string, slot long, total long, good long")
    got = {r.sli: (r.burn_rate, r.alert) for r in sli.burn_rate_alerts(slots, ["sli"], step=300, span=300).collect()}
    assert got == {"s": (2.0, False), "t": (3.0, True)}


@pytest.mark.parametrize("slow,breached", [(0, False), (1, False), (2, True), (200, True)])
def test_p99_breach_equals_the_percentile(spark, slow, breached):
    values = [1.0] * (200 - slow - 1) + [31.0] * slow + [30.0] if slow < 200 else [31.0] * 200
    at = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("k", at, v) for v in values], "kind string, ts timestamp, v double")
    row = sli.p99_alerts(df, "ts", "v", ["kind"], threshold=30.0, step=300, span=300).first()
    want = rank_percentile(values, 990) > 30.0
    assert row.p99_breached == want == (breached and slow > 2 or slow == 200)


def test_rolling_success_rate(spark):
    rows = [("s", 0, 10, 10), ("s", 1800, 10, 5), ("s", 86400, 10, 10)]
    slots = spark.createDataFrame(rows, "sli string, slot long, total long, good long")
    got = [(r.slot, r.success_rate) for r in sli.success_rate(slots, ["sli"], step=1800).orderBy("slot").collect()]
    assert got == [(0, 1.0), (1800, 0.75), (86400, 0.75)]


def test_latest_per_key_takes_one_row_and_folds_before_the_shuffle(spark):
    rows = [("a", 1, 1, "x"), ("a", 2, 1, "y"), ("a", 2, 2, "z"), ("b", 1, 1, None)] * 3
    df = spark.createDataFrame(rows, "k string, t int, tie int, v string").repartition(4)
    newest = V.latest_per_key(df, ["k"], ["t", "tie"])
    assert newest.columns == df.columns
    assert sorted(tuple(r) for r in newest.collect()) == [("a", 2, 2, "z"), ("b", 1, 1, None)]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_top_k_per_reason_limits_before_the_shuffle(spark):
    rows = [([f"r{i % 2}", "all"], dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), f"u{i}") for i in range(20)]
    df = spark.createDataFrame(rows, "rejection_reasons array<string>, processed_at timestamp, source_user_id string")
    top = V.latest_invalid_by_reason(V.invalid_by_reason(df, "processed_at", "source_user_id"), 2)
    assert sorted((r.reason, r.rank, r.source_user_id) for r in top.collect()) == [
        ("all", 1, "u19"), ("all", 2, "u18"), ("r0", 1, "u18"), ("r0", 2, "u16"), ("r1", 1, "u19"), ("r1", 2, "u17"),
    ]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    by_reason = V.invalid_by_reason(df, "processed_at", "source_user_id")
    assert V.latest_invalid_by_reason(by_reason, 5000).count() == 40
    with pytest.raises(ValueError):
        V.latest_invalid_by_reason(by_reason, 0)


def test_views_prune_partitions_and_overwrite_only_their_own(spark, tmp_path):
    path = str(tmp_path / "view")
    first = spark.createDataFrame([("FR", 1), ("DE", 2)], "country string, n int")
    V.write_view(first, path, ["country"], load="1")
    for n in (3, 4):
        V.write_view(spark.createDataFrame([("FR", n)], "country string, n int"), path, ["country"], load="2")
    view = V.read_view(spark, path)
    assert sorted((r.country, r.n) for r in view.collect()) == [("DE", 2), ("FR", 1), ("FR", 4)]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        V.write_view(first, path, ["country"])
    plan = view.filter("country = 'FR'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(country" in plan


def rows_of(spark, path):
    return sorted((tuple(r) for r in V.read_view(spark, path, loads=True).collect()), key=repr)


def test_a_load_is_replaced_whole(spark, tmp_path):
    path, kind = str(tmp_path / "view"), "country string, n int"
    write = lambda rows, load: V.write_view(spark.createDataFrame(rows, kind), path, ["country"], load=load)
    write([("FR", 1), ("DE", 2), (None, 3), ("a/b=c %", 4)], "day 1/2")
    write([("FR", 5)], "b")
    both = [("FR", 1, "day 1/2"), ("DE", 2, "day 1/2"), (None, 3, "day 1/2"), ("a/b=c %", 4, "day 1/2"), ("FR", 5, "b")]
    assert rows_of(spark, path) == sorted(both, key=repr)
    write([("DE", 6)], "day 1/2")
    assert rows_of(spark, path) == [("DE", 6, "day 1/2"), ("FR", 5, "b")]
    write([], "day 1/2")
    assert rows_of(spark, path) == [("FR", 5, "b")]
    V.drop_load(spark, path, "b")
    assert rows_of(spark, path) == [] and V.read_view(spark, path).columns == ["country", "n"]
    write([("FR", 7)], "c")
    assert rows_of(spark, path) == [("FR", 7, "c")]
    with pytest.raises(ValueError):
        V.write_view(spark.createDataFrame([("FR", "x")], "country string, other string"), path, ["country"], load="d")
    with pytest.raises(ValueError):
        V.write_view(spark.createDataFrame([("FR", "x")], "country string, load_id string"), path, ["country"], load="d")
    V.write_view(spark.createDataFrame([("FR", 8)], kind), path, ["country"], mode="overwrite")
    assert [tuple(r) for r in V.read_view(spark, path).collect()] == [("FR", 8)]


def test_a_load_that_dies_before_its_commit_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "view")
    V.write_view(spark.createDataFrame([("FR", 1)], "country string, n int"), path, ["country"], load="a")

    def dies(self, change):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Table, "commit", dies)
        with pytest.raises(RuntimeError):
            V.write_view(spark.createDataFrame([("FR", 2), ("DE", 3)], "country string, n int"), path, ["country"], load="a")
    assert rows_of(spark, path) == [("FR", 1, "a")]
    assert len(Table(spark, path).tidy(0)) == 2 and rows_of(spark, path) == [("FR", 1, "a")]


def test_commits_that_meet_are_worked_out_again(spark, tmp_path):
    path = str(tmp_path / "view")
    V.write_view(spark.createDataFrame([("FR", 1)], "country string, n int"), path, ["country"], load="a")
    one, two, calls = Table(spark, path), Table(spark, path), []
    dirs = two.put(spark.createDataFrame([("DE", 2)], "country string, n int"), ["country"], "b")

    def change(state):
        calls.append(len(state.dirs))
        if len(calls) == 1:
            two.commit(lambda s: s.swap([], dirs))
        return state.swap(state.of("a"), [])

    one.commit(change)
    assert calls == [1, 2] and rows_of(spark, path) == [("DE", 2, "b")]
    assert one.last()[0] == 3 and one.commit(lambda s: s) == one.state() and one.last()[0] == 3


def moments(*days):
    return [(dt.datetime.combine(d, dt.time(12)), str(d)) for d in days]


def test_retention(spark, tmp_path):
    days = [dt.date(2025, 1, 1) - dt.timedelta(days=i) for i in range(10)]
    path, dates = str(tmp_path / "a"), Dates()
    V.write_view(spark.createDataFrame([(d, 1) for d in days], "event_date date, n int"), path, ["event_date"], dates=dates)
    kept = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    assert len(V.expire(spark, path, TODAY, 3)) == 7
    assert sorted(r.event_date for r in V.read_view(spark, path).collect()) == sorted(days[:3])
    files = [*tmp_path.rglob("*.parquet")]
    assert len(files) == 3 and all(kept[p] == p.stat().st_mtime_ns for p in files)
    assert V.expire(spark, path, TODAY, 3) == []
    with pytest.raises(ValueError):
        V.retained(spark.range(1), TODAY, 0)
    V.write_view(spark.range(1), str(tmp_path / "b"), [])
    with pytest.raises(ValueError):
        V.expire(spark, str(tmp_path / "b"), TODAY, 3)


@pytest.mark.parametrize("unit", ["day", "week", "month"])
@pytest.mark.parametrize("layout", [["event_date"], ["kind", "event_date"], ["event_date", "kind"]])
def test_retention_is_exact_at_any_depth(spark, tmp_path, unit, layout):
    today, keep = dt.date(2025, 2, 5), 10
    days = [dt.date(2024, 11, 1) + dt.timedelta(days=i) for i in range(97)]
    path = str(tmp_path / "v")
    for load in "ab":
        rows = spark.createDataFrame([(*m, f"{load}{i % 2}") for i, m in enumerate(moments(*days))], "at timestamp, day string, kind string")
        V.write_view(V.dated(rows, "at", unit), path, layout, load=load, dates=Dates(unit=unit, ts="at"))
    late = [d for d in days if d > today - dt.timedelta(days=keep)]
    view = V.read_view(spark, path)
    assert sorted(r.day for r in V.retained(view, today, keep, Dates(unit=unit, ts="at")).collect()) == sorted([str(d) for d in late] * 2)
    assert V.expire(spark, path, today, keep)
    assert sorted(r.day for r in V.read_view(spark, path).collect()) == sorted([str(d) for d in late] * 2)
    on_disk = spark.read.option("recursiveFileLookup", "true").parquet(f"{path}/_data")
    assert sorted(r.day for r in on_disk.collect()) == sorted([str(d) for d in late] * 2)
    assert V.expire(spark, path, today, keep) == []
    # Loads keep their rows apart.
    V.drop_load(spark, path, "a")
    assert V.read_view(spark, path).count() == len(late)


def test_rows_of_a_month_without_days_stay_until_it_is_over(spark, tmp_path):
    path = str(tmp_path / "v")
    rows = [(dt.date(2025, 1, 1), 1), (dt.date(2024, 12, 1), 2), (None, 3)]
    V.write_view(spark.createDataFrame(rows, "event_date date, n int"), path, ["event_date"], dates=Dates(unit="month"))
    assert V.expire(spark, path, dt.date(2025, 2, 5), 10) == ["2024-12-01"]
    assert V.expire(spark, path, dt.date(2025, 2, 5), 5) == ["2025-01-01"]
    assert [r.n for r in V.read_view(spark, path).collect()] == [3]


def test_expiry_starts_over_if_a_load_is_replaced_meanwhile(spark, tmp_path, monkeypatch):
    path, put, writes = str(tmp_path / "v"), Table.put, []
    days = [dt.date(2025, 1, 1) + dt.timedelta(days=i) for i in range(20)]
    frame = lambda ds: V.dated(spark.createDataFrame(moments(*ds), "at timestamp, day string"), "at", "month")
    load = lambda ds: V.write_view(frame(ds), path, ["event_date"], load="a", dates=Dates(unit="month", ts="at"))
    load(days)

    def slow(self, rows, *args):
        writes.append(1)
        if len(writes) == 1:
            load(days[5:15])
        return put(self, rows, *args)

    monkeypatch.setattr(Table, "put", slow)
    V.expire(spark, path, dt.date(2025, 1, 20), 10)
    assert sorted(r.day for r in V.read_view(spark, path).collect()) == [str(d) for d in days[10:15]]


def test_hot_users_are_dealt_to_several_tasks(spark, tmp_path):
    rows = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("u"), F.col("id") % 500)).alias("source_user_id"),
        F.lit("s").alias("source"), (F.col("id") % 10).alias("n"),
    )
    rows.write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    assert sorted(r.source_user_id or "" for r in by_user.hot_users(rows, 8).collect()) == ["", "hot"]
    dealt = by_user.by_user(rows, 8)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 30_000 and max(sizes) < 2.5 * 30_000 / 8
    tasks = dealt.withColumn("p", F.spark_partition_id()).groupBy("source_user_id").agg(F.countDistinct("p").alias("p"), F.countDistinct("_slice").alias("s"))
    spread = {r.source_user_id: (r.p, r.s) for r in tasks.collect()}
    assert spread["hot"][1] > 4 and all(v == (1, 1) for k, v in spread.items() if k not in ("hot", None))
    plan = by_user.newest_by_user(rows, ["n"], 8)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(source" in plan and "_slice" in plan and "REPARTITION_BY_NUM" in plan and "BroadcastHashJoin" in plan
    # Folding the slices needs no shuffle beyond the one by user, and one for what they have been folded to.
    assert plan.split("BroadcastExchange")[0].count("Exchange hashpartitioning") == 2
    newest = {(r.source_user_id, r.n) for r in by_user.newest_by_user(rows, ["n"], 8).collect()}
    assert newest == {(r.source_user_id, r.n) for r in rows.groupBy("source_user_id").agg(F.max("n").alias("n")).collect()}
    assert by_user.by_user(rows.filter("false"), 4).count() == 0


def test_replay_is_bounded_and_pushed_down(spark, tmp_path):
    utc = dt.UTC
    rows = [(b"k", b"v", "t", 0, i, dt.datetime(2024, 1, 1, i, tzinfo=utc)) for i in range(6)]
    spark.createDataFrame(rows, S.EVENT_LOG_SCHEMA).write.parquet(str(tmp_path / "log"))
    part = event_log.replay_files(spark, str(tmp_path / "log"), dt.datetime(2024, 1, 1, 2, tzinfo=utc), dt.datetime(2024, 1, 1, 4, tzinfo=utc))
    assert sorted(r.offset for r in part.collect()) == [2, 3]
    assert "GreaterThanOrEqual(timestamp" in part._jdf.queryExecution().executedPlan().toString()


def test_response_scan_keeps_empty_requests(spark, tmp_path):
    rows = [("a", 0, None, 1.0, n, 200, None, "{}") for n in (0, 1, None)]
    spark.createDataFrame(rows, S.RESPONSE_SCHEMA).write.json(str(tmp_path / "r"))
    found = N.classify_responses(RS.read_responses(spark, str(tmp_path / "r"), "json")).collect()
    assert sorted((str(r.expected_count), r.reason) for r in found) == [
        ("0", "invalid_request"), ("1", "unexpected_response"), ("None", "invalid_request"),
    ]


def test_percentiles_take_every_number(spark):
    values = [-5.0, -4.0, -3.0, 1.0, 2.0, 0.0, -0.5, 1e-9, float("inf"), float("-inf"), None, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r.per_mille: (r.rows, r.value) for r in M.exact_percentiles(df, "v", [100, 500, 1000], []).collect()}
    assert got == {100: (10, float("-inf")), 500: (10, -0.5), 1000: (10, float("inf"))}


@pytest.mark.parametrize("k", [200, 800])
def test_sketches_merge_within_their_rank_error(spark, k):
    rnd = random.Random(k)
    rows = [(i % 24, "ab"[i % 3 == 0], rnd.lognormvariate(0, 3)) for i in range(30_000)] + [(0, "a", None), (1, "a", float("nan"))]
    df = spark.createDataFrame(rows, "slot int, kind string, v double").repartition(7)
    sketches = M.quantile_sketches(df, "v", ["kind", "slot"], k)
    assert sketches.agg(F.sum("rows")).first()[0] == 30_000
    for part, by in ((sketches, ["kind"]), (sketches.filter("slot < 6"), []), (sketches, ["kind", "slot"])):
        for r in M.merged_percentiles(part, [0, 10, 500, 990, 1000], by).collect():
            group = sorted(v for s, x, v in rows if v is not None and v == v and ("kind" not in by or x == r.kind) and ("slot" not in by or s == r.slot) and (by or s < 6))
            assert r.rows == len(group)
            below, upto = (sum(f(v, r.value) for v in group) for f in (lambda a, b: a < b, lambda a, b: a <= b))
            most = 2 * M.rank_error(k) * len(group) + 1
            assert below - most <= r.per_mille / 1000 * len(group) <= upto + most
    assert M.merged_percentiles(sketches.filter("false"), [500], ["kind"]).count() == 0
    assert "partial_kll_merge_agg" in M.merged_percentiles(sketches, [500], ["kind"])._jdf.queryExecution().executedPlan().toString()
